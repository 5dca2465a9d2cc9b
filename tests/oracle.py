"""Row-by-row comparison of a Spark frame with a DuckDB query."""

import datetime
import decimal
import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def same(df, con, sql):
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    expected = table([c[0] for c in cur.description], cur.fetchall())
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    assert got[1] == expected[1]
