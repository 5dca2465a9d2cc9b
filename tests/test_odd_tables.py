"""Queries against their SQL on tables with rows that the test tables lack."""

import random

import duckdb
from pyspark.sql import functions as F

from lodeweave.operators import graph, objects
from lodeweave.plans import registry
from lodeweave.sources import writers
from tests import oracle


def agree(spark, d, name, **tables):
    """Writes the tables under a folder; the query's rows there are those of its SQL."""
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t, df in tables.items():
        df.write.parquet(f"{d}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    oracle.same(registry.queries()[name](spark, str(d)), con, registry.oracle_sql()[name])


def test_days_of_any_year_and_zone(spark, tmp_path):
    events = spark.createDataFrame([(x,) for x in (6_000_000, 3_000_000, 2_000_000, 0, -400_000, -735_000, -741_000, -1_500_000, None)], "event_id long")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", z)
            agree(spark, tmp_path / z.replace("/", "-"), "epoch_to_date", events=events)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_long_numbers_on_pages(spark, tmp_path):
    texts = [
        "<title>a</title> 4356412207950626 b", "<h1>9007199254740993</h1>", "<h1 id=x>n 12345678901234567890123</h1> 7 likes", "99999999999999999999 views, 12", "99999999999999999999 views", "9223372036854775807 pages",
        "<h1>1234567890123</h1> downloads: 1234567890123456789", "downloads: 99999999999999999999999", "<h1>0042</h1>", "<h1>1.5K</h1>", "none", "", None,
    ]
    agree(spark, tmp_path, "html_stat_scrape", pages=spark.createDataFrame(list(enumerate(texts)), "page_id long, html string"))


def folded(counts, size, weight=7):
    """The fold over subjects in order, as plain as it can be said."""
    chunk, held, out = 1, 0, []
    for subject, n in counts:
        if held * weight >= size:
            chunk, held = chunk + 1, 0
        held += n
        out.append((subject, n, chunk))
    return out


def test_chunks_are_one_fold_at_any_size(spark):
    rng = random.Random(3)
    counts = sorted((f"urn:{'é' if i % 3 else 'z'}{i}", rng.choice((1, 1, 2, 3, 5, 40))) for i in range(3000)) + [(None, 4)]
    t = spark.createDataFrame(counts, "s string, k int").select("s", F.explode(F.sequence(F.lit(1), "k")))
    got = lambda *a, **k: sorted(map(tuple, graph.subject_chunks(t, *a, **k).collect()), key=lambda r: (r[0] is None, r[0]))
    assert got(1) == folded(counts, 1)
    assert got(8) == folded(counts, 8)
    for size in (50, 1000, 9000, 10**9):
        assert got(size, per_run=400) == folded(counts, size)
    assert graph.subject_chunks(t.limit(0), 50).collect() == []


def test_each_chunk_is_one_file(spark, tmp_path):
    t = spark.range(0, 4000, 1, 8).select(F.concat(F.lit("urn:"), (F.col("id") % 400).cast("string")).alias("s"), F.lit("urn:p").alias("p"), F.col("id").cast("string").alias("o"), F.lit("literal").alias("o_kind"), F.lit(None).cast("string").alias("o_dtype"))
    aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        n = writers.write_chunks(t, t.withColumn("method", F.lit("m")), 1400, str(tmp_path / "c")).count()
        for part in ("kg", "metadata"):
            files = list((tmp_path / "c" / part).glob("chunk_id=*/part-*"))
            assert n == 20 and len(files) == n == len({f.parent for f in files})
        writers.write_chunks(t, t, 0, str(tmp_path / "one"), per_file=1000)
        assert 1 < len(list((tmp_path / "one/kg/chunk_id=1").glob("part-*"))) <= 5
        assert spark.read.text(str(tmp_path / "one/kg")).count() == 4000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", aqe)


def test_metadata_of_repeated_statements(spark, tmp_path):
    rows = [(i, f"Customer#{i // 3}", i // 3 % 2, 1.0, "BUILDING") for i in range(30)]
    agree(spark, tmp_path, "metadata_chunks", customer=spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"))


def test_entities_of_values_are_made_once(spark):
    cells = spark.range(0, 2000, 1, 4).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("entity"), F.lit("fair4ml:sharedBy").alias("property"), (F.col("id") % 3).cast("string").alias("data"), F.lit("Person or Organization").alias("range"), F.lit("m").alias("method"), F.lit(1.0).alias("confidence"), F.lit("t").alias("extraction_time"))
    plain, fold = (objects.typed_triples(cells, "open_ml", fold=f) for f in (False, True))
    assert (plain.count(), fold.count()) == (4 * 2000, 2000 + 3 * 3)
    assert sorted(map(tuple, plain.distinct().collect()), key=repr) == sorted(map(tuple, fold.distinct().collect()), key=repr)
