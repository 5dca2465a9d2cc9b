"""Versioned-store queries: orders as observations, by customer and month."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeweave.functions.columns import triple_hash
from lodeweave.operators import store
from lodeweave.plans.registry import query, table
from lodeweave.sources.scratch import scratch_path


def _observed(spark, d):
    """(triplet_id, extraction_info_id, time): a customer's order status, seen with the order's priority."""
    o = table(spark, d, "orders")
    return o.select((F.col("o_custkey") * 10 + F.ascii("o_orderstatus") % 10).alias("triplet_id"), F.substring("o_orderpriority", 1, 1).cast("long").alias("extraction_info_id"), F.col("o_orderdate").alias("time"))


CUT = "1996-01-01 00:00:00"
OBSERVED_SQL = """obs AS (SELECT o_custkey * 10 + ascii(o_orderstatus) % 10 AS triplet_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS extraction_info_id, o_orderdate AS t FROM orders),
old AS (SELECT triplet_id, extraction_info_id, min(t) AS use_start, max(t) AS use_end FROM obs WHERE t < TIMESTAMP '1996-01-01' GROUP BY 1, 2),
new AS (SELECT triplet_id, extraction_info_id, max(t) AS t FROM obs WHERE t >= TIMESTAMP '1996-01-01' GROUP BY 1, 2)"""
MERGED_SQL = OBSERVED_SQL + """, ranges AS (SELECT coalesce(old.triplet_id, new.triplet_id) AS triplet_id, coalesce(old.extraction_info_id, new.extraction_info_id) AS extraction_info_id,
 coalesce(use_start, t) AS use_start, coalesce(t, use_end) AS use_end, false AS deprecated FROM old FULL JOIN new ON old.triplet_id = new.triplet_id AND old.extraction_info_id = new.extraction_info_id)"""


def _ranges(spark, d):
    seen = _observed(spark, d)
    cut = F.lit(CUT).cast("timestamp_ntz")
    old = seen.filter(F.col("time") < cut).groupBy("triplet_id", "extraction_info_id").agg(F.min("time").alias("use_start"), F.max("time").alias("use_end")).withColumn("deprecated", F.lit(False))
    return store.merge_ranges(old, seen.filter(F.col("time") >= cut))


def _triplets(ranges):
    return ranges.select(F.col("triplet_id").alias("id"), F.floor(F.col("triplet_id") / 10).alias("subject")).distinct()


def _subjects(spark, d):
    return table(spark, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("subject"))


@query(f"WITH {MERGED_SQL} SELECT * FROM ranges")
def version_ranges(spark, d):
    return _ranges(spark, d)


@query(f"""WITH {MERGED_SQL} SELECT triplet_id, extraction_info_id, use_start, CASE WHEN h THEN TIMESTAMP '1997-01-01' ELSE use_end END AS use_end, h AS deprecated FROM (SELECT *, (triplet_id // 10) % 2 = 0 AND use_end < TIMESTAMP '1997-01-01' AS h FROM ranges)""")
def deprecate_precise(spark, d):
    r = _ranges(spark, d)
    return store.deprecate(r, _triplets(r), _subjects(spark, d), F.lit("1997-01-01").cast("timestamp_ntz"))


@query(f"""WITH {MERGED_SQL}, s AS (SELECT DISTINCT triplet_id AS i FROM ranges WHERE (triplet_id // 10) % 2 = 0 AND use_end < TIMESTAMP '1997-01-01')
SELECT triplet_id, extraction_info_id, use_start, CASE WHEN i IS NOT NULL THEN TIMESTAMP '1997-01-01' ELSE use_end END AS use_end, i IS NOT NULL AS deprecated FROM ranges LEFT JOIN s ON i = triplet_id""")
def deprecate_siblings(spark, d):
    r = _ranges(spark, d)
    return store.deprecate(r, _triplets(r), _subjects(spark, d), F.lit("1997-01-01").cast("timestamp_ntz"), siblings=True)


@query(f"""WITH {MERGED_SQL} SELECT triplet_id, extraction_info_id, use_start, use_end, use_end < TIMESTAMP '1997-01-01' AS deprecated FROM ranges""")
def deprecate_global(spark, d):
    return store.deprecate_before(_ranges(spark, d), F.lit("1997-01-01").cast("timestamp_ntz"))


@query(f"""WITH {MERGED_SQL} SELECT triplet_id, extraction_info_id, use_start, CASE WHEN use_end < TIMESTAMP '1996-06-01' THEN use_end ELSE TIMESTAMP '2000-01-01' END AS use_end, use_end < TIMESTAMP '1996-06-01' AS deprecated FROM ranges""")
def carry_forward(spark, d):
    r = store.deprecate_before(_ranges(spark, d), F.lit("1996-06-01").cast("timestamp_ntz"))
    return store.carry_forward(r, F.lit("2000-01-01").cast("timestamp_ntz"))


def _named(ranges):
    return ranges.select(F.col("triplet_id").alias("id"), F.floor(F.col("triplet_id") / 10).alias("subject"), F.lit("p").alias("predicate"), (F.col("triplet_id") % 10).alias("object")).distinct()


@query(f"""WITH {MERGED_SQL} SELECT DISTINCT triplet_id // 10 AS subject, 'p' AS predicate, triplet_id % 10 AS object FROM ranges WHERE use_end >= TIMESTAMP '1997-01-01'""")
def current_graph(spark, d):
    r = deprecate_global(spark, d)
    return store.current_graph(_named(r), r)


@query(f"""WITH {MERGED_SQL} SELECT DISTINCT triplet_id // 10 AS subject, 'p' AS predicate, triplet_id % 10 AS object FROM ranges WHERE use_start <= TIMESTAMP '1995-06-01' AND use_end >= TIMESTAMP '1995-06-01'""")
def time_travel(spark, d):
    r = _ranges(spark, d)
    return store.as_of(_named(r), r, F.lit("1995-06-01").cast("timestamp_ntz"))


def _facts(df):
    return df.select(F.concat(F.lit("<"), "c_name", F.lit(">")).alias("subject"), F.lit("<seg>").alias("predicate"), F.concat(F.lit('"'), "c_mktsegment", F.lit('"')).alias("object"))


FACT = """'<' || c_name || '>' || '<seg>' || '"' || c_mktsegment || '"'"""


@query(f"SELECT c_custkey, md5({FACT}) AS triplet_hash FROM customer")
def triple_hashes(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", triple_hash(F.concat(F.lit("<"), "c_name", F.lit(">")), F.lit("<seg>"), F.concat(F.lit('"'), "c_mktsegment", F.lit('"'))).alias("triplet_hash"))


@query(f"""WITH h AS (SELECT DISTINCT md5({FACT}) AS triplet_hash, c_custkey % 3 = 0 AS old FROM customer),
o AS (SELECT triplet_hash, row_number() OVER (ORDER BY triplet_hash) AS id FROM h WHERE old), n AS (SELECT triplet_hash, (SELECT max(id) FROM o) + row_number() OVER (ORDER BY triplet_hash) AS id FROM h WHERE NOT old)
SELECT triplet_hash, id AS triplet_id, false AS is_new FROM o UNION ALL SELECT triplet_hash, id, true FROM n""")
def get_or_create_ids(spark, d):
    c = table(spark, d, "customer")
    none = spark.createDataFrame([], store.TRIPLETS)
    old, _ = store.get_or_create_triplets(_facts(c.filter("c_custkey % 3 = 0")), none)
    _, rows = store.get_or_create_triplets(_facts(c), old)
    return rows.select("triplet_hash", "triplet_id", "is_new")


@query("""WITH h AS (SELECT DISTINCT event_type AS m, CAST(round(CAST(value / 1000 AS DECIMAL(18, 9)), 5) AS DECIMAL(6, 5)) AS c FROM events)
SELECT row_number() OVER (ORDER BY md5(m || CAST(c AS VARCHAR))) AS id, m AS method_description, CAST(c AS DOUBLE) AS extraction_confidence, md5(m || CAST(c AS VARCHAR)) AS extraction_info_hash FROM h""")
def info_ids(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("method"), (F.col("value") / 1000).alias("confidence"))
    infos, _ = store.get_or_create_infos(e, spark.createDataFrame([], store.INFOS))
    return infos.withColumn("extraction_confidence", F.col("extraction_confidence").cast("double"))


@query("""SELECT 'ranges' AS what, count(DISTINCT (user_id, event_type)) AS n FROM events UNION ALL SELECT 'triplets', count(DISTINCT (user_id, event_type)) FROM events""")
def stream_apply(spark, d):
    """A folder of batches applied to a store by a stream; what the store then holds."""
    from lodeweave.streaming.apply import apply_stream

    root = scratch_path(spark, "stream")
    e = table(spark, d, "events")
    t = F.lit("<type>")
    obs = e.select(F.concat(F.lit("<u"), F.col("user_id").cast("string"), F.lit(">")).alias("subject"), t.alias("predicate"), F.concat(F.lit('"'), "event_type", F.lit('"')).alias("object"), F.lit("log").alias("method"), F.lit(1.0).alias("confidence"), F.lit("2024-01-01").cast("timestamp_ntz").alias("time"))
    obs.coalesce(2).write.parquet(f"{root}/in")
    apply_stream(spark, f"{root}/in", f"{root}/store", f"{root}/cp").awaitTermination()
    s = store.Store.load(spark, f"{root}/store")
    one = lambda name, df: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
    return one("triplets", s.triplets).unionByName(one("ranges", s.ranges.select("triplet_id").distinct()))
