"""Exploration reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeweave.operators import analytics
from lodeweave.plans.graphs import CUSTOMER_SQL, customer_triples
from lodeweave.plans.registry import query, table

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _TABLES))
def count_tables(spark, d):
    return analytics.table_counts({t: table(spark, d, t) for t in _TABLES})


@query(f"WITH {CUSTOMER_SQL} SELECT count(DISTINCT s) AS n_subjects FROM ct")
def count_distinct_subjects(spark, d):
    return analytics.distinct_subjects(customer_triples(spark, d))


@query(f"WITH {CUSTOMER_SQL} SELECT s, count(*) AS n FROM ct GROUP BY s")
def count_by_subject(spark, d):
    return analytics.count_by(customer_triples(spark, d), "s")


@query("SELECT lower(trim(p_type)) AS p_type, count(*) AS n FROM part GROUP BY 1")
def type_frequency(spark, d):
    return analytics.type_frequency(table(spark, d, "part"), "p_type")


@query("SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS tag FROM part) GROUP BY tag")
def tag_frequency(spark, d):
    return analytics.tag_frequency(table(spark, d, "part").select(F.split("p_name", " ").alias("tags")), "tags")


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS created, CAST(sum(CASE WHEN o_orderkey % 3 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS modified, CAST(sum(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS untouched FROM orders GROUP BY 1""")
def monthly_hist(spark, d):
    o = table(spark, d, "orders").withColumn("changed", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate")).otherwise(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")))
    return analytics.monthly(o, "o_orderdate", "changed")


@query("""SELECT period, n, CAST(sum(n) OVER (ORDER BY period) AS BIGINT) AS total FROM (SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS n FROM orders GROUP BY 1)""")
def cumulative_growth(spark, d):
    return analytics.cumulative(table(spark, d, "orders"), "o_orderdate")


@query("""SELECT count(*) AS n, count(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate""")
def modified_before_created(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate").join(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate"), "o_orderkey")
    return analytics.anomalies(rows, "o_orderdate", "l_shipdate")


@query("""SELECT source, round(sum(n_chars) / 1e9, 9) AS sum_g, round(avg(n_chars) / 1e9, 12) AS mean_g FROM documents GROUP BY source""")
def size_report(spark, d):
    out = analytics.size_report(table(spark, d, "documents"), F.col("n_chars"), ["source"])
    return out.select("source", F.round("sum_g", 9).alias("sum_g"), F.round("mean_g", 12).alias("mean_g"))


@query("""SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events""")
def distinct_dates(spark, d):
    return table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day")).distinct()


@query("""SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def windowed_events(spark, d):
    from lodeweave.streaming.apply import windowed_counts

    return windowed_counts(table(spark, d, "events"), "ts", ["event_type"])
