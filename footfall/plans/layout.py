"""Sort, limit, sampling, layout and set operations."""

from pyspark.sql import functions as F

from footfall.operators import etl, relational, skew
from footfall.plans.oracle_views import with_views
from footfall.plans.registry import query
from footfall.sources import tables as src


@query("sort_desc", with_views("emp", "SELECT name, CAST(round(salary*100) AS BIGINT) AS salary_cents FROM emp"))
def sort_desc(spark, sf):
    rows = src.employee(spark, sf).select("name", F.round(F.col("salary") * 100).cast("bigint").alias("salary_cents"))
    return rows.orderBy(F.desc("salary_cents"), "name")


@query(
    "secondary_sort",
    with_views("el", """
SELECT u_sd, event_id, s_time FROM el"""),
)
def secondary_sort(spark, sf):
    # a hot session spreads over partitions: the range includes the time
    rows = src.event_logs(spark, sf).select("u_sd", "event_id", "s_time")
    return rows.repartitionByRange("u_sd", "s_time", "event_id").sortWithinPartitions("u_sd", "s_time", "event_id")


@query(
    "sort_desc_order",
    with_views("emp", """
, s AS (SELECT name, CAST(round(salary*100) AS BIGINT) AS salary_cents FROM emp)
SELECT *, lag(name) OVER (ORDER BY salary_cents DESC, name) AS previous FROM s"""),
)
def sort_desc_order(spark, sf):
    """The rows of ``sort_desc`` with the one that stands before each."""
    return skew.with_row_before(sort_desc(spark, sf), "name", "previous")


@query(
    "secondary_sort_order",
    with_views("el", """
SELECT u_sd, event_id, s_time, lag(event_id) OVER (ORDER BY u_sd NULLS FIRST, s_time NULLS FIRST, event_id) AS previous FROM el"""),
)
def secondary_sort_order(spark, sf):
    return skew.with_row_before(secondary_sort(spark, sf), "event_id", "previous")


@query(
    "take_n",
    with_views("emp", """
SELECT name, CAST(round(salary*100) AS BIGINT) AS salary_cents FROM emp ORDER BY salary_cents DESC, name LIMIT 10"""),
)
def take_n(spark, sf):
    return sort_desc(spark, sf).limit(10)


@query(
    "sample_fraction",
    "SELECT count(*) AS n_rows, TRUE AS share_near_fraction, TRUE AS repeatable FROM events",
)
def sample_fraction(spark, sf):
    events = src.table(spark, sf, "events").select("event_id")
    first = events.sample(withReplacement=False, fraction=0.3, seed=9)
    again = events.sample(withReplacement=False, fraction=0.3, seed=9)
    both = events.select(F.lit("all").alias("kind"), "event_id").unionByName(
        first.select(F.lit("first").alias("kind"), "event_id")
    ).unionByName(again.select(F.lit("again").alias("kind"), "event_id"))
    n = lambda kind: F.count_if(F.col("kind") == kind)
    ids = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("event_id")))
    return both.agg(
        n("all").alias("n_rows"),
        (F.abs(n("first") / n("all") - 0.3) < 0.1).alias("share_near_fraction"),
        ((n("first") == n("again")) & (ids("first") == ids("again"))).alias("repeatable"),
    )


@query(
    "random_split",
    "SELECT count(*) AS rows_in_parts, count(DISTINCT event_id) AS distinct_keys, CAST(0 AS BIGINT) AS keys_in_two_parts FROM events",
)
def random_split(spark, sf):
    parts = src.table(spark, sf, "events").select("event_id").randomSplit([3.0, 10.0, 20.0], seed=9)
    return relational.split_check(parts, "event_id")


@query("repartition_layout", "SELECT o_orderkey, o_custkey FROM orders")
def repartition_layout(spark, sf):
    rows = src.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return rows.repartition(16, "o_orderkey").coalesce(4)


@query("distinct_rows", with_views("uva", "SELECT DISTINCT user_id, session_id FROM uva"))
def distinct_rows(spark, sf):
    return src.user_visit_action(spark, sf).select("user_id", "session_id").distinct()


@query(
    "drop_duplicates_by_key",
    with_views("uva", """
SELECT user_id, event_id, page_id FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY action_time, event_id) AS rn FROM uva) WHERE rn = 1"""),
)
def drop_duplicates_by_key(spark, sf):
    rows = src.user_visit_action(spark, sf).select("user_id", "event_id", "page_id", "action_time")
    first = relational.first_per_key(rows, ["user_id"], [F.asc("action_time"), F.asc("event_id")])
    return first.select("user_id", "event_id", "page_id")


@query(
    "union_all",
    """SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier
UNION ALL SELECT c_custkey, c_name FROM customer""",
)
def union_all(spark, sf):
    customers = src.table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    suppliers = src.table(spark, sf, "supplier").selectExpr("s_name AS name", "s_suppkey AS id")
    return customers.unionByName(suppliers).unionByName(customers)


@query("except_distinct", "SELECT l_partkey AS id FROM lineitem EXCEPT SELECT l_suppkey FROM lineitem")
def except_distinct(spark, sf):
    lines = src.table(spark, sf, "lineitem")
    return lines.selectExpr("l_partkey AS id").subtract(lines.selectExpr("l_suppkey AS id"))


@query("intersect_distinct", "SELECT l_partkey AS id FROM lineitem INTERSECT SELECT l_suppkey FROM lineitem")
def intersect_distinct(spark, sf):
    lines = src.table(spark, sf, "lineitem")
    return lines.selectExpr("l_partkey AS id").intersect(lines.selectExpr("l_suppkey AS id"))


@query(
    "rowkey_dedupe",
    with_views("el", """
SELECT s_time, en, u_ud, coalesce(u_mid, '') AS u_mid, min(event_id) AS event_id FROM el GROUP BY ALL"""),
)
def rowkey_dedupe(spark, sf):
    logs = src.event_logs(spark, sf).select("s_time", "en", "u_ud", "u_mid", "event_id")
    # every record arrives twice, the second time under a later id
    twice = logs.unionByName(logs.withColumn("event_id", F.col("event_id") + F.lit(10**12)))
    kept = etl.dedupe(twice, [F.asc("event_id")])
    return kept.select("s_time", "en", "u_ud", F.coalesce("u_mid", F.lit("")).alias("u_mid"), "event_id")
