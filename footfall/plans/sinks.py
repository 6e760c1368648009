"""Sinks and write rules."""

from pyspark.sql import functions as F

from footfall.operators import kpi, orders, products
from footfall.operators.ads import parse_clicks, user_ad_counts
from footfall.plans import params
from footfall.plans.kpis import HISTORY_SQL, history, kpi_ctes
from footfall.plans.oracle_views import with_views
from footfall.plans.orders import count_cube
from footfall.plans.registry import query
from footfall.session import workspace
from footfall.sinks import buckets
from footfall.sinks import tables as sink
from footfall.sources import tables as src


@query(
    "json_sink",
    "SELECT c_mktsegment AS segment, count(*) AS n, min(c_custkey) AS first_key FROM customer GROUP BY ALL",
)
def json_sink(spark, sf):
    result = src.table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("first_key")
    )
    path = sink.write_json(result, workspace(spark, "segments"))
    return spark.read.schema(result.schema).json(path)


@query(
    "multi_insert",
    with_views("oe", """
, base AS (SELECT pl, date, cut, pt, count(DISTINCT oid) AS orders FROM oe WHERE en='e_crt' GROUP BY ALL)
SELECT 'base' AS target, date, pl, cut, pt, orders FROM base
UNION ALL SELECT 'export' AS target, date, pl, cut, pt, orders FROM base"""),
)
def multi_insert(spark, sf):
    base = orders.base_counts(src.order_events(spark, sf))
    first, second = workspace(spark, "orders-base"), workspace(spark, "orders-export")
    columns = ["date", "pl", "cut", "pt", "orders"]
    sink.insert_many(base, [(base, first), (base.select(*columns), second)])

    def read(path, tag):
        return spark.read.schema(base.schema).parquet(path).select(F.lit(tag).alias("target"), *columns)

    return read(first, "base").unionByName(read(second, "export"))


@query("insert_overwrite_append", count_cube("e_crt", own=True))
def insert_overwrite_append(spark, sf):
    base = orders.base_counts(src.order_events(spark, sf)).select("date", "pl", "cut", "pt", "orders")
    path = sink.overwrite(base, workspace(spark, "order-counts"))
    stored = spark.read.schema(base.schema).parquet(path)
    rollups = orders.cubed(stored, "orders").where(
        (F.col("pl") == "all") | (F.col("cut") == "all") | (F.col("pt") == "all")
    )
    target = sink.overwrite(stored, workspace(spark, "order-report"))
    sink.append(rollups.select(*base.columns), target)
    return spark.read.schema(base.schema).parquet(target)


@query(
    "batch_insert",
    with_views("uva ci", """
SELECT 1 AS task_id, area, click_product_id AS product_id, count(*) AS click_count
FROM uva JOIN ci USING (city_id) WHERE click_product_id IS NOT NULL GROUP BY area, click_product_id
UNION ALL
SELECT 2 AS task_id, area, click_product_id, count(*)
FROM uva JOIN ci USING (city_id) WHERE click_product_id IS NOT NULL GROUP BY area, click_product_id"""),
)
def batch_insert(spark, sf):
    counts = products.area_product_clicks(src.user_visit_action(spark, sf), src.city_info(spark, sf))
    target = workspace(spark, "area-products")
    rows = counts.select("area", "product_id", "click_count")
    for task_id in (1, 2, 1):  # the first task is run again
        sink.insert(rows.select(F.lit(task_id).alias("task_id"), *rows.columns), target, ["task_id"])
    return spark.read.parquet(target)


@query(
    "upsert_set",
    with_views("oe", """
, old AS (SELECT oid, min(s_time) AS s_time, 'created' AS state FROM oe WHERE en='e_crt' AND pl='website' GROUP BY oid),
new AS (SELECT DISTINCT oid, 'paid' AS state FROM oe WHERE en='e_cs')
SELECT coalesce(old.oid, new.oid) AS oid, coalesce(s_time, 0) AS s_time, coalesce(new.state, old.state) AS state
FROM old FULL OUTER JOIN new ON old.oid = new.oid"""),
)
def upsert_set(spark, sf):
    events = src.order_events(spark, sf)
    old = (
        events.where("en = 'e_crt' AND pl = 'website'").groupBy("oid")
        .agg(F.min("s_time").alias("s_time"), F.lit("created").alias("state"))
    )
    new = events.where("en = 'e_cs'").select("oid").distinct().withColumn("state", F.lit("paid"))
    root, keys = workspace(spark, "order-state"), ["oid"]
    for rows in (old, new):
        buckets.merge(rows, root, keys, lambda stored, r: sink.upsert_set(stored, r, keys), old.schema)
    return buckets.content(spark, root, old.schema).fillna(0, ["s_time"])


@query(
    "upsert_add",
    with_views("ads", "SELECT date, user_id, ad_id, count(*) AS click_count FROM ads GROUP BY ALL"),
)
def upsert_add(spark, sf):
    clicks = parse_clicks(src.ad_click_lines(spark, sf))
    first_half = F.col("province").isin("P0", "P1")
    keys, root = ["date", "user_id", "ad_id"], workspace(spark, "ad-user-clicks")
    for part in (first_half, ~first_half):
        delta = user_ad_counts(clicks.where(part))
        rule = lambda stored, d: sink.upsert_add(stored, d, keys, "click_count")
        buckets.merge(delta, root, keys, rule, delta.schema)
    return buckets.content(spark, root, delta.schema)


@query(
    "replace_group",
    with_views("ads", f"""
, old AS (SELECT date, province, ad_id, count(*) AS click_count FROM ads GROUP BY ALL),
new AS (SELECT date, province, ad_id, count(DISTINCT user_id) AS click_count FROM ads
  WHERE date >= '{params.RUN_DATE}' AND province IN ('P1','P2') GROUP BY ALL)
SELECT * FROM old WHERE (date, province) NOT IN (SELECT date, province FROM new)
UNION ALL SELECT * FROM new"""),
)
def replace_group(spark, sf):
    clicks = parse_clicks(src.ad_click_lines(spark, sf))
    keys = ["date", "province", "ad_id"]
    old = clicks.groupBy(*keys).agg(F.count(F.lit(1)).alias("click_count"))
    new = (
        clicks.where((F.col("date") >= params.RUN_DATE) & F.col("province").isin("P1", "P2"))
        .groupBy(*keys).agg(F.count_distinct("user_id").alias("click_count"))
    )
    root, group = workspace(spark, "ad-province-clicks"), ["date", "province"]
    for rows in (old, new):
        buckets.merge(rows, root, group, lambda stored, r: sink.replace_group(stored, r, group), old.schema)
    return buckets.content(spark, root, old.schema)


@query(
    "rerun_idempotent_delete",
    with_views("el", """
, m AS (SELECT u_mid AS member_id, min(dt) AS created FROM el WHERE u_mid IS NOT NULL GROUP BY u_mid)
SELECT member_id, created, CASE WHEN created = (SELECT min(created) FROM m) THEN 2 ELSE 1 END AS run FROM m"""),
)
def rerun_idempotent_delete(spark, sf):
    first_seen = (
        src.event_logs(spark, sf).where(F.col("u_mid").isNotNull())
        .groupBy(F.col("u_mid").alias("member_id"))
        .agg(F.min(F.col("dt").cast("date")).cast("string").alias("created"))
        .withColumn("run", F.lit(1))
    )
    path = sink.overwrite(first_seen, workspace(spark, "member-info"), ["created"])
    stored = spark.read.schema(first_seen.schema).parquet(path)
    # the run of the first date is repeated: its partition is rewritten, the others stay
    run_date = stored.agg(F.min("created")).first()[0]
    again = first_seen.where(F.col("created") == run_date).withColumn("run", F.lit(2))
    sink.replace_partitions(again, path, ["created"])
    return spark.read.schema(first_seen.schema).parquet(path).select("member_id", "created", "run")


@query(
    "kpi_fact_export",
    with_views("el", kpi_ctes() + f""", hist AS ({HISTORY_SQL}),
dims AS (SELECT DISTINCT date, platform FROM both_pl),
au AS (SELECT date, platform, count(DISTINCT u_ud) AS active_users FROM both_pl GROUP BY ALL),
nu AS (SELECT date, platform, count(DISTINCT u_ud) AS new_install_users FROM both_pl WHERE en='e_l' GROUP BY ALL),
am AS (SELECT date, platform, count(DISTINCT u_mid) AS active_members FROM both_pl WHERE en='e_pv' GROUP BY ALL),
nm AS (SELECT date, platform, count(DISTINCT u_mid) AS new_members FROM both_pl
  WHERE u_mid NOT IN (SELECT member_id FROM hist) GROUP BY ALL),
sp AS (SELECT date, platform, u_sd, max(s_time)-min(s_time) AS span FROM both_pl GROUP BY ALL),
se AS (SELECT date, platform, count(*) AS sessions,
  CAST((sum(CASE WHEN span <= 86400000 THEN span ELSE 0 END) + 999)//1000 AS BIGINT) AS sessions_length FROM sp GROUP BY ALL)
, facts AS (
SELECT date, platform, coalesce(active_users,0) AS active_users, coalesce(new_install_users,0) AS new_install_users,
  coalesce(active_members,0) AS active_members, coalesce(new_members,0) AS new_members,
  coalesce(sessions,0) AS sessions, coalesce(sessions_length,0) AS sessions_length
FROM dims LEFT JOIN au USING (date, platform) LEFT JOIN nu USING (date, platform)
  LEFT JOIN am USING (date, platform) LEFT JOIN nm USING (date, platform) LEFT JOIN se USING (date, platform))
SELECT *, CAST(sum(new_install_users) OVER w AS BIGINT) AS total_install_users,
  CAST(sum(new_members) OVER w AS BIGINT) AS total_members
FROM facts WINDOW w AS (PARTITION BY platform ORDER BY date)"""),
)
def kpi_fact_export(spark, sf):
    return kpi.user_facts(src.event_logs(spark, sf), history(spark, sf))
