"""Sources."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall import schemas
from footfall.operators import etl
from footfall.functions.times import ms_day
from footfall.plans import params
from footfall.plans.oracle_views import with_views
from footfall.plans.registry import query
from footfall.session import workspace
from footfall.sinks import tables as sink
from footfall.sources import files, loglines
from footfall.sources import tables as src


@query(
    "scan_date_range",
    with_views("uva", f"""
SELECT event_id, CAST(date AS VARCHAR) AS date, user_id, session_id, page_id,
  coalesce(click_category_id, -1) AS click_category_id
FROM uva WHERE date >= DATE '{params.START_DATE}' AND date <= DATE '{params.END_DATE}'"""),
)
def scan_date_range(spark, sf):
    days = (params.START_DATE, params.END_DATE)
    actions = files.date_range(src.user_visit_action(spark, sf, days), *days)
    return actions.select(
        "event_id",
        F.col("date").cast("string").alias("date"),
        "user_id",
        "session_id",
        "page_id",
        F.coalesce("click_category_id", F.lit(-1)).alias("click_category_id"),
    )


@query(
    "json_scan",
    with_views("emp", """
SELECT name, age, depId AS dep_id, gender, CAST(round(salary*100) AS BIGINT) AS salary_cents FROM emp"""),
)
def json_scan(spark, sf):
    path = sink.write_json(src.employee(spark, sf), workspace(spark, "employee-json"))
    return files.json_lines(spark, path, schemas.EMPLOYEE).select(
        "name", "age", F.col("depId").alias("dep_id"), "gender",
        F.round(F.col("salary") * 100).cast("bigint").alias("salary_cents"),
    )


@query(
    "text_scan",
    with_views("ads", """
SELECT concat_ws(' ', CAST(click_ms AS VARCHAR), province, city, CAST(user_id AS VARCHAR),
  CAST(ad_id AS VARCHAR)) AS value FROM ads"""),
)
def text_scan(spark, sf):
    path = workspace(spark, "click-lines")
    src.ad_click_lines(spark, sf).select("value").write.text(path)
    return files.text_lines(spark, path)


@query(
    "ctrl_a_scan",
    with_views("uva", """
SELECT CAST(date AS VARCHAR) AS date, user_id, session_id, page_id,
  coalesce(search_keyword, '') AS search_keyword, coalesce(click_product_id, -1) AS click_product_id,
  coalesce(order_category_ids, '') AS order_category_ids, city_id FROM uva"""),
)
def ctrl_a_scan(spark, sf):
    path = workspace(spark, "actions-ctrl-a")
    columns = [f.name for f in schemas.USER_VISIT_ACTION.fields]
    actions = src.user_visit_action(spark, sf).withColumn(
        "order_product_ids", F.lit(None).cast("string")
    ).withColumn("pay_product_ids", F.lit(None).cast("string"))
    actions.select(*[F.col(c).cast("string").alias(c) for c in columns]).write.csv(
        path, sep=files.CTRL_A, nullValue="\\N", quote="", emptyValue=""
    )
    return files.ctrl_a(spark, path, schemas.USER_VISIT_ACTION).select(
        "date", "user_id", "session_id", "page_id",
        F.coalesce("search_keyword", F.lit("")).alias("search_keyword"),
        F.coalesce("click_product_id", F.lit(-1)).alias("click_product_id"),
        F.coalesce("order_category_ids", F.lit("")).alias("order_category_ids"),
        "city_id",
    )


@query("jdbc_dim_scan", with_views("ci", "SELECT city_id, city_name, area FROM ci"))
def jdbc_dim_scan(spark, sf):
    path = sink.overwrite(src.city_info(spark, sf), workspace(spark, "city-info"))
    return files.dimension(spark, "parquet", path, schemas.CITY_INFO)


@query(
    "hive_table_load",
    """SELECT CAST(p_partkey AS INTEGER) AS key, p_name AS value, n_per_value
FROM part JOIN (SELECT p_name AS pn, count(*) AS n_per_value FROM part GROUP BY p_name) ON pn = p_name
WHERE n_per_value > 1 ORDER BY key""",
)
def hive_table_load(spark, sf):
    path = workspace(spark, "src")
    name = "footfall_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (key INT, value STRING) USING parquet LOCATION '{path}'")
    loaded = src.table(spark, sf, "part").selectExpr("CAST(p_partkey AS INT) AS key", "p_name AS value")
    loaded.write.insertInto(name)
    # the table is external: its files stay when the catalog forgets it
    spark.sql(f"DROP TABLE {name}")
    return spark.sql("""
        SELECT key, value, n_per_value
        FROM {rows} JOIN (SELECT value, count(*) AS n_per_value FROM {rows} GROUP BY value) USING (value)
        WHERE n_per_value > 1 ORDER BY key""", rows=spark.read.schema("key INT, value STRING").parquet(path))


EVENT_LOG_SCHEMA_COLUMNS = ["dt", "en", "u_ud", "s_time", "pl", "browser", "browser_v"]


@query(
    "event_log_scan",
    with_views("el", f"""
SELECT dt, en, u_ud, s_time, pl, browser, browser_v FROM el WHERE dt = '{params.RUN_DATE}' AND en = 'e_l'"""),
)
def event_log_scan(spark, sf):
    logs = src.event_logs(spark, sf, params.SCAN_DAYS)  # the wanted day and its neighbours
    path = sink.overwrite(logs, workspace(spark, "event-logs"), ["dt"])
    return files.event_log(
        spark, path, params.RUN_DATE, EVENT_LOG_SCHEMA_COLUMNS, event="e_l", schema=logs.schema
    )


@query(
    "event_log_time_range",
    with_views("el", f"""
SELECT dt, en, u_ud, s_time, pl, browser, browser_v FROM el
WHERE s_time >= {params.RANGE_MS[0]} AND s_time < {params.RANGE_MS[1]}"""),
)
def event_log_time_range(spark, sf):
    """Some hours across midnight, of logs stored in the order of their time."""
    logs = src.event_logs(spark, sf, params.SCAN_DAYS)
    path = sink.overwrite_clustered(logs, workspace(spark, "event-logs"), ["dt"], ["s_time"])
    return files.event_log_range(spark, path, *params.RANGE_MS, EVENT_LOG_SCHEMA_COLUMNS, schema=logs.schema)


@query(
    "raw_log_scan",
    with_views("el", f"""
SELECT split_part(p_url, '/', 5) AS page, count(*) AS n FROM el WHERE dt = '{params.RUN_DATE}' GROUP BY ALL"""),
)
def raw_log_scan(spark, sf):
    root = workspace(spark, "logs")
    lines = loglines.good_lines(src.event_logs(spark, sf, params.SCAN_DAYS))
    # the wanted day's folder beside its neighbours'
    for day in sorted({*params.SCAN_DAYS, params.RUN_DATE}):
        lines.where(F.col("dt") == day).select("value").write.text(files.raw_log_path(root, day))
    parsed = etl.parse_lines(files.raw_log(spark, root, params.RUN_DATE))
    page = F.element_at(F.split("p_url", "/"), -1)
    return (
        parsed.where(ms_day(F.col("s_time")) == params.RUN_DATE)
        .groupBy(page.alias("page"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


KINDS = [("view", 1), ("click", 2), ("signup", 3), ("purchase", 4), ("error", 5)]


@query(
    "inline_relation",
    """SELECT CAST(code AS BIGINT) AS code, concat('val_', CAST(code AS VARCHAR)) AS value, count(*) AS n
FROM events JOIN (VALUES ('view',1),('click',2),('signup',3),('purchase',4),('error',5)) v(kind, code)
ON event_type = kind GROUP BY ALL""",
)
def inline_relation(spark, sf):
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("code", T.LongType())])
    kinds = files.literal_relation(spark, KINDS, schema)
    records = files.numbered_relation(
        spark, 100, F.col("id").alias("code"), F.concat(F.lit("val_"), F.col("id")).alias("value")
    )
    events = src.table(spark, sf, "events").select(F.col("event_type").alias("kind"))
    return (
        events.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
        .join(kinds, "kind").join(records, "code").select("code", "value", "n")
    )
