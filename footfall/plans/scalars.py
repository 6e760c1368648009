"""Scalar functions and the registered-function surface."""

from pyspark.sql import functions as F

from footfall.functions import numbers, text, times, web
from footfall.operators import dims, skew
from footfall.plans.oracle_views import ratio2, with_views
from footfall.plans.registry import query
from footfall.sources import tables as src


@query(
    "fn_string",
    """SELECT c_custkey, split_part(c_name, '#', 2) AS number, concat(c_mktsegment, '/', CAST(c_nationkey AS VARCHAR)) AS joined,
  concat(c_name, ',x') AS trimmed, CASE WHEN c_nationkey < 10 THEN '0' ELSE '' END || CAST(c_nationkey AS VARCHAR) AS padded,
  c_custkey % 7 = 0 AS empty_flag, substr(c_mktsegment, 2, 3) AS part FROM customer""",
)
def fn_string(spark, sf):
    nation = F.col("c_nationkey").cast("string")
    maybe_empty = F.when(F.col("c_custkey") % 14 == 0, "").when(F.col("c_custkey") % 7 != 0, F.col("c_name"))
    return src.table(spark, sf, "customer").select(
        "c_custkey",
        F.split("c_name", "#").getItem(1).alias("number"),
        F.concat("c_mktsegment", F.lit("/"), nation).alias("joined"),
        text.trim_comma(F.concat(F.lit(","), F.col("c_name"), F.lit(",x,"))).alias("trimmed"),
        text.pad2(nation).alias("padded"),
        text.is_empty(maybe_empty).alias("empty_flag"),
        F.substring("c_mktsegment", 2, 3).alias("part"),
    )


@query(
    "fn_kv_string",
    with_views("ui", """
SELECT user_id, CAST(age AS VARCHAR) AS age, '' AS missing,
  concat('age=', age, '|city=here|professional=', professional, '|empty=') AS changed FROM ui"""),
)
def fn_kv_string(spark, sf):
    packed = F.concat(
        F.lit("age="), F.col("age"), F.lit("|city="), F.col("city"), F.lit("|professional="),
        F.col("professional"), F.lit("|empty="),
    )
    return src.user_info(spark, sf).select(
        "user_id",
        text.get_field(packed, "age").alias("age"),
        F.coalesce(text.get_field(packed, "empty"), text.get_field(packed, "absent"), F.lit("")).alias("missing"),
        text.set_field(packed, "city", F.lit("here")).alias("changed"),
    )


@query(
    "fn_date",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,
  strftime(ts, '%Y%m%d') AS date_key, strftime(ts, '%Y%m%d%H%M') AS minute_key, strftime(ts, '%Y-%m-%d_%H') AS date_hour,
  strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS yesterday,
  epoch_us(date_trunc('second', ts) - TIMESTAMP '2024-01-01 00:00:30')//1000000 AS seconds,
  CAST(trunc((epoch_us(date_trunc('second', ts)) - epoch_us(TIMESTAMP '2024-01-01 00:00:30'))//1000000 / 3600) AS BIGINT) AS hours,
  ts < TIMESTAMP '2024-01-15' AS is_before FROM events""",
)
def fn_date(spark, sf):
    ts = F.col("ts")
    base = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:30"), F.lit("yyyy-MM-dd HH:mm:ss"))
    return src.table(spark, sf, "events").select(
        "event_id",
        F.date_format(ts, "yyyy-MM-dd").alias("day"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.date_format(ts, "yyyyMMdd").alias("date_key"),
        times.minute_key(ts).alias("minute_key"),
        times.date_hour(ts).alias("date_hour"),
        F.date_sub(ts.cast("date"), 1).cast("string").alias("yesterday"),
        times.seconds_between(ts, base).alias("seconds"),
        numbers.int_div(times.seconds_between(ts, base), F.lit(3600)).alias("hours"),
        (ts < F.expr("TIMESTAMP_NTZ'2024-01-15 00:00:00'")).alias("is_before"),
    )


@query(
    "fn_epoch",
    with_views("el", """
SELECT event_id, s_time AS parsed_ms, dt AS day, (s_time//3600000)%24 AS hour, CAST(-1 AS BIGINT) AS bad FROM el"""),
)
def fn_epoch(spark, sf):
    ms = F.col("s_time")
    nginx = F.concat_ws(".", numbers.int_div(ms, F.lit(1000)).cast("string"), F.lpad((ms % 1000).cast("string"), 3, "0"))
    parsed = times.nginx_ms(nginx)
    return src.event_logs(spark, sf).select(
        "event_id",
        parsed.alias("parsed_ms"),
        times.ms_day(parsed).alias("day"),
        times.ms_hour(parsed).alias("hour"),
        times.nginx_ms(F.col("en")).alias("bad"),
    )


@query(
    "fn_math",
    f"""SELECT l_orderkey, l_linenumber, {ratio2('CAST(l_quantity AS BIGINT)', '(l_partkey + 1)')} AS ratio,
  CAST(round(l_extendedprice) AS BIGINT) AS rounded, TRUE AS rand_in_range FROM lineitem""",
)
def fn_math(spark, sf):
    draw = F.rand(7)
    return src.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.ratio2(F.col("l_quantity").cast("bigint"), F.col("l_partkey") + 1).alias("ratio"),
        F.round("l_extendedprice").cast("bigint").alias("rounded"),
        ((draw >= 0) & (draw < 1)).alias("rand_in_range"),
    )


@query(
    "fn_json",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '' AS bad,
  strftime(ts, '%Y-%m-%d') AS first_value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS typed_k FROM events""",
)
def fn_json(spark, sf):
    params = F.concat(F.lit('{"startDate":["'), F.date_format("ts", "yyyy-MM-dd"), F.lit('","x"],"endDate":[]}'))
    broken = F.concat(F.lit("{"), F.col("props"))
    return src.table(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.coalesce(F.get_json_object(broken, "$.k"), F.get_json_object(params, "$.endDate[0]"), F.lit("")).alias("bad"),
        F.get_json_object(params, "$.startDate[0]").alias("first_value"),
        F.from_json("props", "k BIGINT")["k"].alias("typed_k"),
    )


@query(
    "fn_url_query",
    with_views("el", """
SELECT event_id, en, u_sd, coalesce(p_ref, '') AS p_ref, CAST(3 + CASE WHEN p_ref IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_params,
  concat('last ', event_id) AS twice FROM el"""),
)
def fn_url_query(spark, sf):
    target = F.concat(
        F.lit("/log.gif?en="), F.col("en"), F.lit("&u_sd="), F.url_encode("u_sd"), F.lit("&noise&=x&bad=%zz&blank="),
        F.lit("&twice=first"), F.coalesce(F.concat(F.lit("&p_ref="), F.url_encode("p_ref")), F.lit("")),
        F.lit("&twice="), F.concat(F.lit("last+"), F.col("event_id")),
    )
    logs = src.event_logs(spark, sf).select("event_id", target.alias("target"))
    m = F.col("params")
    return web.with_query_map(logs, "target", "params").select(
        "event_id",
        m["en"].alias("en"),
        m["u_sd"].alias("u_sd"),
        F.coalesce(m["p_ref"], F.lit("")).alias("p_ref"),
        F.size(m).cast("bigint").alias("n_params"),
        m["twice"].alias("twice"),
    )


@query("fn_current", with_views("emp", "SELECT name, TRUE AS same_day, TRUE AS past FROM emp"))
def fn_current(spark, sf):
    now = F.current_timestamp()
    return src.employee(spark, sf).select(
        "name",
        (F.current_date() == F.to_date(now)).alias("same_day"),
        (now > F.lit("2024-01-01").cast("timestamp")).alias("past"),
    )


def _order_span(spark, sf):
    d = F.col("o_orderdate").cast("date")
    return src.table(spark, sf, "orders").agg(F.min(d).alias("first"), F.max(d).alias("last"))


# US week number: weeks start on Sunday, week 1 holds January 1.
_WEEK = "(((dayofyear({s}) - 1) // 7) + 1)"


@query(
    "date_dimension",
    """WITH days AS (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM orders),
w AS (SELECT d, CAST(d - CAST(dayofweek(d) AS INTEGER) AS DATE) AS sun FROM days),
x AS (SELECT d, sun, """ + _WEEK.format(s="CAST(sun + 6 AS DATE)") + """ AS wk FROM w)
SELECT DISTINCT year(d) AS year, CAST(0 AS BIGINT) AS season, CAST(0 AS BIGINT) AS month, CAST(0 AS BIGINT) AS week,
  CAST(0 AS BIGINT) AS day, 'year' AS type, CAST(CAST(date_trunc('year', d) AS DATE) AS VARCHAR) AS calendar FROM x
UNION SELECT year(d), quarter(d), 0, 0, 0, 'season', CAST(CAST(date_trunc('quarter', d) AS DATE) AS VARCHAR) FROM x
UNION SELECT year(d), quarter(d), month(d), 0, 0, 'month', CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) FROM x
UNION SELECT year(sun), quarter(sun), month(sun), CASE WHEN month(sun) = 12 AND wk = 1 THEN 53 ELSE wk END, 0, 'week', CAST(sun AS VARCHAR) FROM x
UNION SELECT year(d), quarter(d), month(d), CASE WHEN month(d) = 12 AND wk = 1 THEN 53 ELSE wk END, day(d), 'day', CAST(d AS VARCHAR) FROM x""",
)
def date_dimension(spark, sf):
    return dims.date_dimension(_order_span(spark, sf))


@query(
    "calendar_series",
    """WITH days AS (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)) + 1, max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
SELECT CAST(d AS VARCHAR) AS day, strftime(d, '%Y-%m') AS month, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_first_day,
  CAST(last_day(d) AS VARCHAR) AS month_last_day, day(last_day(d)) AS days_in_month, quarter(d) AS season,
  quarter(d) * 3 AS season_end_month, CASE WHEN month(d) <= 6 THEN '06' ELSE '12' END AS half_year_end_month,
  dayofweek(d) IN (0, 6) AS is_weekend, CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS week_monday,
  CAST(d - 1 AS VARCHAR) AS last_day_value, CAST(d + 1 AS VARCHAR) AS next_day_value,
  strftime(date_trunc('month', d) - INTERVAL 1 MONTH, '%Y-%m') AS last_month,
  strftime(date_trunc('month', d) + INTERVAL 1 MONTH, '%Y-%m') AS next_month,
  CAST(year(d) - 1 AS VARCHAR) AS last_year,
  strftime(date_trunc('quarter', d) - INTERVAL 1 MONTH, '%Y-%m') AS last_season,
  CASE WHEN month(d) <= 6 THEN concat(year(d) - 1, '-12') ELSE concat(year(d), '-06') END AS last_half_year,
  CAST(year(d) + 1 AS VARCHAR) AS next_year,
  strftime(date_trunc('quarter', d) + INTERVAL 5 MONTH, '%Y-%m') AS next_season,
  CASE WHEN month(d) <= 6 THEN concat(year(d), '-12') ELSE concat(year(d) + 1, '-06') END AS next_half_year,
  array_to_string([concat(year(d), '-', lpad(CAST(quarter(d) * 3 - i AS VARCHAR), 2, '0')) FOR i IN [2, 1, 0]], ',') AS season_months,
  CASE WHEN month(d) <= 6 THEN array_to_string([concat(year(d), '-0', i) FOR i IN [1, 2, 3, 4, 5, 6]], ',')
    ELSE array_to_string([concat(year(d), '-', lpad(CAST(i AS VARCHAR), 2, '0')) FOR i IN [7, 8, 9, 10, 11, 12]], ',') END AS half_year_months
FROM days""",
)
def calendar_series(spark, sf):
    return dims.calendar_days(_order_span(spark, sf))


@query(
    "calendar_months",
    """WITH s AS (SELECT min(CAST(o_orderdate AS DATE)) AS f, max(CAST(o_orderdate AS DATE)) AS l FROM orders),
m AS (SELECT l, CAST(f + to_months(CAST(i AS INTEGER)) AS DATE) AS cur, CAST(f + to_months(CAST(i AS INTEGER) - 1) AS DATE) AS before
  FROM s, range(1, 2000) t(i))
SELECT strftime(cur, '%Y-%m') AS month FROM m WHERE before < l""",
)
def calendar_months(spark, sf):
    return dims.calendar_months(_order_span(spark, sf))


@query(
    "row_fingerprint",
    "SELECT doc_id, md5(concat_ws(chr(31), lang, source, text)) AS fingerprint FROM documents",
)
def row_fingerprint(spark, sf):
    return src.table(spark, sf, "documents").select(
        "doc_id", text.fingerprint(F.col("lang"), F.col("source"), F.col("text")).alias("fingerprint")
    )


@query(
    "hash_bucket_skew_audit",
    """WITH b AS (SELECT l_partkey % 32 AS b, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT count(*) AS buckets, CAST(sum(n) AS BIGINT) AS n_rows, max(n) AS max_rows,
  CAST(max(n) * count(*) * 100 // sum(n) AS BIGINT) AS max_to_mean_pct FROM b""",
)
def hash_bucket_skew_audit(spark, sf):
    return skew.bucket_audit(src.table(spark, sf, "lineitem"), F.col("l_partkey") % 32)


@query(
    "udf_concat_long_string",
    with_views("ci", "SELECT concat(CAST(city_id AS VARCHAR), ':', city_name) AS city, area FROM ci"),
)
def udf_concat_long_string(spark, sf):
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(id BIGINT, name STRING, sep STRING)
                 RETURNS STRING RETURN concat_ws(sep, CAST(id AS STRING), name)""")
    src.city_info(spark, sf).createOrReplaceTempView("footfall_city_info")
    return spark.sql("SELECT concat_long_string(city_id, city_name, ':') AS city, area FROM footfall_city_info")


@query(
    "udf_get_json_object",
    with_views("pi", """
SELECT product_id, json_extract_string(extend_info, '$.product_status') AS product_status FROM pi"""),
)
def udf_get_json_object(spark, sf):
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION json_field(json STRING, field STRING)
                 RETURNS STRING RETURN get_json_object(json, concat('$.', field))""")
    src.product_info(spark, sf).createOrReplaceTempView("footfall_product_info")
    return spark.sql(
        "SELECT product_id, json_field(extend_info, 'product_status') AS product_status FROM footfall_product_info"
    )


@query(
    "udf_random_prefix",
    """SELECT p_partkey, p_name AS restored, TRUE AS salt_in_range FROM part""",
)
def udf_random_prefix(spark, sf):
    salted = text.salted(F.col("p_name"), 10, F.col("p_partkey"))
    prefix = F.substring_index(salted, "_", 1).cast("int")
    return src.table(spark, sf, "part").select(
        "p_partkey", text.unsalted(salted).alias("restored"), prefix.between(0, 9).alias("salt_in_range")
    )


@query("udf_remove_random_prefix", "SELECT p_name AS value, count(*) AS n FROM part GROUP BY ALL")
def udf_remove_random_prefix(spark, sf):
    salted = text.salted(F.col("p_name"), 10, F.col("p_partkey"))
    per_salt = src.table(spark, sf, "part").groupBy(salted.alias("salted")).agg(F.count(F.lit(1)).alias("n"))
    return per_salt.groupBy(text.unsalted(F.col("salted")).alias("value")).agg(F.sum("n").alias("n"))


@query(
    "udaf_group_concat_distinct",
    with_views("ci", """
SELECT area, string_agg(DISTINCT city_name, ',' ORDER BY city_name) AS cities FROM ci GROUP BY area"""),
)
def udaf_group_concat_distinct(spark, sf):
    return src.city_info(spark, sf).groupBy("area").agg(text.distinct_list(F.col("city_name")).alias("cities"))


@query(
    "flat_map_rows",
    with_views("dept", """
SELECT id + 1 AS id, concat(name, '_1') AS name FROM dept UNION ALL SELECT id + 2, concat(name, '_2') FROM dept"""),
)
def flat_map_rows(spark, sf):
    copies = F.array(*[
        F.struct((F.col("id") + i).alias("id"), F.concat("name", F.lit(f"_{i}")).alias("name")) for i in (1, 2)
    ])
    return src.department(spark, sf).select(F.explode(copies).alias("d")).select("d.*")


@query(
    "row_to_string",
    "SELECT concat('KEY: ', CAST(p_partkey AS VARCHAR), ', VALUE: ', p_name) AS line FROM part",
)
def row_to_string(spark, sf):
    return src.table(spark, sf, "part").select(
        F.format_string("KEY: %d, VALUE: %s", "p_partkey", "p_name").alias("line")
    )
