"""Joins."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall import schemas
from footfall.functions.times import ms_day
from footfall.operators import dims as D
from footfall.operators import joins as J
from footfall.operators import orders
from footfall.operators import relational as R
from footfall.operators import sessions as S
from footfall.operators import skew
from footfall.operators.ads import parse_clicks
from footfall.plans import params
from footfall.plans.kpis import HISTORY_SQL, history
from footfall.plans.oracle_views import with_views
from footfall.plans.projections import SESSION_AGG
from footfall.plans.registry import query
from footfall.sources import files
from footfall.sources import tables as src


def ip_ranges(spark, rows=params.IP_RANGES):
    return files.literal_relation(spark, rows, schemas.IP_RANGE)


@query(
    "join_session_user",
    with_views("uva ui", SESSION_AGG + """
SELECT session_id, user_id, step_length, visit_length, age, professional, city, sex FROM sa JOIN ui USING (user_id)"""),
)
def join_session_user(spark, sf):
    sessions = S.session_aggregate(src.user_visit_action(spark, sf))
    return J.session_with_user(sessions, src.user_info(spark, sf)).select(
        "session_id", "user_id", "step_length", "visit_length", "age", "professional", "city", "sex"
    )


@query(
    "join_click_city",
    with_views("uva ci", """
SELECT event_id, city_id, city_name, area, click_product_id FROM uva JOIN ci USING (city_id)
WHERE click_product_id IS NOT NULL"""),
)
def join_click_city(spark, sf):
    clicks = src.user_visit_action(spark, sf).where(F.col("click_product_id").isNotNull())
    return J.click_with_city(clicks, src.city_info(spark, sf)).select(
        "event_id", "city_id", "city_name", "area", "click_product_id"
    )


@query(
    "join_product_info",
    with_views("uva pi", """
SELECT product_id, product_name, CASE WHEN json_extract_string(extend_info, '$.product_status') = '0'
  THEN 'Self' ELSE 'Third Party' END AS product_status, count(*) AS clicks
FROM uva JOIN pi ON click_product_id = product_id GROUP BY ALL"""),
)
def join_product_info(spark, sf):
    clicks = src.user_visit_action(spark, sf).where(F.col("click_product_id").isNotNull())
    counted = clicks.groupBy(F.col("click_product_id").alias("product_id")).agg(
        F.count(F.lit(1)).alias("clicks")
    )
    return J.with_product(counted, src.product_info(spark, sf)).select(
        "product_id", "product_name", "product_status", "clicks"
    )


CATEGORY_COUNTS = """
, kinds AS (
  SELECT 'click' AS kind, click_category_id AS id FROM uva WHERE click_category_id IS NOT NULL
  UNION ALL SELECT 'order', CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT) FROM uva WHERE order_category_ids IS NOT NULL
  UNION ALL SELECT 'pay', CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT) FROM uva WHERE pay_category_ids IS NOT NULL),
cc AS (SELECT id AS category_id, count(*) FILTER (kind='click') AS click_count,
  count(*) FILTER (kind='order') AS order_count, count(*) FILTER (kind='pay') AS pay_count FROM kinds GROUP BY id)"""


@query("left_join_defaults", with_views("uva", CATEGORY_COUNTS + "SELECT * FROM cc"))
def left_join_defaults(spark, sf):
    return S.category_counts_by_joins(src.user_visit_action(spark, sf))


_LINE_PART = """SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_brand
FROM lineitem JOIN part ON l_partkey = p_partkey"""


def _lines_and_parts(spark, sf):
    lines = src.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey")
    )
    parts = src.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return lines, parts


def _line_part(joined):
    return joined.select(
        "l_orderkey", "l_linenumber", F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand"
    )


@query("broadcast_join", _LINE_PART)
def broadcast_join(spark, sf):
    lines, parts = _lines_and_parts(spark, sf)
    return _line_part(lines.join(skew.checked_broadcast(parts), "p_partkey"))


@query("skew_split_join", _LINE_PART)
def skew_split_join(spark, sf):
    lines, parts = _lines_and_parts(spark, sf)
    return _line_part(
        skew.skew_split_join(lines, parts, "p_partkey", spread=["l_orderkey", "l_linenumber"])
    )


@query("salted_expand_join", _LINE_PART)
def salted_expand_join(spark, sf):
    lines, parts = _lines_and_parts(spark, sf)
    return _line_part(
        skew.salted_join(lines, parts, "p_partkey", 10, spread=["l_orderkey", "l_linenumber"])
    )


_BLACKLIST = "SELECT c_custkey AS user_id FROM customer WHERE c_nationkey = 7"


def blacklist(spark, sf):
    return src.table(spark, sf, "customer").where("c_nationkey = 7").select(
        F.col("c_custkey").alias("user_id")
    )


@query(
    "anti_blacklist",
    with_views("ads", f"""
SELECT event_id, date, province, city, user_id, ad_id FROM ads WHERE user_id NOT IN ({_BLACKLIST})"""),
)
def anti_blacklist(spark, sf):
    clicks = parse_clicks(src.ad_click_lines(spark, sf))
    return J.without_users(clicks, blacklist(spark, sf)).select(
        "event_id", "date", "province", "city", "user_id", "ad_id"
    )


@query(
    "anti_new_member",
    with_views("el", f"""
, hist AS ({HISTORY_SQL})
SELECT DISTINCT u_mid FROM el WHERE u_mid IS NOT NULL AND u_mid NOT IN (SELECT member_id FROM hist)"""),
)
def anti_new_member(spark, sf):
    members = src.event_logs(spark, sf).where(F.col("u_mid").isNotNull()).select("u_mid").distinct()
    return J.unseen(members, history(spark, sf), "u_mid", "member_id")


@query(
    "semi_session_detail",
    with_views("uva ui", SESSION_AGG + """
SELECT event_id, session_id, page_id FROM uva WHERE session_id IN (
  SELECT session_id FROM sa JOIN ui USING (user_id) WHERE age BETWEEN 20 AND 60 AND sex = 'male')"""),
)
def semi_session_detail(spark, sf):
    actions = src.user_visit_action(spark, sf)
    sessions = J.session_with_user(S.session_aggregate(actions), src.user_info(spark, sf))
    passing = S.filter_sessions(sessions, start_age=20, end_age=60, sex="male")
    return J.detail_of(actions, passing).select("event_id", "session_id", "page_id")


@query(
    "range_join_ip_region",
    with_views("el", """
, num AS (SELECT event_id, ip, CAST(split_part(ip,'.',1) AS BIGINT)*16777216 + CAST(split_part(ip,'.',2) AS BIGINT)*65536
  + CAST(split_part(ip,'.',3) AS BIGINT)*256 + CAST(split_part(ip,'.',4) AS BIGINT) AS n FROM el),
r(lo, hi, region) AS (VALUES (10*16777216, 10*16777216+128*65536-1, 'net-a'),
  (10*16777216+128*65536, 12*16777216-1, 'net-b'), (12*16777216, 14*16777216-1, 'net-c'),
  (8*16777216, 16*16777216-1, 'wide'), (11*16777216+5*65536+100, 11*16777216+9*65536+70000, 'inner'))
SELECT event_id, ip, coalesce(arg_min(region, hi - lo), 'unknown') AS region
FROM num LEFT JOIN r ON n BETWEEN lo AND hi GROUP BY event_id, ip"""),
)
def range_join_ip_region(spark, sf):
    logs = src.event_logs(spark, sf).select("event_id", "ip")
    overlapping = [("8.0.0.0", "15.255.255.255", "wide"), ("11.5.0.100", "11.10.17.112", "inner")]
    return J.ip_region(logs, ip_ranges(spark, [*params.IP_RANGES, *overlapping])).fillna("unknown", ["region"])


@query(
    "theta_join_inbound",
    with_views("el", """
SELECT coalesce(regexp_extract(p_ref, '^https?://([^/]+)', 1), '') AS ref_host,
  CAST(CASE WHEN p_ref LIKE '%www.search-a.example%' THEN 3 WHEN p_ref LIKE '%m.search-b.example%' THEN 4
    WHEN p_ref LIKE '%blog.other%' THEN 2 ELSE 0 END AS BIGINT) AS inbound, count(*) AS n
FROM el GROUP BY ALL"""),
)
def theta_join_inbound(spark, sf):
    patterns = files.literal_relation(spark, params.INBOUND_PATTERNS, schemas.INBOUND)
    logs = src.event_logs(spark, sf).select("event_id", "p_ref")
    host = F.coalesce(F.regexp_extract("p_ref", "^https?://([^/]+)", 1), F.lit(""))
    return (
        J.inbound_of(logs, patterns, params.OWN_HOSTS)
        .groupBy(host.alias("ref_host"), F.col("inbound").cast("bigint").alias("inbound"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


LOCATION_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("country", T.StringType()),
    T.StructField("province", T.StringType()), T.StructField("city", T.StringType()),
])
KNOWN_LOCATIONS = [(1, "unknown", "prov0", "city0"), (2, "CN", "prov1", "city1")]
_LOCATION_DIM = """
, known(id, country, province, city) AS (VALUES (1,'unknown','prov0','city0'), (2,'CN','prov1','city1')),
new_values AS (SELECT DISTINCT country, province, city FROM el
  WHERE (country, province, city) NOT IN (SELECT country, province, city FROM known)),
dim AS (SELECT CAST(id AS BIGINT) AS id, country, province, city FROM known
  UNION ALL SELECT 2 + row_number() OVER (ORDER BY country, province, city), country, province, city FROM new_values)"""


def location_dimension(spark, sf):
    known = files.literal_relation(spark, KNOWN_LOCATIONS, LOCATION_SCHEMA)
    return D.with_new_ids(known, src.event_logs(spark, sf), ["country", "province", "city"])


@query("dim_surrogate_key", with_views("el", _LOCATION_DIM + "SELECT id, country, province, city FROM dim"))
def dim_surrogate_key(spark, sf):
    return location_dimension(spark, sf)


@query(
    "dimension_id_lookup",
    with_views("oe", """
, pld AS (SELECT pl, row_number() OVER (ORDER BY pl) AS platform_id FROM (SELECT DISTINCT pl FROM oe)),
dd AS (SELECT date, row_number() OVER (ORDER BY date) AS date_id FROM (SELECT DISTINCT date FROM oe)),
cd AS (SELECT cut, row_number() OVER (ORDER BY cut) AS currency_id FROM (SELECT DISTINCT cut FROM oe)),
pd AS (SELECT pt, row_number() OVER (ORDER BY pt) AS payment_id FROM (SELECT DISTINCT pt FROM oe)),
base AS (SELECT pl, date, cut, pt, count(DISTINCT oid) AS orders FROM oe WHERE en='e_crt' GROUP BY ALL)
SELECT platform_id, date_id, currency_id, payment_id, orders FROM base JOIN pld USING (pl) JOIN dd USING (date)
  JOIN cd USING (cut) JOIN pd USING (pt)"""),
)
def dimension_id_lookup(spark, sf):
    events = src.order_events(spark, sf).withColumn("date", ms_day(F.col("s_time")))
    facts = orders.base_counts(events)
    for column, name in (("pl", "platform_id"), ("date", "date_id"), ("cut", "currency_id"), ("pt", "payment_id")):
        empty = spark.createDataFrame([], f"id bigint, {column} string")
        dimension = D.with_new_ids(empty, events, [column])
        facts = D.with_dimension_id(facts, dimension, [column], name)
    return facts


@query(
    "sql_join",
    """SELECT n_nationkey AS key, n_name AS value, r_name AS record FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def sql_join(spark, sf):
    src.table(spark, sf, "nation").createOrReplaceTempView("footfall_src")
    src.table(spark, sf, "region").createOrReplaceTempView("footfall_records")
    return spark.sql("""
        SELECT s.n_nationkey AS key, s.n_name AS value, r.r_name AS record
        FROM footfall_src s JOIN footfall_records r ON s.n_regionkey = r.r_regionkey""")


@query(
    "join_with_pairs",
    with_views("emp dept", """
SELECT emp.name AS employee, emp.age AS age, dept.id AS department_id, dept.name AS department
FROM emp JOIN dept ON depId = id"""),
)
def join_with_pairs(spark, sf):
    pairs = R.both_sides(
        src.employee(spark, sf), src.department(spark, sf), F.col("_1.depId") == F.col("_2.id")
    )
    return pairs.select(
        F.col("_1.name").alias("employee"), F.col("_1.age").alias("age"),
        F.col("_2.id").alias("department_id"), F.col("_2.name").alias("department"),
    )


@query(
    "event_dimension_lookup",
    with_views("el", """
, dim AS (SELECT ca, ac, row_number() OVER (ORDER BY ca NULLS FIRST, ac NULLS FIRST) AS event_id
  FROM (SELECT DISTINCT ca, ac FROM el))
SELECT dt AS date, dim.event_id, count(*) AS times FROM el JOIN dim
  ON el.ca IS NOT DISTINCT FROM dim.ca AND el.ac IS NOT DISTINCT FROM dim.ac GROUP BY ALL"""),
)
def event_dimension_lookup(spark, sf):
    """Events by the id of their category and action; rows without either have an id too."""
    logs = src.event_logs(spark, sf).select(F.col("dt").alias("date"), "ca", "ac")
    counted = logs.groupBy("date", "ca", "ac").agg(F.count(F.lit(1)).alias("times"))
    empty = spark.createDataFrame([], "id bigint, ca string, ac string")
    dimension = D.with_new_ids(empty, counted, ["ca", "ac"])
    again = D.with_new_ids(dimension, counted, ["ca", "ac"])  # a second run adds no id
    return D.with_dimension_id(counted, again, ["ca", "ac"], "event_id")
