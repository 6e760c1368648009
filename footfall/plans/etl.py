"""Access-log ETL."""

from pyspark.sql import functions as F

from footfall.operators import etl
from footfall.plans.joins import ip_ranges
from footfall.plans.oracle_views import with_views
from footfall.plans.registry import query
from footfall.session import workspace
from footfall.sources import files, loglines
from footfall.sources import tables as src

# Which of the lines are broken, and how (see ``sources.loglines.mixed_lines``).
_REJECT = """, tagged AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN 'field_count' WHEN event_id % 89 = 0 THEN 'no_query'
  WHEN event_id % 83 = 0 THEN 'unknown_event' WHEN event_id % 79 = 0 THEN 'server_time' END AS reject FROM el)"""


def _lines(spark, sf, purpose):
    path = workspace(spark, purpose)
    loglines.mixed_lines(src.event_logs(spark, sf)).select("value").write.text(path)
    return files.text_lines(spark, path)


@query(
    "access_log_parse",
    with_views("el", _REJECT + """
SELECT s_time, ip, en, pl, u_ud, coalesce(u_mid, '') AS u_mid, u_sd, p_url, coalesce(p_ref, '') AS p_ref,
  coalesce(ca, '') AS ca, CAST(k % 10 AS VARCHAR) AS kv_page,
  CAST(1 AS BIGINT) AS extra_params
FROM (SELECT * REPLACE (CASE WHEN pl = '' THEN '-' ELSE pl END AS pl) FROM tagged) WHERE reject IS NULL"""),
)
def access_log_parse(spark, sf):
    events = etl.accepted(etl.parse_lines(_lines(spark, sf, "access-log")))
    return events.select(
        "s_time", "ip", "en", F.coalesce("pl", F.lit("-")).alias("pl"), "u_ud",
        F.coalesce("u_mid", F.lit("")).alias("u_mid"), "u_sd", "p_url",
        F.coalesce("p_ref", F.lit("")).alias("p_ref"), F.coalesce("ca", F.lit("")).alias("ca"),
        F.col("extra")["kv_page"].alias("kv_page"), F.size("extra").cast("bigint").alias("extra_params"),
    )


@query(
    "access_log_rejects",
    with_views("el", _REJECT + "SELECT reject, count(*) AS n FROM tagged WHERE reject IS NOT NULL GROUP BY ALL"),
)
def access_log_rejects(spark, sf):
    bad = etl.rejected(etl.parse_lines(_lines(spark, sf, "access-log")))
    return bad.groupBy("reject").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ua_enrich",
    with_views("el", """
, ua(i, browser, browser_v, os, os_v) AS (VALUES (0,'Chrome','119.0','Windows','10.0'), (1,'Firefox','115.0','Linux','Linux'),
  (2,'IE','8.0','Windows','6.1'), (3,'Safari','16.6','macOS','10_15'), (4,'Edge','118.0','Windows','10.0'),
  (5,'unknown','unknown','unknown','unknown'))
SELECT event_id, ua.browser, ua.browser_v, os, os_v FROM el JOIN ua ON i = k % 6"""),
)
def ua_enrich(spark, sf):
    logs = src.event_logs(spark, sf).select(
        "event_id", loglines.user_agent_of(F.col("k")).alias(etl.USER_AGENT)
    )
    return etl.with_user_agent(logs)


# Regions of the addresses (10.u.k.e .. 14.u.k.e) and what they resolve to.
REGIONS = [
    ("10.0.0.0", "10.63.255.255", "广东省广州市天河区"),
    ("10.64.0.0", "10.127.255.255", "湖南省"),
    ("10.128.0.0", "10.255.255.255", "上海市浦东新区"),
    ("11.0.0.0", "11.31.255.255", "内蒙古呼和浩特市"),
    ("11.32.0.0", "11.255.255.255", "广西南宁市"),
    ("12.0.0.0", "12.31.255.255", "重庆市开县"),
    ("12.32.0.0", "12.127.255.255", "香港"),
    ("12.128.0.0", "12.255.255.255", "局域网"),
    ("13.0.0.0", "13.255.255.255", "美国"),
]


@query(
    "geo_enrich",
    with_views("el", """
, num AS (SELECT event_id, CAST(split_part(ip,'.',1) AS BIGINT)*256 + CAST(split_part(ip,'.',2) AS BIGINT) AS n FROM el),
r(lo, hi, country, province, city) AS (VALUES (2560, 2623, '中国', '广东省', '广州市'), (2624, 2687, '中国', '湖南省', 'unknown'),
  (2688, 2815, '中国', '上海市', '浦东新区'), (2816, 2847, '中国', '内蒙古自治区', '呼和浩特市'), (2848, 3071, '中国', '广西', '南宁市'),
  (3072, 3103, '中国', '重庆市', '开县'), (3104, 3199, '中国', '香港特别行政区', 'unknown'), (3200, 3327, '中国', '上海市', 'unknown'),
  (3328, 3583, 'unknown', 'unknown', 'unknown'))
SELECT event_id, coalesce(country, 'unknown') AS country, coalesce(province, 'unknown') AS province,
  coalesce(city, 'unknown') AS city FROM num LEFT JOIN r ON n BETWEEN lo AND hi"""),
)
def geo_enrich(spark, sf):
    logs = src.event_logs(spark, sf).select("event_id", "ip")
    return etl.with_location(logs, ip_ranges(spark, REGIONS)).select("event_id", "country", "province", "city")


@query(
    "etl_counters",
    with_views("el", _REJECT + """
SELECT count(*) AS input_records, count(*) FILTER (reject IS NULL) AS output_records,
  count(*) FILTER (reject IS NOT NULL) AS filtered_records,
  count(*) FILTER (reject = 'field_count') AS filtered_field_count, count(*) FILTER (reject = 'no_query') AS filtered_no_query,
  count(*) FILTER (reject = 'unknown_event') AS filtered_unknown_event,
  count(*) FILTER (reject = 'server_time') AS filtered_server_time FROM tagged"""),
)
def etl_counters(spark, sf):
    return etl.store_counted(etl.parse_lines(_lines(spark, sf, "access-log")), workspace(spark, "records"))
