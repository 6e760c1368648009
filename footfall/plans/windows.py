"""Ordered analytics."""

from pyspark.sql import functions as F

from footfall.operators.joins import detail_of
from footfall.operators import ads, funnel, products, skew
from footfall.operators import sessions as S
from footfall.plans import params
from footfall.plans.aggregates import AREA_PRODUCTS, TRANSITIONS
from footfall.plans.joins import CATEGORY_COUNTS
from footfall.plans.oracle_views import with_views
from footfall.plans.projections import SESSION_AGG
from footfall.plans.registry import query
from footfall.sources import tables as src


@query(
    "area_top3_products",
    with_views("uva ci pi", AREA_PRODUCTS + """
, ranked AS (SELECT apc.*, product_name, CASE WHEN json_extract_string(extend_info, '$.product_status') = '0'
    THEN 'Self' ELSE 'Third Party' END AS product_status,
  row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS rank
  FROM apc JOIN pi USING (product_id))
SELECT area, CASE WHEN area IN ('AFRICA','AMERICA') THEN 'A Level' WHEN area IN ('ASIA','EUROPE') THEN 'B Level'
  WHEN area = 'MIDDLE EAST' THEN 'C Level' ELSE 'D Level' END AS area_level,
  product_id, click_count, city_infos, product_name, product_status, rank FROM ranked WHERE rank <= 3"""),
)
def area_top3_products(spark, sf):
    return products.top_products_by_area(
        src.user_visit_action(spark, sf),
        src.city_info(spark, sf),
        src.product_info(spark, sf),
        levels=params.AREA_LEVELS,
    )


@query(
    "grade_rank",
    with_views("gr", """
SELECT id, class, grade, row_number() OVER (PARTITION BY class ORDER BY grade DESC, id) AS rank FROM gr"""),
)
def grade_rank(spark, sf):
    return skew.numbered(src.grades(spark, sf), [F.desc("grade"), F.asc("id")], "rank", keys=["class"])


@query(
    "province_top3_ads",
    with_views("ads", """
SELECT * FROM (SELECT date, province, ad_id, count(*) AS click_count,
  row_number() OVER (PARTITION BY date, province ORDER BY count(*) DESC, ad_id) AS rank
  FROM ads GROUP BY date, province, ad_id) WHERE rank <= 3"""),
)
def province_top3_ads(spark, sf):
    clicks = ads.parse_clicks(src.ad_click_lines(spark, sf))
    return ads.province_top_ads(ads.ad_stat(clicks))


@query(
    "page_transitions",
    with_views("uva", TRANSITIONS + """
SELECT session_id, event_id, prev_page, page_id FROM tr WHERE prev_page IS NOT NULL"""),
)
def page_transitions(spark, sf):
    return funnel.transitions(src.user_visit_action(spark, sf)).select(
        "session_id", "event_id", "prev_page", "page_id"
    )


_TOP10 = CATEGORY_COUNTS + """
, top AS (SELECT * FROM cc ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10)"""


@query("top10_categories", with_views("uva", _TOP10 + "SELECT * FROM top"))
def top10_categories(spark, sf):
    return S.top_categories(S.category_counts(src.user_visit_action(spark, sf)))


@query(
    "top10_sessions_per_category",
    with_views("uva", _TOP10 + """
SELECT * FROM (SELECT click_category_id AS category_id, session_id, count(*) AS click_count,
  row_number() OVER (PARTITION BY click_category_id ORDER BY count(*) DESC, session_id) AS rank
  FROM uva WHERE click_category_id IN (SELECT category_id FROM top)
  GROUP BY click_category_id, session_id) WHERE rank <= 10"""),
)
def top10_sessions_per_category(spark, sf):
    actions = src.user_visit_action(spark, sf)
    best = S.top_categories(S.category_counts(actions))
    return S.top_sessions_per_category(actions, best)


@query(
    "stratified_session_extract",
    with_views("uva", SESSION_AGG + f"""
, k AS (SELECT *, strftime(start_time, '%Y-%m-%d') AS date, hour(start_time) AS hour FROM sa),
h AS (SELECT date, hour, count(*) AS hn FROM k GROUP BY ALL),
q AS (SELECT date, hour, least(hn, (hn * ({params.SAMPLE_TOTAL} // (SELECT count(DISTINCT date) FROM h))) //
  CAST(sum(hn) OVER (PARTITION BY date) AS BIGINT)) AS quota FROM h),
p AS (SELECT *, row_number() OVER (PARTITION BY date, hour ORDER BY (user_id * 7919) % 10007, session_id) AS pick FROM k)
SELECT session_id, user_id, p.date, p.hour, pick, search_keywords, click_category_ids
FROM p JOIN q ON p.date = q.date AND p.hour = q.hour WHERE pick <= quota"""),
)
def stratified_session_extract(spark, sf):
    sessions = S.session_aggregate(src.user_visit_action(spark, sf))
    order_key = F.col("user_id") * 7919 % 10007
    return S.extract_sessions(sessions, order_key, params.SAMPLE_TOTAL).select(
        "session_id", "user_id", "date", "hour", F.col("pick").cast("bigint").alias("pick"),
        "search_keywords", "click_category_ids",
    )


_DETAIL = "SELECT event_id, session_id, page_id, click_category_id FROM uva WHERE session_id IN (SELECT session_id FROM {})"


@query(
    "top10_session_detail",
    with_views("uva", _TOP10 + """
, best AS (SELECT session_id FROM (SELECT session_id, row_number() OVER (PARTITION BY click_category_id
    ORDER BY count(*) DESC, session_id) AS rank FROM uva WHERE click_category_id IN (SELECT category_id FROM top)
  GROUP BY click_category_id, session_id) WHERE rank <= 10)
""" + _DETAIL.format("best")),
)
def top10_session_detail(spark, sf):
    actions = src.user_visit_action(spark, sf)
    best = S.top_sessions_per_category(actions, S.top_categories(S.category_counts(actions)))
    return detail_of(actions, best.select("session_id").distinct()).select(
        "event_id", "session_id", "page_id", "click_category_id"
    )


@query(
    "stratified_session_detail",
    with_views("uva", SESSION_AGG + f"""
, k AS (SELECT *, strftime(start_time, '%Y-%m-%d') AS date, hour(start_time) AS hour FROM sa),
h AS (SELECT date, hour, count(*) AS hn FROM k GROUP BY ALL),
q AS (SELECT date, hour, least(hn, (hn * ({params.SAMPLE_TOTAL} // (SELECT count(DISTINCT date) FROM h))) //
  CAST(sum(hn) OVER (PARTITION BY date) AS BIGINT)) AS quota FROM h),
p AS (SELECT *, row_number() OVER (PARTITION BY date, hour ORDER BY (user_id * 7919) % 10007, session_id) AS pick FROM k),
picked AS (SELECT session_id FROM p JOIN q ON p.date = q.date AND p.hour = q.hour WHERE pick <= quota)
""" + _DETAIL.format("picked")),
)
def stratified_session_detail(spark, sf):
    actions = src.user_visit_action(spark, sf)
    picked = S.extract_sessions(S.session_aggregate(actions), F.col("user_id") * 7919 % 10007, params.SAMPLE_TOTAL)
    return detail_of(actions, picked).select("event_id", "session_id", "page_id", "click_category_id")


@query(
    "first_seen_running_blacklist",
    with_views("ads", f"""
, nth AS (SELECT *, row_number() OVER (PARTITION BY date, user_id, ad_id ORDER BY click_ms, event_id) AS n FROM ads),
ban AS (SELECT user_id, min((click_ms, event_id)) AS b FROM nth WHERE n = {params.BLACKLIST_THRESHOLD} GROUP BY user_id)
SELECT event_id, user_id, ad_id, date FROM ads LEFT JOIN ban USING (user_id)
WHERE b IS NULL OR (click_ms, event_id) <= b"""),
)
def first_seen_running_blacklist(spark, sf):
    clicks = ads.parse_clicks(src.ad_click_lines(spark, sf))
    return ads.clicks_before_ban(clicks, params.BLACKLIST_THRESHOLD).select(
        "event_id", "user_id", "ad_id", "date"
    )
