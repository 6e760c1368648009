"""Session, product and general aggregations."""

from pyspark.sql import functions as F

from footfall.functions.numbers import cents
from footfall.functions.text import distinct_list
from footfall.operators import funnel, products, relational, skew
from footfall.operators import sessions as S
from footfall.plans import params
from footfall.plans.joins import CATEGORY_COUNTS
from footfall.plans.oracle_views import ratio2, with_views
from footfall.plans.projections import SESSION_AGG
from footfall.plans.registry import query
from footfall.sources import tables as src


@query(
    "session_aggregate",
    with_views("uva", SESSION_AGG + """
SELECT session_id, user_id, search_keywords, click_category_ids, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
  step_length, visit_length FROM sa"""),
)
def session_aggregate(spark, sf):
    return S.session_aggregate(src.user_visit_action(spark, sf)).select(
        "session_id", "user_id", "search_keywords", "click_category_ids",
        F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("start_time"), "step_length", "visit_length",
    )


def _bucket_sql() -> str:
    parts = []
    for column, buckets in (("visit_length", S.VISIT_SECONDS), ("step_length", S.STEP_COUNTS)):
        for name, (low, high) in buckets.items():
            cond = f"{column} >= {low}" + (f" AND {column} <= {high}" if high else "")
            parts.append(ratio2(f"count(*) FILTER ({cond})", "count(*)") + f" AS {name}_ratio")
    return with_views("uva", SESSION_AGG + f"SELECT count(*) AS session_count, {', '.join(parts)} FROM sa")


@query("session_bucket_ratios", _bucket_sql())
def session_bucket_ratios(spark, sf):
    return S.bucket_ratios(S.session_aggregate(src.user_visit_action(spark, sf)))


@query("category_click_order_pay", with_views("uva", CATEGORY_COUNTS + "SELECT * FROM cc"))
def category_click_order_pay(spark, sf):
    return S.category_counts(src.user_visit_action(spark, sf))


@query(
    "sessions_per_day_hour",
    with_views("uva", SESSION_AGG + """
SELECT strftime(start_time, '%Y-%m-%d') AS date, hour(start_time) AS hour, count(*) AS session_count FROM sa GROUP BY ALL"""),
)
def sessions_per_day_hour(spark, sf):
    return S.sessions_per_hour(S.session_aggregate(src.user_visit_action(spark, sf)))


TRANSITIONS = """
, tr AS (SELECT session_id, event_id, lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS prev_page,
  page_id FROM uva)"""
_SPLITS = TRANSITIONS + """
, sp AS (SELECT concat(CAST(prev_page AS VARCHAR), '_', CAST(page_id AS VARCHAR)) AS page_split, count(*) AS pv FROM tr
  WHERE (prev_page, page_id) IN ((1,2),(2,3),(3,4)) GROUP BY ALL)"""


@query("page_split_pv", with_views("uva", _SPLITS + "SELECT page_split, pv FROM sp"))
def page_split_pv(spark, sf):
    return funnel.page_splits(src.user_visit_action(spark, sf), params.PAGE_FLOW)


@query("start_page_pv", with_views("uva", "SELECT count(*) AS start_pv FROM uva WHERE page_id = 1"))
def start_page_pv(spark, sf):
    return funnel.start_page_views(src.user_visit_action(spark, sf), params.PAGE_FLOW)


@query(
    "page_convert_rate",
    with_views("uva", _SPLITS + f"""
, flow(step, page_split) AS (VALUES (1,'1_2'),(2,'2_3'),(3,'3_4')),
v AS (SELECT 0 AS step, 'start' AS page_split, count(*) AS pv FROM uva WHERE page_id = 1
  UNION ALL SELECT step, page_split, coalesce(pv, 0) FROM flow LEFT JOIN sp USING (page_split))
SELECT CAST(step AS BIGINT) AS step, page_split, pv, {ratio2('pv', 'prev')} AS rate FROM (
  SELECT *, nullif(lag(pv) OVER (ORDER BY step), 0) AS prev FROM v) WHERE step > 0"""),
)
def page_convert_rate(spark, sf):
    return funnel.conversion_rates(src.user_visit_action(spark, sf), params.PAGE_FLOW)


AREA_PRODUCTS = """
, apc AS (SELECT area, click_product_id AS product_id, count(*) AS click_count,
  string_agg(DISTINCT concat(CAST(city_id AS VARCHAR), ':', city_name), ',' ORDER BY concat(CAST(city_id AS VARCHAR), ':', city_name)) AS city_infos
  FROM uva JOIN ci USING (city_id) WHERE click_product_id IS NOT NULL GROUP BY ALL)"""


@query("area_product_clicks", with_views("uva ci", AREA_PRODUCTS + "SELECT * FROM apc"))
def area_product_clicks(spark, sf):
    return products.area_product_clicks(src.user_visit_action(spark, sf), src.city_info(spark, sf))


@query("two_phase_salted_agg", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL")
def two_phase_salted_agg(spark, sf):
    rows = src.table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    return skew.two_phase_count(rows, ["l_suppkey"])


@query(
    "dept_salary_age_avg",
    with_views("emp dept", """
SELECT dept.name AS department, gender, sum(CAST(round(salary*100) AS BIGINT)) / count(*) / 100 AS avg_salary,
  sum(age) / count(*) AS avg_age
FROM emp JOIN dept ON depId = id WHERE age > 20 GROUP BY ALL"""),
)
def dept_salary_age_avg(spark, sf):
    return relational.average_by_department(src.employee(spark, sf), src.department(spark, sf))


@query(
    "basic_aggregates",
    with_views("emp", """
SELECT depId AS dep_id, sum(c) / count(*) AS avg_cents, CAST(sum(c) AS BIGINT) AS sum_cents, max(c) AS max_cents,
  min(c) AS min_cents, count(name) AS n, count(DISTINCT age) AS ages
FROM (SELECT *, CAST(round(salary*100) AS BIGINT) AS c FROM emp) GROUP BY ALL"""),
)
def basic_aggregates(spark, sf):
    c = cents(F.col("salary"))
    return src.employee(spark, sf).groupBy(F.col("depId").alias("dep_id")).agg(
        F.avg(c).alias("avg_cents"), F.sum(c).alias("sum_cents"), F.max(c).alias("max_cents"),
        F.min(c).alias("min_cents"), F.count("name").alias("n"), F.count_distinct("age").alias("ages"),
    )


@query(
    "collect_set_list",
    with_views("emp", """
, n AS (SELECT *, (row_number() OVER (PARTITION BY depId ORDER BY name) - 1) // 50 AS chunk FROM emp),
a AS (SELECT depId, array_to_string(list_sort(list(DISTINCT age)), ',') AS ages FROM emp GROUP BY ALL)
SELECT depId AS dep_id, chunk, ages, array_to_string(list_sort(list(name)), ',') AS names
FROM n JOIN a USING (depId) GROUP BY ALL"""),
)
def collect_set_list(spark, sf):
    employees = src.employee(spark, sf)
    ages = employees.groupBy("depId").agg(distinct_list(F.col("age")).alias("ages"))
    names = skew.chunked_lists(employees, "depId", "name", ["name"], 50)
    return names.join(ages, "depId").select(
        F.col("depId").alias("dep_id"), "chunk", "ages", F.array_join("values", ",").alias("names")
    )


@query("group_count", with_views("emp", "SELECT age, count(*) AS n FROM emp GROUP BY age"))
def group_count(spark, sf):
    return src.employee(spark, sf).groupBy("age").agg(F.count(F.lit(1)).alias("n"))


@query("reduce_count", "SELECT count(*) AS n FROM lineitem")
def reduce_count(spark, sf):
    return src.table(spark, sf, "lineitem").agg(F.sum(F.lit(1)).alias("n"))


@query(
    "word_count",
    """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
WHERE word <> '' GROUP BY ALL""",
)
def word_count(spark, sf):
    counted = relational.word_count(src.table(spark, sf, "documents"), "text")
    return counted.orderBy(F.desc("n"), "word")


@query(
    "word_count_order",
    """SELECT word, n, lag(word) OVER (ORDER BY n DESC, word) AS previous FROM (SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> '' GROUP BY ALL)""",
)
def word_count_order(spark, sf):
    return skew.with_row_before(word_count(spark, sf), "word", "previous")


@query(
    "percent_of_total",
    """WITH g AS (SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
  FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_linestatus, quantity, CAST((quantity*200 + t) // (t*2) AS BIGINT) AS percent
FROM g, (SELECT sum(quantity) AS t FROM g)""",
)
def percent_of_total(spark, sf):
    rows = src.table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", F.col("l_quantity").cast("bigint").alias("quantity")
    )
    return relational.percent_of_total(rows, ["l_returnflag", "l_linestatus"], "quantity")
