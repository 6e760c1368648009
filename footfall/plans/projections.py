"""Projections, filters and predicates."""

from pyspark.sql import functions as F

from footfall import schemas
from footfall.functions import predicates as P
from footfall.functions import web
from footfall.functions.text import parse_or_zero
from footfall.operators import sessions as S
from footfall.operators.joins import session_with_user
from footfall.operators.products import area_level
from footfall.plans import params
from footfall.plans.oracle_views import with_views
from footfall.plans.registry import query
from footfall.session import workspace
from footfall.sinks import tables as sink
from footfall.sources import tables as src


@query("project_expr", with_views("emp", "SELECT name, age + 1 AS age_next FROM emp"))
def project_expr(spark, sf):
    return src.employee(spark, sf).select("name", (F.col("age") + 1).alias("age_next"))


@query(
    "filter_where",
    with_views("emp", "SELECT name, age, depId AS dep_id FROM emp WHERE age > 30 AND gender = 'male' AND depId < 20"),
)
def filter_where(spark, sf):
    return (
        src.employee(spark, sf).where("age > 30").filter(F.col("gender") == "male")
        .where(F.col("depId") < 20).select("name", "age", F.col("depId").alias("dep_id"))
    )


@query(
    "pred_between_optional",
    with_views("ui", """
SELECT user_id, age, TRUE AS passes_open FROM ui WHERE age BETWEEN 20 AND 40"""),
)
def pred_between_optional(spark, sf):
    age = F.col("age")
    return src.user_info(spark, sf).where(P.between_optional(age, 20, 40)).select(
        "user_id", "age", P.between_optional(age, 20, None).alias("passes_open")
    )


SESSION_AGG = """
, sa AS (SELECT session_id, min(user_id) AS user_id,
  coalesce(array_to_string(list_sort(list(DISTINCT search_keyword) FILTER (search_keyword IS NOT NULL)), ','), '') AS search_keywords,
  coalesce(array_to_string(list_sort(list(DISTINCT click_category_id) FILTER (click_category_id IS NOT NULL)), ','), '') AS click_category_ids,
  min(action_time) AS start_time, max(action_time) AS end_time, count(*) AS step_length,
  epoch_us(max(action_time))//1000000 - epoch_us(min(action_time))//1000000 AS visit_length
FROM uva GROUP BY session_id)"""


@query(
    "pred_in_overlap",
    with_views("uva", SESSION_AGG + """
SELECT session_id, click_category_ids FROM sa
WHERE len(list_intersect(string_split(click_category_ids, ','), ['3','7','11'])) > 0"""),
)
def pred_in_overlap(spark, sf):
    sessions = S.session_aggregate(src.user_visit_action(spark, sf))
    return sessions.where(P.overlaps_optional(F.col("click_category_ids"), ["3", "7", "11"])).select(
        "session_id", "click_category_ids"
    )


@query(
    "pred_equal_optional",
    with_views("ui", "SELECT user_id, sex FROM ui WHERE sex = 'male'"),
)
def pred_equal_optional(spark, sf):
    return (
        src.user_info(spark, sf).where(P.equal_optional(F.col("sex"), "male"))
        .where(P.equal_optional(F.col("city"), None)).select("user_id", "sex")
    )


@query(
    "session_filter",
    with_views("uva ui", SESSION_AGG + """
SELECT session_id, user_id, age, professional, city, sex, search_keywords, click_category_ids,
  step_length, visit_length
FROM sa JOIN ui USING (user_id)
WHERE age BETWEEN 20 AND 60 AND professional IN ('BUILDING','MACHINERY','HOUSEHOLD')
  AND city IN (SELECT concat('city', CAST(i AS VARCHAR)) FROM range(0, 20) t(i)) AND sex = 'male'
  AND len(list_intersect(string_split(search_keywords, ','), ['kw1','kw2','kw3','kw4','kw5'])) > 0
  AND len(list_intersect(string_split(click_category_ids, ','),
      ['0','1','2','3','4','5','6','7','8','9','10','11'])) > 0"""),
)
def session_filter(spark, sf):
    sessions = S.session_aggregate(src.user_visit_action(spark, sf))
    full = session_with_user(sessions, src.user_info(spark, sf))
    return S.filter_sessions(full, **params.TASK).select(
        "session_id", "user_id", "age", "professional", "city", "sex", "search_keywords",
        "click_category_ids", "step_length", "visit_length",
    )


@query(
    "pred_not_blank_numeric",
    with_views("el", """
SELECT event_id, pl, u_mid FROM el
WHERE pl <> '' AND u_mid IS NOT NULL AND browser <> ''"""),
)
def pred_not_blank_numeric(spark, sf):
    return src.event_logs(spark, sf).where(P.usable_record("pl", "u_mid", "browser")).select(
        "event_id", "pl", "u_mid"
    )


@query(
    "pred_epoch_day",
    with_views("el", f"""
SELECT event_id, s_time FROM el
WHERE s_time >= epoch_us(TIMESTAMP '{params.RUN_DATE}')//1000
  AND s_time < epoch_us(TIMESTAMP '{params.RUN_DATE}' + INTERVAL 1 DAY)//1000"""),
)
def pred_epoch_day(spark, sf):
    day = src.event_logs(spark, sf, (params.RUN_DATE, params.RUN_DATE))
    return day.where(P.epoch_day(F.col("s_time"), params.RUN_DATE)).select("event_id", "s_time")


RAW_EVENT = "CASE event_type WHEN 'signup' THEN 'e_l' WHEN 'view' THEN 'e_pv' WHEN 'purchase' THEN 'e_crt' WHEN 'click' THEN 'e_click' ELSE 'e_e' END"


@query(
    "pred_event_type",
    f"""SELECT en, en IN ('e_l','e_pv','e_crt','e_cs','e_cr','e_e') AS is_known, count(*) AS n
FROM (SELECT {RAW_EVENT} AS en FROM events) GROUP BY ALL""",
)
def pred_event_type(spark, sf):
    events = src.table(spark, sf, "events").select(F.expr(RAW_EVENT).alias("en"))
    return events.groupBy("en", P.known_event(F.col("en")).alias("is_known")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "case_when_grade",
    with_views("gr", """
SELECT id, grade*2 AS score, CASE WHEN grade*2>=90 THEN 'A' WHEN grade*2>=80 THEN 'B'
  WHEN grade*2>=70 THEN 'C' WHEN grade*2>=60 THEN 'D' ELSE 'E' END AS grade_level FROM gr"""),
)
def case_when_grade(spark, sf):
    score = F.col("grade") * 2
    level = F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C").when(score >= 60, "D")
    return src.grades(spark, sf).select("id", score.alias("score"), level.otherwise("E").alias("grade_level"))


@query(
    "if_flag",
    with_views("gr", "SELECT id, CASE WHEN grade*2 >= 80 THEN 'GOOD' ELSE 'BAD' END AS grade_level FROM gr"),
)
def if_flag(spark, sf):
    return src.grades(spark, sf).selectExpr("id", "IF(grade * 2 >= 80, 'GOOD', 'BAD') AS grade_level")


@query(
    "area_level",
    with_views("ci", """
SELECT city_id, area, CASE WHEN area IN ('AFRICA','AMERICA') THEN 'A Level' WHEN area IN ('ASIA','EUROPE') THEN 'B Level'
  WHEN area = 'MIDDLE EAST' THEN 'C Level' ELSE 'D Level' END AS area_level FROM ci"""),
)
def area_levels(spark, sf):
    return src.city_info(spark, sf).select(
        "city_id", "area", area_level(F.col("area"), params.AREA_LEVELS).alias("area_level")
    )


@query(
    "member_id_valid",
    with_views("el", """
SELECT event_id, coalesce(u_mid, u_sd) AS member_id,
  regexp_full_match(coalesce(u_mid, u_sd), '[0-9a-zA-Z]{1,32}') AS is_valid FROM el"""),
)
def member_id_valid(spark, sf):
    logs = src.event_logs(spark, sf).select("event_id", F.coalesce("u_mid", "u_sd").alias("member_id"))
    return logs.withColumn("is_valid", P.valid_member_id(F.col("member_id")))


@query(
    "url_external_host",
    with_views("el", """
SELECT coalesce(host, '') AS host, count(*) AS n FROM (
  SELECT nullif(regexp_extract(p_ref, '^https?://([^/]+)', 1), 'shop.example.com') AS host FROM el) GROUP BY ALL"""),
)
def url_external_host(spark, sf):
    # every third referrer comes without its scheme
    ref = F.when(F.col("event_id") % 3 == 0, F.regexp_replace("p_ref", "^https?://", "")).otherwise(F.col("p_ref"))
    logs = src.event_logs(spark, sf).select(ref.alias("ref"))
    hosted = web.with_external_host(logs, "ref", "host", params.OWN_HOSTS)
    return hosted.groupBy(F.coalesce("host", F.lit("")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "sql_view_pipeline",
    with_views("uva ci", """
SELECT area, count(*) AS clicks, count(DISTINCT click_product_id) AS products FROM uva JOIN ci USING (city_id)
WHERE click_product_id IS NOT NULL GROUP BY area HAVING count(*) > 0"""),
)
def sql_view_pipeline(spark, sf):
    src.user_visit_action(spark, sf).createOrReplaceTempView("footfall_actions")
    src.city_info(spark, sf).createOrReplaceTempView("footfall_cities")
    spark.sql(
        "SELECT city_id, click_product_id FROM footfall_actions WHERE click_product_id IS NOT NULL"
    ).createOrReplaceTempView("footfall_clicks")
    return spark.sql("""
        WITH per_city AS (
          SELECT city_id, click_product_id, count(*) AS n FROM footfall_clicks GROUP BY city_id, click_product_id)
        SELECT area, sum(n) AS clicks, count(DISTINCT click_product_id) AS products
        FROM (SELECT p.*, c.area FROM per_city p JOIN footfall_cities c ON p.city_id = c.city_id)
        GROUP BY area""")


@query(
    "typed_schema_cast",
    with_views("emp", "SELECT name, age, depId AS dep_id, gender, CAST(round(salary*100) AS BIGINT) AS salary_cents FROM emp"),
)
def typed_schema_cast(spark, sf):
    untyped = src.employee(spark, sf).select(*[F.col(f.name).cast("string") for f in schemas.EMPLOYEE.fields])
    path = sink.write_json(untyped, workspace(spark, "untyped"))
    read = spark.read.schema(untyped.schema).json(path)
    typed = read.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.EMPLOYEE.fields])
    return typed.to(schemas.EMPLOYEE).select(
        "name", "age", F.col("depId").alias("dep_id"), "gender",
        F.round(F.col("salary") * 100).cast("bigint").alias("salary_cents"),
    )


@query(
    "parse_or_default",
    """SELECT o_orderkey, coalesce(TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority
  ELSE substr(o_orderpriority, 1, 1) END AS DOUBLE), 0) AS parsed FROM orders""",
)
def parse_or_default(spark, sf):
    text = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise(
        F.substring("o_orderpriority", 1, 1)
    )
    return src.table(spark, sf, "orders").select("o_orderkey", parse_or_zero(text).alias("parsed"))
