"""Adapters: the given parquet tables reshaped into the job inputs.

All are projections of one scan, so filters and column choices made on top of
them still reach the parquet reader.  Times stay ``TIMESTAMP_NTZ``; epoch
values need the UTC session zone of ``session.SETTINGS``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.times import epoch_ms
from footfall.sources.files import time_range

OWN_HOST = "shop.example.com"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


Days = tuple[str, str]


def _events(spark: SparkSession, sf_dir: str, days: Days | None = None) -> DataFrame:
    events = table(spark, sf_dir, "events")
    if days is not None:
        events = time_range(events, *days, "ts")
    # a plain column: queries that do not use it do not read ``props``
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def user_visit_action(spark: SparkSession, sf_dir: str, days: Days | None = None) -> DataFrame:
    """Actions, optionally of the days ``first..last``; that range reaches the scan."""
    return _events(spark, sf_dir, days).selectExpr(
        "CAST(ts AS DATE) AS date",
        "user_id",
        "concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS session_id",
        "k % 10 AS page_id",
        "ts AS action_time",
        "event_id",
        "CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 10 AS STRING)) END AS search_keyword",
        "CASE WHEN event_type = 'click' THEN k % 20 END AS click_category_id",
        "CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id",
        "CASE WHEN event_type = 'signup' THEN "
        "concat(CAST(k % 20 AS STRING), ',', CAST((k + 7) % 20 AS STRING)) END AS order_category_ids",
        "CASE WHEN event_type = 'purchase' THEN CAST(k % 20 AS STRING) END AS pay_category_ids",
        "user_id % 25 AS city_id",
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id",
        "c_name AS name",
        "CAST(18 + c_custkey % 50 AS INT) AS age",
        "c_mktsegment AS professional",
        "concat('city', CAST(c_nationkey AS STRING)) AS city",
        "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        "concat('{\"product_status\":', CAST(p_partkey % 2 AS STRING), '}') AS extend_info",
    )


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "CAST(n_nationkey AS BIGINT) AS city_id", "n_name AS city_name", "r_name AS area"
    )


def ad_click_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        "event_id",
        F.concat_ws(
            " ",
            epoch_ms("ts").cast("string"),
            F.expr("concat('P', CAST(user_id % 5 AS STRING))"),
            F.expr("concat('C', CAST(user_id % 25 AS STRING))"),
            F.col("user_id").cast("string"),
            F.expr("CAST(k % 10 AS STRING)"),
        ).alias("value"),
    )


def event_logs(spark: SparkSession, sf_dir: str, days: Days | None = None) -> DataFrame:
    """Log records, optionally of the days ``first..last``; that range reaches the scan."""
    return _events(spark, sf_dir, days).withColumn("s_time", epoch_ms("ts")).selectExpr(
        "event_id",
        "s_time",
        "CAST(CAST(ts AS DATE) AS STRING) AS dt",
        "CASE event_type WHEN 'signup' THEN 'e_l' WHEN 'error' THEN 'e_e' ELSE 'e_pv' END AS en",
        "CASE WHEN event_id % 50 = 0 THEN '' WHEN user_id % 3 = 0 THEN 'java_server' "
        "ELSE 'website' END AS pl",
        "concat('u', CAST(user_id AS STRING)) AS u_ud",
        "CASE WHEN user_id % 2 = 0 THEN concat('m', CAST(user_id AS STRING)) END AS u_mid",
        "concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS u_sd",
        "CASE k % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'IE' WHEN 2 THEN 'Firefox' ELSE '' END AS browser",
        "concat('v', CAST(k % 3 AS STRING)) AS browser_v",
        f"concat('http://{OWN_HOST}/p/', CAST(k % 10 AS STRING)) AS p_url",
        "CASE k % 5 WHEN 0 THEN 'https://www.search-a.example/q?x=1' "
        "WHEN 1 THEN 'http://m.search-b.example/' WHEN 2 THEN 'http://blog.other.example/' "
        f"WHEN 3 THEN 'http://{OWN_HOST}/p/1' END AS p_ref",
        "CASE WHEN user_id % 5 = 0 THEN 'unknown' ELSE 'CN' END AS country",
        "concat('prov', CAST(user_id % 5 AS STRING)) AS province",
        "concat('city', CAST(user_id % 25 AS STRING)) AS city",
        "concat(CAST(10 + k % 5 AS STRING), '.', CAST(user_id % 256 AS STRING), '.', "
        "CAST(k AS STRING), '.', CAST(event_id % 256 AS STRING)) AS ip",
        "CASE WHEN event_type = 'error' THEN concat('cat', CAST(k % 3 AS STRING)) END AS ca",
        "CASE WHEN event_type = 'error' THEN concat('act', CAST(k % 4 AS STRING)) END AS ac",
        "k",
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creation, payment and refund records, made from one scan of ``orders``.

    Every seventh order has a second creation record, a minute later and with
    another amount and payment type.
    """
    record = "named_struct('en', '{}', 'after', {}L, 'again', {})"
    create, again = record.format("e_crt", 0, "false"), record.format("e_crt", 60000, "true")
    pay, refund = record.format("e_cs", 3600000, "false"), record.format("e_cr", 7200000, "false")
    kinds = F.expr(
        f"concat(array({create}), IF(o_orderkey % 7 = 0, array({again}), array()), "
        f"CASE WHEN o_orderstatus = 'P' THEN array({pay}, {refund}) "
        f"WHEN o_orderstatus = 'F' THEN array({pay}) ELSE array() END)"
    )
    return (
        table(spark, sf_dir, "orders")
        .withColumn("oms", epoch_ms("o_orderdate"))
        .withColumn("r", F.explode(kinds))
        .selectExpr(
            "CAST(o_orderkey AS STRING) AS oid",
            "r.en AS en",
            "oms + r.after AS s_time",
            "CASE WHEN o_custkey % 3 = 0 THEN 'java_server' ELSE 'website' END AS pl",
            "CASE WHEN o_orderkey % 4 = 0 THEN 'USD' ELSE 'RMB' END AS cut",
            "CASE WHEN r.again THEN 'card' ELSE CASE o_orderkey % 3 WHEN 0 THEN 'alipay' WHEN 1 THEN 'weixin' "
            "ELSE 'card' END END AS pt",
            "CAST(floor(o_totalprice) AS BIGINT) + IF(r.again, 1, 0) AS cua",
        )
    )


def employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_name AS name",
        "18 + c_custkey % 50 AS age",
        "CAST(c_nationkey AS BIGINT) AS depId",
        "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender",
        "c_acctbal AS salary",
    )


def department(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS id", "n_name AS name"
    )


def grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "p_brand AS class", "CAST(p_size AS BIGINT) AS grade"
    )
