"""Session statistics: aggregation, length histograms, categories, extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.functions import predicates as P
from footfall.functions.numbers import int_div, ratio2
from footfall.functions.text import distinct_list
from footfall.functions.times import seconds_between
from footfall.operators.skew import checked_broadcast, top_per_group
from footfall.session import materialize

# Inclusive bounds of the histogram buckets.
VISIT_SECONDS = {
    "visit_length_1s_3s": (1, 3),
    "visit_length_4s_6s": (4, 6),
    "visit_length_7s_9s": (7, 9),
    "visit_length_10s_30s": (10, 30),
    "visit_length_30s_60s": (31, 60),
    "visit_length_1m_3m": (61, 180),
    "visit_length_3m_10m": (181, 600),
    "visit_length_10m_30m": (601, 1800),
    "visit_length_30m": (1801, None),
}
STEP_COUNTS = {
    "step_length_1_3": (1, 3),
    "step_length_4_6": (4, 6),
    "step_length_7_9": (7, 9),
    "step_length_10_30": (10, 30),
    "step_length_30_60": (31, 60),
    "step_length_60": (61, None),
}


def session_aggregate(actions: DataFrame) -> DataFrame:
    """One row per session; map-side partial aggregation, one shuffle."""
    return (
        actions.groupBy("session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            distinct_list(F.col("search_keyword")).alias("search_keywords"),
            distinct_list(F.col("click_category_id")).alias("click_category_ids"),
            F.min("action_time").alias("start_time"),
            F.max("action_time").alias("end_time"),
            F.count(F.lit(1)).alias("step_length"),
        )
        .withColumn("visit_length", seconds_between(F.col("end_time"), F.col("start_time")))
    )


def filter_sessions(sessions_with_user: DataFrame, **task) -> DataFrame:
    return sessions_with_user.where(P.session_condition(**task))


def _inside(c: Column, low: int, high: int | None) -> Column:
    return c >= low if high is None else c.between(low, high)


def bucket_ratios(sessions: DataFrame) -> DataFrame:
    """Share of sessions per visit-length and step-length bucket, one row."""
    counts = [F.count(F.lit(1)).alias("session_count")]
    for column, buckets in (("visit_length", VISIT_SECONDS), ("step_length", STEP_COUNTS)):
        for name, (low, high) in buckets.items():
            counts.append(F.count_if(_inside(F.col(column), low, high)).alias(name))
    one = sessions.agg(*counts)
    return one.select(
        "session_count",
        *[
            ratio2(F.col(n), F.col("session_count")).alias(f"{n}_ratio")
            for n in [*VISIT_SECONDS, *STEP_COUNTS]
        ],
    )


def _ids(csv: str) -> Column:
    return F.transform(F.split(F.col(csv), ","), lambda v: v.try_cast("bigint"))


def category_counts(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category from one pass over the actions."""
    def tag(kind: str, ids: Column) -> Column:
        tagged = F.transform(ids, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("id")))
        return F.coalesce(tagged, F.array().cast("array<struct<kind:string,id:bigint>>"))

    tagged = F.concat(
        tag("click", F.array("click_category_id")),
        tag("order", _ids("order_category_ids")),
        tag("pay", _ids("pay_category_ids")),
    )
    kinds = actions.select(F.explode(tagged).alias("t")).select("t.kind", "t.id")
    return (
        kinds.where(F.col("id").isNotNull())
        .groupBy(F.col("id").alias("category_id"))
        .agg(*[
            F.count_if(F.col("kind") == kind).alias(f"{kind}_count") for kind in ("click", "order", "pay")
        ])
    )


def category_counts_by_joins(actions: DataFrame) -> DataFrame:
    """Same result as ``category_counts`` with the join shape: clicks, orders and
    payments are counted apart and joined on the category, a missing count
    being 0.  The full outer join also yields the ids, so they need no pass of
    their own."""
    clicks = actions.select(F.col("click_category_id").alias("category_id"))
    orders = actions.select(F.explode(_ids("order_category_ids")).alias("category_id"))
    pays = actions.select(F.explode(_ids("pay_category_ids")).alias("category_id"))

    def counted(df: DataFrame, name: str) -> DataFrame:
        return (
            df.where(F.col("category_id").isNotNull())
            .groupBy("category_id")
            .agg(F.count(F.lit(1)).alias(name))
        )

    return (
        counted(clicks, "click_count")
        .join(counted(orders, "order_count"), "category_id", "full_outer")
        .join(counted(pays, "pay_count"), "category_id", "full_outer")
        .fillna(0, ["click_count", "order_count", "pay_count"])
    )


def top_categories(counts: DataFrame, k: int = 10) -> DataFrame:
    """Best categories by clicks, then orders, then payments."""
    return counts.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), "category_id"
    ).limit(k)


def top_sessions_per_category(actions: DataFrame, categories: DataFrame, k: int = 10) -> DataFrame:
    """Sessions with most clicks in each of the given (few) categories."""
    clicks = actions.where(F.col("click_category_id").isNotNull()).select(
        F.col("click_category_id").alias("category_id"), "session_id"
    )
    wanted = checked_broadcast(categories.select("category_id"))
    counted = (
        clicks.join(wanted, "category_id", "left_semi")
        .groupBy("category_id", "session_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )
    return top_per_group(
        counted, ["category_id"], [F.desc("click_count"), F.asc("session_id")], k
    ).withColumn("rank", F.col("rank").cast("bigint"))


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    return (
        sessions.groupBy(
            F.to_date("start_time").cast("string").alias("date"),
            F.hour("start_time").cast("bigint").alias("hour"),
        )
        .agg(F.count(F.lit(1)).alias("session_count"))
    )


def _quotas(hours: DataFrame, per_day: Column, remainders: bool) -> DataFrame:
    """date, hour, quota: the day's quota in proportion to the sessions of its hours.

    Shares are rounded down; with ``remainders`` what is left of a day goes to
    the hours with the largest fractions, one each, and the quota is used up.
    """
    day = W.partitionBy("date")
    shares = hours.withColumn("_day_n", F.sum("_hour_n").over(day)).withColumn(
        "quota", int_div(F.col("_hour_n") * per_day, F.col("_day_n"))
    )
    if remainders:
        fraction = F.col("_hour_n") * per_day - F.col("quota") * F.col("_day_n")
        place = F.row_number().over(day.orderBy(F.desc("_fraction"), "hour"))
        left = per_day - F.sum("quota").over(day)
        shares = shares.withColumn("_fraction", fraction).withColumns({"_place": place, "_left": left})
        shares = shares.withColumn("quota", F.col("quota") + F.when(F.col("_place") <= F.col("_left"), 1).otherwise(0))
    return shares.select("date", "hour", F.least("quota", "_hour_n").cast("bigint").alias("quota"))


def extract_sessions(
    sessions: DataFrame, order_key: Column | None = None, total: int = 100, remainders: bool = False
) -> DataFrame:
    """Sample of sessions in proportion to the traffic of each hour.

    ``total`` is divided by the number of days; an hour gets its share of the
    day's quota (``_quotas``).  Inside an hour the sessions with the smallest
    ``order_key`` are picked (a hash of the session id unless given), which
    makes a re-run repeat it.  The largest quota of an hour bounds what a task
    keeps of each: every map task cuts its rows to that many before the
    shuffle, and no hour is ranked as a whole.
    """
    key = F.xxhash64("session_id") if order_key is None else order_key
    keyed = sessions.withColumn("date", F.to_date("start_time").cast("string")).withColumn(
        "hour", F.hour("start_time").cast("bigint")
    )
    hours = keyed.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("_hour_n"))
    hours = materialize(hours, "session-hours")  # a row per hour
    days = hours.agg(F.count_distinct("date")).first()[0]
    quotas = _quotas(hours, F.lit(total // max(days, 1)).cast("bigint"), remainders)
    largest = quotas.agg(F.max("quota")).first()[0] or 0
    ranked = top_per_group(
        keyed.withColumn("_key", key), ["date", "hour"], [F.col("_key"), F.col("session_id")], max(largest, 1), "pick"
    )
    return (
        ranked.join(quotas, ["date", "hour"])
        .where(F.col("pick") <= F.col("quota"))
        .drop("_key", "quota")
    )
