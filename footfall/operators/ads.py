"""Ad clicks: parsing, daily counts, blacklist, rankings and trend.

Used by the batch queries and, frame by frame, by the streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.times import ms_day
from footfall.functions.web import computed_once
from footfall.operators.skew import top_per_group

BLACKLIST_THRESHOLD = 100


def parse_clicks(lines: DataFrame, line: str = "value") -> DataFrame:
    """``millis province city user ad`` as typed columns; other lines are dropped."""
    fields = computed_once(lines, "_f", F.split(F.col(line), " "))
    parsed = fields.where(F.size("_f") == 5).select(
        *[c for c in lines.columns if c != line],
        F.get("_f", 0).try_cast("bigint").alias("click_ms"),
        F.get("_f", 1).alias("province"),
        F.get("_f", 2).alias("city"),
        F.get("_f", 3).try_cast("bigint").alias("user_id"),
        F.get("_f", 4).try_cast("bigint").alias("ad_id"),
    )
    usable = F.col("click_ms").isNotNull() & F.col("user_id").isNotNull() & F.col("ad_id").isNotNull()
    return parsed.where(usable).withColumn("date", ms_day(F.col("click_ms")))


def user_ad_counts(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("date", "user_id", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def over_threshold(counts: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users who clicked one ad at least ``threshold`` times on a day."""
    return counts.where(F.col("click_count") >= threshold).select("user_id").distinct()


def ad_stat(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("date", "province", "city", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def province_top_ads(stat: DataFrame, k: int = 3) -> DataFrame:
    """Best ads per (date, province) from counts of finer or equal grain."""
    per_province = stat.groupBy("date", "province", "ad_id").agg(F.sum("click_count").alias("click_count"))
    return top_per_group(
        per_province, ["date", "province"], [F.desc("click_count"), F.asc("ad_id")], k
    ).withColumn("rank", F.col("rank").cast("bigint"))


def ban_points(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """First click with which a user reaches the threshold on some (day, ad).

    Only the first ``threshold`` clicks of a key matter, so the ranking limit
    keeps the shuffle to that many rows per key and map task.
    """
    reached = top_per_group(
        clicks.select("date", "user_id", "ad_id", "click_ms", "event_id"),
        ["date", "user_id", "ad_id"],
        [F.col("click_ms"), F.col("event_id")],
        threshold,
        "nth",
    ).where(F.col("nth") == threshold)
    return reached.groupBy("user_id").agg(F.min(F.struct("click_ms", "event_id")).alias("_ban")).select(
        "user_id", F.col("_ban.click_ms").alias("ban_ms"), F.col("_ban.event_id").alias("ban_event")
    )


def clicks_before_ban(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Clicks up to and including the one that bans its user."""
    later = (F.col("click_ms") > F.col("ban_ms")) | (
        (F.col("click_ms") == F.col("ban_ms")) & (F.col("event_id") > F.col("ban_event"))
    )
    return (
        clicks.join(ban_points(clicks, threshold), "user_id", "left")
        .where(F.col("ban_ms").isNull() | ~later)
        .drop("ban_ms", "ban_event")
    )
