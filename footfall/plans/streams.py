"""Streams, run over click lines written from ``events``."""

from pyspark.sql import functions as F

from footfall.plans import params
from footfall.plans.joins import _BLACKLIST, blacklist
from footfall.plans.oracle_views import with_views
from footfall.plans.registry import query
from footfall.session import workspace
from footfall.sources import tables as src
from footfall.streaming import ads, words
from footfall.streaming.base import file_lines


BATCHES = 3


def _folders(spark, sf, name):
    """Click lines in a fresh folder, plus result and checkpoint folders.

    The lines come as files without an order in time, read in ``BATCHES``
    batches, so every batch holds clicks older than those of the one before.
    """
    root = workspace(spark, name)
    lines = src.ad_click_lines(spark, sf)
    lines.repartition(_files(spark), "event_id").select("value").write.text(f"{root}/in")
    return f"{root}/in", f"{root}/out", f"{root}/checkpoint"


def _files(spark):
    return max(BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _click_job(spark, sf, name, job, *args, **kwargs):
    source, out, checkpoint = _folders(spark, sf, name)
    return job(file_lines(spark, source, -(-_files(spark) // BATCHES)), *args, out, checkpoint, **kwargs)


@query(
    "stream_ad_parse",
    with_views("ads", "SELECT click_ms, province, city, user_id, ad_id, date FROM ads"),
)
def stream_ad_parse(spark, sf):
    return _click_job(spark, sf, "stream-parse", ads.parsed_clicks)


@query(
    "stream_blacklist_filter",
    with_views("ads", f"""
SELECT click_ms, province, city, user_id, ad_id, date FROM ads WHERE user_id NOT IN ({_BLACKLIST})"""),
)
def stream_blacklist_filter(spark, sf):
    return _click_job(spark, sf, "stream-filter", ads.allowed_clicks, lambda s: blacklist(s, sf))


@query(
    "stream_user_ad_daily_count",
    with_views("ads", "SELECT date, user_id, ad_id, count(*) AS click_count FROM ads GROUP BY ALL"),
)
def stream_user_ad_daily_count(spark, sf):
    return _click_job(spark, sf, "stream-user-ad", ads.user_ad_totals)


@query(
    "stream_dynamic_blacklist",
    with_views("ads", f"""
SELECT DISTINCT user_id FROM (SELECT date, user_id, ad_id FROM ads GROUP BY ALL
  HAVING count(*) >= {params.BLACKLIST_THRESHOLD})"""),
)
def stream_dynamic_blacklist(spark, sf):
    return _click_job(
        spark, sf, "stream-blacklist", ads.dynamic_blacklist, threshold=params.BLACKLIST_THRESHOLD
    )


_STAT = "SELECT date, province, city, ad_id, count(*) AS click_count FROM ads GROUP BY ALL"


@query("stream_ad_state_count", with_views("ads", _STAT))
def stream_ad_state_count(spark, sf):
    return _click_job(spark, sf, "stream-sums", ads.ad_totals)


@query("stream_ad_keyed_state", with_views("ads", _STAT))
def stream_ad_keyed_state(spark, sf):
    """Counts as keyed state; three batches out of order, the query restarted between them."""
    root = workspace(spark, "stream-state")
    lines = src.ad_click_lines(spark, sf)
    part, result = F.pmod(F.xxhash64("event_id"), F.lit(BATCHES)), None
    for i in range(BATCHES):
        lines.where(part == i).select("value").write.mode("append").text(f"{root}/in")
        result = ads.ad_state_totals(file_lines(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint")
    return result


@query(
    "stream_province_top3",
    with_views("ads", """
SELECT * FROM (SELECT date, province, ad_id, count(*) AS click_count,
  row_number() OVER (PARTITION BY date, province ORDER BY count(*) DESC, ad_id) AS rank
  FROM ads GROUP BY date, province, ad_id) WHERE rank <= 3"""),
)
def stream_province_top3(spark, sf):
    return _click_job(spark, sf, "stream-top3", ads.province_top3)


@query(
    "stream_ad_click_trend",
    with_views("ads", """
SELECT date, strftime(make_timestamp(click_ms*1000), '%H') AS hour, strftime(make_timestamp(click_ms*1000), '%M') AS minute,
  ad_id, count(*) AS click_count FROM ads GROUP BY ALL"""),
)
def stream_ad_click_trend(spark, sf):
    return _click_job(spark, sf, "stream-trend", ads.click_trend)


@query(
    "stream_sliding_window",
    with_views("ads", """
, w AS (SELECT ad_id, (click_ms//600000 - i) * 600000 AS start_ms FROM ads, range(0, 6) t(i))
SELECT strftime(make_timestamp(start_ms*1000), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(make_timestamp((start_ms + 3600000)*1000), '%Y-%m-%d %H:%M:%S') AS window_end, ad_id, count(*) AS click_count
FROM w GROUP BY ALL"""),
)
def stream_sliding_window(spark, sf):
    return _click_job(spark, sf, "stream-sliding", ads.sliding_counts, slide_ms=600_000)


@query(
    "stream_sliding_changes",
    with_views("ads", """
, w AS (SELECT ad_id, (click_ms//10000 - i) * 10000 AS start_ms FROM ads, range(0, 360) t(i)),
n AS (SELECT ad_id, start_ms, count(*) AS click_count FROM w GROUP BY ALL),
edges AS (SELECT *, lag(start_ms) OVER o IS DISTINCT FROM start_ms - 10000 OR lag(click_count) OVER o <> click_count AS new
  FROM n WINDOW o AS (PARTITION BY ad_id ORDER BY start_ms)),
runs AS (SELECT *, sum(new::INT) OVER (PARTITION BY ad_id ORDER BY start_ms) AS run FROM edges)
SELECT strftime(make_timestamp(min(start_ms)*1000), '%Y-%m-%d %H:%M:%S') AS first_start,
  strftime(make_timestamp(max(start_ms)*1000), '%Y-%m-%d %H:%M:%S') AS last_start, ad_id, any_value(click_count) AS click_count
FROM runs GROUP BY ad_id, run"""),
)
def stream_sliding_changes(spark, sf):
    """The window of one hour that slides by 10 s."""
    return _click_job(spark, sf, "stream-changes", ads.sliding_changes, slide_ms=10_000)


@query(
    "stream_word_count",
    """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(word_line, ' ')) AS word
  FROM (SELECT unnest(string_split(text, chr(10))) AS word_line FROM documents)) WHERE word <> '' GROUP BY ALL""",
)
def stream_word_count(spark, sf):
    root = workspace(spark, "stream-words")
    src.table(spark, sf, "documents").select(F.col("text").alias("value")).write.text(f"{root}/in")
    return words.word_totals(file_lines(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint")


@query("stream_recover", with_views("ads", _STAT))
def stream_recover(spark, sf):
    """Two runs with one checkpoint: the second starts where the first stopped."""
    root = workspace(spark, "stream-recover")
    lines = src.ad_click_lines(spark, sf)
    early = F.split("value", " ").getItem(0).cast("bigint") < 1705276800000  # 2024-01-15
    result = None
    for part in (early, ~early):
        lines.where(part).select("value").write.mode("append").text(f"{root}/in")
        result = ads.ad_totals(file_lines(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint")
    return result
