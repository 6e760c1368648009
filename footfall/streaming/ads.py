"""Real-time ad clicks.

Input is a stream of click lines.  Every job takes the stream, a folder for its
results and a checkpoint folder, processes what is there and can be started
again later.

Counts are kept as the sum of what each batch adds, not as state behind a
watermark: a click counts however late it comes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from footfall.functions.times import DAY_MS
from footfall.operators import ads
from footfall.operators.joins import without_users
from footfall.operators.skew import sliced_neighbour, sliced_running_sum
from footfall.sinks.tables import latest, latest_groups
from footfall.streaming import ledger
from footfall.streaming.base import Run, run_available, use_keyed_state

_STR, _LONG = T.StringType(), T.LongType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CLICKS = _schema(
    ("click_ms", _LONG), ("province", _STR), ("city", _STR), ("user_id", _LONG), ("ad_id", _LONG), ("date", _STR)
)
USER_AD = _schema(("date", _STR), ("user_id", _LONG), ("ad_id", _LONG), ("click_count", _LONG))
STAT = _schema(
    ("date", _STR), ("province", _STR), ("city", _STR), ("ad_id", _LONG), ("click_count", _LONG)
)
TOP = _schema(("date", _STR), ("province", _STR), ("ad_id", _LONG), ("click_count", _LONG), ("rank", _LONG))
TREND = _schema(
    ("date", _STR), ("hour", _STR), ("minute", _STR), ("ad_id", _LONG), ("click_count", _LONG)
)
SLOTS = _schema(("date", _STR), ("slot_ms", _LONG), ("ad_id", _LONG), ("click_count", _LONG))
LIVES = _schema(
    ("date", _STR), ("province", _STR), ("city", _STR), ("ad_id", _LONG), ("life", _LONG), ("click_count", _LONG)
)
USERS = _schema(("user_id", _LONG))


def parsed_clicks(lines: DataFrame, out: str, checkpoint: str, run: Run = run_available) -> DataFrame:
    """Typed clicks appended to a table."""
    clicks = ads.parse_clicks(lines)
    run(clicks.writeStream.outputMode("append").format("parquet").option("path", out), checkpoint)
    return lines.sparkSession.read.schema(CLICKS).parquet(out)


def allowed_clicks(
    lines: DataFrame,
    load_blacklist: Callable[[SparkSession], DataFrame],
    out: str,
    checkpoint: str,
    run: Run = run_available,
) -> DataFrame:
    """Clicks of users outside the blacklist, which is loaded anew for each batch."""

    def step(batch: DataFrame, batch_id: int) -> None:
        ledger.store(without_users(batch, load_blacklist(batch.sparkSession)), out, batch_id)

    run(ads.parse_clicks(lines).writeStream.foreachBatch(step), checkpoint)
    return ledger.appended(lines.sparkSession, out, CLICKS)


USER_AD_KEYS = ["date", "user_id", "ad_id"]
STAT_KEYS = ["date", "province", "city", "ad_id"]


def _sum_by(keys: list[str]) -> ledger.Fold:
    return lambda rows: rows.groupBy(*keys).agg(F.sum("click_count").alias("click_count"))


_summed = _sum_by(USER_AD_KEYS)


def _users(rows: DataFrame) -> DataFrame:
    return rows.select("user_id").distinct()


def user_ad_totals(
    lines: DataFrame, out: str, checkpoint: str, every: int = ledger.EVERY, run: Run = run_available
) -> DataFrame:
    """Clicks per (day, user, ad): batches store their counts, reading adds them up."""

    def step(batch: DataFrame, batch_id: int) -> None:
        ledger.fold_if_due(batch.sparkSession, out, USER_AD, batch_id, _summed, every)
        ledger.store(ads.user_ad_counts(batch), out, batch_id)

    run(ads.parse_clicks(lines).writeStream.foreachBatch(step), checkpoint)
    return ledger.content(lines.sparkSession, out, USER_AD, _summed, every)


def dynamic_blacklist(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    threshold: int = ads.BLACKLIST_THRESHOLD,
    every: int = ledger.EVERY,
    run: Run = run_available,
) -> DataFrame:
    """Blacklist that grows batch by batch.

    A batch first loses the clicks of users banned so far, then adds its counts
    to the stored ones and bans the users who reach the threshold.  Counts and
    bans of a batch are stored under its id, and a repeated batch reads only
    what earlier batches stored, so a retry gives the same result.
    """
    counts_path, banned_path = f"{out}/counts", f"{out}/banned"

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger.fold_if_due(spark, counts_path, USER_AD, batch_id, _summed, every)
        ledger.fold_if_due(spark, banned_path, USERS, batch_id, _users, every)
        banned = _users(ledger.before(spark, banned_path, USERS, batch_id, every))
        delta = ledger.store(ads.user_ad_counts(without_users(batch, banned)), counts_path, batch_id)
        # only keys this batch touched can newly reach the threshold
        earlier = ledger.before(spark, counts_path, USER_AD, batch_id, every).drop("batch_id")
        earlier = earlier.where(F.col("date").isin(ledger.days_of(delta)))
        touched = earlier.join(delta.select(*USER_AD_KEYS), USER_AD_KEYS, "left_semi")
        totals = _summed(touched.unionByName(delta))
        ledger.store(without_users(ads.over_threshold(totals, threshold), banned), banned_path, batch_id)

    run(ads.parse_clicks(lines).writeStream.foreachBatch(step), checkpoint)
    return ledger.content(lines.sparkSession, banned_path, USERS, _users, every)


def _counted(
    lines: DataFrame,
    count: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    schema: T.StructType,
    every: int,
    run: Run,
) -> DataFrame:
    """Counts that batches add to: ``count`` makes those of one batch."""
    fold = _sum_by([n for n in schema.names if n != "click_count"])

    def step(batch: DataFrame, batch_id: int) -> None:
        ledger.fold_if_due(batch.sparkSession, out, schema, batch_id, fold, every)
        ledger.store(count(batch).select(*schema.names), out, batch_id)

    run(ads.parse_clicks(lines).writeStream.foreachBatch(step), checkpoint)
    return ledger.content(lines.sparkSession, out, schema, fold, every)


def _per(*keys: str) -> Callable[[DataFrame], DataFrame]:
    return lambda clicks: clicks.groupBy(*keys).agg(F.count(F.lit(1)).alias("click_count"))


def ad_totals(
    lines: DataFrame, out: str, checkpoint: str, every: int = ledger.EVERY, run: Run = run_available
) -> DataFrame:
    """Running counts per (day, province, city, ad)."""
    return _counted(lines, _per(*STAT_KEYS), out, checkpoint, STAT, every, run)


def province_top3(
    lines: DataFrame, out: str, checkpoint: str, every: int = ledger.EVERY, run: Run = run_available
) -> DataFrame:
    """Best three ads per (day, province), renewed for the groups a batch touched."""
    stat_path, top_path = f"{out}/stat", f"{out}/top"
    group = ["date", "province"]
    fold = _sum_by(STAT_KEYS)

    def newest_groups(rows: DataFrame) -> DataFrame:
        return latest_groups(rows, group)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger.fold_if_due(spark, stat_path, STAT, batch_id, fold, every)
        ledger.fold_if_due(spark, top_path, TOP, batch_id, newest_groups, every)
        delta = ledger.store(_per(*STAT_KEYS)(batch), stat_path, batch_id)
        earlier = ledger.before(spark, stat_path, STAT, batch_id, every).drop("batch_id")
        earlier = earlier.where(F.col("date").isin(ledger.days_of(delta)))
        touched = earlier.join(delta.select(*group).distinct(), group, "left_semi")
        ledger.store(ads.province_top_ads(fold(touched.unionByName(delta))), top_path, batch_id)

    run(ads.parse_clicks(lines).writeStream.foreachBatch(step), checkpoint)
    return ledger.content(lines.sparkSession, top_path, TOP, newest_groups, every)


def click_trend(
    lines: DataFrame, out: str, checkpoint: str, every: int = ledger.EVERY, run: Run = run_available
) -> DataFrame:
    """Clicks per (minute, ad)."""
    at = F.timestamp_millis("click_ms")

    def count(clicks: DataFrame) -> DataFrame:
        minutes = clicks.withColumns({"hour": F.date_format(at, "HH"), "minute": F.date_format(at, "mm")})
        return _per("date", "hour", "minute", "ad_id")(minutes)

    return _counted(lines, count, out, checkpoint, TREND, every, run)


SLIDE_MS = 10_000


def _slots(lines: DataFrame, out: str, checkpoint: str, slide_ms: int, every: int, run: Run) -> DataFrame:
    """Clicks per ad and slide; batches store these, whatever windows a reader wants."""
    slot = (F.floor(F.col("click_ms") / F.lit(slide_ms)) * slide_ms).cast("bigint")
    return _counted(
        lines, lambda clicks: _per("date", "slot_ms", "ad_id")(clicks.withColumn("slot_ms", slot)),
        out, checkpoint, SLOTS, every, run,
    )


def _time_text(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")


def sliding_counts(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    size_ms: int = 3_600_000,
    slide_ms: int = SLIDE_MS,
    every: int = ledger.EVERY,
    run: Run = run_available,
) -> DataFrame:
    """Clicks per ad in overlapping windows, one row per window.

    Reading expands a slide's count to the windows that hold it, so this is for
    few windows per click; ``sliding_changes`` is for many.
    """
    stored = _slots(lines, out, checkpoint, slide_ms, every, run)
    starts = F.sequence(F.col("slot_ms") - (size_ms - slide_ms), F.col("slot_ms"), F.lit(slide_ms).cast("bigint"))
    windows = stored.select(F.explode(starts).alias("start"), "ad_id", "click_count")
    summed = windows.groupBy("start", "ad_id").agg(F.sum("click_count").alias("click_count"))
    return summed.select(
        _time_text(F.col("start")).alias("window_start"), _time_text(F.col("start") + size_ms).alias("window_end"),
        "ad_id", "click_count",
    )


def sliding_changes(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    size_ms: int = 3_600_000,
    slide_ms: int = SLIDE_MS,
    every: int = ledger.EVERY,
    run: Run = run_available,
) -> DataFrame:
    """Clicks per ad in overlapping windows, one row per run of windows with the same count.

    The windows that start from ``first_start`` to ``last_start`` hold
    ``click_count`` clicks each; windows without clicks are left out.  A slide's
    count enters with the first window that holds it and leaves with the first
    that does not, so two rows stand for a slide, however many windows hold it:
    a running sum over these differences is the count of every window.  Sums go
    by day and carry over, so no task holds an ad's whole history.
    """
    stored = _slots(lines, out, checkpoint, slide_ms, every, run)
    enters, leaves = F.col("slot_ms") - (size_ms - slide_ms), F.col("slot_ms") + slide_ms
    change = F.array(
        F.struct(enters.alias("start"), F.col("click_count").alias("n")),
        F.struct(leaves.alias("start"), (-F.col("click_count")).alias("n")),
    )
    changes = stored.select("ad_id", F.explode(change).alias("c")).select("ad_id", "c.*")
    changes = changes.groupBy("ad_id", "start").agg(F.sum("n").alias("n")).where("n <> 0")
    changes = changes.withColumn("_slice", F.floor(F.col("start") / F.lit(DAY_MS)).cast("bigint"))
    counted = sliced_running_sum(changes, ["ad_id"], "_slice", ["start"], F.col("n"), "click_count")
    until = sliced_neighbour(
        counted.select("ad_id", "_slice", "start", "click_count"), ["ad_id"], "_slice", ["start"], {"start": "until"}, forward=True
    )
    return until.where("click_count > 0").select(
        _time_text(F.col("start")).alias("first_start"), _time_text(F.col("until") - slide_ms).alias("last_start"),
        "ad_id", "click_count",
    )


# A key's clicks of one stay in the state store; a key that comes back later has another.
LIFE_KEYS = [*STAT_KEYS, "life"]


def _newest_lives(rows: DataFrame) -> DataFrame:
    return latest(rows, LIFE_KEYS)


def ad_state_totals(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    idle: str = "2 days",
    every: int = ledger.EVERY,
    run: Run = run_available,
) -> DataFrame:
    """Running counts per (day, province, city, ad), kept as keyed state of the stream.

    The engine holds the count of every key that had a click within ``idle`` in
    its state store (RocksDB, checkpointed as changes), and a batch stores the
    new counts of its keys only.  A key without a click for ``idle`` - its day is
    over - leaves the state; its count stays in the result table.  A click that
    comes later still starts another life of the key, named by the time of its
    batch, which a repeated batch keeps; lives add up.  So every click counts,
    and the state holds the keys of a few days.
    """
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(parts)
        now = int(rows["seen"].max().timestamp() * 1000)
        life, n = state.get if state.exists else (now, 0)
        n += len(rows)
        state.update((life, n))
        state.setTimeoutTimestamp(max(now, state.getCurrentWatermarkMs()) + idle_ms)
        yield pd.DataFrame([(*key, life, n)], columns=LIVES.names)

    # The clock is that of the batches, which a repeated batch keeps; no click is late by it.
    clicks = ads.parse_clicks(lines).select(*STAT_KEYS, F.current_timestamp().alias("seen")).withWatermark("seen", "0 seconds")
    counted = clicks.groupBy(*STAT_KEYS).applyInPandasWithState(
        step, LIVES, _schema(("life", _LONG), ("n", _LONG)), "update", GroupStateTimeout.EventTimeTimeout
    )

    def keep(batch: DataFrame, batch_id: int) -> None:
        ledger.fold_if_due(batch.sparkSession, out, LIVES, batch_id, _newest_lives, every)
        ledger.store(batch, out, batch_id)

    use_keyed_state(lines.sparkSession)
    run(counted.writeStream.outputMode("update").foreachBatch(keep), checkpoint)
    lives = ledger.content(lines.sparkSession, out, LIVES, _newest_lives, every)
    return lives.groupBy(*STAT_KEYS).agg(F.sum("click_count").alias("click_count"))
