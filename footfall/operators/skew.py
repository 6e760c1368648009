"""Ordered analytics and joins that hold when one key has a third of all rows.

A window function sends every row of its partition to one task, and adaptive
execution does not split windows.  The helpers here cut a key into slices, run
the window inside the slices and carry one small row per slice across.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.functions.times import DAY_MS
from footfall.session import materialize


def plan_bytes(df: DataFrame) -> int:
    """Size estimate the optimizer holds for ``df``."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    text = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")).lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for unit in sorted(units, key=len, reverse=True):
        if text.endswith(unit):
            return int(float(text[: -len(unit)]) * units[unit])
    return int(text)


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the estimated size of ``df`` allows a broadcast."""
    return plan_bytes(df) <= (broadcast_limit(df) if limit is None else limit)


def checked_broadcast(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Broadcast hint only below the size limit; the planner decides beyond it."""
    return F.broadcast(df) if is_small(df, limit) else df


HOT_ROWS = 1_000_000
SKETCH_ITEMS = 65_536
SKETCH_PARTS = 64
SECOND_MS = 1000
WIDTHS_MS = (DAY_MS, 60 * SECOND_MS, SECOND_MS, 1)


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, items: int = SKETCH_ITEMS
) -> DataFrame | None:
    """Keys with ``hot_rows`` rows or more and their counts ``n_rows``; None if there are none.

    Every task sketches the frequent items of its rows as it scans them
    (Misra-Gries, ``items`` counters), sketches merge in ``SKETCH_PARTS`` parts
    and then in one, and only what may be frequent is counted exactly.  No key
    is shuffled unless it is a candidate.  A sketch of ``items`` counters errs
    by 3.5 / items of all rows at most, so it surely shows every key above
    twice that; where this is more than ``hot_rows`` - beyond 9 * 10^9 rows -
    it is the limit instead.  Rows with a null key have no key.
    """
    keyed = _with_keys(df, keys).withColumn("_key", F.xxhash64(*keys))
    sketch = F.count(F.lit(1)).alias("_n"), F.expr(f"approx_top_k_accumulate(_key, {items})").alias("_sketch")
    parts = keyed.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_PARTS)).alias("_part")).agg(*sketch).drop("_part")
    parts = parts.unionByName(keyed.limit(0).agg(*sketch))  # an empty sketch, in case there is no row
    whole = parts.agg(F.sum("_n").alias("n"), F.expr(f"approx_top_k_combine(_sketch, {items})").alias("_sketch"))
    shown = F.filter(F.expr(f"approx_top_k_estimate(_sketch, {items})"), lambda x: x["count"] >= hot_rows)
    found = whole.select("n", F.when(F.col("n") >= hot_rows, shown).alias("shown")).first()
    if not found["shown"]:
        return None
    limit = max(hot_rows, 7 * found["n"] // items + 1)
    suspects = [(x["item"],) for x in found["shown"] if x["count"] >= limit]  # at most ``items``
    if not suspects:
        return None
    candidates = df.sparkSession.createDataFrame(suspects, "_key long")
    counted = (
        keyed.join(F.broadcast(candidates), "_key", "left_semi")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") >= limit)
    )
    counted = materialize(counted, "hot-keys")
    return None if counted.isEmpty() else counted


def time_sliced(
    df: DataFrame,
    keys: Sequence[str],
    ms: Column,
    name: str = "_slice",
    widths_ms: Sequence[int] = WIDTHS_MS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds the time slice of each row for the sliced operators below; without a hot key, ``df`` as it is.

    A key of ``hot_rows`` rows or more is cut into days, a day of it that holds
    as many into minutes, such a minute into seconds, such a second into
    milliseconds; any other key is one slice (0).  ``hot_keys`` looks at every
    row at any size of input.  Hot slices are a written table, so the join knows
    its true size.  Slices only steer the distribution of the work; results do
    not depend on them.
    """
    keys = list(keys)
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return df
    starts = [F.floor(ms / F.lit(w)).cast("bigint") * w for w in widths_ms]
    flagged = lambda t, mark: t.drop("n_rows").withColumn(mark, F.lit(True))
    out = df.join(flagged(hot, "_hot"), keys, "left")
    slice_start = F.when(F.col("_hot"), starts[0]).otherwise(F.lit(0).cast("bigint"))
    staged = df.select(*keys, *[c.alias(f"_w{i}") for i, c in enumerate(starts)]).join(hot.select(*keys), keys, "left_semi")
    for level in range(len(widths_ms) - 1):
        here = [*keys, f"_w{level}"]
        full = hot_keys(staged, here, hot_rows)
        if full is None:
            break
        mark = f"_hot{level}"
        out = out.withColumn(f"_w{level}", starts[level]).join(flagged(full, mark), here, "left").drop(f"_w{level}")
        slice_start = F.when(F.col(mark), starts[level + 1]).otherwise(slice_start)
        staged = staged.join(full.select(*here), here, "left_semi")
    return out.withColumn(name, slice_start).select(*df.columns, name)


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def sliced_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    slice_col: str,
    order: Sequence[str],
    values: dict[str, str],
    forward: bool = False,
) -> DataFrame:
    """``lag`` (``lead`` when ``forward``) of ``values`` per key, computed by slices.

    ``slice_col`` must not decrease along ``order``.  ``values`` maps a source
    column to the name of its neighbour column.  Rows with a null key belong to
    no sequence and are left out.  Taking them out up front also makes both
    readers of the rows ask for the same exchange, as long as ``df`` has no
    other columns than these: the input is read and shuffled once, and the join
    with the carried values keeps its partitioning.  Without the column nothing
    is sliced, and one window does it all.
    """
    step, back = (F.lead, F.lag) if forward else (F.lag, F.lead)
    if slice_col not in df.columns:
        plain = W.partitionBy(*keys).orderBy(*order)
        return _with_keys(df, keys).withColumns({name: step(source).over(plain) for source, name in values.items()})
    part = [*keys, slice_col]
    df = _with_keys(df, part)
    inside = W.partitionBy(*part).orderBy(*order)

    marked = df.withColumns({
        **{name: step(source).over(inside) for source, name in values.items()},
        "_open": step(F.lit(1)).over(inside).isNull(),
        "_edge": back(F.lit(1)).over(inside).isNull(),
    })
    across = W.partitionBy(*keys).orderBy(slice_col)
    edges = marked.where("_edge").select(*part, F.struct(*values).alias("_value"))
    carry = edges.select(*part, step("_value").over(across).alias("_carry"))

    joined = marked.join(carry, part, "left")
    filled = {
        name: F.when(F.col("_open"), F.col("_carry")[source]).otherwise(F.col(name))
        for source, name in values.items()
    }
    return joined.withColumns(filled).select(*df.columns, *values.values())


def sliced_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    slice_col: str,
    order: Sequence[str],
    value: Column,
    name: str,
) -> DataFrame:
    """Running sum of ``value`` per key in ``order``, computed by slices.

    Conditions as for ``sliced_neighbour``.  What came before a slice is a sum,
    so it is pre-aggregated on the map side and shuffles one row per slice.
    """
    if slice_col not in df.columns:
        plain = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        return _with_keys(df, keys).withColumn(name, F.sum(value).over(plain))
    part = [*keys, slice_col]
    df = _with_keys(df, part).withColumn("_v", value)
    before = W.partitionBy(*keys).orderBy(slice_col).rowsBetween(W.unboundedPreceding, -1)
    carry = (
        df.groupBy(*part)
        .agg(F.sum("_v").alias("_t"))
        .select(*part, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"))
    )
    until = W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    joined = df.withColumn("_local", F.sum("_v").over(until)).join(carry, part)
    return joined.withColumn(name, F.col("_local") + F.col("_before")).drop("_v", "_local", "_before")


def with_row_before(sorted_rows: DataFrame, value: str, name: str) -> DataFrame:
    """Adds ``value`` of the row that stands before each, across partitions.

    Rows are written in the order they come in, so this tells what a sort did.
    """
    place = F.monotonically_increasing_id()  # partition and place in it
    kept = materialize(sorted_rows.withColumn("_at", place), "in-order").withColumn("_slice", F.shiftright("_at", 33))
    return sliced_neighbour(kept, [], "_slice", ["_at"], {value: name}).drop("_at", "_slice")


def numbered(
    df: DataFrame, order: Sequence[str | Column], name: str, keys: Sequence[str] = ()
) -> DataFrame:
    """``row_number`` over whole groups (or the whole frame) without one task
    holding a group.

    Rows are range partitioned by (keys, order) and sorted, once; what the rows
    of a partition have as numbers of their own is made group numbers by adding
    the counts of the partitions before.  A row's place in the input breaks
    ties, so equal rows spread over partitions as well.  The sorted rows are
    written, because both steps must see the same partitions.
    """
    spark = df.sparkSession
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # one struct for all keys: never null itself, so rows with a null key join too
    group = F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)
    by = [F.col("_group"), *order, F.col("_tie")]
    ranged = materialize(
        df.withColumns({"_group": group, "_tie": F.monotonically_increasing_id()})
        .repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id()),  # partition and place in it
        "numbered",
    ).withColumn("_pid", F.shiftright("_at", 33))
    part = ["_group", "_pid"]
    before = W.partitionBy("_group").orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    # at most one row per partition and group that touches it
    offsets = (
        ranged.groupBy(*part)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
        .select(*part, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    )
    number = (F.col("_at") + F.col("_shift")).cast("bigint")
    return ranged.join(offsets, part).select(*df.columns, number.alias(name))


def skew_split_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    hot_rows: int = HOT_ROWS,
    how: str = "inner",
    spread: Sequence[str] = (),
) -> DataFrame:
    """Equi-join that salts the hot keys of ``left`` and joins the rest plainly.

    A key of ``hot_rows`` rows or more gets a salt for every half of that many.
    A hot row of ``left`` takes one of its key's salts, and the ``right`` rows
    of the key are repeated once per salt; all other rows have number 0 on both
    sides.  Every pair is met exactly once, in one join.  The hot keys are a
    written table, so the planner knows their size; without one it is a plain join.  The salt is a hash of the
    ``spread`` columns (all columns unless given), which must tell the rows of a
    key apart; a retried task puts a row in the same place, which a random salt
    would not.
    """
    _keeps_left(how)
    salts = F.ceil(F.col("n_rows") * 2 / hot_rows).cast("int")
    hot = hot_keys(left, [key], hot_rows)
    if hot is None:
        return left.join(right, key, how)
    hot = hot.select(key, salts.alias("_salts"))
    zero = F.lit(0)
    salt = F.when(F.col("_salts").isNull(), zero).otherwise(
        F.pmod(F.xxhash64(*(spread or left.columns)), F.col("_salts")).cast("int")
    )
    numbers = F.sequence(zero, F.coalesce("_salts", F.lit(1)) - 1)
    return (
        left.join(hot, key, "left").withColumn("_salt", salt).drop("_salts")
        .join(right.join(hot, key, "left").withColumn("_salt", F.explode(numbers)).drop("_salts"), [key, "_salt"], how)
        .drop("_salt")
    )


def _salt(spread: Sequence[str], salts: int) -> Column:
    return F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")


def _keeps_left(how: str) -> None:
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only joins that keep or filter the left side can be salted")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    salts: int = 10,
    how: str = "inner",
    spread: Sequence[str] = (),
) -> DataFrame:
    """Equi-join with ``left`` salted 0..n-1 and every ``right`` row repeated n times.

    Both sides are shuffled and merged.  The planner's estimate of ``right``
    does not count the copies, so left to itself it broadcasts n times what its
    limit allows, through the driver.
    """
    _keeps_left(how)
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (
        left.withColumn("_salt", _salt(spread or left.columns, salts))
        .join(right.withColumn("_salt", copies).hint("merge"), [key, "_salt"], how)
        .drop("_salt")
    )


def chunked_lists(
    df: DataFrame, key: str, value: str, order: Sequence[str | Column], chunk_rows: int
) -> DataFrame:
    """Values of each key as arrays of ``chunk_rows`` in ``order``: (key, chunk, values).

    The last array of a key may be shorter.  The shape is the same for keys of
    any size, and no task and no row holds an unbounded group.
    """
    rows = numbered(df.select(key, value), order, "_n", keys=[key])
    chunk = F.call_function("div", F.col("_n") - 1, F.lit(chunk_rows))
    pairs = F.array_sort(F.collect_list(F.struct("_n", value)))
    return rows.groupBy(key, chunk.alias("chunk")).agg(
        F.transform(pairs, lambda p: p[value]).alias("values")
    )


def two_phase_count(df: DataFrame, keys: Sequence[str], salts: int = 10) -> DataFrame:
    """Count per key in two steps: per (key, salt), then per key."""
    keys = list(keys)
    return (
        df.withColumn("_salt", _salt(df.columns, salts))
        .groupBy(*keys, "_salt")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*keys)
        .agg(F.sum("_n").alias("n"))
    )


def spread_nulls(df: DataFrame, key: str, name: str, parts: int = 1024) -> DataFrame:
    """Adds ``name``: the text ``key``, or for a null one of ``parts`` texts that
    match no key.  An outer join on it spreads the null rows instead of sending
    them all to one task."""
    number = F.pmod(F.xxhash64(*df.columns), F.lit(parts)).cast("string")
    return df.withColumn(name, F.coalesce(key, F.concat(F.lit("\x01"), number)))


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rank", parts: int = 64
) -> DataFrame:
    """First ``k`` rows of each group.

    The literal limit lets Spark cut every map task's share to k rows per group
    before the shuffle.  Spark does so up to a threshold only; for a larger
    ``k`` each group is ranked in ``parts`` parts first, so that no task gets
    more of a group than its part and ``parts`` times k rows.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    if k > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        part = F.pmod(F.xxhash64(*df.columns), F.lit(parts))
        own = W.partitionBy(*keys, "_part").orderBy(*order)
        df = df.withColumn("_part", part).withColumn("_rn", F.row_number().over(own)).where(F.col("_rn") <= k)
        df = df.drop("_part", "_rn")
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def bucket_audit(df: DataFrame, bucket: Column) -> DataFrame:
    """Rows per bucket, summed up: the fullest bucket in percent of the mean."""
    per = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))
    return per.agg(
        F.count(F.lit(1)).alias("buckets"),
        F.sum("n_rows").alias("n_rows"),
        F.max("n_rows").alias("max_rows"),
    ).withColumn(
        "max_to_mean_pct",
        F.call_function("div", F.col("max_rows") * F.col("buckets") * 100, F.col("n_rows")),
    )
