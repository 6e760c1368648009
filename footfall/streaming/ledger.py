"""Result tables of streams: one folder per batch, folded now and then.

``foreachBatch`` may repeat a batch after a failure.  Each batch therefore
writes a folder named by its id, which a repetition overwrites.  Every
``EVERY`` batches what they stored is folded into a snapshot, so a reader
opens at most one snapshot and ``EVERY`` batch folders, however long the stream
has been running; what two snapshots have made obsolete is deleted.  A table and the
checkpoint of its query belong together.

Tables with a ``date`` column are laid out by it.  A batch that asks for its own
days reads no others, and a snapshot writes only the days that its batches
touched: a list names, for every day, the snapshot that holds its rows.  So the
work of a fold follows the last ``EVERY`` batches, not the age of the stream.
Tables without days are folded whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.sources.files import literal_relation, newest_folder

EVERY = 100

# Content with a batch id per row -> content (one row per key, for example).
Fold = Callable[[DataFrame], DataFrame]


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch_id", T.LongType(), True)])


def _batch(path: str, batch_id: int) -> str:
    return f"{path}/batches/batch_id={batch_id}"


def _snapshot(path: str, batch_id: int) -> str:
    return f"{path}/snapshots/before={batch_id}"


def _days_list(path: str, batch_id: int) -> str:
    return f"{path}/days/before={batch_id}"


DAYS = T.StructType([T.StructField("date", T.StringType()), T.StructField("held_by", T.LongType())])


def _held_days(spark: SparkSession, path: str, batch_id: int) -> dict[str | None, int]:
    """The snapshot that holds each day, as of the one before ``batch_id``: one entry per day."""
    if batch_id <= 0 or not _exists(spark, _days_list(path, batch_id)):
        return {}
    return {r["date"]: r["held_by"] for r in spark.read.schema(DAYS).parquet(_days_list(path, batch_id)).collect()}


def _day_folder(path: str, day: str | None, held_by: int) -> str:
    return f"{_snapshot(path, held_by)}/date={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"


def _folded(spark: SparkSession, path: str, schema: T.StructType, start: int) -> DataFrame:
    """Content of the snapshot at ``start``."""
    if "date" not in schema.names:
        return spark.read.schema(schema).parquet(_snapshot(path, start))
    folders = [_day_folder(path, day, held_by) for day, held_by in _held_days(spark, path, start).items()]
    if not folders:
        return literal_relation(spark, [], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/snapshots").parquet(*folders).select(*schema.names)


def _range(spark: SparkSession, path: str, schema: T.StructType, start: int, end: int) -> DataFrame:
    """The snapshot at ``start`` and the batches from there up to ``end``.

    Rows of the snapshot carry the id of the last batch in it.
    """
    rows = literal_relation(spark, [], _with_batch(schema))
    if start:
        folded = _folded(spark, path, schema, start)
        rows = rows.unionByName(folded.withColumn("batch_id", F.lit(start - 1).cast("bigint")))
    if end > start:
        folders = [_batch(path, i) for i in range(start, end)]
        reader = spark.read.schema(_with_batch(schema)).option("basePath", f"{path}/batches")
        rows = rows.unionByName(reader.parquet(*folders))
    return rows


def before(spark: SparkSession, path: str, schema: T.StructType, batch_id: int, every: int = EVERY) -> DataFrame:
    """What the batches earlier than ``batch_id`` stored, with their ids."""
    return _range(spark, path, schema, batch_id // every * every, batch_id)


def fold_if_due(
    spark: SparkSession, path: str, schema: T.StructType, batch_id: int, fold: Fold, every: int = EVERY
) -> None:
    """Write the snapshot due before ``batch_id``; call this first in a batch."""
    if not batch_id or batch_id % every:
        return
    start = batch_id - every
    rows = _range(spark, path, schema, start, batch_id)
    if "date" in schema.names:
        touched = days_of(rows.where(F.col("batch_id") >= start))
        rows = rows.where(_one_of(F.col("date"), touched))
    _write(fold(rows).select(*schema.names), _snapshot(path, batch_id))
    if "date" in schema.names:
        held = _held_days(spark, path, start) | dict.fromkeys(touched, batch_id)
        literal_relation(spark, list(held.items()), DAYS).coalesce(1).write.mode("overwrite").parquet(
            _days_list(path, batch_id)
        )
    _forget(spark, path, schema, start, every)


def _one_of(day: Column, days: list[str | None]) -> Column:
    return day.isin([d for d in days if d is not None]) | (day.isNull() if None in days else F.lit(False))


def _write(df: DataFrame, folder: str) -> None:
    by = ["date"] if "date" in df.columns else []
    df.write.mode("overwrite").partitionBy(*by).parquet(folder)


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, name: str) -> bool:
    path, files = _path(spark, name)
    return files.exists(path)


def _delete(spark: SparkSession, name: str) -> None:
    path, files = _path(spark, name)
    files.delete(path, True)


def _forget(spark: SparkSession, path: str, schema: T.StructType, before_id: int, every: int) -> None:
    """Delete what no reader needs: it is in the snapshot before ``before_id``, and a later one exists."""
    if before_id <= 0:
        return
    for i in range(before_id - every, before_id):
        _delete(spark, _batch(path, i))
    older = before_id - every
    if older <= 0:
        return
    if "date" not in schema.names:
        _delete(spark, _snapshot(path, older))
        return
    now, was = _held_days(spark, path, before_id), _held_days(spark, path, older)
    for day, held_by in was.items():
        if now.get(day) != held_by:
            _delete(spark, _day_folder(path, day, held_by))
    for held_by in set(was.values()) - set(now.values()):  # no day is left in it
        _delete(spark, _snapshot(path, held_by))
    _delete(spark, _days_list(path, older))


def store(df: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Keep the rows of a batch; returns them as stored."""
    _write(df, _batch(path, batch_id))
    return df.sparkSession.read.schema(df.schema).parquet(_batch(path, batch_id))


def days_of(delta: DataFrame) -> list[str]:
    """The days a batch touches; a batch is a few seconds of clicks and some late ones."""
    return [r["date"] for r in delta.select("date").distinct().collect()]


def last_batch(spark: SparkSession, path: str) -> int:
    """Id of the newest completely written batch, -1 if there is none."""
    return newest_folder(spark, f"{path}/batches", "batch_id")


def appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a table that only grows, of completely written batches."""
    end = last_batch(spark, path)
    if end < 0:
        return literal_relation(spark, [], schema)
    rows = spark.read.schema(_with_batch(schema)).parquet(f"{path}/batches")
    return rows.where(F.col("batch_id") <= end).select(*schema.names)


def content(
    spark: SparkSession, path: str, schema: T.StructType, fold: Fold, every: int = EVERY
) -> DataFrame:
    """The table as of its newest batch."""
    end = last_batch(spark, path) + 1
    # the snapshot at ``end`` is only written by the batch that follows
    start = max(end - 1, 0) // every * every
    return fold(_range(spark, path, schema, start, end)).select(*schema.names)
