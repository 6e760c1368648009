"""Tables whose merges rewrite only the buckets they touch.

Rows are dealt to a fixed number of buckets by a hash of the key.  A merge reads
the buckets of its new rows, applies a rule of ``sinks.tables`` to them, writes
them under the next version and then a list that names, for every bucket, the
version that holds it.  The list makes the merge visible, so one that breaks
off leaves the table as it was, and its files are overwritten by the next try.
The version before the newest stays readable; older files are deleted.

    root/lists/version=3            bucket, held_by
    root/data/version=3/bucket=17   rows
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.sources.files import literal_relation, newest_folder

BUCKETS = 64
LIST = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("held_by", T.LongType())])

# (rows stored under the touched buckets, new rows) -> what these buckets hold from now on
Rule = Callable[[DataFrame, DataFrame], DataFrame]


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _folder(root: str, bucket: int, held_by: int) -> str:
    return f"{root}/data/version={held_by}/bucket={bucket}"


def held_buckets(spark: SparkSession, root: str, version: int) -> dict[int, int]:
    """The version that holds each bucket: at most one entry per bucket."""
    if version < 0:
        return {}
    return {r["bucket"]: r["held_by"] for r in spark.read.schema(LIST).parquet(f"{root}/lists/version={version}").collect()}


def _rows(spark: SparkSession, root: str, schema: T.StructType, held: dict[int, int]) -> DataFrame:
    if not held:
        return literal_relation(spark, [], schema)
    folders = [_folder(root, bucket, held_by) for bucket, held_by in sorted(held.items())]
    return spark.read.schema(schema).parquet(*folders)


def newest(spark: SparkSession, root: str) -> int:
    """The newest version, -1 before the first merge."""
    return newest_folder(spark, f"{root}/lists", "version")


def content(spark: SparkSession, root: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The table as of its newest version, or the one before it."""
    version = newest(spark, root) if version is None else version
    return _rows(spark, root, schema, held_buckets(spark, root, version))


def merge(
    new: DataFrame, root: str, keys: Sequence[str], rule: Rule, schema: T.StructType, buckets: int = BUCKETS
) -> int:
    """Apply ``rule`` to the buckets that ``new`` has keys of; returns the version.

    ``keys`` and ``buckets`` are the same in every merge of a table.  The rule
    must not move rows to other keys.
    """
    spark = new.sparkSession
    last = newest(spark, root)
    version, held = last + 1, held_buckets(spark, root, last)
    touched = {r[0] for r in new.select(_bucket(keys, buckets)).distinct().collect()}  # at most ``buckets``
    old = _rows(spark, root, schema, {b: v for b, v in held.items() if b in touched})
    merged = rule(old, new).select(*schema.names).withColumn("bucket", _bucket(keys, buckets))
    target = f"{root}/data/version={version}"
    merged.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
    written = {b for b in touched if _exists(spark, _folder(root, b, version))}  # a rule may empty a bucket
    now = {b: v for b, v in held.items() if b not in touched} | dict.fromkeys(written, version)
    literal_relation(spark, list(now.items()), LIST).coalesce(1).write.mode("overwrite").parquet(
        f"{root}/lists/version={version}"
    )
    _forget(spark, root, version - 2)
    return version


def _file_system(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, name: str) -> bool:
    path, files = _file_system(spark, name)
    return files.exists(path)


def _forget(spark: SparkSession, root: str, version: int) -> None:
    """Delete what only ``version`` and older ones hold."""
    if version < 0 or not _exists(spark, f"{root}/lists/version={version}"):
        return
    later = held_buckets(spark, root, version + 1)
    for bucket, held_by in held_buckets(spark, root, version).items():
        if later.get(bucket) != held_by:
            path, files = _file_system(spark, _folder(root, bucket, held_by))
            files.delete(path, True)
    path, files = _file_system(spark, f"{root}/lists/version={version}")
    files.delete(path, True)
