"""How result tables change: overwrite, append, upsert, replace, re-run.

The merge rules return the new content of the table.  Plain files cannot be
updated in place, so the caller publishes it as the next version, or lets
``replace_partitions`` overwrite the touched partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.sources.files import literal_relation, newest_folder

BATCH_ROWS = 500


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def _laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows gathered by table partition, so that not every task writes a file
    into every folder; adaptive execution splits a partition that is too big."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    _laid_out(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def overwrite_clustered(
    df: DataFrame, path: str, partition_by: Sequence[str], order: Sequence[str], rows_per_group: int = 20_000
) -> str:
    """Overwrite with files that hold neighbouring ranges of ``order``, sorted.

    The smallest and largest value of a file's row groups then tell a reader of
    a range which few of them to open; groups are kept small for that.
    """
    by = [*partition_by, *order]
    laid_out = df.repartitionByRange(*by).sortWithinPartitions(*by)
    writer = laid_out.write.mode("overwrite").partitionBy(*partition_by).option("parquet.block.row.count.limit", rows_per_group)
    writer.parquet(path)
    return path


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    _laid_out(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)
    return path


def insert(
    df: DataFrame, target: str, run_by: Sequence[str], fmt: str = "parquet", batch_rows: int = BATCH_ROWS, **options
) -> None:
    """Add the rows of a run; the columns ``run_by`` name it.

    Files are laid out by run and a repeated run replaces its own rows.  With
    ``jdbc`` each task sends batches of ``batch_rows``; the database has to
    refuse or merge what a repeated run sends again.
    """
    if fmt == "jdbc":
        writer = df.write.mode("append").format(fmt).options(**options)
        writer.option("dbtable", target).option("batchsize", batch_rows).save()
    else:
        replace_partitions(df, target, run_by)


def insert_many(df: DataFrame, targets: Sequence[tuple[DataFrame, str]]) -> None:
    """Several targets fed by one computation of ``df``.

    ``targets`` are frames derived from ``df``.  A lost executor only costs a
    recomputation of its cached part.
    """
    df.persist()
    try:
        for frame, path in targets:
            overwrite(frame, path)
    finally:
        df.unpersist()


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Overwrite only the partitions that occur in ``df``; a re-run repeats itself."""
    (
        _laid_out(df, partition_by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return path


def publish(df: DataFrame, root: str) -> int:
    """Write the new content of a table as its next version; returns the number.

    Readers go on with the old version until the new one is complete, so the
    new content may be computed from the old.
    """
    version = newest_folder(df.sparkSession, root, "version") + 1
    df.write.mode("overwrite").parquet(f"{root}/version={version}")
    return version


def current(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The newest complete version of a published table (empty before the first)."""
    version = newest_folder(spark, root, "version")
    if version < 0:
        return literal_relation(spark, [], schema)
    return spark.read.schema(schema).parquet(f"{root}/version={version}")


def upsert_set(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert, or on a key conflict replace only the columns ``new`` carries."""
    keys = list(keys)
    values = [c for c in old.columns if c not in keys]
    replaced = [c for c in new.columns if c not in keys]
    right = new.select(
        *keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in replaced]
    )
    joined = old.join(right, keys, "full_outer")
    columns = [
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in replaced else F.col(c)
        for c in values
    ]
    extra = [F.col(f"_new_{c}").alias(c) for c in replaced if c not in values]
    return joined.select(*keys, *columns, *extra)


def upsert_add(old: DataFrame, delta: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Add the delta to the stored measure, inserting unknown keys.

    Other stored columns stay as they are; new keys bring theirs, or null.
    """
    keys = list(keys)
    others = [c for c in old.columns if c not in [*keys, measure]]
    brought = [c for c in delta.columns if c in [*keys, measure, *others]]
    both = old.withColumn("_stored", F.lit(1)).unionByName(
        delta.select(*brought).withColumn("_stored", F.lit(0)), allowMissingColumns=True
    )
    kept = [F.max_by(c, "_stored").alias(c) for c in others]
    return both.groupBy(*keys).agg(F.sum(measure).alias(measure), *kept).select(*old.columns)


def replace_group(old: DataFrame, new: DataFrame, group: Sequence[str]) -> DataFrame:
    """Drop the stored rows of every group in ``new``, then add ``new``."""
    group = list(group)
    return old.join(new.select(*group).distinct(), group, "left_anti").unionByName(new)


def without_run(table: DataFrame, run_date: str, column: str = "created") -> DataFrame:
    """The table as it was before the run of ``run_date``."""
    return table.where(F.col(column) != run_date)


def latest(versions: DataFrame, keys: Sequence[str], version: str = "batch_id") -> DataFrame:
    """Newest stored row per key of a table that gets one partition per batch."""
    rest = [c for c in versions.columns if c not in [*keys, version]]
    return versions.groupBy(*keys).agg(*[F.max_by(c, version).alias(c) for c in rest])


def latest_groups(versions: DataFrame, group: Sequence[str], version: str = "batch_id") -> DataFrame:
    """All rows of the newest batch of each group."""
    group = list(group)
    newest = versions.groupBy(*group).agg(F.max(version).alias(version))
    kept = versions.join(newest, [*group, version], "left_semi")
    return kept.select(*[c for c in versions.columns if c != version])
