"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are written for.  All are runtime settings, so a session
# made elsewhere can take them with ``apply_settings``.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even if the rows are grouped on the same
    # key afterwards: the extra exchange carries pre-aggregated rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Tasks are many before they are large.  A task that counts ids holds some
    # twenty times what it reads of a shuffle; by default a shuffle is coalesced
    # to one task a core until a task reads 64 MB, and a scan to 128 MB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.parquet.filterPushdown": "true",
    # The last value of a repeated request parameter wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def build_session(
    name: str = "footfall",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    conf = dict(SETTINGS)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting may use a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    # shell-free check: the context keeps its checkpoint folder once it is set
    existing = context.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    local = tempfile.mkdtemp(prefix="footfall-")
    context.setCheckpointDir(local)
    return context.getCheckpointDir().rstrip("/")


def workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the shared root."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a plan is read more than once and must see the very same rows
    (partition numbers, for example), also after a lost executor.
    """
    spark = df.sparkSession
    path = workspace(spark, purpose)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
