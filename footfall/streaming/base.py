"""Sources and the run loop shared by the streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def file_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Text files dropped into a folder as a stream of lines."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def kafka_lines(spark: SparkSession, brokers: str, topics: str, **options) -> DataFrame:
    """Kafka messages of a comma-separated list of topics as lines.

    Needs the Kafka connector on the class path.  Offsets live in the
    checkpoint of the query, so a restart goes on where it stopped.
    """
    topic_list = ",".join(t.strip() for t in topics.split(",") if t.strip())
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic_list)
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines of a socket; for trials only, since a socket cannot be replayed."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def use_keyed_state(spark: SparkSession) -> None:
    """Keep state on the executors' disks, and checkpoint what a batch changed of it."""
    store = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", store)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


# How a job runs: (writer, checkpoint folder) -> query.
Run = Callable[[DataStreamWriter, str], StreamingQuery]


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process everything that has arrived, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_continuously(writer: DataStreamWriter, checkpoint: str, every: str = "5 seconds") -> StreamingQuery:
    """Start a query that keeps taking batches; the caller stops it.

    The job then returns its table as of now; ``ledger.content`` reads it later.
    """
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
