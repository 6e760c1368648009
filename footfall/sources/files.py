"""File, table and JDBC readers."""

from __future__ import annotations

import datetime
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from footfall.functions.predicates import known_event
from footfall.functions.times import yesterday

CTRL_A = "\x01"
RUN_DATE = re.compile(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")


def date_range(df: DataFrame, start: str | None, end: str | None, column: str = "date") -> DataFrame:
    """Rows with ``start <= column <= end``; literal bounds, so they reach the scan."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end).cast("date"))
    return df


def time_range(df: DataFrame, start: str, end: str, column: str) -> DataFrame:
    """Whole days ``start..end`` of a zone-free time column, pushable to parquet."""
    return df.where(
        (F.col(column) >= F.expr(f"TIMESTAMP_NTZ'{start} 00:00:00'"))
        & (F.col(column) < F.expr(f"TIMESTAMP_NTZ'{end} 00:00:00' + INTERVAL 1 DAY"))
    )


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def ctrl_a(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files with the ``\\x01`` field separator; ``\\N`` is null."""
    return spark.read.schema(schema).csv(path, sep=CTRL_A, nullValue="\\N", quote="")


def dimension(spark: SparkSession, fmt: str, target: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """A dimension table from any reader: ``parquet`` (path) or ``jdbc`` (table).

    For ``jdbc`` pass ``url`` and, for anything large, ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions``.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        return reader.option("dbtable", target).load()
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(target)


def run_date(value: str | None) -> str:
    """A valid ``yyyy-MM-dd`` run date; yesterday if none is given."""
    if value is None:
        return yesterday()
    if not RUN_DATE.match(value):
        raise ValueError(f"run date {value!r} is not yyyy-MM-dd")
    return value


def raw_log_path(root: str, day: str | None = None) -> str:
    _, month, dom = run_date(day).split("-")
    return f"{root.rstrip('/')}/{month}/{dom}/"


def raw_log(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """Log lines of the run date; a missing folder is an error (raised by Spark)."""
    return spark.read.text(raw_log_path(root, day))


def event_log(
    spark: SparkSession,
    path: str,
    day: str,
    columns: Sequence[str],
    event: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One day of event records with the columns one KPI needs.

    The table is partitioned by ``dt``: other days are never listed, and the
    event filter and the column choice are pushed to the reader.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(path).where(F.col("dt") == day)
    if event is not None:
        rows = rows.where(F.col("en") == event)
    return rows.select(*columns)


def event_log_range(
    spark: SparkSession,
    path: str,
    start_ms: int,
    end_ms: int,
    columns: Sequence[str],
    schema: T.StructType | None = None,
) -> DataFrame:
    """Event records with ``start_ms <= s_time < end_ms``.

    For a table partitioned by ``dt`` and clustered by ``s_time``: other days
    are never listed, and of the range's days only the row groups that hold it
    are read.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    day = lambda ms: datetime.datetime.fromtimestamp(ms / 1000, datetime.UTC).strftime("%Y-%m-%d")
    rows = reader.parquet(path).where(F.col("dt").between(day(start_ms), day(max(start_ms, end_ms - 1))))
    return rows.where((F.col("s_time") >= start_ms) & (F.col("s_time") < end_ms)).select(*columns)


def only_known_events(df: DataFrame, column: str = "en") -> DataFrame:
    return df.where(known_event(F.col(column)))


def literal_relation(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small inline table.  Made from an Arrow table, it becomes a local
    relation whose size the planner knows."""
    columns = [pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(zip(*rows), schema.fields)]
    if not rows:
        columns = [pa.array([], to_arrow_type(f.dataType)) for f in schema.fields]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.names), schema)


def numbered_relation(spark: SparkSession, n: int, *columns: Column) -> DataFrame:
    """``n`` generated rows; made on the executors, not shipped from the driver."""
    return spark.range(1, n + 1).select(*columns)


def newest_folder(spark: SparkSession, root: str, name: str) -> int:
    """Largest n of the completely written folders ``root/name=n``, -1 if none."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    top = path(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return -1
    folders = [s.getPath().getName() for s in fs.listStatus(top)]
    numbers = sorted((int(f[len(name) + 1 :]) for f in folders if f.startswith(f"{name}=")), reverse=True)
    return next((n for n in numbers if fs.exists(path(f"{root}/{name}={n}/_SUCCESS"))), -1)
