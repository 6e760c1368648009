"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import apply_settings

# Documents differ widely in length: few rows per Arrow batch keep a batch of
# long ones small.  Functions gather batches by bytes where they want more.
ARROW_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the corpus operators, and this package on every executor."""
    apply_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package's source to the executors' Python workers, once per context."""
    context = spark.sparkContext
    if getattr(context, "_footfall_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(root):  # else it runs from such an archive itself
        archive = os.path.join(tempfile.mkdtemp(prefix="footfall-"), "footfall_src.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.join("footfall", os.path.relpath(path, root)))
        context.addPyFile(archive)
    context._footfall_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(taken: Iterable[str], *wanted: str) -> list[str]:
    """Column names like ``wanted`` that clash with none in ``taken``, in any case."""
    used = {name.lower() for name in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def gathered(batches: Iterable[pa.RecordBatch], max_bytes: int) -> Iterator[pa.Table]:
    """Join small batches into tables of about ``max_bytes``; a larger batch comes alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            if held and size + batch.nbytes > max_bytes:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(batch)
            size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


def keep_where(docs: DataFrame, text_col: str, max_bytes: int, keep: Callable[[pa.Array], list[bool]]) -> DataFrame:
    """The rows for whose texts ``keep`` says so, with all columns as they are."""
    names = [f"c{i}" for i in range(len(docs.columns))]  # any name may stand in ``docs``
    text = names[docs.columns.index(text_col)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in gathered(batches, max_bytes):
            yield from t.filter(pa.array(keep(column(t, text)), pa.bool_())).to_batches()

    plain = docs.toDF(*names)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def column(t: pa.Table, name: str) -> pa.Array:
    got = t.column(name).combine_chunks()
    return pa.concat_arrays(got.chunks) if isinstance(got, pa.ChunkedArray) else got
