"""Word count over a stream of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.operators.relational import word_count
from footfall.streaming import ledger
from footfall.streaming.base import Run, run_available

WORDS = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def word_totals(
    lines: DataFrame, out: str, checkpoint: str, every: int = ledger.EVERY, run: Run = run_available
) -> DataFrame:
    """Counts over all lines so far: batches store their own, reading adds them up."""

    def step(batch: DataFrame, batch_id: int) -> None:
        ledger.fold_if_due(batch.sparkSession, out, WORDS, batch_id, _summed, every)
        ledger.store(word_count(batch, "value"), out, batch_id)

    run(lines.writeStream.foreachBatch(step), checkpoint)
    return ledger.content(lines.sparkSession, out, WORDS, _summed, every)
