"""From raw documents to packed training sequences.

Five stages, each on all that the one before kept: reject bad texts, drop exact
copies, keep one document of each group of near copies, drop documents that
hold benchmark passages, pack the rest.  Every stage is written to the shared
folder and read again, so a lost executor costs no more than a stage.

Odd rows: a null text counts as empty everywhere and is scored like any other;
of empty texts and repeated rows one document stays.  Documents without words
link with nothing and hold no passage.  A null id stays null.  Other columns
pass through whatever their names and values; only the last stage drops them.
Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import decontaminate, exact, neardup, packing, quality
from footfall.llm.common import id_remainder, prepare, table
from footfall.llm.queries import END_ID, SEQUENCE, tokenizer_file
from footfall.session import materialize

NEAR_PERCENT = 80


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more; it learns as in op8."""
    prepare(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"), id_remainder(F.col("doc_id"), 5) != 0)
    return quality.keep_good(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact.unique_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return neardup.one_of_each(docs, NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), keep_columns=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(packing.cut(docs, tokenizer_file(), END_ID, SEQUENCE), SEQUENCE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", reject_bad),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pack", pack),
]

# Tokenizing, learning and packing are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
