"""Exact duplicates: grouped by a 128-bit content hash, compared byte by byte.

Rows are grouped by hash and text together, so only identical bytes share a
group and a hash collision cannot join two texts.  The hash comes first in the
key: Spark compares sixteen bytes before it compares texts.  Map tasks reduce
copies before the shuffle, so a group of any size sends one row per task.

Null text counts as empty text.  Of equal texts the row with the largest id
stays; a null id is smaller than any other.  Rows that repeat id and text are
one document: they count in ``group_size``, all report the same result, and
``unique_rows`` returns one of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import quoted
from footfall.session import materialize


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def duplicate_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = hash128,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    keyed = docs.select(
        quoted(id_col).alias("doc_id"),
        F.coalesce(quoted(text_col), F.lit("")).alias("text"),
    ).withColumn("h", digest(F.col("text")))
    classes = keyed.groupBy("h", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    facts = [
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
        F.col("keep_id"),
        F.col("group_size"),
    ]
    # One narrow row per hash; texts go no further than this.
    per_hash = materialize(
        classes.select("h", F.struct(*facts).alias("fact"))
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("texts"), F.any_value("fact").alias("fact")),
        "exact-groups",
    )
    rows = keyed.select("doc_id", "h").join(
        per_hash.filter("texts = 1").select("h", "fact"), "h"
    ).select("doc_id", "fact")
    collided = per_hash.filter("texts > 1").select("h")
    if not collided.isEmpty():  # different texts under one hash: told apart by their bytes
        members = keyed.join(collided, "h")
        exact = members.groupBy("h", "text").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        ).select("h", "text", F.struct(*facts).alias("fact"))
        rows = rows.unionByName(members.join(exact, ["h", "text"]).select("doc_id", "fact"))
    return rows.select(
        "doc_id",
        F.col("fact.keep_id"),
        F.col("fact.group_size"),
        F.col("doc_id").eqNullSafe(F.col("fact.keep_id")).alias("kept"),
        F.col("fact.text_sha256"),
    )


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def unique_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with the columns of ``docs`` and nothing else.

    One pass, one shuffle: the group carries the other columns of its largest
    row along.  Rows equal in id and text are told apart by their other
    columns, so a repeated task keeps the same one.
    """
    text = quoted(text_col)
    others = [f for f in docs.schema.fields if f.name != text_col]
    rest = F.struct(
        text.isNull().alias("none"),
        *(quoted(f.name).alias(f"c{i}") for i, f in enumerate(others)),
    )
    order = F.struct(
        quoted(id_col).alias("id"),
        *(
            quoted(f.name).alias(f"o{i}")
            for i, f in enumerate(others)
            if f.name != id_col and _orderable(f.dataType)
        ),
        text.isNotNull().alias("some"),
    )
    body = F.coalesce(text, F.lit(""))
    kept = (
        docs.select(hash128(body).alias("h"), body.alias("t"), rest.alias("rest"), order.alias("order"))
        .groupBy("h", "t")
        .agg(F.max_by("rest", "order").alias("rest"))
    )
    place = {f.name: i for i, f in enumerate(others)}
    return kept.select(
        *(
            (F.when(~F.col("rest.none"), F.col("t")) if name == text_col else F.col(f"rest.c{place[name]}")).alias(name)
            for name in docs.columns
        )
    )
