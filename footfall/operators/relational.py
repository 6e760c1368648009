"""General relational operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.numbers import cents, int_div
from footfall.operators.skew import top_per_group


def word_count(lines: DataFrame, column: str) -> DataFrame:
    words = lines.select(F.explode(F.split(F.col(column), " ")).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def average_by_department(employees: DataFrame, departments: DataFrame, min_age: int = 20) -> DataFrame:
    """Average salary and age per department and gender of employees over ``min_age``.

    Sums per department id come first; names are joined to the few results.
    """
    per_id = (
        employees.where(F.col("age") > min_age)
        .groupBy("depId", "gender")
        .agg(
            F.sum(cents(F.col("salary"))).alias("_cents"),
            F.sum("age").alias("_age"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    named = per_id.join(departments, F.col("depId") == F.col("id"))
    grouped = named.groupBy(F.col("name").alias("department"), "gender").agg(
        F.sum("_cents").alias("_cents"), F.sum("_age").alias("_age"), F.sum("_n").alias("_n")
    )
    return grouped.select(
        "department",
        "gender",
        (F.col("_cents") / F.col("_n") / 100).alias("avg_salary"),
        (F.col("_age") / F.col("_n")).alias("avg_age"),
    )


def percent_of_total(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Each group's share of the total in whole percent, rounded half up."""
    groups = df.groupBy(*keys).agg(F.sum(value).alias(value))
    total = groups.agg(F.sum(value)).scalar()
    return groups.withColumn("percent", int_div(F.col(value) * 200 + total, total * 2))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``."""
    return top_per_group(df, keys, order, 1, "_rn").drop("_rn")


def both_sides(left: DataFrame, right: DataFrame, on: Column, names: tuple[str, str] = ("_1", "_2")) -> DataFrame:
    """Inner join that keeps each side as one struct."""
    l = left.select(F.struct(*left.columns).alias(names[0]))
    r = right.select(F.struct(*right.columns).alias(names[1]))
    return l.join(r, on)


def split_check(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """How often each key of the parts occurs over all parts, summed up."""
    tagged = parts[0].select(key)
    for part in parts[1:]:
        tagged = tagged.unionByName(part.select(key))
    return (
        tagged.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.sum("n").alias("rows_in_parts"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.count_if(F.col("n") > 1).alias("keys_in_two_parts"),
        )
    )
