"""Number helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(n: Column, d: Column) -> Column:
    return F.call_function("div", n, d)


def ratio2(n: Column, d: Column) -> Column:
    """n/d for non-negative integers, rounded half up to two decimals.

    Integer arithmetic, so the result does not depend on how an engine rounds
    binary fractions.  Null when d is 0.
    """
    d = F.nullif(d.cast("bigint"), F.lit(0).cast("bigint"))
    n = n.cast("bigint")
    return int_div(n * 200 + d, d * 2) / F.lit(100.0)


def cents(c: Column) -> Column:
    """A two-decimal amount as whole cents: sums stay exact in any order."""
    return F.round(c * 100).cast("bigint")


def ceil_div(n: Column, d: int) -> Column:
    return int_div(n + (d - 1), F.lit(d).cast("bigint"))
