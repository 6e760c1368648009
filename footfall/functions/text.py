"""String and packed-field helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "|"


def is_empty(c: Column) -> Column:
    return c.isNull() | (c == "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def trim_comma(c: Column) -> Column:
    """Drop one leading and one trailing comma."""
    return F.regexp_replace(F.regexp_replace(c, "^,", ""), ",$", "")


def pad2(c: Column) -> Column:
    return F.when(F.length(c) == 2, c).otherwise(F.concat(F.lit("0"), c))


def _fields(packed: Column) -> Column:
    return F.split(packed, "\\|")


def get_field(packed: Column, name: str) -> Column:
    """Value of ``name`` in ``k=v|k=v``; null if absent or empty."""
    hit = F.filter(
        _fields(packed),
        lambda f: (F.substring_index(f, "=", 1) == name)
        & (F.size(F.split(f, "=")) == 2)
        & (F.element_at(F.split(f, "="), 2) != ""),
    )
    return F.split(F.get(hit, 0), "=").getItem(1)


def set_field(packed: Column, name: str, value: Column) -> Column:
    """Replace the value of ``name``; the other fields keep their order."""
    return F.array_join(
        F.transform(
            _fields(packed),
            lambda f: F.when(
                F.substring_index(f, "=", 1) == name, F.concat(F.lit(f"{name}="), value)
            ).otherwise(f),
        ),
        SEPARATOR,
    )


def distinct_list(c: Column) -> Column:
    """Aggregate: sorted distinct values joined with commas ('' when none)."""
    return F.array_join(F.array_sort(F.collect_set(c)).cast("array<string>"), ",")


def parse_or_zero(c: Column) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def fingerprint(*cols: Column) -> Column:
    return F.md5(F.concat_ws("\x1f", *cols))


def salted(c: Column, n: int, spread: Column) -> Column:
    """``<0..n-1>_value``; the number follows ``spread`` and is stable on retries."""
    return F.concat(F.pmod(F.xxhash64(spread), F.lit(n)).cast("string"), F.lit("_"), c.cast("string"))


def unsalted(c: Column) -> Column:
    return F.regexp_replace(c, "^[0-9]+_", "")
