"""Dimension levels, surrogate keys and the date dimension."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.text import is_blank
from footfall.functions.times import week_of_year_us, week_start_sunday
from footfall.functions.web import UNKNOWN
from footfall.operators.skew import numbered
from footfall.session import materialize
from footfall.sinks.tables import current, publish, replace_partitions

ALL = "all"

# Which columns stay at each level of a dimension; the others become 'all'.
PLATFORM = [["platform"], []]
BROWSER = [["browser", "browser_version"], ["browser"]]
LOCATION = [["country", "province", "city"], ["country", "province"], ["country"]]


def _or_unknown(c: Column) -> Column:
    return F.when(is_blank(c), UNKNOWN).otherwise(c)


def clean_platform(pl: str = "pl") -> Column:
    return _or_unknown(F.col(pl)).alias("platform")


def clean_browser(name: str = "browser", version: str = "browser_v") -> list[Column]:
    blank = is_blank(F.col(name))
    v = F.col(version)
    return [
        _or_unknown(F.col(name)).alias("browser"),
        F.when(blank | v.isNull() | (v == ""), UNKNOWN).otherwise(v).alias("browser_version"),
    ]


def clean_location(country: str = "country", province: str = "province", city: str = "city") -> list[Column]:
    no_country = is_blank(F.col(country)) | (F.col(country) == UNKNOWN)
    no_province = no_country | is_blank(F.col(province)) | (F.col(province) == UNKNOWN)
    return [
        F.when(no_country, UNKNOWN).otherwise(F.col(country)).alias("country"),
        F.when(no_province, UNKNOWN).otherwise(F.col(province)).alias("province"),
        F.when(no_province | is_blank(F.col(city)), UNKNOWN).otherwise(F.col(city)).alias("city"),
    ]


def level_sets(*dimensions: Sequence[Sequence[str]], always: Sequence[str] = ()) -> list[list[str]]:
    """Every combination of one level per dimension, as grouping sets."""
    sets: list[list[str]] = [list(always)]
    for levels in dimensions:
        sets = [s + list(level) for s in sets for level in levels]
    return sets


def rolled_up(df: DataFrame, sets: Sequence[Sequence[str]], rolled: Sequence[str], *aggs: Column) -> DataFrame:
    """Grouping sets whose absent ``rolled`` columns read ``all``."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    missing = [c for c in rolled if c not in columns]
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        *aggs, *[F.grouping(c).alias(f"_g_{c}") for c in rolled if c in columns]
    )
    out = [
        F.when(F.col(f"_g_{c}") == 1, ALL).otherwise(F.col(c)).alias(c) if c in rolled else F.col(c)
        for c in columns
    ]
    measures = [c for c in grouped.columns if c not in columns and not c.startswith("_g_")]
    return grouped.select(*out, *[F.lit(ALL).alias(c) for c in missing], *measures)


def with_new_ids(dimension: DataFrame, values: DataFrame, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """The dimension plus a new id for every value combination it lacks.

    New ids continue after the largest one, in the order of the values, so two
    runs over the same data agree.  Numbering is distributed (``numbered``).
    """
    keys = list(keys)
    known = dimension.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    # null is a value like others: it gets one id, and a second run finds it
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys])
    new = values.select(*keys).distinct().join(known, same, "left_anti")
    top = dimension.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    added = numbered(new, keys, "_rn").select(
        (F.col("_rn") + top).cast("bigint").alias(id_col), *keys
    )
    return dimension.select(F.col(id_col).cast("bigint").alias(id_col), *keys).unionByName(added)


def with_dimension_id(facts: DataFrame, dimension: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Replace the value columns ``keys`` of the facts by the dimension id; null finds null."""
    ids = dimension.select(F.col("id").alias(name), *[F.col(k).alias(f"_dim_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_dim_{k}")) for k in keys])
    return facts.join(ids, same, "left").drop(*keys, *[f"_dim_{k}" for k in keys])


def store_dimension(values: DataFrame, root: str, keys: Sequence[str]) -> DataFrame:
    """The stored dimension with an id for every combination in ``values``; new ones are published first."""
    keys = list(keys)
    spark = values.sparkSession
    schema = T.StructType([T.StructField("id", T.LongType()), *values.select(*keys).schema.fields])
    known = current(spark, root, schema)
    whole = materialize(with_new_ids(known, values, keys), "dimension")
    if whole.count() > known.count():
        publish(whole, root)
    return current(spark, root, schema)


def store_facts(facts: DataFrame, root: str, dimensions: dict[str, Sequence[str]], run_by: str) -> None:
    """Facts keyed by dimension ids instead of values; both are stored below ``root``.

    ``dimensions`` maps the name of an id to the columns it stands for.  A run
    replaces the facts it has computed before (same ``run_by`` id).
    """
    facts = materialize(facts, "facts")  # ids and facts must see the same rows
    for name, keys in dimensions.items():
        facts = with_dimension_id(facts, store_dimension(facts, f"{root}/{name}", keys), keys, name)
    replace_partitions(facts, f"{root}/facts", [run_by])


def stored_facts(spark: SparkSession, root: str) -> DataFrame:
    facts = spark.read.parquet(f"{root}/facts")
    return facts.select(*[F.col(c).cast("bigint").alias(c) if c.endswith("_id") else F.col(c) for c in facts.columns])


def date_dimension(first_last: DataFrame) -> DataFrame:
    """Rows for every year, season, month, week and day between ``first`` and
    ``last`` (one-row frame of dates).  Unused parts are 0.

    Weeks start on Sunday.  A December day or week in week 1 of the next year
    counts as week 53.
    """
    day = F.col("d")
    week_day = week_start_sunday(day)
    zero = F.lit(0)

    def week(c: Column) -> Column:
        n = week_of_year_us(c)
        return F.when((F.month(c) == 12) & (n == 1), 53).otherwise(n)

    def row(kind: str, year, season, month, wk, dom, calendar) -> Column:
        return F.struct(
            year.cast("bigint").alias("year"),
            season.cast("bigint").alias("season"),
            month.cast("bigint").alias("month"),
            wk.cast("bigint").alias("week"),
            dom.cast("bigint").alias("day"),
            F.lit(kind).alias("type"),
            calendar.cast("date").cast("string").alias("calendar"),
        )

    y, s, m = F.year(day), F.quarter(day), F.month(day)
    days = first_last.select(F.explode(F.sequence("first", "last")).alias("d"))
    rows = F.array(
        row("year", y, zero, zero, zero, zero, F.trunc(day, "year")),
        row("season", y, s, zero, zero, zero, F.trunc(day, "quarter")),
        row("month", y, s, m, zero, zero, F.trunc(day, "month")),
        row(
            "week", F.year(week_day), F.quarter(week_day), F.month(week_day), week(week_day), zero, week_day
        ),
        row("day", y, s, m, week(day), F.dayofmonth(day), day),
    )
    return days.select(F.explode(rows).alias("r")).select("r.*").distinct()


def calendar_days(first_last: DataFrame) -> DataFrame:
    """One row per day after ``first`` up to ``last`` with calendar attributes."""
    day = F.col("d")
    y, m = F.year(day).cast("string"), F.month(day)
    prev_half = F.when(m <= 6, F.concat(F.year(day) - 1, F.lit("-12"))).otherwise(F.concat(y, F.lit("-06")))
    next_half = F.when(m <= 6, F.concat(y, F.lit("-12"))).otherwise(F.concat(F.year(day) + 1, F.lit("-06")))
    quarter_end = F.add_months(F.trunc(day, "quarter"), 2)
    half_start = F.add_months(F.trunc(day, "year"), F.when(m <= 6, 0).otherwise(6))

    def months_from(first: Column, n: int) -> Column:
        return F.concat_ws(",", *[F.date_format(F.add_months(first, i), "yyyy-MM") for i in range(n)])

    days = first_last.select(
        F.explode(F.sequence(F.date_add("first", 1), F.col("last"))).alias("d")
    )
    text = lambda c: c.cast("string")
    return days.select(
        text(day).alias("day"),
        F.date_format(day, "yyyy-MM").alias("month"),
        text(F.trunc(day, "month")).alias("month_first_day"),
        text(F.last_day(day)).alias("month_last_day"),
        F.dayofmonth(F.last_day(day)).cast("bigint").alias("days_in_month"),
        F.quarter(day).cast("bigint").alias("season"),
        (F.quarter(day) * 3).cast("bigint").alias("season_end_month"),
        F.when(m <= 6, "06").otherwise("12").alias("half_year_end_month"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        text(F.trunc(day, "week")).alias("week_monday"),
        text(F.date_sub(day, 1)).alias("last_day_value"),
        text(F.date_add(day, 1)).alias("next_day_value"),
        F.date_format(F.add_months(F.trunc(day, "month"), -1), "yyyy-MM").alias("last_month"),
        F.date_format(F.add_months(F.trunc(day, "month"), 1), "yyyy-MM").alias("next_month"),
        (F.year(day) - 1).cast("string").alias("last_year"),
        F.date_format(F.add_months(quarter_end, -3), "yyyy-MM").alias("last_season"),
        prev_half.alias("last_half_year"),
        (F.year(day) + 1).cast("string").alias("next_year"),
        F.date_format(F.add_months(quarter_end, 3), "yyyy-MM").alias("next_season"),
        next_half.alias("next_half_year"),
        months_from(F.trunc(day, "quarter"), 3).alias("season_months"),
        months_from(half_start, 6).alias("half_year_months"),
    )


def calendar_months(first_last: DataFrame) -> DataFrame:
    """Months after that of ``first`` while the running date is before ``last``."""
    return first_last.select(
        F.explode(
            F.sequence(
                F.add_months("first", 1), F.add_months("last", 1), F.expr("interval 1 month")
            )
        ).alias("d"),
        "last",
    ).where(F.add_months("d", -1) < F.col("last")).select(F.date_format("d", "yyyy-MM").alias("month"))
