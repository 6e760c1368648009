"""Optional predicates: a missing parameter lets every row pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.functions.text import is_blank
from footfall.functions.times import DAY_MS, day_start_ms

# Event codes of the log, and the form of a member id.
KNOWN_EVENTS = ["e_l", "e_pv", "e_crt", "e_cs", "e_cr", "e_e"]
MEMBER_ID = "^[0-9a-zA-Z]{1,32}$"


def _all() -> Column:
    return F.lit(True)


def between_optional(c: Column, low: int | None, high: int | None) -> Column:
    if low is None or high is None:
        return _all()
    return F.coalesce(c.between(low, high), F.lit(False))


def overlaps_optional(csv: Column, wanted: Sequence[str] | None) -> Column:
    """True when a value of the comma list ``csv`` is among ``wanted``."""
    if not wanted:
        return _all()
    # a plain equality on single values stays pushable; the split handles lists
    hit = F.arrays_overlap(F.split(csv, ","), F.array(*[F.lit(w) for w in wanted]))
    return F.coalesce(hit, F.lit(False))


def isin_optional(c: Column, wanted: Sequence[str] | None) -> Column:
    if not wanted:
        return _all()
    return F.coalesce(c.isin(list(wanted)), F.lit(False))


def equal_optional(c: Column, value: str | None) -> Column:
    if value is None:
        return _all()
    return F.coalesce(c == value, F.lit(False))


def not_blank(*cols: str) -> Column:
    cond = _all()
    for c in cols:
        cond = cond & ~is_blank(F.col(c))
    return cond


def numeric_text(c: Column) -> Column:
    return F.coalesce(F.trim(c).rlike("^[0-9]+$"), F.lit(False))


def usable_record(*required: str, time: str = "s_time", time_is_text: bool = False) -> Column:
    """Required fields are filled and the server time is a number."""
    timed = numeric_text(F.col(time)) if time_is_text else F.coalesce(F.col(time) >= 0, F.lit(False))
    return not_blank(*required) & timed


def epoch_day(c: Column, first: str, last: str | None = None) -> Column:
    """Half-open range of whole days on a millisecond column."""
    return (c >= day_start_ms(first)) & (c < day_start_ms(last or first) + DAY_MS)


def known_event(c: Column) -> Column:
    return F.coalesce(c.isin(KNOWN_EVENTS), F.lit(False))


def valid_member_id(c: Column) -> Column:
    return F.coalesce(F.trim(c).rlike(MEMBER_ID), F.lit(False))


def session_condition(
    start_age: int | None = None,
    end_age: int | None = None,
    professionals: Sequence[str] | None = None,
    cities: Sequence[str] | None = None,
    sex: str | None = None,
    keywords: Sequence[str] | None = None,
    category_ids: Sequence[str] | None = None,
) -> Column:
    """Conjunction of all session conditions of a task."""
    return (
        between_optional(F.col("age"), start_age, end_age)
        & isin_optional(F.col("professional"), professionals)
        & isin_optional(F.col("city"), cities)
        & equal_optional(F.col("sex"), sex)
        & overlaps_optional(F.col("search_keywords"), keywords)
        & overlaps_optional(F.col("click_category_ids"), category_ids)
    )
