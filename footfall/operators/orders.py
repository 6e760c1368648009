"""Order, event and view-depth reports."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.times import ms_date
from footfall.operators.dims import rolled_up
from footfall.operators.joins import with_order_info
from footfall.operators.kpi import dense_running_total, reported

CREATED, PAID, REFUNDED = "e_crt", "e_cs", "e_cr"
KEYS = ["pl", "cut", "pt"]


def _cube(keys: Sequence[str], always: Sequence[str]) -> list[list[str]]:
    return [
        list(always) + [k for k, keep in zip(keys, kept) if keep]
        for kept in product([True, False], repeat=len(keys))
    ]


CUBE = _cube(KEYS, ["date"])


def _dated(events: DataFrame, event: str) -> DataFrame:
    return events.where((F.col("en") == event) & F.col("pl").isNotNull()).withColumn(
        "date", ms_date(F.col("s_time"))
    )


def _orders(events: DataFrame, event: str, order_info: DataFrame | None) -> DataFrame:
    """One row per order and day with its dimensions and amount.

    Duplicate records of an order are folded before the dimensions are joined.
    Created orders carry their own dimensions; paid and refunded ones take
    them from the order table.
    """
    dated = _dated(events, event)
    if order_info is None:
        return dated.groupBy("date", *KEYS, "oid").agg(F.max("cua").alias("amount"))
    once = dated.select("oid", "date").distinct()
    return with_order_info(once, order_info)


def order_info_rows(events: DataFrame) -> DataFrame:
    """Order table rows from the creation records: the latest record of each order."""
    created = events.where((F.col("en") == CREATED) & F.col("pl").isNotNull() & F.col("oid").isNotNull())
    info = created.select(
        F.col("oid").alias("order_id"),
        F.struct(
            "s_time",
            F.col("pl").alias("platform"),
            F.col("cut").alias("currency_type"),
            F.col("pt").alias("payment_type"),
            F.col("cua").alias("amount"),
        ).alias("_last"),
    )
    # the largest struct: the latest record, ties by its other columns
    last = info.groupBy("order_id").agg(F.max("_last").alias("_last"))
    return last.select(
        "order_id", "_last.platform", "_last.s_time", "_last.currency_type", "_last.payment_type", "_last.amount"
    )


def base_counts(events: DataFrame, event: str = CREATED, order_info: DataFrame | None = None) -> DataFrame:
    per_order = _orders(events, event, order_info)
    return reported(per_order.groupBy("date", *KEYS).agg(F.count("oid").alias("orders")))


def base_amounts(events: DataFrame, event: str = CREATED, order_info: DataFrame | None = None) -> DataFrame:
    per_order = _orders(events, event, order_info)
    return reported(per_order.groupBy("date", *KEYS).agg(F.sum("amount").alias("amount")))


def cubed(base: DataFrame, value: str) -> DataFrame:
    """The base rows and the sums over every subset of (pl, cut, pt).

    Counts are added up, not recounted: an order under two platforms counts
    twice in the row of all platforms.
    """
    return rolled_up(base, CUBE, KEYS, F.sum(value).alias(value))


def order_counts(events: DataFrame, event: str = CREATED, order_info: DataFrame | None = None) -> DataFrame:
    return cubed(base_counts(events, event, order_info), "orders")


def order_amounts(events: DataFrame, event: str = CREATED, order_info: DataFrame | None = None) -> DataFrame:
    return cubed(base_amounts(events, event, order_info), "amount")


def amount_to_date(events: DataFrame, event: str, order_info: DataFrame, name: str) -> DataFrame:
    """Running total of the paid or refunded amount, 'all' rows included."""
    last = _dated(events, event).agg(F.max("date")).scalar()  # no order leaves the cube
    return dense_running_total(order_amounts(events, event, order_info), KEYS, "amount", name, last=last)


def event_counts(logs: DataFrame) -> DataFrame:
    """Event counts by category and action with the coarser rows as 'all'."""
    base = (
        logs.where((F.col("en") == "e_e") & F.col("pl").isNotNull())
        .groupBy("pl", ms_date(F.col("s_time")).alias("date"), "ca", "ac")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    sets = [
        ["pl", "date", "ca", "ac"],
        ["date", "ca", "ac"],
        ["pl", "date", "ca"],
        ["date", "ca"],
        ["pl", "date"],
        ["date"],
    ]
    return reported(rolled_up(base, sets, ["pl", "ca", "ac"], F.sum("_n").alias("times")))


# Half-open depth buckets [low, high).
VIEW_DEPTH = {
    "pv1": (1, 2),
    "pv2": (2, 3),
    "pv3": (3, 4),
    "pv4": (4, 5),
    "pv5_10": (5, 10),
    "pv10_30": (10, 30),
    "pv30_60": (30, 60),
    "pv60_plus": (60, None),
}


def _in_bucket(n: Column, low: int, high: int | None) -> Column:
    return (n >= low) if high is None else ((n >= low) & (n < high))


def view_depth(logs: DataFrame, id_col: str) -> DataFrame:
    """Users (``u_ud``) or sessions (``u_sd``) by number of page views, per
    platform and, added up, for all platforms."""
    n = F.col("n")
    per_id = (
        logs.where(
            (F.col("en") == "e_pv")
            & F.col("p_url").isNotNull()
            & F.col("pl").isNotNull()
            & F.col(id_col).isNotNull()
        )
        .groupBy("pl", ms_date(F.col("s_time")).alias("date"), id_col)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_platform = per_id.groupBy("pl", "date").agg(*[
        F.count_if(_in_bucket(n, low, high)).alias(name) for name, (low, high) in VIEW_DEPTH.items()
    ])
    return reported(
        rolled_up(per_platform, [["pl", "date"], ["date"]], ["pl"], *[F.sum(c).alias(c) for c in VIEW_DEPTH])
    )
