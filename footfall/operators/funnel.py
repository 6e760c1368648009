"""Page funnels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.numbers import ratio2
from footfall.functions.times import epoch_ms
from footfall.operators.skew import HOT_ROWS, sliced_neighbour, time_sliced


def _steps(actions: DataFrame, hot_rows: int) -> DataFrame:
    """Every page view with the page before it in its session (null for the first).

    A view without a session is a session of its own: it counts as a view and
    takes part in no step.
    """
    own = F.concat(F.lit("\x01"), F.coalesce(F.col("event_id").cast("string"), F.lit("")))
    session = F.coalesce("session_id", own).alias("session_id")
    views = actions.select(session, "page_id", "action_time", "event_id")
    sliced = time_sliced(views, ["session_id"], epoch_ms("action_time"), hot_rows=hot_rows)
    return sliced_neighbour(
        sliced, ["session_id"], "_slice", ["action_time", "event_id"], {"page_id": "prev_page"}
    ).drop("_slice")


def transitions(actions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Consecutive pages of a session as (session_id, prev_page, page_id).

    Sessions are cut into time slices where needed, so one endless session does
    not end up in one task; the step across a border comes from the
    neighbouring slice.
    """
    return _steps(actions, hot_rows).where(F.col("prev_page").isNotNull())


def flow_pairs(flow: Sequence[int]) -> list[tuple[int, int]]:
    return list(zip(flow, flow[1:]))


def page_splits(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Views of each step ``a_b`` of the flow; a step nobody took is missing."""
    wanted = F.lit(False)
    for a, b in dict.fromkeys(flow_pairs(flow)):
        wanted = wanted | ((F.col("prev_page") == a) & (F.col("page_id") == b))
    return (
        transitions(actions)
        .where(wanted)
        .groupBy(F.concat_ws("_", "prev_page", "page_id").alias("page_split"))
        .agg(F.count(F.lit(1)).alias("pv"))
    )


def start_page_views(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    return actions.where(F.col("page_id") == flow[0]).agg(F.count(F.lit(1)).alias("start_pv"))


def conversion_rates(actions: DataFrame, flow: Sequence[int], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rate of each step: its views over those of the step before.

    The first step is measured against the views of the first page.  A step
    that never happened counts 0; a rate over 0 is null.
    """
    pairs = flow_pairs(flow)
    names = ["start"] + [f"{a}_{b}" for a, b in pairs]
    page, before = F.col("page_id"), F.col("prev_page")
    hits = [page == flow[0]] + [(before == a) & (page == b) for a, b in pairs]
    # one pass and one row with a column per step: the flow is a short parameter
    row = _steps(actions, hot_rows).agg(*[F.count_if(hit).alias(f"s{i}") for i, hit in enumerate(hits)])
    steps = F.array(*[
        F.struct(
            F.lit(i).cast("bigint").alias("step"),
            F.lit(names[i]).alias("page_split"),
            F.col(f"s{i}").alias("pv"),
            ratio2(F.col(f"s{i}"), F.col(f"s{i - 1}")).alias("rate"),
        )
        for i in range(1, len(names))
    ])
    return row.select(F.explode(steps).alias("r")).select("r.*")


def rates_text(rates: DataFrame) -> DataFrame:
    """The rates as one text ``a_b=r|b_c=r`` in flow order."""
    item = F.struct("step", F.concat_ws("=", "page_split", F.col("rate").cast("string")).alias("t"))
    ordered = F.array_sort(F.collect_list(item))
    return rates.agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "|").alias("convert_rate"))
