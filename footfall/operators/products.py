"""Product popularity by area."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.joins import click_with_city, with_product
from footfall.operators.skew import top_per_group

# Level of each area; every other area is in the last level.
AREA_LEVELS = {
    "A Level": ["China North", "China East"],
    "B Level": ["China South", "China Middle"],
    "C Level": ["West North", "West South"],
}
OTHER_LEVEL = "D Level"


def area_level(area: Column, levels: Mapping[str, Sequence[str]] = AREA_LEVELS) -> Column:
    expr = None
    for level, areas in levels.items():
        cond = area.isin(list(areas))
        expr = F.when(cond, level) if expr is None else expr.when(cond, level)
    return F.lit(OTHER_LEVEL) if expr is None else expr.otherwise(OTHER_LEVEL)


def product_clicks_by_city(actions: DataFrame) -> DataFrame:
    """Clicks per (city, product): the only shuffle that depends on the rows."""
    return (
        actions.where(F.col("click_product_id").isNotNull())
        .groupBy("city_id", F.col("click_product_id").alias("product_id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def area_product_clicks(actions: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks and the cities they came from per (area, product)."""
    located = click_with_city(product_clicks_by_city(actions), cities)
    return located.groupBy("area", "product_id").agg(
        F.sum("n").alias("click_count"),
        F.array_join(
            F.array_sort(F.collect_set(F.concat_ws(":", F.col("city_id"), F.col("city_name")))), ","
        ).alias("city_infos"),
    )


def top_products_by_area(
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    k: int = 3,
    levels: Mapping[str, Sequence[str]] = AREA_LEVELS,
) -> DataFrame:
    full = with_product(area_product_clicks(actions, cities), products)
    best = top_per_group(full, ["area"], [F.desc("click_count"), F.asc("product_id")], k)
    return best.select(
        "area",
        area_level(F.col("area"), levels).alias("area_level"),
        "product_id",
        "click_count",
        "city_infos",
        "product_name",
        "product_status",
        F.col("rank").cast("bigint").alias("rank"),
    )
