"""Connected components of an edge table, without ever gathering it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.session import materialize


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """node, label: the smallest node reachable, for all nodes that ``edges`` (a, b) or ``labels`` hold.

    Every node points to the smallest of its neighbours and itself, pointers
    are followed to their ends by doubling, and the links between the ends go
    on to the next turn.  Ends are at most half of the nodes, so turns are few
    and links soon gone.  ``labels`` continues an earlier result.  Self-links,
    repeated links and links with a null end do no harm.  Each step is a
    written table.
    """
    links = edges.filter("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    total = None
    if labels is not None:
        total = labels.select("node", "label")
        links = _mapped(links, total)
    links = _both_ways(links)
    while not links.isEmpty():
        ends = materialize(links.groupBy("a").agg(F.least("a", F.min("b")).alias("label")), "pointers")
        ends = ends.withColumnRenamed("a", "node")
        while True:
            over = ends.select(F.col("node").alias("over"), F.col("label").alias("next"))
            step = ends.join(over, F.col("label") == F.col("over"))
            step = step.select("node", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved"))
            step = materialize(step, "pointers")
            ends = step.select("node", "label")
            if step.filter("moved").isEmpty():
                break
        total = ends if total is None else _composed(total, ends)
        links = _both_ways(_mapped(links.filter("a < b"), ends))
    return total if total is not None else links.toDF("node", "label")


def _mapped(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between the labels of their ends; an end without a label stays."""
    return (
        links.join(labels.toDF("a", "la"), "a", "left")
        .join(labels.toDF("b", "lb"), "b", "left")
        .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    )


def _both_ways(links: DataFrame) -> DataFrame:
    """Links without repetition, written in one direction and read in both."""
    once = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    once = materialize(once, "links")
    return once.unionByName(once.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _composed(labels: DataFrame, ends: DataFrame) -> DataFrame:
    """Earlier labels followed to where these end, and the nodes that are new."""
    kept = labels.join(ends.toDF("label", "end"), "label", "left").select(
        "node", F.coalesce("end", "label").alias("label")
    )
    new = ends.join(labels.select("node"), "node", "left_anti")
    return materialize(kept.unionByName(new.select("node", "label")), "labels")
