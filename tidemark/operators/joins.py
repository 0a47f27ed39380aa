"""Lookups, parent and child selection, graph joins.

No side carries a broadcast hint: Catalyst broadcasts a side by its size
against the session limit and AQE splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise


def look_up(df: DataFrame, codes: DataFrame, code: str, title: str, prefix: str = "col_", name: str = "title") -> DataFrame:
    """Title of a code, else ``<prefix><code>``. ``codes`` has one row per code."""
    small = codes.select(F.col(code).alias("_code"), F.col(title).alias("_title"))
    return (df.join(small, F.col(code) == F.col("_code"), "left")
            .withColumn(name, F.coalesce("_title", F.concat(F.lit(prefix), F.col(code).cast("string"))))
            .drop("_code", "_title"))


def three_way(mapped: Column, found: Column, defaults: dict[str, tuple[object, Column]]) -> list[Column]:
    """Per column: a fixed value without a mapping, NULL without a result, else the value."""
    return [F.when(~mapped, F.lit(fixed)).when(found, value).alias(name) for name, (fixed, value) in defaults.items()]


def newer_children(children: DataFrame, marks: DataFrame, parent: str, time: str, mark: str = "mark") -> DataFrame:
    """Child rows newer than their parent's own mark; a parent without a mark gives all of them.

    ``marks`` has one row per parent.
    """
    limits = marks.select(F.col(parent).alias("_parent"), F.col(mark).alias("_mark"))
    joined = children.join(limits, F.col(parent) == F.col("_parent"), "left")
    return joined.filter(F.col("_mark").isNull() | (F.col(time) > F.col("_mark"))).drop("_parent", "_mark")


def pattern_pairs(vertices: DataFrame, edges: DataFrame, key: str, label: str) -> DataFrame:
    """Attributes of both ends of each edge: two equi joins through the edge table."""
    a = vertices.select(F.col(key).alias("from_id"), F.col(label).alias("from_label"))
    b = vertices.select(F.col(key).alias("to_id"), F.col(label).alias("to_label"))
    return edges.join(a, "from_id").join(b, "to_id")


def open_combinations(bounds: DataFrame, start: str, end: str, types: DataFrame, kind: str, marks: DataFrame,
                      mark: str = "mark", day: str = "day") -> DataFrame:
    """(day, type) combinations after the type's mark.

    Each type explodes its own days, so the grid is never joined without a key; ``bounds`` is one row.
    """
    lo, hi = bounds.select(F.col(start).cast("date")).scalar(), bounds.select(F.col(end).cast("date")).scalar()
    with_marks = types.join(marks.select(F.col(kind), F.col(mark).alias("_mark")), kind, "left")
    first = F.greatest(lo, F.coalesce(F.date_add("_mark", 1), lo))
    return (with_marks.filter(first <= hi)
            .select(kind, F.explode(F.sequence(first, hi, F.expr("INTERVAL 1 DAY"))).alias(day)))


def expand_frontier(seed: DataFrame, links: DataFrame, hops: int, step_limit: int | None = None) -> DataFrame:
    """Ids reached from the seeds over an undirected two-column link table ``(item, via)``, with their hop.

    A hop goes item to via to item; ids seen before (seeds included) are never taken again. With
    ``step_limit`` each hop keeps that many new ids, most linked first, then by id. The new ids of
    each hop are written out once, so the plan grows by one scan a hop and ids seen before are not written again.
    """
    frontier = visited = materialise(seed.select("item").distinct().withColumn("hop", F.lit(0)), "hop")
    for hop in range(1, hops + 1):
        vias = links.join(frontier.select("item"), "item").select("via").distinct()
        reached = (links.join(vias, "via").join(visited, "item", "left_anti")
                   .groupBy("item").agg(F.count("*").alias("links")))
        if step_limit is not None:
            reached = reached.orderBy(F.desc("links"), "item").limit(step_limit)
        frontier = materialise(reached.select("item", F.lit(hop).alias("hop")), "hop")
        visited = visited.unionByName(frontier)
    return visited


def paired(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that both sides have."""
    return left.join(right, list(keys), "inner")
