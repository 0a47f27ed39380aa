"""Property graphs as vertex, property and edge tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vertex_table(vertices: DataFrame, key: str, label: Column, properties: Sequence[str]) -> DataFrame:
    """Id, label and the first value of each (list) property."""
    return vertices.select(F.col(key).alias("vertex_id"), label.alias("vertex_label"),
                           *[F.get(p, F.lit(0)).alias(p) for p in properties])


def property_table(vertices: DataFrame, key: str, properties: Sequence[str]) -> DataFrame:
    """All values of the properties that have more than one, with their index."""
    lists = F.array(*[F.struct(F.lit(p).alias("property_key"), F.col(p).cast("array<string>").alias("v")) for p in properties])
    rows = vertices.select(F.col(key).alias("vertex_id"), F.inline(lists)).filter(F.size("v") > 1)
    return rows.select("vertex_id", "property_key", F.posexplode("v").alias("property_index", "property_value"))


def edge_table(edges: DataFrame, key: str, label: Column, source: str, target: str, properties: Sequence[str] = ()) -> DataFrame:
    """Id, label, both vertices and the properties of each edge; an edge without one of its vertices stays, with NULL there."""
    return edges.select(F.col(key).alias("edge_id"), label.alias("edge_label"), F.col(source).alias("out_vertex_id"), F.col(target).alias("in_vertex_id"),
                        *[F.col(p) for p in properties])
