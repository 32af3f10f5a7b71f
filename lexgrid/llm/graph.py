"""Connected components for the near-duplicate operators (the library's own, under the names used here)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lexgrid.operators.components import connected_components


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node, component_id`` (smallest node reachable) of every node on an edge."""
    return connected_components(edges, src, dst).withColumnRenamed("component", "component_id")
