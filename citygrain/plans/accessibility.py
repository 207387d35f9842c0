"""Accessibility assessment: places to walking zones, without intermediate files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.grid import Grid
from citygrain.operators import reach, shapes
from citygrain.operators.spatial import straight_edges
from citygrain.scale import join_on


def isochrone_footprints(edges: DataFrame, nodes: DataFrame, origins: DataFrame,
                         thresholds: Sequence[float] | Mapping[str, Sequence[float]], radius: float, grid: Grid,
                         carry: Sequence[str] = ("category",), fill: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Cells near the streets between reached nodes, per category and threshold, from one search.

    Thresholds can be given for each value of the first ``carry`` column; other values have no zones then. ``by`` names columns,
    such as the city, shared by edges, nodes and origins, that keep networks apart.
    """
    if isinstance(thresholds, Mapping):
        wanted = {float(t) for each in thresholds.values() for t in each}
        origins = origins.where(F.col(carry[0]).isin(*thresholds))
        reached = reach.isochrone_nodes(edges, origins, sorted(wanted), by=by, carry=carry)
        mine = F.lit(False)
        for name, limits in thresholds.items():
            mine = mine | ((F.col(carry[0]) == name) & F.col("threshold").isin(*[float(t) for t in limits]))
        reached = reached.where(mine)
    else:
        reached = reach.isochrone_nodes(edges, origins, thresholds, by=by, carry=carry)
    keys = [*by, *carry, "threshold"]
    here = reached.select(*keys, "node")
    # nodes are as many as the network has, whatever size a plan expects of them: they are dealt out, never sent to every task
    nodes = nodes.hint("merge")
    lines = straight_edges(edges.select(*by, "u", "v").distinct(), nodes, by)
    inside = join_on(lines, here.withColumnRenamed("node", "u"), [*by, "u"])
    inside = join_on(inside, here.withColumnRenamed("node", "v"), [*keys, "v"], "left_semi")
    spots = join_on(here, nodes, [*by, "node"]).select(
        *keys, F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2")
    )
    segments = inside.select(*keys, "x1", "y1", "x2", "y2").unionByName(spots)
    return shapes.footprint(segments, radius, grid, keys, fill)


def isochrone_bands(edges: DataFrame, nodes: DataFrame, origins: DataFrame,
                    thresholds: Sequence[float] | Mapping[str, Sequence[float]], radius: float, grid: Grid,
                    carry: Sequence[str] = ("category",), fill: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """The footprints with every cell in its smallest zone."""
    cells = isochrone_footprints(edges, nodes, origins, thresholds, radius, grid, carry, fill, by)
    return shapes.distance_bands(cells, [*by, *carry])


def zones_of_places(places: DataFrame, edges: DataFrame, nodes: DataFrame,
                    thresholds: Sequence[float] | Mapping[str, Sequence[float]], radius: float, grid: Grid,
                    category: str = "category", by: Sequence[str] = ("city",), fill: bool = False) -> DataFrame:
    """From places (x, y and their category) to zones: the nearest nodes that have a street, the search, the cells.

    A place without coordinates, or in a city without streets, has no zone.
    """
    used = edges.select(*by, F.explode(F.array("u", "v")).alias("node")).distinct()
    known = join_on(nodes, used, [*by, "node"], "left_semi")
    origins = reach.facility_nodes(places, known, [category], within=by)
    return isochrone_bands(edges, nodes, origins, thresholds, radius, grid, [category], fill, by)
