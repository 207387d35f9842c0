"""Road network assessment: edges with centrality and class, statistics and the bearing rose, from one network table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.operators import centrality, graph
from citygrain.operators.spatial import straight_edges
from citygrain.scale import join_on


class RoadNetwork(NamedTuple):
    """``edges`` carry road_type and edge_centrality in percent; ``statistics`` has one row a network, ``rose`` one a sector."""

    edges: DataFrame
    statistics: DataFrame
    rose: DataFrame


def assess(nodes: DataFrame, edges: DataFrame, by: Sequence[str] = ("city",), sectors: int = 36,
           sources: int | None = None) -> RoadNetwork:
    """Nodes (node, x, y in degrees) and edges (u, v, length, highway) of every city to the tables of a road assessment.

    Betweenness is searched once; edges, the mean of the statistics and parallel edges share it. Self-loops
    have no centrality. The mean is that of distinct pairs of nodes, in percent like the edges.
    """
    by = list(by)
    scores = centrality.betweenness(edges, "edge", sources, by=by)
    scored = join_on(edges, scores.select(*by, "u", "v", F.col("centrality").alias("edge_centrality")), [*by, "u", "v"], "left")
    means = scores.groupBy(*by).agg((F.max("mean_centrality") * 100).alias("mean_centrality"))
    statistics = graph.network_stats(nodes, edges, by)
    if by:
        statistics = join_on(statistics, means, by, "left")
    else:
        # two tables of one row
        statistics = join_on(statistics.withColumn("_one", F.lit(1)), means.withColumn("_one", F.lit(1)), ["_one"], "left").drop("_one")
    ends = straight_edges(edges.select(*by, "u", "v"), nodes, by)
    ends = ends.withColumnsRenamed({"x1": "lon1", "y1": "lat1", "x2": "lon2", "y2": "lat2"})
    return RoadNetwork(graph.road_type(scored), statistics, graph.bearing_rose(ends, sectors, by))
