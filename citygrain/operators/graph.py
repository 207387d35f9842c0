"""Street-graph tables and edge attributes.

``nodes(node, x, y, ..)`` and ``edges(edge, u, v, length, highway, ..)``; ``highway`` is an
array whose first element counts. Parallel edges have their own ``edge`` ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.functions import geometry as geo
from citygrain.operators.nearest import nearest_node
from citygrain.scale import join_on, lookup, numbered

# Driving speed of each road class, km/h.
SPEEDS = {
    "residential": 20.0,
    "primary": 40.0,
    "primary_link": 35.0,
    "motorway": 50.0,
    "motorway_link": 45.0,
    "trunk": 40.0,
    "trunk_link": 35.0,
    "secondary": 30.0,
    "secondary_link": 25.0,
    "tertiary": 30.0,
    "tertiary_link": 25.0,
    "unclassified": 20.0,
    "projected_footway": 3.5,
}

# Rank of each road class at an intersection.
RANKS = {
    "motorway": 1,
    "motorway_link": 1,
    "trunk": 1,
    "trunk_link": 1,
    "primary": 2,
    "primary_link": 2,
    "secondary": 3,
    "secondary_link": 3,
    "tertiary": 4,
    "tertiary_link": 4,
    "unclassified": 5,
    "residential": 5,
    "track": 5,
}
LOWEST_RANK = 5

# Classes kept by default, and classes that count as major roads.
ACCEPTED_ROADS = (
    "primary", "primary_link", "secondary", "secondary_link", "motorway", "motorway_link", "trunk", "trunk_link",
)
MAJOR_WORDS = ("primary", "trunk", "motorway", "primary_link", "trunk_link", "motorway_link")


def road_class() -> Column:
    return F.try_element_at("highway", F.lit(1))


def filter_classes(edges: DataFrame, classes: Sequence[str] = ACCEPTED_ROADS) -> DataFrame:
    return edges.where(road_class().isin(*classes))


def graph_tables(nodes: DataFrame, edges: DataFrame, single_edge: bool = False) -> DataFrame:
    """Edge table with a line for every edge; a missing line becomes a straight one.

    With ``single_edge`` the two directions of a street become one row with a ``oneway`` flag:
    of each pair the edge with the smaller start node stays.
    """
    a = nodes.select(F.col("node").alias("u"), F.struct("x", "y").alias("_a"))
    b = nodes.select(F.col("node").alias("v"), F.struct("x", "y").alias("_b"))
    straight = F.array("_a", "_b")
    line = F.coalesce(F.col("line"), straight) if "line" in edges.columns else straight
    out = edges.join(a, "u").join(b, "v").withColumn("line", line).drop("_a", "_b")
    if not single_edge:
        return out
    reverse = edges.select(F.col("u").alias("_rv"), F.col("v").alias("_ru")).distinct()
    flagged = out.join(reverse, (F.col("u") == F.col("_ru")) & (F.col("v") == F.col("_rv")), "left")
    two_way = F.col("_ru").isNotNull()
    return (
        flagged.where(~two_way | (F.col("u") <= F.col("v")))
        .withColumn("oneway", ~two_way)
        .drop("_ru", "_rv")
    )


def unused_nodes(nodes: DataFrame, edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Nodes that no edge starts or ends at; ``by`` names columns of both tables that keep networks apart."""
    used = edges.select(*by, F.explode(F.array("u", "v")).alias("node")).distinct()
    return nodes.join(used, [*by, "node"], "left_anti")


def build_graph(nodes: DataFrame, edges: DataFrame, oneway: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Node and edge tables of a graph: edges with known end nodes, reversed where two-way."""
    known = nodes.select("node")
    kept = edges.join(known.withColumnRenamed("node", "u"), "u", "left_semi").join(
        known.withColumnRenamed("node", "v"), "v", "left_semi"
    )
    kept = kept.select(*edges.columns)
    return nodes, reflect_edges(kept, oneway) if oneway else kept


def reflect_edges(edges: DataFrame, oneway: str | None = None, only_missing: bool = False,
                  by: Sequence[str] = ()) -> DataFrame:
    """Add the reverse of every two-way edge, or only of edges whose reverse is missing; ``by`` keeps networks apart."""
    source = edges.where(~F.coalesce(F.col(oneway), F.lit(False))) if oneway else edges
    if only_missing:
        present = edges.select(*by, F.col("u").alias("v"), F.col("v").alias("u")).distinct()
        source = join_on(source, present, [*by, "u", "v"], "left_anti").select(*edges.columns)
    swapped = source.withColumns({"u": F.col("v"), "v": F.col("u")})
    if "line" in edges.columns:
        swapped = swapped.withColumn("line", F.reverse("line"))
    return edges.withColumn("reflected", F.lit(False)).unionByName(swapped.withColumn("reflected", F.lit(True)))


def compose_graphs(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Union of node (or edge) tables of several graphs; a later graph's attributes win."""
    out = None
    for i, t in enumerate(tables):
        tagged = t.withColumn("_source", F.lit(i))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    values = [c for c in out.columns if c not in keys and c != "_source"]
    # per attribute: the value of the last graph that has one
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_source"))).alias(c) for c in values]
    return out.groupBy(*keys).agg(*latest) if latest else out.select(*keys).distinct()


def travel_time(edges: DataFrame, mode: str = "drive", speeds: dict | None = None, default: float | None = 20.0,
                walk: float = 4.5, factor: float = 1.0) -> DataFrame:
    """Seconds per edge from its length; a null default leaves unlisted classes without a time."""
    if mode not in ("drive", "walk"):
        raise ValueError("mode is drive or walk")
    meters = F.col("length") * factor
    speed = F.lit(float(walk)) if mode == "walk" else lookup(speeds or SPEEDS, road_class(), default)
    return edges.withColumns({"length": meters, "time": meters / 1000 / speed * 3600, "mode": F.lit(mode)})


def intersection_delay(edges: DataFrame, seconds: float = 7.0,
                       exempt: Sequence[str] = ("projected_footway", "motorway")) -> DataFrame:
    """Add a delay to edges that enter an intersection, except its right-of-way.

    At nodes with more than two edge ends, predecessors are ranked by road class; when at
    most two share the best rank they keep their time.
    """
    degree = (
        edges.select(F.explode(F.array("u", "v")).alias("v"))
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("_degree"))
        .where("_degree > 2")
    )
    rank = lookup(RANKS, road_class(), LOWEST_RANK)
    preds = edges.groupBy("u", "v").agg(F.max_by(rank, "edge").alias("_rank"))
    per_rank = preds.groupBy("v", "_rank").agg(F.count(F.lit(1)).alias("_n"))
    best = per_rank.groupBy("v").agg(F.min("_rank").alias("_best"), F.min_by("_n", "_rank").alias("_sharing"))
    entering = best.join(degree, "v").drop("_degree")
    marked = edges.join(preds, ["u", "v"]).join(entering, "v", "left")
    delayed = (
        F.col("_best").isNotNull()
        & ~((F.col("_sharing") <= 2) & (F.col("_rank") == F.col("_best")))
        & ~F.coalesce(road_class().isin(*exempt), F.lit(False))
    )
    time = F.col("time") + F.when(delayed, F.lit(float(seconds))).otherwise(F.lit(0.0))
    return marked.withColumn("time", time).select(*edges.columns)


def length_by_class(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return edges.groupBy(*by, road_class().alias("road")).agg(F.sum("length").alias("length"))


def mean_speed(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total kilometres over total hours."""
    return edges.groupBy(*by).agg(
        F.try_divide(F.sum("length") / 1000, F.sum("time") / 3600).alias("mean_speed_kmh")
    )


def disrupt(edges: DataFrame, nodes: DataFrame, column: str, threshold: float, fail: float) -> DataFrame:
    """Every edge at a node whose property exceeds the threshold gets the fail time."""
    broken = nodes.where(F.col(column) > threshold).select("node")
    u = broken.select(F.col("node").alias("u"), F.lit(True).alias("_bu"))
    v = broken.select(F.col("node").alias("v"), F.lit(True).alias("_bv"))
    hit = F.coalesce("_bu", "_bv").isNotNull()
    return (
        edges.join(u, "u", "left")
        .join(v, "v", "left")
        .withColumn("disrupted", hit)
        .withColumn("time", F.when(hit, F.lit(float(fail))).otherwise(F.col("time")))
        .select(*edges.columns, "disrupted")
    )


def disrupt_random(edges: DataFrame, percent: float, fail: float, seed: int = 0, street: str = "edge") -> DataFrame:
    """Give the fail time to streets chosen by a seeded digest of their id.

    ``street`` names the id that both directions of a street share. As many ids are drawn as half
    the edges times the percentage, without drawing one twice; parallel streets have ids of their own.
    """
    streets = edges.select(F.col(street).alias("_id")).distinct()
    streets = streets.withColumn("_h", F.md5(F.concat_ws(" ", F.lit(str(seed)), F.col("_id").cast("string")).cast("binary")))
    count = edges.agg(F.floor(F.count(F.lit(1)) / 2 * (percent / 100)).alias("n"))
    chosen = numbered(streets, ["_h", "_id"], "_rank").where(F.col("_rank") < count.scalar()).select("_id", F.lit(True).alias("_hit"))
    marked = edges.withColumn("_id", F.col(street)).join(chosen, "_id", "left")
    hit = F.col("_hit").isNotNull()
    return (
        marked.withColumn("disrupted", hit)
        .withColumn("time", F.when(hit, F.lit(float(fail))).otherwise(F.col("time")))
        .select(*edges.columns, "disrupted")
    )


def drop_parallel(edges: DataFrame, max_ratio: float = 1.5, by: Sequence[str] = ()) -> DataFrame:
    """Of parallel edges with nearly the same length keep the first; longer detours all stay. ``by`` keeps networks apart."""
    groups = edges.groupBy(*by, "u", "v").agg(
        F.min("edge").alias("_first"), F.try_divide(F.max("length"), F.min("length")).alias("_ratio")
    )
    return (
        join_on(edges, groups, [*by, "u", "v"])
        .where(F.col("_ratio").isNull() | (F.col("_ratio") >= max_ratio) | (F.col("edge") == F.col("_first")))
        .select(*edges.columns)
    )


def join_networks(base_nodes: DataFrame, base_edges: DataFrame, new_nodes: DataFrame, new_edges: DataFrame,
                  max_dist: float = 500.0) -> tuple[DataFrame, DataFrame]:
    """Two networks glued where a new node lies within the distance of a base node (planar units).

    New ids get a prefix, glue edges run both ways, and all nodes are renumbered from 0.
    """
    prefix = F.lit("add_net_")

    def text(df: DataFrame, columns: Sequence[str], added: bool) -> DataFrame:
        made = {c: F.col(c).cast("string") for c in columns}
        return df.withColumns({c: F.concat(prefix, t) if added else t for c, t in made.items()})

    snapped = nearest_node(
        new_nodes.select(F.col("node").alias("_new"), "x", "y"), base_nodes.select("node", F.col("x").alias("_bx"), F.col("y").alias("_by")).withColumnsRenamed({"_bx": "x", "_by": "y"}), "x", "y"
    ).where(F.col("distance") < max_dist)
    glue = snapped.select(
        F.concat(prefix, F.col("_new").cast("string")).alias("u"),
        F.col("node").cast("string").alias("v"),
        (F.col("distance") / 1000).alias("length"),
        F.lit("net_glue").alias("kind"),
    )
    back = glue.select(F.col("v").alias("u"), F.col("u").alias("v"), "length", "kind")
    nodes = text(base_nodes, ["node"], False).unionByName(text(new_nodes, ["node"], True), allowMissingColumns=True)
    edges = (
        text(base_edges, ["u", "v"], False).withColumn("kind", F.lit("base"))
        .unionByName(text(new_edges, ["u", "v"], True).withColumn("kind", F.lit("new")), allowMissingColumns=True)
        .unionByName(glue, allowMissingColumns=True)
        .unionByName(back, allowMissingColumns=True)
    )
    ids = numbered(nodes.select("node").distinct(), ["node"], "id")
    relabelled = edges.join(ids.withColumnsRenamed({"node": "u", "id": "_u"}), "u").join(
        ids.withColumnsRenamed({"node": "v", "id": "_v"}), "v"
    )
    return (
        nodes.join(ids, "node").withColumnsRenamed({"node": "label", "id": "node"}),
        relabelled.drop("u", "v").withColumnsRenamed({"_u": "u", "_v": "v"}),
    )


def bearing_rose(edges: DataFrame, n: int = 36, by: Sequence[str] = ()) -> DataFrame:
    """Share of edges in n compass sectors centred on 0, 10, 20, .. degrees.

    Bins half a sector wide are rolled by one and paired, so sector 0 spans north.
    ``edges`` has lon1, lat1, lon2, lat2.
    """
    angle = geo.bearing(F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2"))
    half = 360.0 / (2 * n)
    sector = F.floor(F.pmod(angle + half, F.lit(360.0)) / (2 * half)).cast("int")
    same_place = (F.col("lon1") == F.col("lon2")) & (F.col("lat1") == F.col("lat2"))
    counted = edges.where(~same_place).groupBy(*by).agg(
        F.count(F.lit(1)).alias("_all"), *[F.count_if(sector == i).alias(f"_s{i}") for i in range(n)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("sector"),
                F.col(f"_s{i}").alias("count"),
                F.try_divide(F.col(f"_s{i}"), F.col("_all")).alias("frequency"),
            )
            for i in range(n)
        ]
    )
    return counted.select(*by, F.inline(rows))


def major_roads(edges: DataFrame) -> DataFrame:
    """Edges with any class that contains a major-road word."""
    return edges.where(F.exists("highway", lambda h: h.rlike("|".join(MAJOR_WORDS))))


def road_type(edges: DataFrame, centrality: str = "edge_centrality") -> DataFrame:
    """Primary or Secondary label, and centrality in percent."""
    primary = F.exists("highway", lambda h: h.rlike("|".join(MAJOR_WORDS)))
    return edges.withColumns(
        {"road_type": F.when(primary, "Primary").otherwise("Secondary"), centrality: F.col(centrality) * 100}
    )


def attach_times(edges: DataFrame, times: DataFrame, by: Sequence[str] = ("u", "v")) -> DataFrame:
    """External travel times joined on the composite edge id; unmatched edges keep theirs."""
    given = times.select(*by, F.col("time").alias("_given"))
    joined = join_on(edges, given, by, "left")
    return (
        joined.withColumn("matched", F.col("_given").isNotNull())
        .withColumn("time", F.coalesce("_given", "time"))
        .drop("_given")
    )


def network_stats(nodes: DataFrame, edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts, mean degree, lengths, intersections and streets per node.

    A street is an unordered pair of nodes; an intersection joins two or more streets.
    """
    edge_part = edges.groupBy(*by).agg(
        F.count(F.lit(1)).alias("m"), F.sum("length").alias("length_total"), F.avg("length").alias("length_mean")
    )
    streets = edges.select(*by, F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    ends = (
        streets.select(*by, F.explode(F.array("a", "b")).alias("node"))
        .groupBy(*by, "node")
        .agg(F.count(F.lit(1)).alias("_streets"))
    )
    node_part = (
        nodes.join(ends, [*by, "node"], "left")
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("_streets") > 1).alias("intersections"),
            F.avg(F.coalesce("_streets", F.lit(0))).alias("streets_per_node"),
        )
    )
    if by:
        out = join_on(node_part, edge_part, by)
    else:
        packed = edge_part.select(F.struct("m", "length_total", "length_mean")).scalar()
        out = node_part.withColumn("_e", packed).select("*", "_e.*").drop("_e")
    return out.withColumn("degree_mean", F.col("m") * 2 / F.col("n"))
