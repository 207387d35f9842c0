"""Shortest-path costs on street graphs, reach, and origin-destination tables.

Costs spread outwards by repeated joins with the edge table, for all cities, categories
and origins together. Origin-destination results stay sparse: a pair without a route has
no row, and every consumer accounts for missing pairs exactly without listing them.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.operators.nearest import nearest_node
from citygrain.scale import Kept, cut_and_measure, cut_lineage, with_totals

# Decay rates of the accessibility scores (halving every 15, 30, 60, 120, 300 minutes among them).
DECAYS = (0.01, 0.005, 0.001, 0.0007701635, 0.0003850818, 0.0001925409, 0.0000962704, 0.0000385082, 0.00001)


def checked_weight(weight: str) -> Column:
    """The weight column, failing on null, zero and negative values."""
    w = F.col(weight).cast("double")
    return F.when(w > 0, w).otherwise(F.raise_error(F.lit(f"edge without a positive {weight}")).cast("double"))


#: Rows of the open part of a search: costs that may still fall.
OPEN_ROWS = 50_000_000


def shortest_costs(edges: DataFrame, origins: DataFrame, cutoff: float | None = None, weight: str = "length",
                   by: Sequence[str] = (), carry: Sequence[str] = (), open_rows: int = OPEN_ROWS) -> DataFrame:
    """Least cost from the origins to every node within the cutoff.

    ``origins`` has ``node``, the ``by`` columns shared with the edges (such as the city) and
    the ``carry`` columns that keep searches apart (a category, or the origin itself).
    One search runs per distinct combination.

    Costs are settled band by band. Only the band that is open takes part in the rounds: each round extends nodes whose
    cost improved in the round before, inside the band. When nothing improves any more, its rows are final; they are
    written once, and costs beyond the band wait, one per node, until their band opens. Settled rows are only looked up, in the place
    where they were written. A band is as wide as ``open_rows`` allow, so a search with few rows has one band.
    """
    keys = [*by, *carry]
    place = [*keys, "node"]
    cutoff = None if cutoff == float("inf") else cutoff
    # of parallel edges only the cheapest matters
    steps, sizes = cut_and_measure(
        edges.where("u <> v").groupBy(*by, "u", "v").agg(F.min(checked_weight(weight)).alias("_w")),
        n=F.count(F.lit(1)), mean=F.avg("_w"),
    )
    waiting, starts = cut_and_measure(
        origins.select(*place).distinct().withColumn("cost", F.lit(0.0)),
        n=F.count(F.lit(1)), least=F.min("cost"), searches=F.count_distinct(F.struct(*keys)) if keys else F.lit(1),
    )
    width = _band(starts, sizes, cutoff, open_rows)
    if width is None:
        return _fixpoint(waiting, steps, by, place, cutoff, None, None)[0]
    settled = Kept(edges.sparkSession, place, "settled_costs")
    streets = Kept(edges.sparkSession, [*by, "u"], "search_edges")
    streets.append(steps)
    steps = streets.table()
    limit = 0.0
    while starts["n"]:
        limit = max(limit, starts["least"]) + width
        state, n = _fixpoint(settled.without(waiting.where(F.col("cost") < limit)), steps, by, place, cutoff, limit, settled)
        beyond = _extended(state, steps, by, place, cutoff).where(F.col("cost") >= limit)
        settled.append(state, dealt=True)
        waiting, starts = cut_and_measure(
            waiting.where(F.col("cost") >= limit).unionByName(beyond).groupBy(*place).agg(F.min("cost").alias("cost")),
            n=F.count(F.lit(1)), least=F.min("cost"),
        )
        # bands that hold too little or too much are made wider or narrower
        width = width * 2 if n < open_rows / 4 else max(width / 2, sizes["mean"] / 8) if n > open_rows else width
    streets.drop()
    return settled.close()


def _band(starts: dict, steps: dict, cutoff: float | None, open_rows: int) -> float | None:
    """A first width of the bands; None if all rows that the searches can have may be open at once.

    Origins of one search share its rows: a node has one, however many origins reach it.
    """
    reachable = starts["n"] + starts["searches"] * steps["n"]
    if reachable <= open_rows:
        return None
    return max(cutoff * open_rows / reachable, steps["mean"]) if cutoff is not None else 4 * steps["mean"]


def _extended(frontier: DataFrame, steps: DataFrame, by: Sequence[str], place: Sequence[str], cutoff: float | None) -> DataFrame:
    out = frontier.withColumnRenamed("node", "u").join(steps, [*by, "u"])
    out = out.select(*place[:-1], F.col("v").alias("node"), (F.col("cost") + F.col("_w")).alias("cost"))
    return out if cutoff is None else out.where(F.col("cost") <= cutoff)


def _fixpoint(state: DataFrame, steps: DataFrame, by: Sequence[str], place: Sequence[str], cutoff: float | None,
              limit: float | None, settled: Kept | None) -> tuple[DataFrame, int]:
    """Least costs below the limit, starting from ``state``, and their number."""
    best = F.min(F.struct("cost", "_round"))
    state, measured = cut_and_measure(state.withColumn("_round", F.lit(0)), n=F.count(F.lit(1)))
    for i in count(1):
        step = _extended(state.where(F.col("_round") == i - 1), steps, by, place, cutoff)
        if limit is not None:
            step = settled.without(step.where(F.col("cost") < limit))
        state, measured = cut_and_measure(
            state.unionByName(step.withColumn("_round", F.lit(i))).groupBy(*place).agg(best.alias("_b")).select(*place, "_b.*"),
            n=F.count(F.lit(1)), changed=F.count(F.when(F.col("_round") == i, 1)),
        )
        if not measured["changed"]:
            return state.drop("_round"), measured["n"]


def reach(edges: DataFrame, origins: DataFrame, cutoff: float, weight: str = "length", stacking: bool = False,
          by: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """Nodes within the cutoff of any origin; with ``stacking`` the number of origins that reach each."""
    if not stacking:
        found = shortest_costs(edges, origins, cutoff, weight, by, carry)
        return found.select(*by, *carry, "node", F.lit(1).alias("reached"))
    keyed = origins.withColumn("origin", F.col("node"))
    found = shortest_costs(edges, keyed, cutoff, weight, by, [*carry, "origin"])
    return found.groupBy(*by, *carry, "node").agg(F.count(F.lit(1)).alias("reached"))


def facility_nodes(places: DataFrame, nodes: DataFrame, by: Sequence[str] = ("category",), x: str = "x",
                   y: str = "y", within: Sequence[str] = ()) -> DataFrame:
    """Distinct nearest nodes of the places, per category; ``within`` names columns, such as the city, shared with the nodes."""
    keys = [*within, *[c for c in by if c not in within]]
    return nearest_node(places.select(*keys, x, y), nodes, x, y, within).select(*keys, "node").distinct()


def isochrone_nodes(edges: DataFrame, origins: DataFrame, thresholds: Sequence[float], weight: str = "length",
                    by: Sequence[str] = (), carry: Sequence[str] = ("category",)) -> DataFrame:
    """Nodes of each threshold's zone, from one search at the largest threshold."""
    found = shortest_costs(edges, origins, max(thresholds), weight, by, carry)
    limits = F.filter(F.array(*[F.lit(float(t)) for t in thresholds]), lambda t: t >= F.col("cost"))
    return found.select(*by, *carry, "node", "cost", F.explode(limits).alias("threshold"))


def od_costs(edges: DataFrame, origins: DataFrame, dests: DataFrame, cutoff: float, weight: str = "length",
             origin_weights: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Cost of every (origin, destination) pair of nodes within the cutoff.

    The cutoff is what keeps the table sparse on a large network, so it must be given. ``by`` names columns of
    all tables, such as the city, that keep networks apart; pairs are formed inside each.

    The search starts from the smaller side; from destinations it runs on reversed edges,
    which gives the same costs on one-way streets too.
    """
    o = origins.select(*by, "node").distinct()
    d = dests.select(*by, "node").distinct()
    if d.count() < o.count():
        reverse = edges.select(*by, F.col("v").alias("u"), F.col("u").alias("v"), weight)
        found = shortest_costs(reverse, d.withColumn("d", F.col("node")), cutoff, weight, by, ["d"])
        od = found.withColumnRenamed("node", "o").join(o.withColumnRenamed("node", "o"), [*by, "o"], "left_semi")
    else:
        found = shortest_costs(edges, o.withColumn("o", F.col("node")), cutoff, weight, by, ["o"])
        od = found.withColumnRenamed("node", "d").join(d.withColumnRenamed("node", "d"), [*by, "d"], "left_semi")
    if origin_weights is not None:
        # a multiplier per origin (columns o, multiplier)
        od = od.join(origin_weights, [*by, "o"]).withColumn("cost", F.col("cost") * F.col("multiplier")).drop("multiplier")
    return od.select(*by, "o", "d", "cost")


def od_lookup(od: DataFrame, pairs: DataFrame, fail: float) -> DataFrame:
    """Costs of the wanted pairs (o, d); the fail value where no route exists."""
    return pairs.join(od, ["o", "d"], "left").withColumn("cost", F.coalesce("cost", F.lit(float(fail))))


def od_unreached(od: DataFrame, origins: DataFrame, dests: DataFrame) -> DataFrame:
    """Per origin: destinations reached and not reached."""
    total = dests.select("node").distinct().agg(F.count(F.lit(1)).alias("n"))
    reached = od.groupBy("o").agg(F.count(F.lit(1)).alias("reached"))
    return (
        origins.select(F.col("node").alias("o")).distinct()
        .join(reached, "o", "left")
        .withColumn("reached", F.coalesce("reached", F.lit(0).cast("long")))
        .withColumn("unreached", total.scalar() - F.col("reached"))
    )


def od_from_points(nodes: DataFrame, edges: DataFrame, origins: DataFrame, dests: DataFrame, pairs: DataFrame,
                   fail: float, cutoff: float, weight: str = "length",
                   walk_speed_kmh: float | None = None, x: str = "x", y: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """Costs between points: both ends snapped to nodes, costs found between distinct nodes.

    ``origins`` and ``dests`` have ``id``, ``x``, ``y`` in metres; ``pairs`` lists the wanted (origin,
    destination) ids; only their points are snapped and searched from. Pairs further apart than the cutoff
    get the fail value. With a walking speed the time to and from the snapped nodes is added. ``by`` names columns of all
    tables, such as the city, that keep networks apart.
    """
    by = list(by)
    end = lambda origin, column: F.struct(F.lit(origin).alias("_from"), F.col(column).alias("id"))
    ends = F.explode(F.array(end(True, "origin"), end(False, "destination"))).alias("_e")
    asked = pairs.select(*by, ends).select(*by, "_e.*").distinct()
    points = origins.select(*by, F.lit(True).alias("_from"), "id", x, y).unionByName(dests.select(*by, F.lit(False).alias("_from"), "id", x, y))
    # both ends are looked for in one search
    snapped = cut_lineage(nearest_node(points.join(asked, [*by, "_from", "id"], "left_semi"), nodes, x, y, by))
    o = snapped.where("_from").select(*by, F.col("id").alias("origin"), F.col("node").alias("o"), F.col("distance").alias("_od"))
    d = snapped.where("not _from").select(*by, F.col("id").alias("destination"), F.col("node").alias("d"), F.col("distance").alias("_dd"))
    placed = cut_lineage(pairs.join(o, [*by, "origin"]).join(d, [*by, "destination"]))
    starts, goals = (placed.select(*by, F.col(c).alias("node")) for c in ("o", "d"))
    od = od_costs(edges, starts, goals, cutoff, weight, by=by)
    wanted = placed.join(od, [*by, "o", "d"], "left")
    cost = F.coalesce("cost", F.lit(float(fail)))
    if walk_speed_kmh:
        cost = cost + (F.col("_od") + F.col("_dd")) / 1000 / walk_speed_kmh * 3600
    return wanted.select(*by, "origin", "destination", cost.alias("cost"))


def decay_name(k: float) -> str:
    return f"d_{k}"


def gravity_access(od: DataFrame, o_weight: DataFrame, d_weight: DataFrame, decays: Sequence[float] = DECAYS,
                   fail: float | None = None) -> DataFrame:
    """Sum over destinations of weight times exp(-k cost), times the origin's weight, per decay.

    ``o_weight`` (o, weight) and ``d_weight`` (d, weight). With a fail value, destinations
    without a route count at that cost: their weight is the total less the reached weight.
    """
    weighted = od.join(d_weight.withColumnRenamed("weight", "_dw"), "d")
    sums = weighted.groupBy("o").agg(
        F.sum("_dw").alias("_reached"),
        *[F.sum(F.col("_dw") * F.exp(F.col("cost") * -k)).alias(decay_name(k)) for k in decays],
    )
    out = o_weight.withColumnRenamed("weight", "_ow").join(sums, "o", "left")
    if fail is not None:
        out = out.withColumn("_all", d_weight.agg(F.sum("weight").alias("w")).scalar())
    columns = []
    for k in decays:
        total = F.coalesce(F.col(f"`{decay_name(k)}`"), F.lit(0.0))
        if fail is not None:
            total = total + (F.col("_all") - F.coalesce("_reached", F.lit(0.0))) * F.exp(F.lit(-k * fail))
        columns.append((total * F.col("_ow")).alias(decay_name(k)))
    return out.select("o", *columns)


def market_access(od: DataFrame, decays: Sequence[float] = DECAYS) -> DataFrame:
    """Sum of destination population times exp(-k distance) over pairs a positive distance apart."""
    return (
        od.where(F.col("DIST") > 0)
        .groupBy("O_UID")
        .agg(*[F.sum(F.col("D_POP") * F.exp(F.col("DIST") * -k)).alias(decay_name(k)) for k in decays])
    )


def gravity_demand(od: DataFrame, weights: DataFrame, max_trips: float = 100.0, decay: float = 1.0,
                   fail: float | None = None, origins: DataFrame | None = None,
                   dests: DataFrame | None = None) -> DataFrame:
    """Trips per pair: weight product times exp(-decay cost / largest cost), scaled to the maximum, rounded up.

    The diagonal is 0. ``weights`` has node and weight. When a fail value is given and some
    pair has no route, the fail value is the largest cost.
    """
    w = weights.select("node", "weight")
    pairs = od.join(w.select(F.col("node").alias("o"), F.col("weight").alias("_ow")), "o").join(
        w.select(F.col("node").alias("d"), F.col("weight").alias("_dw")), "d"
    )
    largest = od.agg(F.max("cost").alias("c"), F.count(F.lit(1)).alias("n"))
    limit = F.col("c")
    if fail is not None:
        possible = origins.select("node").distinct().agg(F.count(F.lit(1)).alias("n")).scalar() * dests.select(
            "node"
        ).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
        limit = F.when(F.col("n") < possible, F.greatest(F.lit(float(fail)), F.col("c"))).otherwise(F.col("c"))
    top = largest.select(limit.alias("c")).scalar()
    raw = F.when(F.col("o") == F.col("d"), F.lit(0.0)).otherwise(
        F.col("_ow") * F.col("_dw") * F.exp(F.col("cost") / F.col("_top") * -decay)
    )
    scored = pairs.withColumn("_top", top).withColumn("_raw", raw)
    peak = with_totals(scored, (), _peak=F.max("_raw"))
    # noise in the last digits must not lift a whole number to the next one
    trips = F.ceil(F.round(F.try_divide(F.col("_raw"), F.col("_peak")) * max_trips, 9)).cast("int")
    return peak.select("o", "d", trips.alias("trips"))


def straight_od(pairs: DataFrame, origins: DataFrame, dests: DataFrame, x: str = "lon", y: str = "lat") -> DataFrame:
    """Straight-line distance, degrees times 100, of the wanted (O_UID, D_UID) pairs."""
    o = origins.select(F.col("id").alias("O_UID"), F.col(x).alias("_ox"), F.col(y).alias("_oy"))
    d = dests.select(F.col("id").alias("D_UID"), F.col(x).alias("_dx"), F.col(y).alias("_dy"))
    distance = F.hypot(F.col("_ox") - F.col("_dx"), F.col("_oy") - F.col("_dy")) * 100
    return pairs.join(o, "O_UID").join(d, "D_UID").select("O_UID", "D_UID", distance.alias("DIST"))


def attach_population(od: DataFrame, origins: DataFrame, dests: DataFrame, pop: str = "weight") -> DataFrame:
    """Population of both ends joined to distinct pairs."""
    o = origins.select(F.col("id").alias("O_UID"), F.col(pop).alias("O_POP"))
    d = dests.select(F.col("id").alias("D_UID"), F.col(pop).alias("D_POP"))
    unique = od.groupBy("O_UID", "D_UID").agg(F.min("DIST").alias("DIST"))
    return unique.join(o, "O_UID", "left").join(d, "D_UID", "left").select("O_UID", "D_UID", "DIST", "O_POP", "D_POP")
