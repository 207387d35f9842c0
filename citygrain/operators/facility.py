"""Facility coverage and location on sparse origin-destination tables.

The tables hold no row for a pair without a route, so every operator takes the origins as well: an
origin that nothing reaches is demand not covered, or costs the fail value.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.scale import cut_lineage, lookup


def _demand(origins: DataFrame, weights: DataFrame | None) -> DataFrame:
    """Demand of each origin: its weight (0 without one), or 1."""
    every = origins.select("o").distinct()
    if weights is None:
        return every.withColumn("_w", F.lit(1.0))
    known = weights.select("o", F.col("weight").cast("double").alias("_w"))
    return every.join(known, "o", "left").withColumn("_w", F.coalesce("_w", F.lit(0.0)))


def coverage(od: DataFrame, origins: DataFrame, max_cost: float, chosen: DataFrame | None = None,
             weights: DataFrame | None = None) -> DataFrame:
    """Demand of all origins, what lies within the cost of a chosen facility, and its percent."""
    served = od.where(F.col("cost") <= max_cost)
    if chosen is not None:
        served = served.join(chosen, "d", "left_semi")
    demand = _demand(origins, weights)
    marked = demand.join(served.select("o", F.lit(True).alias("_in")).distinct(), "o", "left")
    covered = F.coalesce(F.sum(F.when(F.col("_in"), F.col("_w"))), F.lit(0.0))
    return marked.agg(
        F.sum("_w").alias("demand"),
        covered.alias("covered"),
        F.try_divide(covered * 100, F.sum("_w")).alias("percent"),
    )


#: Facilities that are weighed against each other in one job; their overlaps are at most 2 ** TOGETHER rows.
TOGETHER = 12
#: Pairs of an origin and a facility from which the driver makes all choices.
DRIVER_LINKS = 4_000_000


def greedy_cover(od: DataFrame, origins: DataFrame, p: int | None, max_cost: float, weights: DataFrame | None = None,
                 forced: Sequence[int] = (), share: float | None = None, together: int = TOGETHER) -> DataFrame:
    """Facilities chosen one at a time for the most uncovered demand.

    Stops at ``p`` facilities, or when the wanted share of all demand is covered. Forced
    facilities come first; ties go to the smaller id. One row per choice, in order.

    Up to ``DRIVER_LINKS`` pairs within the cost are fetched once and all choices made from them. Of more, a job makes as
    many choices as are certain. It takes the ``together`` facilities of the largest gains and sums the open demand
    by which of them cover it. From these sums their gains after any choice among them follow. Gains only fall, so a
    choice is certain while its gain is above what the best facility outside had at the start of the job.
    """
    if p is None and share is None:
        raise ValueError("give the number of facilities or the share to cover")
    links = cut_lineage(od.where(F.col("cost") <= max_cost).select("o", "d").distinct())
    demand = _demand(origins, weights)
    total = demand.agg(F.sum("_w")).first()[0] or 0.0
    target = None if share is None else total * share
    open_links = cut_lineage(links.join(demand, "o"))
    rows, covered = [], 0.0
    forced_left = list(forced)

    def wanted() -> bool:
        return (p is None or len(rows) < p) and (target is None or covered < target)

    def add(d, gain: float) -> None:
        nonlocal covered
        covered += gain
        rows.append((len(rows) + 1, d, gain, covered, covered / total * 100 if total else 0.0))

    few = open_links.count() <= DRIVER_LINKS
    if few:
        choices = _choices(open_links, forced_left)
        while wanted() and (choice := next(choices, None)):
            add(*choice)
    while not few and wanted():
        must, forced_left = forced_left[:together], forced_left[together:]
        ranked, outside = list(dict.fromkeys(must)), None
        if not must:
            gains = open_links.groupBy("d").agg(F.sum("_w").alias("gain"))
            best = gains.orderBy(F.desc("gain"), "d").limit(together + 1).collect()
            if not best:
                break
            ranked = [r["d"] for r in best[:together]]
            outside = (best[together]["gain"], best[together]["d"]) if len(best) > together else None
        overlaps = _overlaps(open_links, ranked)
        picks = []
        while wanted() and (not must or len(picks) < len(must)):
            held = {i: sum(w for s, w in overlaps if i in s) for i in range(len(ranked)) if any(i in s for s, _ in overlaps)}
            if must:
                i = ranked.index(must[len(picks)])
            elif held:
                i = min(held, key=lambda i: (-held[i], ranked[i]))
            else:
                break
            gain = float(held.get(i, 0.0))
            if picks and outside and (-gain, ranked[i]) > (-outside[0], outside[1]):
                break
            picks.append(ranked[i])
            add(ranked[i], gain)
            overlaps = [(s, w) for s, w in overlaps if i not in s]
        served = links.where(F.col("d").isin(*picks)).select("o")
        open_links = cut_lineage(open_links.join(served, "o", "left_anti"))
    kind = od.schema["d"].dataType.simpleString()
    return od.sparkSession.createDataFrame(rows, f"step int, d {kind}, gain double, covered double, percent double")


def _choices(open_links: DataFrame, forced: Sequence) -> Iterator[tuple]:
    """Facilities and their gains, the forced ones first, then one after another by the largest gain.

    Gains only fall, so a facility whose gain still is what the heap has for it is before all others.
    """
    table = open_links.groupBy("o", "d").agg(F.max("_w").alias("_w")).toArrow()
    o = table.column("o").combine_chunks().dictionary_encode().indices.to_numpy()
    weight = np.zeros(o.max(initial=-1) + 1)
    weight[o] = table.column("_w").to_numpy()
    coded = table.column("d").combine_chunks().dictionary_encode()
    del table
    order = pc.sort_indices(coded.dictionary)
    names, rank = coded.dictionary.take(order), np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    d = rank[coded.indices.to_numpy()]
    gains = np.bincount(d, weight[o], len(names))
    by_d = np.argsort(d, kind="stable")
    first, o = np.searchsorted(d[by_d], np.arange(len(names) + 1)), o[by_d]
    served = np.zeros(len(weight), bool)

    def open_to(i: int) -> np.ndarray:
        mine = o[first[i] : first[i + 1]]
        return mine[~served[mine]]

    for name in forced:
        i = pc.index(names, name).as_py()
        mine = open_to(i) if i >= 0 else o[:0]
        served[mine] = True
        yield name, float(weight[mine].sum())
    heap = [(-g, i) for i, g in enumerate(gains.tolist())]
    heapq.heapify(heap)
    while heap:
        known, i = heap[0]
        mine = open_to(i)
        gain = float(weight[mine].sum())
        if not len(mine):
            heapq.heappop(heap)
        elif gain != -known:
            heapq.heapreplace(heap, (-gain, i))
        else:
            heapq.heappop(heap)
            served[mine] = True
            yield names[i].as_py(), gain


def _overlaps(open_links: DataFrame, ranked: list) -> list[tuple[set[int], float]]:
    """Open demand by the set of the ranked facilities (their numbers) that cover it."""
    number = lookup({d: i for i, d in enumerate(ranked)}, "d")
    near = open_links.where(F.col("d").isin(*ranked)).groupBy("o").agg(F.max("_w").alias("_w"), F.sort_array(F.collect_set(number)).alias("s"))
    return [(set(r["s"]), r["w"]) for r in near.groupBy("s").agg(F.sum("_w").alias("w")).collect()]


def median_cost(od: DataFrame, origins: DataFrame, chosen: DataFrame, fail: float, weights: DataFrame | None = None) -> DataFrame:
    """Sum over all origins of the cost to the cheapest chosen facility; the fail value where none has a route."""
    nearest = od.join(chosen, "d", "left_semi").groupBy("o").agg(F.min("cost").alias("cost"))
    costs = _demand(origins, weights).join(nearest, "o", "left")
    cost = F.coalesce("cost", F.lit(float(fail))) * F.col("_w")
    return costs.agg(
        F.sum(cost).alias("total_cost"), F.count(F.lit(1)).alias("origins"), F.count_if(F.col("cost").isNull()).alias("unserved")
    )


def greedy_median(od: DataFrame, origins: DataFrame, p: int, forced: Sequence[int] = (), fail: float = 1e9) -> DataFrame:
    """Facilities added one at a time for the lowest total cost; unserved origins cost the fail value."""
    candidates = od.select("d").distinct().count()
    if not 1 <= p <= candidates:
        raise ValueError("p must be between 1 and the number of facilities")
    spark = od.sparkSession
    kind = od.schema["d"].dataType.simpleString()
    od = cut_lineage(od.groupBy("o", "d").agg(F.min("cost").alias("cost")))
    known = {r["d"] for r in od.where(F.col("d").isin(*forced)).select("d").distinct().collect()} if forced else set()
    if set(forced) - known:
        raise ValueError("forced facilities must be destinations")
    current = cut_lineage(origins.select("o").distinct().withColumn("_now", F.lit(float(fail))))
    rows, forced_left = [], list(forced)
    for step in range(1, p + 1):
        gap = od.join(current, "o").withColumn("_saved", F.greatest(F.col("_now") - F.col("cost"), F.lit(0.0)))
        saved = gap.groupBy("d").agg(F.sum("_saved").alias("saved"))
        if forced_left:
            pick = forced_left.pop(0)
        else:
            taken = [r[1] for r in rows]
            left = saved.where(~F.col("d").isin(*taken)) if taken else saved
            pick = left.orderBy(F.desc("saved"), "d").limit(1).first()["d"]
        new = od.where(F.col("d") == pick).select("o", "cost")
        current = cut_lineage(
            current.join(new, "o", "left").select(
                "o", F.least("_now", F.coalesce("cost", "_now")).alias("_now")
            )
        )
        rows.append((step, pick, float(current.agg(F.sum("_now")).first()[0])))
    return spark.createDataFrame(rows, f"step int, d {kind}, total_cost double")
