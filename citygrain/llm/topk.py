"""Exact top-k by inner product with Fagin's threshold algorithm.

Vectors are dealt into blocks. A block keeps one list of its vectors per dimension, sorted by value. A query walks
all lists from their better end for its sign at once, some entries deep at a time, scores every vector it meets
for the first time, and stops when no unseen vector can reach the k-th score: an unseen vector has at most
the value at the present depth in every dimension.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.llm.common import map_arrow
from citygrain.scale import cut_lineage

#: Vectors in a block, and queries that visit it together.
BLOCK = 8192
QUERIES = 2048

#: Entries of each list that the first step takes; later steps take twice as many.
DEPTH = 16


class SortedLists:
    """A block's vectors with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], np.ascontiguousarray(vectors[order])
        self.lists = np.argsort(self.vectors, axis=0, kind="stable")

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best vectors with another id than the query's, ties to the smaller id."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        if not len(used):
            used = np.arange(min(1, len(query)))
        falling = query[used] > 0
        lists, weights = self.lists[:, used], query[used]
        unseen = self.ids != own
        best_rows = np.empty(0, np.int64)
        best = np.empty(0, np.int64)
        depth, step = 0, DEPTH
        while depth < n and len(used):
            end = min(n, depth + step)
            met = np.where(falling, lists[::-1][depth:end], lists[depth:end]).ravel()
            met = np.unique(met[unseen[met]])
            unseen[met] = False
            rows = np.concatenate([best_rows, met])
            scores = np.concatenate([best, self.vectors[met] @ query])
            keep = np.lexsort((rows, -scores))[:k]
            best_rows, best = rows[keep], scores[keep]
            # the largest score that a vector behind this depth can have
            edge = np.where(falling, lists[n - end], lists[end - 1])
            bound = int((self.vectors[edge, used] * weights).sum())
            if len(best) == k and bound < best[-1]:
                break
            depth, step = end, 2 * step
        return self.ids[best_rows], best


def _values(vector: str) -> Column:
    """floor(1024 x) of every component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 1024))


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """id and v of the rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & finite)
    return rows.select(F.col(vec_id).cast("long").alias("id"), _values(vector).alias("v"))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
    block: int = BLOCK, queries: int = QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows for each row that ``is_query`` picks.

    Components become floor(1024 x) and scores are integer inner products, so results are exact. Ties go to the
    smaller id. Rows with the query's own id are no candidates. Vectors that are null or hold null or non-finite
    components, and rows without an id, take no part; vectors of different lengths are not compared. Of rows with
    one id and equal vectors each is a candidate, and a query repeated so gives one answer. Extra columns
    are not read. Every block of queries meets every block of vectors once; a task holds one of each.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(usable(vectors, vec_id, vector).withColumn("size", F.size("v")))
    asked = cut_lineage(usable(vectors.where(is_query), vec_id, vector).distinct().withColumn("size", F.size("v")))
    # one row for each length of vectors
    n = {r.size: r["count"] for r in rows.groupBy("size").count().collect()}
    q = {r.size: r["count"] for r in asked.groupBy("size").count().collect()}
    plan = [(s, math.ceil(q[s] / queries), max(math.ceil(n[s] / block), min(8, math.ceil(n[s] / 512)))) for s in q]
    if not plan:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = F.broadcast(spark.createDataFrame(plan, "size int, nq int, nv int"))
    number = lambda c: F.pmod(F.xxhash64("id", "v"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = asked.join(blocks, "size").select("size", number("nq").alias("a"), every("nv").alias("b"), "id", "v", F.lit(True).alias("asks"))
    right = rows.join(blocks, "size").select("size", every("nq").alias("a"), F.pmod(F.xxhash64("id"), F.col("nv")).cast("int").alias("b"), "id", "v", F.lit(False).alias("asks"))
    dealt = left.unionByName(right).withColumn("task", F.xxhash64("size", "a", "b")).select("task", "asks", "id", "v")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches) -> Iterator[dict]:
        for ids, values, asks in _tasks(batches):
            lists = SortedLists(ids[~asks], values[~asks])
            out: dict[str, list] = {"query_id": [], "vec_id": [], "score": [], "q": []}
            for own, query in zip(ids[asks].tolist(), values[asks]):
                found, scores = lists.top(query, own, k)
                out["query_id"] += [own] * len(found)
                out["q"] += [hash_of(query)] * len(found)
                out["vec_id"] += found.tolist()
                out["score"] += scores.tolist()
            if out["query_id"]:
                yield out

    sorted_rows = dealt.repartition(parts, "task").sortWithinPartitions("task")
    found = map_arrow(sorted_rows, run, "query_id long, q long, vec_id long, score long")
    # k rows for each query and block of vectors
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def hash_of(query: np.ndarray) -> int:
    """Tells queries apart that share an id but not the vector."""
    import xxhash

    return xxhash.xxh64_intdigest(query.tobytes()) >> 1


def _tasks(batches) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, vectors and whether they ask, of one pair of blocks after the other."""
    held: list[tuple] = []
    current = None
    for batch in batches:
        task = batch.column("task").to_numpy()
        lists = batch.column("v")
        flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        ids = batch.column("id").to_numpy()
        asks = batch.column("asks").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and task[a] != current:
                yield tuple(map(np.concatenate, zip(*held)))
                held = []
            current = task[a]
            held.append((ids[a:b], flat[offsets[a] : offsets[b]].reshape(b - a, -1).astype(np.int64), asks[a:b]))
    if held:
        yield tuple(map(np.concatenate, zip(*held)))
