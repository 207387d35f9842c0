"""Ranked lexical search in a trie of documents with bounds on its subtrees.

Of a document only the terms of the items matter. They are put in order of document frequency, so that documents with the
same frequent terms share a path of the trie. Every node knows the largest count of each term and the least length
factor below it; put into the formula of the score they bound all scores below. A depth-first search carries the items that
a subtree may still serve and leaves out those whose tenth best score is above the bound. All arithmetic is whole numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citygrain.llm.common import binary_column, checked_broadcast, map_arrow, words
from citygrain.scale import work_folder

#: Documents of an item in the result.
TOP = 10

#: Bytes of items that are searched for together; more are searched for in blocks.
ITEM_BLOCK = 1 << 20

#: Bytes that terms and items of a block may take, for each of its bytes.
ITEM_BYTES = 96

#: Documents and their term counts in one trie.
DOCUMENTS, COUNTS = 1 << 13, 1 << 21

#: Documents of a leaf, and levels below which a subtree is searched as one leaf.
LEAF, DEEPEST = 32, 64

#: Numbers of a table of documents by terms in a leaf.
TABLE = 1 << 21


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight one adds to the score; grows with tf and falls with m."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def length_factor(n: int, documents: int, length: int) -> int:
    return 100 - 75 + 75 * n * documents // length


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Items:
    """Items as rows of (term, weight times repeats), terms numbered by falling frequency."""

    def __init__(self, rows: list[Counter], df: dict[bytes, int], documents: int):
        self.order = sorted(df, key=lambda t: (-df[t], t))
        number = {t: i for i, t in enumerate(self.order)}
        self.size = len(self.order)
        held = [[(number[t], k * weight(df[t], documents)) for t, k in row.items() if t in number] for row in rows]
        #: items without any known term can't be found and take no part
        self.names = np.array([i for i, row in enumerate(held) if row], np.int64)
        held = [row for row in held if row]
        self.starts = np.concatenate([[0], np.cumsum([len(row) for row in held], dtype=np.int64)]).astype(np.int64)
        self.terms = np.array([t for row in held for t, _ in row], np.int64)
        self.weights = np.array([w for row in held for _, w in row], np.int64)

    def of(self, active: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms, weights and starts of some items."""
        if len(active) == len(self.names):
            return self.terms, self.weights, self.starts[:-1]
        sizes = self.starts[active + 1] - self.starts[active]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.starts[active] - (ends - sizes), sizes)
        return self.terms[at], self.weights[at], ends - sizes


class Node:
    """Documents a..b of a trie in the order of their paths."""

    __slots__ = ("a", "b", "children", "terms", "most", "least")

    def __init__(self, a: int, b: int, children: list[Node]):
        self.a, self.b, self.children = a, b, children


class Trie:
    """Documents as paths of term numbers; a path that does not part is one step."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, lengths: np.ndarray, terms: np.ndarray, tf: np.ndarray, size: int, leaf: int = LEAF):
        starts = np.concatenate([[0], np.cumsum(lengths)])
        path = terms.astype(">u4").tobytes()
        order = sorted(range(len(ids)), key=lambda i: path[4 * starts[i] : 4 * starts[i + 1]])
        self.order = np.array(order, np.int64)
        self.ids, self.m, self.lengths, self.begin = ids[order], m[order], lengths[order], starts[:-1][order]
        self.terms, self.tf, self.leaf = terms, tf, leaf
        self.scratch = np.zeros(size, np.int64)
        self.root = self._node(0, len(ids), 0)

    def _shared(self, a: int, b: int) -> int:
        """Terms that the paths a..b begin with together: those of the first and the last."""
        n = int(min(self.lengths[a], self.lengths[b - 1]))
        first, last = (self.terms[self.begin[i] : self.begin[i] + n] for i in (a, b - 1))
        differ = np.flatnonzero(first != last)
        return int(differ[0]) if len(differ) else n

    def _node(self, a: int, b: int, level: int) -> Node:
        node = Node(a, b, [])
        if b - a > self.leaf and level < DEEPEST:
            depth = self._shared(a, b)
            ends = self.lengths[a:b] == depth
            step = self.terms[np.where(ends, 0, self.begin[a:b] + depth)] + 1
            step[ends] = 0
            cuts = [a, *(np.flatnonzero(np.diff(step)) + 1 + a).tolist(), b]
            if len(cuts) > 2:
                # neighbours with few documents share a leaf
                groups = [cuts[0]]
                for low, high in zip(cuts[1:], cuts[2:]):
                    if high - groups[-1] > self.leaf:
                        groups.append(low)
                node.children = [self._node(x, y, level + 1) for x, y in zip(groups, [*groups[1:], b])]
        self._sum_up(node)
        return node

    def entries(self, a: int, b: int) -> np.ndarray:
        """Places of the counts of documents a..b."""
        sizes = self.lengths[a:b]
        ends = np.cumsum(sizes)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[a:b] - (ends - sizes), sizes)

    def _sum_up(self, node: Node):
        if node.children:
            terms = np.concatenate([c.terms for c in node.children])
            most = np.concatenate([c.most for c in node.children])
            node.least = min(c.least for c in node.children)
        else:
            at = self.entries(node.a, node.b)
            terms, most = self.terms[at], self.tf[at]
            node.least = int(self.m[node.a : node.b].min())
        np.maximum.at(self.scratch, terms, most)
        node.terms = np.unique(terms)
        node.most = self.scratch[node.terms]
        self.scratch[node.terms] = 0


class Best:
    """The best documents of every item so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, items: int, top: int):
        self.score = np.zeros((items, top), np.int64)
        self.id = np.zeros((items, top), np.int64)
        self.null = np.ones((items, top), bool)

    def bar(self, active: np.ndarray) -> np.ndarray:
        """A score below this, or zero, can't enter."""
        return np.maximum(self.score[active, -1], 1)

    def offer(self, active: np.ndarray, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray):
        """scores: a row for each active item, a column for each document."""
        good = (scores >= self.bar(active)[:, None]).any(axis=1)
        if not good.any():
            return
        active = active[good]
        shape = scores[good].shape
        score = np.concatenate([self.score[active], scores[good]], axis=1)
        name = np.concatenate([self.id[active], np.broadcast_to(ids, shape)], axis=1)
        null = np.concatenate([self.null[active], np.broadcast_to(nulls, shape)], axis=1)
        order = np.lexsort((name, null, -score), axis=1)[:, : self.score.shape[1]]
        self.score[active] = np.take_along_axis(score, order, 1)
        self.id[active] = np.take_along_axis(name, order, 1)
        self.null[active] = np.take_along_axis(null, order, 1)


def search(trie: Trie, nulls: np.ndarray, items: Items, best: Best) -> int:
    """Depth-first search of one trie for all items at once; returns how many scores it worked out."""
    f = np.zeros(items.size, np.int64)
    everyone = np.arange(len(items.names))
    stack: list[tuple[Node, np.ndarray, np.ndarray]] = [(trie.root, everyone, np.full(len(everyone), 1 << 62))]
    looked = 0
    while stack:
        node, active, bound = stack.pop()
        # the bar may have risen since the bound was worked out
        active = active[bound >= best.bar(active)]
        if not len(active):
            continue
        terms, weights, starts = items.of(active)
        if node.children:
            found = []
            for child in node.children:
                f[child.terms] = gain(child.most, child.least)
                bounds = np.add.reduceat(f[terms] * weights, starts)
                f[child.terms] = 0
                may = bounds >= best.bar(active)
                if may.any():
                    found.append((child, active[may], bounds[may]))
            # the most promising subtree comes first
            stack += sorted(found, key=lambda x: int(x[2].max()))
            continue
        step = max(1, min(trie.leaf, TABLE // max(items.size, len(terms))))
        for a in range(node.a, node.b, step):
            b = min(a + step, node.b)
            at = trie.entries(a, b)
            row = np.repeat(np.arange(b - a), trie.lengths[a:b])
            table = np.zeros((b - a, items.size), np.int64)
            table[row, trie.terms[at]] = gain(trie.tf[at], trie.m[a:b][row])
            scores = np.add.reduceat(table[:, terms] * weights, starts, axis=1)
            looked += scores.size
            best.offer(active, scores.T, trie.ids[a:b], nulls[trie.order[a:b]])
    return looked


def _vectors(docs: DataFrame, terms: dict[bytes, int], size: int) -> DataFrame:
    """doc_id, n, terms, tf of every document that has a term; of its terms only the items' are listed."""
    shared = checked_broadcast(docs.sparkSession, terms, size, ITEM_BYTES * ITEM_BLOCK, "terms of items")

    def run(batches) -> Iterator[dict]:
        get, width = shared.value.get, len(shared.value) + 1
        for batch in batches:
            split = [words(t) for t in binary_column(batch, "text")]
            n = np.array([len(row) for row in split], np.int64)
            flat = np.concatenate([np.fromiter(map(get, row, repeat(0)), np.int64, len(row)) for row in split])
            keys, tf = np.unique((np.repeat(np.arange(len(n)), n) * width + flat)[flat > 0], return_counts=True)
            offsets = np.searchsorted(keys, np.arange(len(n) + 1) * width).astype(np.int32)
            some = pa.array(n > 0)
            lists = lambda v: pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))).filter(some)
            yield {
                "doc_id": batch.column("doc_id").filter(some),
                "n": n[n > 0],
                "terms": lists(keys % width - 1),
                "tf": lists(tf),
            }

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = map_arrow(whole, run, "doc_id long, n long, terms array<int>, tf array<int>")
    folder = work_folder(docs.sparkSession, "term-vectors")
    found.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def _frequencies(vectors: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """Documents with each term; tasks count before they send."""
    width = len(terms)

    def run(batches) -> Iterator[dict]:
        counts = np.zeros(width, np.int64)
        for batch in batches:
            counts += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=width)
        held = np.flatnonzero(counts)
        yield {"term": held, "df": counts[held]}

    found = map_arrow(vectors.select("terms"), run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    # at most as many rows as the block of items has terms
    return {terms[r.term]: r.df for r in found.toLocalIterator()}


def _block(docs: DataFrame, rows: list[Counter], top: int, documents: int, counts: int, leaf: int) -> DataFrame:
    """item, doc_id, score: for each of the items the best documents of every task."""
    names = sorted(set().union(*rows))
    vectors = _vectors(docs, {t: i + 1 for i, t in enumerate(names)}, sum(len(t) + 90 for t in names))
    total = vectors.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    df = _frequencies(vectors, names)
    items = Items(rows, df, total.n)
    place = {t: i for i, t in enumerate(names)}
    rank = np.zeros(len(names), np.int64)
    rank[[place[t] for t in items.order]] = np.arange(items.size)
    size = sum(x.nbytes for x in (rank, items.terms, items.weights, items.starts, items.names))
    shared = checked_broadcast(docs.sparkSession, (items, rank, total.n, total.l or 1), size, ITEM_BYTES * ITEM_BLOCK, "items")

    def run(batches) -> Iterator[dict]:
        items, rank, every, length = shared.value
        best = Best(len(items.names), top)
        held: list[tuple] = []

        def searched():
            ids, nulls, m, lengths, terms, tf = (np.concatenate(x) for x in zip(*held))
            # the terms of a document by falling frequency
            order = np.lexsort((terms, np.repeat(np.arange(len(ids)), lengths)))
            search(Trie(ids, m, lengths, terms[order], tf[order], items.size, leaf), nulls, items, best)
            held.clear()

        for batch in batches:
            lengths = batch.column("terms").value_lengths().to_numpy().astype(np.int64)
            some = np.flatnonzero(lengths)
            if not len(some) or not len(items.names):
                continue
            ids = batch.column("doc_id")
            held.append((
                ids.fill_null(0).to_numpy()[some],
                ids.is_null().to_numpy(zero_copy_only=False)[some],
                np.array([length_factor(n, every, length) for n in batch.column("n").to_pylist()], np.int64)[some],
                lengths[some],
                rank[batch.column("terms").flatten().to_numpy()],
                batch.column("tf").flatten().to_numpy().astype(np.int64),
            ))
            if sum(len(x[0]) for x in held) >= documents or sum(len(x[4]) for x in held) >= counts:
                searched()
        if held:
            searched()
        item, at = np.nonzero(best.score > 0)
        yield {
            "item": items.names[item],
            "doc_id": pa.array(best.id[item, at], mask=best.null[item, at]),
            "score": best.score[item, at],
        }

    return map_arrow(vectors, run, "item long, doc_id long, score long")


def best_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    block: int = ITEM_BLOCK,
    documents: int = DOCUMENTS,
    counts: int = COUNTS,
    leaf: int = LEAF,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents with a score above zero for every row of ``items``.

    Equal scores are ordered by doc_id, null last. Rows of ``docs`` are documents of their own, repeated ones too, and so are
    rows of ``items``: an item that stands twice has two rows of each rank. Null and empty texts have no terms: such a document is
    found by none and counts nowhere, such an item has no rows. Extra columns are not read.

    Items are held by every task in blocks of about ``block`` bytes, as many as there are; documents are only ever read
    in place. Of each task the ``top`` best go on, first among neighbouring tasks, then all.
    """
    spark = docs.sparkSession
    given = items.select("item_id", F.col("text").alias("t")).where("octet_length(t) > 0")
    total = given.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / block))
    kind = items.schema["item_id"].dataType.simpleString()
    out = None
    for k in range(n_blocks):
        # a block's size is bounded, and checked again before it is broadcast
        rows = given.where(F.pmod(F.xxhash64("item_id", "t"), F.lit(n_blocks)) == k) if n_blocks > 1 else given
        held = [(r.item_id, Counter(words(r.t.encode()))) for r in rows.toLocalIterator()]
        held = [(i, c) for i, c in held if c]
        if not held:
            continue
        found = _block(docs, [c for _, c in held], top, documents, counts, leaf)
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(held)], f"item long, item_id {kind}")
        order = (F.desc("score"), F.asc_nulls_last("doc_id"))
        near = Window.partitionBy("item", "_near").orderBy(*order)
        found = found.withColumn("_near", F.spark_partition_id() % 64).withColumn("_at", F.row_number().over(near))
        found = found.where(F.col("_at") <= top).drop("_at", "_near")
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
        part = ranked.where(F.col("rank") <= top).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long") if out is None else out
