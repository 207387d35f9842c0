"""SimHash near-duplicates: exact comparison of fingerprint tiles.

Fingerprints within the radius cannot differ more than the radius in the population counts of their two
halves together. Distinct fingerprints are therefore dealt into cells by these counts, full cells are split into
tiles, and only tiles of cells close enough are compared, by exclusive-or and bit counts. Inside a
pair of tiles smaller tiles are skipped in the same way by the counts of their quarters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.llm.common import binary_column, map_arrow, tokens
from citygrain.llm.components import components
from citygrain.scale import cut_lineage, join_on

#: Words in a shingle.
SHINGLE = 4

#: Bits in which linked fingerprints may differ.
RADIUS = 4

#: Population counts of a half that share a cell.
CELL = 3

#: Fingerprints in a tile.
TILE = 8192

#: Fingerprints in the smaller tiles of one comparison.
SUBTILE = 64

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of a text; 0 for a text without words."""
    row = tokens(text)
    n = len(row) - shingle + 1
    if not row:
        return 0
    joined = b" ".join(row)
    if n <= 1:
        return int(np.uint64(_hash(joined)).view(np.int64))
    ends = np.cumsum(np.fromiter(map(len, row), np.int64, len(row)) + 1) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    hashes = np.fromiter((_hash(joined[a:b]) for a, b in zip(starts, ends[shingle - 1 :].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 14):
        part = hashes[a : a + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carried: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``carried`` columns and fp (signed 64 bit) of every row; a null text counts as empty."""
    carried = list(carried)

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            yield {c: batch.column(c) for c in carried} | {"fp": [fingerprint(t, shingle) for t in binary_column(batch, "text")]}

    kinds = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in carried)
    return map_arrow(docs.select("text", *carried), run, f"{kinds}fp long")


def _spread(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values ordered by the population counts of their quarters, and the least and largest counts of each subtile."""
    quarters = np.bitwise_count(a.view(np.uint16).reshape(-1, 4)).astype(np.int16)
    order = np.lexsort(quarters.T[::-1])
    quarters = quarters[order]
    cuts = np.arange(0, len(a), SUBTILE)
    return order, np.minimum.reduceat(quarters, cuts), np.maximum.reduceat(quarters, cuts)


def _links(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of values within the radius, some subtile pairs at a time."""
    order_a, low_a, high_a = _spread(a)
    order_b, low_b, high_b = (order_a, low_a, high_a) if same else _spread(b)
    apart = np.zeros((len(low_a), len(low_b)), np.int16)
    for q in range(4):
        apart += np.maximum(0, np.maximum.outer(low_a[:, q], low_b[:, q]) - np.minimum.outer(high_a[:, q], high_b[:, q]))
    near = apart <= radius
    if same:
        near = np.triu(near)
    rows, columns = np.nonzero(near)
    inside = np.arange(SUBTILE)
    for at in range(0, len(rows), 64):
        i = rows[at : at + 64, None] * SUBTILE + inside
        j = columns[at : at + 64, None] * SUBTILE + inside
        real_i, real_j = i < len(a), j < len(b)
        i, j = order_a[np.minimum(i, len(a) - 1)], order_b[np.minimum(j, len(b) - 1)]
        close = np.bitwise_count(a[i][:, :, None] ^ b[j][:, None, :]) <= radius
        k, x, y = np.nonzero(close)
        keep = real_i[k, x] & real_j[k, y]
        left, right = i[k, x][keep], j[k, y][keep]
        if same:
            left, right = left[left != right], right[left != right]
        if len(left):
            yield left, right


class Forest:
    """Union of links that keeps only those which join two trees."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.kept: list[tuple[int, int]] = []

    def add(self, left: np.ndarray, right: np.ndarray):
        root = self.root
        new = np.flatnonzero(root[left] != root[right])
        for i, j in zip(left[new].tolist(), right[new].tolist()):
            x, y = i, j
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                self.kept.append((i, j))
        if len(new):
            while (root[root] != root).any():
                root[:] = root[root]


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two tiles (or inside one), as pairs of fingerprints."""
    values = a if b is None else np.concatenate([a, b])
    forest = Forest(len(values))
    shift = 0 if b is None else len(a)
    for left, right in _links(a.view(np.uint64), (a if b is None else b).view(np.uint64), b is None, radius):
        forest.add(left, right + shift)
    return [(int(values[i]), int(values[j])) for i, j in forest.kept]


def near_links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links u, v that connect all fingerprints within ``radius`` bits, from distinct ``fp`` values.

    Each pair of tiles gives a spanning forest of its links, so a large group of near copies adds as
    many rows as it has members, and joins the same values as all its pairs would.
    """
    spark = distinct.sparkSession
    halves = distinct.select(
        "fp",
        F.floor(F.bit_count(F.shiftrightunsigned("fp", 32)) / CELL).cast("int").alias("x"),
        F.floor(F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))) / CELL).cast("int").alias("y"),
    )
    # one row for each cell that has any, (32 / CELL + 1)^2 at most
    counted = halves.groupBy("x", "y").count().collect()
    cells = {(r.x, r.y): -(-r["count"] // tile) for r in counted}
    pairs = []
    for (x, y), n in cells.items():
        for (v, w), m in cells.items():
            # the least difference that the counts of two cells leave
            gap = sum(max(0, (abs(d) - 1) * CELL + 1) for d in (x - v, y - w) if d)
            if (x, y) <= (v, w) and gap <= radius:
                pairs.append((x, y, v, w, n, m))
    if not pairs:
        return spark.createDataFrame([], "u long, v long")
    # one row for each pair of cells, so its size is bounded; the tiles of a pair are counted out on the rows
    near = F.broadcast(spark.createDataFrame(pairs, "ax int, ay int, bx int, by int, n int, m int"))
    own = F.pmod(F.xxhash64("fp"), F.col("n")), F.pmod(F.xxhash64("fp"), F.col("m"))
    every = [F.explode(F.sequence(F.lit(0).cast("long"), F.col(c).cast("long") - 1)) for c in ("n", "m")]
    left = halves.join(near, (F.col("x") == F.col("ax")) & (F.col("y") == F.col("ay")))
    left = left.select("fp", "ax", "ay", "bx", "by", own[0].alias("s"), every[1].alias("t"), F.lit(0).alias("side"))
    right = halves.join(near, (F.col("x") == F.col("bx")) & (F.col("y") == F.col("by")))
    right = right.select("fp", "ax", "ay", "bx", "by", every[0].alias("s"), own[1].alias("t"), F.lit(1).alias("side"))
    # inside one cell, tiles s and t meet once
    once = (F.col("ax") != F.col("bx")) | (F.col("ay") != F.col("by")) | (F.col("s") <= F.col("t"))
    dealt = left.unionByName(right).where(once)
    dealt = dealt.select("fp", F.xxhash64("ax", "ay", "bx", "by", "s", "t").alias("task"), "side")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches) -> Iterator[dict]:
        for sides in grouped(batches):
            a, b = (np.unique(sides[sides[:, 1] == s, 0]) for s in (0, 1))
            if len(a) and len(b):
                found = tile_links(a, None if len(a) == len(b) and (a == b).all() else b, radius)
                if found:
                    yield {"u": [x for x, _ in found], "v": [y for _, y in found]}

    return map_arrow(dealt.repartition(parts, "task").sortWithinPartitions("task"), run, "u long, v long")


def grouped(batches) -> Iterator[np.ndarray]:
    """Rows (fp, side) of one task after the other, from batches sorted by task."""
    held: list[np.ndarray] = []
    current = None
    for batch in batches:
        task = batch.column("task").to_numpy()
        rows = np.stack([batch.column("fp").to_numpy(), batch.column("side").to_numpy().astype(np.int64)], axis=1)
        cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and task[a] != current:
                yield np.concatenate(held)
                held = []
            current = task[a]
            held.append(rows[a:b])
    if held:
        yield np.concatenate(held)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """doc_id, fp, component_id: one row per row of ``docs``, repeated rows included.

    ``component_id`` is the smallest doc_id among all documents reachable over links of at most ``radius``
    bits, the document itself included; null only where all of them have a null id. Null and empty texts have
    fingerprint 0 and are linked like any other. Extra columns are not read; an empty table gives no row.
    """
    return _grouped(docs, shingle, radius, tile).select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, shingle: int, radius: int, tile: int) -> DataFrame:
    """The same with ``label``, one fingerprint for each component, as components may share their smallest doc_id."""
    marks = cut_lineage(fingerprints(docs, shingle))
    # equal fingerprints count as one from here on, so copies never meet in pairs
    distinct = cut_lineage(marks.groupBy("fp").agg(F.min("doc_id").alias("first")))
    labels = components(near_links(distinct.select("fp"), radius, tile))
    named = distinct.join(labels, distinct.fp == labels.node, "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    known = named.join(least, "label").select(F.col("fp").alias("f"), "component_id", "label")
    return marks.join(known, marks.fp == F.col("f")).select("doc_id", "fp", "component_id", "label")


def fingerprint_hex(column: str = "fp"):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all their columns, with one document of each group of near-duplicates.

    The document with the smallest id stays, null last, once if its row is repeated. Rows of one id with different
    fingerprints are documents of their own: each may stay or go.
    """
    found = cut_lineage(_grouped(docs, SHINGLE, radius, TILE).select("doc_id", "fp", "label"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp"))
    stay = found.groupBy("label").agg(first.alias("s")).select("s.doc_id", "s.fp")
    mixed = (F.min("fp") != F.max("fp")) | F.col("doc_id").isNull()
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"), mixed.alias("_mixed"))
    stay = join_on(stay, ids, ["doc_id"])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    digest = F.xxhash64(*[c.cast("string") for c in columns]).alias("_place")
    whole = docs.select("doc_id", "text", F.struct(*columns).alias("_row"), digest)
    # as a rule all rows of an id have one fingerprint, and the id alone tells them
    kept = whole.join(stay.where("not _mixed").select(F.col("doc_id").alias("_id"), "_n"), F.col("doc_id") == F.col("_id"))
    rows = kept.where("_n = 1").select("_row")
    # of repeated rows the one with the smallest digest stays; they are told apart without gathering texts
    repeated = cut_lineage(kept.where("_n > 1").groupBy(F.col("_id").alias("_again")).agg(F.min("_place").alias("_least")))
    if not repeated.isEmpty():
        again = kept.join(repeated, (F.col("_id") == F.col("_again")) & (F.col("_place") == F.col("_least")))
        rows = rows.union(again.dropDuplicates(["_again"]).select("_row"))
    named = cut_lineage(stay.where("_mixed").select("doc_id", "fp"))
    if not named.isEmpty():
        some = join_on(whole, named.select("doc_id").distinct(), ["doc_id"], "left_semi")
        some = join_on(fingerprints(some, SHINGLE, ["doc_id", "_row", "_place"]), named, ["doc_id", "fp"])
        least = some.groupBy("doc_id", "fp").agg(F.min("_place").alias("_least"))
        some = join_on(some, least, ["doc_id", "fp"]).where("_place = _least")
        rows = rows.union(some.dropDuplicates(["doc_id", "fp"]).select("_row"))
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
