"""Edge and node betweenness by hop count, for blocks of sources at once."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.scale import Rounds, cut_lineage, join_on, numbered, with_totals

#: Rows of sources and nodes that a block of sources may have.
BLOCK_ROWS = 200_000_000
#: Sources whose paths through a node travel as one row.
CHUNK = 512
#: Links that every task may hold; more are joined with what was reached, level by level.
TASK_LINKS = 2_000_000
#: Nodes and links in reach of the sources that a task searches from at once.
TASK_REACH = 8_000_000


def betweenness(edges: DataFrame, kind: str = "edge", sources: int | None = None, seed: int = 0,
                by: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Normalized betweenness of each edge (u, v) or node, with the mean over all appended.

    Shortest paths are counted level by level outwards; on the way back nodes pass on what they got from the nodes behind them, and
    scores are sums of that. Up to ``TASK_LINKS`` links are held by every task, and sources are dealt over the tasks, so that nothing is
    shuffled but sums, however many levels there are. Of larger networks, sources are worked on in blocks, so that a block has about
    ``block_rows`` pairs of (source, node). Up to ``CHUNK`` sources that reach a node on one level travel as one row, and
    one bit for each says whether the node was reached before. The result is exact and covers all
    sources, whatever the size; only for edges, and only if ``sources`` asks for it, as many sources are drawn
    by a seeded hash and the result is scaled up. ``by`` names columns, such as the city, that keep networks
    apart: each is normalized by its own nodes and has its own mean.
    """
    if sources is not None and by:
        raise ValueError("sources are drawn from one network")
    if sources is not None and kind != "edge":
        raise ValueError("sources can be drawn for edge betweenness only")
    by = list(by)
    pairs = cut_lineage(edges.where("u <> v").select(*by, "u", "v").distinct())
    nodes = cut_lineage(pairs.select(*by, F.explode(F.array("u", "v")).alias("node")).distinct())
    counted = nodes.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    totals = counted.agg(F.sum("_n").alias("n"), F.sum(F.col("_n") * F.col("_n")).alias("rows")).first()
    n, rows = int(totals["n"] or 0), totals["rows"] or 0
    # numbers name nodes of all networks, and sources by their place in a chunk
    names = cut_lineage(numbered(nodes, [*by, "node"], "_at"))
    starts, k = names.withColumn("_source", F.col("_at")), n
    if sources is not None and sources < n:
        hashed = names.withColumn("_h", F.xxhash64(F.lit(seed), "node"))
        starts = numbered(hashed, ["_h", "node"], "_source").where(F.col("_source") < sources)
        k, rows = sources, sources * n
    keys = [*by, "u", "v"] if kind == "edge" else [*by, "node"]
    named = lambda c: names.select(*by, F.col("node").alias(c), F.col("_at").alias(f"_{c}"))
    links = cut_lineage(pairs.join(named("u"), [*by, "u"]).join(named("v"), [*by, "v"]).select("_u", "_v"))
    if links.count() <= TASK_LINKS:
        scores = _searched(starts.select("_at"), links, kind, n)
    else:
        blocks = max(1, math.ceil(rows / block_rows))
        chunk = max(1, min(CHUNK, math.ceil(k / blocks)))
        starts = cut_lineage(
            starts.select(F.floor(F.col("_source") / chunk).alias("chunk"), F.col("_at").alias("node"), F.pmod("_source", F.lit(chunk)).alias("at"))
        )
        done = Rounds(edges.sparkSession, "betweenness_blocks")
        for block in range(blocks):
            found = done.cut(_block_scores(starts.where(F.pmod("chunk", F.lit(blocks)) == block), links, kind, chunk))
        scores = done.finish(done.together(range(1, blocks + 1), found.schema))
    out = (pairs if kind == "edge" else nodes).withColumn("score", F.lit(0.0))
    if kind == "edge":
        scores = scores.join(named("u"), "_u").join(named("v").drop(*by), "_v")
    else:
        scores = scores.join(named("node"), scores["_u"] == F.col("_node"))
    summed = out.unionByName(scores.select(*out.columns)).groupBy(*keys).agg(F.sum("score").alias("score"))
    # ordered pairs of nodes that a path can join, of each network
    size = F.col("_n") - 1
    possible = counted.select(*by, (F.col("_n") * size if kind == "edge" else size * (size - 1)).alias("_pairs"))
    scaled = join_on(summed, possible, by) if by else summed.withColumn("_pairs", possible.select("_pairs").scalar())
    centrality = F.col("score") * (n / k if k else 1.0) / F.when(F.col("_pairs") > 0, F.col("_pairs")).otherwise(F.lit(1.0))
    return with_totals(scaled.select(*keys, centrality.alias("centrality")), by, mean_centrality=F.avg("centrality"))


def _block_scores(starts: DataFrame, links: DataFrame, kind: str, chunk: int) -> DataFrame:
    """Scores of links (_u, _v) or of nodes (_u) from the shortest paths of some sources (chunk, node, at)."""
    rounds = Rounds(starts.sparkSession, "betweenness")
    reached = "chunk long, node long, seen binary, at binary, paths binary"
    first = lambda batches: _levels(batches, chunk, True)
    further = lambda batches: _levels(batches, chunk, False)
    levels = [rounds.cut(_dealt(starts.select("chunk", "node", "at"), "at").mapInArrow(first, reached))]
    open_rows = F.octet_length("at") > 0
    for _ in count(1):
        here = levels[-1]
        step = here.where(open_rows).join(links, F.col("node") == F.col("_u"))
        step = step.select("chunk", F.col("_v").alias("node"), F.lit(None).cast("binary").alias("seen"), "at", "paths")
        known = here.select("chunk", "node", "seen", *[F.lit(None).cast("binary").alias(c) for c in ("at", "paths")])
        level = rounds.cut(_dealt(known.unionByName(step)).mapInArrow(further, reached))
        if level.where(open_rows).isEmpty():
            break
        levels.append(level)
    owed = "chunk long, node long, at binary, share binary, v long, score double"
    back = lambda batches: _shares(batches, chunk, kind == "edge")
    passed, scored = None, []
    for level in range(len(levels) - 1, -1, -1):
        # a source is no inner node of its own paths, and nothing is behind the last level
        own = levels[level].where(open_rows).select("chunk", "node", "at", "paths", F.lit(None).cast("long").alias("v"))
        if passed is not None:
            sent = passed.where(open_rows).join(links, F.col("node") == F.col("_v"))
            own = own.unionByName(sent.select("chunk", F.col("_u").alias("node"), "at", F.col("share").alias("paths"), F.col("_v").alias("v")))
        passed = rounds.cut(_dealt(own, "v").mapInArrow(back, owed))
        if kind == "edge" or level > 0:
            scored.append(rounds.number)
    scores = rounds.together(scored, passed.schema) if scored else passed.limit(0)
    scores = scores.where("score is not null").select(F.col("node").alias("_u"), F.col("v").alias("_v"), "score")
    ends = ["_u", "_v"] if kind == "edge" else ["_u"]
    # one row per link or node is left of a block
    return rounds.finish(scores.groupBy(*ends).agg(F.sum("score").alias("score")))


class Links(NamedTuple):
    """A graph as every task holds it: the links of a node one after another, and the nodes of a component too.

    A search needs places for the nodes of its component only. ``shift`` is how far the places of both ends of a link are apart.
    """

    first: np.ndarray  # of each node, its first link
    u: np.ndarray
    v: np.ndarray
    shift: np.ndarray
    place: np.ndarray  # of each node, in its component
    start: np.ndarray  # of each node, where its component begins in ``order``
    size: np.ndarray  # of each node, the nodes of its component
    reach: np.ndarray  # of each node, the nodes and links of its component
    order: np.ndarray


def _graph(links: DataFrame, n: int) -> Links:
    """Links (_u, _v) between the nodes 0 .. n - 1."""
    table = links.toArrow()
    u, v = (table.column(c).to_numpy().astype(np.int64) for c in ("_u", "_v"))
    by_u = np.lexsort((v, u))
    u, v = u[by_u], v[by_u]
    part = np.arange(n)
    while (open_links := part[u] != part[v]).any():
        a, b = part[u[open_links]], part[v[open_links]]
        np.minimum.at(part, np.maximum(a, b), np.minimum(a, b))
        while (part != part[part]).any():
            part = part[part]
    order = np.argsort(part, kind="stable")
    sizes, held = np.bincount(part, minlength=n), np.bincount(part[u], minlength=n)
    start = (np.cumsum(sizes) - sizes)[part]
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    place -= start
    small = [x.astype(np.int32) for x in (u, v, place[v] - place[u], place, start, sizes[part])]
    return Links(np.searchsorted(u, np.arange(n + 1)), *small, (sizes + held)[part], order.astype(np.int32))


def _searched(starts: DataFrame, links: DataFrame, kind: str, n: int) -> DataFrame:
    """Scores of links (_u, _v) or of nodes (_u) from the shortest paths of sources (_at), each searched in one task."""
    spark, rounds = starts.sparkSession, Rounds(starts.sparkSession, "betweenness")
    graph = _graph(links, n)
    held = spark.sparkContext.broadcast(tuple(graph))
    work = starts.count() * int(graph.reach.max(initial=1))
    tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(work / TASK_REACH)))
    search = lambda batches, reach=TASK_REACH: _paths(batches, held, kind == "edge", reach)
    found = starts.repartition(tasks, "_at").mapInArrow(search, "_u long, _v long, score double")
    ends = ["_u", "_v"] if kind == "edge" else ["_u"]
    out = rounds.finish(rounds.cut(found.groupBy(*ends).agg(F.sum("score").alias("score"))))
    held.destroy()
    return out


def _paths(batches: Iterator[pa.RecordBatch], held: Broadcast, of_edges: bool, reach: int) -> Iterator[pa.RecordBatch]:
    """Sums over the sources of a task, for every link or node that has any."""
    graph = Links(*held.value)
    sources = np.concatenate([np.empty(0, np.int64), *[b.column(0).to_numpy() for b in batches]])
    score = np.zeros(len(graph.u) if of_edges else len(graph.order))
    group = np.cumsum(graph.reach[sources]) // reach
    for some in np.split(sources, np.flatnonzero(np.diff(group)) + 1):
        if len(some):
            _add_scores(some, graph, score, of_edges)
    used = np.flatnonzero(score)
    u, v = (graph.u[used], graph.v[used]) if of_edges else (used, used)
    found = pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(score[used])], names=["_u", "_v", "score"])
    for at in range(0, len(used), 50_000):
        yield found.slice(at, 50_000)


def _add_scores(sources: np.ndarray, graph: Links, score: np.ndarray, of_edges: bool) -> None:
    """Adds what the shortest paths from some sources give, one level of all of them at a time.

    A cell is a source and a node of its component.
    """
    sizes = graph.size[sources].astype(np.int64)
    ends = np.cumsum(sizes)
    base = ends - sizes
    paths, seen, last = np.zeros(ends[-1]), np.zeros(ends[-1], bool), np.empty(ends[-1], np.int64)
    cells, nodes = base + graph.place[sources], sources
    own = cells
    paths[cells], seen[cells] = 1.0, True
    levels = []
    while len(cells):
        first = graph.first[nodes]
        n = graph.first[nodes + 1] - first
        until = np.cumsum(n)
        link = np.arange(until[-1]) + np.repeat(first - until + n, n)
        cell = np.repeat(cells, n)
        to = cell + graph.shift[link]
        new = np.flatnonzero(~seen[to])
        link, cell, to = link[new], cell[new], to[new]
        np.add.at(paths, to, paths[cell])
        # of the links to a cell, one goes on
        at = np.arange(len(to))
        last[to] = at
        one = np.flatnonzero(last[to] == at)
        levels.append((link, cell, to))
        cells, nodes = to[one], graph.v[link[one]]
        seen[cells] = True
    owed = np.zeros(ends[-1])
    for link, cell, to in reversed(levels):
        flow = paths[cell] * ((1 + owed[to]) / paths[to])
        np.add.at(owed, cell, flow)
        if of_edges:
            np.add.at(score, link, flow)
    if not of_edges:
        # a source is no inner node of its own paths
        owed[own] = 0
        node = graph.order[np.arange(ends[-1]) + np.repeat(graph.start[sources] - base, sizes)]
        np.add.at(score, node, owed)


def _dealt(df: DataFrame, *then: str) -> DataFrame:
    """Rows of a node and chunk of sources one after another in one task."""
    return df.repartition("chunk", "node").sortWithinPartitions("chunk", "node", *then)


def _numbers(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers packed in the rows of a binary column, one after another, and how many each row has."""
    column = column.cast(pa.binary())
    size = np.dtype(kind).itemsize
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    n = int(ends[-1] - ends[0]) // size
    flat = np.frombuffer(column.buffers()[2], kind, n, int(ends[0])) if n else np.empty(0, kind)
    return flat, np.diff(ends) // size


def _packed(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column with ``lengths`` of the numbers in each row."""
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths * flat.dtype.itemsize, out=ends[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))])


def _slots(batch: pa.RecordBatch, last: tuple | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slot of each row, and chunk and node of each slot; slot 0 is that of the last key before."""
    chunks, nodes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("chunk", "node"))
    before = last if last is not None else (chunks[0], nodes[0])
    chunks, nodes = np.append(before[0], chunks), np.append(before[1], nodes)
    new = (np.diff(chunks) != 0) | (np.diff(nodes) != 0)
    firsts = np.append(0, np.flatnonzero(new) + 1)
    return np.cumsum(new), chunks[firsts], nodes[firsts]


def _levels(batches: Iterator[pa.RecordBatch], chunk: int, first: bool) -> Iterator[pa.RecordBatch]:
    """Sources that reach a node on this level, with their paths, and all that have reached it so far.

    Rows of a node come together; only the open node's numbers, one for each source of a chunk, are kept from batch to batch.
    """

    def emit(chunks, nodes, paths, seen):
        slot, at = np.nonzero((paths > 0) & ~seen)
        found = np.bincount(slot, minlength=len(nodes))
        bits = np.packbits(seen | (paths > 0), axis=1)
        return pa.RecordBatch.from_arrays(
            [pa.array(chunks), pa.array(nodes), _packed(bits.ravel(), np.full(len(nodes), bits.shape[1])),
             _packed(at.astype(np.int32), found), _packed(paths[slot, at], found)],
            names=["chunk", "node", "seen", "at", "paths"],
        )

    last, kept = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        slots, chunks, nodes = _slots(batch, last)
        n = len(nodes)
        if first:
            cells, weights = slots * chunk + batch.column("at").to_numpy(), None
        else:
            at, lengths = _numbers(batch.column("at"), np.int32)
            weights, _ = _numbers(batch.column("paths"), np.float64)
            cells = np.repeat(slots, lengths) * chunk + at
        paths = np.bincount(cells, weights, n * chunk).reshape(n, chunk).astype(np.float64)
        seen = np.zeros((n, chunk), bool)
        if not first:
            bits, lengths = _numbers(batch.column("seen"), np.uint8)
            known = slots[lengths > 0]
            seen[known] = np.unpackbits(bits.reshape(len(known), -1), axis=1, count=chunk).astype(bool)
        if kept is not None:
            paths[0] += kept[0]
            seen[0] |= kept[1]
        if n > 1:
            yield emit(chunks[:-1], nodes[:-1], paths[:-1], seen[:-1])
        last, kept = (chunks[-1], nodes[-1]), (paths[-1].copy(), seen[-1].copy())
    if last is not None:
        yield emit(np.array([last[0]]), np.array([last[1]]), kept[0][None], kept[1][None])


def _shares(batches: Iterator[pa.RecordBatch], chunk: int, of_edges: bool) -> Iterator[pa.RecordBatch]:
    """What a node passes on for each path of a source, from what the nodes behind it pass on to it.

    A node's own row, without ``v``, comes first. Rows with shares of its own have ``at``; rows with ``score`` hold sums over the
    sources of a chunk, for the link to ``v`` or for the node.
    """

    def batch_of(chunks, nodes, at, share, v, score):
        return pa.RecordBatch.from_arrays(
            [pa.array(chunks), pa.array(nodes), at, share, pa.array(v, pa.int64(), mask=None if v is None else np.isnan(score)),
             pa.array(score, pa.float64(), from_pandas=True)],
            names=["chunk", "node", "at", "share", "v", "score"],
        )

    def emit(chunks, nodes, paths, owed):
        slot, at = np.nonzero(paths > 0)
        found = np.bincount(slot, minlength=len(nodes))
        share = (1 + owed[slot, at]) / paths[slot, at]
        score = np.full(len(nodes), np.nan) if of_edges else owed.sum(axis=1)
        return batch_of(chunks, nodes, _packed(at.astype(np.int32), found), _packed(share, found), np.zeros(len(nodes), np.int64), score)

    last, kept = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        slots, chunks, nodes = _slots(batch, last)
        n = len(nodes)
        at, lengths = _numbers(batch.column("at"), np.int32)
        given, _ = _numbers(batch.column("paths"), np.float64)
        cells = np.repeat(slots, lengths) * chunk + at
        own = np.asarray(batch.column("v").is_null())
        is_own = np.repeat(own, lengths)
        paths, owed = np.zeros(n * chunk), np.zeros(n * chunk)
        paths[cells[is_own]] = given[is_own]
        if kept is not None:
            paths[:chunk] += kept[0]
            owed[:chunk] = kept[1]
        sent = ~is_own
        # nothing goes to a node that is not on a shortest path, as it has no paths of this level
        flow = paths[cells[sent]] * given[sent]
        owed += np.bincount(cells[sent], flow, n * chunk)
        paths, owed = paths.reshape(n, chunk), owed.reshape(n, chunk)
        if of_edges and not own.all():
            rows = np.flatnonzero(~own)
            score = np.bincount(np.repeat(np.arange(len(rows)), lengths[rows]), flow, len(rows))
            used = np.flatnonzero(score > 0)
            here = slots[rows[used]]
            v = batch.column("v").take(pa.array(rows[used])).to_numpy(zero_copy_only=False).astype(np.int64)
            none = _packed(np.empty(0), np.zeros(len(used), np.int64))
            yield batch_of(chunks[here], nodes[here], none, none, v, score[used])
        if n > 1:
            yield emit(chunks[:-1], nodes[:-1], paths[:-1], owed[:-1])
        last, kept = (chunks[-1], nodes[-1]), (paths[-1].copy(), owed[-1].copy())
    if last is not None:
        yield emit(np.array([last[0]]), np.array([last[1]]), kept[0][None], kept[1][None])
