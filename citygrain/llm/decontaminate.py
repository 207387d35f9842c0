"""Benchmark decontamination with suffix arrays of the training text.

Every shard of documents gets a suffix array over words; each suffix of each test item is looked up in
it by binary search, which gives all places of its leading words and, at the start of every hit, the longest
verbatim match. Only suffixes that begin with a run of test words long enough to match are kept in the
array: the others cannot match any test suffix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.llm.common import binary_column, checked_broadcast, map_arrow, row_key, slices, words

#: Words in a window.
WINDOW = 13

#: Bytes of text in a shard.
SHARD = 4 << 20

#: Bytes of test text that are held at once.
TEST_BLOCK = 8 << 20

#: Bytes that an index takes for each byte of a block, at most.
INDEX_BYTES = 96


class TestSuffixes:
    """All test suffixes in order, their distinct leading windows, and the items these come from.

    The words of the items are held once, a zero after each item; suffixes are places in them.
    """

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.names = sorted({item for item, _ in items})
        number = {item: i for i, item in enumerate(self.names)}
        rows = [(number[item], words(text)) for item, text in sorted(items)]
        rows = [(i, row) for i, row in rows if row]
        lengths = np.array([len(row) for _, row in rows], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.flat = np.zeros(self.begins[-1], np.int32)
        for at, (_, row) in zip(self.begins, rows):
            self.flat[at : at + len(row)] = [self.ids.setdefault(w, len(self.ids) + 1) for w in row]
        if len(self.ids) >= 1 << 24:
            raise ValueError("a block of test items has too many distinct words")
        self.item = np.array([i for i, _ in rows], np.int32)
        # words from each place to the end of its item
        self.left = np.repeat(self.begins[1:] - 1, lengths + 1) - np.arange(len(self.flat)) if rows else np.zeros(0, np.int64)
        self.left = self.left.astype(np.int32)
        self.order = self._ordered()
        # a window fits, or is the whole of a shorter item
        at = np.flatnonzero((self.left >= window) | ((self.left > 0) & np.isin(np.arange(len(self.flat)), self.begins)))
        keys = np.empty(len(at), f"S{3 * window}")
        for a in range(0, len(at), 1 << 16):
            part = at[a : a + (1 << 16)]
            keys[a : a + len(part)] = packed(self._windows(part))
        self.first, where, owned = np.unique(keys, return_index=True, return_inverse=True)
        self.sizes = np.minimum(self.left[at[where]], window).astype(np.int64)
        owners = np.repeat(self.item, lengths + 1)[at] if rows else np.zeros(0, np.int32)
        pairs = np.unique(owned.astype(np.int64) * (len(self.names) + 1) + owners)
        self.owner = (pairs % (len(self.names) + 1)).astype(np.int32)
        self.owned = np.searchsorted(pairs // (len(self.names) + 1), np.arange(len(self.first) + 1))
        # the key after all keys that begin with the window
        self.last = np.empty(len(self.first), f"S{3 * window}")
        for a in range(0, len(self.first), 1 << 16):
            part = self._windows(at[where[a : a + (1 << 16)]])
            part[part == 0] = (1 << 24) - 1
            self.last[a : a + len(part)] = packed(part)
        self.least = int(self.sizes.min()) if len(self.sizes) else window

    def _windows(self, at: np.ndarray) -> np.ndarray:
        reach = np.arange(self.window)
        rows = self.flat[np.minimum(at[:, None] + reach, len(self.flat) - 1)].astype(np.int64)
        rows[reach >= self.left[at][:, None]] = 0
        return rows

    def _ordered(self) -> np.ndarray:
        """Places of all suffixes in the order of their words, by doubling; equal ones as they lie."""
        rank, step, n = self.flat.astype(np.int64), 1, len(self.flat)
        longest = int(self.left.max()) if n else 0
        while step < longest:
            after = np.zeros(n, np.int64)
            on = np.flatnonzero(self.left > step)
            after[on] = rank[on + step]
            both = rank * (max(n, int(rank.max())) + 1) + after
            _, rank = np.unique(both, return_inverse=True)
            # a separator comes first and no suffix of words has its rank
            step *= 2
        order = np.argsort(rank, kind="stable")
        return order[self.left[order] > 0].astype(np.int32)

    def nbytes(self) -> int:
        """Bytes of all that is held; a word of the dictionary counts 100 besides its letters."""
        arrays = sum(x.nbytes for x in vars(self).values() if isinstance(x, np.ndarray))
        return arrays + sum(len(w) + 100 for w in self.ids) + sum(4 * len(x) + 60 for x in self.names)

    def owners(self, w: int) -> list[str]:
        """The items that have a window."""
        return [self.names[i] for i in self.owner[self.owned[w] : self.owned[w + 1]]]

    def _same(self, row: np.ndarray, at: int) -> int:
        """How many words ``row`` and a suffix have in common."""
        most, done, step = min(len(row), int(self.left[at])), 0, 32
        while done < most:
            end = min(most, done + step)
            apart = np.flatnonzero(row[done:end] != self.flat[at + done : at + end])
            if len(apart):
                return done + int(apart[0])
            done, step = end, 2 * step
        return most

    def longest(self, row) -> tuple[int, str, int]:
        """Length, item and place of the longest test passage that ``row`` begins with."""
        row = np.asarray(row, np.int32)
        low, high = 0, len(self.order)
        while low < high:
            middle = (low + high) // 2
            at = int(self.order[middle])
            same = self._same(row, at)
            before = same < len(row) and (same == self.left[at] or self.flat[at + same] < row[same])
            low, high = (middle + 1, high) if before else (low, middle)
        found = (0, "", 0)
        for at in self.order[max(0, low - 1) : low + 1]:
            same = self._same(row, int(at))
            if same > found[0]:
                own = int(np.searchsorted(self.begins, at, "right") - 1)
                found = (same, self.names[self.item[own]], int(at - self.begins[own]))
        return found


def packed(rows: np.ndarray) -> np.ndarray:
    """Rows of word ids as byte strings that sort as the rows do, three bytes a word."""
    out = np.empty((*rows.shape, 3), np.uint8)
    for k, shift in enumerate((16, 8, 0)):
        out[..., k] = rows >> shift & 255
    width = 3 * rows.shape[1]
    return out.reshape(len(rows), width).view(f"S{width}").ravel()


def shard_matches(texts: list[bytes], test: TestSuffixes) -> tuple[list[int], np.ndarray, list[list[str]], list[list]]:
    """Of each text: words, words inside matches, items, and longest matches (start, words, item, item_start)."""
    split = [words(t) for t in texts]
    counts = np.array([len(x) for x in split], np.int64)
    starts = np.concatenate([[0], np.cumsum(counts + 1)])
    get = test.ids.get
    ids = np.zeros(starts[-1], np.int32)
    for at, row in zip(starts, split):
        ids[at : at + len(row)] = [get(w, 0) for w in row]
    n = len(ids)
    items: list[list[str]] = [[] for _ in texts]
    longest: list[list] = [[] for _ in texts]
    hits = np.zeros(len(texts), np.int64)
    if not n or not len(test.sizes):
        return counts.tolist(), hits, items, longest
    # run: known words from here on; a zero ends every document
    gaps = np.flatnonzero(ids == 0)
    run = np.minimum(gaps[np.searchsorted(gaps, np.arange(n))] - np.arange(n), test.window)
    places = np.flatnonzero(run >= test.least)
    if not len(places):
        return counts.tolist(), hits, items, longest
    reach = np.arange(test.window)
    rows = ids[np.minimum(places[:, None] + reach, n - 1)].astype(np.int64)
    rows[reach >= run[places][:, None]] = 0
    keys = packed(rows)
    order = np.argsort(keys, kind="stable")
    array, keys = places[order], keys[order]
    low = np.searchsorted(keys, test.first, "left")
    high = np.searchsorted(keys, test.last, "right")
    found = np.flatnonzero(high > low)
    if not len(found):
        return counts.tolist(), hits, items, longest
    cover = np.zeros(n + 1, np.int64)
    named: list[set[str]] = [set() for _ in texts]
    for w in found:
        at = array[low[w] : high[w]]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + test.sizes[w], -1)
        for d in np.unique(np.searchsorted(starts, at, "right") - 1):
            named[d].update(test.owners(w))
    covered = np.cumsum(cover[:-1]) > 0
    # every document has its closing zero, so no stretch is empty
    hits = np.add.reduceat(covered.astype(np.int64), starts[:-1])
    edges = np.flatnonzero(covered & ~np.concatenate([[False], covered[:-1]]))
    for p in edges:
        d = int(np.searchsorted(starts, p, "right") - 1)
        end = int(gaps[np.searchsorted(gaps, p)])
        size, item, start = test.longest(ids[p:end])
        longest[d].append((int(p - starts[d]), size, item, start))
    return counts.tolist(), hits, [sorted(x) for x in named], longest


#: The longest match at the start of each run of hit words.
FIELDS = ("start", "words", "item_id", "item_start")
MATCHES = "array<struct<start:long,words:long,item_id:string,item_start:long>>"


def _block_matches(docs: DataFrame, items: list[tuple[str, bytes]], window: int, carried: list[str]) -> DataFrame:
    test = TestSuffixes(items, window)
    shared = checked_broadcast(docs.sparkSession, test, test.nbytes(), INDEX_BYTES * TEST_BLOCK, "index of test items")

    def run(batches) -> Iterator[dict]:
        test = shared.value
        for batch in batches:
            texts = binary_column(batch, "text")
            for a, b in slices([len(t) for t in texts], SHARD):
                n, hit, items, longest = shard_matches(texts[a:b], test)
                yield {c: batch.column(c).slice(a, b - a) for c in carried} | {
                    "n_words": n,
                    "n_hit": hit.tolist(),
                    "items": items,
                    "matches": [[dict(zip(FIELDS, m)) for m in row] for row in longest],
                }

    return map_arrow(docs.select("text", *carried), run, _schema(docs, carried))


def _schema(docs: DataFrame, carried: list[str]) -> str:
    kinds = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in carried)
    return f"{kinds}n_words long, n_hit long, items array<string>, matches {MATCHES}"


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = TEST_BLOCK) -> DataFrame:
    """doc_id, n_words, n_hit, items, matches: one row per row of ``docs``, repeated rows included.

    A window is ``window`` consecutive words of an item, or a whole shorter item; ``n_hit`` counts document
    words inside any occurrence of one. ``items`` holds the distinct ids, as text, of items with a match. A null
    text has no words; a null item id counts as an empty id; rows that share an item id count as one item. An empty
    table of items, or items without words, match nothing. Extra columns are not read.

    The test items are held in blocks of about ``block`` bytes. One block, the usual case, needs no shuffle;
    for more, the words hit are united per document.
    """
    return _found(docs.select("doc_id", "text"), benchmark, window, block, ["doc_id"])


def _found(docs: DataFrame, benchmark: DataFrame, window: int, block: int, carried: list[str]) -> DataFrame:
    tests = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").alias("t")).where(
        F.col("t").isNotNull()
    )
    total = tests.agg(F.sum(F.octet_length("t") + F.octet_length("i") + 1)).first()[0] or 0
    n_blocks = max(1, math.ceil(total / block))
    if n_blocks == 1:
        return _block_matches(docs, [(r.i, r.t.encode()) for r in tests.toLocalIterator()], window, carried)
    keyed = docs.withColumn("k", row_key())
    parts = None
    for k in range(n_blocks):
        # a block's size is bounded, and checked again before it is broadcast
        rows = tests.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == k)
        part = _block_matches(keyed, [(r.i, r.t.encode()) for r in rows.toLocalIterator()], window, ["k"])
        part = part.where("n_hit > 0").select("k", F.explode("items").alias("i"))
        parts = part if parts is None else parts.union(part)
    return _united(keyed, parts.distinct(), tests, window, carried)


def _united(docs: DataFrame, hits: DataFrame, tests: DataFrame, window: int, carried: list[str]) -> DataFrame:
    """Results of several blocks: documents that any block hits are looked at again with just their items."""
    own = hits.join(tests, "i").groupBy("k").agg(F.collect_list(F.struct("i", "t")).alias("tests"))
    joined = docs.join(own, "k", "left")

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            texts = binary_column(batch, "text")
            for i, (text, tests) in enumerate(zip(texts, batch.column("tests").to_pylist())):
                test = TestSuffixes([(x["i"], x["t"].encode()) for x in tests or []], window)
                n, hit, items, longest = shard_matches([text], test)
                yield {c: batch.column(c).slice(i, 1) for c in carried} | {
                    "n_words": n,
                    "n_hit": hit.tolist(),
                    "items": items,
                    "matches": [[dict(zip(FIELDS, m)) for m in longest[0]]],
                }

    return map_arrow(joined.select("text", "tests", *carried), run, _schema(docs, carried))


def contaminated() -> Column:
    """The rule: some word is hit, and hits are a twentieth of the words at least."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = TEST_BLOCK) -> DataFrame:
    """The rows of ``docs``, all their columns, that are not contaminated."""
    # the columns travel as one value beside the text, so nothing is joined back
    whole = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = _found(whole, benchmark, window, block, ["row"]).where(~contaminated())
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
