"""Language-model scores: a unigram over words, and self-attention over subword ids.

A word's subword is its first bytes. The attention model gives the probability of the next subword from those
before; the word itself follows from counts of all training words with that subword. Both factors are proper
distributions, so their product is the probability of the text.

Counts come from all training documents. Texts are cut into slices; a slice keeps its words once, as digests, and its
texts as numbers of these, so that what is shuffled per slice is its vocabulary and not its tokens.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.llm import attention
from citygrain.llm.attention import Attention
from citygrain.llm.common import binary_column, map_arrow, remainder, tokens
from citygrain.scale import cut_lineage, work_folder

#: Bytes of text in a slice.
SLICE = 6 << 20

#: Leading bytes of a word that make its subword.
SUBWORD = 3

#: Subword ids: the most frequent subwords, one for all others, one for the end of a text.
SUBWORDS = 128

#: Rounds of averaging; steps of a task in each, at least; windows of a step.
ROUNDS = 4
STEPS = 120
BATCH = 64

#: Tokens that are trained on together, about, and sums of weights that come to the driver.
TRAINED = 1 << 20
SUMS = 16

#: Windows that go through the model together.
TOGETHER = 128


def held_out(doc_id="doc_id"):
    """Documents that no count and no weight comes from."""
    return remainder(doc_id, 5) == 1


def subword(word: bytes) -> int:
    """The leading bytes of a word as a number."""
    return int.from_bytes(word[:SUBWORD], "big") | len(word[:SUBWORD]) << 24


def subwords(words: list[bytes]) -> np.ndarray:
    """:func:`subword` of many words."""
    size = np.minimum(np.fromiter(map(len, words), np.int64, len(words)), SUBWORD)
    leading = np.array(words, f"S{SUBWORD}").view(np.uint8).reshape(len(words), SUBWORD).astype(np.int64)
    out = np.zeros(len(words), np.int64)
    for i in range(SUBWORD):
        out = np.where(size > i, out << 8 | leading[:, i], out)
    return out | size << 24


def _sliced(docs: DataFrame) -> DataFrame:
    """One row for each slice: ids, training flags and sizes of its texts, word numbers, and its words with counts."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches) -> Iterator[dict]:
        number = count(TaskContext.get().partitionId() << 32)
        pack = zstandard.ZstdCompressor(level=3)
        empty = lambda: {"doc_id": [], "train": [], "rows": [], "bytes": 0}
        held = empty()

        def sent() -> dict:
            ids: defaultdict[bytes, int] = defaultdict(count().__next__)
            sizes = np.array([len(row) for row in held["rows"]], np.int64)
            sequence = np.fromiter(map(ids.__getitem__, chain.from_iterable(held["rows"])), np.int32, sizes.sum())
            learned = sequence[np.repeat(np.array(held["train"], bool), sizes)]
            # planes of bytes, as the upper ones hardly vary
            planes = sequence.view(np.uint8).reshape(-1, 4).T.tobytes()
            return {
                "slice": [next(number)],
                "doc_id": [held["doc_id"]],
                "train": [held["train"]],
                "sizes": [sizes.tolist()],
                "sequence": [pack.compress(planes)],
                "words": [[xxhash.xxh64_intdigest(w) - (1 << 63) for w in ids]],
                "heads": [subwords(list(ids)).astype(np.int32)],
                "n": [np.bincount(learned, minlength=len(ids)).tolist()],
            }

        for batch in batches:
            columns = batch.column("doc_id").to_pylist(), batch.column("train").to_pylist(), binary_column(batch, "text")
            for doc_id, train, text in zip(*columns):
                if held["rows"] and held["bytes"] + len(text) > SLICE:
                    yield sent()
                    held = empty()
                held["doc_id"].append(doc_id)
                held["train"].append(train)
                held["rows"].append(tokens(text))
                held["bytes"] += len(text)
        if held["rows"]:
            yield sent()

    schema = (
        f"slice long, doc_id array<{kind}>, train array<boolean>, sizes array<long>, sequence binary, "
        "words array<long>, heads array<int>, n array<long>"
    )
    return map_arrow(docs.select("doc_id", "text", (~held_out()).alias("train")), run, schema)


def sequence_of(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view(np.int32).ravel()


class Inputs:
    """Subword ids of a slice's texts: each begins with the end of another and ends with its own."""

    def __init__(self, sizes: np.ndarray, sequence: np.ndarray, heads: np.ndarray, known: np.ndarray):
        """``known``: sorted subwords that have an id; others share one, and the last id is the end."""
        at = np.minimum(np.searchsorted(known, heads), max(0, len(known) - 1))
        of_word = np.where(known[at] == heads, at, len(known)) if len(known) else np.zeros(len(heads), np.int64)
        self.end = len(known) + 1
        self.of_word = of_word
        self.sizes = sizes + 1
        ends = np.cumsum(self.sizes) - 1
        self.targets = np.full(self.sizes.sum(), self.end, np.int64)
        inside = np.ones(len(self.targets), bool)
        inside[ends] = False
        self.targets[inside] = of_word[sequence]
        self.given = np.concatenate([[self.end], self.targets[:-1]]) if len(self.targets) else self.targets

    def windows(self, keep: np.ndarray | None = None, stride: int = attention.STRIDE, turn: int | None = None):
        """Windows of ids, their targets, which positions they score and hold, and the first position scored.

        With ``keep`` only those of some texts, with ``turn`` only a share of them: what is left out is not built. Windows
        that begin a text go together, and so do those that go on in one.
        """
        start, length, scored, owner = attention.windows(self.sizes, stride=stride)
        pick = np.ones(len(start), bool) if keep is None else keep[owner]
        if turn is not None:
            # a window has the same turn in every round, whatever else the task holds
            mixed = (np.cumsum(pick).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            pick &= mixed % np.uint64(ROUNDS) == np.uint64(turn)
        reach = np.arange(attention.WINDOW)
        for first in np.unique(scored[pick]).tolist():
            some = np.flatnonzero(pick & (scored == first))
            for a in range(0, len(some), TOGETHER):
                part = some[a : a + TOGETHER]
                at = np.minimum(start[part, None] + reach, len(self.targets) - 1)
                inside = reach < length[part, None]
                yield self.given[at], self.targets[at], inside & (reach >= first), inside, owner[part], first


def _train(slices: DataFrame, known: np.ndarray, total: int) -> Attention:
    """Local training on all slices, whose weights are averaged by windows after every round.

    Windows side by side cover all ``total`` training tokens; every round takes its share of them, so each is trained on
    once, or more often where there are few.
    """
    spark = slices.sparkSession
    picked = slices.select("train", "sizes", "sequence", "heads").coalesce(max(1, total // TRAINED))
    model = Attention(len(known) + 2)
    names = sorted(model.weights)
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((model.weights, known))

        def run(batches, turn=turn, shared=shared) -> Iterator[dict]:
            weights, known = shared.value
            local = Attention(len(known) + 2, weights={k: v.copy() for k, v in weights.items()})
            task, held, done, steps = TaskContext.get().partitionId(), [], 0, 0

            def trained(least: int) -> tuple[int, int]:
                given, targets, real = (np.concatenate(x) for x in zip(*held))
                n = max(-(-len(given) // BATCH), least)
                local.train(given, targets, real.astype(np.float32), n, 0.01 * 0.5**turn, BATCH, turn)
                return len(given), n

            for batch in batches:
                for i in range(batch.num_rows):
                    row = {c: batch.column(c)[i] for c in ("train", "sizes", "sequence", "heads")}
                    heads = np.asarray(row["heads"].values).astype(np.int64)
                    inputs = Inputs(np.asarray(row["sizes"].values), sequence_of(row["sequence"].as_py()), heads, known)
                    keep = np.array(row["train"].as_py(), bool)
                    # windows are chosen before they are built
                    held += [x[:2] + x[3:4] for x in inputs.windows(keep, attention.WINDOW, turn)]
                    if sum(len(x[0]) for x in held) * attention.WINDOW * ROUNDS >= TRAINED:
                        n, more = trained(0)
                        held, done, steps = [], done + n, steps + more
            if held:
                n, _ = trained(STEPS - steps)
                done += n
            if done:
                flat = np.concatenate([local.weights[k].ravel() for k in names]).astype(np.float64) * done
                yield {"task": [task], "part": [task % SUMS], "n": [done], "weights": [flat.tobytes()]}

        def added(batches) -> Iterator[dict]:
            n, flat = 0, 0.0
            for batch in batches:
                for more, weights in zip(batch.column("n").to_pylist(), batch.column("weights").to_pylist()):
                    n, flat = n + more, flat + np.frombuffer(weights)
            if n:
                yield {"n": [n], "weights": [flat.tobytes()]}

        sums = map_arrow(picked, run, "task int, part int, n long, weights binary")
        sums = map_arrow(sums.repartition(SUMS, "part").sortWithinPartitions("task").select("n", "weights"), added, "n long, weights binary")
        # a fixed number of rows
        found = sums.collect()
        shared.unpersist()
        if not found:
            break
        mean, at = sum(np.frombuffer(r.weights) for r in found) / sum(r.n for r in found), 0
        for k in names:
            n = model.weights[k].size
            model.weights[k] = mean[at : at + n].reshape(model.weights[k].shape).astype(np.float32)
            at += n
    return model


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of ``docs``.

    Learns from the rows that are not held out. A null or empty text is one end token; repeated rows count each;
    a null id counts as an empty text for the fold; extra columns are not read; an empty table gives no row, and without
    training rows every count is zero. Words are told apart by 64-bit digests.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "lm-slices")
    _sliced(docs).write.option("compression", "zstd").parquet(folder)
    slices = spark.read.parquet(folder)
    word = F.posexplode(F.arrays_zip("words", "heads", "n")).alias("at", "w")
    vocabulary = slices.select("slice", word).select("slice", "at", F.col("w.words").alias("h"), F.col("w.heads").alias("head"), F.col("w.n").alias("n"))
    counts = vocabulary.where("n > 0").groupBy(F.col("h").alias("known_h")).agg(F.sum("n").alias("c"), F.min("head").alias("head"))
    counts = cut_lineage(counts)
    by_head = counts.groupBy("head").agg(F.sum("c").alias("c"), F.count("*").alias("v"))
    by_head = cut_lineage(by_head)
    totals = by_head.agg(F.sum("c"), F.sum("v")).first()
    ends = slices.agg(F.sum(F.aggregate("train", F.lit(0).cast("long"), lambda a, x: a + x.cast("long")))).first()[0] or 0
    words, kinds = totals[0] or 0, totals[1] or 0
    # a fixed number of rows
    top = sorted((r.head, r.c, r.v) for r in by_head.orderBy(F.desc("c"), "head").limit(SUBWORDS - 2).collect())
    known = np.array([h for h, _, _ in top], np.int64)
    total = words + ends
    distinct = kinds + (ends > 0)
    # tokens and distinct words of every subword id; the end is a word of its own
    sizes = [(c, v) for _, c, v in top]
    sizes += [(words - sum(c for c, _ in sizes), kinds - sum(v for _, v in sizes)), (ends, 1)]
    within = np.log10([c + 0.5 * (v + 1) for c, v in sizes])
    model = _train(slices, known, total)
    counted = vocabulary.select("slice", "at", "h").join(counts.select("known_h", "c"), F.col("h") == F.col("known_h"), "left")
    # as many rows as a slice has words
    counted = counted.groupBy(F.col("slice").alias("s")).agg(F.collect_list(F.struct("at", F.coalesce("c", F.lit(0)).alias("c"))).alias("counts"))
    joined = slices.select("slice", "doc_id", "train", "sizes", "sequence", "heads").join(counted, F.col("slice") == F.col("s"), "left")
    shared = spark.sparkContext.broadcast((model.weights, known, within))

    def run(batches) -> Iterator[dict]:
        weights, known, within = shared.value
        model = Attention(len(known) + 2, weights=weights)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("doc_id", "train", "sizes", "sequence", "heads", "counts")}
                held = np.asarray(row["sizes"].values)
                own = _word_counts(row["counts"].values, len(row["heads"]))
                sequence = sequence_of(row["sequence"].as_py())
                inputs = Inputs(held, sequence, np.asarray(row["heads"].values).astype(np.int64), known)
                yield {
                    "doc_id": row["doc_id"].values,
                    "held_out": [not t for t in row["train"].as_py()],
                } | _scores(model, inputs, held, sequence, own, ends, total, distinct, within)

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_arrow(
        joined.select("doc_id", "train", "sizes", "sequence", "heads", "counts"),
        run,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    return scored


def _word_counts(pairs: pa.Array | None, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    if pairs is not None and len(pairs):
        out[pairs.field("at").to_numpy(zero_copy_only=False)] = pairs.field("c").to_numpy(zero_copy_only=False)
    return out


def _scores(model, inputs: Inputs, sizes, sequence, counts, ends, total, distinct, within) -> dict:
    """Token numbers and both scores of every text of a slice."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    seen = counts[sequence]
    # the words' own factor is the same in both scores
    word_part = np.bincount(owner, np.log10(seen + 0.5), n) + np.log10(ends + 0.5)
    base = word_part - (sizes + 1) * np.log10(total + 0.5 * (distinct + 1))
    all_owners = np.repeat(np.arange(n), inputs.sizes)
    score = word_part - np.bincount(all_owners, within[inputs.targets], n)
    for given, targets, scored, _, text, first in inputs.windows():
        rows, columns = np.nonzero(scored)
        found = model.log_probabilities(given, rows, columns, targets[rows, columns], first)
        score += np.bincount(text[rows], found, n) / np.log(10)
    return {
        "n_tokens": sizes + 1,
        "n_known": np.bincount(owner[seen > 0], minlength=n) + (ends > 0),
        "train_tokens": [total] * n,
        "base_score": base,
        "score": score,
    }
