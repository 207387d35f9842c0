"""Removal of long repeated byte strings with a logarithmic family of sparse suffix arrays.

Every string of ``LONG`` bytes is represented by one of the suffixes that start inside it: the one whose first
``GRAM`` bytes have the least fingerprint. Equal strings pick equal suffixes, so suffixes picked by no string need
not be in any array. A string is thus known by the fingerprint of its suffix and by where that starts in it;
neighbouring strings with the same suffix form one entry, whose context is all their bytes.

Strings are made of bytes, or of words for passages that are measured in words; a word is then known by its digest.

Each task keeps a family of suffix arrays of these entries: a new batch gets a sorted array, arrays
of equal size are merged, and the merge scan counts entries that are equal over their whole context. What the
tasks have is merged once more by suffix. Entries with an equal context elsewhere are repeated throughout. Entries
whose suffix recurs in other contexts are compared string by string, again by merge scans of sorted arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.llm.common import WORD_BYTES, binary_column, map_arrow
from citygrain.scale import work_folder

#: Bytes of a string that may stand only once.
LONG = 400

#: Bytes of a suffix that its fingerprint covers.
GRAM = 160

#: Bytes of text that get a suffix array together; longer texts are cut, with an overlap.
BATCH = 1 << 19

#: The same measures for strings of words: every passage of over 50 words holds one of these.
LONG_WORDS, GRAM_WORDS, BATCH_WORDS = 50, 20, 1 << 17

#: Rows of entries that are put in order together.
ROWS = 1 << 16

#: Contexts of one suffix that are compared in one task; strings of more are dealt out by digest.
GROUP = 256

_CODES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """First byte and end of every word, and the text in small letters with a space for all else."""
    plain = text.translate(WORD_BYTES)
    edges = np.flatnonzero(np.diff(np.frombuffer(b" " + plain + b" ", np.uint8) != 32))
    return edges[::2], edges[1::2], plain


class Words:
    """Words as numbers: a fingerprint of up to 64 letters in one go, of longer words one by one."""

    most, chunk = 64, 1 << 19

    def __init__(self):
        self.up = _powers(_FACTOR, self.chunk + self.most)
        self.down = _powers(pow(_FACTOR, -1, 1 << 64), self.chunk + self.most)

    def encode(self, text: bytes) -> np.ndarray:
        starts, ends, plain = word_places(text)
        data = np.frombuffer(plain, np.uint8)
        out = np.zeros(len(starts), np.uint64)
        for low in range(0, len(data), self.chunk):
            a, b = np.searchsorted(starts, (low, low + self.chunk))
            if a == b:
                continue
            part = data[low : low + self.chunk + self.most]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_CODES[part] * self.up[: len(part)], out=sums[1:])
            first = starts[a:b] - low
            out[a:b] = (sums[np.minimum(ends[a:b] - low, len(part))] - sums[first]) * self.down[first]
        for i in np.flatnonzero(ends - starts > self.most).tolist():
            out[i] = xxhash.xxh3_64_intdigest(plain[starts[i] : ends[i]])
        return _mixed(out)


class Scanner:
    """Entries of texts: suffix fingerprint, context digest, and place. Texts are sequences of bytes or of words."""

    def __init__(self, long: int = LONG, gram: int = GRAM, batch: int = BATCH, words: bool = False):
        if not 0 < long - gram < 256:
            raise ValueError("a suffix must start in the first 256 symbols of a string")
        self.long, self.gram, self.batch = long, gram, batch
        self.bits = (batch + long).bit_length()
        self.up = _powers(_FACTOR, batch + long)
        self.down = _powers(pow(_FACTOR, -1, 1 << 64), batch + long)
        self.words = Words() if words else None
        self.width = 8 if words else 1

    def encode(self, text: bytes) -> np.ndarray:
        """The symbols of a text."""
        return self.words.encode(text) if self.words else np.frombuffer(text, np.uint8)

    def fingerprints(self, data: np.ndarray) -> np.ndarray:
        """Of the ``gram`` symbols from every position on."""
        codes = data | np.uint64(1) if self.words else _CODES[data]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes * self.up[: len(data)], out=sums[1:])
        return _mixed((sums[self.gram :] - sums[: -self.gram]) * self.down[: len(data) - self.gram + 1])

    def picked(self, marks: np.ndarray) -> np.ndarray:
        """The suffix of the string at every position: least mark, then leftmost."""
        low = np.uint64((1 << self.bits) - 1)
        keys = (marks & ~low) | np.arange(len(marks), dtype=np.uint64)
        width = self.long - self.gram + 1
        padded = np.concatenate([keys, np.full(-len(keys) % width, ~np.uint64(0))]).reshape(-1, width)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[: len(keys) - width + 1], ahead[width - 1 : len(keys)])
        return (least & low).astype(np.int64)

    def pieces(self, texts: list[bytes]) -> Iterator[list[tuple[int, int, np.ndarray]]]:
        """Lists of (text number, offset, symbols), ``batch`` symbols together at most."""
        held, size = [], 0
        for i, text in enumerate(map(self.encode, texts)):
            if len(text) < self.long:
                continue
            for at in range(0, len(text) - self.long + 1, self.batch):
                piece = text[at : at + self.batch + self.long - 1]
                if held and size + len(piece) > self.batch:
                    yield held
                    held, size = [], 0
                held.append((i, at, piece))
                size += len(piece)
        if held:
            yield held

    def entries(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """Arrays text, suffix, context, place for each piece list; see :func:`place`."""
        for held in self.pieces(texts):
            flat = np.concatenate([p for _, _, p in held])
            data, width = flat.tobytes(), self.width
            starts = np.concatenate([[0], np.cumsum([len(p) for _, _, p in held])])
            marks = self.fingerprints(flat)
            suffix = self.picked(marks)
            piece = np.searchsorted(starts, np.arange(len(suffix)), "right") - 1
            at = np.flatnonzero(np.arange(len(suffix)) + self.long <= starts[piece + 1])
            own = suffix[at]
            cuts = np.flatnonzero((np.diff(own) != 0) | (np.diff(at) != 1)) + 1
            first = at[np.concatenate([[0], cuts])]
            last = at[np.concatenate([cuts - 1, [len(at) - 1]])]
            own = suffix[first]
            offset = own - first
            digest = xxhash.xxh3_64_intdigest
            context = np.fromiter(
                (digest(data[a:b], o) for a, b, o in zip((first * width).tolist(), ((last + self.long) * width).tolist(), offset.tolist())),
                np.uint64,
                len(first),
            )
            shift = np.array([o for _, o, _ in held]) - starts[:-1]
            text = np.array([i for i, _, _ in held])
            where = first + shift[piece[first]]
            yield text[piece[first]], marks[own].view(np.int64), context.view(np.int64), place(where, offset, last - first)


def place(start, offset, more):
    """The first string of an entry, where its suffix starts in that, and how many strings follow, as one number."""
    return start << 16 | offset << 8 | more


class Levels:
    """A logarithmic family of sorted arrays of (suffix, context, count, key, place)."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    KIND = np.dtype([("h", "<i8"), ("c", "<i8"), ("n", "<i8"), ("key", "<i8"), ("place", "<i8")])

    def add(self, rows: np.ndarray):
        """A batch becomes a level of its own; levels of about equal size are merged."""
        level = self._scanned(rows)
        while self.levels and len(self.levels[-1]) < 2 * len(level):
            level = self._scanned(np.concatenate([self.levels.pop(), level]))
        if len(level):
            self.levels.append(level)

    def all(self) -> np.ndarray:
        return self._scanned(np.concatenate(self.levels)) if self.levels else np.empty(0, self.KIND)

    @classmethod
    def _scanned(cls, rows: np.ndarray) -> np.ndarray:
        """Rows in order, equal ones counted together under the least of their places."""
        rows = rows[np.lexsort((rows["place"], rows["key"], rows["c"], rows["h"]))]
        if not len(rows):
            return rows
        new = np.concatenate([[True], (rows["h"][1:] != rows["h"][:-1]) | (rows["c"][1:] != rows["c"][:-1])])
        first = np.flatnonzero(new)
        out = rows[first]
        out["n"] = np.add.reduceat(rows["n"], first)
        return out


class SortedStrings:
    """A logarithmic family of sorted string digests that marks digests met twice."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.seen = np.zeros(0, bool)

    def add(self, digests: np.ndarray):
        own = np.arange(len(self.seen), len(self.seen) + len(digests))
        self.seen = np.concatenate([self.seen, np.zeros(len(digests), bool)])
        order = np.argsort(digests, kind="stable")
        level = digests[order], own[order]
        self._mark(*level)
        # merge scan of the new array against every level
        for keys, numbers in self.levels:
            at = np.searchsorted(keys, level[0])
            at[at == len(keys)] = 0
            met = keys[at] == level[0]
            self.seen[level[1][met]] = True
            self.seen[numbers[np.isin(keys, level[0][met])]] = True
        while self.levels and len(self.levels[-1][0]) < 2 * len(level[0]):
            keys, numbers = (np.concatenate(x) for x in zip(self.levels.pop(), level))
            order = np.argsort(keys, kind="stable")
            level = keys[order], numbers[order]
        self.levels.append(level)

    def _mark(self, keys: np.ndarray, numbers: np.ndarray):
        same = keys[1:] == keys[:-1]
        self.seen[numbers[1:][same]] = True
        self.seen[numbers[:-1][same]] = True


def strings(context: bytes, offset: int, more: int, long: int, width: int) -> np.ndarray:
    """Digests of all strings of an entry, with the place of the suffix in them."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(
        (digest(context[i * width : (i + long) * width], offset - i) for i in range(more + 1)), np.uint64, more + 1
    ).view(np.int64)


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [(a, b - 1) for a, b in edges.reshape(-1, 2).tolist()]


def _entries(docs: DataFrame, scan: tuple) -> DataFrame:
    """h, c, key, place of all entries; every text is scanned once."""

    def run(batches) -> Iterator[dict]:
        scanner = Scanner(*scan)
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for text, h, c, at in scanner.entries(binary_column(batch, "text")):
                yield {"h": h, "c": c, "key": keys[text], "place": at}

    return map_arrow(docs.select("key", "text"), run, "h long, c long, key long, place long")


def _counted(entries: DataFrame) -> DataFrame:
    """h, c, n, key, place of all entries, equal ones of a task counted together."""

    def run(batches) -> Iterator[dict]:
        levels, held = Levels(), []

        def add():
            rows = np.empty(sum(len(x["key"]) for x in held), Levels.KIND)
            rows["n"] = 1
            for name in ("h", "c", "key", "place"):
                rows[name] = np.concatenate([x[name] for x in held])
            levels.add(rows)
            held.clear()

        def sent() -> dict:
            rows = levels.all()
            return {c: np.ascontiguousarray(rows[c]) for c in Levels.KIND.names}

        for batch in batches:
            held.append({c: batch.column(c).to_numpy() for c in ("h", "c", "key", "place")})
            if sum(len(x["key"]) for x in held) >= ROWS:
                add()
            if sum(map(len, levels.levels)) > 1 << 20:
                yield sent()
                levels = Levels()
        if held:
            add()
        yield sent()

    return map_arrow(entries, run, "h long, c long, n long, key long, place long")


def _packed(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Texts in compressed form, for a shuffle."""

    def run(batches) -> Iterator[dict]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = binary_column(batch, "text")
            yield {c: batch.column(c) for c in carried} | {"packed": [pack.compress(t) for t in texts]}

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in carried)
    return map_arrow(docs.select("text", *carried), run, f"{kinds}, packed binary")


def _written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: it cuts the lineage and takes little room."""
    folder = work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _contexts(docs: DataFrame, open_entries: DataFrame, scan: tuple) -> DataFrame:
    """h, key, place, m, open and the context of entries that must be compared string by string."""
    wanted = open_entries.groupBy("key").agg(F.collect_list(F.struct("h", "place", "m", "open")).alias("entries"))
    joined = _packed(docs, ["key"]).dropDuplicates(["key"]).join(wanted, "key")

    def run(batches) -> Iterator[dict]:
        unpack, scanner = zstandard.ZstdDecompressor(), Scanner(*scan)
        long, width = scanner.long, scanner.width
        for batch in batches:
            for key, packed, entries in zip(*(batch.column(c).to_pylist() for c in ("key", "packed", "entries"))):
                text = scanner.encode(unpack.decompress(packed))
                found = []
                for e in entries:
                    start = e["place"] >> 16
                    found.append(text[start : start + (e["place"] & 255) + long].tobytes())
                yield {k: [e[k] for e in entries] for k in ("h", "place", "m", "open")} | {
                    "key": [key] * len(entries),
                    "context": found,
                }

    schema = "h long, key long, place long, m long, open boolean, context binary"
    return map_arrow(joined.select("key", "packed", "entries"), run, schema)


def _compared(contexts: DataFrame, long: int, width: int) -> DataFrame:
    """key, start, end of repeated runs in open entries; all contexts of a suffix meet in one task."""

    def group(rows: list[tuple]) -> dict:
        family, at = SortedStrings(), [0]
        for a in range(0, len(rows), 64):
            found = [strings(c, p >> 8 & 255, p & 255, long, width) for _, p, _, c in rows[a : a + 64]]
            family.add(np.concatenate(found))
            at += [at[-1] + n for n in np.cumsum([len(f) for f in found]).tolist()]
        out: dict[str, list] = {"key": [], "start": [], "end": []}
        for (key, p, is_open, _), a, b in zip(rows, at, at[1:]):
            if is_open:
                for first, last in runs(family.seen[a:b]):
                    out["key"].append(key)
                    out["start"].append((p >> 16) + first)
                    out["end"].append((p >> 16) + last + long)
        return out

    def run(batches) -> Iterator[dict]:
        held, current = [], None
        for batch in batches:
            for h, *row in zip(*(batch.column(c).to_pylist() for c in ("h", "key", "place", "open", "context"))):
                if held and h != current:
                    yield group(held)
                    held = []
                current = h
                held.append(tuple(row))
        if held:
            yield group(held)

    ordered = contexts.repartition("h").sortWithinPartitions("h", "key", "place")
    return map_arrow(ordered.select("h", "key", "place", "open", "context"), run, "key long, start long, end long")


def _dealt(contexts: DataFrame, long: int, width: int, group: int) -> DataFrame:
    """The same for suffixes with very many contexts: their strings are dealt out by digest, about ``group`` contexts' to a part.

    A context goes to a part as one row with all its strings there, so rows grow with contexts and parts and not with strings.
    """

    def deal(batches) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("h", "part", "key", "place", "open", "at", "w")}
            for h, key, p, is_open, m, context in zip(*(batch.column(c).to_pylist() for c in ("h", "key", "place", "open", "m", "context"))):
                found = strings(context, p >> 8 & 255, p & 255, long, width)
                part = (found.view(np.uint64) >> np.uint64(33)).astype(np.int64) % -(-m // group)
                for k in np.unique(part).tolist():
                    at = np.flatnonzero(part == k)
                    for c, v in zip(out, (h, k, key, p, is_open, at.tolist(), found[at].tolist())):
                        out[c].append(v)
            yield out

    schema = "h long, part long, key long, place long, open boolean, at array<int>, w array<long>"
    parts = map_arrow(contexts.select("h", "key", "place", "open", "m", "context"), deal, schema)

    def group_of(rows: list[tuple]) -> dict:
        family, ends = SortedStrings(), [0]
        for a in range(0, len(rows), 64):
            family.add(np.concatenate([np.array(w, np.int64) for *_, w in rows[a : a + 64]]))
        ends += np.cumsum([len(w) for *_, w in rows]).tolist()
        out: dict[str, list] = {"key": [], "place": [], "at": []}
        for (key, p, is_open, at, _), a, b in zip(rows, ends, ends[1:]):
            seen = np.array(at)[family.seen[a:b]].tolist() if is_open else []
            if seen:
                for c, v in zip(out, (key, p, seen)):
                    out[c].append(v)
        return out

    def compare(batches) -> Iterator[dict]:
        held, current = [], None
        for batch in batches:
            for h, part, *row in zip(*(batch.column(c).to_pylist() for c in ("h", "part", "key", "place", "open", "at", "w"))):
                if held and (h, part) != current:
                    yield group_of(held)
                    held = []
                current = h, part
                held.append(tuple(row))
        if held:
            yield group_of(held)

    ordered = parts.repartition("h", "part").sortWithinPartitions("h", "part", "key", "place")
    seen = map_arrow(ordered, compare, "key long, place long, at array<int>")
    # as many numbers as an entry has strings, 256 at most
    seen = seen.groupBy("key", "place").agg(F.flatten(F.collect_list("at")).alias("at"))

    def join(batches) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {"key": [], "start": [], "end": []}
            for key, p, at in zip(*(batch.column(c).to_pylist() for c in ("key", "place", "at"))):
                flags = np.zeros(256, bool)
                flags[at] = True
                for first, last in runs(flags):
                    for c, v in zip(out, (key, (p >> 16) + first, (p >> 16) + last + long)):
                        out[c].append(v)
            yield out

    return map_arrow(seen, join, "key long, start long, end long")


def repeated_spans(
    docs: DataFrame, long: int = LONG, gram: int = GRAM, batch: int = BATCH, group: int = GROUP, words: bool = False
) -> DataFrame:
    """key, spans: the ranges of symbols of ``docs`` (key, text) that lie in strings which start anywhere else too."""
    scan = (long, gram, batch, words)
    width = 8 if words else 1
    entries = _written(_entries(docs, scan), "suffix-entries")
    # all counts of a suffix are in one partition from here on, so no further shuffle is needed
    counted = _counted(entries).repartition("h").groupBy("h", "c")
    counted = counted.agg(F.sum("n").alias("n"), F.min(F.struct("key", "place")).alias("first"))
    suffix = Window.partitionBy("h")
    known = counted.withColumns({"m": F.count("*").over(suffix), "all": F.sum("n").over(suffix)}).where("`all` > 1")
    known = known.select(F.col("h").alias("kh"), F.col("c").alias("kc"), "n", "first", "m")
    met = entries.join(known, (F.col("h") == F.col("kh")) & (F.col("c") == F.col("kc")))
    is_first = (F.col("key") == F.col("first.key")) & (F.col("place") == F.col("first.place"))
    hits = _written(met.select("h", "key", "place", "m", (F.col("n") == 1).alias("open"), is_first.alias("is_first")), "suffix-hits")
    contexts = hits.where("m > 1 and (open or is_first)").dropDuplicates(["key", "place"])
    contexts = _written(_contexts(docs, contexts, scan), "suffix-contexts")
    start = F.shiftright("place", 16)
    whole = hits.where("not open").select("key", start.alias("start"), (start + F.col("place").bitwiseAND(F.lit(255)) + long).alias("end"))
    few, many = contexts.where(F.col("m") <= group), contexts.where(F.col("m") > group)
    parts = _compared(few, long, width).union(_dealt(many, long, width, group))
    # as many spans as a text has entries
    return whole.union(parts).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching ranges."""
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(
    docs: DataFrame,
    long: int = LONG,
    gram: int | None = None,
    batch: int = BATCH,
    group: int = GROUP,
    carried: list[str] | None = None,
    characters: bool = False,
    words: bool = False,
    passages: int | None = None,
) -> DataFrame:
    """doc_id (or the ``carried`` columns), n_bytes, spans (start, end) and ``kept``, the bytes left of every text.

    One row per row of ``docs``. A byte goes if any string of ``long`` bytes that covers it starts anywhere
    else as well: in another text, elsewhere in this one, or in a repetition of this row. Strings are judged on
    the input, so all their occurrences go. Null and empty texts have no bytes; texts shorter than ``long`` keep
    all; a null id is an id like any other; extra columns are not read. ``kept`` may begin or end inside a
    character; with ``characters`` the rest of a cut character goes too.

    With ``words``, ``long`` and ``gram`` count words of letters, digits and non-ASCII characters, A-Z taken as small, and
    a string is a row of words whatever stands between them; ranges are still of bytes, from the first word to the last.

    With ``passages`` there is a column n_passages: the maximal runs of the text that lie in rows of so many words which start
    anywhere else too. They are found by a second family, and nothing is removed for them.
    """
    carried = carried or ["doc_id"]
    gram = gram or max(long - 255, min(GRAM_WORDS if words else GRAM, long // 2))
    # identical rows share a key; each still counts, as a string in both stands twice
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(keyed, long, gram, batch, group, words).withColumnRenamed("key", "k")
    if passages:
        found = repeated_spans(keyed, passages, max(passages - 255, min(GRAM_WORDS, passages // 2)), BATCH_WORDS, group, True)
        found = found.select(F.col("key").alias("pk"), _run_count("spans").alias("n_passages"))
        spans = spans.join(found, F.col("k") == F.col("pk"), "full_outer").select(F.coalesce("k", "pk").alias("k"), "spans", "n_passages")
    joined = _packed(keyed, [*carried, "key"]).join(spans, F.col("key") == F.col("k"), "left")

    def run(batches) -> Iterator[dict]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out: dict[str, list] = {"n_bytes": [], "spans": [], "kept": []}
            for packed, spans in zip(batch.column("packed").to_pylist(), batch.column("spans").to_pylist()):
                text = unpack.decompress(packed)
                gone = merged(spans or [])
                if words and gone:
                    starts, ends, _ = word_places(text)
                    gone = [(int(starts[a]), int(ends[b - 1])) for a, b in gone]
                edges = [0, *(x for span in gone for x in span), len(text)]
                out["n_bytes"].append(len(text))
                out["spans"].append([{"start": a, "end": b} for a, b in gone])
                kept = [text[a:b] for a, b in zip(edges[::2], edges[1::2])]
                if characters:
                    kept = [k.decode("utf-8", "ignore").encode() for k in kept]
                out["kept"].append(b"".join(kept))
            more = {"n_passages": batch.column("n_passages")} if passages else {}
            yield {c: batch.column(c) for c in carried} | out | more

    kinds = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in carried)
    schema = f"{kinds}n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    if passages:
        counted = joined.withColumn("n_passages", F.coalesce("n_passages", F.lit(0).cast("long")))
        return map_arrow(counted.select("packed", "spans", "n_passages", *carried), run, f"{schema}, n_passages long")
    return map_arrow(joined.select("packed", "spans", *carried), run, schema)


def _run_count(spans: str) -> Column:
    """Maximal runs of overlapping or touching ranges."""
    begin = F.struct(F.lit(-1).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda a, s: F.struct(
        F.greatest(a["end"], s["end"]).alias("end"), (a["n"] + (s["start"] > a["end"]).cast("long")).alias("n")
    )
    return F.aggregate(F.array_sort(spans), begin, step, lambda a: a["n"])


def without_repeats(docs: DataFrame, long: int = LONG, words: bool = False) -> DataFrame:
    """The rows of ``docs``, all their columns, with repeated strings cut out of the texts.

    Strings are ``long`` bytes, or with ``words`` so many words; see :func:`remove_repeats`. Bytes of cut characters at the
    edges go with the string. Rows of which nothing is left go; rows that were
    empty before stay. ``n_chars``, if there is such a column, counts the characters left.
    """
    whole = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    batch = BATCH_WORDS if words else BATCH
    found = remove_repeats(whole, long, batch=batch, carried=["row"], characters=True, words=words)
    found = found.where("octet_length(kept) > 0 or size(spans) = 0")
    cut = F.size("spans") > 0
    new = {"text": F.col("kept").cast("string"), "n_chars": F.length(F.col("kept").cast("string")).cast("long")}
    old = {c: F.col("row").getField(c) for c in docs.columns}
    return found.select(*[F.when(cut, new[c]).otherwise(old[c]).alias(c) if c in new else old[c].alias(c) for c in old])
