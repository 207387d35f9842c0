"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A merge-order vocabulary makes the result of byte-pair merging unique: a token sequence is the merged
one if and only if every neighbouring pair could not have been merged differently across its border.
The encoder therefore walks from longest token to longest token, as the Aho-Corasick automaton reports
them, and steps back whenever a pair is incompatible. Every position is given up at most once, so
the work is linear in the text.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from citygrain.llm.common import binary_column, checked_broadcast, map_arrow

#: Fixed value: the pattern that byte-level vocabularies of this kind split texts by.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: White space that one blank or line end between two visible characters is not.
IRREGULAR = re.compile(r"\s\s|^\s|\s\Z|[^\S \n]")

#: Entries each generation of a cache may hold.
CACHE = 150_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte: itself where visible in Latin-1, else 256 onwards."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Generations:
    """A cache of bounded size that forgets what was not asked for lately."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value):
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Bpe:
    """Encoder and decoder for one vocabulary file (byte-level, ids in the order of merges)."""

    def __init__(self, definition: str, cache: int = CACHE):
        parsed = json.loads(definition)
        alphabet = byte_alphabet()
        vocabulary = parsed["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for text, i in vocabulary.items():
            if text not in self.special:
                self.bytes_of[i] = bytes(alphabet[c] for c in text)
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        ordinary = {b: i for i, b in enumerate(self.bytes_of) if b and i not in self.special.values()}
        # how each token was made: its two parts, and which token a pair makes
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(size)]
        self.merged: dict[tuple[int, int], int] = {}
        for merge in parsed["model"]["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pair = vocabulary[a], vocabulary[b]
            made = vocabulary[a + b]
            if made <= max(pair):
                raise ValueError("ids must follow the order of merges")
            self.merged[pair] = made
            self.parts[made] = pair
        self.automaton = ahocorasick.Automaton()
        for b, i in ordinary.items():
            self.automaton.add_word(b.decode("latin-1"), (i, len(b) - 1))
        self.automaton.make_automaton()
        # the longest token that is a proper prefix of each token, -1 if none
        self.shorter = [-1] * size
        for b, i in ordinary.items():
            for n in range(len(b) - 1, 0, -1):
                if (j := ordinary.get(b[:n])) is not None:
                    self.shorter[i] = j
                    break
        self.length = [len(b) for b in self.bytes_of]
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        self.id_bytes = [i.to_bytes(4, "little") for i in range(size)]
        self.pairs: dict[int, bool] = {}
        self.cache_size = cache
        self.pieces, self.chunks = Generations(cache), Generations(cache)
        self.split = regex.compile(SPLIT)
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.mark_ids = {c: self.piece_ids(c) for c in ",.;:!?\n"}

    def rest(self):
        """Give back what the next texts are least likely to need; called when a task ends."""
        self.pieces.old, self.chunks.old = {}, {}
        self.pairs.clear()

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves this border: no pair across it, at any depth, merges before its sides do."""
        # undo merges from the latest back; `before` is the merge that a pair must come ahead of to matter
        before, merged, parts = len(self.parts), self.merged, self.parts
        while True:
            if merged.get((left, right), before) < before:
                return False
            undo_left = left > right
            for _ in range(2):
                token = left if undo_left else right
                part = parts[token][1 if undo_left else 0]
                if part != token:
                    break
                undo_left = not undo_left
            else:
                return True
            if undo_left:
                before, left = token, part
            else:
                before, right = token + 1, part

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one piece, exactly as merging gives them."""
        n = len(piece)
        # ends come in order, so the last match seen from a start is its longest
        longest = [-1] * n
        for end, (token, back) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - back] = token
        pairs, length, shorter = self.pairs, self.length, self.shorter
        given_up: set[int] = set()
        out: list[int] = []
        at, last, token = 0, -1, longest[0] if n else -1
        while at < n:
            while token >= 0:
                if last < 0:
                    fits = True
                elif (fits := pairs.get(last << 32 | token)) is None:
                    if len(pairs) >= 2 * self.cache_size:
                        pairs.clear()
                    fits = pairs[last << 32 | token] = self.compatible(last, token)
                if fits and at + length[token] not in given_up:
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                last = token
                token = longest[at] if at < n else -1
            else:
                given_up.add(at)
                token = out.pop()
                at -= length[token]
                last = out[-1] if out else -1
                token = shorter[token]
        return out

    def piece_ids(self, piece: str) -> bytes:
        found = self.pieces.young.get(piece) or self.pieces.get(piece)
        if found is None:
            found = b"".join(map(self.id_bytes.__getitem__, self.encode_piece(piece.encode())))
            self.pieces.put(piece, found)
        return found

    def word_ids(self, chunk: str) -> bytes:
        """Ids of what stands between two blanks, the first of them included."""
        if chunk.isascii():
            if chunk.isalpha():
                return self.piece_ids(" " + chunk)
            word, mark = chunk[:-1], self.mark_ids.get(chunk[-1:])
            if mark is not None and word.isalpha():
                return self.piece_ids(" " + word) + mark
        return b"".join(map(self.piece_ids, self.split.findall(" " + chunk)))

    def encode_plain(self, text: str) -> bytes:
        """Ids, as little-endian 32-bit integers, of a text without special tokens."""
        if IRREGULAR.search(text):
            return b"".join(map(self.piece_ids, self.split.findall(text)))
        # one blank or line end between visible characters is always a border of pieces
        out, cache = [], self.chunks
        for i, line in enumerate(text.split("\n") if text else []):
            if i:
                out.append(self.mark_ids["\n"])
            head, *tail = line.split(" ")
            out += map(self.piece_ids, self.split.findall(head))
            ids = list(map(cache.young.get, tail))
            if None in ids:
                for j, found in enumerate(ids):
                    if found is None:
                        chunk = tail[j]
                        if (found := cache.get(chunk)) is None:
                            cache.put(chunk, found := self.word_ids(chunk))
                        ids[j] = found
            out += ids
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if not self.cut:
            return self.encode_plain(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [self.encode_plain(text[at : m.start()]), np.array([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self.encode_plain(text[at:])])

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the tokens, gathered through the offset table."""
        tokens = np.frombuffer(ids, "<u4")
        if not len(tokens):
            return b""
        starts = self.offset[tokens]
        sizes = self.offset[tokens + 1] - starts
        ends = np.cumsum(sizes)
        places = np.repeat(starts - (ends - sizes), sizes)
        places += np.arange(ends[-1])
        return self.flat[places].tobytes()


_LOADED: dict[str, Bpe] = {}


def loaded(definition: str) -> Bpe:
    """The encoder of this Python worker, built once."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(definition)
        gc.freeze()  # the tables stay for good; the collector need not walk them again
    return _LOADED[key]


def encode_documents(docs: DataFrame, vocabulary: str, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and the ids themselves as ``ids`` (little-endian 32 bit).

    One row per row of ``docs``, repeated rows included. A null text counts as empty: no token, and the
    digests are those of nothing. Other columns are not read, so their names may be anything. Rows are
    independent; a text of any length is handled by one task, and the caches of a worker are bounded.
    ``vocabulary`` is the path of a tokenizer file on the driver; it is at most 16 MB and is broadcast.
    """
    with open(vocabulary, encoding="utf-8") as f:
        definition = f.read()
    shared = checked_broadcast(docs.sparkSession, definition, len(definition), 16 << 20, "vocabulary")

    def run(batches) -> Iterator[dict]:
        bpe = loaded(shared.value)
        for batch in batches:
            ids = [bpe.encode(t.decode("utf-8", "replace")) for t in binary_column(batch, "text")]
            out = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                # bytes that form no character are replaced, as in any decoded text
                "decoded_sha256": [
                    hashlib.sha256(bpe.decode(x).decode("utf-8", "replace").encode()).hexdigest() for x in ids
                ],
            }
            yield out | ({"ids": ids} if with_ids else {})
        bpe.rest()

    schema = "doc_id {}, n_tokens long, ids_sha256 string, decoded_sha256 string".format(
        docs.schema["doc_id"].dataType.simpleString()
    )
    return map_arrow(docs.select("doc_id", "text"), run, schema + (", ids binary" if with_ids else ""))


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and text of rows with ``ids`` as made by :func:`encode_documents`; null ids give an empty text."""
    with open(vocabulary, encoding="utf-8") as f:
        definition = f.read()
    shared = checked_broadcast(encoded.sparkSession, definition, len(definition), 16 << 20, "vocabulary")

    def run(batches) -> Iterator[dict]:
        bpe = loaded(shared.value)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            yield {
                "doc_id": batch.column("doc_id"),
                "text": [bpe.decode(x or b"").decode("utf-8", "replace") for x in ids],
            }

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_arrow(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, text string")
