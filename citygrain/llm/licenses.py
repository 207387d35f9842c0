"""License scans: an exact set-similarity join between text blocks and license templates.

Template words are ordered by how many blocks of the corpus hold them, rarest first. A block that holds
at least ``least`` of a template's words must share one of its rarest ``size - least + 1``; only blocks with
such a word become candidates. Candidates then pass the length filter (enough template words in the block), the
positional filter (enough words left behind the first shared one, in both orders) and the exact count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.llm.common import binary_column, checked_broadcast, map_arrow, words

#: Share of a notice's distinct words that a block must hold.
THRESHOLD = 0.8

#: Words from the start of one block to the next.
STRIDE = 64

#: Phrases that count at every place where their words stand in a row.
PHRASES = {
    "mit": "mit license",
    "apache": "apache license",
    "gpl": "general public license",
}

#: Opening words of common license notices.
NOTICES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-notice": "licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that"
    " the following conditions are met",
    "cc-by": "licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "gpl-3.0": "licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu"
    " general public license as published by the free software foundation",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and"
    " associated documentation files",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}

PLACES = "array<struct<label:string,block:long,containment:double,places:array<long>>>"


@dataclass
class Templates:
    """Templates over numbered words; after :meth:`order`, numbers follow the global frequency order."""

    phrases: dict[str, str]
    notices: dict[str, str]
    threshold: float
    stride: int
    ids: dict[bytes, int] = field(default_factory=dict)
    #: label, whether a phrase, distinct words in order, words as they stand, least words to share
    rows: list[tuple[str, bool, list[int], list[int], int]] = field(default_factory=list)

    def __post_init__(self):
        self.texts = [(k, True, words(v.encode())) for k, v in sorted(self.phrases.items())]
        self.texts += [(k, False, words(v.encode())) for k, v in sorted(self.notices.items())]
        self.texts = [t for t in self.texts if t[2]]
        self.overlap = max([len(t[2]) for t in self.texts], default=1)
        if self.overlap > self.stride:
            raise ValueError("blocks must be as long as the longest template")
        self.order({})

    def order(self, frequency: dict[bytes, int]):
        """Number the words from the rarest to the most frequent, ties by the word."""
        every = {w for _, _, row in self.texts for w in row}
        ranked = sorted(every, key=lambda w: (frequency.get(w, 0), w))
        self.ids = {w: i for i, w in enumerate(ranked)}
        self.rows, self.prefixes = [], {}
        for label, phrase, row in self.texts:
            numbers = sorted({self.ids[w] for w in row})
            least = len(numbers) if phrase else math.ceil(self.threshold * len(numbers) - 1e-9)
            for place in range(len(numbers) - least + 1):
                self.prefixes.setdefault(numbers[place], []).append((len(self.rows), place))
            self.rows.append((label, phrase, numbers, [self.ids[w] for w in row], least))

    def numbered(self, row: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.ids.get, row, repeat(-1)), np.int32, len(row))

    def blocks(self, at: np.ndarray) -> np.ndarray:
        """Block numbers that hold the word positions; blocks overlap, so a position has one or two."""
        block = at // self.stride
        before = (block > 0) & (at - (block - 1) * self.stride < self.stride + self.overlap)
        return np.concatenate([block, block[before] - 1])

    def scan(self, text: bytes) -> tuple[int, list[tuple[str, int, float, list[int]]]]:
        """Number of words, and label, block, containment and places of every template a block holds."""
        row = words(text)
        ids = self.numbered(row)
        wanted = np.flatnonzero(np.isin(ids, list(self.prefixes)))
        found = []
        for block in np.unique(self.blocks(wanted)).tolist() if len(wanted) else []:
            start = block * self.stride
            inside = ids[start : start + self.stride + self.overlap]
            held = np.unique(inside[inside >= 0]).tolist()
            found += self._join(block, start, inside, held)
        return len(row), found

    def _join(self, block: int, start: int, inside: np.ndarray, held: list[int]):
        tried = set()
        for j, word in enumerate(held):
            for t, i in self.prefixes.get(word, ()):
                if t in tried:
                    continue
                tried.add(t)
                label, phrase, numbers, row, least = self.rows[t]
                # length filter, then positional filter: words that can still be shared from here on
                if len(held) < least or min(len(numbers) - i, len(held) - j) < least:
                    continue
                shared = len(set(held).intersection(numbers))
                if shared < least:
                    continue
                places = []
                if phrase:
                    # a place belongs to the block it starts in
                    match = np.ones(max(0, len(inside) - len(row) + 1), bool)
                    for k, w in enumerate(row):
                        match &= inside[k : k + len(match)] == w
                    places = (start + np.flatnonzero(match[: self.stride])).tolist()
                    if not places:
                        continue
                yield label, block, shared / len(numbers), places


def word_blocks(docs: DataFrame, templates: Templates) -> dict[bytes, int]:
    """In how many blocks of all documents each template word stands."""
    size = sum(len(w) for w in templates.ids)
    shared = checked_broadcast(docs.sparkSession, templates, size, 16 << 20, "templates")

    def run(batches) -> Iterator[dict]:
        t = shared.value
        total = np.zeros(len(t.ids), np.int64)
        for batch in batches:
            for text in binary_column(batch, "text"):
                ids = t.numbered(words(text))
                at = np.flatnonzero(ids >= 0)
                if len(at):
                    # a word counts once in each block it starts
                    total += np.bincount(np.unique(at // t.stride * len(t.ids) + ids[at]) % len(t.ids), minlength=len(t.ids))
        yield {"id": list(range(len(total))), "n": total.tolist()}

    counted = map_arrow(docs.select("text"), run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # one row for each template word
    by_id = {r.id: r.n for r in counted.collect()}
    return {w: by_id.get(i, 0) for w, i in templates.ids.items()}


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
    stride: int = STRIDE,
) -> DataFrame:
    """doc_id, n_words and matches (label, block, containment, places): one row per row of ``docs``.

    A block is ``stride`` words and as many more as the longest template has, from every ``stride``-th word
    on, so whatever is as long as a template stands whole in some block. A notice matches a block that holds
    ``threshold`` of its distinct words; a phrase matches where its words stand in a row, and ``places`` holds every
    such word position once. A null text has no words; repeated rows are scanned each; extra columns are
    not read; an empty table gives no row.
    """
    templates = Templates(PHRASES if phrases is None else phrases, NOTICES if notices is None else notices, threshold, stride)
    templates.order(word_blocks(docs, templates))
    shared = checked_broadcast(docs.sparkSession, templates, sum(map(len, templates.ids)), 16 << 20, "templates")

    def run(batches) -> Iterator[dict]:
        t = shared.value
        for batch in batches:
            scanned = [t.scan(x) for x in binary_column(batch, "text")]
            yield {
                "doc_id": batch.column("doc_id"),
                "n_words": [n for n, _ in scanned],
                "matches": [
                    [dict(zip(("label", "block", "containment", "places"), m)) for m in found] for _, found in scanned
                ],
            }

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_words long, matches {PLACES}")


def labels(matches: Column | str, names: list[str] | None = None) -> Column:
    """Distinct labels, sorted and comma-joined; only those in ``names``, if given."""
    found = F.transform(matches, lambda m: m["label"])
    if names is not None:
        found = F.array_intersect(found, F.array(*map(F.lit, names)))
    return F.array_join(F.array_sort(F.array_distinct(found)), ",")
