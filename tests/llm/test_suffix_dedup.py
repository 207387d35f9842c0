import random
import re

import numpy as np
import pytest

from citygrain.llm import suffix_dedup as m


def brute(texts, long):
    """Byte ranges covered by strings that start twice or more."""
    places = {}
    for i, t in enumerate(texts):
        for p in range(len(t) - long + 1):
            places.setdefault(t[p : p + long], []).append((i, p))
    gone = [np.zeros(len(t), bool) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for i, p in found:
                gone[i][p : p + long] = True
    return [(len(t), [(a, b + 1) for a, b in m.runs(g)], bytes(np.frombuffer(t, np.uint8)[~g])) for t, g in zip(texts, gone)]


def some_texts(r):
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(r.randint(5, 30)) for _ in range(6)]
    out = [None, "", "short", "xy" * 90, "z" * 333, text(50)]
    for _ in range(40):
        parts = [text(r.randint(0, 12)) for _ in range(3)] + r.sample(shared, r.randint(0, 3))
        r.shuffle(parts)
        out.append(" ".join(parts))
    for t in out[6:16]:
        i = r.randrange(len(t) + 1)
        out.append(t[:i] + "#" + t[i + 1 :])
    return out + out[8:11] + ["q" + shared[0]] * 5


@pytest.mark.parametrize("batch,group", [(1 << 16, 4096), (150, 2)])
def test_against_brute_force(spark, batch, group):
    r = random.Random(batch)
    texts = some_texts(r)
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(5, texts[5], None), (None, texts[9], "x"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = m.remove_repeats(docs, 40, 16, batch, group).collect()
    want = brute([(t or "").encode() for _, t, _ in rows], 40)
    key = lambda x: (str(x[0]), x[1:])
    assert sorted(((g.doc_id, g.n_bytes, [tuple(s) for s in g.spans], bytes(g.kept)) for g in got), key=key) == sorted(
        ((i, *w) for (i, _, _), w in zip(rows, want)), key=key
    )


def test_rewritten_texts(spark):
    a, b = "é" * 60, "b" * 50 + "".join(map(chr, range(300, 420)))
    rows = [(1, a + "one", 63, "x"), (2, a + "two", 63, "y"), (3, b, 9, "z"), (4, b, 9, "z"), (5, None, None, None), (6, "", 0, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, source string")
    got = m.without_repeats(docs, 100)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(1, "one", 3, "x"), (2, "two", 3, "y"), (5, None, None, None), (6, "", 0, "w")]
    assert m.remove_repeats(docs.limit(0)).collect() == []


def test_levels_grow_geometrically():
    r = np.random.default_rng(2)
    levels, every = m.Levels(), []
    for _ in range(100):
        rows = np.zeros(50, m.Levels.KIND)
        rows["h"], rows["c"], rows["n"], rows["place"] = r.integers(0, 900, 50), r.integers(0, 2, 50), 1, r.integers(0, 99, 50)
        levels.add(rows)
        every += rows[["h", "c"]].tolist()
    assert len(levels.levels) <= 8
    found = {(x["h"], x["c"]): x["n"] for x in levels.all()}
    assert found == {k: every.count(k) for k in set(every)}
    family = m.SortedStrings()
    digests = r.integers(0, 3000, 2000)
    for a in range(0, 2000, 70):
        family.add(digests[a : a + 70])
    assert family.seen.tolist() == [(digests == d).sum() > 1 for d in digests]


def brute_words(texts, long):
    """Byte ranges of rows of ``long`` words that start twice or more, and what is left of the texts."""
    found = [list(re.finditer(rb"[0-9a-z\x80-\xff]+", t.lower())) for t in texts]
    places = {}
    for i, row in enumerate(found):
        for p in range(len(row) - long + 1):
            places.setdefault(tuple(m.group() for m in row[p : p + long]), []).append((i, p))
    gone = [np.zeros(len(row), bool) for row in found]
    for where in places.values():
        if len(where) > 1:
            for i, p in where:
                gone[i][p : p + long] = True
    out = []
    for t, row, flags in zip(texts, found, gone):
        spans = [(row[a].start(), row[b].end()) for a, b in m.runs(flags)]
        edges = [0, *(x for s in spans for x in s), len(t)]
        out.append((len(t), spans, b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2]))))
    return out


@pytest.mark.parametrize("batch,group", [(1 << 12, 4096), (25, 2)])
def test_strings_of_words_against_brute_force(spark, batch, group):
    r = random.Random(batch)
    texts = [t and t.replace(" b", ". B").replace(" c", "\nC") for t in some_texts(r)] + ["w" * 70 + " " + "v" * 900 + " 1 2 3 4 5 6 7"] * 2
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(5, texts[5], None), (None, texts[9], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = m.remove_repeats(docs, 9, 4, batch, group, words=True).collect()
    want = brute_words([(t or "").encode() for _, t, _ in rows], 9)
    key = lambda x: (str(x[0]), x[1:])
    assert sorted(((g.doc_id, g.n_bytes, [tuple(s) for s in g.spans], bytes(g.kept)) for g in got), key=key) == sorted(
        ((i, *w) for (i, _, _), w in zip(rows, want)), key=key
    )


def test_no_passage_of_over_fifty_words_escapes(spark):
    r = random.Random(9)
    word = lambda n: "".join(r.choice("abcdefghij") for _ in range(n))
    passages = [" ".join(word(size) for _ in range(51)) for size in (1, 2, 4, 9, 80)]
    docs = [(10 * i + k, f"{word(6)} {word(7)} {p} {word(8)}") for i, p in enumerate(passages) for k in range(3)]
    clean = [(100 + i, " ".join(word(5) for _ in range(200))) for i in range(20)]
    table = spark.createDataFrame(docs + clean, "doc_id long, text string")
    left = {x.doc_id: x.text for x in m.without_repeats(table, m.LONG_WORDS, words=True).collect()}
    assert all(len(left[i].split()) == 3 for i, _ in docs) and all(left[i] == t for i, t in clean)


def test_words_are_told_apart_wherever_they_stand():
    w = m.Words()
    w.chunk = 40
    r = random.Random(4)
    some = ["a", "ab", "ba", "é", "x" * 64, "x" * 65, "y" * 130] + ["".join(r.choice("ab") for _ in range(r.randint(1, 9))) for _ in range(60)]
    rows = [r.choice(some) for _ in range(400)]
    codes = w.encode(" ".join(rows).encode())
    assert len(codes) == 400 and len({(x, int(c)) for x, c in zip(rows, codes)}) == len(set(rows)) == len(set(codes.tolist()))


def test_passages_are_counted_beside_the_strings(spark):
    r = random.Random(77)
    texts = some_texts(r)
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (None, texts[9])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    data = [(t or "").encode() for _, t in rows]
    got = m.remove_repeats(docs, 60, 16, passages=7).collect()
    strings, passages = brute(data, 60), brute_words(data, 7)
    want = sorted((str(i), s[2], len(p[1])) for (i, _), s, p in zip(rows, strings, passages))
    assert sorted((str(g.doc_id), bytes(g.kept), g.n_passages) for g in got) == want
    assert any(n for *_, n in want)
