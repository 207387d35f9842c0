import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from citygrain.llm import ranked as r

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, top=10):
    held = [(i, Counter(t.translate(SMALL) for t in TERM.findall(text or ""))) for i, text in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, total = len(held), sum(x for _, _, x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for name, text in items:
        want = Counter(t.translate(SMALL) for t in TERM.findall(text or ""))
        found = []
        for i, c, size in held:
            m = 25 + 75 * size * n // total
            score = sum(
                k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t, k in want.items()
                if c[t]
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(name, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def corpus(seed, n, vocabulary=60):
    rng = random.Random(seed)
    terms = [w + x for w in ("ab", "Ça", "x9", "the", "É") for x in ("", "1", "un", "Q", "ñ", "ly", "zz", "p", "0", "de", "k", "t")]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    text = lambda most: rng.choice([" ", ", ", "-\n"]).join(rng.choices(terms[:vocabulary], weights, k=rng.randint(0, most)))
    docs = [(i, text(rng.choice([3, 10, 80]))) for i in range(n)]
    docs += [(n + i, docs[i % 5][1]) for i in range(n // 3)]  # groups of copies, so that scores tie
    items = [(i, text(12)) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("block, documents, leaf", [(1 << 20, 1 << 13, 32), (1 << 20, 40, 2), (200, 64, 1)])
def test_against_brute_force(spark, block, documents, leaf):
    docs, items = corpus(3, 180)
    docs += [(None, docs[0][1]), (None, docs[1][1]), (7, docs[7][1]), (900, None), (901, ""), (902, "?! ,"), (903, "the " * 50000 + "É1")]
    items += [(3, items[3][1]), (90, None), (91, "--"), (92, "unknown word"), (None, "the x9 x9")]
    table = spark.createDataFrame([(*d, "kept") for d in docs], "doc_id long, text string, score string").repartition(5)
    tests = spark.createDataFrame([(*i, "kept") for i in items], "item_id long, text string, rank string")
    got = r.best_documents(table, tests, block=block, documents=documents, leaf=leaf)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute(docs, items)


def test_bounds_leave_out_documents_without_changing_the_result():
    rng = np.random.default_rng(4)
    n, size = 3000, 400
    # topics: documents of one topic share its terms, as texts of one language do
    rows = []
    for i in range(n):
        topic = i % 8
        terms = np.unique(np.concatenate([rng.integers(topic * 50, topic * 50 + 50, 20), rng.integers(0, size, 2)]))
        rows.append((terms, rng.integers(1, 5, len(terms))))
    m = rng.integers(25, 400, n)
    df = Counter(int(t) for terms, _ in rows for t in terms)
    names = {t: str(t).encode() for t in df}
    wanted = [Counter(names[int(t)] for t in rng.choice(50, 8) + 50 * (q % 8)) for q in range(40)]
    items = r.Items(wanted, {names[t]: k for t, k in df.items()}, n)
    place = {name: i for i, name in enumerate(items.order)}
    lengths = np.array([len(t) for t, _ in rows])
    sorted_rows = [sorted((place[names[int(t)]], int(k)) for t, k in zip(*row)) for row in rows]
    flat = np.array([x for row in sorted_rows for x in row], np.int64)
    trie = r.Trie(np.arange(n), m, lengths, flat[:, 0], flat[:, 1], items.size)
    best = r.Best(len(items.names), 10)
    looked = r.search(trie, np.zeros(n, bool), items, best)
    assert looked < 0.5 * n * len(items.names)
    for q in range(len(items.names)):
        terms = dict(zip(items.terms[items.starts[q] : items.starts[q + 1]], items.weights[items.starts[q] : items.starts[q + 1]]))
        scores = [sum(int(w) * (10**9 * k // (1000 * k + 8 * int(m[i]))) for t, k in row if (w := terms.get(t))) for i, row in enumerate(sorted_rows)]
        want = sorted((-s, i) for i, s in enumerate(scores) if s > 0)[:10]
        assert [(-int(s), int(i)) for s, i in zip(best.score[q], best.id[q]) if s > 0] == want


def test_bound_is_never_below_a_score():
    tf, m = np.arange(1, 2000), np.arange(25, 2024)
    assert (np.diff(r.gain(tf, np.int64(80))) >= 0).all() and (np.diff(r.gain(np.int64(3), m)) <= 0).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id string, text string")
    assert r.best_documents(none, items).collect() == []
    docs = spark.createDataFrame([(1, "a b"), (2, "a")], "doc_id long, text string")
    assert r.best_documents(docs, items.limit(0)).collect() == []
    assert [tuple(x)[:3] for x in r.best_documents(docs, items).orderBy("rank").collect()] == [("1", 1, 1), ("1", 2, 2)]
