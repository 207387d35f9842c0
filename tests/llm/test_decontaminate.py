import random

import pytest

from citygrain.llm import decontaminate as d
from citygrain.llm.common import words


def brute(docs, items, window=13):
    out = []
    for text in docs:
        row = words((text or "").encode())
        hit, names = set(), set()
        for name, item in items:
            w = words((item or "").encode())
            size = min(window, len(w))
            wins = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
            for i in range(len(row) - size + 1):
                if size and tuple(row[i : i + size]) in wins:
                    hit.update(range(i, i + size))
                    names.add(str(name))
        out.append((len(row), len(hit), sorted(names)))
    return out


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_against_brute_force(spark, block):
    r = random.Random(3)
    word = lambda: r.choice("ab cd ef gh The é9".split())
    items = [(i, " ".join(word() for _ in range(r.choice([0, 1, 3, 5, 9, 20])))) for i in range(12)] + [(90, None), (3, "x")]
    docs = [" ".join(word() for _ in range(r.randint(0, 60))) for _ in range(40)] + [None, "", "x X", items[5][1] + ", zz"]
    rows = [(i, t, "kept") for i, t in enumerate(docs)] + [(1, docs[1], "kept"), (None, docs[2], "kept")]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = d.find_contamination(table, tests, 4, block).collect()
    want = brute([t for _, t, _ in rows], items, 4)
    assert sorted((str(g.doc_id), g.n_words, g.n_hit, g["items"]) for g in got) == sorted(
        (str(i), *w) for (i, _, _), w in zip(rows, want)
    )
    for g in got:
        for m in g.matches:
            text = words((dict((i, t) for i, t, _ in rows)[g.doc_id] or "").encode())
            sources = [words((t or "").encode()) for i, t in items if str(i) == m.item_id]
            assert any(s[m.item_start : m.item_start + m.words] == text[m.start : m.start + m.words] for s in sources)
    kept = d.remove_contaminated(table, tests, 4, block)
    assert kept.columns == table.columns
    assert sorted(str(k.doc_id) for k in kept.collect()) == sorted(
        str(i) for (i, _, _), (n, h, _) in zip(rows, want) if not (h and 20 * h >= n)
    )


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert d.find_contamination(docs, items).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [tuple(r)[:3] for r in d.find_contamination(one, items).collect()] == [(1, 2, 0)]


def test_long_items_take_room_in_proportion():
    r = random.Random(4)
    word = lambda: r.choice("ab cd ef gh".split())
    rows = [("a", [word() for _ in range(40)]), ("b", [word() for _ in range(9)]), ("a", [word() for _ in range(30)]), ("c", [])]
    test = d.TestSuffixes([(i, " ".join(x).encode()) for i, x in rows], 4)
    suffixes = sorted(([test.ids[w.encode()] for w in x[k:]], i, k) for i, x in rows for k in range(len(x)))
    assert [test.flat[p : p + test.left[p]].tolist() for p in test.order] == [s for s, _, _ in suffixes]
    for _ in range(200):
        row = [r.randint(1, 4) for _ in range(r.randint(1, 12))]
        size, item, at = test.longest(row)
        best = max(next((k for k, (a, b) in enumerate(zip(row, s)) if a != b), min(len(row), len(s))) for s, _, _ in suffixes)
        assert size == best and any(i == item and [test.ids[w.encode()] for w in x[at : at + size]] == row[:size] for i, x in rows)
    small, large = (d.TestSuffixes([("x", " ".join(f"w{i}" for i in range(n)).encode())]).nbytes() for n in (5_000, 50_000))
    assert large < 11 * small
    long = [str(r.randrange(1000)) for _ in range(50_000)]
    test = d.TestSuffixes([("x", " ".join(long).encode()), ("y", " ".join(["z"] * 20_000).encode())])
    counts, hits, items, longest = d.shard_matches([" ".join(["q", *long[10_000:], "q"]).encode()], test)
    assert (counts, hits.tolist(), items, longest) == ([40_002], [40_000], [["x"]], [[(1, 40_000, "x", 10_000)]])
