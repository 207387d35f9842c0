import random

import numpy as np
import xxhash

from citygrain.llm import simhash as m
from citygrain.llm.components import components


def brute_fingerprint(text):
    row = bytes(text, "utf-8").lower().split()
    if not row:
        return 0
    parts = [b" ".join(row[i : i + 4]) for i in range(max(1, len(row) - 3))]
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, radius):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def signed(x):
    return int(np.uint64(x).view(np.int64))


def test_fingerprints_and_components(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeÉ ") for _ in range(r.randint(1, 4)))
    base = [" ".join(word() for _ in range(120)) for _ in range(8)]
    texts = [None, "", " \t", "One", "one two", "a b c d", "A b c  d"] + base
    for t in base:
        for _ in range(6):
            w = t.split(" ")
            w[r.randrange(len(w))] = word()
            texts.append(" ".join(w))
    texts += [base[0]] * 3 + ["x" * 200_000]
    r.shuffle(texts)
    rows = [(i * 3, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    got = {x.doc_id: x for x in m.near_duplicates(docs).collect()}
    values = [brute_fingerprint(t or "") for t in texts]
    roots = brute_components(values, 4)
    assert len(got) == len(rows)
    for i, v in enumerate(values):
        assert got[3 * i].fp == signed(v)
        assert got[3 * i].component_id == 3 * roots[i]
    kept = m.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(k.doc_id for k in kept.collect()) == sorted({3 * x for x in roots})


def test_null_and_repeated_ids(spark):
    rows = [(7, "a b c d e"), (7, "a b c d e"), (None, "a b c d e"), (9, "a b c d e"), (None, "q r s t u v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(x.doc_id), str(x.component_id)) for x in m.near_duplicates(docs).collect())
    assert got == [("7", "7"), ("7", "7"), ("9", "7"), ("None", "7"), ("None", "None")]
    assert sorted(str(x.doc_id) for x in m.one_of_each(docs).collect()) == ["7", "None"]
    assert m.near_duplicates(docs.limit(0)).collect() == []
    assert m.one_of_each(docs.limit(0)).collect() == []


def test_one_id_for_different_texts(spark):
    text = lambda c: " ".join(c + str(i) for i in range(40))
    rows = [(5, text("a")), (5, text("b")), (6, text("c")), (3, text("b")), (None, text("d")), (None, text("d")), (None, text("a"))]
    rows += [(9, text("e")), (9, text("e")), (9, text("f"))]
    docs = spark.createDataFrame([(*x, "kept") for x in rows], "doc_id long, text string, _n string")
    kept = sorted(((str(x.doc_id), x.text[0]) for x in m.one_of_each(docs).collect()))
    assert kept == [("3", "b"), ("5", "a"), ("6", "c"), ("9", "e"), ("9", "f"), ("None", "d")]


def test_tiles_lose_no_link(spark):
    r = random.Random(8)
    values = [r.getrandbits(64) for _ in range(300)]
    for v in values[:150]:
        for _ in range(3):
            values.append(v ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 6))))
    values = sorted(set(values))
    distinct = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    for tile in (5, 8192):
        labels = {x.node: x.label for x in components(m.near_links(distinct, 4, tile)).collect()}
        order = [signed(v) for v in values]
        roots = brute_components(values, 4)
        groups, want = {}, {}
        for v, root in zip(order, roots):
            groups.setdefault(labels.get(v, v), set()).add(v)
            want.setdefault(root, set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_chain(spark):
    links = spark.range(200).selectExpr("id as u", "id + 1 as v").union(spark.createDataFrame([(500, 500), (900, 901)], "u long, v long"))
    got = {x.node: x.label for x in components(links).collect()}
    assert got == {i: 0 for i in range(201)} | {900: 900, 901: 900}
    assert components(links.limit(0)).collect() == []
