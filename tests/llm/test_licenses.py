import random

from citygrain.llm import licenses as m
from citygrain.llm.common import words


def brute(text, phrases, notices, threshold, stride):
    row = words((text or "").encode())
    texts = {k: words(v.encode()) for k, v in {**phrases, **notices}.items()}
    overlap = max(map(len, texts.values()))
    found = set()
    for label, phrase in phrases.items():
        w = words(phrase.encode())
        for i in range(len(row) - len(w) + 1):
            if row[i : i + len(w)] == w:
                found.add((label, i))
    for b in range(-(-len(row) // stride)):
        held = set(row[b * stride : (b + 1) * stride + overlap])
        for label in notices:
            wanted = set(texts[label])
            share = len(held & wanted) / len(wanted)
            if share >= threshold - 1e-12:
                found.add((label, b, round(share, 9)))
    return len(row), found


def seen(row, phrases):
    out = set()
    for x in row.matches:
        if x.label in phrases:
            assert len(set(x.places)) == len(x.places) and x.containment == 1
            out |= {(x.label, p) for p in x.places}
        else:
            out.add((x.label, x.block, round(x.containment, 9)))
    return out


def test_against_brute_force(spark):
    r = random.Random(4)
    phrases = {"mit": "mit license", "gpl": "general public license", "twice": "a a"}
    notices = {"n1": "a b c d e f g h", "n2": "licensed under the mit license", "n3": "d e a"}
    vocabulary = "a b c d e f g h mit license general public licensed under the x y z É9".split()
    texts = [None, "", "MIT-License", "mit license mit license", "the " * 3000 + "mit license", "x" * 50_000]
    texts += [" ".join(r.choice(vocabulary) for _ in range(r.randint(0, 90))) for _ in range(60)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(2, texts[2], None), (None, "mit license", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, matches string")
    got = m.scan_licenses(docs, phrases, notices, 0.75, 10).collect()
    want = [(str(i), *brute(t, phrases, notices, 0.75, 10)) for i, t, _ in rows]
    assert sorted((str(g.doc_id), g.n_words, sorted(map(str, seen(g, phrases)))) for g in got) == sorted(
        (i, n, sorted(map(str, f))) for i, n, f in want
    )
    assert m.scan_licenses(docs.limit(0)).collect() == []


def test_prefixes_follow_the_corpus(spark):
    docs = spark.createDataFrame([(1, "license license under"), (2, "license"), (3, "mit license")], "doc_id long, text string")
    t = m.Templates({"mit": "mit license"}, {}, 0.8, 64)
    counts = m.word_blocks(docs, t)
    assert counts == {b"mit": 1, b"license": 3}
    t.order(counts)
    assert t.prefixes == {t.ids[b"mit"]: [(0, 0)]}
