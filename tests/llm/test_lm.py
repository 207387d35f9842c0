import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from citygrain.llm import attention, lm


def test_gradients():
    r = np.random.default_rng(0)
    m = attention.Attention(7, 4, 5, 6)
    m.weights = {k: v.astype(np.float64) for k, v in m.weights.items()}
    m.mask = m.mask.astype(np.float64)
    ids, targets = r.integers(0, 7, (3, 6)), r.integers(0, 7, (3, 6))
    weight = (r.random((3, 6)) > 0.3).astype(float)
    _, g = m.loss(ids, targets, weight)
    for k, w in m.weights.items():
        for _ in range(4):
            at = tuple(r.integers(0, n) for n in w.shape)
            old = w[at]
            w[at] = old + 1e-5
            up, _ = m.loss(ids, targets, weight)
            w[at] = old - 1e-5
            down, _ = m.loss(ids, targets, weight)
            w[at] = old
            assert abs((up - down) / 2e-5 - g[k][at]) < 1e-6, k


def test_no_position_sees_what_follows():
    m = attention.Attention(9, window=8)
    ids = np.arange(16).reshape(2, 8) % 9
    changed = ids.copy()
    changed[:, 5:] = 0
    rows, columns = np.nonzero(np.ones((2, 5)))
    goal = np.ones(10, np.int64)
    assert np.allclose(m.log_probabilities(ids, rows, columns, goal), m.log_probabilities(changed, rows, columns, goal))
    every = [m.log_probabilities(ids, np.array([0]), np.array([3]), np.array([t]))[0] for t in range(9)]
    assert abs(np.exp(every).sum() - 1) < 1e-5


def test_windows_score_each_position_once():
    sizes = np.array([1, 31, 32, 33, 48, 49, 200])
    start, length, scored, owner = attention.windows(sizes)
    places = np.concatenate([np.arange(s + f, s + n) for s, n, f in zip(start, length, scored)])
    assert sorted(places.tolist()) == list(range(sizes.sum()))
    assert all(f in (0, attention.WINDOW - attention.STRIDE) for f in scored)


def brute(rows):
    counts, known = {}, {}
    parts = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    train = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for i, _ in rows]
    for row, learn in zip(parts, train):
        for w in row if learn else ():
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, _), row, learn in zip(rows, parts, train):
        base = sum(math.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in row)
        out.append((str(i), not learn, len(row), sum(w in counts for w in row), n, round(base, 6)))
    return sorted(out)


def test_base_score_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lm, "STEPS", 3)
    rows = [(i, f"Word{i % 7} the  The\tÉ a{i}") for i in range(60)] + [(70, None), (71, ""), (3, "x"), (3, "x"), (None, "the end")]
    rows += [(72, "long " * 40_000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    got = lm.score_texts(docs).collect()
    assert sorted((str(g.doc_id), g.held_out, g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 6)) for g in got) == brute(rows)
    assert all(g.score < 0 for g in got)
    assert lm.score_texts(docs.limit(0)).collect() == []
    only = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 1")
    assert all(g.train_tokens == 0 and abs(g.base_score) < 1e-5 for g in lm.score_texts(only).collect())


def test_the_model_beats_the_unigram_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scored = lm.score_texts(docs).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert scored[0] > scored[1]


def test_every_training_token_is_trained_on(spark, monkeypatch, tmp_path):
    from pyspark import TaskContext

    rows = [(i, " ".join(f"w{i}x{k % 5}" for k in range(i % 90))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)

    def noted(self, ids, targets, weight, steps, rate, batch=64, seed=0):
        with (tmp_path / f"{TaskContext.get().partitionId()}-{seed}").open("a") as out:
            out.write(f"{int(weight.sum())} {steps * batch >= len(ids)}\n")

    run = lm.map_arrow

    def patched(df, fn, schema):
        def with_notes(batches):
            own, attention.Attention.train = attention.Attention.train, noted
            try:
                yield from fn(batches)
            finally:
                # workers live on
                attention.Attention.train = own

        return run(df, with_notes, schema)

    monkeypatch.setattr(lm, "map_arrow", patched)
    found = lm.score_texts(docs).first()
    lines = [x.split() for f in tmp_path.iterdir() for x in f.read_text().splitlines()]
    assert sum(int(n) for n, _ in lines) == found.train_tokens
    assert all(x == "True" for _, x in lines)


def test_turns_share_out_all_windows():
    r = np.random.default_rng(4)
    sizes = r.integers(0, 90, 60)
    inputs = lm.Inputs(sizes, np.arange(sizes.sum()) % 50, np.arange(50), np.arange(20))
    keep = r.random(60) < 0.7
    rows = lambda turn: [tuple(x) for part in inputs.windows(keep, attention.WINDOW, turn) for x in np.c_[part[0], part[1], part[3]].tolist()]
    shares = [rows(turn) for turn in range(lm.ROUNDS)]
    assert sorted(x for s in shares for x in s) == sorted(rows(None))
    assert all(0.5 * len(rows(None)) / lm.ROUNDS < len(s) < 2 * len(rows(None)) / lm.ROUNDS for s in shares)


def test_score_by_hand(spark):
    """The score of every text position by position, from the weights that training leaves."""
    texts = ["the cat sat on the mat " * 9, "a dog", "", "cats and dogs and cats " * 20, "the the the"] * 4
    rows = [(i, t) for i, t in enumerate(texts)]
    kept = {}
    train = lm._train
    lm._train = lambda *x: kept.setdefault("model", train(*x))
    try:
        got = {x.doc_id: x.score for x in lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        lm._train = train
    model = kept["model"]
    learn = [t.encode().lower().split() for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = {}
    for w in (w for row in learn for w in [*row, None]):
        counts[w] = counts.get(w, 0) + 1
    heads = {}
    for w, c in counts.items():
        if w is not None:
            n, v = heads.get(lm.subword(w), (0, 0))
            heads[lm.subword(w)] = n + c, v + 1
    known = sorted(heads)
    within = [heads[h][0] + 0.5 * (heads[h][1] + 1) for h in known] + [0.5, counts[None] + 1.0]
    for i, t in rows:
        words = [*t.encode().lower().split(), None]
        ids = [len(known) + 1 if w is None else known.index(lm.subword(w)) if lm.subword(w) in heads else len(known) for w in words]
        given = [len(known) + 1, *ids[:-1]]
        want = 0.0
        for p, w in enumerate(words):
            # the window that scores this position begins a multiple of the stride before it
            start = 0 if p < attention.WINDOW else (p - attention.WINDOW) // attention.STRIDE * attention.STRIDE + attention.STRIDE
            at = np.array([given[start : p + 1]])
            want += model.log_probabilities(at, np.array([0]), np.array([p - start]), np.array([ids[p]]))[0] / math.log(10)
            want += math.log10(counts.get(w, 0) + 0.5) - math.log10(within[ids[p]])
        assert abs(want - got[i]) < 1e-3 * max(1, abs(want)), (i, want, got[i])


def test_subwords_of_many_words_at_once():
    r = np.random.default_rng(5)
    words = [bytes(r.choice(list(b"ab\x00\xff"), r.integers(1, 6)).astype(np.uint8)) for _ in range(500)]
    assert lm.subwords(words).tolist() == [lm.subword(w) for w in words]
    assert lm.subwords([]).tolist() == []


def test_scores_take_the_inner_values_of_training():
    r = np.random.default_rng(6)
    m = attention.Attention(20)
    ids, targets = r.integers(0, 20, (2, 40, attention.WINDOW))
    for factor in (1, 40):
        # the larger weights lead beyond the exponents that need no shift
        m.weights = {k: v * np.float32(factor) for k, v in m.weights.items()}
        for first in (0, attention.WINDOW - attention.STRIDE):
            rows, columns = np.nonzero(np.ones((40, attention.WINDOW - first)))
            goal = targets[rows, columns + first]
            z = m._states(ids, first)["z"][rows, columns]
            assert np.allclose(m._last(ids, first)[rows, columns], z, rtol=1e-3, atol=1e-3 * abs(z).max())
            scores = m._scores(z).astype(np.float64)
            want = scores[np.arange(len(goal)), goal] - np.log(np.exp(scores).sum(axis=1))
            got = m.log_probabilities(ids, rows, columns + first, goal, first)
            assert np.isfinite(got).all() and np.allclose(got, want, rtol=1e-3, atol=1e-3 * max(1, abs(want).max()))


def test_scoring_multiplies_all_windows_at_once(monkeypatch):
    m = attention.Attention(20)
    monkeypatch.setattr(m, "_states", None)
    ids = np.arange(64).reshape(2, 32) % 20
    assert len(m.log_probabilities(ids, np.array([0, 1]), np.array([3, 5]), np.array([1, 2]))) == 2
