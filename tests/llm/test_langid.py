import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from citygrain.llm import langid as g
from citygrain.llm.queries import op11_language

SYLLABLES = {"xx": ["ka", "to", "ri", "sze"], "yy": ["ña", "lo", "dré", "que"], "zz": ["üb", "sch", "ung", "ein"]}


def prose(rng, lang, words):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(words))


def plain(network, text):
    """Window by window, place by place, in plain loops."""
    w, step = network.weights, network.window - network.reach + 1
    filters = w["filters"].reshape(network.reach, g.VECTOR, -1).astype(float)
    total, weight = np.zeros(len(network.labels)), 0
    for start in range(0, max(1, len(text) - network.window + step), step):
        piece = text[start : start + network.window]
        row = list(piece) + [0] * (network.window - len(piece))
        pooled = np.full(filters.shape[2], -np.inf)
        for p in range(step):
            pooled = np.maximum(pooled, sum(w["bytes"][row[p + k]].astype(float) @ filters[k] for k in range(network.reach)))
        z = np.maximum(pooled + w["bias"], 0) @ w["out"] + w["shift"]
        z = np.exp(z - z.max())
        letters = sum(b >= 128 or 65 <= b <= 90 or 97 <= b <= 122 for b in piece)
        total += letters * z / z.sum()
        weight += letters
    return total / max(weight, 1)


def test_probabilities_against_plain_loops():
    network = g.Network(["a", "b", "c"], window=16)
    rng = random.Random(2)
    texts = [bytes(rng.choices(range(256), k=n)) for n in (1, 5, 15, 16, 17, 27, 28, 29, 200)] + [b"12 34", b"x"]
    got = g.text_probabilities(network, texts)
    assert np.allclose(got, [plain(network, t) for t in texts], atol=1e-5)


def test_every_byte_stands_in_a_window():
    for n in range(1, 900, 7):
        starts, _, _ = g.cut([bytes(n)])
        seen = {(int(s) + i, int(s) + i + 1) for s in starts for i in range(min(g.WINDOW, n - int(s)) - 1)}
        assert seen >= {(i, i + 1) for i in range(n - 1)}


def test_gradients_against_differences():
    network = g.Network(["a", "b"], window=12)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    rng = np.random.default_rng(3)
    rows, labels = rng.integers(0, 256, (5, 12)).astype(np.uint8), np.array([0, 1, 1, 0, 1])
    _, gradients = network.loss_and_gradients(rows, labels)
    for name, values in network.weights.items():
        places = np.argwhere(np.abs(gradients[name]) > 1e-6)
        for at in map(tuple, places[rng.permutation(len(places))[:6]]):
            old = values[at]
            values[at] = old + 1e-6
            high = network.loss_and_gradients(rows, labels)[0]
            values[at] = old - 1e-6
            low = network.loss_and_gradients(rows, labels)[0]
            values[at] = old
            assert gradients[name][at] == pytest.approx((high - low) / 2e-6, rel=1e-3, abs=1e-7), (name, at)


def documents(spark, n=400):
    rng = random.Random(8)
    rows = [(i, prose(rng, lang, rng.choice([4, 30, 200])), lang) for i in range(n) for lang in [rng.choice(list(SYLLABLES))]]
    odd = [(n, None, "xx"), (n + 1, "", "xx"), (n + 2, "123 !? 4", "yy"), (n + 3, prose(rng, "zz", 9), None), (None, rows[0][1], "xx")]
    odd += [rows[5], (n + 4, prose(rng, "yy", 60000), "yy"), (n + 5, "é", "yy")]
    return spark.createDataFrame([(*r, "kept") for r in rows + odd], "doc_id long, text string, lang string, score string"), rows, odd


def test_learned_languages(spark):
    docs, rows, odd = documents(spark)
    network = g.fit(docs, ~g.held_out())
    got = g.identify(docs, network, ["doc_id", "lang"]).collect()
    assert len(got) == len(rows) + len(odd)
    held = [x for x in got if x.doc_id is not None and x.doc_id < len(rows) and zlib.crc32(str(x.doc_id).encode()) % 3 == 1]
    assert len(held) > 80 and sum(x.lang == x.lang_pred for x in held) >= 0.97 * len(held)
    by = {x.doc_id: x for x in got}
    for i in range(3):
        assert (by[len(rows) + i].lang_pred, by[len(rows) + i].score) == ("und", 0.0)
    assert by[len(rows) + 4].lang_pred == "yy" and all(0 <= x.score <= 1 for x in got)
    assert len({(x.lang_pred, x.score) for x in got if x.doc_id == 5}) == 1
    # the answer depends on the text alone, not on the layout
    again = {x.doc_id: x.lang_pred for x in g.identify(docs.repartition(7), g.fit(docs.repartition(3), ~g.held_out())).collect()}
    assert sum(again[x.doc_id] == x.lang_pred for x in got if x.doc_id is not None) >= len(got) - 3


def test_held_out_rows_and_other_columns_teach_nothing(spark):
    docs, *_ = documents(spark, 120)
    changed = docs.withColumn("lang", F.when(g.held_out(), F.lit("never")).otherwise(F.col("lang")))
    sample = g.sample_windows(changed, ~g.held_out())
    assert sample == g.sample_windows(docs, ~g.held_out()) and {x for x, _ in sample} == set(SYLLABLES)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, None)], "doc_id long, text string, lang string")
    assert g.fit(docs, F.lit(True)) is None
    assert [(x.lang_pred, x.score) for x in g.identify(docs, None).collect()] == [("und", 0.0)] * 2
    one = docs.withColumn("lang", F.lit("en"))
    assert [x.lang_pred for x in g.identify(one, g.fit(one, F.lit(True))).orderBy("doc_id").collect()] == ["en", "und"]
    assert g.identify(docs.limit(0), g.fit(docs.limit(0), F.lit(True))).collect() == []


def test_held_out_accuracy_of_the_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [(truth[x.doc_id], x.lang_pred) for x in op11_language(spark, sf_dir).collect() if x.held_out]
    assert len(held) > 200 and sum(a == b for a, b in held) >= 0.95 * len(held)
