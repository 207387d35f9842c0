import zlib

import pytest
from pyspark.sql import functions as F

from citygrain.llm import toxicity as t

SF = "/root/testdata/sf0.1"


def test_folding():
    assert t.folded("ІDІ0Т").split() == ["idiot"]
    assert t.folded("st​upíd, 1diot!").split() == ["stupid", "idiot"]
    assert t.folded("ｔｒａｓｈ\ncLoWn").split() == ["trash", "clown"]


def test_matches_and_exceptions():
    m = t.Model({"idio": 2.0, "idiot ": 3.0, "trash ": 1.0}, ("trash can",))
    assert m.weigh("An idiot, idiotic") == (5.0, 3)
    assert m.weigh("the trash can is trash") == (1.0, 5)
    assert m.weigh("trashy") == (0.0, 1)
    assert m.weigh("") == (0.0, 0)
    assert t.Model({}, ()).weigh("a b") == (0.0, 2)
    assert 0 < m.score("") < m.score("idiot") < 1
    # longer texts with the same words score lower
    assert m.score("idiot " + "fine " * 500) < m.score("idiot " + "fine " * 5)


def test_against_a_plain_scan():
    m = t.Model({"ab": 1.0, "abc ": 2.0, "cd ": 4.0}, ("ab cd", "x abc"))
    for text in ["ab cd", "abc abd cd", "x abc cd", "ab ab cd cd", "zab cdx abcd abc"]:
        row = t.folded(text).split()
        gone = {i + k for p in m.exceptions for i in range(len(row)) if row[i : i + 2] == p.split() for k in (0, 1)}
        total = sum(
            max([w for term, w in m.lexicon.items() if (word + " ").startswith(term)], default=0)
            for i, word in enumerate(row)
            if i not in gone
        )
        assert m.weigh(text) == (total, len(row))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    model = t.fit(docs, labels, ~t.held_out())
    scored = t.score_documents(docs, model).join(labels, "doc_id").where(t.held_out())
    c = {(r.toxic, r.p): r.n for r in scored.groupBy("toxic", (F.col("score") >= 0.3).alias("p")).agg(F.count("*").alias("n")).collect()}
    caught, missed = c.get((1, True), 0), c.get((1, False), 0)
    assert caught / (caught + missed) > 0.8
    assert c.get((0, True), 0) / c[0, False] < 0.02


def test_odd_rows(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "you idiot", None), (2, "", "b"), (3, "x " * 100_000, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    model = t.fit(docs, labels, ~t.held_out())
    assert set(model.lexicon) == {w + " " for w in t.WORDS}
    got = t.score_documents(docs, model).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "2", "3", "None"]
    assert all(0 <= r.score <= 1 for r in got)
    kept = t.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "2", "3"]
    assert t.fit(docs.limit(0), labels.limit(0), ~t.held_out()).lexicon == model.lexicon
    assert t.score_documents(docs.limit(0), model).collect() == []


@pytest.mark.parametrize("doc_id", [0, 17, -1, 123456789])
def test_fold_of_an_id(spark, doc_id):
    row = spark.createDataFrame([(doc_id,)], "doc_id long").select(t.held_out().alias("h")).first()
    assert row.h == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
