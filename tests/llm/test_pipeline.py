"""The pipeline against plain versions of its stages, and the registered queries."""

import hashlib
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline as p
from citygrain.llm import toxicity
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_suffix_dedup import brute_words as repeats


def word(r):
    return "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))


def tables(spark, folder):
    r = random.Random(11)
    text = lambda n: " ".join(word(r) for _ in range(n))
    items = [text(20) for _ in range(4)]
    passage = text(120)
    texts = [text(r.randint(1, 200)) for _ in range(30)]
    texts += [texts[0], texts[3] + " more", None, "", "you stupid idiot, trash and scum", text(50) + " " + items[1]]
    texts += [text(9) + passage + text(8), passage + text(30), text(400) + items[0][:40], text(5) + " moron loser clown"]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(0, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return [(i, t) for i, t, *_ in rows], list(enumerate(items))


def plain(rows, items):
    model = toxicity.Model({w + " ": 1.0 for w in toxicity.WORDS})
    rows = [(i, t) for i, t in rows if model.score(t or "") < 0.3]
    roots = brute_components([brute_fingerprint(t or "") for _, t in rows], 4)
    rows = [rows[i] for i in sorted(set(roots))]
    kept = []
    for (i, t), (_, spans, left) in zip(rows, repeats([(t or "").encode() for _, t in rows], 50)):
        if left or not spans:
            edges = [0, *(x for s in spans for x in s), len((t or "").encode())]
            parts = [(t or "").encode()[a:b].decode("utf-8", "ignore") for a, b in zip(edges[::2], edges[1::2])]
            kept.append((i, "".join(parts)))
    hits = contamination([t for _, t in kept], items)
    kept = [row for row, (n, h, _) in zip(kept, hits) if not (h and 20 * h >= n)]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for i, x in kept:
        ids = np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes()
        out.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(x.encode()).hexdigest(), ids))
    return sorted(out)


def test_pipeline_against_plain_stages(spark, tmp_path):
    rows, items = tables(spark, tmp_path)
    got = sorted((g.doc_id, g.n_tokens, g.ids_sha256, g.decoded_sha256, bytes(g.ids)) for g in p.run(spark, str(tmp_path)).collect())
    want = plain(rows, items)
    assert got == want
    assert 0 < len(want) < len(rows)


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for empty in (False, True):
        kept = docs.limit(0) if empty else docs
        for _, stage in p.STAGES[:-1]:
            kept = stage(spark, kept, str(tmp_path))
            assert kept.schema.simpleString() == docs.schema.simpleString()
            assert not empty or kept.collect() == []


def test_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names}
    assert "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names
    assert [n for n, _ in p.STAGES] == ["toxicity", "simhash", "suffix_dedup", "decontamination", "bpe"]
