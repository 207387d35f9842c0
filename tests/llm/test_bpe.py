import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from citygrain.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
REFERENCE = Tokenizer.from_file(PATH)
OWN = bpe.Bpe(open(PATH, encoding="utf-8").read(), cache=200)


def ids(text):
    return np.frombuffer(OWN.encode(text), "<u4").tolist()


def expected(text):
    return REFERENCE.encode(text, add_special_tokens=False).ids


PIECES = ["the", "The", " ", "  ", "\n", "\t", "é", "漢字", "don't", "we'll", "123", "½", "!?", ",", ".", "<|endoftext|>", "　", "\x1c", "aaaa", "abab", "ing", "\U0001f600", "\x00"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=6)), max_size=15).map("".join))
def test_ids_and_round_trip(text):
    text = text.encode("utf-8", "replace").decode()
    assert ids(text) == expected(text)
    assert OWN.decode(OWN.encode(text)).decode() == text


def test_few_letters_need_backtracking():
    r = random.Random(1)
    for _ in range(2000):
        text = "".join(r.choice("abest ") for _ in range(r.randint(0, 60)))
        assert ids(text) == expected(text)


@pytest.mark.parametrize("first", range(0, 0x3000, 0x800))
def test_classes_of_characters(first):
    for c in range(first, first + 0x800):
        text = f"a{chr(c)}1 {chr(c)}b"
        assert ids(text) == expected(text), hex(c)


def test_documents(spark):
    rows = [(1, "The cat, the hat."), (1, "The cat, the hat."), (None, "x"), (2, None), (3, ""), (4, "word " * 50_000)]
    docs = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, n_tokens int")
    encoded = bpe.encode_documents(docs, PATH)
    got = sorted((str(x.doc_id), x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in encoded.collect())
    want = []
    for i, t in rows:
        raw = np.array(expected(t or ""), "<u4").tobytes()
        want.append((str(i), len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    back = bpe.decode_documents(encoded, PATH).collect()
    assert sorted((str(x.doc_id), x.text) for x in back) == sorted((str(i), t or "") for i, t in rows)
    assert bpe.encode_documents(docs.limit(0), PATH).collect() == []
