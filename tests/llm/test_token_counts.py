"""Token counts against the library."""

from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer as Library

from adherence.llm import token_counts as C

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    with open(PATH, encoding="utf-8") as f:
        return C.Tokenizer(f.read()), Library.from_file(PATH)


def _same(both, texts):
    own, library = both
    assert own.count_rows(pa.array(texts)).tolist() == [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_random_strings(both):
    rnd = random.Random(1)
    signs = [*" \t\n\r\u3000\u00a0'''strevmldSLaZz019\u00bd\u00b2\u2167\u00e9\u00df\u00f1\u6f22\u0633\U0001f600.!-_&#<|>\x1c\x85\u200b\u0301\x00", "<|endoftext|>", " '", "ll", "re"]
    _same(both, ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40))) for _ in range(4000)])


def test_long_and_odd_texts(both):
    _same(both, ["", None, "<|endoftext|>" * 3, "a" * 5000, " " * 777, "the" * 999, "!" * 3001, "'s's'll", "I've  I'll 'tis", "x" * 100 + "\n" * 200])
    own, _ = both
    assert own.count_rows(pa.array([], pa.string())).tolist() == []


def test_stores_can_be_emptied(both, monkeypatch):
    monkeypatch.setattr(C, "KEPT_TRANSITIONS", 50)
    monkeypatch.setattr(C, "KEPT_PIECES", 5)
    _same(both, ["a number of different words that fill the stores again and again " * 3, "other ones"])


def test_query(spark, sf_dir, both):
    rows = [(1, "some text", 9), (None, None, 9), (2, "", 9), (2, "word " * 600, 9), (2, "word " * 600, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in C.token_counts(df, PATH).collect())
    assert got == [(0, 0, 0, False), (1, 9, 2, False), (2, 0, 0, False), (2, 3000, 601, True), (2, 3000, 601, True)]
    assert C.token_counts(df.limit(0), PATH).count() == 0
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    want = {d: len(both[1].encode(t, add_special_tokens=False).ids) for d, t in texts.items()}
    assert {r["doc_id"]: r["n_tokens"] for r in C.op2_token_counts(spark, sf_dir).collect()} == want
