"""Spelling variants against a plain search over all pairs of words."""
import random
import zlib
from collections import Counter

import pytest

from adherence.llm import spelling as S
from adherence.llm.base import table


def plain_vocabulary(rows, length=7, occurrences=2):
    found = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 31 == 0:
                    run = "".join(x for i, x in enumerate(run) if i != h % len(run))
                found[run] += 1
                run = ""
    return {w: n for w, n in found.items() if len(w) >= length and n >= occurrences}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(words, ratio=10):
    form, near = {}, {}
    for w, n in words.items():
        close = [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)]
        near[w] = len(close)
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, near[w], words[form[w]] if form[w] else None))
    return out


def variants(spark, words, ratio=10):
    got = S.variants(spark.createDataFrame(list(words.items()), "word string, n long"), ratio).collect()
    assert len(got) == len(words)
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def test_whole_documents_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    words = plain_vocabulary([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.word: r.n for r in S.vocabulary(docs).collect()} == words
    got = S.op11_spelling(spark, sf_dir)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    by_length = {}
    for w, n in words.items():
        by_length.setdefault(len(w), {})[w] = n
    want = plain_variants_by_length(words, by_length)
    assert {tuple(r) for r in got.collect()} == want
    assert sum(1 for r in want if r[1]) > 0 and sum(r[4] for r in want) > 100


def plain_variants_by_length(words, by_length):
    """The plain search with all single edits of a word spelled out, for larger vocabularies."""
    letters = sorted({c for w in words for c in w})
    form, near = {}, {}
    for w, n in words.items():
        cut = {w[:i] + w[i + 1:] for i in range(len(w))}
        put = {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        changed = {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters} - {w}
        close = [v for v in cut | put | changed if v in by_length.get(len(v), ())]
        near[w] = len(close)
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, near[w], words[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("blocks", [1, 7, 40])
def test_random_words_with_runs_and_ties(spark, blocks):
    """Two letters only, so every word has many neighbours and runs; also across many blocks."""
    rng = random.Random(blocks)
    words = {}
    for _ in range(300):
        w = "".join(rng.choice("aaabé") for _ in range(rng.randint(1, 9)))
        words[w] = rng.choice([1, 1, 2, 10, 10, 100, 1000])
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", blocks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert variants(spark, words) == plain_variants(words)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])


def test_chains_ties_and_long_words(spark):
    long = "xy" * 40_000
    words = {"abcdefg": 10_000, "abcdefgh": 1_000, "abcdefghi": 100, "abcdefghij": 10, "zbcdefgh": 1_000,
             long: 50, long + "x": 5, long[:-1]: 5, "a" * 3_000: 7, "a" * 3_001: 70}
    got = variants(spark, words)
    assert got == plain_variants(words)
    assert ("abcdefghij", "abcdefghi", "abcdefg", 10, 1, 100) in got


def test_nulls_repeats_extra_columns_and_empty_tables(spark):
    rows = [(1, "Wörterbuch wörterbuch", "x"), (1, "Wörterbuch wörterbuch", "x"), (None, "wörterbuch kurz", None), (2, None, "y"), (3, "", "z"), (4, "q" * 200_000 + " " + "q" * 200_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    assert {r.word: r.n for r in S.vocabulary(docs).collect()} == plain_vocabulary([r[:2] for r in rows])
    empty = docs.where("false")
    assert S.vocabulary(empty).count() == 0
    assert S.variants(S.vocabulary(empty)).count() == 0
    with pytest.raises(ValueError):
        S.variants(S.vocabulary(empty), ratio=1)
