"""Collocations: DuckDB has the same on whole documents; here a plain count, the summaries' bound and odd rows."""
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from adherence.llm import collocations as C
from adherence.llm.base import table
from adherence.llm.words import U

BREAKS = ".,;:!?\n\x0b\x0c\r"


def pieces(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    for b in BREAKS:
        text = text.replace(b, "\n")
    return [[w for w in piece.replace("\t", " ").split(" ") if w] for piece in text.split("\n")]


def plain_counts(rows, longest):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i:i + size])] += 1
    return f, n


def plain(rows, least=10, longest=3, top=2000, inside=50):
    f, n = plain_counts(rows, longest)
    out = set()
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in often.items():
            k = min(range(1, len(p)), key=lambda k: (1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k))
            part = any(100 * b >= inside * a for q, b in often.items() if len(q) > len(p)
                       and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if not part:
                score = 1000000 * a * a // (counts[p[:k]] * counts[p[k:]])
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return out


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = C.collocations(docs, **options).collect()
    assert len(got) == len({(r.lang, r["rank"]) for r in got})
    return {tuple(r) for r in got}


def texts(seed, n=120):
    """Few words, so that phrases are frequent, ties are many and parts of longer phrases go."""
    rng = random.Random(seed)
    words = ["Of", "the", "éa", "ÉA", "x y", "zu", "longer", "a-b", "the"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " ? ", "\r\n"]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["de", "de", "en", None, "und"]), text))
    return rows


@pytest.mark.parametrize("options", [{}, {"least": 3, "longest": 5, "inside": 70}, {"longest": 2, "top": 4}])
def test_plain_count(spark, options):
    rows = texts(len(options))
    want = plain(rows, **options)
    assert run(spark, rows, **options) == want and len(want) > 4


def test_hash_partitions_and_flushes_change_nothing(spark, monkeypatch):
    rows = texts(9)
    monkeypatch.setattr(C, "MASS", 200)
    monkeypatch.setattr(C, "HELD", 50)
    monkeypatch.setattr(C, "HELD_PHRASES", 20)
    assert run(spark, rows) == plain(rows)
    # a filter that is full lets rare phrases be counted, no more
    monkeypatch.setattr(C, "_surviving", lambda *_: np.full(1 << C.FILTER_BITS - 3, 255, np.uint8))
    assert run(spark, rows) == plain(rows)


def test_a_hash_partition_is_summarised_by_one_task(spark, monkeypatch):
    """the summaries' rows stay together where Spark plans their join by shuffle and broadcasts at run time."""
    monkeypatch.setattr(C, "MASS", 20_000)
    rng = random.Random(7)
    rows = [("x", " ".join(f"w{rng.randrange(1500)}" for _ in range(60))) for _ in range(600)]
    rows += [("x", f"p{i} q{i} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(20))) for i in range(300) for _ in range(10)]
    rng.shuffle(rows)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "60k")  # between the masses and the summaries
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        docs = spark.createDataFrame(rows, "lang string, text string").repartition(16)
        got = {(r.phrase, r.f) for r in C.phrase_counts(docs).where("size > 0").collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    f, _ = plain_counts(rows, 3)
    assert got == {(" ".join(p), n) for p, n in f["x"].items() if n >= 10}


def test_whole_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "lang", "text")
    assert {tuple(r) for r in C.op12_collocations(spark, sf_dir).collect()} == plain([tuple(r) for r in docs.collect()])


def test_summaries_keep_what_is_frequent():
    """However summaries are merged, counters and what was taken off bound the true count, and what was
    taken off stays below mass / (capacity + 1)."""
    rng = random.Random(4)
    for capacity in (3, 10, 40):
        true, parts = Counter(), []
        for _ in range(20):
            own = Counter(int(rng.paretovariate(0.7)) % 500 for _ in range(200))
            true += own
            parts.append((np.array(sorted(own), U), np.array([own[k] for k in sorted(own)], np.int64)))
        summary = np.zeros(0, U), np.zeros(0, np.int64), 0
        while parts:
            take = rng.randint(1, 4)
            summary, parts = C.merged(summary, parts[:take], capacity), parts[take:]
        hashes, counts, off = summary
        assert len(hashes) <= capacity and off <= sum(true.values()) / (capacity + 1)
        left = dict(zip(hashes.tolist(), counts.tolist()))
        for k, n in true.items():
            assert left.get(k, 0) <= n <= left.get(k, 0) + off


def test_exact_beyond_64_bits(spark):
    rows = [("en", "", 0, 9 * 10**13), ("en", "a", 1, 4 * 10**13), ("en", "b", 1, 3 * 10**13), ("en", "a b", 2, 2 * 10**13 + 1)]
    got = C.scored(spark.createDataFrame(rows, "lang string, phrase string, size int, f long")).first()
    assert got.score == 1000000 * (2 * 10**13 + 1) ** 2 // (4 * 10**13 * 3 * 10**13)


def test_odd_rows(spark):
    rows = [(None, None, 1), ("en", "", 2), ("en", " .\t!\n", 2), ("fr", "ab cd " * 60_000, 3), ("fr", "w" * 300_000, 4), ("en", "to be " * 9, 5), ("en", "to be " * 9, 5)]
    docs = spark.createDataFrame(rows, "lang string, text string, phrase int")
    assert {tuple(r) for r in C.collocations(docs).collect()} == plain([r[:2] for r in rows])
    empty = C.collocations(docs.where("false"))
    assert empty.count() == 0 and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("hot", [30, 10**9])
def test_frequent_parts_are_looked_up_apart(spark, monkeypatch, hot):
    """Counts are shuffled once, not once a salt, and summaries aren't stored on their way to the merge."""
    monkeypatch.setattr(C, "HOT", hot)
    monkeypatch.setattr(C, "RARE", 10**9)
    names, kept = [], C.stored
    monkeypatch.setattr(C, "stored", lambda df, name: names.append(name) or kept(df, name))
    rows = texts(5)
    docs = spark.createDataFrame(rows, "lang string, text string")
    out = C.collocations(docs)
    assert names == ["phrases"] and {tuple(r) for r in out.collect()} == plain(rows)
    assert "explode(sequence(0" not in out._jdf.queryExecution().optimizedPlan().toString()
