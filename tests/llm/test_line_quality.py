"""The quality field: held-out accuracy, marginals against enumeration, edge cases."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa

from adherence.llm import quality as Q


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    rows = Q.op6_quality(spark, d).join(spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality"), "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)


def test_marginals_equal_enumeration():
    rnd = np.random.default_rng(0)
    f, first = rnd.random((7, Q.N_FEATURES)), np.array([0, 4, 5, 7])
    c = Q.Chain(rnd.normal(size=3 * Q.N_FEATURES + 1), rnd.normal(size=(2, 2)), np.zeros(Q.N_FEATURES), np.ones(Q.N_FEATURES))
    got = c.good(f, first)
    x = Q._around(f, first) @ c.weights
    for a, b in itertools.pairwise(first):
        total, ones = 0.0, np.zeros(b - a)
        for y in itertools.product((0, 1), repeat=b - a):
            p = np.exp(sum(x[a + i] * v for i, v in enumerate(y)) + sum(c.pairs[u, v] for u, v in itertools.pairwise(y)))
            total += p
            ones += p * np.array(y)
        assert np.allclose(got[a:b], ones / total)


def test_lines_of_rows():
    f, size, first = Q.line_features(pa.array(["ab c\n\nd", "", None, "x\n", "one two two"]))
    assert first.tolist() == [0, 3, 4, 5, 7, 8]
    assert size.tolist() == [4, 0, 1, 0, 0, 1, 0, 11]
    assert np.isfinite(f).all() and f[7, 9] > 0


def test_edge_cases(spark):
    schema = "doc_id long, text string, score int, quality int"
    rows = [(1, "fine words here", 1, 1), (2, None, 1, 1), (3, "", 1, 1), (None, "more fine words", 1, 1), (1, "fine words here", 1, 1), (4, "line\n" * 50_000, 1, 1)]
    df = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert Q.learned(df, labels) is None
    assert {r["score"] for r in Q.scores(df, None).collect()} == {1.0}
    chain = Q.fit([np.random.default_rng(i).random((3, Q.N_FEATURES)) + i % 2 for i in range(20)], [i % 2 for i in range(20)], 20)
    out = Q.scores(df, chain).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    kept = Q.good(df, chain, 0.0)
    assert kept.columns == df.columns and kept.count() == len(rows)
    assert Q.scores(df.limit(0), chain).count() == 0


def test_one_row_of_an_id_is_learned_from(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "fit", lambda features, y: seen.append((features, y)))
    ids = [r["id"] for r in spark.range(40).where(~Q.held_out(Q.F.col("id"))).collect()]
    rows = [(i, f"document {i}\nwith a line of its own {i * i}") for i in ids]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    for docs in (rows, rows + [rows[0]] * 300 + [(ids[1], None)]):
        Q.learned(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), labels)
    (a, y), (b, z) = seen
    assert len(a) == len(b) == len(ids) and y == z
    assert all(np.array_equal(p, q) for p, q in zip(a, b, strict=True))
