"""Mixing: DuckDB twin, brute-force targets, edge cases."""

from __future__ import annotations

from fractions import Fraction

import duckdb
import pytest

from adherence.llm import mixing as M

ROWS = [(1, "a b c", "s1"), (2, "a", "s1"), (3, None, "s1"), (4, "", "s2"), (5, "w " * 500, "s3"), (6, "x y", None), (None, "no id here", "s3"),
        (7, "tie tie", "s1"), (7, "tie tie", "s1"), (8, " \t\x0b ", "s4"), (9, "é\u00a0ß", "s4")]


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = set()
    while True:
        free = [s for s in order if s not in full]
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        total = sum(w[s] for s in free)
        share = {s: Fraction(w[s] * left, total) for s in free}
        over = {s for s in free if share[s] >= most * sizes[s]}
        if not over:
            return {s: float(share[s]) if s in share else float(most * sizes[s]) for s in order}
        full |= over


def test_targets_and_takes(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string").repartition(3)
    got = M.decided(df).collect()
    sizes = {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = brute_targets(sizes)
    assert len(got) == len(ROWS)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert int(rate) <= r["copies"] <= min(3, int(rate) + 1)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, M.decided(df).collect()), key=str)


def test_equals_sql(spark, sf_dir):
    got = M.op7_mixing(spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({M.ORACLE})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_mix_keeps_columns(spark):
    rows = [(i, "word " * (i % 7 + 1), f"s{i % 4}", i, "c") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, copy_no string")
    out = M.mixed(df)
    assert out.columns == [*df.columns, "copy_no_"]
    n = {}
    for r in out.collect():
        n[r["doc_id"]] = n.get(r["doc_id"], 0) + 1
    want = {r["doc_id"]: r["copies"] for r in M.decided(df).collect() if r["copies"]}
    assert n == want
    assert M.mixed(df.limit(0)).count() == M.decided(df.limit(0)).count() == 0
