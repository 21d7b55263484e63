"""Line de-duplication against a brute-force version."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from adherence.llm import line_dedup as L


def _distance_at_most_one(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1] <= 1


def brute(docs):
    """{(doc_id, text): places that go}, over documents as they are."""
    seen = sorted({(d if d is not None else 1 << 63, t) for d, t in docs if t is not None}, key=lambda x: x[0])
    lines = [(d, t, i, s.strip(" \t\n\x0b\x0c\r")) for d, t in seen for i, s in enumerate(t.split("\n"))]
    texts = sorted({s for *_, s in lines if len(s) >= L.MIN_CHARS})
    root = {s: s for s in texts}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(texts):
        for b in texts[i + 1:]:
            if _distance_at_most_one(a, b):
                root[find(a)] = find(b)
    first, out = {}, {}
    for d, t, i, s in lines:
        if len(s) >= L.MIN_CHARS:
            if first.setdefault(find(s), (d, t, i)) != (d, t, i):
                out.setdefault((d, t), set()).add(i)
    return out


def _docs(seed=3):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(2, 7)))
    base = [" ".join(word() for _ in range(rnd.randint(4, 9))) for _ in range(30)]
    hot = "a template line, all but one sign of which is the same: number 1000"
    docs = []
    for d in range(120):
        lines = []
        for _ in range(rnd.randint(1, 6)):
            s = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                k = rnd.randrange(len(s))
                s[k:k + 1] = rnd.choice([[], ["x"], [s[k], "y"]])
            lines.append(" " * rnd.randint(0, 1) + "".join(s))
        if d % 2:
            lines.append(hot[:-4] + str(1000 + 37 * d))  # a segment that many lines share
        if d % 5 == 0:
            lines.append(hot + chr(97 + d % 7))
        docs.append((d, "\n".join(lines)))
    return docs + [(500, None), (501, ""), (502, "\n\n"), (None, docs[0][1]), (7, docs[7][1]), (503, "short")]


def test_equals_brute_force(spark):
    docs = _docs()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {}
    marks = {(r["doc"], r["mark"]): r["text"] for r in L._named(df).collect()}
    for r in L.repeats(df).collect():
        key = (r["doc"] if r["doc"] != L._LAST else 1 << 63, marks[r["doc"], r["mark"]])
        got.setdefault(key, set()).add(r["pos"])
    assert got == brute(docs)


def test_texts_and_columns(spark):
    line = "the same line stands in both documents"
    rows = [(1, line + "\nown first", 1, "x"), (2, "own second\n" + line, 2, "y"), (3, line, 3, "z"), (4, None, 4, "n"), (5, "", 5, "e"), (None, "own", 6, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pos int, key string")
    out = {r["pos"]: r for r in L.without_repeats(df).collect()}
    assert set(out) == {1, 2, 4, 5, 6}
    assert out[1]["text"] == line + "\nown first" and out[2]["text"] == "own second" and out[4]["text"] is None and out[5]["text"] == ""
    assert L.without_repeats(df).columns == df.columns
    assert L.without_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize(("a", "b"), [("abcdef", "abcdef"), ("abcdef", "abXdef"), ("abcdef", "abdef"), ("abcdef", "Xabcdef"), ("abcdef", "abcdefX"),
                                      ("abcdef", "badcef"), ("abcdef", "abcXXf"), ("abcdef", "abcd"), ("éa", "a"), ("ab", "ba")])
def test_banded_distance(spark, a, b):
    for p, q in ((a, b), (b, a)):
        df = spark.createDataFrame([(p, q)], "a string, b string")
        assert df.where(L.within_one(F.col("a"), F.col("b"))).count() == _distance_at_most_one(p, q)


def test_crowded_steps_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(L, "FEW", 2)
    test_equals_brute_force(spark)


def test_equal_short_lines_go(spark):
    line = "a line that is long enough for an edit"
    rows = [(1, f"Menu\n{line}\n\n \nown"), (2, f"  Menu\nMenus\n\n \n{line}s\n}}"), (3, "}\nMenu"), (4, "é\né"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = {(r["doc"], r["mark"]): r["doc"] for r in L._named(df).collect()}
    got = {marks[r["doc"], r["mark"]]: (r["gone"], r["n_near"]) for r in L._gone(df).collect()}
    assert got == {2: ([0, 4], 1), 3: ([0, 1], 0), 4: ([1], 0)}
    assert {r["doc_id"]: r["text"] for r in L.without_repeats(df).collect()} == {
        1: rows[0][1], 2: "Menus\n\n \n}", 4: "é", 5: None}
