"""Near duplicates against brute force."""

from __future__ import annotations

import random
import re

import pytest

from adherence.llm import near_dup as N


def _sets(rows, k):
    out = {}
    for d, t in rows:
        if d is None:
            continue
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    return out


def brute(rows, k, percent):
    sets = _sets(rows, k)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(s), find(d), d == find(d)) for d, s in sets.items()}


def _rows(seed, n=120):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 120))] for _ in range(12)]
    rows = []
    for d in range(n):
        t = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 3, 5])):
            t[rnd.randrange(len(t))] = rnd.choice(words)
        rows.append((d * 3 + 1, (rnd.choice([" ", "\n", "\t "])).join(t).upper() if d % 9 == 0 else " ".join(t)))
    return [*rows, (1000, None), (1001, ""), (1002, "  "), (1003, "one"), (1004, "one"), (1005, "ONE two"), (None, "one"), (None, None)]


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_equals_brute_force(spark, k, percent):
    rows = _rows(k)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(df, k, percent).collect() if r["doc_id"] is not None}
    assert got == brute(rows, k, percent)


def test_large_nodes_branch_and_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(N, "SMALL", 4)
    rows = _rows(11, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(df, 3, 85).collect() if r["doc_id"] is not None}
    assert got == brute(rows, 3, 85)


def test_one_of_each_group_stays(spark):
    long_text = " ".join(f"word{i}" for i in range(300))
    rows = [(1, long_text, "x", 0), (2, long_text + " more", "y", 0), (3, "something else entirely here now", "z", 0), (None, long_text, "n", 0),
            (3, "something else entirely here now", "z", 0), (4, None, "e", 0), (5, "", "e", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string, kept int")
    out = N.representatives(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 1, 3, 4, 5]
    assert N.representatives(df.limit(0)).count() == 0


def _template_rows(seed, n=400, planted=60, shared=0.9, words=120):
    """A template that makes unrelated documents just less similar than the threshold, and changed copies."""
    rnd = random.Random(seed)
    head = [f"t{i}" for i in range(int(words * shared))]
    own = lambda d: [f"o{d}x{i}" for i in range(words - len(head))]
    rows = [(d, " ".join(head + own(d))) for d in range(n)]
    for p in range(planted):
        d = rnd.randrange(n)
        t = (head + own(d))
        t[rnd.randrange(len(head), words)] = f"n{p}"  # one of the words of its own
        rows.append((n + p, " ".join(t)))
    return rows


@pytest.mark.parametrize("shared", [0.5, 0.88, 0.9, 0.97])
def test_hot_template_finds_every_link(spark, monkeypatch, shared):
    """Nodes forty times as large as what is compared exhaustively; the similarity of unrelated documents
    far below, just below and above the threshold."""
    monkeypatch.setattr(N, "SMALL", 10)
    rows = _template_rows(int(shared * 100), shared=shared)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(df, 3, 85).collect()}
    assert got == brute(rows, 3, 85)


def test_prefix_join_alone_is_exact(spark, monkeypatch):
    """All links between all sets, small blocks, and components known before."""
    from adherence.llm import prefix_join as P
    rows = [r for r in _rows(5, 150) if r[0] is not None]
    texts = spark.createDataFrame(rows, "id long, text string")
    want = {d: c for d, (n, c, _) in brute(rows, 3, 85).items() if n}
    monkeypatch.setattr(P, "BLOCK", 1500)
    sets = P.token_sets(texts, 3).where("size > 0").cache()
    for known in ([], [(d, c) for d, c in want.items() if d % 2]):
        comp = spark.createDataFrame(known, "id long, comp long")
        edges = [tuple(r) for r in P.links(sets, comp, 85).collect()] + known
        root = {d: d for d in want}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        assert {d: find(d) for d in want} == want


def test_texts_that_share_an_id_and_clashing_columns(spark):
    one, two = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(1, one, "x", 1), (1, two, "y", 2), (2, two, "z", 3), (3, "c " * 100_000, "z", 4), (4, "c " * 100_001, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string, comp long")
    got = {(r.doc_id, r.component_id) for r in N.near_duplicates(df, 3, 85).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (4, 3)}
