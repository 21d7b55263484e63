"""Decontamination against brute force, with planted passages."""

from __future__ import annotations

import itertools
import random

import numpy as np

from adherence.llm import decontaminate as D


def _table(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} long, text string, extra int")


def test_planted_passages(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(rnd.randint(18, 50))), 0) for i in range(20)]
    items += [(100, "only four words here", 0), (101, None, 0), (102, "", 0), (103, items[0][1], 0)]
    noise = lambda n: " ".join(word() for _ in range(n))
    docs, want = [], set()
    for d in range(80):
        text = noise(rnd.randint(0, 200))
        if d % 4 == 0:
            i, passage, _ = items[rnd.randrange(20)]
            w = passage.split()
            if d % 8 == 0:  # one word in eight is another one
                for k in range(4, len(w), 8):
                    w[k] = word()
            text = f"{text} {' '.join(w).upper() if d % 16 == 0 else ', '.join(w)}. {noise(30)}"
            want.add((d, i))
            if items[0][0] == i:
                want.add((d, 103))
        docs.append((d, text, 1))
    docs += [(200, None, 1), (201, "", 1), (202, "x Only, FOUR words here y", 1), (None, items[1][1], 1)]
    want.add((202, 100))
    a, b = _table(spark, docs, "doc_id").repartition(3), _table(spark, items, "item_id")
    got = D.overlaps(a, b).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    texts = {d: t for d, t, _ in docs}
    for r in got:
        if r["n_equal"] == r["n_words"] and r["item_id"] < 100:
            assert r["coverage"] > 0.9 and r["n_words"] >= 13
            assert r["doc_word"] >= 0 and len(texts[r["doc_id"]].split()) >= r["doc_word"] + r["n_words"]
    out = D.clean(a, b)
    assert out.columns == a.columns
    assert {r["doc_id"] for r in out.collect()} == {d for d, _, _ in docs} - {d for d, _ in want}
    assert D.overlaps(a.limit(0), b).count() == D.overlaps(a, b.limit(0)).count() == 0


def test_finds_every_whole_item(spark, sf_dir):
    got = {(r["doc_id"], r["item_id"]) for r in D.op9_decontaminate(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    whole = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in d["text"]}
    assert whole and whole <= got


def test_every_maximal_run():
    rnd = random.Random(9)
    for _ in range(300):
        n = rnd.randint(1, 60)
        doc = np.arange(n, dtype=np.uint64)
        item = doc.copy()
        for i in range(n):
            if rnd.random() < rnd.choice([0.1, 0.25, 0.4]):
                item[i] = 1000 + i
        diagonal = rnd.randint(-5, 5)
        doc = np.concatenate([np.full(max(0, diagonal), 5000, np.uint64), doc])[max(0, -diagonal):]
        same = [0 <= i + diagonal < len(doc) and doc[i + diagonal] == item[i] for i in range(n)]
        fits = [(s, e) for s in range(n) for e in range(s + 13, n + 1) if same[s] and same[e - 1] and 5 * same[s:e].count(False) <= e - s]
        want = [(s, e, sum(same[s:e])) for s, e in fits if not any((a, b) != (s, e) and a <= s and e <= b for a, b in fits)]
        if max(0, -diagonal) < min(len(item), len(doc) - diagonal):
            assert D._runs(doc, item, diagonal, 13) == want


def test_overlap_beside_a_badly_changed_stretch(spark):
    w = [f"w{i}" for i in range(128)]
    text = [x if i < 20 or (i - 20) % 4 else f"other{i}" for i, x in enumerate(w)]  # 20 exact words, then 27 times 1 wrong and 3 right
    a, b = _table(spark, [(1, " ".join(text), 0)], "doc_id"), _table(spark, [(1, " ".join(w), 0)], "item_id")
    got = D.overlaps(a, b).collect()
    assert any(r["doc_word"] == 0 and r["n_words"] >= 20 for r in got)
    assert all(5 * (r["n_words"] - r["n_equal"]) <= r["n_words"] for r in got)
    assert D.clean(a, b).count() == 0


def test_masks_hit_every_placement():
    def missed(masks, n, wrong):
        """Placements of the wrong words inside a run of n words that no window of a mask has on ignored places."""
        out = []
        # a part of a longer run may begin or end with a wrong word
        for places in itertools.combinations(range(n) if n >= D.KINDS[-1][0] else range(1, n - 1), wrong):
            if not any(all(s + k not in places for k in m) for m in masks for s in range(n - m[-1])):
                out.append(places)
        return out

    for words in range(5, 26):
        masks = [m for least, m in D.KINDS if least <= words][-1]
        for n in range(min(D.MIN_WORDS, max(1, round(0.9 * words))), words + 1):
            assert not missed(masks, n, n // 5), (words, n)


def test_short_and_heavily_changed_items(spark):
    rnd = random.Random(2)
    sizes = {5: [2], 6: [3], 7: [3], 8: [3], 9: [4], 10: [3, 6], 13: [4, 8], 15: [3, 7, 11], 20: [4, 8, 12, 16]}
    items, docs = [], []
    for n, places in sizes.items():
        words = [f"n{n}x{i}" for i in range(n)]
        items.append((n, " ".join(words), 0))
        for k in places:
            words[k] = "other"
        noise = [f"z{rnd.randrange(1000)}" for _ in range(40)]
        docs.append((n, " ".join(noise[:20] + words + noise[20:]), 0))
    got = D.overlaps(_table(spark, docs, "doc_id"), _table(spark, items, "item_id")).collect()
    assert {(r["doc_id"], r["item_id"], r["n_words"], r["n_equal"]) for r in got} == {(n, n, n, n - len(p)) for n, p in sizes.items()}
