"""License scans against a plain search, with changed notices."""

from __future__ import annotations

from adherence.llm import licenses as L


def test_every_whole_notice(spark, sf_dir):
    got = {}
    for r in L.op1_licenses(spark, sf_dir).collect():
        got[r["doc_id"], r["license"]] = got.get((r["doc_id"], r["license"]), 0) + 1
    want = {}
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        for name, text in L.TEMPLATES.items():
            if n := d["text"].count(text):
                want[d["doc_id"], name] = n
    assert want and got == want


def test_changed_notices_and_spans(spark):
    grant = L.TEMPLATES["ISC"].split()
    less = [w for i, w in enumerate(grant) if i not in (9, 20)]
    more = grant[:15] + ["really"] + grant[15:]
    other = [("thing" if i == 12 else w) for i, w in enumerate(grant)]
    rows = [(1, "é before. " + " ".join(less) + " after."), (2, " ".join(more)), (3, "\n".join(other).upper()), (4, " ".join(grant[:12])), (5, None), (6, ""), (None, " ".join(grant)),
            (7, "All rights reserved. " * 4), (8, "filler " * 50_000 + " ".join(grant)), (9, "licensed under the terms")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, coverage int")
    got = L.scan(df).collect()
    n = {}
    for r in got:
        n[r["doc_id"], r["license"]] = n.get((r["doc_id"], r["license"]), 0) + 1
    assert n == {(1, "ISC"): 1, (2, "ISC"): 1, (3, "ISC"): 1, (None, "ISC"): 1, (7, "All rights reserved"): 4, (8, "ISC"): 1}
    for r in got:
        text = dict(rows)[r["doc_id"]].encode()[r["start_byte"]:r["end_byte"]].decode().lower()
        assert text.startswith(("permission to use", "permission\nto", "all rights")) and text.endswith(("copies", "reserved"))
        if r["doc_id"] == 1:
            assert r["matched"] == len(L.Words(__import__("pyarrow").array([" ".join(less)]), L.ALNUM).starts)
    assert L.scan(df.limit(0)).count() == 0


def test_whole_texts_and_siblings(spark):
    texts = {n: t for n, t in L.shipped().items() if n not in L.TEMPLATES}
    assert {"MIT whole text", "GPL-3.0 whole text", "MPL-2.0 whole text", "AGPL-3.0-or-later notice", "CC-BY-SA-4.0 notice"} <= set(texts)
    rows = [(i, "before it " + t + " after it") for i, t in enumerate(texts.values())]
    rows += [(1000, L.TEMPLATES["MIT text"])]  # a part is not reported as the whole
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    for i, name in enumerate(texts):
        assert [r["coverage"] for r in got if r["doc_id"] == i and r["license"] == name] == [1.0], name
    notices = {i: n for i, n in enumerate(texts) if n.endswith("notice")}
    assert {(r["doc_id"], r["license"]) for r in got if r["doc_id"] in notices and r["license"] in notices.values()} == set(notices.items())
    assert {r["license"] for r in got if r["doc_id"] == 1000} == {"MIT text"}


def _plain_align(doc, template, lo, hi):
    """Score and matches of the best local alignment in the band, cell by cell."""
    score, best = {}, (0, 0)
    for i, t in enumerate(template):
        for d in range(lo, hi + 1):
            j = i + d
            if not 0 <= j < len(doc):
                continue
            here = [(0, 0)]
            s, k = score.get((i - 1, j - 1), (0, 0))
            here.append((s + 2, k + 1) if doc[j] == t else (s - 1, k))
            for cell in ((i - 1, j), (i, j - 1)):
                if cell in score:
                    here.append((score[cell][0] - 1, score[cell][1]))
            score[i, j] = max(here)
            best = max(best, score[i, j])
    return best[0]


def test_alignment_against_cell_by_cell():
    import random

    import numpy as np
    rnd = random.Random(5)
    for _ in range(150):
        template = [rnd.randrange(6) for _ in range(rnd.randint(1, 25))]
        doc = [x for x in template if rnd.random() < 0.9 for x in ([x] if rnd.random() < 0.9 else [x, 7])]
        doc = [rnd.randrange(8) if rnd.random() < 0.1 else x for x in doc] or [1]
        lo = rnd.randint(-3, 1)
        hi = lo + rnd.randint(0, 5)
        score, matched, s, end, u, v = L.align(np.array(doc), np.array(template), lo, hi)
        assert score == max(0, _plain_align(doc, template, lo, hi))
        if score:
            assert 0 <= s < end <= len(doc) and 0 <= u < v <= len(template) and doc[s] == template[u] and doc[end - 1] == template[v - 1]
            assert 0 < matched <= min(end - s, v - u)


def test_licences_with_passages_put_in_left_out_or_exchanged(spark):
    texts = {n: t for n, t in L.shipped().items() if n in ("MIT whole text", "GPL-3.0 whole text", "Apache-2.0 whole text", "MPL-2.0 whole text")}
    assert len(texts) == 4
    rows, want = [], {}
    for i, (name, text) in enumerate(texts.items()):
        words = text.split()
        half, third = len(words) // 2, len(words) // 3
        added = [f"addition{j}" for j in range(40)]
        rows += [(10 * i, "before " + " ".join(words[:half] + added + words[half:]) + " after"),                 # put in
                 (10 * i + 1, " ".join(words[:third] + added + words[third:2 * third] + added + words[2 * third:])),  # twice
                 (10 * i + 2, " ".join(words[:third] + words[third + len(words) // 10:])),                        # left out
                 (10 * i + 3, " ".join(words[half:] + added * 40 + words[:half])),                                # in another order
                 (10 * i + 4, " ".join(words[:half]))]
        want |= {(10 * i, name): 2, (10 * i + 1, name): 3, (10 * i + 2, name): 2}
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    found = {(r.doc_id, r.license): r for r in got if r.license in texts}
    assert {k: len(r.parts) for k, r in found.items()} == want
    for (i, name), r in found.items():
        assert r.coverage > (0.85 if i % 10 == 2 else 0.97)
        ends = [(p.start_word, p.end_word, p.template_start, p.template_end) for p in r.parts]
        assert all(x[1] <= y[0] and x[3] <= y[2] for x, y in zip(ends, ends[1:])) and (r.start_word, r.end_word) == (ends[0][0], ends[-1][1])
        if i % 10 == 0:
            assert ends[1][0] - ends[0][1] in range(39, 44)
