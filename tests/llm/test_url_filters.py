"""URL filters: hosts, paths and rules against plain Python; templates."""

from __future__ import annotations

import re

from adherence.llm import url_filters as U


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def _rule(host, path):
    fit = [r for _, r in U.RULES if (host == (h := r.partition("/")[0]) or host.endswith("." + h)) and path.startswith(r[len(h):])]
    return max(fit, key=len, default=None)


def test_hosts_paths_and_rules(spark, sf_dir):
    odd = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG", "http://example.org/es/1", "http://x.example.org/en/12?a#b", "http://org/", "http://org", "ftp://a.com?x/fr/",
           "http://a.com#/fr/", "http://a.com/fr/x://y", "http://É.COM/de/", "http://badexample.org/es/", "http://a.com:80/fr/", "x://a.org/\nb", "http://a.com//fr/"]
    rows = [(i, u) for i, u in enumerate(odd)] + [(None, "http://example.org/es/")]
    rows += [(1000 + r["page_id"], r["url"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    df = spark.createDataFrame([(p, u, "z") for p, u in rows], "page_id long, url string, host string")
    got = {(r["page_id"], r["host"], r["path"], r["rule"]): r["verdict"] for r in U.judged(df).collect()}
    want = {(p, *_parts(u), _rule(*_parts(u))) for p, u in rows}
    assert set(got) == want
    kinds = {r: k for k, r in U.RULES}
    assert all(v == kinds[rule] for (_, _, _, rule), v in got.items() if rule)
    assert all(v in ("allow", "block") for v in got.values()) and U.judged(df.limit(0)).count() == 0


def test_impure_templates_are_rejected(spark):
    rules = (("block", "shop.example/item/1"), ("allow", "shop.example/help/"))
    rows = [(i, f"https://shop.example/item/{100 + i}") for i in range(100)]  # labelled: blocked
    rows += [(200 + i, f"https://shop.example/item/{2000 + i}") for i in range(40)]  # the same template, no rule
    rows += [(300 + i, f"https://shop.example/help/page-{i}") for i in range(60)] + [(400, "https://shop.example/about"), (401, "https://other.example/item/5")]
    got = {r["page_id"]: r for r in U.judged(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert all(got[200 + i]["verdict"] == "block" and got[200 + i]["rule"] is None and got[200 + i]["template"] == "/item/*" for i in range(40))
    assert got[400]["verdict"] == got[401]["verdict"] == got[300]["verdict"] == "allow"


def _plain_shape(s):
    import re
    if re.search(r"^[0-9]+(\.[a-z0-9]+)?$", s) or re.search(r"^[0-9a-f-]*[0-9][0-9a-f-]*$", s) and len(s) >= 6:
        return "*"
    return s


def plain_templates(urls):
    """The tree, node by node: {(host, path): template}, {(host, template): purity} of (host, path, verdict)."""
    import math
    from collections import defaultdict
    paths = {}
    for host, path, verdict in urls:
        p = paths.setdefault((host, path), [0, 0, 0])
        p[0], p[1], p[2] = p[0] + 1, p[1] + (verdict == "block"), p[2] + (verdict is not None)
    known = sum(v is not None for _, _, v in urls)
    overall = (sum(v == "block" for _, _, v in urls) + 1) / (known + 2)
    segments = {}
    for host, path in paths:
        own = (path[1:] if path.startswith("/") else path).split("/")
        own = own if len(own) <= U.DEPTH else [*own[:U.DEPTH - 1], "/".join(own[U.DEPTH - 1:])]
        segments[host, path] = [_plain_shape(s) for s in own]
    template, purity = dict.fromkeys(paths, ""), {}
    for host in {h for h, _ in paths}:
        mine = [v for (h, _), v in paths.items() if h == host]
        purity[host, ""] = (sum(v[1] for v in mine) + U.SMOOTH * overall) / (sum(v[2] for v in mine) + U.SMOOTH)
    for depth in range(U.DEPTH):
        below = defaultdict(lambda: defaultdict(list))
        for key, own in segments.items():
            if len(own) > depth:
                below[key[0], template[key]][own[depth]].append(key)
        moved = {}
        for (host, up), children in below.items():
            total = sum(paths[k][0] for keys in children.values() for k in keys)
            variable = len(children) > U.BRANCHES and (len(children) > U.MANY * total or len(children) > 20 * U.BRANCHES)
            branches = defaultdict(list)
            for segment, keys in children.items():
                branches["*" if variable else segment] += keys
            rows = []
            for branch, keys in branches.items():
                blocked, seen = (sum(paths[k][i] for k in keys) for i in (1, 2))
                rate = (blocked + 0.5) / (seen + 1)
                rows.append((seen < U.LABELLED, rate, branch, math.sqrt(rate * (1 - rate) / (seen + 1)), keys))
            rows.sort(key=lambda r: r[:3])
            groups = []
            for r in rows:
                q = groups[-1][-1] if groups else None
                apart = q is None or r[0] != q[0] or not r[0] and abs(r[1] - q[1]) > U.SIMILAR * math.sqrt(r[3] ** 2 + q[3] ** 2)
                groups.append([r]) if apart else groups[-1].append(r)
            for g in groups:
                name = min(r[2] for r in g) + ("~" if len(g) > 1 else "")
                keys = [k for r in g for k in r[4]]
                moved.update(dict.fromkeys(keys, f"{up}/{name}"))
                blocked, seen = (sum(paths[k][i] for k in keys) for i in (1, 2))
                purity[host, f"{up}/{name}"] = (blocked + U.SMOOTH * purity[host, up]) / (seen + U.SMOOTH)
        template.update(moved)
    return template, purity


def test_templates_and_purity_against_a_plain_tree(spark):
    """Wildcards, merged branches, weak ones, long paths, hot urls; every template and every purity."""
    import random
    rnd = random.Random(8)
    words = ["news", "shop", "help", "item", "a", "b", "c", "d", "2024-01-02", "77", "x.html", ""]
    urls = [("deep.example", "/" + "/".join(f"s{i}" for i in range(12_000)), "block"), ("deep.example", "/", None)]
    for host in ("one.example", "two.example", "three.example"):
        kind = {w: rnd.random() for w in words}
        for i in range(700):
            own = [rnd.choice(words if rnd.random() < 0.8 else [f"v{rnd.randrange(400)}"]) for _ in range(rnd.randint(0, 9))]
            chance = kind.get(own[0], 0.5) if own else 0.5
            urls.append((host, "/" + "/".join(own), None if rnd.random() < 0.4 else "block" if rnd.random() < chance else "allow"))
    urls += [("hot.example", "/same", "block")] * 200
    of_path, of_template = U.templates(spark.createDataFrame(urls, "host string, path string, verdict string").repartition(4))
    template, purity = plain_templates(urls)
    assert {(r.host, r.path): r.template for r in of_path.collect()} == template
    got = {(r.host, r.template): r.p for r in of_template.collect()}
    assert got.keys() == purity.keys() and all(abs(got[k] - purity[k]) < 1e-9 for k in got)
    assert any("~" in t for t in template.values()) and any("*" in t for t in template.values())


def test_repeated_page_ids_and_bare_hosts(spark):
    rows = [(1, "http://a.example"), (1, "http://a.example"), (1, "http://a.example/x"), (2, "http://a.example?q"), (3, "nothing")]
    got = sorted((r.page_id, r.host, r.path, r.verdict) for r in U.judged(spark.createDataFrame(rows, "page_id long, url string")).collect())
    assert got == [(1, "a.example", "", "allow"), (1, "a.example", "", "allow"), (1, "a.example", "/x", "allow"), (2, "a.example", "", "allow"), (3, "", "", "allow")]
