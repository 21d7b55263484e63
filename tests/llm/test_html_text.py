"""HTML extraction: blocks, a plain parser on the given pages, boilerplate by suffix arrays."""

from __future__ import annotations

import random
from html.parser import HTMLParser

import numpy as np

from adherence.llm import html_text as H


class _Article(HTMLParser):
    """Text inside article, a space for every tag that isn't inline."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.text = 0, []

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.text.append(" " if tag not in ("b", "i", "a", "em") and self.inside else "")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        self.text.append(" " if tag not in ("b", "i", "a", "em") and self.inside else "")

    def handle_data(self, data):
        if self.inside:
            self.text.append(data)


def test_given_pages(spark, sf_dir):
    got = {r["page_id"]: r for r in H.op4_html_text(spark, sf_dir).collect()}
    for p in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        a = _Article()
        a.feed(p["html"])
        a.close()
        assert got[p["page_id"]]["text"] == " ".join("".join(a.text).split())
        assert got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"])


def test_blocks():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><script>var t="</p><article>";</script>
    <nav><ul><li>menu</li></ul></nav><header><h1>site</h1></header><div class="cookie-notice">we use</div><article><h1>A &amp; B</h1>
    <p>one<b>bold</b> two<br>three <p>open para &lt;x&gt; &#233;&nbsp;y<aside>side</aside><form><input value="<p>">send</form><!-- hidden <p>c</p> -->
    <div class='post comments'>reader says</div><pre>a
    b</pre><img alt=">" src=x></article><footer>&copy; f</footer>"""
    kinds = H.blocks(page)
    assert " ".join(t for k, t in kinds if k == H.MAIN) == "A & B onebold two three open para <x> é y a b"
    assert [t for k, t in kinds if k == H.OPEN] == []
    assert H.blocks("") == [] and H.blocks("plain") == [(H.OPEN, "plain")]
    assert H.blocks("<p>cut <b>off &am") == [(H.OPEN, "cut off &am")]
    assert H.blocks("</div><p>a</p></article>b<scr") == [(H.OPEN, "a"), (H.OPEN, "b<scr")]


def test_suffix_array_and_common_prefixes():
    rnd = random.Random(2)
    for n, letters in ((200, 3), (150, 1), (300, 40), (1, 1), (0, 1)):
        t = np.array([rnd.randrange(letters) for _ in range(n)], np.int64)
        order, common = H.suffix_array(t)
        keys = [t[i:].tolist() for i in order]
        assert keys == sorted(keys) and sorted(order) == list(range(n))
        for x, y, c in zip(keys, keys[1:], common[1:]):
            assert c == next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def _plain_repeats(pages):
    """Of (page id, blocks) of one host: the pages of each run of RUN tokens, and the longest repeat that
    begins with it and stands on it or another page again."""
    streams = [(i, [t for b in blocks for t in [*b.lower().split(), None]]) for i, blocks in pages]
    on, places = {}, {}
    for s, (i, tokens) in enumerate(streams):
        for at in range(len(tokens) - H.RUN + 1):
            run = tuple(tokens[at:at + H.RUN])
            on.setdefault(run, set()).add(i)
            places.setdefault(run, []).append((s, at))
    longest = {}
    for run, where in places.items():
        best = H.RUN
        for x, (s, a) in enumerate(where):
            for s2, b in where[:x]:
                p, q = streams[s][1][a:], streams[s2][1][b:]
                best = max(best, next((i for i, (u, v) in enumerate(zip(p, q)) if u != v), min(len(p), len(q))))
        longest[run] = best
    return streams, on, longest


def _host(rnd, n):
    menu = ["Home", "About us", "Sign in", "Contact"]
    words = ["alpha", "beta", "gamma", "delta"]
    return [(i % (n - 2), [*(menu if rnd.random() < 0.6 else menu[1:]), *[" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 9))) for _ in range(3)], "Share this story", f"Copyright {i % 2}"])
            for i in range(n)]


def test_repeats_of_a_part_against_brute_force():
    for seed in range(6):
        pages = _host(random.Random(seed), 12)
        _, on, longest = _plain_repeats(pages)
        got = H._repeats([b for _, b in pages], [i for i, _ in pages])
        assert sorted((n, x) for _, n, x in got) == sorted((len(on[r]), longest[r]) for r in on) and len({h for h, _, _ in got}) == len(on)


def test_undecided_pages_against_brute_force(spark, monkeypatch):
    """Hosts without containers: what RUN tokens on SHARE of the pages cover goes, all else stays; also when
    a host is built in many parts."""
    import html as lib
    import math
    hosts = {f"h{s}.example": _host(random.Random(50 + s), n) for s, n in enumerate((3, 8, 30))}
    rows = [(i, f"http://{h}/{n}", "".join(f"<div>{lib.escape(b)}</div>" for b in blocks)) for h, pages in hosts.items() for n, (i, blocks) in enumerate(pages)]
    want = {}
    for h, pages in hosts.items():
        streams, on, _ = _plain_repeats(pages)
        need = max(2, math.ceil(H.SHARE * len({i for i, _ in pages})))
        for n, (_, tokens) in enumerate(streams):
            gone = {at + k for at in range(len(tokens) - H.RUN + 1) if len(on[tuple(tokens[at:at + H.RUN])]) >= need for k in range(H.RUN)}
            plain = [t for b in pages[n][1] for t in [*b.split(), None]]
            want[f"http://{h}/{n}"] = " ".join(t for k, t in enumerate(plain) if t is not None and k not in gone)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for part in (H.PART, 60):
        monkeypatch.setattr(H, "PART", part)
        got = {r.url: r.text for r in H.extracted(df).collect()}
        assert got == want
    assert sum(len(t) for t in want.values()) > 500 and not any("About us Sign in" in t for u, t in want.items() if u.startswith("http://h2"))


def test_short_menus_go_and_an_articles_own_parts_stay(spark):
    menu = "<ul><li>Home</li><li>About us</li><li>Sign in</li></ul>"
    foot = "<p>Share this story</p><p>Copyright Acme</p>"
    rows = [(i, f"http://a.example/{i}", f"{menu}<div>own words of page {' '.join(f'p{i}w{j}' for j in range(12))}</div>{foot}") for i in range(6)]
    article = "<header class='masthead'>Site</header><article><header><h1>The big title</h1></header><p class='social'>A social matter</p><p class='notice'>Notice this</p><div class='ad'>Buy</div><section id='comments'>me too</section><p>Body</p></article>"
    rows.append((7, "http://b.example/", article))
    got = {r.page_id: r.text for r in H.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[i] == " ".join(f"p{i}w{j}" for j in range(12)) or got[i].endswith(f"p{i}w11") and "Home" not in got[i] and "Copyright" not in got[i] and "Share" not in got[i]
    assert got[7] == "The big title A social matter Notice this Body"


def test_very_long_page(spark):
    text = "word " * 200_000
    rows = [(1, "http://l.example/1", f"<div>{text}</div>"), (2, "http://l.example/2", f"<div>{' '.join(map(str, range(100_000)))}</div>")]
    got = {r.page_id: r.n_chars for r in H.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == len(text) - 1 and got[2] == len(" ".join(map(str, range(100_000))))


def test_repeated_runs_go_where_markup_is_silent(spark):
    same = "read all our other news on this very site today"
    rows = [(i, f"http://h.example/{i}", f"<div>{same} number {i}</div><div>own story {' '.join(f'w{i}x{j}' for j in range(20))}</div>") for i in range(30)]
    rows += [(100, "http://other.example/", f"<p>{same} number 5</p>"), (101, None, None), (102, None, ""), (103, "http://h.example/103", f"<article>{same}</article>"),
             (None, "http://h.example/x", f"<p>{same} and more text that stays</p>"), (5, "http://h.example/5", rows[5][2])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = H.extracted(df).collect()
    assert len(got) == len(rows)
    by = {(r["page_id"], r["url"]): r["text"] for r in got}
    for i in range(30):
        assert by[i, f"http://h.example/{i}"].startswith(("number", f"{i} own", "own")) and same not in by[i, f"http://h.example/{i}"]
        assert by[i, f"http://h.example/{i}"].endswith(f"w{i}x19")
    assert by[100, "http://other.example/"] == f"{same} number 5" and by[101, None] == by[102, None] == ""
    assert by[103, "http://h.example/103"] == same and by[None, "http://h.example/x"] == "and more text that stays"
    assert H.extracted(df.limit(0)).count() == 0


def test_repeats_of_the_site_go_from_articles_too(spark):
    """A line that one template puts into the article and another into the footer goes; what articles share, quote
    in a sidebar, or lend to teasers elsewhere stays."""
    line = "read all our other news on this very site"
    shared = "a paragraph that several articles of this host have in common with others"
    quote = "the pulled quote of the story that stands beside it as well"
    title = "a title of eight words that teasers repeat"
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(8))
    rows = [(i, f"http://h.example/{i}", f"<article><p>{own(i)}</p><p>{shared}</p><p>{line}</p></article><footer>imprint</footer>") for i in range(6)]
    rows += [(i, f"http://h.example/{i}", f"<aside>{title}</aside><aside>{quote}</aside><article><p>{own(i)}</p><p>{shared}</p><p>{quote}</p></article><footer>{line}</footer>") for i in range(6, 12)]
    rows.append((12, "http://h.example/12", f"<article><h1>{title}</h1><p>{own(12)}</p></article>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_boilerplate) for r in H.extracted(df).collect()}
    for i in range(6):
        assert got[i] == (f"{own(i)} {shared}", 1 + len(line.split()))
    for i in range(6, 12):
        assert got[i][0] == f"{own(i)} {shared} {quote}"
    assert got[12][0] == f"{title} {own(12)}"
