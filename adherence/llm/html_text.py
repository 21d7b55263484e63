"""Main text of HTML pages, with a host's boilerplate found by suffix arrays.

A page is cut into blocks of text: markup, scripts and styles go, character references are decoded,
white space inside a block becomes one space.  Markup says what a block is where it can: what stands in ``article`` or ``main`` is
the main text, and what stands in a menu, header, footer, sidebar, notice, advert, form or comment section
is not.  Inside an article its own header is text, and names of classes only tell of sections, not of
paragraphs and headings.

What the host repeats then settles every page.  A page's stream is the tokens of its blocks outside such
containers in order, with a mark between blocks, so that a menu of many short blocks is one long run.  The
streams of a host's pages are concatenated and sorted into suffix arrays; of neighbours in the order the
longest common prefix is known, and where it is ``RUN`` tokens or more, a substring is repeated.  Substrings
on ``SHARE`` of the host's pages, two at least, are boilerplate.  On a page without a container, the tokens
that they cover are removed from the blocks that no markup tells apart, and the unique runs between them are
kept.  Text in a container is looked up in the same repeats.  An article's text may be shared, quoted in a
sidebar or taken for a teaser, so it goes only where as large a share of the host's pages, two at least, have
the substring in their containers and not outside them: a line of the site that one template puts into the
article and another beside it.

The suffix array of a host is built in parts: its pages are dealt over as many parts as keep one at
``PART`` tokens or so.  A part sends one row for the suffixes that share their first ``RUN`` tokens, with
the number of distinct pages and the length of the longest repeat that begins there; as every page is in one
part, numbers add up over parts, and a substring is repeated on so many pages if all its pieces of ``RUN``
tokens are.  So no task holds a host, and a notice on every page of a host is a few rows of each part.

Defined cases: null and empty html give an empty text; a page whose url is null or has no host shares
an empty host with others like it; rows with equal page_id are pages of their own, but count as one
page for repeats (those without one as one page, too); texts of any length are one stream; extra columns
are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.llm.base import BROADCAST_IDS, stored, table
from adherence.llm.url_filters import host_and_path
from adherence.llm.words import SPACED, U, Words, mix, slices

#: Tokens (marks between blocks among them) of a repeat at least, and the share of a host's pages that have it.
RUN, SHARE = 6, 0.3
PART = 200_000
#: Copies of a host's repeats that its pages look up, so that a host of very many pages spreads.
SALTS = 8
_MARK = U(0x5851F42D4C957F2D)

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|type|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
#: Elements whose content is not text.
_RAW = {"script", "style", "template", "noscript", "iframe", "object", "svg", "math", "canvas", "textarea", "select", "title", "noframes", "xmp"}
_MAIN = {"article", "main"}
_BOILER = {"nav", "header", "footer", "aside", "form", "dialog", "menu", "button", "head"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt",
           "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|aside|ads?|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|"
    r"cookies?|consent|gdpr|notice|popup|modal|newsletter|subscribe|signup|login|search|share|sharing|social|related|recommended|comments?|replies|respond|disqus|widget)(?:$|[\s_-])", re.I)
#: Elements that hold a section, whose class or id may say what it is also inside an article.
_SECTION = {"div", "section", "ul", "ol", "dl", "table", "figure"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
MAIN, OPEN, BOILER = 2, 1, 0


def _boilerplate(name: str, attributes: str, inside: bool) -> bool:
    if name in _BOILER and not (inside and name == "header"):
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    named = name in _SECTION if inside else True
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if named and key in ("class", "id") and _NAMES.search(value) or key == "role" and value.lower() in _ROLES or key == "hidden":
            return True
        if key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def blocks(page: str) -> list[tuple[int, str]]:
    """(kind, text) of the blocks of a page in order: MAIN, OPEN (undecided) or BOILER.

    Tags need not be closed in order: an end tag closes the nearest open element of its name, and what is
    open inside it; one without a start is passed over."""
    out, buffer, stack, at, kind = [], [], [], 0, OPEN

    def flush():
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            out.append((kind, text))

    def kind_now():
        if any(b for _, b, _ in stack):
            return BOILER
        return MAIN if any(m for _, _, m in stack) else OPEN

    n = len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            buffer.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            buffer.append(html.unescape(page[at:m.start()]))
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if not m[1] and name in _RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name == "br":
            buffer.append(" ")
            continue
        if name in _VOID and name not in ("hr",):
            continue
        if name not in _INLINE:
            flush()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if any(b for _, b, _ in stack[k:]) or any(x for _, _, x in stack[k:]):
                        flush()
                    del stack[k:]
                    break
        elif not m[3].endswith("/") and name not in _VOID:
            if name == "p" and stack and stack[-1][0] == "p":
                stack.pop()  # a paragraph ends where the next one begins
            boiler, main = _boilerplate(name, m[3], any(x for _, _, x in stack)), name in _MAIN or 'role="main"' in m[3]
            if boiler or main:
                flush()
            stack.append((name, boiler, main))
        now = kind_now()
        if now != kind:
            flush()
            kind = now
    flush()
    return out


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start places of the suffixes in order, by prefix doubling until all differ; and the length of the
    longest common prefix of each with the one before it (0 for the first), from the ranks of the doublings."""
    n, width, levels = len(tokens), 1, []
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    while n:
        levels.append((width, rank))
        if int(rank.max()) == n - 1:
            break
        later = np.full(n, -1, np.int64)
        later[:max(0, n - width)] = rank[width:]
        rank = np.unique(rank * (n + 1) + later + 1, return_inverse=True)[1].astype(np.int64)
        width *= 2
    order = np.argsort(rank, kind="stable")
    common, a, b = np.zeros(n, np.int64), order[:-1], order[1:]
    for width, rank in reversed(levels):
        i, j = a + common[1:], b + common[1:]
        inside = (i + width <= n) & (j + width <= n)
        common[1:][inside] += width * (rank[i[inside]] == rank[j[inside]])
    return order, common


class _Streams:
    """The streams of some pages, one after the other: ``token`` hashes, ``page`` and ``block`` of each, and
    the places where ``RUN`` tokens of one page begin, with their hash."""

    def __init__(self, pages: list[list[str]]):
        blocks = [b for p in pages for b in p]
        self.words = w = Words(pa.array(blocks, pa.large_string()), SPACED)
        block, n = w.rows(), len(blocks)
        page_of = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
        self.token = np.full(len(w.hashes) + n, _MARK, U)
        self.place = np.arange(len(w.hashes)) + block  # where each word stands; a mark follows each block
        self.token[self.place] = w.hashes
        self.block = np.repeat(np.arange(n), np.diff(w.first) + 1)
        self.page = page_of[self.block]
        m = max(0, len(self.token) - RUN + 1)
        self.at = np.flatnonzero(self.page[:m] == self.page[RUN - 1:][:m])
        total = np.zeros(len(self.at), U)
        for k in range(RUN):
            total += self.token[self.at + k] * U(pow(0xC2B2AE3D27D4EB4F, 2 * k + 1, 1 << 64))
        self.run = mix(total).view(np.int64)


def _repeats(pages: list[list[str]], ids: list[int]) -> list[tuple[int, int, int]]:
    """(run, pages, longest) of a part: the first ``RUN`` tokens of each repeated substring, on how many pages
    they stand and how long the longest repeat is that begins with them."""
    s = _Streams(pages)
    if not len(s.at):
        return []
    # a token of its own behind each page: no repeat goes over its end
    last = np.flatnonzero(np.diff(s.page, append=-1))
    codes = np.unique(s.token, return_inverse=True)[1].astype(np.int64)
    order, common = suffix_array(np.insert(codes, last + 1, len(codes) + np.arange(len(last))))
    back = np.insert(np.arange(len(codes)), last + 1, -1)[order]
    hash_of = np.zeros(len(codes), np.int64)
    valid = np.zeros(len(codes) + 1, bool)
    hash_of[s.at], valid[s.at] = s.run, True
    take = valid[back]  # suffixes with RUN tokens; those that share them lie in a row
    places, common = back[take], common[take]
    new = np.concatenate([[True], common[1:] < RUN])
    group = np.cumsum(new) - 1
    page = np.unique(np.array(ids), return_inverse=True)[1][s.page[places]]
    n_pages = np.bincount(np.unique(group * (int(page.max()) + 1) + page) // (int(page.max()) + 1))
    longest = np.maximum.reduceat(np.where(new, 0, common), np.flatnonzero(new))
    return list(zip(hash_of[places[new]].tolist(), n_pages.tolist(), np.maximum(longest, RUN).tolist(), strict=True))


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, blocks, kinds): the blocks in order, and what markup says of them."""

    def parse(batches):
        for batch in batches:
            for a, b in slices(batch.column("html")):
                part = batch.slice(a, b - a)
                found = [blocks(page or "") for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), part.column("host"), pa.array([[t for _, t in x] for x in found], pa.list_(pa.string())),
                                                  pa.array([[k for k, _ in x] for x in found], pa.list_(pa.int32()))], ["page_id", "url", "host", "blocks", "kinds"])

    host, _ = host_and_path(F.col("url"))
    return pages.select("page_id", "url", host.alias("host"), "html").mapInArrow(parse, "page_id long, url string, host string, blocks array<string>, kinds array<int>")


def repeated_runs(pages: DataFrame) -> DataFrame:
    """(host, run, n_pages, longest, need): hashes of the first ``RUN`` tokens of the substrings that ``SHARE``
    of a host's pages (``need``) have outside their containers, from pages as ``parsed`` gives them."""
    outside = F.transform(F.filter(F.arrays_zip("blocks", "kinds"), lambda x: x["kinds"] != MAIN), lambda x: x["blocks"])
    streams = pages.select("host", F.coalesce("page_id", F.lit(-1)).alias("page"), outside.alias("blocks"))
    tokens = F.aggregate("blocks", F.lit(0.0), lambda n, b: n + F.length(b) / 6 + 1)  # about so many
    hosts = streams.withColumn("tokens", tokens).groupBy("host", "page").agg(F.sum("tokens").alias("tokens")).groupBy("host").agg(
        F.greatest(F.lit(1), F.ceil(F.sum("tokens") / PART)).cast("int").alias("parts"), F.greatest(F.lit(2), F.ceil(F.count("*") * SHARE)).cast("long").alias("need"))
    hosts = stored(hosts, "hosts")
    dealt = streams.where(F.size("blocks") > 0).join(hosts.select("host", "parts"), "host").withColumn("part", F.pmod(F.xxhash64("page"), F.col("parts")))

    def sort(batches):
        """Parts lie in a row in their partitions, so that a task builds one array after the other."""
        held, key = [], None
        for batch in batches:
            for r in batch.to_pylist():
                if key != (r["host"], r["part"]):
                    yield from emit(key, held)
                    held, key = [], (r["host"], r["part"])
                held.append(r)
        yield from emit(key, held)

    def emit(key, held):
        if held:
            rows = _repeats([r["blocks"] for r in held], [r["page"] for r in held])
            yield pa.RecordBatch.from_arrays([pa.array([key[0]] * len(rows), pa.string()), *[pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]], ["host", "run", "n_pages", "longest"])

    ordered = dealt.select("host", "part", "page", "blocks").repartition("host", "part").sortWithinPartitions("host", "part")
    found = ordered.mapInArrow(sort, "host string, run long, n_pages long, longest long")
    merged = found.groupBy("host", "run").agg(F.sum("n_pages").alias("n_pages"), F.max("longest").alias("longest")).where("n_pages > 1")
    return merged.join(hosts.select("host", "need"), "host").where("n_pages >= need")


def _halves(batches):
    """Some pages at a time (a part of a batch), their blocks and kinds, and their streams: of page ``i`` what
    stands outside its containers is stream ``2 i``, and what stands in them ``2 i + 1``."""
    for batch in batches:
        for a, b in slices(pc.binary_join(batch.column("blocks"), ""), 1 << 20):
            part = batch.slice(a, b - a)
            pages, kinds = part.column("blocks").to_pylist(), part.column("kinds").to_pylist()
            halves = [[b for b, k in zip(p, x, strict=True) if (k == MAIN) == inside] for p, x in zip(pages, kinds, strict=True) for inside in (False, True)]
            yield part, halves, kinds, _Streams(halves)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_boilerplate): ``n_boilerplate`` counts the tokens that the host
    repeats, or that markup says are boilerplate; of a page with a container, those of it that are repeated and
    those that markup says are boilerplate."""
    p = stored(parsed(pages).withColumn("key", F.xxhash64("page_id", "url", F.concat_ws("\n", "blocks"), "kinds")), "parsed")
    runs = stored(repeated_runs(p), "runs")
    salted = runs.select("host", "run", "need", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"))
    # checked by count: the hashes of the repeats, so that other runs of the pages needn't be shuffled
    known = np.unique(np.array([r.run for r in runs.select("run").toLocalIterator()], np.int64)) if runs.count() <= BROADCAST_IDS else None

    def own_runs(batches):
        """The runs that may go: of a page without a container, or those inside its containers only."""
        for part, halves, _, s in _halves(batches):
            half, run = s.page[s.at], s.run
            if known is not None:
                hit = np.isin(run, known)
                half, run = half[hit], run[hit]
            rows = np.unique(np.rec.fromarrays([half >> 1, run, half & 1], names="page,run,inside"))
            both = np.zeros(len(rows), bool)  # outside first, then inside, of the same page and run
            both[1:] = (rows.page[1:] == rows.page[:-1]) & (rows.run[1:] == rows.run[:-1])
            has_main = np.array([len(x) > 0 for x in halves[1::2]], bool)[rows.page]
            rows = rows[~both & (has_main == (rows.inside == 1))]
            at = pa.array(rows.page)
            yield pa.RecordBatch.from_arrays([*[part.column(c).take(at) for c in ("host", "key", "page_id")], pa.array(rows.run), pa.array(rows.inside == 1)],
                                             ["host", "key", "page_id", "run", "inside"])

    own = p.select("host", "key", "page_id", "blocks", "kinds").mapInArrow(own_runs, "host string, key long, page_id long, run long, inside boolean").distinct()
    hits = stored(own.withColumn("salt", F.pmod("key", F.lit(SALTS))).join(salted, ["host", "run", "salt"]).drop("salt"), "hits")
    often = (hits.where("inside").select("host", "run", "need", F.coalesce("page_id", F.lit(-1)).alias("page")).distinct()
             .groupBy("host", "run", "need").agg(F.count("*").alias("n")).where("n >= need").select("host", "run"))
    hits = hits.where("not inside").select("key", "run").unionByName(hits.where("inside").join(often, ["host", "run"], "left_semi").select("key", "run"))
    hits = hits.groupBy(F.col("key").alias("of")).agg(F.collect_list("run").alias("runs"))

    def keep(batches):
        for part, halves, kinds, s in _halves(batches):
            covered = np.zeros(len(s.token), bool)
            repeated = [set(x or ()) for x in part.column("runs").to_pylist()]
            some = np.flatnonzero(np.array([len(x) > 0 for x in repeated], bool)[s.page[s.at] >> 1])
            for at, run, page in zip(s.at[some].tolist(), s.run[some].tolist(), (s.page[s.at[some]] >> 1).tolist(), strict=True):
                if run in repeated[page]:
                    covered[at:at + RUN] = True
            gone = covered[s.place]
            texts, n, w, block = [], [], s.words, 0
            for i, (outside, inside) in enumerate(zip(halves[::2], halves[1::2], strict=True)):
                left, lost = [], 0
                for own, those in ((outside, [k for k in kinds[i] if k != MAIN]), (inside, [MAIN] * len(inside))):
                    for text, kind in zip(own, those, strict=True):
                        a, b = int(w.first[block]), int(w.first[block + 1])
                        block += 1
                        cut = int(np.count_nonzero(gone[a:b])) if repeated[i] else 0
                        if kind == BOILER:
                            lost += b - a
                        elif kind == MAIN or not inside:
                            lost += cut
                            if not cut:
                                left.append(text)
                            elif cut < b - a:
                                left.extend(w.raw[w.starts[j]:w.ends[j]].tobytes().decode() for j in range(a, b) if not gone[j])
                texts.append(" ".join(left))
                n.append(lost)
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(n, pa.int64())],
                                             ["page_id", "url", "text", "n_boilerplate"])

    settled = (p.join(hits, p["key"] == hits["of"], "left").select("page_id", "url", "blocks", "kinds", "runs")
               .mapInArrow(keep, "page_id long, url string, text string, n_boilerplate long"))
    return settled.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_boilerplate")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages", "page_id", "url", "html"))
