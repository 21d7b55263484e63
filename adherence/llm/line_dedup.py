"""Line de-duplication by a segment-partition edit join.

Lines are trimmed.  Equal lines, and lines one edit (a character put in, taken out or changed) apart,
are one class, closed over such links; of each class the first occurrence in the corpus (least doc_id,
then place) stays and the others go.  Lines of fewer than ``MIN_CHARS`` characters are compared for
equality only: at one edit most of them would meet something.  Empty lines always stay.

With a threshold of one edit a line is cut into two segments by its length.  Two lines that are one
edit apart share a segment, unchanged, at a place that their lengths determine; so each line is indexed
under its two segments, and probes the segments of lines of its own length and of one character less.
Candidates are verified by a bit-parallel edit distance on the band of three diagonals.

Segments that many lines share (over ``FEW`` in a bucket) are not paired.  Their lines are indexed
again under all but one of ``BLOCKS`` blocks; those that still meet many lines, under all but one part
of that block, and so on until a part has ``SHORT`` characters; there they are indexed under all but
one character, where whoever meets is one edit apart and is linked to the least of them.  Each step
finds every link of the lines it is given, so none is lost, and no bucket gives more than ``FEW``
squared pairs.

All in DataFrame functions.  Line texts move only for candidates; all else is hashes (128 bits for
equality).  Defined cases: a null text stays null and an empty one empty; rows with equal doc_id and
text are one document and lose the same lines; rows without doc_id come last in the order; white space
around a line does not count, but stays in lines that stay; extra columns of any name are kept by
``without_repeats``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.llm.base import components, only_ids, stored, table

#: Characters of a line that is compared up to an edit.
MIN_CHARS = 24
BLOCKS = 16
SHORT = 12
#: Lines of a bucket that are paired directly.
FEW = 16
_LAST = (1 << 63) - 1


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _trim(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\n\x0b\x0c\r"))


def _named(docs: DataFrame) -> DataFrame:
    """(doc, mark, text): a document is its id (the largest number if there is none) and a hash of its text."""
    return docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("mark"), "text").where("text is not null")


def _lines(docs: DataFrame, shortest: int) -> DataFrame:
    """(doc, mark, pos, h1, h2, k1..k4) of every line of ``shortest`` characters or more: a 128-bit hash,
    the two segments it is indexed under and the two it probes (null for a line under ``MIN_CHARS``)."""
    d = _named(docs).select("doc", "mark", F.posexplode(_split(F.col("text"))).alias("pos", "line"))
    d = d.where(F.length("line") >= shortest).withColumn("line", _trim(F.col("line")))
    n, s = F.col("n"), F.col("line")
    half, less = F.expr("n div 2").cast("int"), F.expr("(n - 1) div 2").cast("int")
    d = d.withColumn("n", F.length("line")).where(n >= shortest)
    key = lambda *x: F.when(n >= MIN_CHARS, F.xxhash64(*x))
    return d.select(
        "doc", "mark", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(77), "line").alias("h2"),
        key(n, F.lit(1), F.substring(s, F.lit(1), half)).alias("k1"), key(n, F.lit(2), F.substring(s, half + 1, n)).alias("k2"),
        key(n - 1, F.lit(1), F.substring(s, F.lit(1), less)).alias("k3"), key(n - 1, F.lit(2), F.substring(s, less + 2, n)).alias("k4"))


def _met(keys: DataFrame) -> DataFrame:
    """Of (key, h1, h2, own), the rows whose key is met by two lines, one of which is indexed under it
    (own = 1); with the number of rows of the key."""
    n = (keys.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("indexed"), F.min("h1").alias("lo"), F.max("h1").alias("hi"))
         .where("indexed = 1 and lo <> hi").select("key", "n"))
    return keys.join(n, "key")


def _pairs(met: DataFrame) -> DataFrame:
    """Pairs of lines that meet in a bucket of few."""
    few = met.where(F.col("n") <= FEW)
    a = few.where("own = 1").select("key", F.col("h1").alias("a1"), F.col("h2").alias("a2"))
    b = few.select("key", F.col("h1").alias("b1"), F.col("h2").alias("b2"), "own")
    pairs = a.join(b, "key").where("(a1 <> b1 or a2 <> b2) and (own = 0 or a1 < b1 or (a1 = b1 and a2 < b2))")
    swap = F.expr("a1 > b1 or (a1 = b1 and a2 > b2)")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    return pairs.select(pick("a1", "b1").alias("a1"), pick("a2", "b2").alias("a2"), pick("b1", "a1").alias("b1"), pick("b2", "a2").alias("b2")).distinct()


def _texts(docs: DataFrame, lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h1, h2, line) of the wanted lines (h1, h2), read from one place where each stands."""
    at = (lines.join(wanted, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.min(F.struct("doc", "mark", "pos")).alias("at"))
          .select("h1", "h2", "at.*"))
    at = stored(at, "places")
    ids = stored(at.select(F.col("doc").alias("id")).distinct(), "ids")
    d = only_ids(_named(docs).withColumnRenamed("doc", "id"), ids)
    per = at.groupBy(F.col("doc").alias("id"), "mark").agg(F.collect_list(F.struct("h1", "h2", "pos")).alias("at"))
    found = d.join(per, ["id", "mark"]).dropDuplicates(["id", "mark"]).select(_split(F.col("text")).alias("all"), F.explode("at").alias("at"))
    return found.select("at.h1", "at.h2", _trim(F.element_at("all", F.col("at.pos") + 1)).alias("line"))


def within_one(a: Column, b: Column) -> Column:
    """Whether two strings are at most one edit apart: bit-parallel, on the band of three diagonals.

    ``r0`` and ``r1`` hold, for the characters of ``a`` read so far, the diagonals (bit 0: one character
    of ``b`` less, 1: as many, 2: one more) that are reached with no and with one edit."""
    x, y = F.split(a, ""), F.split(b, "")
    # by place of a: on which diagonals its character is that of b.  Outside of the fold below, whose
    # function would split the strings anew for every character if it looked at them
    def bits(other, v):
        return F.zip_with(x, other, lambda c, d: F.when(c == d, F.lit(v)).otherwise(F.lit(0)))

    def both(p, q):
        return F.zip_with(p, q, lambda c, d: F.coalesce(c, F.lit(0)) + F.coalesce(d, F.lit(0)))

    before, after = F.concat(F.array(F.lit(None).cast("string")), y), F.slice(y, 2, F.greatest(F.size(y), F.lit(1)))
    same_at = F.slice(both(both(bits(before, 1), bits(y, 2)), bits(after, 4)), 1, F.length(a))

    def step(s, same):
        r0 = s["r0"].bitwiseAND(same)
        one = s["r1"].bitwiseAND(same).bitwiseOR(s["r0"]).bitwiseOR(F.shiftright(s["r0"], 1)).bitwiseOR(F.shiftleft(r0, 1))
        return F.struct(r0.alias("r0"), one.bitwiseAND(F.lit(7)).alias("r1"))

    end = F.aggregate(same_at, F.struct(F.lit(2).alias("r0"), F.lit(6).alias("r1")), step)
    more = F.length(b) - F.length(a)
    last = F.when(more == -1, 1).when(more == 0, 2).when(more == 1, 4).otherwise(0)
    return end["r1"].bitwiseAND(last) != 0


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    a = texts.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("line").alias("ta"))
    b = texts.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("line").alias("tb"))
    both = pairs.join(a, ["a1", "a2"]).join(b, ["b1", "b2"])
    return both.where(within_one(F.col("ta"), F.col("tb"))).select("a1", "a2", "b1", "b2")


def _narrowed(rows: DataFrame) -> DataFrame:
    """Of (key, h1, h2, own, lo, hi, line): lines that agree outside lo..hi (of the shorter line's places;
    own = 0 marks the longer one) under keys that say so for each of ``BLOCKS`` parts of lo..hi."""
    lo, hi, more = F.col("lo"), F.col("hi"), 1 - F.col("own")

    def part(k: int):
        a, b = (lo + F.floor((hi - lo) * j / BLOCKS).cast("int") for j in (k, k + 1))
        kept = F.substring("line", lo + 1, a - lo), F.substring("line", b + 1 + more, hi - b)
        return F.struct(F.xxhash64("key", a, b, *kept).alias("key"), a.alias("lo"), b.alias("hi"))

    return rows.select("h1", "h2", "own", "line", F.explode(F.array(*map(part, range(BLOCKS)))).alias("k")).where("k.hi > k.lo").select(
        "k.key", "h1", "h2", "own", "k.lo", "k.hi", "line")


def _but_one(rows: DataFrame) -> DataFrame:
    """Links (a1, a2, b1, b2) of lines that agree outside a short part (rows as in ``_narrowed``) and in
    all but one character of it: whoever meets is linked to the least line of the bucket.  A line that
    lacks a character of another meets it by its whole part."""
    part = F.substring("line", F.col("lo") + 1, F.col("hi") - F.col("lo") + 1 - F.col("own"))
    rows = rows.withColumn("part", part).withColumn("n", F.length("part"))
    rest = lambda i: F.concat(F.substring("part", F.lit(1), i - 1), F.substring("part", i + 1, F.col("n")))
    key = lambda kind, *x: F.struct(F.lit(kind).alias("kind"), F.xxhash64("key", *x).alias("key"))
    at = F.sequence(F.lit(1), F.col("n"))
    shorter = F.concat(F.array(key("whole", "part")), F.transform(at, lambda i: key("changed", i, rest(i))))
    longer = F.transform(at, lambda i: key("lacks", rest(i)))
    rows = rows.select("h1", "h2", F.explode(F.when(F.col("own") == 1, shorter).otherwise(longer)).alias("k")).select(
        "h1", "h2", (F.col("k.kind") == "changed").alias("changed"), "k.key", (F.col("k.kind") == "whole").alias("whole")).distinct()
    # two lines that lack a character each may be two edits apart: only a line that is there as a whole links them
    lead = (rows.groupBy("changed", "key").agg(F.count("*").alias("n"), F.min(F.when(F.col("whole") | F.col("changed"), F.struct("h1", "h2"))).alias("to"))
            .where("n > 1 and to is not null"))
    return rows.join(lead, ["changed", "key"]).select(
        F.col("to.h1").alias("a1"), F.col("to.h2").alias("a2"), F.col("h1").alias("b1"), F.col("h2").alias("b2"))


def _near_links(docs: DataFrame, lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """(a1, a2, b1, b2): links between different lines, enough of them to connect all that are linked."""
    one = lambda c, own: F.struct(F.col(c).alias("key"), F.lit(own).alias("own"))
    keys = distinct.where("k1 is not null").select("h1", "h2", F.explode(F.array(one("k1", 1), one("k2", 1), one("k3", 0), one("k4", 0))).alias("k")).select("k.key", "h1", "h2", "k.own")
    met = stored(_met(keys), "met")
    wanted = met.select("h1", "h2").distinct()
    texts = stored(_texts(docs, lines, wanted), "texts")
    links = _verified(_pairs(met), texts)
    crowded = met.where(F.col("n") > FEW).select("h1", "h2").distinct()
    # lines of crowded buckets begin anew, with the whole line as the part in which they may differ
    n = F.length("line")
    part = lambda own, m: F.struct(F.xxhash64(m).alias("key"), F.lit(own).alias("own"), F.lit(0).alias("lo"), m.cast("int").alias("hi"))
    rows = texts.join(crowded, ["h1", "h2"], "left_semi").select("h1", "h2", "line", F.explode(F.array(part(1, n), part(0, n - 1))).alias("k")).select("h1", "h2", "line", "k.*")
    while crowded.limit(1).count():
        met = stored(_met(_narrowed(rows).drop("line").distinct()), "met")
        links = links.unionByName(_verified(_pairs(met), texts))
        crowded = met.where(F.col("n") > FEW)
        rows = crowded.join(texts, ["h1", "h2"])
        short = F.col("hi") - F.col("lo") <= SHORT
        links = links.unionByName(_but_one(rows.where(short)))
        rows, crowded = rows.where(~short), crowded.where(~short)
    return links


def repeats(docs: DataFrame, shortest: int = MIN_CHARS) -> DataFrame:
    """(doc, mark, pos, near) of every line of ``shortest`` characters or more that goes: near, if no line
    before it in the corpus equals it."""
    lines = stored(_lines(docs, shortest), "lines")
    distinct = stored(lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), *[F.min(k).alias(k) for k in ("k1", "k2", "k3", "k4")]), "distinct")
    links = stored(_near_links(docs, lines, distinct).distinct(), "links")
    comp = components(links.select(F.col("a1").alias("a"), F.col("b1").alias("b")))
    linked = links.select(F.explode(F.array(F.struct(F.col("a1").alias("h1"), F.col("a2").alias("h2")), F.struct(F.col("b1").alias("h1"), F.col("b2").alias("h2")))).alias("x")).select("x.*").distinct()
    near = linked.join(comp, linked["h1"] == comp["id"]).select("h1", "h2", F.col("comp").alias("c1"), F.lit(0).cast("long").alias("c2"))
    many = distinct.where("n > 1").select("h1", "h2")
    classes = many.join(near, ["h1", "h2"], "full").select("h1", "h2", F.coalesce("c1", "h1").alias("c1"), F.coalesce("c2", "h2").alias("c2"))
    own = stored(lines.select("doc", "mark", "pos", "h1", "h2").join(classes, ["h1", "h2"]), "classed")
    first = own.groupBy("c1", "c2").agg(F.min(F.struct("doc", "mark", "pos")).alias("first"))
    equal = own.groupBy("h1", "h2").agg(F.min(F.struct("doc", "mark", "pos")).alias("equal"))
    at = F.struct("doc", "mark", "pos")
    return (own.join(first, ["c1", "c2"]).where(at != F.col("first")).join(equal, ["h1", "h2"])
            .select("doc", "mark", "pos", (at == F.col("equal")).alias("near")).distinct())


def _gone(docs: DataFrame) -> DataFrame:
    """(doc, mark, gone, n_near): places of the lines that go, of all that aren't empty, in order, by document."""
    return repeats(docs, shortest=1).groupBy("doc", "mark").agg(F.array_sort(F.collect_list("pos")).alias("gone"), F.sum(F.col("near").cast("long")).alias("n_near"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns, repeated lines taken out of the texts.  A document that loses lines and
    keeps nothing but white space goes as a whole: all it said is said before."""
    gone = _gone(docs).select(F.struct("doc", "mark").alias("key"), "gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.struct(
        F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("mark")).alias("key"))
    lines = _split(F.col("row.text"))
    # what stays lies between the places that go
    edge = F.concat(F.array(F.lit(-1)), "gone", F.array(F.size(lines)))
    both = rows.join(gone, "key", "left").withColumn("all", lines).withColumn("edge", edge)
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("gone")), lambda j: F.slice(
        F.col("all"), F.get(F.col("edge"), j) + 2, F.get(F.col("edge"), j + 1) - F.get(F.col("edge"), j) - 1)))
    both = both.withColumn("text_", F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n")))
    both = both.where(F.col("gone").isNull() | F.col("text_").rlike(r"[^\x20\x09-\x0D]"))
    text = {c for c in docs.columns if c.lower() == "text"}
    return both.select(*[(F.col("text_") if c in text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those that go (places from 0), and how many go by an edit only."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    per = docs.select("doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("mark"),
                      F.coalesce(F.size(_split(F.col("text"))), F.lit(0)).cast("long").alias("n_lines"))
    out = per.join(_gone(docs), ["doc", "mark"], "left")
    none = F.array().cast("array<int>")
    return out.select("doc_id", F.when(F.col("n_lines") < 0, 0).otherwise(F.col("n_lines")).alias("n_lines"), F.coalesce("gone", none).alias("gone"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_gone"), F.coalesce("n_near", F.lit(0)).alias("n_near"))
