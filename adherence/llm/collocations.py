"""Phrases of a language whose words stand together more often than apart, mined in bounded memory.

Only phrases that occur ``least`` times count, and they are found by Misra-Gries summaries: every phrase is
hashed, the hash space is cut into partitions, and each partition's summary keeps a number of counters that
exceeds the partition's mass (all occurrences of its phrases) divided by ``least``, here ``SLACK`` times as
many.  What a summary takes off its counters is then below ``least``, so a phrase that occurs ``least``
times has a counter left, and one whose counter and all that was taken off are below ``least`` together is
rare for certain.  Summaries are merged by adding counters and taking the first one beyond the capacity off
all, which keeps that bound: tasks summarise the texts they read, and one merge a partition ends it.
Phrases of one and two words come first; a longer one is only looked at where both phrases that it
consists of, less a word, survived.

What survives goes into a bit filter of a fixed size, and a last pass over the texts counts exactly, by the
words themselves and again by hash partition, each phrase that the filter lets pass.  Hashes only decide what is counted: one that
several phrases share, or a filter that is full, lets a rare phrase be counted, and its count shows that it
is rare.  (Inside one slice of a few MB of text, phrases are told apart by 64-bit hashes.)

Defined cases: null texts are empty; a null lang is ``und``, the same as a lang of that name; repeated rows
and doc_ids count again; extra columns are not looked at; texts may be of any length; a language without
words has no rows, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adherence.llm.base import stored, table
from adherence.llm.words import U, Words, mix, slices

#: Occurrences at least, words of a phrase at most, phrases reported for each language, and the share of a
#: phrase's occurrences (in percent) inside one longer phrase that makes it a part of that.
LEAST, LONGEST, TOP, INSIDE = 10, 3, 2000, 50
#: Counters of a summary: so many times the partition's mass divided by ``least``.
SLACK = 4
#: Occurrences in a hash partition, about.
MASS = 1 << 23
#: Bits of a hash that summaries keep, and bits of the filter (16 MB, whatever the size of the corpus).
HASH_BITS, FILTER_BITS = 48, 27
#: Hashes, and exact counts, that a task holds before it passes them on; hashes that a merge takes in at once.
HELD, HELD_PHRASES, MERGED = 1 << 21, 700_000, 1 << 20
#: Phrases that occur so often, and more often than one in ``RARE`` words, are looked up in a broadcast frame, so
#: that no task gets all phrases of a very frequent word.
HOT, RARE = 100_000, 50_000

_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_BREAKS
_WORD[[0x20, 0x09]] = False
_SLICE = 1 << 21


class _Pieces:
    """Words of some rows of (lang, text), and their phrases, which end where a piece does."""

    def __init__(self, lang, text):
        self.words = w = Words(text, _WORD)
        self.rows = w.rows()
        lang = pc.dictionary_encode(pc.fill_null(lang, "und"))
        self.langs = lang.dictionary.to_pylist()
        self.lang = np.asarray(lang.indices)
        own = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in self.langs], U)
        self._salt = own[self.lang] if len(own) else np.zeros(0, U)
        self._lower = self._odd = None
        # non-decreasing, and equal for the words of one piece only
        self._piece = self.rows + (np.cumsum(_BREAKS[w.raw])[w.starts] if len(w.raw) else 0)

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first word, hash) of all phrases of so many words."""
        pos, hashes = self.words.grams(list(range(size)))
        whole = self._piece[pos] == self._piece[pos + size - 1]
        pos, hashes = pos[whole], hashes[whole]
        return pos, mix(hashes + self._salt[self.rows[pos]] + U(size))

    def passing(self, longest: int, kept: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Phrases by size whose hash the filter ``kept`` holds, as it holds those of their parts."""
        out, before = {}, None
        for size in range(1, longest + 1):
            pos, hashes = self.phrases(size)
            if before is not None:
                both = before[pos] & before[pos + 1]
                pos, hashes = pos[both], hashes[both]
            at = hashes >> U(64 - FILTER_BITS)
            hit = (kept[at >> U(3)] >> (at & U(7)).astype(np.uint8)) & 1 == 1
            pos, hashes = pos[hit], hashes[hit]
            out[size] = pos, hashes
            before = np.zeros(len(self.words.starts), bool)
            before[pos] = True
        return out

    def texts(self, at: np.ndarray, size: np.ndarray) -> list[bytes]:
        """Phrases, lower-cased (A-Z only), their words joined by one space."""
        w = self.words
        if self._lower is None:
            self._lower = w.raw.tobytes().lower()
            spaced = (w.starts[1:] - w.ends[:-1] == 1) & (w.raw[w.ends[:-1]] == 0x20)
            self._odd = np.concatenate([[0], np.cumsum(~spaced)])
        data, last = self._lower, at + size - 1
        as_is = (self._odd[last] == self._odd[at]).tolist()
        rows = zip(at.tolist(), size.tolist(), w.starts[at].tolist(), w.ends[last].tolist(), as_is, strict=True)
        return [data[a:b] if same else b" ".join(data[w.starts[j]:w.ends[j]] for j in range(i, i + k)) for i, k, a, b, same in rows]


def _read(batches):
    for batch in batches:
        for a, b in slices(batch.column("text"), _SLICE):
            part = batch.slice(a, b - a)
            yield _Pieces(part.column("lang"), part.column("text"))


def merged(summary, others, capacity: int):
    """A Misra-Gries summary (hashes, counters, taken off) with further (hashes, counters) added."""
    hashes, counts, off = summary
    hashes, back = np.unique(np.concatenate([hashes, *[h for h, _ in others]]), return_inverse=True)
    counts = np.bincount(back, np.concatenate([counts, *[c for _, c in others]]), len(hashes)).astype(np.int64)
    if len(counts) > capacity:
        at = len(counts) - capacity - 1
        less = int(np.partition(counts, at)[at])
        counts -= less
        off += less
        hashes, counts = hashes[counts > 0], counts[counts > 0]
    return hashes, counts, off


def _partition_summaries(docs: DataFrame, sizes: tuple[int, ...], parts: int, kept: np.ndarray | None) -> DataFrame:
    """(part, mass, hashes, counts): what each task saw of each hash partition, its mass in one row and the rest
    (mass null) in another.  Hashes are six bytes each and counts one; a phrase that occurs more often stands
    there several times."""

    def summarise(batches):
        held, n = [], 0
        for p in _read(batches):
            before = p.passing(max(sizes) - 1, kept)[max(sizes) - 1][0] if kept is not None else None
            for size in sizes:
                pos, hashes = p.phrases(size)
                if before is not None:
                    there = np.zeros(len(p.words.starts), bool)
                    there[before] = True
                    hashes = hashes[there[pos] & there[pos + 1]]
                held.append(hashes >> U(64 - HASH_BITS))
                n += len(hashes)
            if n > HELD:
                yield flushed(held)
                held, n = [], 0
        yield flushed(held)

    def flushed(held):
        hashes, counts = np.unique(np.concatenate(held or [np.zeros(0, U)]), return_counts=True)
        times = counts // 255 + (counts % 255 > 0)
        last = np.cumsum(times) - 1
        hashes, ones = np.repeat(hashes, times), np.full(times.sum(), 255, np.uint8)
        ones[last[counts % 255 > 0]] = (counts % 255)[counts % 255 > 0]
        part = _part_of(hashes, parts)
        begin = np.flatnonzero(np.diff(part, prepend=U(parts)))
        end = np.append(begin, len(part))[1:]
        six = hashes.view(np.uint8).reshape(-1, 8)[:, :HASH_BITS // 8]
        rows = [r for a, b in zip(begin, end, strict=True) for r in ((int(part[a]), int(ones[a:b].sum(dtype=np.int64)), None, None),
                                                                     (int(part[a]), None, six[a:b].tobytes(), ones[a:b].tobytes()))]
        types = pa.int64(), pa.int64(), pa.binary(), pa.binary()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["part", "mass", "hashes", "counts"])

    return docs.select("lang", "text").mapInArrow(summarise, "part long, mass long, hashes binary, counts binary")


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Partitions are ranges of the hash."""
    return (hashes >> U(HASH_BITS - 28)) * U(parts) >> U(28)


def _surviving(docs: DataFrame, sizes: tuple[int, ...], least: int, parts: int, kept: np.ndarray | None) -> np.ndarray:
    """The filter ``kept`` with the phrases of these sizes added that may occur ``least`` times."""
    def merge(batches):
        """The rows of a partition lie in a row, those with its mass first, which tell the capacity."""
        part = None
        for batch in batches:
            for i in range(batch.num_rows):
                p, own_mass = batch.column("part")[i].as_py(), batch.column("mass")[i].as_py()
                if p != part:
                    if part is not None:
                        yield ended(part, merged(summary, waiting, mass * SLACK // least + 1))
                    part, mass, summary, waiting, n = p, 0, (np.zeros(0, U), np.zeros(0, np.int64), 0), [], 0
                if own_mass is not None:
                    mass += own_mass
                    continue
                six = np.frombuffer(batch.column("hashes")[i].as_buffer(), np.uint8).reshape(-1, HASH_BITS // 8)
                hashes = np.zeros((len(six), 8), np.uint8)
                hashes[:, :HASH_BITS // 8] = six
                waiting.append((hashes.view(U).reshape(-1), np.frombuffer(batch.column("counts")[i].as_buffer(), np.uint8).astype(np.int64)))
                n += len(hashes)
                if n > MERGED:
                    summary, waiting, n = merged(summary, waiting, mass * SLACK // least + 1), [], 0
        if part is not None:
            yield ended(part, merged(summary, waiting, mass * SLACK // least + 1))

    def ended(part, summary):
        """The bits of the partition's range of the filter."""
        hashes, counts, off = summary
        bits = np.unique(hashes[counts + off >= least] >> U(HASH_BITS - FILTER_BITS))
        first = int(bits[0] >> U(3)) if len(bits) else 0
        field = np.zeros((int(bits[-1] >> U(3)) - first + 1) if len(bits) else 0, np.uint8)
        np.bitwise_or.at(field, (bits >> U(3)).astype(np.int64) - first, U(1).astype(np.uint8) << (bits & U(7)).astype(np.uint8))
        return pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([field.tobytes()], pa.binary())], ["first", "field"])

    seen = _partition_summaries(docs, sizes, parts, kept)
    fields = seen.repartition("part").sortWithinPartitions("part", F.desc_nulls_last("mass")).mapInArrow(merge, "first long, field binary")
    out = np.zeros(1 << FILTER_BITS - 3, np.uint8) if kept is None else kept.copy()
    for r in fields.toLocalIterator():  # ranges of the filter: its own size all together
        own = np.frombuffer(r.field, np.uint8)
        out[r.first:r.first + len(own)] |= own
    return out


class _Counts:
    """Exact counts of a task, in the order of the phrases' hashes."""

    def __init__(self):
        self.hashes, self.n, self.text = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, object)
        self.lang = np.zeros(0, np.int32)
        self.langs: dict[str, int] = {}
        self.words: Counter = Counter()

    def add(self, p: _Pieces, longest: int, kept: np.ndarray) -> None:
        code = np.array([self.langs.setdefault(x, len(self.langs)) for x in p.langs], np.int32)
        if len(p.langs):
            self.words.update(dict(zip(p.langs, np.bincount(p.lang[p.rows], minlength=len(p.langs)).tolist(), strict=True)))
        found = p.passing(longest, kept)
        pos, hashes = (np.concatenate([f[i] for f in found.values()]) for i in (0, 1))
        sizes = np.repeat(np.array(list(found), np.uint8), [len(f[0]) for f in found.values()])
        hashes, first, n = np.unique(hashes, return_index=True, return_counts=True)
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(at), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        self.n[at[known]] += n[known]
        at, new = at[~known], first[~known]
        self.hashes, self.n = np.insert(self.hashes, at, hashes[~known]), np.insert(self.n, at, n[~known])
        text = np.empty(len(new), object)
        text[:] = p.texts(pos[new], sizes[new].astype(np.int64))
        self.text = np.insert(self.text, at, text)
        self.lang = np.insert(self.lang, at, code[p.lang[p.rows[pos[new]]]] if len(code) else [])

    def rows(self, parts: int) -> pa.RecordBatch:
        """(part, lang, phrases, counts): the phrases of a partition and language in one row, in order, a line
        break between them, which none of them has; their counts, of as few bytes as the largest one takes; and in
        partition 0 all words as the empty phrase."""
        names, part = list(self.langs), _part_of(self.hashes >> U(64 - HASH_BITS), parts).astype(np.int64)
        order = np.lexsort((self.lang, part))
        key = part[order] * max(1, len(names)) + self.lang[order]
        begin = np.flatnonzero(np.diff(key, prepend=-1))
        out = [(0, lang, b"", np.int64(n).tobytes()) for lang, n in self.words.items() if n]
        for a, b in zip(begin, np.append(begin, len(key))[1:], strict=True):
            own = order[a:b]
            own = own[np.argsort(self.text[own])]
            n = self.n[own]
            out.append((int(part[own[0]]), names[self.lang[own[0]]], b"\n".join(self.text[own]), n.astype(np.min_scalar_type(n.max())).tobytes()))
        types = pa.int64(), pa.string(), pa.binary(), pa.binary()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["part", "lang", "phrases", "counts"])


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, size, f) of every phrase of up to ``longest`` words that occurs ``least`` times in its
    language; and a row of size 0 with the number of all words for each language."""
    # a word takes two bytes at least, with the one that ends it
    most = (docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0) // 2
    kept = None
    for sizes in [(1, 2), *[(size,) for size in range(3, longest + 1)]]:
        kept = _surviving(docs, sizes, least, max(1, -(-most * len(sizes) // MASS)), kept)
    parts = max(1, -(-most * longest // MASS))

    def count(batches):
        held = _Counts()
        for p in _read(batches):
            held.add(p, longest, kept)
            if len(held.hashes) > HELD_PHRASES:
                yield held.rows(parts)
                held = _Counts()
        yield held.rows(parts)

    def add_up(batches):
        key, held = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column("part")[i].as_py(), batch.column("lang")[i].as_py()
                if own != key:
                    if key is not None:
                        yield often(key[1], held)
                    key, held = own, {}
                phrases, counts = batch.column("phrases")[i].as_py().split(b"\n"), batch.column("counts")[i].as_py()
                for phrase, n in zip(phrases, np.frombuffer(counts, f"u{len(counts) // len(phrases)}").tolist(), strict=True):
                    held[phrase] = held.get(phrase, 0) + n
        if key is not None:
            yield often(key[1], held)

    def often(lang, held):
        rows = [(p, p.count(b" ") + 1 if p else 0, n) for p, n in held.items() if n >= least or not p]
        columns = [pa.array([lang] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.binary()).cast(pa.string()),
                   pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "size", "f"])

    seen = docs.select("lang", "text").mapInArrow(count, "part long, lang string, phrases binary, counts binary")
    return seen.repartition("part").sortWithinPartitions("part", "lang").mapInArrow(add_up, "lang string, phrase string, size int, f long")


def scored(counts: DataFrame, inside: int = INSIDE) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words or more in ``counts`` that are not part
    of a longer one: counts of the phrase, of the two parts at its weakest cut and of all words, and
    floor(1,000,000 a^2 / (l r)) there.  Exact up to counts of 10^16."""
    words = F.split("phrase", " ")
    whole = counts.where("size > 1").select("lang", "phrase", F.col("f").alias("a"), "size")

    # each cut looks up both parts; their counts lie in one frame
    def joined(first, n):
        return F.array_join(F.slice("words", first, n), " ")

    cut = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.array(
        F.struct(k.alias("k"), F.lit(0).alias("side"), joined(F.lit(1), k).alias("part")),
        F.struct(k.alias("k"), F.lit(1).alias("side"), joined(k + 1, F.col("size") - k).alias("part"))))
    parts = whole.withColumn("words", words).select("lang", "phrase", "a", F.explode(F.flatten(cut)).alias("c")).select("lang", "phrase", "a", "c.*")
    # a part that occurs f times is looked up by 2 f / least phrases at most for each place and size, as each has
    # its own occurrences of it.  Those of frequent parts know their count, and then find no partner and spread
    known = counts.where("size > 0").select("lang", F.col("phrase").alias("part"), "f")
    hot = max(HOT, (counts.where("size = 0").agg(F.sum("f")).first()[0] or 0) // RARE)
    often = known.where(F.col("f") > hot).withColumnRenamed("f", "often")
    parts = parts.join(F.broadcast(often), ["lang", "part"], "left").withColumn("salt", F.when(F.col("often").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("phrase")))
    seen = known.where(F.col("f") <= hot).withColumn("salt", F.lit(0).cast("long"))
    looked_up = parts.join(seen, ["lang", "part", "salt"], "left").withColumn("f", F.coalesce("often", "f")).where("f is not null")
    cuts = looked_up.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    big = lambda c: F.col(c).cast("decimal(38,0)")
    cuts = cuts.withColumn("n1", F.lit(1_000_000).cast("decimal(38,0)") * big("a") * big("a")).withColumn("n2", big("l") * big("r"))
    cuts = cuts.withColumn("score", F.expr("n1 div n2"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))

    shorter = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: joined(i, n))))
    longer = (whole.where("size > 2").withColumn("words", words).select("lang", F.explode(shorter).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    total = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    out = best.join(longer, ["lang", "phrase"], "left").where(~F.coalesce(100 * F.col("longer") >= inside * F.col("a"), F.lit(False)))
    return out.join(F.broadcast(total), "lang").select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, inside: int = INSIDE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language by score, then
    count, then the phrase in UTF-8 order."""
    rows = scored(stored(phrase_counts(docs, least, longest), "phrases"), inside)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents", "lang", "text"))


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) > 1
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w WHERE len(w) > 2
), f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
k AS (
  SELECT *, 1 AS k, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM c
  UNION ALL SELECT *, 2, w[1] || ' ' || w[2], w[3] FROM c WHERE size = 3
), s AS (
  SELECT k.*, fx.f AS l, fy.f AS r, (1000000::HUGEINT * a * a) // (fx.f::HUGEINT * fy.f) AS score
  FROM k JOIN f fx ON fx.lang = k.lang AND fx.phrase = k.x JOIN f fy ON fy.lang = k.lang AND fy.phrase = k.y
), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
t AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM c WHERE size = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE size = 3) GROUP BY ALL
), o AS (
  SELECT b.* FROM b LEFT JOIN t ON t.lang = b.lang AND t.phrase = b.phrase AND b.size = 2
  WHERE NOT coalesce(100 * t.a >= 50 * b.a, false)
)
SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n.n, score::BIGINT AS score
FROM o JOIN n ON n.lang = o.lang
QUALIFY rank <= 2000
"""
