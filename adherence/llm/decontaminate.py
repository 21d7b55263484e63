"""Benchmark decontamination by spaced seeds.

A seed is a mask over a few words with some places ignored; two passages that differ by
substituted words still share the hash of a window whose differing words fall on ignored places.
The masks of each kind of item (by its number of words) are chosen so that wherever the substituted
words of a run that counts may stand, some window of it has them all on ignored places: no such run is
without a seed.  Hashes of the benchmark (every position, every mask of the item's kind) are joined with those of the documents; each
hit names a document, an item and a diagonal (their offset), and the overlap around it is verified
word by word.  A run of the diagonal counts if it begins and ends with an equal word and has
``MIN_WORDS`` words or, for a shorter item, nearly all of it, at most ``MAX_WRONG`` of them
substituted; every such run that is part of no longer one is given, so two of them may overlap.

A bit filter of a fixed size (``1 << FILTER_BITS`` bits, however large the benchmark is) keeps document
windows that are in no item from being moved at all.  It only spares work: what it lets through is
joined by the full hash, and by nothing else.  Texts of documents without a hit do not move.

Defined cases: null and empty texts, on either side, match nothing; rows without doc_id can't be named
and take no part in ``overlaps`` (``clean`` keeps them); rows with equal doc_id are one document; items
with equal text both match; an item of fewer words than ``KINDS`` begin with may have none substituted
(of four words none is a fifth) and is matched as a whole, word for word;
extra columns are kept by ``clean`` and otherwise not looked at; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.llm.base import BROADCAST_IDS, only_ids, stored, table
from adherence.llm.words import ALNUM, U, Words, mix, slices

#: (least words of an item, kept places of its masks).  Runs of 26 words and more have a part of 13 to 25 words
#: with no larger share of substituted words, so the last kind is complete if all runs of 13 to 25 words are hit.
KINDS = (
    (5, ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4))),
    (8, ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 4, 5), (0, 1, 3, 6, 7))),
    (14, ((0, 1, 2, 3, 5, 6, 7), (0, 1, 2, 3, 6, 8, 9), (0, 1, 2, 4, 5, 9, 10), (0, 1, 3, 7, 9, 10, 11),
          (0, 1, 4, 7, 8, 9, 10), (0, 2, 5, 7, 9, 10, 11), (0, 3, 5, 7, 8, 10, 11))),
)
MIN_WORDS = 13
MAX_WRONG = 0.2
FILTER_BITS = 25
#: Bytes of item texts that may be broadcast; beyond them the join is shuffled.
ITEM_BYTES = 16 << 20


def _seeds(w: Words, kinds):
    """(kind, word position, hash) of every window, mask by mask of the kinds."""
    for kind in kinds:
        for m, mask in enumerate(KINDS[kind][1]):
            pos, h = w.grams(list(mask))
            yield kind, pos, mix(h + U(16 * kind + m + 1))


def _probes(hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    return tuple((hashes >> U(s)) & U((1 << FILTER_BITS) - 1) for s in (0, 21, 39))


def item_seeds(items: DataFrame) -> DataFrame:
    """(h, item_id, at, kind) of the benchmark: window hashes under the masks of the item's kind, and their
    word positions, over words of letters and digits in lower case."""
    least = np.array([n for n, _ in KINDS])

    def seeds(batches):
        for batch in batches:
            for a, b in slices(batch.column("text")):
                part = batch.slice(a, b - a)
                w = Words(part.column("text"), ALNUM)
                ids = np.asarray(part.column("item_id"))
                own = np.searchsorted(least, np.diff(w.first), "right") - 1
                for kind, pos, h in _seeds(w, range(len(KINDS))):
                    row = np.searchsorted(w.first, pos, "right") - 1
                    keep = own[row] == kind
                    pos, h, row = pos[keep], h[keep], row[keep]
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[row], pa.int64()), pa.array(pos - w.first[row]), pa.array(np.full(len(pos), kind, np.int32))], ["h", "item_id", "at", "kind"])

    return items.select("item_id", "text").where("item_id is not null").mapInArrow(seeds, "h long, item_id long, at long, kind int")


def _filter(seeds: DataFrame) -> np.ndarray:
    """The bit filter: words of 64 bits, put together in Spark; at most ``2^FILTER_BITS / 64`` rows come back."""
    where = [F.shiftrightunsigned("h", s).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) for s in (0, 21, 39)]
    bit = seeds.select(F.explode(F.array(*where)).alias("i"))
    words = bit.groupBy(F.shiftright("i", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(i & 63 as int))")).alias("bits"))
    got = words.toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[got.column("w").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint8)


def _hits(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """(id, h, at): windows of documents that pass the filter."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter(seeds))
    kinds = sorted(r["kind"] for r in seeds.select("kind").distinct().collect())

    def hits(batches):
        words = bits.value

        def is_set(i):
            return (words[(i >> U(3)).astype(np.int64)] >> (i & U(7)).astype(np.uint8)) & 1 == 1

        for batch in batches:
            for a, b in slices(batch.column("text")):
                part = batch.slice(a, b - a)
                w = Words(part.column("text"), ALNUM)
                found = [(np.zeros(0, np.int64), np.zeros(0, U))]
                for _, pos, h in _seeds(w, kinds):
                    for k in range(3):
                        keep = is_set(_probes(h)[k]) if len(h) else np.zeros(0, bool)
                        pos, h = pos[keep], h[keep]
                    found.append((pos, h))
                pos, h = (np.concatenate(x) for x in zip(*found, strict=True))
                row = np.searchsorted(w.first, pos, "right") - 1
                ids = part.column("id").take(pa.array(row))
                yield pa.RecordBatch.from_arrays([ids, pa.array(h.view(np.int64)), pa.array(pos - w.first[row])], ["id", "h", "at"])

    return docs.mapInArrow(hits, "id long, h long, at long")


def _runs(doc: np.ndarray, item: np.ndarray, diagonal: int, need: int) -> list[tuple[int, int, int]]:
    """(first item word, end item word, equal words) of every maximal run of the diagonal: it begins and
    ends with an equal word, has ``need`` words and at most ``MAX_WRONG`` of them substituted, and is part
    of no other such run."""
    lo, hi = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    same = doc[lo + diagonal:hi + diagonal] == item[lo:hi]
    starts = np.flatnonzero(same)
    if not len(starts):
        return []
    wrong = round(100 * MAX_WRONG)
    # a run is within MAX_WRONG if the score at its end is not below that at its start
    score = np.concatenate([[0], np.cumsum(np.where(same, wrong, wrong - 100))])
    at_ends = score[starts + 1]
    beyond = np.maximum.accumulate(at_ends[::-1])  # from the last end to the first
    last = len(starts) - 1 - np.searchsorted(beyond, score[starts], "left")
    longest = np.concatenate([[True], last[1:] > np.maximum.accumulate(last)[:-1]])
    ends = starts[last] + 1
    equal = np.concatenate([[0], np.cumsum(same)])
    return [(lo + int(s), lo + int(e), int(equal[e] - equal[s])) for s, e in zip(starts[longest], ends[longest], strict=True) if e - s >= need]


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, doc_word, item_word, n_words, n_equal, coverage) of every verified overlap:
    where the run begins in the document and in the item, its length, its equal words, and the part of
    the item that it covers."""
    named = docs.select(F.col("doc_id").alias("id"), "text").where("id is not null")
    seeds = stored(item_seeds(items), "seeds")
    hits = _hits(named, seeds)
    found = hits.join(seeds, "h").groupBy("id", "item_id", (hits["at"] - seeds["at"]).alias("diagonal")).agg(F.count("*").alias("n_hits"))
    found = stored(found.select("id", "item_id", "diagonal").unionByName(_whole_short(named, items)), "found")
    ids = stored(found.select("id").distinct(), "ids")
    texts = only_ids(named, ids)
    given = items.select("item_id", F.col("text").alias("item"))
    few = (given.agg(F.sum(F.octet_length("item") + 64)).first()[0] or 0) <= ITEM_BYTES
    both = found.join(F.broadcast(given) if few else given, "item_id").join(texts, "id")

    def verify(batches):
        for batch in batches:
            for a, b in slices(batch.column("text")):
                part = batch.slice(a, b - a)
                d, i = Words(part.column("text"), ALNUM), Words(part.column("item"), ALNUM)
                rows = []
                for k, diagonal in enumerate(part.column("diagonal").to_pylist()):
                    item = i.hashes[i.first[k]:i.first[k + 1]]
                    doc = d.hashes[d.first[k]:d.first[k + 1]]
                    if max(0, -diagonal) >= min(len(item), len(doc) - diagonal):
                        continue
                    need = min(MIN_WORDS, max(1, round(0.9 * len(item))))
                    rows += [(k, s + diagonal, s, e - s, same, (e - s) / len(item)) for s, e, same in _runs(doc, item, diagonal, need)]
                at, dw, iw, n, same, cover = (list(x) for x in zip(*rows, strict=True)) if rows else ([],) * 6
                keep = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(keep), part.column("item_id").take(keep), pa.array(dw, pa.int64()), pa.array(iw, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(same, pa.int64()), pa.array(cover, pa.float64())],
                    ["doc_id", "item_id", "doc_word", "item_word", "n_words", "n_equal", "coverage"])

    return both.select("id", "item_id", "diagonal", "text", "item").mapInArrow(
        verify, "doc_id long, item_id long, doc_word long, item_word long, n_words long, n_equal long, coverage double").distinct()


def _whole_short(named: DataFrame, items: DataFrame) -> DataFrame:
    """(id, item_id, diagonal) for items of fewer words than ``KINDS`` begin with: they have no
    window, and are looked for whole, as a run of words."""
    span = KINDS[0][0]
    word = r"[A-Za-z0-9\x{80}-\x{10FFFF}]+"
    lower = lambda c: F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = F.regexp_count("item", F.lit(word))
    short = items.where("item_id is not null").select("item_id", lower("text").alias("item")).where((n > 0) & (n < span))
    short = stored(short, "short")
    if not short.limit(1).count():
        return named.sparkSession.createDataFrame([], "id long, item_id long, diagonal long")
    keyed = short.select("item_id", F.regexp_extract_all("item", F.lit(f"({word})")).alias("w"))
    keyed = keyed.select("item_id", F.size("w").alias("n"), F.array_join("w", " ").alias("g"))
    sizes = [r["n"] for r in keyed.select("n").distinct().collect()]  # fewer than KINDS begin with
    words = named.select("id", F.regexp_extract_all(lower("text"), F.lit(f"({word})")).alias("w"))
    runs = F.array(*map(F.lit, sizes))
    grams = words.select("id", "w", F.explode(runs).alias("n")).where("size(w) >= n").select(
        "id", "n", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1), lambda i: F.array_join(F.slice("w", i, F.col("n")), " "))).alias("at", "g"))
    return grams.join(keyed, ["n", "g"]).select("id", "item_id", F.col("at").cast("long").alias("diagonal"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that overlap with no benchmark item, with all their columns."""
    hit = stored(overlaps(docs, items).select(F.col("doc_id").alias("id")).distinct(), "leaks")
    few = hit.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(hit) if few else hit, docs["doc_id"] == hit["id"], "left_anti")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))
