"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad: the score of a line comes from its own features and those of the
lines before and after it, the score of a sequence also from the labels of neighbouring lines.
Forward-backward gives each line's marginal probability of being good; a document's score is their
mean, weighted by the lines' bytes.

The model is fitted on the driver, on a bounded sample: the ``SAMPLE`` labelled documents with the
smallest hashes of their ids, and of a document of more than ``SAMPLE_LINES`` lines that many lines in
a row, from a place that the hash picks.  A line's label in training is its document's.  Scoring reads
every whole text, one slice of a few MB at a time.

Defined cases: a null or empty text is one empty line, which is scored as such; rows with equal ids
are scored one by one; labels that disagree about an id count by their mean; null labels are left out;
without any usable labels of both kinds every document gets a score of 1 (none is rejected); documents
without doc_id are scored, and are not held out; extra columns are kept by ``good`` and not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.llm.base import table
from adherence.llm.words import Words, slices

SAMPLE = 4000
SAMPLE_LINES = 192
#: Lines of a training sequence; longer documents are cut into several.
SEQUENCE = 48
ROUNDS = 120
THRESHOLD = 0.3

# classes of bytes
_UPPER, _LOWER, _DIGIT, _STOP, _MARK, _SPACE, _HIGH, _LINE, _REST = range(9)
_CLASS = np.full(256, _REST, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = _UPPER, _LOWER, _DIGIT, _HIGH
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = _STOP
_CLASS[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = _MARK
_CLASS[[0x20, 9, 11, 12, 13]], _CLASS[10] = _SPACE, _LINE
N_FEATURES = 14


def line_features(col) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features by line, bytes by line, first line of each row and the end) of a text column."""
    w = Words(col)
    raw, off = w.raw, w.offsets
    breaks = np.flatnonzero(raw == 10)
    owner = np.searchsorted(off, breaks, "right") - 1
    rows = np.concatenate([np.arange(len(off) - 1), owner])
    starts = np.concatenate([off[:-1], breaks + 1])
    order = np.lexsort((starts, rows))
    rows, starts = rows[order], starts[order]
    first = np.searchsorted(rows, np.arange(len(off)))
    ends = np.append(starts[1:], len(raw))  # with the line break
    n = len(starts)
    of_byte = np.repeat(np.arange(n), ends - starts)
    kinds = _CLASS[raw]
    by = np.bincount(of_byte * 9 + kinds, minlength=9 * n).reshape(n, 9).astype(np.float64)
    size = by.sum(axis=1) - by[:, _LINE]
    line = of_byte[w.starts] if len(w.starts) else np.zeros(0, np.int64)
    words = np.bincount(line, minlength=n).astype(np.float64)
    letters = np.concatenate([[0], np.cumsum((kinds == _UPPER) | (kinds == _LOWER) | (kinds == _HIGH), dtype=np.int64)])
    bare = np.bincount(line, letters[w.ends] == letters[w.starts], minlength=n)
    repeated = np.zeros((3, n))
    for lag in (1, 2, 3):
        if len(line) > lag:
            same = (w.hashes[lag:] == w.hashes[:-lag]) & (line[lag:] == line[:-lag])
            repeated[lag - 1] = np.bincount(line[lag:], same, minlength=n)
    letter = by[:, _UPPER] + by[:, _LOWER] + by[:, _HIGH]
    one, many = np.maximum(size, 1), np.maximum(words, 1)
    last = np.where(size > 0, kinds[np.maximum(np.minimum(starts + size.astype(np.int64), len(raw)) - 1, 0)] == _STOP, False) if len(raw) else np.zeros(n, bool)
    f = np.stack([
        np.log1p(size) / 6, np.log1p(words) / 4, by[:, _UPPER] / np.maximum(letter, 1), by[:, _DIGIT] / one, by[:, _MARK] / one,
        by[:, _STOP] / one, by[:, _HIGH] / one, letter / one, bare / many, repeated[0] / many, repeated[1] / many, repeated[2] / many,
        np.minimum(size / many, 40) / 10, last.astype(np.float64)], axis=1)
    return f, size, first


def _around(f: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Features of a line, of the one before and of the one after (zeros beyond the ends), and 1."""
    n = len(f)
    before, after = np.zeros_like(f), np.zeros_like(f)
    before[1:], after[:-1] = f[:-1], f[1:]
    before[first[:-1][first[:-1] < n]] = 0
    after[first[1:] - 1] = 0
    return np.hstack([f, before, after, np.ones((n, 1))])


class Chain:
    """The fitted field: weights of ``_around`` for label 1 (good), and of pairs of labels."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.weights, self.pairs, self.mean, self.scale = weights, pairs, mean, scale

    def good(self, f: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Marginal probability of good for every line."""
        x = _around((f - self.mean) / self.scale, first) @ self.weights
        node = np.stack([np.zeros_like(x), np.clip(x, -30, 30)], axis=1)
        lengths = np.diff(first)
        order = np.argsort(-lengths, kind="stable")
        begin, lengths = first[:-1][order], lengths[order]
        node = np.exp(node - node.max(axis=1, keepdims=True))
        edge = np.exp(self.pairs - self.pairs.max())
        fore, back = node.copy(), np.ones_like(node)
        steps = int(lengths[0]) if len(lengths) else 0
        alive = [int(np.searchsorted(-lengths, -t, "left")) for t in range(steps + 1)]  # rows of over t lines
        fore[begin] /= fore[begin].sum(axis=1, keepdims=True)
        for t in range(1, steps):
            at = begin[:alive[t]] + t
            v = (fore[at - 1] @ edge) * node[at]
            fore[at] = v / v.sum(axis=1, keepdims=True)
        for t in range(steps - 1, 0, -1):
            at = begin[:alive[t]] + t
            v = (back[at] * node[at]) @ edge.T
            back[at - 1] = v / v.sum(axis=1, keepdims=True)
        both = fore * back
        return both[:, 1] / both.sum(axis=1)


def fit(features: list[np.ndarray], labels: list[int], rounds: int = ROUNDS) -> Chain:
    """Maximum likelihood with a small quadratic penalty, by Adam over all sequences at once."""
    every = np.concatenate(features)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    parts, kinds = [], []
    for f, y in zip(features, labels, strict=True):
        x = _around((f - mean) / scale, np.array([0, len(f)]))
        for a in range(0, len(x), SEQUENCE):
            parts.append(x[a:a + SEQUENCE])
            kinds.append(y)
    order = np.argsort([-len(p) for p in parts], kind="stable")
    parts, y = [parts[i] for i in order], np.array(kinds)[order]
    lengths = np.array([len(p) for p in parts])
    first = np.concatenate([[0], np.cumsum(lengths)])
    x, line_y = np.concatenate(parts), np.repeat(y, lengths)
    share = np.repeat(1.0 / lengths, lengths) / len(parts)  # each sequence counts once
    begin, steps = first[:-1], int(lengths[0])
    alive = [int((lengths > t).sum()) for t in range(steps + 1)]
    weights, pairs = np.zeros(x.shape[1]), np.zeros((2, 2))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(pairs), np.zeros_like(pairs)]
    for r in range(1, rounds + 1):
        s = np.clip(x @ weights, -30, 30)
        node = np.stack([np.exp(-np.maximum(s, 0)), np.exp(np.minimum(s, 0))], axis=1)
        edge = np.exp(pairs)
        fore, back = node.copy(), np.ones_like(node)
        fore[begin] /= fore[begin].sum(axis=1, keepdims=True)
        for t in range(1, steps):
            at = begin[:alive[t]] + t
            v = (fore[at - 1] @ edge) * node[at]
            fore[at] = v / v.sum(axis=1, keepdims=True)
        g_pairs = np.zeros((2, 2))
        for t in range(steps - 1, 0, -1):
            at = begin[:alive[t]] + t
            v = back[at] * node[at]
            joint = fore[at - 1][:, :, None] * edge * v[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            k = line_y[at]
            joint[np.arange(len(at)), k, k] -= 1
            g_pairs += (joint * share[at][:, None, None]).sum(axis=0)
            v = v @ edge.T
            back[at - 1] = v / v.sum(axis=1, keepdims=True)
        both = fore * back
        good = both[:, 1] / both.sum(axis=1)
        g_weights = x.T @ ((good - line_y) * share) + 1e-4 * weights
        g_pairs += 1e-3 * pairs
        for i, (value, grad) in enumerate(((weights, g_weights), (pairs, g_pairs))):
            m, v = state[2 * i], state[2 * i + 1]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value -= 0.15 * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.99 ** r)) + 1e-9)
    return Chain(weights, pairs, mean, scale)


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain | None:
    """The field, from labels (doc_id, quality) of documents that aren't held out; None without labels
    of both kinds.  Of rows with equal doc_id one takes part, the greatest by its features."""
    known = (labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))

    def features(batches):
        for batch in batches:
            for a, b in slices(batch.column("text")):
                part = batch.slice(a, b - a)
                f, _, first = line_features(part.column("text"))
                out = []
                for i, (lo, hi) in enumerate(zip(first[:-1], first[1:], strict=True)):
                    if hi - lo > SAMPLE_LINES:
                        lo += part.column("h")[i].as_py() % (hi - lo - SAMPLE_LINES)
                    out.append(f[lo:min(hi, lo + SAMPLE_LINES)].astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"), pa.array(out, pa.binary())], ["id", "y", "f"])

    picked = (docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(known.withColumnRenamed("doc_id", "id")), "id")
              .withColumn("h", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 40))))
    one = picked.mapInArrow(features, "id long, y int, f binary").groupBy("id", "y").agg(F.max("f").alias("f"))
    rows = one.toArrow().sort_by("id").to_pylist()
    if len({r["y"] for r in rows}) < 2:
        return None
    return fit([np.frombuffer(r["f"], np.float32).reshape(-1, N_FEATURES).astype(np.float64) for r in rows], [r["y"] for r in rows])


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _scores(col, chain: Chain | None) -> np.ndarray:
    f, size, first = line_features(col)
    if chain is None:
        return np.ones(len(first) - 1)
    good = chain.good(f, first)
    weight = np.where(np.repeat(np.add.reduceat(size, first[:-1]) > 0, np.diff(first)), size, 1.0)
    total = np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])
    return np.clip(total, 0.0, 1.0)


def scores(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """(doc_id, score) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(chain)

    def score(batches):
        for batch in batches:
            for a, b in slices(batch.column("text")):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_scores(part.column("text"), sent.value))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")


def good(docs: DataFrame, chain: Chain | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score of at least ``threshold``, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    text = [c.lower() for c in docs.columns].index("text")

    def keep(batches):
        for batch in batches:
            for a, b in slices(batch.column(text)):
                part = batch.slice(a, b - a)
                yield part.filter(pa.array(_scores(part.column(text), sent.value) >= threshold))

    return docs.mapInArrow(keep, docs.schema)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    chain = learned(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    out = scores(docs, chain)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
