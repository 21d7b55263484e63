"""Exact links of sets that branch by their rarest tokens.

A set of n tokens is put into a node for each of its rarest tokens, in one fixed order for all sets.  If A
and B (|A| <= |B|) have ``100 |A and B| >= percent |A or B|``, they share ``2 percent |A| / (100 + percent)``
tokens at least, and ``percent |B| / 100``; so the first common token is among the first
``|A| - that + 1`` of A (its stem) and the first ``|B| - that + 1`` of B (its reach).  Stems and reaches that
meet in a token are compared by their full sets: no link is lost, whatever the order, and a good order
makes few sets meet.  The order is by how often a token occurs, counted in ``1 << BUCKETS`` buckets, so the
tokens of a template that a third of all sets share come last, and those sets meet only where the rest of
them agrees.  Linked sets are of like size, so a node is a token and a class of sizes, in which the largest is
``100 / percent`` times the smallest: a stem goes to its own class, a reach to its own and the one below.

Sets that are in one component already need no comparison.  Of a token's sets, therefore, those outside
its largest component meet all, and those inside it only the ones outside.  Where many are left to meet, stems and
reaches are cut into blocks of about ``BLOCK`` tokens, and each pair of blocks is a task's work: every pair
of sets meets once, and no task gets more than two blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.llm.base import BROADCAST_IDS, stored
from adherence.llm.words import U, Words, mix, shingle_sets, slices

#: Counters of the token order (log2), and tokens of a block; a set counts as ``LEAST`` tokens at least.
BUCKETS, BLOCK, LEAST = 20, 1 << 20, 512
_RANGE = 1 << 12


def token_sets(texts: DataFrame, k: int) -> DataFrame:
    """(id, size, tokens) of (id, text): the sorted distinct shingle hashes, eight bytes each."""

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column("text")):
                part = batch.slice(a, b - a)
                sets = shingle_sets(Words(part.column("text")), k)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 ["id", "size", "tokens"])

    return texts.select("id", "text").mapInArrow(run, "id long, size long, tokens binary")


def _flat(column) -> np.ndarray:
    return np.concatenate([np.zeros(0, U), *[np.frombuffer(x.as_buffer(), U) for x in column]])


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens ^ U(0xA0761D6478BD642F)) >> U(64 - BUCKETS)).astype(np.int64)


def frequency_order(sets: DataFrame) -> np.ndarray:
    """The level of each bucket of tokens: how often they occur, as a logarithm in quarter steps.  Tasks send
    counters by ranges; the driver gets a byte a bucket."""

    def count(batches):
        total = np.zeros(1 << BUCKETS, np.int64)
        for batch in batches:
            tokens = _flat(batch.column("tokens"))
            for at in range(0, len(tokens), 1 << 20):
                total += np.bincount(_bucket(tokens[at:at + (1 << 20)]), minlength=1 << BUCKETS)
        used = np.flatnonzero(total.reshape(-1, _RANGE).any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([total.reshape(-1, _RANGE)[r].tobytes() for r in used], pa.binary())], ["r", "n"])

    def add_up(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for r, n in zip(batch.column("r").to_pylist(), batch.column("n"), strict=True):
                held[r] = held.get(r, 0) + np.frombuffer(n.as_buffer(), np.int64)
        levels = [np.minimum(255, 4 * np.log2(n + 1)).astype(np.uint8).tobytes() for n in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(levels, pa.binary())], ["r", "levels"])

    out = np.zeros(1 << BUCKETS, np.uint8)
    for row in sets.select("tokens").mapInArrow(count, "r long, n binary").repartition("r").mapInArrow(add_up, "r long, levels binary").collect():
        out[row.r * _RANGE:(row.r + 1) * _RANGE] = np.frombuffer(row.levels, np.uint8)
    return out


def branches(sets: DataFrame, levels: np.ndarray, percent: int) -> DataFrame:
    """(token, id, size, stem): the nodes (tokens with a class of sizes) that each set goes to; those of its
    stem are marked."""

    def run(batches):
        for batch in batches:
            size = batch.column("size").to_numpy().astype(np.int64)
            tokens = _flat(batch.column("tokens"))
            if not len(tokens):
                continue
            row = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((tokens, levels[_bucket(tokens)], row))
            tokens, place = tokens[order], np.arange(len(tokens)) - np.repeat(np.cumsum(size) - size, size)
            stem = size - -(-2 * percent * size // (100 + percent)) + 1
            reach = size - -(-percent * size // 100) + 1
            keep = place < reach[row]
            row, place, tokens = row[keep], place[keep], tokens[keep]
            ids = batch.column("id").to_numpy()
            # a little wider than the ratio, so that rounding parts no pair
            kind = np.floor(np.log(np.maximum(size, 1)) / np.log(100.0001 / percent)).astype(np.int64)
            for at in range(0, len(row), 1 << 17):
                r, t, first = row[at:at + (1 << 17)], tokens[at:at + (1 << 17)], place[at:at + (1 << 17)]
                for below in (0, 1):
                    node = mix(t + (kind[r] - below).astype(U) * U(0x9E3779B97F4A7C15))
                    stems = first < stem[r] if not below else np.zeros(len(r), bool)
                    yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(ids[r]), pa.array(size[r]), pa.array(stems)], ["token", "id", "size", "stem"])

    return sets.select("id", "size", "tokens").mapInArrow(run, "token long, id long, size long, stem boolean")


def _cells(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """(token, part, strip, lane, left, id, comp): which sets meet where.  Part 1: stems outside the token's
    largest component with all reaches; part 2: stems inside it with the reaches outside."""
    rows = rows.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    weight = F.greatest("size", F.lit(LEAST))
    by_comp = rows.groupBy("token", "comp").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("stem"), weight)).alias("stems"), F.sum(weight).alias("reaches"))
    main = F.max_by(F.struct("comp", "stems", "reaches"), F.struct("n", "comp"))
    tokens = by_comp.groupBy("token").agg(main.alias("main"), F.count("*").alias("n_comps"), F.coalesce(F.sum("stems"), F.lit(0)).alias("stems"), F.sum("reaches").alias("reaches"))
    blocks = lambda c: F.ceil(c / F.lit(BLOCK)).cast("int")
    main_stems = F.coalesce("main.stems", F.lit(0))
    tokens = tokens.where("n_comps > 1 and stems > 0").select(
        "token", F.col("main.comp").alias("main"), blocks(F.col("stems") - main_stems).alias("s1"), blocks(F.col("reaches")).alias("r1"),
        blocks(main_stems).alias("s2"), blocks(F.col("reaches") - F.col("main.reaches")).alias("r2"))
    tokens = stored(tokens, "tokens")
    few = tokens.limit(BROADCAST_IDS // 4 + 1).count() <= BROADCAST_IDS // 4
    met = rows.join(F.broadcast(tokens) if few else tokens, "token")
    inside = F.col("comp") == F.col("main")

    def side(part: int, left: bool, taken, own: str, other: str) -> F.Column:
        """The copies of a row on one side of one part: its own block with each of the other side's."""
        mine = F.pmod(F.xxhash64("id"), F.greatest(F.col(own), F.lit(1))).cast("int")
        cell = lambda i: F.struct(F.lit(part).alias("part"), (mine if left else i).alias("strip"), (i if left else mine).alias("lane"), F.lit(left).alias("left"))
        meets = taken & (F.col(own) > 0) & (F.col(other) > 0)
        return F.when(meets, F.transform(F.sequence(F.lit(0), F.greatest(F.col(other) - 1, F.lit(0))), cell)).otherwise(F.array())

    cells = F.concat(side(1, True, F.col("stem") & ~inside, "s1", "r1"), side(1, False, F.lit(True), "r1", "s1"),
                     side(2, True, F.col("stem") & inside, "s2", "r2"), side(2, False, ~inside, "r2", "s2"))
    return met.select("token", "id", "comp", F.explode(cells).alias("c")).select("token", "c.*", "id", "comp")


_CELL = ("token", "part", "strip", "lane")


def _links(t: pa.Table, percent: int):
    """A spanning set of the links between components of one cell's left and right sets."""
    left = t.column("left").to_numpy(zero_copy_only=False)
    ids, comp = t.column("id").to_numpy(), t.column("comp").to_numpy()
    sets = [np.frombuffer(x.as_buffer(), U) for x in t.column("tokens")]
    size = np.array([len(s) for s in sets], np.int64)
    label = np.unique(comp, return_inverse=True)[1]
    x, y = np.flatnonzero(left), np.flatnonzero(~left)
    both = shared_counts([sets[i] for i in x], [sets[j] for j in y])
    hit = (both > 0) & (100 * both >= percent * (size[x][:, None] + size[y][None] - both)) & (label[x][:, None] != label[y][None])
    out = []
    for i, j in zip(*np.nonzero(hit), strict=True):
        a, b = x[i], y[j]
        if label[a] != label[b]:
            out.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
            label[label == label[b]] = label[a]
    return out


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, as products of their 0-1 rows over the
    tokens that both sides have, some thousand at a time."""
    out = np.zeros((len(left), len(right)), np.float32)  # exact up to 2^24 tokens
    flat = [np.concatenate([np.zeros(0, U), *s]) for s in (left, right)]
    common = np.intersect1d(flat[0], flat[1])
    places = []
    for s, f in zip((left, right), flat, strict=True):
        at = np.searchsorted(common, f)
        known = (at < len(common)) & (common[np.minimum(at, max(0, len(common) - 1))] == f) if len(common) else np.zeros(len(f), bool)
        rows, codes = np.repeat(np.arange(len(s)), [len(x) for x in s])[known], at[known]
        order = np.argsort(codes, kind="stable")
        places.append((rows[order], codes[order]))
    step = max(256, (1 << 22) // max(1, len(left) + len(right)))
    for a in range(0, len(common), step):
        blocks = []
        for (rows, codes), n in zip(places, (len(left), len(right)), strict=True):
            lo, hi = np.searchsorted(codes, [a, a + step])
            block = np.zeros((n, min(step, len(common) - a)), np.float32)
            block[rows[lo:hi], codes[lo:hi] - a] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out.astype(np.int64)


def links(sets: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components (id, comp; an id that isn't there is its own) of stored ``token_sets``
    of distinct ids: enough of them to join all that any link joins."""
    rows = stored(branches(sets, frequency_order(sets), percent), "branches")
    cells = _cells(rows, comp)
    full = cells.join(sets.select("id", "tokens"), "id").select(*_CELL, "left", "id", "comp", "tokens")

    def run(batches):
        held, key = [], None
        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in _CELL], strict=True))
            at = 0
            while at < len(keys):
                end = at
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if keys[at] != key:
                    if held:
                        yield found(held)
                    held, key = [], keys[at]
                held.append(batch.slice(at, end - at))
                at = end
        if held:
            yield found(held)

    def found(held):
        out = _links(pa.Table.from_batches(held).combine_chunks(), percent)
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    return full.repartition(*_CELL).sortWithinPartitions(*_CELL, "id").mapInArrow(run, "a long, b long").distinct()
