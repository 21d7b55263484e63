"""Spelling variants of words by a dictionary of trie-node pairs.

The vocabulary stands in a forward and in a reversed trie, whose nodes are numbered.  A word of length L
that leaves out its position i is the pair (node of its first i characters, reversed node of its last
L - i - 1); a word that takes in a character at i is (node of its first i, reversed node of its last
L - i).  Two words differ by one replaced character if they have a pair of the first kind in common, and
by one inserted or deleted one if a pair of the first kind of the longer is one of the second kind of the
shorter.  So one grouping by two integers gives all neighbours exactly, and no word is compared with
another.  Such a group holds words that differ at one place only: as many as the alphabet has letters, and
one more, so it needs no cap.  In a run of equal letters only the first one is left out, so a pair of
words meets in one group only.

Numbering: the sorted vocabulary lies end to end, and a node has the place of its last character in the
first word that passes through it.  Each block of the sorted words is walked on its own; what a block
takes over from the one before (the nodes of the common prefix) follows from the blocks' first and last
words, which are all that the driver sees.  Only nodes that two words share can be in a common pair, so a
word keeps its nodes as far as its longest common prefix (suffix) with a neighbour in the order.

Defined cases: null and empty texts have no words; a null doc_id is written as the empty string in the
salt; repeated rows count again; extra columns are not looked at; words may be of any length; an empty
table gives an empty result.  Ties between forms go to the smallest word in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.llm.base import stored, table

#: Code points of a word at least, occurrences at least, and how many times a word's n its form's n is.
LENGTH, OCCURRENCES, RATIO = 7, 2, 10
#: One run in so many loses a code point.
SLIPS = 31
#: Different words that a task holds before it passes on their counts.
HELD = 400_000
_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def slipped(doc_id, run: str, slips: int = SLIPS) -> str:
    """The run (lower-cased already) without the code point that its crc32 names, if it names one."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % slips:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, length: int = LENGTH, occurrences: int = OCCURRENCES, slips: int = SLIPS) -> DataFrame:
    """(word, n) of the words of all whole texts with ``length`` code points and ``occurrences`` at least."""

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                # bytes.lower() changes A-Z only
                for run, n in Counter(_RUN.findall(text.encode().lower().decode()) if text else ()).items():
                    if len(run) >= length:
                        word = slipped(doc_id, run, slips)
                        if len(word) >= length:
                            held[word] += n
                if len(held) >= HELD:
                    yield _counts(held)
                    held = Counter()
        yield _counts(held)

    counts = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def _counts(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    if n < 64:
        return next(i for i in range(n) if a[i] != b[i])
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


def _blocks(batches):
    """(block, word) of rows that lie in order; one code point is one byte."""
    for batch in batches:
        for block, word in zip(batch.column("block").to_pylist(), batch.column("word").to_pylist(), strict=True):
            yield block, word.encode("latin-1")


def _next_nodes(nodes: list[int], shared: int, at: int, length: int) -> list[int]:
    """Nodes by depth of the word at place ``at``, which shares its first characters with the one before."""
    return nodes[:shared + 1] + list(range(at + shared + 1, at + length + 1))


def _ends(batches):
    """Of each block: its first and last word, its size, and the nodes of the last word, counted from the
    block's begin."""
    block = None
    out = []
    for b, word in _blocks(batches):
        if b != block:
            if block is not None:
                out.append((block, first, last, at + len(last) + 1, nodes))
            block, first, at, nodes = b, word, 0, list(range(len(word) + 1))
        else:
            at += len(last) + 1
            nodes = _next_nodes(nodes, _common(last, word), at, len(word))
        last = word
    if block is not None:
        out.append((block, first, last, at + len(last) + 1, nodes))
    types = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["block", "first", "last", "size", "nodes"])


def _borders(ends) -> dict[int, tuple]:
    """Of each block: where it begins, the word before it and that word's nodes, and the word after it."""
    out, at, before, nodes = {}, 0, None, []
    ends = sorted(ends, key=lambda r: r.block)
    for r, after in zip(ends, [*ends, None][1:], strict=True):
        first, last = bytes(r.first), bytes(r.last)
        out[r.block] = (at, before, nodes, bytes(after.first) if after else None)
        shared = _common(before, first) if before is not None else -1
        head = _next_nodes(nodes, shared, at, len(first))
        inherited = _common(first, last)
        nodes = head[:inherited + 1] + [at + x for x in r.nodes[inherited + 1:]]
        before, at = last, at + r.size
    return out


def numbered(words: DataFrame) -> DataFrame:
    """(word, place, nodes) of distinct ``word``s: the place in the sorted vocabulary laid end to end, and
    the numbers of the trie nodes on the word's way, from the root as far as another word shares them."""
    rows = words.select("word").repartitionByRange("word").sortWithinPartitions("word").withColumn("block", F.spark_partition_id())
    rows = stored(rows, "sorted").repartition("block").sortWithinPartitions("block", "word")
    borders = _borders(rows.mapInArrow(_ends, "block int, first binary, last binary, size long, nodes array<long>").collect())

    def number(batches):
        def ahead():
            """Each word with the one after it, which may be the first of the next block."""
            was = None
            for b, word in _blocks(batches):
                if was is not None:
                    yield *was, word if was[0] == b else borders[was[0]][3]
                was = b, word
            if was is not None:
                yield *was, borders[was[0]][3]

        out, held, block = ([], [], []), 0, None
        for b, word, after in ahead():
            if b != block:
                block = b
                at, last, nodes, _ = borders[b]
            shared = _common(last, word) if last is not None else -1
            nodes = _next_nodes(nodes, shared, at, len(word))
            keep = max(shared, _common(word, after) if after is not None else 0, 0)
            for column, value in zip(out, (word.decode("latin-1"), at, nodes[:keep + 1]), strict=True):
                column.append(value)
            held += keep + 1
            at, last = at + len(word) + 1, word
            if held > 1 << 20:
                yield _numbers(out)
                out, held = ([], [], []), 0
        yield _numbers(out)

    return rows.mapInArrow(number, "word string, place long, nodes array<long>")


def _numbers(out) -> pa.RecordBatch:
    types = pa.string(), pa.int64(), pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["word", "place", "nodes"])


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, place, n_near, best) of distinct words (word, n): how many words differ by exactly one
    inserted, deleted or replaced code point, and of those the struct (n, place) of the most frequent.
    Places are in code-point order."""
    ahead = numbered(words)
    back = numbered(words.select(F.reverse("word").alias("word"))).select(F.reverse("word").alias("word"), F.col("nodes").alias("back"))
    tries = stored(words.select("word", "n").join(ahead, "word").join(back, "word"), "tries")
    size, known, known_back = F.length("word"), F.size("nodes") - 1, F.size("back") - 1

    def pairs(first, last, node_back, kind):
        return F.when(first <= last, F.transform(F.sequence(first, last), lambda i: F.struct(
            F.get("nodes", i).alias("p"), F.get("back", node_back(i)).alias("s"), kind(i).alias("kind")))).otherwise(F.array())

    # 0: leaves out a letter that repeats the one before, 1: any other, 2: takes one in
    begins = lambda i: F.when((i > 0) & (F.get("letters", i) == F.get("letters", i - 1)), 0).otherwise(1)
    out = pairs(F.greatest(F.lit(0), size - 1 - known_back), F.least(known, size - 1), lambda i: size - 1 - i, begins)
    into = pairs(F.greatest(F.lit(0), size - known_back), F.least(known, size), lambda i: size - i, lambda i: F.lit(2))
    keys = (tries.withColumn("letters", F.split("word", "")).select("place", "n", F.explode(F.concat(out, into)).alias("k"))
            .select("k.*", "place", "n"))
    met = keys.groupBy("p", "s").agg(F.collect_list(F.struct("kind", "place", "n")).alias("m")).where(F.size("m") > 1)

    def near(x):
        # a word that leaves a letter out meets all that do, and one that takes one in
        return F.filter("m", lambda y: (x["place"] != y["place"]) & F.when(x["kind"] == 2, y["kind"] == 1).when(x["kind"] == 1, F.lit(True)).otherwise(y["kind"] < 2))

    sums = F.transform("m", lambda x: F.struct(x["place"].alias("place"), F.size(near(x)).alias("n_near"), F.array_max(
        F.transform(near(x), lambda y: F.struct(y["n"].alias("n"), (-y["place"]).alias("minus")))).alias("best")))
    found = met.select(F.explode(sums).alias("x")).select("x.*").where("n_near > 0")
    found = found.groupBy("place").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))
    best = F.when(F.col("best").isNotNull(), F.struct(F.col("best.n").alias("n"), (-F.col("best.minus")).alias("place")))
    return tries.select("word", "n", "place").join(found, "place", "left").select(
        "word", "n", "place", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), best.alias("best"))


def roots(links: DataFrame, steps: int) -> DataFrame:
    """(place, root) of links (place, to): where the links from a place end, at most ``2 ** steps`` on."""
    at = links.select("place", F.col("to").alias("root"))
    for _ in range(steps):
        at = stored(at, "roots")
        on = at.select(F.col("place").alias("root"), F.col("root").alias("further"))
        at = at.join(on, "root", "left").select("place", F.coalesce("further", "root").alias("root"))
    return at


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words (word, n).  A form is the most frequent near
    word, if its n is ``ratio`` times the word's; the root is where the forms of forms end."""
    if ratio < 2:
        raise ValueError("ratio must be 2 at least: forms of forms have to end")
    rows = stored(neighbours(words), "near")
    has = F.col("best.n") >= F.lit(ratio) * F.col("n")
    links = stored(rows.where(has).select("place", F.col("best.place").alias("to"), F.col("best.n").alias("form_n")), "forms")
    # each form is so many times as frequent, so a chain of forms has fewer links than n has digits
    steps = 5 if ratio >= 4 else 6
    ends = links.join(roots(links, steps), "place")
    named = rows.select("place", "word")
    ends = (ends.join(named.select(F.col("place").alias("to"), F.col("word").alias("form")), "to")
            .join(named.select(F.col("place").alias("root"), F.col("word").alias("root_word")), "root").select("place", "form", "root_word", "form_n"))
    return rows.join(ends, "place", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(stored(vocabulary(table(spark, sf_dir, "documents", "doc_id", "text")), "words"))
