"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct word shingles.  Equal sets are collapsed first.  ``TREES``
independent trees branch the sets: in each tree a set goes to the node named by its minwise shingle, so
two sets of similarity s share a node of a tree with probability s.  Nodes are looked at one kind after the
other, and what is in one component by then is not looked at again:

1. every set is tried with the least one of the best of its nodes, by their full sets;
2. nodes of up to ``SMALL`` members are compared exhaustively, in one task and by full sets, first those
   of one tree, which link most of a cluster, then those of the others;
3. the members of larger nodes branch again, by ``AGAIN`` further minwise shingles each, and the nodes
   of up to ``SMALL`` members are compared exhaustively;
4. what then still lies in larger nodes shares a template.  Those sets branch all together by their
   rarest shingles, until only sets meet that may be linked (``prefix_join``).  That step is exact for any
   two of them, however many there are and whatever they share.

Linked sets are one component, so a step gives a spanning set of links and no pairs.  There is no cap on
members or partners.  A pair of similarity s is missed by all trees with a probability of
``(1 - s)^TREES`` (6e-9 at 0.85) where nodes are small, and ``(1 - s (1 - (1 - s)^AGAIN))^TREES`` (7e-9) where
they branch again.  In steps 2 and 3 pairs whose minwise shingles agree in too few of the
``PLACES`` places are passed over (4.4 standard deviations below the mean at the threshold, 1 in 100 000);
every other pair is confirmed on the two full sets.

Defined cases: null and empty texts have an empty set, linked with nothing; fewer words than a shingle
has make one shingle; rows without doc_id take no part (component null, kept); texts that share a doc_id are
one document, whose links are those of any of its texts; extra columns are not looked at; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.llm import prefix_join
from adherence.llm.base import BROADCAST_IDS, components, only_ids, stored, table
from adherence.llm.words import U, Words, mix, shingle_sets, slices

TREES = 10
#: Members of a node that are compared exhaustively; nodes with more branch by their rarest shingles.
SMALL = 2048
#: Branches of a member of a larger node.
AGAIN = 3
#: Minwise shingles of a set: one for each tree, and then ``AGAIN`` for each.
PLACES = _PLACES = TREES * (1 + AGAIN)
_SCALE = mix(np.arange(1, _PLACES + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
_SHIFT = mix(np.arange(1, _PLACES + 1, dtype=U) * U(0xC2B2AE3D27D4EB4F))


def _least_agreeing(percent: int) -> int:
    """Agreeing minwise values of a candidate at least: 4.4 standard deviations below their mean at the threshold."""
    s = percent / 100
    return max(1, int(_PLACES * s - 4.4 * (_PLACES * s * (1 - s)) ** 0.5))


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, sig) of every document with a doc_id: the set's size, a 128-bit key
    of it, and the ``TREES * LEVELS`` minwise values (none for an empty set)."""

    def sign(batches):
        for batch in batches:
            for a, b in slices(batch.column("text")):
                part = batch.slice(a, b - a)
                sets = shingle_sets(Words(part.column("text")), k)
                sizes = np.array([len(s) for s in sets], np.int64)
                flat = np.concatenate(sets) if sizes.sum() else np.zeros(0, U)
                full = np.flatnonzero(sizes)
                at = (np.cumsum(sizes) - sizes)[full]
                keys = np.zeros((2, len(sizes)), np.int64)
                least = np.zeros((_PLACES, len(full)), np.int64)
                if len(full):
                    keys[0, full] = np.add.reduceat(mix(flat + U(1)), at).view(np.int64)
                    keys[1, full] = np.add.reduceat(mix(flat ^ U(0x5851F42D4C957F2D)), at).view(np.int64)
                    for p in range(_PLACES):
                        least[p] = np.minimum.reduceat(flat * _SCALE[p] + _SHIFT[p], at).view(np.int64)
                lists = np.concatenate([[0], np.cumsum(np.where(sizes > 0, _PLACES, 0))]).astype(np.int32)
                sig = pa.ListArray.from_arrays(pa.array(lists), pa.array(np.ascontiguousarray(least.T).reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), pa.array(keys[0]), pa.array(keys[1]), sig], ["doc_id", "n_shingles", "s1", "s2", "sig"])

    schema = "doc_id long, n_shingles long, s1 long, s2 long, sig array<long>"
    return docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(sign, schema)


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of some documents, from one pass over all."""
    return stored(only_ids(docs.select(F.col("doc_id").alias("id"), "text").where("id is not null"), ids), "texts")


def confirmed(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full shingle sets have ``100 * both >= percent * either``.
    Only texts that are in a pair move, once by each end."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ends")
    texts = _texts_of(docs, ids)
    both = (pairs.select("a", "b").join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b"))

    def verify(batches):
        for batch in batches:
            for x, y in slices(batch.column("ta")):
                part = batch.slice(x, y - x)
                left = shingle_sets(Words(part.column("ta")), k)
                right = shingle_sets(Words(part.column("tb")), k)
                hit = []
                for s, t in zip(left, right, strict=True):
                    n = len(np.intersect1d(s, t, assume_unique=True))
                    hit.append(n > 0 and 100 * n >= percent * (len(s) + len(t) - n))
                yield part.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(verify, "a long, b long").distinct()


def _places(col) -> np.ndarray:
    """The low bytes of the minwise values, a row each."""
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, _PLACES)


def _by_node(found):
    """A function of Arrow batches whose nodes (tree, node) lie in a row: ``found`` gets one table of whole
    nodes after the other; the node that a batch ends in is taken along to the next one."""

    def run(batches):
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            if not t.num_rows:
                continue
            key = np.stack([t.column("tree").to_numpy(), t.column("node").to_numpy()])
            other = np.flatnonzero((key != key[:, -1:]).any(axis=0))
            end = int(other[-1]) + 1 if len(other) else 0
            rest = t.slice(end).combine_chunks()
            if end:
                yield from found(t.slice(0, end).combine_chunks())
        if rest is not None:
            yield from found(rest)

    return run


def _involved(rows: DataFrame, agree: int) -> DataFrame:
    """Of members (tree, node, id, comp, sig8) of small nodes, those that agree enough with a member of
    another component."""

    def found(t):
        tree, node, comp = (t.column(c).to_numpy() for c in ("tree", "node", "comp"))
        sig, at = _places(t.column("sig8")), np.arange(t.num_rows)
        hit = np.zeros(t.num_rows, bool)
        for d in range(1, SMALL):
            at = at[at + d < t.num_rows]
            at = at[(node[at] == node[at + d]) & (tree[at] == tree[at + d])]
            if not len(at):
                break
            near = at[comp[at] != comp[at + d]]
            near = near[(sig[near] == sig[near + d]).sum(axis=1) >= agree]
            hit[near] = hit[near + d] = True
        for batch in t.select(["tree", "node", "id", "comp"]).filter(pa.array(hit)).to_batches():
            yield batch

    rows = rows.select("tree", "node", "id", "comp", "sig8").repartition("tree", "node").sortWithinPartitions("tree", "node")
    return rows.mapInArrow(_by_node(found), "tree int, node long, id long, comp long")


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sorted sets, as products of their 0-1 rows over the elements that two
    of them have, some thousand elements at a time."""
    n = len(sets)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    codes, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    keep = count[codes] > 1
    rows, codes = rows[keep], codes[keep]
    order = np.argsort(codes, kind="stable")
    rows, codes = rows[order], np.unique(codes[order], return_inverse=True)[1]
    out = np.zeros((n, n), np.float32)  # exact up to 2^24 elements
    step = 4096
    for a in range(0, int(codes[-1]) + 1 if len(codes) else 0, step):
        lo, hi = np.searchsorted(codes, [a, a + step])
        block = np.zeros((n, step), np.float32)
        block[rows[lo:hi], codes[lo:hi] - a] = 1
        out += block @ block.T
    return out


def _node_links(rows: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between components, a spanning set of them for each small node, from its members' full
    shingle sets, compared all with all."""

    def found(t):
        tree, node = t.column("tree").to_numpy(), t.column("node").to_numpy()
        begin = np.flatnonzero(np.concatenate([[True], (tree[1:] != tree[:-1]) | (node[1:] != node[:-1])]))
        for a, b in zip(begin, np.append(begin[1:], t.num_rows), strict=True):
            if b - a > 1:
                yield links(t.slice(a, b - a))

    def links(t):
        text, sets = t.column("text"), []
        text = text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text
        for x, y in slices(text):
            sets += shingle_sets(Words(text.slice(x, y - x)), k)
        ids, size = t.column("id").to_numpy(), np.array([len(s) for s in sets], np.int64)
        label = np.unique(t.column("comp").to_numpy(), return_inverse=True)[1]
        both = _shared_counts(sets).astype(np.int64)
        hit = (both > 0) & (100 * both >= percent * (size[:, None] + size[None] - both))
        out = []
        for i in range(len(ids)):
            near = np.flatnonzero(hit[i])
            for other in np.unique(label[near]):
                if other != label[i]:
                    j = near[label[near] == other][0]
                    out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                    label[label == other] = label[i]
        return pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in (0, 1)], ["a", "b"])

    both = rows.join(texts, "id").select("tree", "node", "id", "comp", "text").repartition("tree", "node").sortWithinPartitions("tree", "node", "id")
    return both.mapInArrow(_by_node(found), "a long, b long").distinct()


def _best_of_each(pairs: DataFrame) -> DataFrame:
    """Of pairs (a, b, n) those that are the best one of an end: a link a member, if there is one."""
    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("id"), "n")
    best = ends.groupBy("id").agg(F.max(F.struct("n", (-F.col("a")).alias("a"), (-F.col("b")).alias("b"))).alias("m"))
    return best.select((-F.col("m.a")).alias("a"), (-F.col("m.b")).alias("b")).distinct()


class _Found:
    """Links and components so far."""

    def __init__(self, docs: DataFrame, k: int, percent: int, none: DataFrame):
        self.docs, self.k, self.percent = docs, k, percent
        self.links = none
        self.comp = none.select(F.col("a").alias("id"), F.col("b").alias("comp"))

    def try_pairs(self, pairs: DataFrame) -> None:
        pairs = stored(pairs, "pairs")
        if pairs.limit(1).count():
            self._add(stored(confirmed(self.docs, pairs, self.k, self.percent), "links"))

    def try_nodes(self, members: DataFrame) -> None:
        members = stored(members, "members")
        ids = stored(members.select("id").distinct(), "ends")
        if ids.limit(1).count():
            self._add(stored(_node_links(members, _texts_of(self.docs, ids), self.k, self.percent), "links"))

    def try_sets(self, members: DataFrame) -> None:
        ids = stored(members.select("id").distinct(), "ends")
        if ids.limit(1).count():
            sets = stored(prefix_join.token_sets(only_ids(self.docs.select(F.col("doc_id").alias("id"), "text").where("id is not null"), ids), self.k), "sets")
            self._add(stored(prefix_join.links(sets, self.comp, self.percent), "links"))

    def _add(self, new: DataFrame) -> None:
        """Components grow by the new links alone: those between components, then a new name for each
        component that another one takes in."""
        if not new.limit(1).count():
            return
        self.links = self.links.unionByName(new)
        of = lambda c: self.comp.select(F.col("id").alias(c), F.col("comp").alias(f"c{c}"))
        between = (new.join(of("a"), "a", "left").join(of("b"), "b", "left")
                   .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
        named = components(between).select(F.col("id").alias("comp"), F.col("comp").alias("now"))
        few = named.limit(BROADCAST_IDS // 2 + 1).count() <= BROADCAST_IDS // 2
        ends = new.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(self.comp.select("id"), "id", "left_anti")
        known = self.comp.unionByName(ends.select("id", F.col("id").alias("comp")))
        self.comp = stored(known.join(F.broadcast(named) if few else named, "comp", "left").select("id", F.coalesce("now", "comp").alias("comp")), "comp")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, n_links) of every document: the least doc_id that can be
    reached over links, and whether it is the document itself.  ``n_links`` counts the confirmed links
    between different sets that the search looked at (a spanning set of the links, not all of them)."""
    signed = stored(signatures(docs, k), "signed")
    same = ["n_shingles", "s1", "s2"]
    sets = stored(signed.where("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("id")), "sets")
    low = F.concat(*[F.substring(F.to_binary(F.lpad(F.hex(F.col("sig")[i]), 16, "0"), F.lit("hex")), 8, 1) for i in range(_PLACES)])
    first = sets.select("id").join(signed.select(F.col("doc_id").alias("id"), "sig"), "id").groupBy("id").agg(F.min("sig").alias("sig"))
    reps = stored(first.withColumn("sig8", low), "reps")
    short = reps.select("id", "sig8")

    rows = reps.select("id", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = rows.withColumn("node", F.element_at("sig", F.col("tree") + 1))
    rows = stored(_shared(rows.select("tree", "node", "id")), "nodes")
    agree = _least_agreeing(percent)
    found = _Found(docs, k, percent, docs.sparkSession.createDataFrame([], "a long, b long"))

    found.try_pairs(_best_of_each(_candidates(_leader_pairs(rows), short, agree)))
    for trees in (F.col("tree") == 0, F.col("tree") > 0):
        own = stored(_open(rows.where(trees).where(F.col("n") <= SMALL).select("tree", "node", "id"), found.comp), "nodes")
        found.try_nodes(_involved(own.join(short, "id"), agree))
    large = _open(rows.where(F.col("n") > SMALL).select("tree", "node", "id"), found.comp).select("tree", "node", "id")
    again = large.join(reps.select("id", "sig"), "id").withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(AGAIN - 1))))
    place = F.lit(TREES + 1) + F.col("tree") * AGAIN + F.col("branch")
    again = again.withColumn("node", F.xxhash64("node", "branch", F.element_at("sig", place.cast("int"))))
    rows = stored(_shared(again.select("tree", "node", "id")), "nodes")
    own = stored(_open(rows.where(F.col("n") <= SMALL).select("tree", "node", "id"), found.comp), "nodes")
    found.try_nodes(_involved(own.join(short, "id"), agree))
    found.try_sets(_open(rows.where(F.col("n") > SMALL).select("tree", "node", "id"), found.comp))
    links, comp = found.links, found.comp

    degree = links.distinct().select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    known = (sets.join(comp, "id", "left").join(degree, "id", "left")
             .select(*[F.col(c).alias(f"of_{c}") for c in same], F.coalesce("comp", "id").alias("comp"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    on = [signed[c] == known[f"of_{c}"] for c in same]
    named = signed.join(known, on, "left").select(
        "doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    unnamed = docs.where("doc_id is null").select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return named.unionByName(unnamed).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "n_links")


def representatives(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all columns, of which one of each group of near duplicates stays: the one
    with the least doc_id.  Of rows with equal doc_id one stays, the least by text and then the other
    columns; rows without doc_id, and those without words, all stay."""
    judged = stored(near_duplicates(docs, k, percent).select("doc_id", "kept"), "judged")
    gone = stored(judged.where("not kept").select(F.col("doc_id").alias("id")).distinct(), "gone")
    few = gone.count() <= BROADCAST_IDS
    out = docs.join(F.broadcast(gone) if few else gone, docs["doc_id"] == gone["id"], "left_anti")
    again = stored(judged.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("n")).where("n > 1").select("id"), "again")
    if not again.limit(1).count():
        return out
    columns = [F.col(f"`{c}`") for c in docs.columns]
    several = out.join(again, out["doc_id"] == again["id"], "left_semi").groupBy("doc_id").agg(F.min(F.struct(F.col("text").alias("by"), F.struct(*columns).alias("row"))).alias("m"))
    return out.join(again, out["doc_id"] == again["id"], "left_anti").unionByName(several.select("m.row.*"))


def _shared(rows: DataFrame) -> DataFrame:
    """Rows of nodes with two members at least, with their number and least id."""
    n = rows.groupBy("tree", "node").agg(F.count("*").alias("n"), F.min("id").alias("leader")).where("n > 1")
    return rows.join(n, ["tree", "node"])


def _open(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows of nodes that have members of two components at least, with their components."""
    own = rows.select("tree", "node", "id").join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    n = own.groupBy("tree", "node").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return own.join(n.select("tree", "node"), ["tree", "node"])


def _leader_pairs(rows: DataFrame) -> DataFrame:
    return rows.where("leader <> id").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()


def _candidates(pairs: DataFrame, short: DataFrame, agree: int) -> DataFrame:
    """Pairs whose minwise values agree enough; n: in how many places."""

    def count(batches):
        for batch in batches:
            n = (_places(batch.column("x")) == _places(batch.column("y"))).sum(axis=1)
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(n, pa.int64())], ["a", "b", "n"])
            yield out.filter(pa.array(n >= agree))

    both = (pairs.join(short.select(F.col("id").alias("a"), F.col("sig8").alias("x")), "a")
            .join(short.select(F.col("id").alias("b"), F.col("sig8").alias("y")), "b"))
    return both.select("a", "b", "x", "y").mapInArrow(count, "a long, b long, n long")


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), k=3, percent=85).drop("n_links")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * c >= 85 * (na.n + nb.n - c)
), r AS (
  SELECT doc_id, doc_id AS comp FROM documents
  UNION
  SELECT l.b, r.comp FROM r JOIN l ON l.a = r.doc_id WHERE r.comp < l.b
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.comp AS component_id, d.doc_id = c.comp AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(comp) AS comp FROM r GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""
