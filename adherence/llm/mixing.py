"""Mixing sources to target weights.

Tokens are summed per source, each source's target follows from the weights, the target over the
source's size is its repetition rate, and a document is emitted ``floor(rate)`` times plus once more
with a probability of the rate's fraction, by a coin that a hash of seed and document tosses.

Defined cases: a null text has size 0; a null source is a source of its own, the last one; a source
without words is taken 0 times; rows with equal doc_id have the same coin, rows without doc_id toss by
their text; an empty table gives an empty result; other columns, of any name, are not looked at
(``mixed`` keeps them).  All in DataFrame functions: the per-source frame has one row for each source,
and meets the documents by source and salt, so that a source with a third of all rows is dealt over
``SALTS`` tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adherence.llm.base import table

SALTS = 64
WORD = r"[^\x20\x09-\x0D]+"
SEED = 7


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in order of code points, null last, weigh ``weights`` in turn.  They share the sum of all
    sizes by weight, none gets over ``most`` times its own size, and what is over is shared anew.  In
    closed form: sources fill up in order of size over weight, so a source is full when the share it
    would get with all sources before it full reaches its limit.  The windows run over one row a source."""
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int")).cast("long"))
    limit = F.col("source_size") * most
    unit = 1
    for x in weights:
        unit *= x
    per = per.withColumn("fills", F.expr(f"source_size * {unit} div w"))
    before = Window.orderBy("fills", "w", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    per = (per.withColumn("left_size", F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
           .withColumn("left_w", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
           .withColumn("full", limit * F.col("left_w") <= F.col("w") * F.col("left_size")))
    # the sources that aren't full share what the full ones leave
    per = (per.withColumn("free_size", F.sum("source_size").over(everything) - F.coalesce(F.sum(F.when(F.col("full"), limit)).over(everything), F.lit(0)))
           .withColumn("free_w", F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))).over(everything), F.lit(0))))
    return per.select("source", "source_size", F.when(F.col("full"), limit.cast("double"))
                      .otherwise((F.col("w") * F.col("free_size")).cast("double") / F.col("free_w")).alias("target"))


def _coin(seed: int) -> Column:
    """Uniform in [0, 1), from the first 52 bits of a digest of seed and document."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def decided(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for every document."""
    sizes = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), _coin(seed).alias("coin"))
    per = targets(sizes.select("source", "size"), weights, most).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = sizes.withColumn("salt", F.floor(F.col("coin") * SALTS).cast("int"))
    per = per.withColumnRenamed("source", "of")
    both = left.join(per, left["source"].eqNullSafe(per["of"]) & (left["salt"] == per["salt"]))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    return both.select("doc_id", "source", "size", "source_size", "target",
                       (whole + (F.col("coin") < rate - whole).cast("long")).alias("copies"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all columns, each as often as it is taken.  Adds
    ``copy_no`` (from 1), or ``copy_no_`` with as many underscores as make it new."""
    name = "copy_no"
    while name.lower() in [c.lower() for c in docs.columns]:
        name += "_"
    per = targets(docs.select("source", n_words(F.col("text")).alias("size")), weights, most)
    per = per.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    per = per.select(F.struct("source", "salt").alias("key"), rate.alias("rate"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), _coin(seed).alias("coin"), "source")
    row = row.select("doc", "coin", F.struct("source", F.floor(F.col("coin") * SALTS).cast("int").alias("salt")).alias("key"))
    both = row.join(per, (row["key"]["source"].eqNullSafe(per["key"]["source"])) & (row["key"]["salt"] == per["key"]["salt"]))
    whole = F.floor("rate")
    copies = (whole + (F.col("coin") < F.col("rate") - whole).cast("long")).cast("int")
    return (both.withColumn("copies", copies).where("copies > 0")
            .select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("n")).select("doc.*", F.col("n").alias(name)))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decided(table(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return d.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS coin
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::BIGINT AS w
  FROM d GROUP BY source
), r AS (  -- shared by weight, round after round, until no more sources are over their limit
  SELECT 0 AS n, source, source_size, w, false AS was_full, w * 0 = 1 AS is_full,
         (SELECT sum(source_size) FROM s)::BIGINT AS free_size, (SELECT sum(w) FROM s)::BIGINT AS free_w FROM s
  UNION ALL
  SELECT n + 1, source, source_size, w, is_full, f,
         ((sum(source_size) OVER ()) - coalesce(sum(CASE WHEN f THEN 3 * source_size END) OVER (), 0))::BIGINT,
         coalesce(sum(CASE WHEN NOT f THEN w END) OVER (), 0)::BIGINT
  FROM (SELECT *, is_full OR 3 * source_size * free_w <= w * free_size AS f FROM r)
  WHERE n < (SELECT count(*) FROM s) + 1
), t AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN (3 * source_size)::DOUBLE ELSE (w * free_size)::DOUBLE / free_w END AS target
  FROM r WHERE n = (SELECT max(n) FROM r)
)
SELECT doc_id, size, t.source_size, target,
       ((floor(rate) + (coin < rate - floor(rate))::INT) * size)::BIGINT AS taken
FROM (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source) t
"""
