"""The corpus pipeline: documents that a language model may be trained on.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir), works on all that the stage
before it kept and returns a DataFrame.  All but the last return the columns of ``documents``; the last
adds ``copy_no``.  Between stages rows are written as Parquet in the shared folder and read again, so a
lost executor never sends a later stage back to an earlier one.

Rows without doc_id, null and empty texts, repeated rows and extra columns pass through as the operators
of each stage define; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adherence.llm import decontaminate, line_dedup, mixing, near_dup, quality
from adherence.llm.base import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores below its threshold go."""
    chain = quality.learned(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.good(docs, chain)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier in the corpus, up to one edit, go; and documents that consist of them."""
    return line_dedup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, a similarity of 0.8) stays."""
    return near_dup.representatives(docs, k=5, percent=80)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it."""
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", repeated_lines),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_overlap),
    ("mixing", mix),
]

#: The first stage is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
