"""The corpus pipeline, stage by stage, on given documents with odd rows added."""

from __future__ import annotations

import shutil

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from adherence.llm.base import components, table


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    for t in ("labels", "benchmark"):
        shutil.copy(f"{sf_dir}/{t}.parquet", d / f"{t}.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    good = [r["text"] for r in docs.where("lang = 'en'").join(labels, "doc_id").where("n_chars between 300 and 2000").orderBy("doc_id").limit(3).collect()]
    one, two, three = (". ".join(s.strip()[::-1].capitalize() for s in t.split(".")) + "." for t in good)  # as clean, in other words
    odd = spark.createDataFrame(
        [(None, one, "en", "src0", 1), (90001, None, "en", None, 0), (90002, "", None, "src1", 0), (90003, f"{two}\n{item}\n{two[::-1].capitalize()}.", "en", "src0", 9),
         (90004, three, "en", "src0", 9), (90004, three, "en", "src0", 9)], docs.schema)
    docs.unionByName(odd).withColumn("pos", F.lit("extra")).write.parquet(str(d / "documents.parquet"))
    return str(d)


def test_stages(spark, folder, tmp_path):
    docs = table(spark, folder, "documents")
    columns, n = docs.columns, docs.count()
    for i, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if name != "mixing":
            assert docs.columns == columns and 0 < docs.count() <= n
            n = docs.count()
            assert docs.where("doc_id is null").count() == 1
        if name == "near duplicates":
            assert docs.where("doc_id = 90004").count() == 1
        if name == "benchmark decontamination":
            assert docs.where("doc_id = 90003").count() == 0
    assert docs.columns == [*columns, "copy_no"]
    again = P.run(spark, folder)
    assert sorted(r["doc_id"] or 0 for r in again.select("doc_id").collect()) == sorted(r["doc_id"] or 0 for r in docs.select("doc_id").collect())


def test_empty_table(spark, folder):
    docs = table(spark, folder, "documents").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (7, 7)] + [(200, 201 + i) for i in range(30)]
    got = {r["id"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 103: 100, **dict.fromkeys(range(200, 231), 200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
