"""The pipeline's stages against plain models of each stage's own input."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from promptmill.llm import quality

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF_DIR).cache())
    assert all(f.columns == docs.columns for f in frames[:-1])
    good, one, clean, masked, packed = frames[1:]
    ids = [[r.doc_id for r in f.select("doc_id").collect()] for f in frames[:-1]]
    assert all(len(set(own)) == len(own) and set(own) <= set(before) for before, own in zip(ids, ids[1:]))
    model = quality.learn(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert set(ids[1]) == {r.doc_id for r in quality.classified(docs, model).collect() if r.predicted == 1}
    assert one.select("text").distinct().count() == one.count()
    assert set(ids[4]) == set(ids[3])
    assert masked.filter(F.col("text").rlike("AKIA[A-Z0-9]{16}|[0-9a-f]{24}")).count() == 0
    assert masked.filter("n_chars <> length(text)").count() == 0
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(ids[4])
    ran = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, ran.select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(
        map(tuple, packed.select("doc_id", "piece", "length", "ids_crc32").collect())
    )
