"""From raw documents to packed training sequences, stage by stage over whole tables.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read again as the next
stage's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm import decontamination, jaccard, packing, quality, secrets
from promptmill.llm.queries import table, word_tokenizer
from promptmill.session import shared_dir

#: No SQL: the first stage is a fitted model and the last a search; tests hold the stages against plain models.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.classified(docs, model).filter("predicted = 1").select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return jaccard.one_of_each(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which no benchmark passage makes up a twentieth or more."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark and ``n_chars`` to match."""
    masked = secrets.with_secrets(docs).withColumn("_masked", secrets.masked(F.col("text"), F.col("secrets")))
    changed = {"text": F.col("_masked"), "n_chars": F.when(F.size("secrets") > 0, F.length("_masked").cast("bigint")).otherwise(F.col("n_chars"))}
    return masked.select(*(changed.get(c, F.col(c)).alias(c) for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their sequence and place in it."""
    return packing.pack(packing.token_pieces(docs, word_tokenizer()))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", keep_clean),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
