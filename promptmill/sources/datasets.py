"""Curated datasets: one header row each and one row per sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill import schemas
from promptmill.functions.text import chat_json
from promptmill.operators.ranks import numbered
from promptmill.sources.state import read_or_empty

_SAMPLES = "seq BIGINT, " + schemas.INFERENCE_LOGS


def write_dataset(samples: DataFrame, dataset_id: str, run_id: str, path: str) -> int:
    """Store samples in input order under ``dataset_id`` and return their number.

    Samples that already have their place ``seq`` keep it; others are numbered by (timestamp, log_id), which sorts
    whole rows. The header is written last, so a dataset without header is one whose write did not finish;
    writing the same id again replaces it.
    """
    rows = samples if "seq" in samples.columns else numbered(samples, ["timestamp", "log_id"], "seq")
    rows.write.mode("overwrite").parquet(f"{path}/samples/dataset_id={dataset_id}")
    count = samples.sparkSession.read.parquet(f"{path}/samples/dataset_id={dataset_id}").count()
    header = samples.sparkSession.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("created_at"),
        F.lit(count).cast("bigint").alias("sample_count"),
    )
    header.write.mode("overwrite").parquet(f"{path}/headers/dataset_id={dataset_id}")
    return count


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/headers", schemas.DATASETS)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/samples", f"{_SAMPLES}, dataset_id STRING")


def read_dataset(spark: SparkSession, path: str, dataset_id: str) -> DataFrame:
    """The samples of one dataset; only its folder is scanned. An unknown id is an error."""
    wanted = F.col("dataset_id") == dataset_id
    if read_headers(spark, path).filter(wanted).isEmpty():
        raise ValueError(f"dataset {dataset_id} not found")
    return read_samples(spark, path).filter(wanted)


def export_chat_jsonl(samples: DataFrame, path: str) -> None:
    """One chat object per line, in files written in parallel."""
    samples.select(chat_json(F.col("prompt"), F.col("response")).alias("value")).write.mode(
        "overwrite"
    ).text(path)
