"""Inference logs and the ledger of those already consumed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill import schemas
from promptmill.operators.ranks import first_rows
from promptmill.session import spread
from promptmill.sources.state import read_or_empty


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return spread(spark.read.schema(schemas.INFERENCE_LOGS).parquet(path))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, schemas.LEDGER)


def read_unconsumed(logs: DataFrame, ledger: DataFrame, limit: int | None = None) -> DataFrame:
    """Logs no run has consumed, pruned to the log columns.

    ``limit`` takes the oldest rows. The input order of a run is (timestamp, log_id).
    """
    fresh = logs.select(
        "log_id", "prompt", "response", "model", "latency_ms", "timestamp", "session_id"
    ).join(ledger.select("log_id"), "log_id", "left_anti")
    if limit is None:
        return fresh
    return first_rows(fresh, ["timestamp", "log_id"], limit)


def count_unconsumed(logs: DataFrame, ledger: DataFrame) -> DataFrame:
    return (
        logs.select("log_id")
        .join(ledger.select("log_id"), "log_id", "left_anti")
        .agg(F.count("*").alias("new_logs"))
    )


def ledger_rows(pulled: DataFrame, run_id: str, now: Column) -> DataFrame:
    """Every pulled row counts as consumed, also those a filter dropped later."""
    return pulled.select("log_id", F.lit(run_id).alias("run_id"), now.alias("consumed_at"))


def append_ledger(pulled: DataFrame, run_id: str, path: str) -> None:
    """Record consumption. A repeated attempt of the same run replaces its own entries."""
    (
        ledger_rows(pulled, run_id, F.current_timestamp())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )
