"""One curation run: pull, filter, remove near-duplicates, cap, store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.config import CurationConfig
from promptmill.functions.text import sample_text
from promptmill.operators.dedup import (
    distinct_prints,
    kept_rows,
    near_dedup,
    order_key,
    rows_with_keys,
    surviving_keys,
)
from promptmill.operators.filters import filter_logs, redact_logs
from promptmill.operators.ranks import first_rows, numbered
from promptmill.session import materialise
from promptmill.sources.datasets import read_headers, write_dataset
from promptmill.sources.logs import append_ledger, read_unconsumed

LOG_ORDER = ["timestamp", "log_id"]


def dedup_logs(kept: DataFrame, threshold: float, order_by: list[str] | None = None) -> DataFrame:
    text = sample_text(F.col("prompt"), F.col("response"))
    return near_dedup(kept, text=text, order_by=order_by or LOG_ORDER, threshold=threshold, verify=False)


def curate(
    pulled: DataFrame, cfg: CurationConfig = CurationConfig(), order_by: list[str] | None = None
) -> DataFrame:
    """The curated samples of the pulled logs; duplicates are judged on redacted text.

    The second reading of the texts only redacts the survivors; it does not score again.
    """
    order_by = order_by or LOG_ORDER
    keys = surviving_keys(
        filter_logs(pulled, cfg),
        text=sample_text(F.col("prompt"), F.col("response")),
        order_by=order_by,
        threshold=cfg.dedup_threshold,
        verify=cfg.verify_duplicates,
    )
    samples = redact_logs(rows_with_keys(pulled, keys, order_by), cfg)
    if cfg.max_samples:
        samples = first_rows(samples, order_by, cfg.max_samples)
    return samples


def curation_counts(
    pulled: DataFrame, cfg: CurationConfig = CurationConfig(), order_by: list[str] | None = None
) -> DataFrame:
    """The summary of a curation, from the keys alone: texts are filtered and signed once and not read again."""
    order_by = order_by or LOG_ORDER
    kept = filter_logs(pulled, cfg)
    text = sample_text(F.col("prompt"), F.col("response"))
    rule = {"threshold": cfg.dedup_threshold, "verify": cfg.verify_duplicates}
    distinct = distinct_prints(kept, text=text, order_by=order_by, **rule)
    return curation_summary(pulled, distinct, kept_rows(distinct, kept, text, order_by, **rule))


def curation_summary(pulled: DataFrame, kept: DataFrame, deduped: DataFrame) -> DataFrame:
    """Counts after each step. A pull without rows is skipped with a reason.

    ``kept`` may be the prints of distinct texts, which know how many ``copies`` they stand for.
    """
    steps = [("logs_pulled", pulled), ("samples_after_filter", kept), ("samples_after_dedup", deduped)]
    rows = {name: F.coalesce(F.sum("copies"), F.lit(0)) if "copies" in df.columns else F.count("*") for name, df in steps}
    counted = [df.agg(rows[name].alias("n")).select(F.lit(name).alias("step"), "n") for name, df in steps]
    stacked = counted[0].unionByName(counted[1]).unionByName(counted[2])

    def of(step: str) -> Column:
        return F.max(F.when(F.col("step") == step, F.col("n")))

    empty = F.col("logs_pulled") == 0
    return stacked.agg(*(of(name).alias(name) for name, _ in steps)).select(
        F.when(empty, "skipped").otherwise("completed").alias("status"),
        F.when(empty, "no_logs_available").alias("reason"),
        *(name for name, _ in steps),
    )


def run_curation(
    spark: SparkSession,
    logs: DataFrame,
    ledger: DataFrame,
    *,
    run_id: str,
    dataset_id: str,
    datasets_path: str,
    ledger_path: str,
    cfg: CurationConfig = CurationConfig(),
    limit: int | None = None,
) -> dict:
    """Curate everything unconsumed into ``dataset_id`` and return the stage result.

    The ledger is appended after the dataset is stored, so a run that fails in between loses
    nothing: its logs are still unconsumed. A run whose own ledger rows are there has stored its dataset:
    repeating it changes nothing and counts the same logs again.
    """
    own = F.col("run_id") == run_id
    spark = logs.sparkSession
    header = read_headers(spark, datasets_path).filter(own & (F.col("dataset_id") == dataset_id)).first()
    if header is not None and not ledger.filter(own).isEmpty():
        consumed = logs.join(ledger.filter(own).select("log_id"), "log_id", "left_semi")
        return {
            "status": "completed",
            "reason": None,
            "logs_pulled": consumed.count(),
            "samples_after_filter": filter_logs(consumed, cfg).count(),
            "samples_after_dedup": header["sample_count"],
            "dataset_id": dataset_id,
        }
    # Only keys are kept: which logs this run takes, what survives, and the place of each sample.
    taken = materialise(read_unconsumed(logs, ledger.filter(~own), limit).select(order_key(LOG_ORDER).alias("ord")))
    pulled_count = taken.count()
    if not pulled_count:
        return {
            "status": "skipped",
            "reason": "no_logs_available",
            "logs_pulled": 0,
            "samples_after_filter": 0,
            "samples_after_dedup": 0,
            "dataset_id": None,
        }
    pulled = rows_with_keys(logs, taken, LOG_ORDER)
    kept = filter_logs(pulled, cfg)
    text = sample_text(F.col("prompt"), F.col("response"))
    rule = {"threshold": cfg.dedup_threshold, "verify": cfg.verify_duplicates}
    distinct = distinct_prints(kept, text=text, order_by=LOG_ORDER, **rule)
    survivors = kept_rows(distinct, kept, text, LOG_ORDER, **rule)
    places = numbered(survivors, ["ord"], "seq")
    if cfg.max_samples:
        places = places.filter(F.col("seq") <= cfg.max_samples)
    keyed = logs.withColumn("ord", order_key(LOG_ORDER)).join(places, "ord").drop("ord")
    stored = write_dataset(redact_logs(keyed, cfg), dataset_id, run_id, datasets_path)
    append_ledger(taken.select("ord.log_id"), run_id, ledger_path)
    return {
        "status": "completed",
        "reason": None,
        "logs_pulled": pulled_count,
        "samples_after_filter": distinct.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0],
        "samples_after_dedup": stored,
        "dataset_id": dataset_id,
    }
