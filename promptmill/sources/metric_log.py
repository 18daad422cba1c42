"""Evaluation metrics as a long table, one row per metric."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.functions.stamps import iso_stamp
from promptmill.functions.text import id_prefix

# The metric names of an evaluation and of a promotion.
EVALUATION_KEYS = (
    "accuracy", "mean_score", "latency_p50_ms", "latency_p95_ms", "latency_p99_ms",
    "cost_per_1k_tokens_usd", "total_cost_usd", "sample_count",
)
SCORE_KEYS = ("score_1", "score_2", "score_3", "score_4", "score_5")
PROMOTION_KEYS = ("accuracy", "latency_p95_ms", "cost_per_1k_tokens")


def _long(df: DataFrame, run_name, tags: dict, values: list) -> DataFrame:
    tag_map = F.create_map(
        *(part for name, value in tags.items() for part in (F.lit(name), value.cast("string")))
    )
    entries = F.array(*(F.struct(F.lit(k).alias("key"), v.cast("double").alias("value")) for k, v in values))
    return (
        df.select(run_name.alias("run_name"), tag_map.alias("tags"), F.explode(entries).alias("m"))
        .select("run_name", "tags", "m.*")
        .filter(F.col("value").isNotNull())
    )


def to_metric_log(evaluations: DataFrame) -> DataFrame:
    name = F.concat_ws("_", "model_name", id_prefix(F.col("experiment_id")))
    tags = {c: F.col(c) for c in ("experiment_id", "model_id", "model_name", "run_id")}
    if "evaluated_at" in evaluations.columns:
        tags["evaluated_at"] = iso_stamp(F.col("evaluated_at"))
    values = [(key, F.col(key)) for key in EVALUATION_KEYS]
    values += [
        (key, F.col("score_distribution")[i]) for i, key in enumerate(SCORE_KEYS, start=1)
    ]
    return _long(evaluations, name, tags, values)


def promotions_to_metric_log(promoted: DataFrame) -> DataFrame:
    """Log rows for candidates that were promoted."""
    tags = {c: F.col(c) for c in ("run_id", "model_id", "model_name", "experiment_type")}
    tags |= {"event": F.lit("promotion"), "status": F.lit("production")}
    name = F.concat(F.lit("promotion-"), F.col("model_id"))
    return _long(promoted, name, tags, [(key, F.col(key)) for key in PROMOTION_KEYS])


def read_metric_log(log: DataFrame, keys=EVALUATION_KEYS + SCORE_KEYS, tags=("model_name", "experiment_id")) -> DataFrame:
    """Wide again: one row per run name and experiment, one column per metric and chosen tag."""
    tagged = log.select(
        "run_name", "key", "value", *(F.col("tags")[t].alias(f"tag_{t}") for t in tags)
    )
    return (
        tagged.groupBy("run_name", *(f"tag_{t}" for t in tags))
        .pivot("key", list(keys))
        .agg(F.max("value"))
    )
