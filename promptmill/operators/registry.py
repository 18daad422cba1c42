"""The model registry as a table: each operation maps one snapshot to the next.

A model's key is the id of the experiment that produced it. Snapshots are written whole by
``sources.state``, so readers never see half a promotion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill import schemas

_METRIC_FIELDS = (
    "accuracy", "mean_score", "latency_p95_ms", "cost_per_1k_tokens", "total_cost_usd",
    "sample_count",
)


def candidate_entries(scored: DataFrame, now: Column) -> DataFrame:
    """Registry rows for scored experiments, all with status ``candidate``."""
    unset = F.lit(None).cast("timestamp")
    metrics = F.struct(*(F.col(name) for name in _METRIC_FIELDS)).cast(schemas.REGISTRY_METRICS)
    return scored.select(
        F.col("experiment_id").alias("model_id"),
        "model_name",
        F.lit("groq").alias("provider"),
        "run_id",
        "experiment_id",
        F.lit("candidate").alias("status"),
        metrics.alias("metrics"),
        now.alias("created_at"),
        now.alias("updated_at"),
        unset.alias("promoted_at"),
        unset.alias("archived_at"),
    )


def register(registry: DataFrame, scored: DataFrame, now: Column) -> DataFrame:
    """Upsert by id. Registering again resets status and times, a production row included."""
    entries = candidate_entries(scored, now)
    untouched = registry.join(entries.select("model_id"), "model_id", "left_anti")
    return untouched.unionByName(entries)


def promote(registry: DataFrame, model_id: str, now: Column, stamp: bool = True) -> DataFrame:
    """Archive whatever is in production and put ``model_id`` there, in one step.

    An unknown id is an error and changes nothing. ``stamp=False`` leaves the time columns alone.
    """
    if registry.filter(F.col("model_id") == model_id).isEmpty():
        raise ValueError(f"model {model_id} is not registered")
    chosen = F.col("model_id") == model_id
    replaced = (F.col("status") == "production") & ~chosen
    columns = {
        "status": F.when(chosen, "production").when(replaced, "archived").otherwise(
            F.col("status")
        )
    }
    if stamp:
        columns["promoted_at"] = F.when(chosen, now).otherwise(F.col("promoted_at"))
        columns["archived_at"] = F.when(replaced, now).otherwise(F.col("archived_at"))
        columns["updated_at"] = F.when(chosen | replaced, now).otherwise(F.col("updated_at"))
    return registry.withColumns(columns)


def archive(registry: DataFrame, model_id: str, now: Column) -> DataFrame:
    chosen = F.col("model_id") == model_id
    return registry.withColumns(
        {
            "status": F.when(chosen, "archived").otherwise(F.col("status")),
            "archived_at": F.when(chosen, now).otherwise(F.col("archived_at")),
            "updated_at": F.when(chosen, now).otherwise(F.col("updated_at")),
        }
    )


def active_model(registry: DataFrame) -> DataFrame:
    return registry.filter(F.col("status") == "production")


def get_model(registry: DataFrame, model_id: str) -> DataFrame:
    return registry.filter(F.col("model_id") == model_id).limit(1)


def list_models(registry: DataFrame, status: str | None = None) -> DataFrame:
    """All models, newest first; ``status`` narrows them."""
    rows = registry if status is None else registry.filter(F.col("status") == status)
    return rows.orderBy(F.desc("created_at"), "model_id")


def recently_promoted(registry: DataFrame, limit: int = 100) -> DataFrame:
    return registry.orderBy(F.desc_nulls_last("promoted_at"), "model_id").limit(limit)


def promotion_history(registry: DataFrame) -> DataFrame:
    """Models that were promoted at some time, oldest first."""
    return registry.filter(F.col("promoted_at").isNotNull()).orderBy("promoted_at", "model_id")
