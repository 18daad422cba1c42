"""Choose the best candidate of a run and decide whether it may be promoted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.config import MIN_NEW_LOGS, Criteria
from promptmill.functions.numbers import fixed

_NEVER = float("inf")


def _metric(name: str, missing: float) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(missing))


def passes_criteria(
    cfg: Criteria = Criteria(),
    with_sample_size: bool = True,
    cost: str = "cost_per_1k_tokens",
) -> Column:
    """All thresholds met, boundaries included; a missing metric fails its check."""
    passed = (
        (_metric("accuracy", 0.0) >= F.lit(float(cfg.min_accuracy)))
        & (_metric("latency_p95_ms", _NEVER) <= F.lit(float(cfg.max_latency_p95_ms)))
        & (_metric(cost, _NEVER) <= F.lit(float(cfg.max_cost_per_1k_tokens)))
    )
    if with_sample_size:
        passed = passed & (F.coalesce("sample_count", F.lit(0)) >= cfg.min_eval_sample_size)
    return passed


def failure_reasons(cfg: Criteria = Criteria(), cost: str = "cost_per_1k_tokens") -> Column:
    """Map of each failed criterion to a message; empty when all pass."""
    accuracy = _metric("accuracy", 0.0)
    latency = _metric("latency_p95_ms", _NEVER)
    price = _metric(cost, _NEVER)
    samples = F.coalesce(F.col("sample_count"), F.lit(0))

    def shown(value: Column, digits: int) -> Column:
        return F.when(value == _NEVER, F.lit("inf")).otherwise(fixed(value, digits))

    # Criterion names and message wording.
    messages = {
        "accuracy": F.when(
            accuracy < float(cfg.min_accuracy),
            F.concat(shown(accuracy, 3), F.lit(f" < required {cfg.min_accuracy}")),
        ),
        "latency": F.when(
            latency > float(cfg.max_latency_p95_ms),
            F.concat(shown(latency, 0), F.lit(f"ms > max {cfg.max_latency_p95_ms}ms")),
        ),
        "cost": F.when(
            price > float(cfg.max_cost_per_1k_tokens),
            F.concat(
                F.lit("$"), shown(price, 5), F.lit(f" > max ${cfg.max_cost_per_1k_tokens}")
            ),
        ),
        "sample_size": F.when(
            samples < cfg.min_eval_sample_size,
            F.concat(
                samples.cast("string"), F.lit(f" < required {cfg.min_eval_sample_size}")
            ),
        ),
    }
    entries = [part for name, message in messages.items() for part in (F.lit(name), message)]
    return F.map_filter(F.create_map(*entries), lambda _, message: message.isNotNull())


def best_candidate(scored: DataFrame, seq: str = "seq") -> DataFrame:
    """Per run the scored experiment with the best accuracy, then lowest cost, then first in order.

    An aggregate, so a run that holds most rows is combined before the shuffle.
    """
    rank = F.struct(-F.col("accuracy"), F.col("cost_per_1k_tokens"), F.col(seq))
    whole = F.struct(*(c for c in scored.columns if c != "run_id"))
    return (
        scored.groupBy("run_id")
        .agg(F.min_by(whole, rank).alias("best"))
        .select("run_id", "best.*")
    )


def promotion_decisions(
    runs: DataFrame, scored: DataFrame, cfg: Criteria = Criteria(), seq: str = "seq"
) -> DataFrame:
    """One decision per run: promote its best candidate, or say why not."""
    best = best_candidate(scored, seq).select(
        "run_id",
        F.col("experiment_id").alias("best_experiment_id"),
        F.col("model_name").alias("best_model_name"),
        passes_criteria(cfg).alias("passed"),
        failure_reasons(cfg).alias("failures"),
    )
    found = F.col("best_experiment_id").isNotNull()
    promoted = found & F.col("passed")
    return (
        runs.select("run_id")
        .join(best, "run_id", "left")
        .select(
            "run_id",
            promoted.alias("promoted"),
            F.when(promoted, F.col("best_experiment_id")).alias("promoted_model_id"),
            F.when(promoted, F.col("best_model_name")).alias("promoted_model_name"),
            F.when(~found, F.lit("no_candidate"))
            .when(~F.col("passed"), F.lit("criteria_not_met"))
            .alias("reason"),
            F.when(found & ~F.col("passed"), F.col("failures")).alias("detail"),
        )
    )


def pass_count(scored: DataFrame, cfg: Criteria = Criteria(), cost: str = "cost_per_1k_tokens") -> DataFrame:
    """How many rows pass the thresholds, sample size aside, and how many there are."""
    passed = passes_criteria(cfg, with_sample_size=False, cost=cost)
    return scored.agg(F.count_if(passed).alias("passed"), F.count("*").alias("total"))


def readiness(unconsumed: DataFrame, min_new_logs: int = MIN_NEW_LOGS) -> DataFrame:
    """Start a run when at least ``min_new_logs`` rows wait; ``unconsumed`` has ``new_logs``."""
    waiting = F.col("new_logs") < min_new_logs
    return unconsumed.select(
        F.when(waiting, "skipped").otherwise("started").alias("status"),
        F.when(waiting, "insufficient_logs").alias("reason"),
        "new_logs",
        F.lit(min_new_logs).cast("bigint").alias("min_required"),
    )
