"""Judge, latency and cost aggregates per group of model responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.config import DEFAULT_PRICE, PRICING
from promptmill.functions.numbers import round_exact
from promptmill.functions.verdicts import parse_verdict
from promptmill.operators.ranks import values_at_ranks
from promptmill.operators.skew import attach

SCORES = (1, 2, 3, 4, 5)
WIN_SCORE = 4


def _percentile_rank(share: float) -> tuple[float, Column]:
    """The 0-based index ``min(int(share * n), n - 1)``."""
    n = F.col("n")
    return share, F.least(F.floor(F.lit(share) * n), n - 1)


def latency_stats(responses: DataFrame, keys: Sequence[str], latency: str = "latency_ms") -> DataFrame:
    """p50, p95, p99 and mean per group, rounded to 2. Exact at any group size.

    ``keys`` names at least one column.
    """
    ranked = values_at_ranks(
        responses,
        keys,
        latency,
        {
            "p50": _percentile_rank(0.5),
            "p95": _percentile_rank(0.95),
            "p99": _percentile_rank(0.99),
        },
        {"mean": F.avg("_x")},
    )
    return ranked.select(
        *keys,
        *(round_exact(F.col(p), 2).alias(f"{p}_ms") for p in ("p50", "p95", "p99", "mean")),
    )


def pricing_table(spark, prices=PRICING) -> DataFrame:
    return spark.createDataFrame(
        list(prices), "model_name string, input_usd_per_m double, output_usd_per_m double"
    )


def cost_stats(responses: DataFrame, pricing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Token sums and their price per group. ``keys`` must include ``model_name``.

    Prices meet the sums, not the responses, so the join sees one row per group.
    """
    sums = responses.groupBy(*keys).agg(
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("total_input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("total_output_tokens"),
    )
    tokens = F.col("total_input_tokens") + F.col("total_output_tokens")
    side = lambda count, price: (
        F.col(count) / F.lit(1_000_000) * F.coalesce(price, F.lit(DEFAULT_PRICE))
    )
    total = side("total_input_tokens", "input_usd_per_m") + side(
        "total_output_tokens", "output_usd_per_m"
    )
    priced = sums.join(pricing, "model_name", "left").withColumn("_total", total)
    per_1k = F.when(tokens == 0, F.lit(0.0)).otherwise(
        F.col("_total") / tokens * F.lit(1000)
    )
    return priced.withColumn("_per_1k", per_1k).select(
        *keys,
        "total_input_tokens",
        "total_output_tokens",
        round_exact(F.col("_per_1k"), 6).alias("cost_per_1k_tokens_usd"),
        round_exact(F.col("_total"), 6).alias("total_cost_usd"),
    )


def first_verdicts(raw_verdicts: DataFrame) -> DataFrame:
    """One ``score`` and ``reason`` per judged sample: the earliest readable reply.

    A sample without a readable reply scores 1 with reason ``parse_error``.
    """
    parsed = raw_verdicts.withColumn("verdict", parse_verdict(F.trim("raw")))
    readable = F.col("verdict").isNotNull()
    first = F.min_by("verdict", F.when(readable, F.col("attempt")))
    fallback = F.struct(F.lit(1).alias("score"), F.lit("parse_error").alias("reason"))
    return (
        parsed.groupBy("experiment_id", "sample_id")
        .agg(F.coalesce(first, fallback).alias("verdict"))
        .select("experiment_id", "sample_id", "verdict.*")
    )


def judge_summary(verdicts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sample count, mean score, win rate and the dense score distribution per group."""
    counts = [F.count_if(F.col("score") == s).alias(f"_s{s}") for s in SCORES]
    summed = verdicts.groupBy(*keys).agg(
        F.count("score").alias("sample_count"), F.sum("score").alias("_sum"), *counts
    )
    n = F.col("sample_count")
    wins = sum((F.col(f"_s{s}") for s in SCORES if s >= WIN_SCORE), F.lit(0))
    distribution = F.map_from_arrays(
        F.array(*(F.lit(s) for s in SCORES)), F.array(*(F.col(f"_s{s}") for s in SCORES))
    )
    return summed.select(
        *keys,
        "sample_count",
        F.when(n > 0, round_exact(F.col("_sum") / n, 4)).otherwise(0.0).alias("mean_score"),
        F.when(n > 0, round_exact(wins / n, 4)).otherwise(0.0).alias("win_rate"),
        F.when(n > 0, distribution)
        .otherwise(F.create_map().cast("map<int,bigint>"))
        .alias("score_distribution"),
    )


def pair_responses(responses: DataFrame) -> DataFrame:
    """Each candidate response beside the teacher's response to the same sample.

    The teacher answers a sample once; repeated answers collapse to the first experiment's. A
    sample that very many experiments share is split over tasks.
    """
    teacher = (
        responses.filter(F.col("role") == "teacher")
        .groupBy("sample_id")
        .agg(F.min_by("response", "experiment_id").alias("reference"))
    )
    candidate = responses.filter(F.col("role") == "candidate").select(
        "experiment_id", "sample_id", F.col("response").alias("candidate")
    )
    return attach(candidate, teacher, ["sample_id"], spread=F.col("experiment_id"))


def evaluate_experiments(
    experiments: DataFrame, responses: DataFrame, verdicts: DataFrame, pricing: DataFrame
) -> DataFrame:
    """One evaluation row per experiment; without responses latency is null and samples 0."""
    answers = responses.filter(F.col("role") == "candidate")
    by_model = cost_stats(answers, pricing, ["experiment_id", "model_name"]).drop("model_name")
    judged = judge_summary(verdicts, ["experiment_id"])
    return (
        experiments.select(
            "experiment_id", "model_id", "model_name", "run_id", "experiment_type",
            "adapter_repo_id",
        )
        .join(judged, "experiment_id", "left")
        .join(latency_stats(answers, ["experiment_id"]), "experiment_id", "left")
        .join(by_model, "experiment_id", "left")
        .select(
            "experiment_id",
            "model_id",
            "model_name",
            "run_id",
            "experiment_type",
            "adapter_repo_id",
            F.coalesce("win_rate", F.lit(0.0)).alias("accuracy"),
            F.coalesce("mean_score", F.lit(0.0)).alias("mean_score"),
            "score_distribution",
            F.col("p50_ms").alias("latency_p50_ms"),
            F.col("p95_ms").alias("latency_p95_ms"),
            F.col("p99_ms").alias("latency_p99_ms"),
            "cost_per_1k_tokens_usd",
            "total_cost_usd",
            F.coalesce("sample_count", F.lit(0)).alias("sample_count"),
        )
    )
