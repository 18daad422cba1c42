"""Summaries over logs, experiments and cycles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions.numbers import round_exact
from promptmill.operators.ranks import numbered, values_at_ranks
from promptmill.operators.skew import attach
from promptmill.schemas import EXPERIMENT_TYPES
from promptmill.session import materialise


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), column)
    )


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty ones included, the last one closed.

    Values are binned against the range of their group.
    A constant column gets a range of one around its value.
    """
    key = F.col(by) if by else F.lit(0)
    rows = df.filter(F.col(column).isNotNull()).select(
        key.alias("_by"), F.col(column).cast("double").alias("x")
    )
    # Values are counted first and kept: all later steps see distinct values per group, not rows.
    values = materialise(rows.groupBy("_by", "x").agg(F.count("*").alias("rows")))
    span = values.groupBy("_by").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    flat = F.col("low") == F.col("high")
    span = span.select(
        "_by",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.col("high")).otherwise(F.col("low") + i * width)

    guess = F.least(
        F.floor((F.col("x") - F.col("low")) / (F.col("high") - F.col("low")) * bins),
        F.lit(bins - 1),
    )
    ranged = (
        attach(values, span, ["_by"], spread=F.col("x"))
        if by
        # Without groups the range is a single row.
        else values.join(F.broadcast(span), "_by")
    )
    guessed = ranged.withColumn("bin", guess)
    settled = (
        F.when(F.col("x") < edge(F.col("bin")), F.col("bin") - 1)
        .when(
            (F.col("bin") < bins - 1) & (F.col("x") >= edge(F.col("bin") + 1)), F.col("bin") + 1
        )
        .otherwise(F.col("bin"))
    )
    counts = guessed.withColumn("bin", settled).groupBy("_by", "bin").agg(
        F.sum("rows").alias("n")
    )
    grid = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    result = (
        grid.withColumn("bin", F.col("bin").cast("bigint"))
        .join(counts, ["_by", "bin"], "left")
        .select(
            *([F.col("_by").alias(by)] if by else []),
            "bin",
            edge(F.col("bin")).alias("low"),
            edge(F.col("bin") + 1).alias("high"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )
    return result


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and linearly interpolated quartiles.

    Two passes read the column, so it is stored by itself once: it may be costly to compute.
    """
    df = materialise(df.select(column))
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    position = {name: (F.col("n") - 1) * F.lit(share) for name, share in shares.items()}
    ranks = {}
    for name, share in shares.items():
        ranks[f"{name}_low"] = (share, F.floor(position[name]))
        ranks[f"{name}_high"] = (share, F.ceil(position[name]))
    moments = {"mean": F.avg("_x"), "std": F.stddev_samp("_x"), "min": F.min("_x"), "max": F.max("_x")}
    at = values_at_ranks(df, [], column, ranks, moments)

    def between(name: str) -> Column:
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        return low + (high - low) * (position[name] - F.floor(position[name]))

    # One row or, without values, none: the aggregate makes it one.
    found = at.select(F.col("n").alias("count"), *moments, *(between(q).alias(q) for q in shares))
    columns = ["mean", "std", "min", *shares, "max"]
    return found.agg(F.coalesce(F.max("count"), F.lit(0)).alias("count"), *(F.max(c).alias(c) for c in columns))


def flatten_metrics(df: DataFrame) -> DataFrame:
    return df.select("*", "metrics.*").drop("metrics")


def completed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == "completed")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def _mean(metric: str) -> Column:
    """Mean of a metric of at most six decimals, summed exactly, so that no order of rows changes it."""
    return F.sum(F.col(metric).cast("decimal(24,6)")).cast("double") / F.count(metric)


def accuracy_pivot(experiments: DataFrame) -> DataFrame:
    """Mean accuracy, one row per model and one column per experiment type."""
    return (
        experiments.groupBy("model_id")
        .pivot("experiment_type", list(EXPERIMENT_TYPES))
        .agg(_mean("accuracy"))
    )


def compare_types(experiments: DataFrame) -> DataFrame:
    """Mean metrics per model and experiment type."""
    metrics = ("accuracy", "latency_p95_ms", "cost_per_1k_tokens_usd")
    means = experiments.groupBy("model_id", "experiment_type").agg(
        *(_mean(m).alias(m) for m in metrics)
    )
    return means.select(
        "model_id", "experiment_type", *(round_exact(F.col(m), 4).alias(m) for m in metrics)
    )


def cycles(runs: DataFrame) -> DataFrame:
    """Number all runs by start time, from 1."""
    return numbered(runs, ["started_at", "run_id"], "cycle")


def metric_by_cycle(experiments: DataFrame, runs: DataFrame, metric: str) -> DataFrame:
    """Mean of a metric per cycle; experiments of unknown runs belong to no cycle.

    Experiments are summed per run first, so the join sees one row per run.
    """
    per_run = experiments.groupBy("run_id").agg(
        F.sum(metric).alias("_sum"), F.count(metric).alias("_n")
    )
    return (
        per_run.join(cycles(runs.select("run_id", "started_at")), "run_id")
        .groupBy("cycle")
        .agg((F.sum("_sum") / F.sum("_n")).alias(metric))
    )


def funnel_by_cycle(runs: DataFrame) -> DataFrame:
    """Curation counts of completed runs, numbered among the completed ones.

    Numbers are given before runs without a completed curation drop out, so gaps may occur.
    """
    counted = numbered(completed(runs), ["started_at", "run_id"], "cycle")
    curation = F.col("stages")["curation"]
    zero = F.lit(0)
    return counted.filter(curation["status"] == "completed").select(
        "cycle",
        F.coalesce(curation["logs_pulled"], zero).alias("logs_pulled"),
        F.coalesce(curation["samples_after_filter"], zero).alias("after_filter"),
        F.coalesce(curation["samples_after_dedup"], zero).alias("after_dedup"),
    )


def head(df: DataFrame, order_by: Sequence[Column | str], n: int = 10) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def tail(df: DataFrame, order_by: Sequence[str], n: int = 10) -> DataFrame:
    """The last ``n`` rows in order."""
    last = df.orderBy(*(F.desc(c) for c in order_by)).limit(n)
    return last.orderBy(*order_by)
