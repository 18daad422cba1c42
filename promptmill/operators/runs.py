"""Run state folded from append-only events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill import schemas
from promptmill.operators.lifecycle import outcome_rank, run_rank
from promptmill.schemas import STAGES


def lift_runs(events: DataFrame, guarded: bool = False) -> DataFrame:
    """Each event as the state that it alone gives: values with the place that decides which of two counts.

    That place is the time, or, ``guarded``, the attempt, then how far along the status is, and then the time: an event that
    comes late or would lead back within an attempt changes nothing (see :mod:`promptmill.operators.lifecycle`).
    """
    attempt = F.coalesce(F.col("attempt"), F.lit(0)) if guarded and "attempt" in events.columns else F.lit(0)

    def placed(rank: Column, *values: Column | str) -> Column:
        return F.struct(attempt.alias("attempt"), rank.alias("rank"), "at", "seq", *values)

    by_status = run_rank(F.col("status")) if guarded else F.lit(0)
    by_outcome = outcome_rank(F.col("payload.status")) if guarded else F.lit(0)
    payload = placed(by_outcome, F.col("payload").alias("value"))
    config = placed(F.lit(0), F.col("config").alias("value"))
    return events.select(
        "run_id",
        "stage",
        F.when(F.col("payload").isNotNull(), payload).alias("payload"),
        placed(by_status, "status", "error").alias("last"),
        F.col("at").alias("started_at"),
        F.when(F.col("config").isNotNull(), config).alias("config"),
        "triggered_by",
    )


def merge_runs(states: DataFrame) -> DataFrame:
    """One state per run and stage. Taking the latest of each value, it does not mind order, lateness or repetition."""
    return states.groupBy("run_id", "stage").agg(
        F.max("payload").alias("payload"),
        F.max("last").alias("last"),
        F.min("started_at").alias("started_at"),
        F.max("config").alias("config"),
        F.max("triggered_by").alias("triggered_by"),
    )


def finish_runs(states: DataFrame) -> DataFrame:
    """One row per run: its latest status and, per stage, its latest payload in a ``stages`` map."""
    entry = F.when(
        F.col("stage").isNotNull() & F.col("payload").isNotNull(),
        F.struct("stage", F.col("payload.value").alias("payload")),
    )
    return (
        states.groupBy("run_id")
        .agg(
            F.max("last").alias("last"),
            F.min("started_at").alias("started_at"),
            F.max("config").alias("config"),
            F.max("triggered_by").alias("triggered_by"),
            # Stage names are a fixed vocabulary, so this list is short.
            F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("stages"),
        )
        .select(
            "run_id",
            F.col("last.status").alias("status"),
            "started_at",
            F.col("last.at").alias("updated_at"),
            F.col("config.value").alias("config"),
            "triggered_by",
            "stages",
            F.col("last.error").alias("error"),
            F.col("last.attempt").alias("attempt"),
        )
    )


def fold_runs(events: DataFrame, guarded: bool = False) -> DataFrame:
    """The runs of a whole history of events.

    Both steps are aggregates with partial combining; the second sees one row per run and stage.
    """
    return finish_runs(merge_runs(lift_runs(events, guarded)))


def registration(
    run_ids: DataFrame, now: Column, triggered_by: str, run_icl: bool = True,
    run_lora_sft: bool = True, dry_run: bool = False,
) -> DataFrame:
    """The first event of new runs: status ``pending``, no stage yet."""
    config = F.struct(
        F.lit(run_icl).alias("run_icl"),
        F.lit(run_lora_sft).alias("run_lora_sft"),
        F.lit(dry_run).alias("dry_run"),
    )
    return run_ids.select(
        "run_id",
        now.alias("at"),
        F.lit(0).cast("bigint").alias("seq"),
        F.lit("pending").alias("status"),
        F.lit(None).cast("string").alias("stage"),
        F.lit(None).cast(schemas.STAGE_PAYLOAD).alias("payload"),
        config.alias("config"),
        F.lit(triggered_by).alias("triggered_by"),
        F.lit(None).cast("string").alias("error"),
        F.lit(0).alias("attempt"),
    )


def _stage(name: str) -> Column:
    return F.col("stages")[name]


def _done(name: str, *statuses: str) -> Column:
    return F.coalesce(_stage(name)["status"].isin(*statuses), F.lit(False))


def resume_points(runs: DataFrame) -> DataFrame:
    """The first stage still to run, and what the stage before it hands over.

    Training and evaluation also count as done when they were skipped; curation must have completed.
    """
    resume_from = (
        F.when(~_done("curation", "completed"), F.lit(STAGES[0]))
        .when(~_done("finetuning", "completed", "skipped"), F.lit(STAGES[1]))
        .when(~_done("evaluation", "completed", "skipped"), F.lit(STAGES[2]))
        .otherwise(F.lit(STAGES[3]))
    )
    previous = (
        F.when(F.col("resume_from") == "finetuning", _stage("curation"))
        .when(F.col("resume_from") == "evaluation", _stage("finetuning"))
        .when(F.col("resume_from") == "promotion", _stage("evaluation"))
    )
    return runs.withColumn("resume_from", resume_from).withColumn("carried", previous)


def stage_skips(runs: DataFrame, experiments: DataFrame) -> DataFrame:
    """Which later stages have nothing to do: no dataset, or no experiments."""
    counted = experiments.groupBy("run_id").agg(F.count("*").alias("experiments"))
    dataset = F.col("stages")["curation"]["dataset_id"]
    planned = F.coalesce("experiments", F.lit(0))
    return runs.join(counted, "run_id", "left").select(
        "run_id",
        F.when(dataset.isNull(), "no_dataset_from_curation").alias("finetuning_skip"),
        F.when(planned == 0, "no_experiments_from_finetuning").alias("evaluation_skip"),
    )


def list_runs(runs: DataFrame, status: str | None = None, limit: int = 20) -> DataFrame:
    rows = runs if status is None else runs.filter(F.col("status") == status)
    return rows.orderBy(F.desc("started_at"), "run_id").limit(limit)


def get_run(runs: DataFrame, run_id: str) -> DataFrame:
    return runs.filter(F.col("run_id") == run_id).limit(1)
