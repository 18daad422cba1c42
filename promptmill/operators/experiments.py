"""Plan experiments and bring their samples together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill import schemas
from promptmill.config import CANDIDATES, Candidate, RunConfig
from promptmill.operators.lifecycle import experiment_rank
from promptmill.operators.skew import attach


def candidates_table(spark: SparkSession, candidates: Sequence[Candidate] = CANDIDATES) -> DataFrame:
    rows = [
        (c.id, c.provider, c.model, c.hf_model, list(c.experiments), c.target)
        for c in candidates
    ]
    return spark.createDataFrame(rows, schemas.CANDIDATES)


def plan_experiments(
    candidates: DataFrame,
    datasets: DataFrame,
    cfg: RunConfig = RunConfig(),
    existing: DataFrame | None = None,
) -> DataFrame:
    """New experiment rows: each dataset (``dataset_id``, ``run_id``) × candidate × its types.

    ``lora_sft`` needs a trainable model and is planned once per run and model; ``icl`` has no such guard.
    The plan is empty for a run without dataset. Ids follow from run, model and type, so
    planning again gives the same rows.
    """
    switched_on = [
        name
        for name, on in (("icl", cfg.run_icl), ("lora_sft", cfg.run_lora_sft))
        if on
    ]
    types = candidates.select(
        F.col("id").alias("model_id"),
        F.col("model").alias("model_name"),
        "hf_model",
        F.explode("experiments").alias("experiment_type"),
    ).filter(
        F.col("experiment_type").isin(*switched_on)
        & ((F.col("experiment_type") != "lora_sft") | F.col("hf_model").isNotNull())
    )
    # The candidate list is configuration, a handful of rows, and every dataset takes all of it.
    offered = types.agg(F.collect_list(F.struct(*types.columns)).alias("offer"))
    planned = (
        datasets.filter(F.col("dataset_id").isNotNull())
        .select("run_id", "dataset_id", F.lit(0).alias("_all"))
        .join(F.broadcast(offered.withColumn("_all", F.lit(0))), "_all")
        .select("run_id", "dataset_id", F.explode("offer").alias("o"))
        .select("run_id", "dataset_id", "o.*")
    )
    if existing is not None:
        done = existing.filter(
            (F.col("experiment_type") == "lora_sft")
            & F.col("status").isin("pending_eval", "completed")
        ).select("run_id", "model_id", "experiment_type")
        planned = planned.join(done, ["run_id", "model_id", "experiment_type"], "left_anti")
    return planned.select(
        F.sha2(F.concat_ws("|", "run_id", "model_id", "experiment_type"), 256)
        .substr(1, 32)
        .alias("experiment_id"),
        "run_id",
        "model_id",
        "model_name",
        "hf_model",
        "experiment_type",
        F.when(F.col("experiment_type") == "icl", "pending_eval")
        .otherwise("training")
        .alias("status"),
        "dataset_id",
    )


def run_experiment_ids(planned: DataFrame, existing: DataFrame) -> DataFrame:
    """Ids a run hands to evaluation: the new ones and those it already had."""
    runs = planned.select("run_id").distinct()
    return (
        planned.select("run_id", "experiment_id")
        .unionByName(existing.join(runs, "run_id", "left_semi").select("run_id", "experiment_id"))
        .distinct()
    )


def evaluable(experiments: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Experiments that wait for evaluation, optionally only those in ``ids``."""
    waiting = experiments.filter(F.col("status").isin("pending_eval"))
    if ids is None:
        return waiting
    return waiting.join(ids.select("experiment_id"), "experiment_id", "left_semi")


def experiment_samples(experiments: DataFrame, samples: DataFrame, sample_id: str = "log_id") -> DataFrame:
    """Every experiment with every sample of its dataset; experiments without samples vanish.

    One dataset may hold most samples, so its rows are spread and meet copies of the experiments.
    """
    wanted = experiments.select("experiment_id", "model_name", "dataset_id")
    return attach(samples, wanted, ["dataset_id"], spread=F.col(sample_id))


def list_experiments(experiments: DataFrame, run_id: str | None = None, limit: int = 50) -> DataFrame:
    rows = experiments if run_id is None else experiments.filter(F.col("run_id") == run_id)
    return rows.orderBy(F.desc("created_at"), "experiment_id").limit(limit)


def get_experiment(experiments: DataFrame, experiment_id: str) -> DataFrame:
    return experiments.filter(F.col("experiment_id") == experiment_id).limit(1)


def lift_experiments(
    events: DataFrame, order: Sequence[str] = ("updated_at", "seq"), guarded: bool = False
) -> DataFrame:
    """Each partial update as the state that it alone gives: known values with the time they are from.

    ``guarded``, a status counts by how far along it is and only then by its time, so that none is taken back.
    """
    skip = {"experiment_id", "created_at", *order}

    def known(name: str):
        rank = experiment_rank(F.col("status")) if guarded and name == "status" else F.lit(0)
        value = F.struct(rank.alias("rank"), *order, F.col(name).alias("value"))
        return F.when(F.col(name).isNotNull(), value).alias(name)

    return events.select("experiment_id", "created_at", "updated_at", *(known(n) for n in events.columns if n not in skip))


def merge_experiments(states: DataFrame) -> DataFrame:
    """One state per experiment; order, lateness and repetition of updates do not matter."""
    latest = [F.max(name).alias(name) for name in states.columns if name not in ("experiment_id", "created_at", "updated_at")]
    return states.groupBy("experiment_id").agg(
        F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"), *latest
    )


def finish_experiments(states: DataFrame) -> DataFrame:
    plain = ("experiment_id", "created_at", "updated_at")
    return states.select(*plain, *(F.col(name)["value"].alias(name) for name in states.columns if name not in plain))


def current_experiments(events: DataFrame, order: Sequence[str] = ("updated_at", "seq")) -> DataFrame:
    """Fold partial updates: per experiment and column the latest non-null value."""
    return finish_experiments(merge_experiments(lift_experiments(events, order)))
