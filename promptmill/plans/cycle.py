"""A whole cycle over a workspace folder: curate, plan, respond, judge, evaluate, decide, promote."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill import schemas
from promptmill.config import (
    MIN_NEW_LOGS,
    TEACHER_MODEL,
    Criteria,
    CurationConfig,
    RunConfig,
)
from promptmill.operators import experiments as ex
from promptmill.operators import gate, lifecycle, registry, runs
from promptmill.operators.evaluate import (
    evaluate_experiments,
    first_verdicts,
    pair_responses,
    pricing_table,
)
from promptmill.plans.curation import run_curation
from promptmill.responders import (
    ANSWERS,
    REPLIES,
    BatchJudge,
    BatchResponder,
    Judge,
    Responder,
    failures,
    judge_many,
    one_by_one,
    respond_many,
    unanswered,
)
from promptmill.session import materialise, spread
from promptmill.sources import datasets, folded, logs, state
from promptmill.sources.metric_log import promotions_to_metric_log, to_metric_log
from promptmill.sources.pulls import LogPulls


@dataclass(frozen=True)
class Workspace:
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"


def _event(
    spark: SparkSession, ws: Workspace, run_id: str, seq: int, run_status: str, stage: str | None, attempt: int = 0, **payload
) -> None:
    entry = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("at"),
        F.lit(seq).cast("bigint").alias("seq"),
        F.lit(run_status).alias("status"),
        F.lit(stage).cast("string").alias("stage"),
        (F.from_json(F.lit(json.dumps(payload)), schemas.STAGE_PAYLOAD) if stage else F.lit(None).cast(schemas.STAGE_PAYLOAD)).alias("payload"),
        F.lit(None).cast(schemas.RUN_CONFIG).alias("config"),
        F.lit(None).cast("string").alias("triggered_by"),
        F.lit(payload.get("error")).cast("string").alias("error"),
        F.lit(attempt).alias("attempt"),
    )
    folded.run_events(spark, ws.path("run_events")).append(entry)


def read_runs(spark: SparkSession, ws: Workspace) -> DataFrame:
    """Current runs: the folded base and newer events."""
    return folded.run_events(spark, ws.path("run_events")).read()


def fold_state(spark: SparkSession, ws: Workspace) -> None:
    """Fold run and experiment events, so that later reads leave their files unread; any time, by whatever schedules it."""
    for events in (folded.run_events(spark, ws.path("run_events")), folded.experiment_events(spark, ws.path("experiment_events"))):
        events.fold()
        events.table.vacuum()


def read_registry(spark: SparkSession, ws: Workspace) -> DataFrame:
    return state.read_snapshot(spark, ws.path("registry"), schemas.MODEL_REGISTRY)


def pulls_of(spark: SparkSession, ws: Workspace) -> LogPulls:
    return LogPulls(spark, ws.path("logs"), ws.path("ledger"))


def start_if_ready(
    spark: SparkSession, ws: Workspace, min_new_logs: int = MIN_NEW_LOGS,
    cfg: RunConfig = RunConfig(), triggered_by: str = "schedule",
) -> dict:
    """Register a run when enough logs wait, for whatever scheduler the user has."""
    result = gate.readiness(pulls_of(spark, ws).count_unconsumed(), min_new_logs).first().asDict()
    if result["status"] == "started":
        result["run_id"] = register_run(spark, ws, cfg, triggered_by)
    return result


def register_run(spark: SparkSession, ws: Workspace, cfg: RunConfig = RunConfig(), triggered_by: str = "manual") -> str:
    run_id = str(uuid.uuid4())
    ids = spark.range(1).select(F.lit(run_id).alias("run_id"))
    folded.run_events(spark, ws.path("run_events")).append(
        runs.registration(
            ids, F.current_timestamp(), triggered_by, cfg.run_icl, cfg.run_lora_sft, cfg.dry_run
        )
    )
    return run_id


def run_cycle(
    spark: SparkSession,
    ws: Workspace,
    run_id: str,
    responder: Responder | BatchResponder,
    ask: Judge | BatchJudge,
    is_verdict,
    *,
    cfg: RunConfig = RunConfig(),
    curation: CurationConfig = CurationConfig(),
    criteria: Criteria = Criteria(),
    batched: bool = False,
    wait_for_training: bool = False,
) -> dict:
    """Run every stage that is still to do for ``run_id`` and return the promotion result.

    Each stage commits its tables before its event, so a run that was lost resumes at the stage
    :func:`runs.resume_points` names and reads what the earlier stages stored. A stage that raises leaves the run ``failed``
    with its error; running it again makes it ``resuming`` and begins a new attempt. ``batched`` says that
    ``responder`` and ``ask`` take several prompts at once.

    Fine-tuning itself is outside Spark: planned ``lora_sft`` experiments wait with status ``training`` until a trainer reports on
    them through :func:`report_training`. With ``wait_for_training`` the run stays in evaluation while any of them does, and a
    later call evaluates those that have come; without it they are left out of the decision.
    """
    run = runs.get_run(read_runs(spark, ws), run_id)
    point = runs.resume_points(run).first()
    if point is None:
        raise ValueError(f"run {run_id} is not registered")
    attempt = point["attempt"]
    if point["status"] not in ("pending", "completed"):
        lifecycle.check_transition(point["status"], "resuming")
        attempt += 1
        _event(spark, ws, run_id, 0, "resuming", None, attempt)
    at = Progress(spark, ws, run_id, attempt, point["resume_from"])
    try:
        return _stages(at, cfg, curation, criteria, *_hooks(responder, ask, batched), is_verdict, wait_for_training)
    except Exception as error:
        _event(spark, ws, run_id, 9, "failed", at.stage, attempt, status="failed", error=f"{type(error).__name__}: {error}")
        raise


def _hooks(responder, ask, batched: bool) -> tuple[BatchResponder, BatchJudge]:
    return (responder, ask) if batched else (one_by_one(responder), one_by_one(ask))


@dataclass
class Progress:
    """Where a run is; its events carry the attempt."""

    spark: SparkSession
    ws: Workspace
    run_id: str
    attempt: int
    stage: str

    def event(self, seq: int, run_status: str, stage: str, /, **payload) -> None:
        _event(self.spark, self.ws, self.run_id, seq, run_status, stage, self.attempt, **payload)

    def begins(self, stage: str) -> bool:
        """Whether a stage is still to do; it becomes the current one."""
        if schemas.STAGES.index(stage) < schemas.STAGES.index(self.stage):
            return False
        self.stage = stage
        return True


def _stages(at: Progress, cfg, curation, criteria, responder, ask, is_verdict, wait_for_training: bool) -> dict:
    spark, ws, run_id = at.spark, at.ws, at.run_id
    if at.begins("curation"):
        at.event(1, "curating", "curation", status="running")
        if at.attempt:  # an earlier attempt may have consumed logs, also from files that are closed by now
            source = logs.read_logs(spark, ws.path("logs")), logs.read_ledger(spark, ws.path("ledger"))
        else:
            pulls = pulls_of(spark, ws)
            source = spread(pulls.open_logs().drop("file")), pulls.open_ledger()
        result = run_curation(
            spark,
            *source,
            run_id=run_id,
            dataset_id=f"dataset-{run_id}",
            datasets_path=ws.path("datasets"),
            ledger_path=ws.path("ledger"),
            cfg=curation,
        )
        # A run without logs has no dataset; the later stages are skipped by that, not by this status.
        at.event(2, "curating", "curation", **(result | {"status": "completed"}))
    if at.begins("finetuning"):
        _plan_stage(at, cfg)
    if at.begins("evaluation"):
        training = _evaluation_stage(at, responder, ask, is_verdict, wait_for_training)
        if training:
            return {"run_id": run_id, "promoted": False, "reason": "waiting_for_training", "training": training}
    at.begins("promotion")
    return _promotion_stage(at, criteria)


def _skip(at: Progress, stage: str) -> str | None:
    """Why a stage has nothing to do, from what the stages before it handed over."""
    run = runs.get_run(read_runs(at.spark, at.ws), at.run_id)
    return runs.stage_skips(run, ex_of_run(at.spark, at.ws, at.run_id)).first()[f"{stage}_skip"]


def read_experiments(spark: SparkSession, ws: Workspace) -> DataFrame:
    """Current experiments: the folded base and newer events."""
    return folded.experiment_events(spark, ws.path("experiment_events")).read()


def _experiments_changed(spark: SparkSession, ws: Workspace, rows: DataFrame, seq: int) -> None:
    folded.experiment_events(spark, ws.path("experiment_events")).append(_as_events(rows, seq))


def report_training(spark: SparkSession, ws: Workspace, reports: DataFrame) -> None:
    """A trainer's word on ``experiment_id``: ``status`` ``pending_eval`` or ``failed``, ``adapter_repo_id``, ``error``.

    Reports that come twice or late change nothing: an experiment never falls back to an earlier status.
    """
    allowed = lifecycle.EXPERIMENT_TRANSITIONS["training"]
    rows = reports.filter(F.col("status").isin(*allowed))
    if rows.count() != reports.count():
        raise lifecycle.IllegalTransition(f"a trainer may report {' or '.join(allowed)}")
    _experiments_changed(spark, ws, rows, 2)


def _as_events(df: DataFrame, seq: int) -> DataFrame:
    """Partial experiment rows as events: absent columns are null and change nothing."""
    spark = df.sparkSession
    template = spark.createDataFrame([], schemas.EXPERIMENTS)
    return df.select(
        *(
            F.current_timestamp().alias(f.name)
            if f.name == "updated_at"
            else (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in template.schema.fields
        ),
        F.lit(seq).cast("bigint").alias("seq"),
    )


def _plan_stage(at: Progress, cfg: RunConfig) -> None:
    spark, ws = at.spark, at.ws
    skip = _skip(at, "finetuning")
    if skip:
        at.event(4, "training", "finetuning", status="skipped", reason=skip)
        return
    at.event(3, "training", "finetuning", status="running")
    headers = datasets.read_headers(spark, ws.path("datasets")).filter(F.col("run_id") == at.run_id)
    known = read_experiments(spark, ws)
    planned = ex.plan_experiments(ex.candidates_table(spark), headers, cfg, known)
    rows = planned.withColumn("created_at", F.current_timestamp()).withColumn("promoted", F.lit(False))
    handed_over = ex.run_experiment_ids(planned, known).filter(F.col("run_id") == at.run_id)
    # The experiments of one run: candidates times their types.
    ids = sorted(r["experiment_id"] for r in handed_over.collect())
    _experiments_changed(spark, ws, rows, 1)
    at.event(4, "training", "finetuning", status="completed", dataset_id=f"dataset-{at.run_id}", experiments=ids)


def _evaluation_stage(at: Progress, responder, ask, is_verdict, wait_for_training: bool) -> int:
    """Evaluate what waits; returns how many experiments are still in training if the run is to wait for them."""
    spark, ws, run_id = at.spark, at.ws, at.run_id
    skip = _skip(at, "evaluation")
    if skip:
        at.event(6, "evaluating", "evaluation", status="skipped", reason=skip)
        return 0
    at.event(5, "evaluating", "evaluation", status="running")
    # A repeated stage also takes the experiments an earlier attempt has completed, and asks only for what is absent.
    open_or_done = ("pending_eval", "completed", "eval_failed")
    waiting = materialise(ex_of_run(spark, ws, run_id).filter(F.col("status").isin(*open_or_done)))
    samples = datasets.read_samples(spark, ws.path("datasets"))
    asked = ex.experiment_samples(waiting, samples).select(
        "experiment_id", F.col("log_id").alias("sample_id"), "model_name",
        F.lit("candidate").alias("role"), "prompt",
    )
    # The teacher answers each sample once, whichever experiments use it.
    taught = (
        asked.groupBy("sample_id").agg(F.min_by(F.struct("experiment_id", "prompt"), "experiment_id").alias("s"))
        .select("s.experiment_id", "sample_id", F.lit(TEACHER_MODEL).alias("model_name"),
                F.lit("teacher").alias("role"), "s.prompt")
    )
    folder = f"run_id={run_id}"
    stored = state.read_or_empty(spark, f"{ws.path('responses')}/{folder}", ANSWERS)
    known_teacher = stored.filter("role = 'teacher' AND error IS NULL").select("sample_id")
    absent = unanswered(asked.unionByName(taught.join(known_teacher, "sample_id", "left_anti")), stored)
    respond_many(absent.select(asked.columns), responder).write.mode("append").parquet(
        f"{ws.path('responses')}/{folder}"
    )
    answers = spark.read.schema(ANSWERS).parquet(f"{ws.path('responses')}/{folder}")
    responses = answers.filter("error IS NULL").drop("error")
    prompts = samples.join(
        waiting.select("dataset_id").distinct(), "dataset_id", "left_semi"
    ).select(F.col("log_id").alias("sample_id"), "prompt")
    pairs = pair_responses(responses).join(prompts, "sample_id")
    judged = state.read_or_empty(spark, f"{ws.path('verdicts')}/{folder}", REPLIES).filter("error IS NULL")
    unjudged = pairs.join(judged, ["experiment_id", "sample_id"], "left_anti").select(pairs.columns)
    judge_many(unjudged, ask, is_verdict).write.mode("append").parquet(
        f"{ws.path('verdicts')}/{folder}"
    )
    replies = spark.read.schema(REPLIES).parquet(f"{ws.path('verdicts')}/{folder}")
    # One experiment's errors leave the others alone.
    lost = failures(answers.filter("role = 'candidate'")).unionByName(failures(replies))
    lost = materialise(lost.groupBy("experiment_id").agg(F.min("error").alias("error")))
    sound = waiting.join(lost, "experiment_id", "left_anti")
    evaluations = evaluate_experiments(
        sound, responses, first_verdicts(replies.filter("error IS NULL").drop("error")), pricing_table(spark)
    ).withColumn("evaluated_at", F.current_timestamp())
    evaluations.write.mode("overwrite").parquet(f"{ws.path('evaluations')}/{folder}")
    done = spark.read.parquet(f"{ws.path('evaluations')}/{folder}")
    metrics = F.struct("accuracy", "mean_score", "latency_p95_ms", "cost_per_1k_tokens_usd")
    finished = done.select(
        "experiment_id", F.lit(run_id).alias("run_id"), F.lit("completed").alias("status"),
        F.current_timestamp().alias("completed_at"), metrics.alias("metrics"),
    )
    broken = waiting.filter("status <> 'completed'").join(lost.withColumnRenamed("error", "said"), "experiment_id").select(
        "experiment_id", "run_id", F.lit("eval_failed").alias("status"), F.col("said").alias("error")
    )
    _experiments_changed(spark, ws, finished, 3)
    _experiments_changed(spark, ws, broken, 3)
    _log_metrics(to_metric_log(done.withColumn("run_id", F.lit(run_id))), ws, run_id, "evaluation")
    training = ex_of_run(spark, ws, run_id).filter("status = 'training'").count() if wait_for_training else 0
    if not training:
        best = gate.best_candidate(_scored(spark, ws, run_id)).first()
        at.event(6, "evaluating", "evaluation", status="completed", best_candidate=best["experiment_id"] if best else None)
    return training


def ex_of_run(spark: SparkSession, ws: Workspace, run_id: str) -> DataFrame:
    return read_experiments(spark, ws).filter(F.col("run_id") == run_id)


def _log_metrics(rows: DataFrame, ws: Workspace, run_id: str, source: str) -> None:
    """A run's metrics of one source have a folder of their own, which a repeated stage replaces."""
    rows.write.mode("overwrite").parquet(f"{ws.path('metric_log')}/logged_by={run_id}/source={source}")


def _commit_registry(spark: SparkSession, ws: Workspace, scored: DataFrame, promoted: str | None) -> None:
    """Register and promote on the current registry, and once more if another run was faster."""
    for attempt in range(5):
        parent = state.current_version(spark, ws.path("registry"))
        current = registry.register(read_registry(spark, ws), scored, F.current_timestamp())
        if promoted is not None:
            current = registry.promote(current, promoted, F.current_timestamp())
        try:
            state.write_snapshot(current, ws.path("registry"), parent)
            return
        except state.SnapshotConflict:
            if attempt == 4:
                raise


def _scored(spark: SparkSession, ws: Workspace, run_id: str) -> DataFrame:
    """A run's evaluations as promotion receives them; none if evaluation was skipped."""
    empty = f"{_SCORED}, evaluated_at TIMESTAMP"
    return (
        state.read_or_empty(spark, f"{ws.path('evaluations')}/run_id={run_id}", empty)
        .withColumn("run_id", F.lit(run_id))
        .withColumnRenamed("cost_per_1k_tokens_usd", "cost_per_1k_tokens")
        .withColumn("seq", F.struct("model_id", "experiment_type"))
    )


# The columns of an evaluation.
_SCORED = (
    "experiment_id STRING, model_id STRING, model_name STRING, experiment_type STRING, adapter_repo_id STRING, "
    "accuracy DOUBLE, mean_score DOUBLE, score_distribution MAP<INT, BIGINT>, latency_p50_ms DOUBLE, latency_p95_ms DOUBLE, "
    "latency_p99_ms DOUBLE, cost_per_1k_tokens_usd DOUBLE, total_cost_usd DOUBLE, sample_count BIGINT"
)


def _promotion_stage(at: Progress, criteria: Criteria) -> dict:
    spark, ws, run_id = at.spark, at.ws, at.run_id
    at.event(7, "promoting", "promotion", status="running")
    this_run = spark.range(1).select(F.lit(run_id).alias("run_id"))
    scored = _scored(spark, ws, run_id)
    decision = gate.promotion_decisions(this_run, scored, criteria).first().asDict(recursive=True)
    if decision["reason"] != "no_candidate":
        _commit_registry(spark, ws, scored, decision["promoted_model_id"] if decision["promoted"] else None)
    if decision["promoted"]:
        chosen = scored.filter(F.col("experiment_id") == decision["promoted_model_id"])
        _log_metrics(promotions_to_metric_log(chosen), ws, run_id, "promotion")
    outcome = "no_candidate" if decision["reason"] == "no_candidate" else "completed"
    at.event(8, "completed", "promotion", status=outcome,
             promoted=decision["promoted"], reason=decision["reason"],
             best_candidate=decision["promoted_model_id"])
    pulls_of(spark, ws).settle()  # what this run consumed is final
    return decision
