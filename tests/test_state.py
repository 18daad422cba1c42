"""Registry, run state, sources, reports and the whole cycle."""

import json
import re
import uuid

import pytest
from pyspark.sql import functions as F

from promptmill import schemas
from promptmill.config import CurationConfig, RunConfig
from promptmill.operators import experiments as ex
from promptmill.operators import ranks, registry, reports, runs
from promptmill.operators.skew import attach
from promptmill.plans import cycle
from promptmill.sources import datasets, folded, logs, metric_log, state
from promptmill.streaming.incremental import log_stream, start_curation

SCORED = (
    "experiment_id string, model_name string, run_id string, accuracy double, mean_score double, "
    "latency_p95_ms double, cost_per_1k_tokens double, total_cost_usd double, sample_count long"
)


def at(day):
    return F.to_timestamp(F.lit(f"2024-01-{day:02d}"))


@pytest.fixture
def models(spark):
    rows = [(e, "m", "r1", 0.9, 4.0, 100.0, 0.01, 0.1, 60) for e in ("a", "b", "c")]
    return registry.register(
        spark.createDataFrame([], schemas.MODEL_REGISTRY), spark.createDataFrame(rows, SCORED), at(1)
    )


def statuses(frame):
    return {r.model_id: r.status for r in frame.collect()}


def test_promotion_keeps_exactly_one_in_production(models):
    first = registry.promote(models, "a", at(2))
    second = registry.promote(first, "b", at(3))
    assert statuses(second) == {"a": "archived", "b": "production", "c": "candidate"}
    assert registry.active_model(second).first().model_id == "b"
    row = registry.get_model(second, "a").first()
    assert (row.promoted_at.day, row.archived_at.day, row.updated_at.day) == (2, 3, 3)
    assert [r.model_id for r in registry.promotion_history(second).collect()] == ["a", "b"]
    assert registry.recently_promoted(second).first().model_id == "b"
    assert statuses(registry.promote(second, "b", at(4))) == statuses(second)


def test_promoting_an_unknown_model_changes_nothing(models):
    with pytest.raises(ValueError):
        registry.promote(models, "zzz", at(2))


def test_manual_promotion_sets_no_times_and_archive(models):
    manual = registry.promote(models, "a", at(2), stamp=False)
    assert registry.active_model(manual).first().promoted_at is None
    assert statuses(registry.archive(manual, "a", at(3)))["a"] == "archived"
    assert registry.list_models(manual, "production").count() == 1


def test_registering_again_resets_a_production_row(spark, models):
    live = registry.promote(models, "a", at(2))
    again = spark.createDataFrame([("a", "m", "r2", 0.1, 1.0, 1.0, 0.1, 0.1, 1)], SCORED)
    row = registry.get_model(registry.register(live, again, at(3)), "a").first()
    assert (row.status, row.run_id, row.promoted_at, row.created_at.day) == ("candidate", "r2", None, 3)


def test_snapshots(spark, models, tmp_path):
    path = str(tmp_path / "registry")
    assert state.read_snapshot(spark, path, schemas.MODEL_REGISTRY).count() == 0
    assert state.write_snapshot(models, path) == 1
    current = state.read_snapshot(spark, path, schemas.MODEL_REGISTRY)
    assert state.write_snapshot(registry.promote(current, "a", at(2)), path) == 2
    assert statuses(state.read_snapshot(spark, path, schemas.MODEL_REGISTRY))["a"] == "production"
    # A second writer that started from version 1 must not replace version 2.
    with pytest.raises(state.SnapshotConflict):
        state.write_snapshot(registry.promote(models, "b", at(3)), path, parent=1)
    assert state.current_version(spark, path) == 2
    assert statuses(state.read_snapshot(spark, path, schemas.MODEL_REGISTRY))["a"] == "production"


# --- runs ----------------------------------------------------------------------------------------


def events(spark, rows):
    """rows: run, second, status, stage, stage status."""
    base = spark.createDataFrame(rows, "run_id string, seq long, status string, stage string, s string")
    payload = F.from_json(F.to_json(F.struct(F.col("s").alias("status"))), schemas.STAGE_PAYLOAD)
    return base.select(
        "run_id", F.timestamp_seconds("seq").alias("at"), "seq", "status", "stage",
        F.when(F.col("stage").isNotNull(), payload).alias("payload"),
        F.lit(None).cast(schemas.RUN_CONFIG).alias("config"),
        F.lit(None).cast("string").alias("triggered_by"),
        F.lit(None).cast("string").alias("error"),
    )


@pytest.mark.parametrize(
    "stages, expected",
    [
        ([], "curation"),
        ([("curation", "failed")], "curation"),
        ([("curation", "skipped")], "curation"),
        ([("curation", "completed")], "finetuning"),
        ([("curation", "completed"), ("finetuning", "skipped")], "evaluation"),
        ([("curation", "completed"), ("finetuning", "completed"), ("evaluation", "running")], "evaluation"),
        ([("curation", "completed"), ("finetuning", "completed"), ("evaluation", "completed")], "promotion"),
    ],
)
def test_resume_points(spark, stages, expected):
    rows = [("r", 0, "pending", None, None)]
    rows += [("r", i, "x", stage, status) for i, (stage, status) in enumerate(stages, start=1)]
    assert runs.resume_points(runs.fold_runs(events(spark, rows))).first().resume_from == expected


def test_fold_takes_the_latest_of_each_stage(spark):
    rows = [
        ("r1", 1, "pending", None, None), ("r1", 2, "curating", "curation", "running"),
        ("r1", 4, "curating", "curation", "completed"), ("r1", 5, "training", "finetuning", "running"),
        ("r2", 3, "pending", None, None),
    ]
    got = {r.run_id: r for r in runs.fold_runs(events(spark, rows)).collect()}
    assert got["r1"].status == "training" and got["r2"].status == "pending"
    assert {k: v.status for k, v in got["r1"].stages.items()} == {"curation": "completed", "finetuning": "running"}
    assert got["r2"].stages == {}
    folded = runs.fold_runs(events(spark, rows))
    assert [r.cycle for r in reports.cycles(folded).orderBy("run_id").collect()] == [1, 2]


def test_registration(spark):
    ids = spark.createDataFrame([("r",)], "run_id string")
    run = runs.fold_runs(runs.registration(ids, at(1), "schedule", dry_run=True)).first()
    assert (run.status, run.triggered_by, run.config.dry_run, run.stages) == ("pending", "schedule", True, {})


# --- experiments ---------------------------------------------------------------------------------


def test_planning(spark):
    ds = spark.createDataFrame([("d1", "r1")], "dataset_id string, run_id string")
    offered = ex.candidates_table(spark)
    plan = ex.plan_experiments(offered, ds)
    assert plan.count() == 6 and plan.filter("status = 'training'").count() == 3
    assert ex.plan_experiments(offered, ds, RunConfig(run_lora_sft=False)).count() == 3
    no_weights = offered.withColumn("hf_model", F.lit(None).cast("string"))
    assert ex.plan_experiments(no_weights, ds).count() == 3
    done = plan.withColumn("status", F.lit("completed"))
    again = ex.plan_experiments(offered, ds, existing=done)
    assert {r.experiment_type for r in again.collect()} == {"icl"}
    assert ex.run_experiment_ids(again, done).count() == 6
    assert ex.plan_experiments(offered, ds.withColumn("dataset_id", F.lit(None).cast("string"))).count() == 0


def test_experiments_without_samples_vanish(spark):
    exps = spark.createDataFrame(
        [("e1", "m", "d1"), ("e2", "m", "d1"), ("e3", "m", "d9")],
        "experiment_id string, model_name string, dataset_id string",
    )
    samples = spark.createDataFrame([("d1", str(i)) for i in range(50)], "dataset_id string, log_id string")
    got = ex.experiment_samples(exps, samples).groupBy("experiment_id").count().collect()
    assert {r[0]: r[1] for r in got} == {"e1": 50, "e2": 50}


def test_fold_of_partial_updates(spark):
    rows = [("e", 1, "training", None), ("e", 2, "pending_eval", None), ("e", 3, None, "boom")]
    df = spark.createDataFrame(rows, "experiment_id string, seq long, status string, error string")
    df = df.withColumn("updated_at", F.timestamp_seconds("seq")).withColumn("created_at", at(1))
    row = ex.current_experiments(df).first()
    assert (row.status, row.error) == ("pending_eval", "boom")


def test_attach_splits_a_hot_key_and_keeps_all_rows(spark):
    big = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), "id")
    keyed = spark.createDataFrame([(0, "x"), (0, "y"), (1500, "z"), (-1, "none")], "k long, v string")
    joined = attach(big, keyed, ["k"], spread=F.col("id"))
    assert joined.count() == 2001 and joined.select("id", "v").distinct().count() == 2001


def test_numbering_and_first_rows(spark):
    df = spark.range(5000).select((5000 - F.col("id")).alias("v")).repartition(7)
    rows = ranks.numbered(df, ["v"], "n").collect()
    assert sorted((r.v, r.n) for r in rows) == [(i, i) for i in range(1, 5001)]
    assert sorted(r.v for r in ranks.first_rows(df, ["v"], 100).collect()) == list(range(1, 101))


def test_a_faster_run_is_not_overwritten(spark, models, tmp_path, monkeypatch):
    ws = cycle.Workspace(str(tmp_path))
    path = ws.path("registry")
    state.write_snapshot(models, path)
    read, calls = cycle.read_registry, []

    def interrupted(*given):
        current = read(*given)
        if not calls:  # another run promotes between this run's read and its commit
            calls.append(state.write_snapshot(registry.promote(current, "b", at(2)), path))
        return current

    monkeypatch.setattr(cycle, "read_registry", interrupted)
    scored = spark.createDataFrame([("d", "m", "r2", 0.95, 4.0, 90.0, 0.01, 0.1, 60)], SCORED)
    cycle._commit_registry(spark, ws, scored, "d")
    assert statuses(read(spark, ws)) == {"a": "candidate", "b": "archived", "c": "candidate", "d": "production"}


# --- reports -------------------------------------------------------------------------------------


def test_histogram_matches_numpy(spark):
    import numpy as np

    values = [0.1 * i for i in range(101)] + [3.3] * 5 + [10.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    counts, edges = np.histogram(values, bins=30)
    got = reports.histogram(df, "x", 30).orderBy("bin").collect()
    assert [r.n for r in got] == counts.tolist()
    flat = reports.histogram(df.withColumn("x", F.lit(2.0)), "x", 10).orderBy("bin").collect()
    assert [r.n for r in flat] == np.histogram([2.0] * len(values), bins=10)[0].tolist()


def test_describe_matches_pandas(spark):
    import pandas as pd

    values = [1.0, 2.0, 2.5, 10.0, 11.0, 12.5, 3.0]
    row = reports.describe(spark.createDataFrame([(v,) for v in values], "x double"), "x").first()
    assert list(row) == pytest.approx(pd.Series(values).describe().tolist())


def test_metric_log_round_trip(spark):
    ev = spark.createDataFrame(
        [("exp-12345678", "m", "model", "r", 0.9, 4.0, 1.0, 2.0, 3.0, 0.01, 0.1, 60, {1: 0, 2: 0, 3: 1, 4: 2, 5: 3})],
        "experiment_id string, model_id string, model_name string, run_id string, accuracy double, "
        "mean_score double, latency_p50_ms double, latency_p95_ms double, latency_p99_ms double, "
        "cost_per_1k_tokens_usd double, total_cost_usd double, sample_count long, "
        "score_distribution map<int,long>",
    )
    log = metric_log.to_metric_log(ev)
    assert log.count() == 13 and log.first().run_name == "model_exp-1234"
    wide = metric_log.read_metric_log(log).first()
    assert (wide.accuracy, wide.score_5, wide.tag_model_name) == (0.9, 3.0, "model")


# --- logs, datasets, cycle, stream ---------------------------------------------------------------

WORDS = "river stone cloud ember field quiet lantern harbor maple thunder velvet copper".split()


def make_logs(spark, n=40, start=0):
    rows = []
    for i in range(start, start + n):
        body = ". ".join(f"{WORDS[(i * 7 + j) % 12]} {WORDS[(i + j * 5) % 12]} number {i * 31 + j}" for j in range(12))
        rows.append((f"log-{i:04d}", f"Question {i}?", f"Answer {i}: {body}.", "m", 100, i, "s"))
    rows.append((f"log-dup-{start}", f"Question {start}?", rows[0][2], "m", 100, start + 10_000, "s"))
    rows.append((f"log-short-{start}", "Hi", "Yes.", "m", 100, start + 10_001, "s"))
    df = spark.createDataFrame(
        rows, "log_id string, prompt string, response string, model string, latency_ms int, t long, session_id string"
    )
    return df.withColumn("timestamp", F.timestamp_seconds("t")).drop("t")


def test_dataset_round_trip_and_export(spark, tmp_path):
    path = str(tmp_path / "datasets")
    assert datasets.write_dataset(make_logs(spark), "d1", "r1", path) == 42
    stored = datasets.read_dataset(spark, path, "d1")
    assert [r.seq for r in stored.orderBy("timestamp", "log_id").collect()] == list(range(1, 43))
    assert datasets.read_headers(spark, path).first().sample_count == 42
    with pytest.raises(ValueError):
        datasets.read_dataset(spark, path, "nope")
    datasets.export_chat_jsonl(stored, str(tmp_path / "chat"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "chat")).collect()]
    assert len(lines) == 42 and {m["role"] for m in lines[0]["messages"]} == {"user", "assistant"}


def test_whole_cycle(spark, tmp_path):
    # Local functions travel to the workers with their code, as a user's notebook functions do.
    def reply(model, prompt):
        return f"{model} says {prompt}", 100.0, 10, 20

    def verdict(system, prompt, attempt):
        return "broken" if attempt == 1 else '{"score": 5, "reason": "same"}'

    ws = cycle.Workspace(str(tmp_path))
    make_logs(spark, 60).write.parquet(ws.path("logs"))
    assert cycle.start_if_ready(spark, ws, min_new_logs=500)["status"] == "skipped"
    started = cycle.start_if_ready(spark, ws, min_new_logs=62)
    run_id = started["run_id"]
    options = {"curation": CurationConfig(min_quality_score=0.3)}
    is_json = lambda raw: raw.startswith("{")
    decision = cycle.run_cycle(spark, ws, run_id, reply, verdict, is_json, **options)
    assert decision["promoted"] is True
    active = registry.active_model(cycle.read_registry(spark, ws)).collect()
    assert [r.model_id for r in active] == [decision["promoted_model_id"]]
    run = runs.get_run(cycle.read_runs(spark, ws), run_id).first()
    assert run.status == "completed" and set(run.stages) == set(schemas.STAGES)
    assert (run.stages["curation"].logs_pulled, run.stages["curation"].samples_after_filter) == (62, 61)
    assert run.stages["curation"].samples_after_dedup == 60
    done = reports.completed(cycle.read_experiments(spark, ws))
    assert done.count() == 3 and {r.metrics.accuracy for r in done.collect()} == {1.0}
    waiting = logs.count_unconsumed(
        logs.read_logs(spark, ws.path("logs")), logs.read_ledger(spark, ws.path("ledger"))
    )
    assert waiting.first()[0] == 0 and cycle.pulls_of(spark, ws).open_files() == []
    logged = spark.read.parquet(ws.path("metric_log")).filter("source = 'evaluation'").select(F.col("tags")["evaluated_at"].alias("at")).first()
    assert re.fullmatch(r"[0-9-]{10}T[0-9:]{8}(\.[0-9]{6})?\+00:00", logged["at"])
    # Nothing new: the next run skips through to the end and the registry stays.
    second = cycle.register_run(spark, ws)
    assert cycle.run_cycle(spark, ws, second, reply, verdict, is_json, **options)["reason"] == "no_candidate"
    assert registry.active_model(cycle.read_registry(spark, ws)).count() == 1
    with pytest.raises(ValueError):
        cycle.run_cycle(spark, ws, "unknown", reply, verdict, is_json)


@pytest.mark.parametrize("lost_at", [2, 4, 6, 8])
def test_a_lost_driver_loses_no_results(spark, tmp_path, monkeypatch, lost_at):
    """Stop after a stage's tables are written and before its event, then resume."""
    asked = tmp_path / "asked"
    asked.mkdir()

    def reply(model, prompt):
        (asked / uuid.uuid4().hex).touch()
        return f"{model} says {prompt}", 100.0, 10, 20

    def verdict(system, prompt, attempt):
        return '{"score": 5, "reason": "same"}'

    def tables(ws):
        names = ["responses", "verdicts", "evaluations", "datasets/samples", "ledger"]
        frames = {n: spark.read.parquet(ws.path(n)).drop("run_id", "dataset_id", "evaluated_at", "consumed_at") for n in names}
        drop = ("experiment_id",)  # drawn anew for each run
        return {n: sorted(map(repr, f.drop(*drop).collect())) for n, f in frames.items()}

    options = {"curation": CurationConfig(min_quality_score=0.3)}
    is_json = lambda raw: raw.startswith("{")
    results = []
    for broken in (False, True):
        ws = cycle.Workspace(str(tmp_path / f"broken-{broken}"))
        make_logs(spark, 60).write.parquet(ws.path("logs"))
        run_id = cycle.register_run(spark, ws)
        before = len(list(asked.iterdir()))
        if broken:
            event = cycle._event

            def lost(spark, ws, run_id, seq, *rest, **more):
                if seq == lost_at:
                    raise RuntimeError("driver lost")
                return event(spark, ws, run_id, seq, *rest, **more)

            with monkeypatch.context() as patched:
                patched.setattr(cycle, "_event", lost)
                with pytest.raises(RuntimeError, match="driver lost"):
                    cycle.run_cycle(spark, ws, run_id, reply, verdict, is_json, **options)
            # Logs that arrive meanwhile belong to a later run.
            if lost_at > 1:
                make_logs(spark, 3, start=500).write.mode("append").parquet(ws.path("logs"))
        decision = cycle.run_cycle(spark, ws, run_id, reply, verdict, is_json, **options)
        answers = len(list(asked.iterdir())) - before
        results.append((decision["promoted"], decision["reason"], answers, tables(ws)))
        status = runs.get_run(cycle.read_runs(spark, ws), run_id).first().status
        assert status == "completed" and registry.active_model(cycle.read_registry(spark, ws)).count() == 1
    assert results[0] == results[1]


@pytest.mark.parametrize("across", [False, True])
def test_stream_processes_each_log_once(spark, tmp_path, across):
    source, out = str(tmp_path / "logs"), str(tmp_path / "out")
    cfg = CurationConfig(min_quality_score=0.3, remove_pii=False)

    def drain():
        start_curation(
            log_stream(spark, source), output=out, checkpoint=str(tmp_path / "cp"), cfg=cfg,
            across_batches=across,
        ).awaitTermination()
        return sorted(r.log_id for r in spark.read.parquet(f"{out}/samples").collect())

    make_logs(spark, 20).write.parquet(source)
    first = drain()
    assert first == [f"log-{i:04d}" for i in range(20)]
    assert drain() == first
    # The second file repeats the text of log 0 under a new id.
    repeat = make_logs(spark, 1).filter("log_id = 'log-0000'").withColumn("log_id", F.lit("log-again"))
    make_logs(spark, 5, start=100).unionByName(repeat).write.mode("append").parquet(source)
    added = [f"log-{i:04d}" for i in range(100, 105)]
    assert drain() == sorted(first + added + ([] if across else ["log-again"]))


# --- folded state, pulls, batch hooks, failure states --------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def as_rows(df):
    return sorted(map(repr, df.collect()))


def run_history(spark, n=300, seed=2):
    import random

    draw = random.Random(seed)
    stages = ["curation", "finetuning", "evaluation", "promotion"]
    rows = []
    for i in range(n):
        stage = draw.choice([*stages, None])
        payload = (draw.choice(["running", "completed", "failed"]), None, None, i, None, None, None, None, None, None) if stage else None
        status = draw.choice(list(schemas.RUN_STATUSES))
        rows.append((f"run-{draw.randrange(12)}", draw.randrange(40), i, status, stage, payload, None, None, None, draw.randrange(2)))
    df = spark.createDataFrame(
        rows,
        f"run_id string, t long, seq long, status string, stage string, payload {schemas.STAGE_PAYLOAD}, "
        f"config {schemas.RUN_CONFIG}, triggered_by string, error string, attempt int",
    )
    return df.withColumn("at", F.timestamp_seconds("t")).drop("t")


def test_folded_runs_equal_the_whole_history(spark, tmp_path):
    """Late and repeated events, two folds, a segment key that comes twice; old files are left unread."""
    events = run_history(spark)
    kept = folded.run_events(spark, str(tmp_path / "runs"))
    order = [c.name for c in spark.createDataFrame([], schemas.RUN_EVENTS).schema]
    wanted = as_rows(runs.fold_runs(events, guarded=True))
    for part in range(5):
        piece = events.filter(F.col("seq") % 5 == 4 - part).select(order)  # in no order of time
        if part == 3:
            piece = piece.unionByName(events.filter("seq % 10 = 1").select(order))  # seen before
        kept.append(piece, f"part-{part}")
        kept.append(piece, f"part-{part}")
        if part in (1, 3):
            assert kept.fold() == part + 1
    assert as_rows(kept.read()) == wanted
    files = kept.read().inputFiles()
    old = [s.folder for s in kept.table.segments() if s.number <= 4]
    assert files and len(old) == 4 and not any(folder in f for f in files for folder in old)
    kept.table.vacuum()
    assert as_rows(kept.read()) == wanted and len(kept.table.segments()) == 3
    assert kept.fold() == 5 and as_rows(kept.read()) == wanted


def test_folded_experiments_never_fall_back(spark, tmp_path):
    def piece(*rows):
        df = spark.createDataFrame(rows, "experiment_id string, status string, error string, seq long, t long")
        at = F.timestamp_seconds("t")
        full = spark.createDataFrame([], folded.EXPERIMENT_EVENTS)
        return full.unionByName(df.withColumn("created_at", at).withColumn("updated_at", at).drop("t"), allowMissingColumns=True)

    kept = folded.experiment_events(spark, str(tmp_path / "experiments"))
    kept.append(piece(("a", "training", None, 1, 1), ("b", "pending_eval", None, 1, 1)))
    kept.append(piece(("a", "completed", None, 3, 9), ("b", "eval_failed", "boom", 3, 9)))
    kept.fold()
    kept.append(piece(("a", "pending_eval", None, 2, 20), ("b", "pending_eval", None, 2, 20)))
    got = {r.experiment_id: (r.status, r.error) for r in kept.read().collect()}
    assert got == {"a": ("completed", None), "b": ("eval_failed", "boom")}


def test_writers_that_overlap_take_numbers_in_turn(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from promptmill.sources.segments import SegmentTable

    table = SegmentTable(spark, str(tmp_path / "t"), "x long")
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: table.append(spark.range(i, i + 1).withColumnRenamed("id", "x")), range(8)))
    assert sorted(numbers) == list(range(1, 9))
    assert sorted(r.x for r in table.tail().collect()) == list(range(8))


def test_transitions():
    from promptmill.operators import lifecycle

    ranks = lifecycle.ranks(lifecycle.RUN_TRANSITIONS)
    for table in (lifecycle.RUN_TRANSITIONS, lifecycle.EXPERIMENT_TRANSITIONS):
        ranks = lifecycle.ranks(table)
        assert all(ranks[a] < ranks[b] for a, following in table.items() for b in following)
    lifecycle.check_transition("failed", "resuming")
    lifecycle.check_transition("evaluating", "completed")
    for now, then in (("completed", "resuming"), ("training", "curating"), ("pending", "promoting")):
        with pytest.raises(lifecycle.IllegalTransition):
            lifecycle.check_transition(now, then)


@pytest.mark.parametrize("n", [0, 1, 7, 299, 300, 1000])
def test_first_rows_of_any_number(spark, n):
    rows = [(f"k{i * 7919 % 300:04d}" if i % 3 else None, i * 31 % 50, i) for i in range(300)]
    df = spark.createDataFrame(rows, "s string, i int, id long").repartition(5)
    for order in (["s", "id"], ["i", "id"], ["id"]):
        wanted = sorted((tuple((r[c] is not None, r[c]) for c in order) for r in df.collect()))[:n]
        got = sorted(tuple((r[c] is not None, r[c]) for c in order) for r in ranks.first_rows(df, order, n).collect())
        assert got == wanted
    if n == 7:
        assert ranks._within_cut(df, "id", n).count() < 50


def test_pulls_read_open_files_only(spark, tmp_path):
    from promptmill.sources.pulls import LogPulls

    path, ledger = str(tmp_path / "logs"), str(tmp_path / "ledger")
    pulls = LogPulls(spark, path, ledger)
    assert pulls.open_logs().count() == 0 and pulls.unconsumed().count() == 0
    make_logs(spark, 30).repartition(3).write.parquet(path)
    whole = lambda: sorted(r.log_id for r in logs.read_unconsumed(spark.read.parquet(path), logs.read_ledger(spark, ledger)).collect())
    seen = lambda: sorted(r.log_id for r in pulls.unconsumed().collect())
    assert seen() == whole() and len(pulls.open_files()) == 3
    logs.append_ledger(pulls.unconsumed(), "run-1", ledger)
    pulls.settle()
    assert pulls.open_files() == [] and seen() == whole() == []
    # Late logs with old stamps come in a file of their own; the run takes a part of them.
    make_logs(spark, 10, start=500).withColumn("timestamp", F.timestamp_seconds(F.lit(5))).coalesce(1).write.mode("append").parquet(path)
    assert len(pulls.open_files()) == 1 and seen() == whole() and len(seen()) == 12
    logs.append_ledger(pulls.unconsumed(limit=5), "run-2", ledger)
    pulls.settle()
    assert len(pulls.open_files()) == 1 and seen() == whole() and len(seen()) == 7
    assert len([f for f in pulls.open_logs().inputFiles()]) == 1
    assert "PartitionFilters: [isnotnull(run_id" in plan_of(pulls.open_ledger()) and "run-1" in plan_of(pulls.open_ledger())
    logs.append_ledger(pulls.unconsumed(), "run-3", ledger)
    pulls.settle()
    assert pulls.open_files() == [] and pulls.open_ledger().count() == 0 and pulls.open_ledger(all_runs=True).count() == 44


def failing_hooks():
    """A model that cannot be reached and one that answers; local, so that their code travels to the workers."""

    def answers(model, prompts):
        if model == "unreachable":
            raise ConnectionError("model is gone")
        return [(f"{model} says {p}", 100.0, 10, 20) for p in prompts]

    def verdicts(system, prompts, attempt):
        return ['{"score": 5, "reason": "same"}'] * len(prompts)

    return answers, verdicts


def test_batch_hooks_isolate_errors(spark):
    from promptmill.responders import failures, judge_many, respond_many, unanswered

    def answers(model, prompts):
        assert len(prompts) <= 4
        if model == "bad":
            raise ConnectionError("gone")
        return [ValueError("odd") if p == "p-3" else (p.upper(), 1.0, 1, 2) for p in prompts]

    rows = [(f"e-{m}", f"s-{i}", m, "candidate", f"p-{i}") for m in ("good", "bad", "more") for i in range(10)]
    asked = spark.createDataFrame(rows, "experiment_id string, sample_id string, model_name string, role string, prompt string")
    got = respond_many(asked.repartition(3), answers, call_size=4, open_calls=2).collect()
    assert len(got) == 30
    by = {(r.experiment_id, r.sample_id): r for r in got}
    assert all(by["e-bad", f"s-{i}"].error == "ConnectionError: gone" for i in range(10))
    assert by["e-good", "s-3"].error == "ValueError: odd" and by["e-good", "s-3"].response is None
    assert by["e-more", "s-9"].response == "P-9" and by["e-more", "s-9"].error is None
    stored = spark.createDataFrame(got, respond_many(asked, answers).schema)
    assert unanswered(asked, stored).count() == 12
    assert {(r.experiment_id, r.failed) for r in failures(stored).collect()} == {("e-bad", 10), ("e-good", 1), ("e-more", 1)}
    healed = stored.unionByName(stored.filter("sample_id = 's-9'").withColumn("error", F.lit(None).cast("string")).filter("experiment_id = 'e-bad'"))
    assert {r.experiment_id: r.failed for r in failures(healed).collect()}["e-bad"] == 9

    def ask(system, prompts, attempt):
        if attempt == 1:
            raise TimeoutError("slow")
        return ["no" if "P-1" in p and attempt == 2 else '{"score": 3}' for p in prompts]

    pairs = asked.select("experiment_id", "sample_id", "prompt", F.upper("prompt").alias("reference"), F.col("prompt").alias("candidate"))
    replies = judge_many(pairs, ask, lambda r: r.startswith("{"), call_size=3).collect()
    assert sum(r.error is not None for r in replies) == 30
    assert {r.attempt for r in replies if r.sample_id == "s-1"} == {1, 2, 3}
    assert {r.attempt for r in replies if r.sample_id == "s-2"} == {1, 2}

    def short(model, prompts):
        return []

    assert respond_many(asked, short).filter("error LIKE 'ValueError%'").count() == 30


def test_one_failing_experiment_leaves_the_others(spark, tmp_path, monkeypatch):
    from promptmill.config import Candidate

    answers, verdicts = failing_hooks()
    offered = (Candidate("a", "model-a", None, ("icl",), "x"), Candidate("b", "unreachable", None, ("icl",), "x"), Candidate("c", "model-c", None, ("icl",), "x"))
    table = cycle.ex.candidates_table
    monkeypatch.setattr(cycle.ex, "candidates_table", lambda session: table(session, offered))
    ws = cycle.Workspace(str(tmp_path))
    make_logs(spark, 60).write.parquet(ws.path("logs"))
    run_id = cycle.register_run(spark, ws)
    options = {"curation": CurationConfig(min_quality_score=0.3), "batched": True}
    is_json = lambda raw: raw.startswith("{")
    decision = cycle.run_cycle(spark, ws, run_id, answers, verdicts, is_json, **options)
    states = {r.model_id + "/" + r.experiment_type: (r.status, r.error) for r in cycle.ex_of_run(spark, ws, run_id).collect()}
    failed = [k for k, (status, _) in states.items() if status == "eval_failed"]
    done = [k for k, (status, _) in states.items() if status == "completed"]
    assert decision["promoted"] and failed == ["b/icl"] and sorted(done) == ["a/icl", "c/icl"]
    assert states["b/icl"][1] == "ConnectionError: model is gone"
    run = runs.get_run(cycle.read_runs(spark, ws), run_id).first()
    assert run.stages["evaluation"].best_candidate == decision["promoted_model_id"]
    assert len(run.stages["finetuning"].experiments) == len(states)


def test_late_training_is_evaluated_in_the_same_run(spark, tmp_path):
    def reply(model, prompt):
        return f"{model} says {prompt}", 100.0, 10, 20

    def verdict(system, prompt, attempt):
        return '{"score": 5, "reason": "same"}'

    ws = cycle.Workspace(str(tmp_path))
    make_logs(spark, 60).write.parquet(ws.path("logs"))
    run_id = cycle.register_run(spark, ws)
    is_json = lambda raw: raw.startswith("{")
    options = {"curation": CurationConfig(min_quality_score=0.3), "wait_for_training": True}
    waiting = cycle.run_cycle(spark, ws, run_id, reply, verdict, is_json, **options)
    assert waiting["reason"] == "waiting_for_training" and waiting["training"] == 3
    assert runs.get_run(cycle.read_runs(spark, ws), run_id).first().status == "evaluating"
    trained = cycle.ex_of_run(spark, ws, run_id).filter("status = 'training'").select("experiment_id").collect()
    said = [(trained[0][0], "pending_eval", "repo/1", None), (trained[1][0], "pending_eval", "repo/2", None), (trained[2][0], "failed", None, "no GPU")]
    reports_ = spark.createDataFrame(said, "experiment_id string, status string, adapter_repo_id string, error string")
    cycle.report_training(spark, ws, reports_)
    cycle.fold_state(spark, ws)
    decision = cycle.run_cycle(spark, ws, run_id, reply, verdict, is_json, **options)
    assert decision["promoted"]
    cycle.report_training(spark, ws, reports_)  # once more, late
    states = sorted(((r.experiment_type, r.status, r.adapter_repo_id) for r in cycle.ex_of_run(spark, ws, run_id).collect()), key=str)
    assert states[:3] == [("icl", "completed", None)] * 3
    assert states[3:] == [("lora_sft", "completed", "repo/1"), ("lora_sft", "completed", "repo/2"), ("lora_sft", "failed", None)]
    run = runs.get_run(cycle.read_runs(spark, ws), run_id).first()
    assert (run.status, run.attempt) == ("completed", 1)


def test_a_stage_that_raises_leaves_a_failed_run(spark, tmp_path, monkeypatch):
    def reply(model, prompt):
        return f"{model} says {prompt}", 100.0, 10, 20

    def verdict(system, prompt, attempt):
        return '{"score": 5, "reason": "same"}'

    ws = cycle.Workspace(str(tmp_path))
    make_logs(spark, 60).write.parquet(ws.path("logs"))
    run_id = cycle.register_run(spark, ws)
    is_json = lambda raw: raw.startswith("{")
    options = {"curation": CurationConfig(min_quality_score=0.3)}
    with monkeypatch.context() as patched:
        patched.setattr(cycle.ex, "plan_experiments", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            cycle.run_cycle(spark, ws, run_id, reply, verdict, is_json, **options)
    point = runs.resume_points(runs.get_run(cycle.read_runs(spark, ws), run_id)).first()
    assert (point.status, point.resume_from) == ("failed", "finetuning") and "ZeroDivisionError" in point.error
    assert point.carried.dataset_id == f"dataset-{run_id}"
    assert cycle.run_cycle(spark, ws, run_id, reply, verdict, is_json, **options)["promoted"]
    run = runs.get_run(cycle.read_runs(spark, ws), run_id).first()
    assert (run.status, run.attempt) == ("completed", 1)


def test_a_dead_batch_is_repeated_without_loss(spark, tmp_path, monkeypatch):
    """A batch that dies between its samples and its bands, a restart, and a source that grows meanwhile."""
    from promptmill.streaming.band_index import BandIndex

    source, out = str(tmp_path / "logs"), str(tmp_path / "out")
    cfg = CurationConfig(min_quality_score=0.3, remove_pii=False)

    def drain(**more):
        query = start_curation(
            log_stream(spark, source, maxFilesPerTrigger="1"), output=out, checkpoint=str(tmp_path / "cp"), cfg=cfg,
            across_batches=True, fold_every=2, prefix_bits=3, **more,
        )
        query.awaitTermination()

    for start in (0, 100, 200):
        make_logs(spark, 8, start=start).coalesce(1).write.mode("append").parquet(source)
    add = BandIndex.add
    with monkeypatch.context() as patched:
        def dies(self, batch_id, keys):
            if batch_id == 1:
                raise RuntimeError("lost")
            add(self, batch_id, keys)

        patched.setattr(BandIndex, "add", dies)
        with pytest.raises(Exception, match="lost"):
            drain()
    again = make_logs(spark, 1).filter("log_id = 'log-0000'").withColumn("log_id", F.lit("log-again"))
    make_logs(spark, 8, start=300).unionByName(again).coalesce(1).write.mode("append").parquet(source)
    drain()
    got = sorted(r.log_id for r in spark.read.parquet(f"{out}/samples").collect())
    assert got == [f"log-{start + i:04d}" for start in (0, 100, 200, 300) for i in range(8)]
    index = BandIndex(spark, f"{out}/bands", 3, 2)
    assert index.table.base() is not None
    one = index.table.read_base().limit(1).cache()
    before = index.before(99, one)
    assert before.join(one, ["h1", "h2"]).count() == 1
    plan = plan_of(before)
    assert "PartitionFilters: [isnotnull(prefix#" in plan and f" = {one.first().prefix})]" in plan
    assert index.prefixes(one) == [one.first().prefix]
