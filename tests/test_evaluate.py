import random
import statistics

import pytest
from pyspark.sql import functions as F

from promptmill.config import Criteria
from promptmill.functions.verdicts import judge_prompt, parse_verdict
from promptmill.operators import evaluate as ev
from promptmill.operators import gate, ranks


def latencies(spark, values):
    return spark.createDataFrame([("e", float(v)) for v in values], "k string, latency_ms double")


def model_latency(values):
    ordered, n = sorted(values), len(values)
    picks = [round(ordered[min(int(p / 100 * n), n - 1)], 2) for p in (50, 95, 99)]
    return [*picks, round(statistics.mean(values), 2)]


@pytest.mark.parametrize(
    "values, expected",
    [
        ([100, 200, 300, 400, 500, 600, 700, 800, 900, 1000], [600, 1000, 1000, 550]),
        ([250.0], [250, 250, 250, 250]),
    ],
)
def test_latency_cases(spark, values, expected):
    row = ev.latency_stats(latencies(spark, values), ["k"]).first()
    assert [row.p50_ms, row.p95_ms, row.p99_ms, row.mean_ms] == expected


@pytest.mark.parametrize("sketch", [20_000, 50, 2])
def test_latency_of_hot_and_small_groups(spark, monkeypatch, sketch):
    """However coarse the sketch, with ties and one group of a third of all rows."""
    monkeypatch.setattr(ranks, "_SKETCH", sketch)
    rng = random.Random(3)
    groups = {"hot": [rng.expovariate(0.01) for _ in range(3000)], "ties": [7.0] * 900 + [9.0] * 100}
    groups |= {f"g{i}": [rng.uniform(0, 1000) for _ in range(rng.randrange(1, 60))] for i in range(40)}
    rows = [(k, v) for k, values in groups.items() for v in values]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, latency_ms double").repartition(6)
    got = {r.k: [r.p50_ms, r.p95_ms, r.p99_ms, r.mean_ms] for r in ev.latency_stats(df, ["k"]).collect()}
    assert got == {k: model_latency(v) for k, v in groups.items()}


def cost(spark, model, tokens_in, tokens_out):
    rows = [("e", model, tokens_in, tokens_out)]
    df = spark.createDataFrame(rows, "e string, model_name string, input_tokens int, output_tokens int")
    return ev.cost_stats(df, ev.pricing_table(spark), ["e", "model_name"]).first()


def test_cost(spark):
    known = cost(spark, "llama-3.1-8b-instant", 10_000, 5_000)
    assert known.total_cost_usd == round(10_000 / 1e6 * 0.05 + 5_000 / 1e6 * 0.08, 6)
    assert (known.total_input_tokens, known.total_output_tokens) == (10_000, 5_000)
    unknown = cost(spark, "no-such-model", 1_000, 1_000)
    assert (unknown.total_cost_usd, unknown.cost_per_1k_tokens_usd) == (0.0002, 0.0001)
    nothing = cost(spark, "llama-3.1-8b-instant", 0, 0)
    assert (nothing.total_cost_usd, nothing.cost_per_1k_tokens_usd) == (0.0, 0.0)


@pytest.mark.parametrize(
    "raw, verdict",
    [
        ('{"score": 4, "reason": "mostly equivalent"}', (4, "mostly equivalent")),
        ('{"score": 99, "reason": "off"}', (5, "off")),
        ('{"score": -3}', (1, "")),
        ('{"score": "4"}', (4, "")),
        ('{"score": " +4 "}', (4, "")),
        ('{"score": 4.7}', (4, "")),
        ('{"score": 1e30}', (5, "")),
        ('{"score": true}', (1, "")),
        ('{"score": 2, "reason": null}', (2, None)),
        ('  {"score": 2}\n', (2, "")),
        ('{"score": "4.5"}', None),
        ('{"score": null}', None),
        ('{"score": [1]}', None),
        ('{"reason": "no score"}', None),
        ("[1]", None),
        ("3", None),
        ("not json", None),
        ("", None),
        (None, None),
        ('{"score": 3} trailing', None),
        ('{"score": 3}{"score": 4}', None),
        ('{"score": 3}] [{"x": 1}', None),
        ('{"score": 3}} {"v": {"score": 1}', None),
        ('{"score": 3},{"score": 4}', None),
    ],
)
def test_verdicts(spark, raw, verdict):
    df = spark.createDataFrame([(raw,)], "raw string")
    got = df.select(parse_verdict(F.col("raw"))).first()[0]
    assert (None if got is None else tuple(got)) == verdict


def test_first_readable_attempt_wins(spark):
    rows = [
        ("e", "s1", 1, "bad"), ("e", "s1", 2, '{"score": 2}'), ("e", "s1", 3, '{"score": 5}'),
        ("e", "s2", 1, "bad"), ("e", "s2", 2, "bad"), ("e", "s2", 3, "bad"),
    ]
    raw = spark.createDataFrame(rows, "experiment_id string, sample_id string, attempt int, raw string")
    got = {r.sample_id: (r.score, r.reason) for r in ev.first_verdicts(raw).collect()}
    assert got == {"s1": (2, ""), "s2": (1, "parse_error")}


@pytest.mark.parametrize(
    "scores, mean, wins",
    [([4, 5, 4], 4.3333, 1.0), ([1, 2, 3], 2.0, 0.0), ([4, 3], 3.5, 0.5), ([1, 3, 5, 5], 3.5, 0.5)],
)
def test_judge_summary(spark, scores, mean, wins):
    df = spark.createDataFrame([("e", s) for s in scores], "experiment_id string, score int")
    row = ev.judge_summary(df, ["experiment_id"]).first()
    assert (row.sample_count, row.mean_score, row.win_rate) == (len(scores), mean, wins)
    assert row.score_distribution == {s: scores.count(s) for s in range(1, 6)}


def test_empty_summary_is_zero(spark):
    df = spark.createDataFrame([], "experiment_id string, score int")
    row = ev.judge_summary(df, []).first()
    assert (row.sample_count, row.mean_score, row.win_rate, row.score_distribution) == (0, 0.0, 0.0, {})


def test_experiment_without_responses_fails_the_gate(spark):
    exp = spark.createDataFrame(
        [("e1", "m", "x", "r", "icl", None)],
        "experiment_id string, model_id string, model_name string, run_id string, "
        "experiment_type string, adapter_repo_id string",
    )
    from promptmill import schemas

    none = spark.createDataFrame([], schemas.RESPONSES)
    verdicts = spark.createDataFrame([], "experiment_id string, sample_id string, score int, reason string")
    row = ev.evaluate_experiments(exp, none, verdicts, ev.pricing_table(spark))
    first = row.first()
    assert (first.accuracy, first.latency_p95_ms, first.sample_count) == (0.0, None, 0)
    scored = row.withColumnRenamed("cost_per_1k_tokens_usd", "cost_per_1k_tokens")
    assert scored.select(gate.passes_criteria()).first()[0] is False


def test_judge_prompt_wording(spark):
    got = spark.range(1).select(judge_prompt(F.lit("p"), F.lit("r"), F.lit("c"))).first()[0]
    assert got == (
        "Prompt: p\n\nReference response: r\n\nCandidate response: c\n\nScore the Candidate response."
    )


def test_pairing(spark):
    rows = [
        ("e1", "s1", "teacher", "T1"), ("e2", "s1", "teacher", "T2"), ("e1", "s1", "candidate", "A"),
        ("e2", "s1", "candidate", "B"), ("e1", "s2", "candidate", "alone"),
    ]
    df = spark.createDataFrame(rows, "experiment_id string, sample_id string, role string, response string")
    got = {(r.experiment_id, r.candidate, r.reference) for r in ev.pair_responses(df).collect()}
    assert got == {("e1", "A", "T1"), ("e2", "B", "T1")}


# --- gate ----------------------------------------------------------------------------------------

STRICT = Criteria(0.85, 800, 0.02, 100)
SCORED = (
    "run_id string, experiment_id string, model_name string, accuracy double, latency_p95_ms double, "
    "cost_per_1k_tokens double, sample_count long, seq int"
)


@pytest.mark.parametrize(
    "metrics, failed",
    [
        ((0.90, 600.0, 0.01, 150), {}),
        ((0.85, 800.0, 0.02, 100), {}),
        ((0.70, 600.0, 0.01, 150), {"accuracy": "0.700 < required 0.85"}),
        ((0.90, 1200.0, 0.01, 150), {"latency": "1200ms > max 800ms"}),
        ((0.90, 600.0, 0.05, 150), {"cost": "$0.05000 > max $0.02"}),
        ((0.90, 600.0, 0.01, 50), {"sample_size": "50 < required 100"}),
        (
            (0.8125, 2000.5, 0.10, 10),
            {
                "accuracy": "0.812 < required 0.85", "latency": "2000ms > max 800ms",
                "cost": "$0.10000 > max $0.02", "sample_size": "10 < required 100",
            },
        ),
        (
            (None, None, None, None),
            {
                "accuracy": "0.000 < required 0.85", "latency": "infms > max 800ms",
                "cost": "$inf > max $0.02", "sample_size": "0 < required 100",
            },
        ),
    ],
)
def test_criteria(spark, metrics, failed):
    df = spark.createDataFrame([("r", "e", "m", *metrics, 1)], SCORED)
    passed, reasons = df.select(gate.passes_criteria(STRICT), gate.failure_reasons(STRICT)).first()
    assert (passed, reasons) == (not failed, failed)


def test_best_candidate_and_decisions(spark):
    rows = [
        ("r1", "a", "m1", 0.9, 100.0, 0.010, 200, 1), ("r1", "b", "m2", 0.9, 100.0, 0.005, 200, 2),
        ("r1", "c", "m3", 0.9, 100.0, 0.005, 200, 3), ("r2", "d", "m4", 0.5, 100.0, 0.001, 200, 1),
    ]
    scored = spark.createDataFrame(rows, SCORED)
    assert {r.run_id: r.experiment_id for r in gate.best_candidate(scored).collect()} == {"r1": "b", "r2": "d"}
    all_runs = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "run_id string")
    got = {r.run_id: r for r in gate.promotion_decisions(all_runs, scored, STRICT).collect()}
    assert (got["r1"].promoted, got["r1"].promoted_model_id, got["r1"].reason) == (True, "b", None)
    assert (got["r2"].promoted, got["r2"].reason) == (False, "criteria_not_met")
    assert got["r2"].detail == {"accuracy": "0.500 < required 0.85"}
    assert (got["r3"].promoted, got["r3"].reason) == (False, "no_candidate")


@pytest.mark.parametrize("logs, status", [(100, "skipped"), (499, "skipped"), (500, "started"), (750, "started")])
def test_readiness(spark, logs, status):
    row = gate.readiness(spark.createDataFrame([(logs,)], "new_logs long"), 500).first()
    assert (row.status, row.new_logs, row.min_required) == (status, logs, 500)
    assert row.reason == ("insufficient_logs" if status == "skipped" else None)
