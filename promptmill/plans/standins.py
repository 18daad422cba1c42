"""Stand-ins: the benchmark tables seen as logs, responses, verdicts and run events.

Everything is derived from whole tables by column expressions, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill import schemas
from promptmill.operators.evaluate import (
    evaluate_experiments,
    first_verdicts,
    pricing_table,
)
from promptmill.session import spread

# Which model, price row and experiment type an event type stands for.
EVENT_MODELS = {
    "click": ("qwen-0.5b", "llama-3.1-8b-instant", "icl"),
    "view": ("qwen-1.5b", "openai/gpt-oss-20b", "icl"),
    "purchase": ("qwen-3b", "llama-3.3-70b-versatile", "icl"),
    "signup": ("qwen-0.5b", "unlisted-model", "lora_sft"),
    "error": ("qwen-1.5b", "unlisted-model", "lora_sft"),
}
EVENT_STAGES = {
    "click": ("curation", "curating"),
    "view": ("finetuning", "training"),
    "purchase": ("evaluation", "evaluating"),
    "signup": ("promotion", "completed"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(scan, keep=name == "documents") if name in ("documents", "conversations", "events") else scan


def lookup(key: Column, entries: dict, item: int) -> Column:
    """A chained ``when`` over a small fixed dictionary."""
    result = F.lit(None).cast("string")
    for name, values in reversed(entries.items()):
        result = F.when(key == name, F.lit(values[item])).otherwise(result)
    return result


def document_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as log rows with an empty prompt."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("log_id"),
        F.lit("").alias("prompt"),
        F.col("text").alias("response"),
        F.col("source").alias("model"),
    )


def conversation_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the assistant turn right after it.

    A join on (conversation, turn) rather than a window, so one huge conversation spreads out.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("prompt"), (F.col("turn") + 1).alias("_reply")
    )
    answered = turns.filter("role = 'assistant'").select(
        "conv_id", F.col("turn").alias("_reply"), F.col("text").alias("response")
    )
    pairs = asked.join(answered, ["conv_id", "_reply"])
    return pairs.select(
        F.format_string("%08d-%04d", "conv_id", "turn").alias("log_id"),
        "conv_id",
        "prompt",
        "response",
        F.lit("llama-3.1-8b").alias("model"),
    )


def consumed_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of conversations that open with a system turn count as already consumed."""
    opened = table(spark, sf_dir, "conversations").filter("role = 'system'").select("conv_id").distinct()
    logs = conversation_logs(spark, sf_dir)
    return logs.join(opened, "conv_id", "left_semi").select(
        "log_id", F.lit("run-0").alias("run_id"), F.lit(None).cast("timestamp").alias("consumed_at")
    )


def full_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation pairs with every log column."""
    return conversation_logs(spark, sf_dir).select(
        "log_id", "prompt", "response", "model",
        F.length("response").alias("latency_ms"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id")).alias("timestamp"),
        F.col("conv_id").cast("string").alias("session_id"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").withColumn("k", k)


def experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One experiment per user and event type; the user is the run."""
    kind = F.col("event_type")
    return (
        _events(spark, sf_dir)
        .groupBy("user_id", "event_type")
        .agg(F.min("event_id").alias("seq"), F.min("ts").alias("created_at"))
        .select(
            experiment_id().alias("experiment_id"),
            run_id().alias("run_id"),
            lookup(kind, EVENT_MODELS, 0).alias("model_id"),
            lookup(kind, EVENT_MODELS, 1).alias("model_name"),
            lookup(kind, EVENT_MODELS, 2).alias("experiment_type"),
            F.lit(None).cast("string").alias("adapter_repo_id"),
            F.lit("pending_eval").alias("status"),
            "seq",
            "created_at",
        )
    )


def run_id() -> Column:
    return F.concat(F.lit("run-"), F.col("user_id").cast("string"))


def experiment_id() -> Column:
    return F.concat_ws("-", F.lit("exp"), F.col("user_id").cast("string"), "event_type")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candidate response per event."""
    return _events(spark, sf_dir).select(
        experiment_id().alias("experiment_id"),
        F.col("event_id").cast("string").alias("sample_id"),
        lookup(F.col("event_type"), EVENT_MODELS, 1).alias("model_name"),
        F.lit("candidate").alias("role"),
        F.col("props").alias("response"),
        F.col("value").alias("latency_ms"),
        F.col("k").alias("input_tokens"),
        (F.col("event_id") % 100).cast("int").alias("output_tokens"),
        "event_type",
    )


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three raw judge replies per event, of ten shapes, readable and not."""
    k, shape = F.col("k"), (F.col("k") + 3 * (F.col("attempt") - 1)) % 10
    raw = (
        F.when(shape == 0, "not valid json at all")
        .when(shape == 1, '{"score": 99, "reason": "off the scale"}')
        .when(shape == 2, '{"score": "4", "reason": "text"}')
        .when(shape == 3, '{"score": 4.7}')
        .when(shape == 4, '{"score": "4.5", "reason": "not an integer"}')
        .when(shape == 5, '{"score": null}')
        .when(shape == 6, "[1]")
        .when(shape == 7, '{"score": 3} trailing')
        .when(shape == 8, '{"score": true, "reason": "boolean"}')
        .otherwise(
            F.concat(
                F.lit('{"score": '), (F.floor(k / 20) + 1).cast("string"),
                F.lit(', "reason": "r'), k.cast("string"), F.lit('"}'),
            )
        )
    )
    return (
        _events(spark, sf_dir)
        .withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
        .select(
            experiment_id().alias("experiment_id"),
            F.col("event_id").cast("string").alias("sample_id"),
            "attempt",
            raw.alias("raw"),
            "event_type",
        )
    )


def evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate_experiments(
        experiments(spark, sf_dir),
        responses(spark, sf_dir),
        first_verdicts(verdicts(spark, sf_dir)),
        pricing_table(spark),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluations as the promotion stage receives them, with their order in the run."""
    order = experiments(spark, sf_dir).select("experiment_id", "seq")
    return (
        evaluations(spark, sf_dir)
        .withColumnRenamed("cost_per_1k_tokens_usd", "cost_per_1k_tokens")
        .join(order, "experiment_id")
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as state changes of runs; an ``error`` event fails the run."""
    kind, k = F.col("event_type"), F.col("k").cast("bigint")
    stage = lookup(kind, EVENT_STAGES, 0)
    outcome = F.when(k >= 30, "completed").when(k >= 15, "skipped").otherwise("running")
    text = lambda value: value.cast("string")
    payload = F.struct(
        outcome.alias("status"),
        text(F.lit(None)).alias("reason"),
        text(F.lit(None)).alias("error"),
        (k * 10).alias("logs_pulled"),
        (k * 7).alias("samples_after_filter"),
        (k * 5).alias("samples_after_dedup"),
        F.when(k >= 30, F.concat(F.lit("dataset-"), text(F.col("event_id")))).alias("dataset_id"),
        F.array(F.concat(F.lit("exp-"), text(F.col("event_id")))).alias("experiments"),
        text(F.col("event_id")).alias("best_candidate"),
        (k >= 90).alias("promoted"),
    ).cast(schemas.STAGE_PAYLOAD)
    return _events(spark, sf_dir).select(
        run_id().alias("run_id"),
        F.col("ts").alias("at"),
        F.col("event_id").alias("seq"),
        F.coalesce(lookup(kind, EVENT_STAGES, 1), F.lit("failed")).alias("status"),
        stage.alias("stage"),
        F.when(stage.isNotNull(), payload).alias("payload"),
        F.lit(None).cast(schemas.RUN_CONFIG).alias("config"),
        F.lit(None).cast("string").alias("triggered_by"),
        F.when(kind == "error", F.lit("failed event")).alias("error"),
    )
