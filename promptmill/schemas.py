"""Explicit schemas; nothing is inferred when these tables are read."""

from __future__ import annotations

INFERENCE_LOGS = (
    "log_id STRING, prompt STRING, response STRING, model STRING, latency_ms INT, "
    "timestamp TIMESTAMP, session_id STRING"
)
LEDGER = "log_id STRING, run_id STRING, consumed_at TIMESTAMP"
DATASETS = "dataset_id STRING, run_id STRING, created_at TIMESTAMP, sample_count BIGINT"
CANDIDATES = (
    "id STRING, provider STRING, model STRING, hf_model STRING, "
    "experiments ARRAY<STRING>, target STRING"
)
METRICS = (
    "STRUCT<accuracy: DOUBLE, mean_score: DOUBLE, latency_p95_ms: DOUBLE, "
    "cost_per_1k_tokens_usd: DOUBLE>"
)
EXPERIMENTS = (
    "experiment_id STRING, run_id STRING, model_id STRING, model_name STRING, "
    "hf_model STRING, experiment_type STRING, status STRING, dataset_id STRING, "
    "adapter_repo_id STRING, created_at TIMESTAMP, updated_at TIMESTAMP, "
    f"completed_at TIMESTAMP, metrics {METRICS}, promoted BOOLEAN, error STRING"
)
RESPONSES = (
    "experiment_id STRING, sample_id STRING, model_name STRING, role STRING, "
    "response STRING, latency_ms DOUBLE, input_tokens INT, output_tokens INT"
)
VERDICTS = "experiment_id STRING, sample_id STRING, attempt INT, raw STRING"
PRICING = "model_name STRING, input_usd_per_m DOUBLE, output_usd_per_m DOUBLE"
REGISTRY_METRICS = (
    "STRUCT<accuracy: DOUBLE, mean_score: DOUBLE, latency_p95_ms: DOUBLE, "
    "cost_per_1k_tokens: DOUBLE, total_cost_usd: DOUBLE, sample_count: BIGINT>"
)
MODEL_REGISTRY = (
    "model_id STRING, model_name STRING, provider STRING, run_id STRING, "
    f"experiment_id STRING, status STRING, metrics {REGISTRY_METRICS}, "
    "created_at TIMESTAMP, updated_at TIMESTAMP, promoted_at TIMESTAMP, archived_at TIMESTAMP"
)
STAGE_PAYLOAD = (
    "STRUCT<status: STRING, reason: STRING, error: STRING, logs_pulled: BIGINT, "
    "samples_after_filter: BIGINT, samples_after_dedup: BIGINT, dataset_id: STRING, "
    "experiments: ARRAY<STRING>, best_candidate: STRING, promoted: BOOLEAN>"
)
RUN_CONFIG = "STRUCT<run_icl: BOOLEAN, run_lora_sft: BOOLEAN, dry_run: BOOLEAN>"
RUN_EVENTS = (
    "run_id STRING, at TIMESTAMP, seq BIGINT, status STRING, stage STRING, "
    f"payload {STAGE_PAYLOAD}, config {RUN_CONFIG}, triggered_by STRING, error STRING, attempt INT"
)
METRIC_LOG = "run_name STRING, tags MAP<STRING, STRING>, key STRING, value DOUBLE"

# The stages of a run in order, and the status a run has while in each.
STAGES = ("curation", "finetuning", "evaluation", "promotion")
STAGE_STATUS = {
    "curation": "curating",
    "finetuning": "training",
    "evaluation": "evaluating",
    "promotion": "promoting",
}
RUN_STATUSES = (
    "pending", "curating", "training", "evaluating", "promoting", "completed", "failed", "resuming",
)
EXPERIMENT_STATUSES = ("training", "pending_eval", "completed", "failed", "eval_failed")
REGISTRY_STATUSES = ("candidate", "production", "archived")
EXPERIMENT_TYPES = ("icl", "lora_sft")
