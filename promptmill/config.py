"""Parameters of a cycle. Defaults are the published configuration values."""

from __future__ import annotations

from dataclasses import dataclass

from promptmill.functions.text import BLOCKLIST


# The published defaults.
@dataclass(frozen=True)
class CurationConfig:
    min_quality_score: float = 0.7
    max_token_length: int = 2048
    min_response_length: int = 20
    dedup_threshold: float = 0.85
    remove_pii: bool = True
    max_samples: int | None = None
    blocklist: tuple[str, ...] = BLOCKLIST
    # A sample falls on a shared band, as published; True compares the texts as well.
    verify_duplicates: bool = False


# The published thresholds.
@dataclass(frozen=True)
class Criteria:
    min_accuracy: float = 0.85
    max_latency_p95_ms: float = 1500
    max_cost_per_1k_tokens: float = 0.02
    min_eval_sample_size: int = 50


@dataclass(frozen=True)
class RunConfig:
    run_icl: bool = True
    run_lora_sft: bool = True
    dry_run: bool = False


@dataclass(frozen=True)
class Candidate:
    id: str
    model: str
    hf_model: str | None
    experiments: tuple[str, ...]
    target: str
    provider: str = "groq"


MIN_NEW_LOGS = 500
# The published candidate list and the teacher, which also judges.
TEACHER_MODEL = "llama-3.3-70b-versatile"
CANDIDATES = (
    Candidate("qwen-0.5b", "llama-3.1-8b-instant", "Qwen/Qwen2.5-0.5B", ("icl", "lora_sft"), "low_cost"),
    Candidate("qwen-1.5b", "llama-3.1-8b-instant", "Qwen/Qwen2.5-1.5B", ("icl", "lora_sft"), "balanced"),
    Candidate("qwen-3b", "llama-3.1-8b-instant", "Qwen/Qwen2.5-3B", ("icl", "lora_sft"), "high_accuracy"),
)

# USD per million tokens (model, input, output) and the price of other models.
PRICING = (
    ("llama-3.3-70b-versatile", 0.59, 0.79),
    ("llama-3.1-8b-instant", 0.05, 0.08),
    ("openai/gpt-oss-120b", 0.15, 0.60),
    ("openai/gpt-oss-20b", 0.075, 0.30),
)
DEFAULT_PRICE = 0.10

# What the judge model is told.
JUDGE_SYSTEM_PROMPT = """You are an impartial AI evaluator. Your task is to compare two responses to the same prompt and score the Candidate response relative to the Reference response.

Score the Candidate on a scale of 1-5:
  5 - Equivalent or better than Reference: fully accurate, complete, and coherent
  4 - Mostly equivalent: minor omissions or wording differences only
  3 - Partially equivalent: correct direction but missing key details
  2 - Weak: significant inaccuracies or missing important content
  1 - Poor: incorrect, incoherent, or completely off-topic

Respond with ONLY a JSON object in this exact format:
{"score": <1-5>, "reason": "<one sentence explanation>"}"""
