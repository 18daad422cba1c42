"""Keep or drop log rows, with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.config import CurationConfig
from promptmill.functions.binding import bind
from promptmill.functions.redact import redact_pii
from promptmill.functions.text import (
    TOKENS_PER_WORD,
    is_toxic,
    quality_score,
    sample_text,
    words,
)

# The reasons in the order of their checks.
DROP_REASONS = ("too_short", "too_long", "low_quality", "toxic")


def drop_reason(
    cfg: CurationConfig = CurationConfig(),
    prompt: Column | None = None,
    response: Column | None = None,
) -> Column:
    """The first failing check, cheapest first; null keeps the row."""
    prompt = F.coalesce(F.col("prompt") if prompt is None else prompt, F.lit(""))
    response = F.coalesce(F.col("response") if response is None else response, F.lit(""))

    def check_sample(sample: Column) -> Column:
        text, tokens = sample["text"], sample["tokens"]
        tokens_estimate = F.size(tokens) * F.lit(TOKENS_PER_WORD)
        return (
            F.when(tokens_estimate > F.lit(float(cfg.max_token_length)), "too_long")
            .when(quality_score(text, tokens) < F.lit(float(cfg.min_quality_score)), "low_quality")
            .when(is_toxic(text, cfg.blocklist), "toxic")
        )

    def check(answer: Column) -> Column:
        # A blank joins the two sides, so the words of the sample are the words of both.
        sample = F.struct(
            sample_text(prompt, response).alias("text"),
            F.concat(words(prompt), answer).alias("tokens"),
        )
        return F.when(F.size(answer) < cfg.min_response_length, "too_short").otherwise(
            bind(sample, check_sample)
        )

    return bind(words(response), check)


def tag_logs(logs: DataFrame, cfg: CurationConfig = CurationConfig()) -> DataFrame:
    return logs.withColumn("drop_reason", drop_reason(cfg))


def filter_logs(logs: DataFrame, cfg: CurationConfig = CurationConfig()) -> DataFrame:
    """The kept rows, personal data replaced. Redaction comes after all checks and drops nothing."""
    kept = tag_logs(logs, cfg).filter(F.col("drop_reason").isNull()).drop("drop_reason")
    return redact_logs(kept, cfg)


def redact_logs(logs: DataFrame, cfg: CurationConfig = CurationConfig()) -> DataFrame:
    if not cfg.remove_pii:
        return logs
    return logs.withColumns({name: redact_pii(F.col(name)) for name in ("prompt", "response")})


def drop_counts(tagged: DataFrame) -> DataFrame:
    """Rows per drop reason; kept rows count as ``kept``."""
    return tagged.groupBy(
        F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")
    ).agg(F.count("*").alias("n"))


def drop_rate(tagged: DataFrame) -> DataFrame:
    dropped = F.count("drop_reason")
    total = F.count("*")
    return tagged.agg(
        total.alias("total"),
        (total - dropped).alias("kept"),
        dropped.alias("dropped"),
        F.when(total > 0, dropped / total * F.lit(100.0)).alias("drop_rate_pct"),
    )
