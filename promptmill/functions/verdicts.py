"""Judge prompts and the strict reading of judge replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from promptmill.functions.binding import bind


def judge_prompt(prompt: Column, reference: Column, candidate: Column) -> Column:
    # The wording of the judge request.
    return F.concat(
        F.lit("Prompt: "), prompt,
        F.lit("\n\nReference response: "), reference,
        F.lit("\n\nCandidate response: "), candidate,
        F.lit("\n\nScore the Candidate response."),
    )


def parse_verdict(raw: Column) -> Column:
    """``STRUCT<score INT, reason STRING>`` of one reply, null when it is not a valid verdict.

    The JSON parsers here ignore text after the first value. A reply is therefore read twice, as
    the only element of an array and as the only field of an object; no trailing text closes both.
    Scores may be numbers (truncated), booleans or integer text and are clamped to 1..5.
    """
    in_array = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), raw, F.lit("}")))

    def fields(document: Column) -> Column:
        return F.struct(
            F.schema_of_variant(F.try_variant_get(document, "$.v.score", "variant")).alias("kind"),
            F.try_variant_get(document, "$.v.score", "string").alias("score"),
            F.try_variant_get(document, "$.v.reason", "variant").isNotNull().alias("reasoned"),
            F.try_variant_get(document, "$.v.reason", "string").alias("reason"),
        )

    def verdict(found: Column) -> Column:
        kind, text = found["kind"], found["score"]
        number = (
            F.when(kind == "BOOLEAN", F.lit(1.0))
            .when(kind.rlike("^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$"), text.try_cast("double"))
            .when(
                (kind == "STRING") & text.rlike(r"(?U)^\s*[+-]?[0-9]++(?:_[0-9]++)*+\s*$"),
                F.regexp_replace(text, r"(?U)[\s_]", "").try_cast("double"),
            )
        )
        score = F.greatest(F.lit(1.0), F.least(F.lit(5.0), number)).cast("int")
        reason = F.when(found["reasoned"], found["reason"]).otherwise(F.lit(""))
        return F.when(
            number.isNotNull(), F.struct(score.alias("score"), reason.alias("reason"))
        )

    looks_like_object = raw.rlike(r"(?s)^\s*\{.*\}\s*$")
    return F.when(
        looks_like_object & in_array.isNotNull(), bind(bind(in_object, fields), verdict)
    )
