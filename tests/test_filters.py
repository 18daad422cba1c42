import pytest

from promptmill.config import CurationConfig
from promptmill.operators import filters
from promptmill.plans.curation import curation_summary

GOOD = (
    "Gradient descent walks downhill on a loss surface, one small step after another. "
    "Each step follows the slope of the loss, so the model improves a little every time. "
    "Large steps overshoot; tiny steps take forever."
)
TOXIC = "Please kill every process and bomb the build server."
CFG = CurationConfig(min_quality_score=0.5, min_response_length=10, remove_pii=False)


def frame(spark, rows):
    return spark.createDataFrame(rows, "log_id string, prompt string, response string")


@pytest.mark.parametrize(
    "prompt, response, reason",
    [
        ("What is it?", GOOD, None),
        ("What is it?", "Yes.", "too_short"),
        ("What is it?", "", "too_short"),
        ("What is it?", None, "too_short"),
        (None, GOOD, None),
        (TOXIC, GOOD, "toxic"),
        ("prompt", " ".join(["word"] * 3000), "too_long"),
        ("#### #### ####", "%% && " * 20, "low_quality"),
    ],
)
def test_reasons(spark, prompt, response, reason):
    tagged = filters.tag_logs(frame(spark, [("1", prompt, response)]), CFG)
    assert tagged.first()["drop_reason"] == reason


def test_length_limit_is_strict_and_in_estimated_tokens(spark):
    text = " ".join(f"w{i}" for i in range(100))
    at = CurationConfig(max_token_length=130, min_response_length=5, min_quality_score=0.0)
    below = CurationConfig(max_token_length=129, min_response_length=5, min_quality_score=0.0)
    logs = frame(spark, [("1", "", text)])
    assert filters.tag_logs(logs, at).first()["drop_reason"] is None
    assert filters.tag_logs(logs, below).first()["drop_reason"] == "too_long"


def test_mixed_batch_and_counts(spark):
    logs = frame(
        spark,
        [("1", "Good?", GOOD), ("2", "Another?", GOOD), ("3", "Short?", "Yes."), ("4", TOXIC, GOOD)],
    )
    assert filters.filter_logs(logs, CFG).count() == 2
    tagged = filters.tag_logs(logs, CFG)
    assert {r.drop_reason: r.n for r in filters.drop_counts(tagged).collect()} == {
        "kept": 2, "too_short": 1, "toxic": 1,
    }
    rate = filters.drop_rate(tagged).first()
    assert (rate.total, rate.kept, rate.dropped, rate.drop_rate_pct) == (4, 2, 2, 50.0)


def test_redaction_only_edits_kept_rows_and_never_drops(spark):
    cfg = CurationConfig(min_quality_score=0.5, min_response_length=10)
    kept = filters.filter_logs(frame(spark, [("1", "I am a@b.example", GOOD)]), cfg).collect()
    assert kept[0]["prompt"] == "I am [EMAIL_ADDRESS]"


def test_empty_input(spark):
    empty = frame(spark, [])
    kept = filters.filter_logs(empty, CFG)
    assert kept.count() == 0
    summary = curation_summary(empty, kept, kept).first()
    assert (summary.status, summary.reason, summary.logs_pulled) == ("skipped", "no_logs_available", 0)
