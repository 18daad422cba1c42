"""Which way runs and experiments may move, and how far along a status is.

A status table says what may follow what. Folding events does not replay them: among the events of an attempt the one
farthest along counts, so that late, repeated and backward events change nothing whatever order they are read in, and the
fold stays a combinable maximum. A resumed run begins a new attempt, which counts more than all of the one before.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.operators.skew import attach

# What may follow a status within an attempt; "resuming" begins a new one.
RUN_TRANSITIONS = {
    "pending": ("curating", "failed"),
    "resuming": ("curating", "training", "evaluating", "promoting", "failed"),
    "curating": ("training", "failed"),
    "training": ("evaluating", "failed"),
    "evaluating": ("promoting", "completed", "failed"),
    "promoting": ("completed", "failed"),
    "failed": (),
    "completed": (),
}
EXPERIMENT_TRANSITIONS = {
    "training": ("pending_eval", "failed"),
    "pending_eval": ("completed", "eval_failed"),
    "eval_failed": ("completed",),
    "failed": (),
    "completed": (),
}
# Outcomes of a stage, from one that is still open to those that end it.
OUTCOMES = ("running", "failed", "skipped", "no_candidate", "completed")


class IllegalTransition(ValueError):
    """A status may not follow the one a run or experiment has."""


def check_transition(now: str | None, then: str, table: Mapping[str, tuple[str, ...]] = RUN_TRANSITIONS) -> None:
    """Raise unless ``then`` may follow ``now``. Repeating a status is allowed; ``resuming`` may follow any open or failed one."""
    if now in (None, then) or then in table.get(now, ()) or (then == "resuming" and now != "completed"):
        return
    raise IllegalTransition(f"{now} may not be followed by {then}")


def ranks(table: Mapping[str, tuple[str, ...]]) -> dict[str, int]:
    """The longest way to each status through the table: every allowed step leads to a higher rank."""
    found = dict.fromkeys(table, 0)
    for _ in table:
        for now, following in table.items():
            for then in following:
                found[then] = max(found[then], found[now] + 1)
    return found


def _rank(value: Column, known: Mapping[str, int]) -> Column:
    rank = F.lit(-1)
    for name, number in known.items():
        rank = F.when(value == name, F.lit(number)).otherwise(rank)
    return rank


def run_rank(status: Column) -> Column:
    return _rank(status, ranks(RUN_TRANSITIONS))


def experiment_rank(status: Column) -> Column:
    return _rank(status, ranks(EXPERIMENT_TRANSITIONS))


def outcome_rank(status: Column) -> Column:
    return _rank(status, {name: number for number, name in enumerate(OUTCOMES)})


def ignored_events(events: DataFrame) -> DataFrame:
    """``run_id, status, attempt, kept_status, n``: events after the one that counts, by status, which the guarded fold passes over.

    They came late from an earlier attempt or would lead back. The state of each run meets its events on a salted key.
    """
    rows = events.select("run_id", "status", F.coalesce("attempt", F.lit(0)).alias("attempt"), "at", "seq").withColumn("rank", run_rank(F.col("status")))
    place = ["attempt", "rank", "at", "seq"]
    last = rows.groupBy("run_id").agg(F.max(F.struct(*place, "status")).alias("kept"))
    after = F.struct("at", "seq") > F.struct(F.col("kept.at").alias("at"), F.col("kept.seq").alias("seq"))
    return (
        attach(rows, last, ["run_id"], F.col("seq"))
        .filter(after)
        .groupBy("run_id", "status", "attempt", F.col("kept.status").alias("kept_status"))
        .agg(F.count("*").alias("n"))
    )
