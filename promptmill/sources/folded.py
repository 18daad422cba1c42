"""Run and experiment state kept as a folded base and the events after it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from promptmill import schemas
from promptmill.operators import experiments as ex
from promptmill.operators import runs
from promptmill.sources.segments import SegmentTable

EXPERIMENT_EVENTS = f"{schemas.EXPERIMENTS}, seq BIGINT"


@dataclass(frozen=True)
class Folding:
    """How events become states (``lift``), states one per key (``merge``), and those the table users see (``finish``).

    ``merge`` must not mind the order of its rows, rows that come late and rows that come twice.
    """

    lift: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame]


RUNS = Folding(partial(runs.lift_runs, guarded=True), runs.merge_runs, runs.finish_runs)
EXPERIMENTS = Folding(partial(ex.lift_experiments, guarded=True), ex.merge_experiments, ex.finish_experiments)


class FoldedEvents:
    """Events appended to a segment table and read as current state."""

    def __init__(self, spark: SparkSession, path: str, schema: str, folding: Folding):
        self.folding = folding
        states = folding.merge(folding.lift(spark.createDataFrame([], schema)))
        self.table = SegmentTable(spark, path, schema, base_schema=states.schema)

    def append(self, events: DataFrame, key: str | None = None) -> int:
        """Add events as one segment; a key that was appended before changes nothing."""
        return self.table.append(events, key)

    def _merged(self, base: DataFrame | None, events: DataFrame) -> DataFrame:
        states = self.folding.lift(events)
        return self.folding.merge(states if base is None else base.unionByName(states))

    def read(self) -> DataFrame:
        """The current state: the base merged with newer segments only; files of older events are not read."""
        return self.folding.finish(self._merged(self.table.read_base(), self.table.tail()))

    def fold(self) -> int | None:
        """Fold all segments into a new base; returns the number of the last one it holds."""
        return self.table.fold(self._merged)


def run_events(spark: SparkSession, path: str, folding: Folding = RUNS) -> FoldedEvents:
    return FoldedEvents(spark, path, schemas.RUN_EVENTS, folding)


def experiment_events(spark: SparkSession, path: str, folding: Folding = EXPERIMENTS) -> FoldedEvents:
    return FoldedEvents(spark, path, EXPERIMENT_EVENTS, folding)
