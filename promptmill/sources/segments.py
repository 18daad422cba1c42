"""Tables that grow by segments and are folded, now and then, into one base.

A segment is written to a folder of its own and becomes visible by a commit file whose number it takes when it is complete,
so numbers follow the order of commits even when writers overlap. A base holds what the segments up to a number fold to. Readers
take the newest base and the segments after it; the files of older segments are not opened, and the rows a reader sees
do not depend on whether or when the table was folded.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from promptmill.session import discard
from promptmill.sources.state import claim


@dataclass(frozen=True)
class Segment:
    """``key`` names what a segment holds; a repeated attempt finds its key committed."""

    number: int
    key: str
    folder: str


class SegmentTable:
    """A table at ``path`` with rows of ``schema``; ``by`` are partition columns of each segment and base."""

    def __init__(self, spark: SparkSession, path: str, schema: str, by: Sequence[str] = (), base_schema: str | None = None):
        self.spark, self.path, self.schema, self.by = spark, path, schema, tuple(by)
        self.base_schema = base_schema or schema

    # --- commits

    def _names(self, folder: str) -> list[str]:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        where = hadoop.Path(f"{self.path}/{folder}")
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(where):
            return []
        return sorted(name for s in files.listStatus(where) if not (name := s.getPath().getName()).startswith((".", "_")))

    def _committed(self, folder: str, names: Sequence[str]) -> list[Segment]:
        """The commits of some names: a line ``number key/uuid`` each."""
        if not names:
            return []
        lines = self.spark.read.text([f"{self.path}/{folder}/{name}" for name in names]).collect()
        found = [line["value"].split(" ", 1) for line in lines]
        return sorted((Segment(int(n), f.rsplit("/", 1)[0], f) for n, f in found), key=lambda s: s.number)

    def base(self) -> Segment | None:
        """The newest base; its number is that of the last segment it holds."""
        names = self._names("bases")
        return self._committed("bases", names[-1:])[0] if names else None

    def segments(self, after: int = 0) -> list[Segment]:
        """Committed segments with larger numbers, without those that repeat a key."""
        found = self._committed("commits", [n for n in self._names("commits") if int(n) > after])
        return list({s.key: s for s in reversed(found)}.values())[::-1]

    # --- writing

    def append(self, rows: DataFrame, key: str | None = None) -> int:
        """Add ``rows`` as one segment and return its number; a key that is committed already stays as it is."""
        key = key or str(uuid.uuid4())
        held = [s for s in self.segments() if s.key == key]
        if held:
            return held[0].number
        folder = f"{key}/{uuid.uuid4()}"
        rows.write.partitionBy(*self.by).parquet(f"{self.path}/rows/{folder}")
        while True:
            number = int((self._names("commits") or ["0"])[-1]) + 1
            if claim(self.spark, f"{self.path}/commits", number, folder):
                return number

    def fold(self, folded: Callable[[DataFrame | None, DataFrame], DataFrame], upto: int | None = None) -> int | None:
        """Make a base of the one before and the segments up to a number, by default all; return its number.

        ``folded(base, segments)`` gives the rows. If another writer has folded as far meanwhile, its base stands.
        """
        base = self.base()
        done = base.number if base else 0
        chosen = [s for s in self.segments(done) if upto is None or s.number <= upto]
        if not chosen:
            return done or None
        number, folder = chosen[-1].number, f"base/{uuid.uuid4()}"
        rows = folded(self.read_base(base), self._read(chosen, self.schema))
        rows.write.partitionBy(*self.by).parquet(f"{self.path}/rows/{folder}")
        claim(self.spark, f"{self.path}/bases", number, folder)
        return number

    def vacuum(self) -> None:
        """Remove what the base before the newest one already held; readers of the newest two bases are not disturbed."""
        bases = self._committed("bases", self._names("bases"))
        if len(bases) < 2:
            return
        kept = bases[-2].number
        for s in self.segments():
            if s.number <= kept:
                discard(self.spark, f"{self.path}/commits/{s.number:012d}")
                discard(self.spark, f"{self.path}/rows/{s.folder}")
        for b in bases[:-2]:
            discard(self.spark, f"{self.path}/bases/{b.number:012d}")
            discard(self.spark, f"{self.path}/rows/{b.folder}")

    # --- reading

    def _read(self, segments: Sequence[Segment], schema: str) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], schema)
        frames = [self.spark.read.schema(schema).parquet(f"{self.path}/rows/{s.folder}") for s in segments]
        if not self.by:  # one scan of all folders
            return self.spark.read.schema(schema).parquet(*(f"{self.path}/rows/{s.folder}" for s in segments))
        rows = frames[0]
        for more in frames[1:]:
            rows = rows.unionByName(more)
        return rows

    def read_base(self, base: Segment | None = None) -> DataFrame | None:
        base = base or self.base()
        return None if base is None else self._read([base], self.base_schema)

    def tail(self, unless: Callable[[Segment], bool] | None = None) -> DataFrame:
        """The rows of the segments after the newest base, without those that ``unless`` names."""
        base = self.base()
        chosen = [s for s in self.segments(base.number if base else 0) if unless is None or not unless(s)]
        return self._read(chosen, self.schema)
