"""An index of the band keys of all kept samples, read by hash prefix.

Keys are stored in folders by the first bits of their hash. A batch names the prefixes of its own keys and reads only those
folders of the base and of the newer segments. Folding leaves one row per key and one file per prefix, so that the index
holds as many rows as there are kept bands, however many batches wrote them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.sources.segments import Segment, SegmentTable

#: Bits of a prefix: 256 folders, and as many numbers at most that a batch gathers on the driver. A large index wants more, so
#: that a folder holds some 100 MB and a small batch touches few of them. It is fixed for the life of an index.
PREFIX_BITS = 8

_KEYS = "h1 BIGINT, h2 BIGINT, prefix INT"


def prefix_of(h1: Column, bits: int = PREFIX_BITS) -> Column:
    return F.shiftrightunsigned(h1, 64 - bits).cast("int")


class BandIndex:
    """Band keys ``h1, h2`` by batch; a batch sees those of the batches before it only."""

    def __init__(self, spark: SparkSession, path: str, bits: int = PREFIX_BITS, fold_every: int = 8):
        self.bits, self.fold_every = bits, fold_every
        self.table = SegmentTable(spark, path, _KEYS, by=["prefix"])

    def _batch(self, segment: Segment) -> int:
        return int(segment.key.removeprefix("batch-"))

    def prefixes(self, keys: DataFrame) -> list[int]:
        """The prefixes that occur among some keys: numbers below 2 ** bits."""
        return sorted(r[0] for r in keys.select(prefix_of(F.col("h1"), self.bits)).distinct().collect())

    def before(self, batch_id: int, keys: DataFrame) -> DataFrame:
        """``h1, h2`` stored by earlier batches under the prefixes of ``keys``, each once.

        Base and segments are filtered by their partition column, so other folders are not opened.
        """
        touched = F.col("prefix").isin(self.prefixes(keys))
        rows = self.table.tail(unless=lambda s: self._batch(s) >= batch_id).filter(touched)
        base = self.table.read_base()
        if base is not None:
            rows = rows.unionByName(base.filter(touched))
        return rows.select("h1", "h2").distinct()

    def add(self, batch_id: int, keys: DataFrame) -> None:
        """Store a batch's keys; a batch that is repeated after they were committed changes nothing."""
        rows = keys.select("h1", "h2").distinct().withColumn("prefix", prefix_of(F.col("h1"), self.bits))
        self.table.append(rows.repartition("prefix"), f"batch-{batch_id}")

    def fold_before(self, batch_id: int) -> None:
        """Fold the batches before this one if there are enough new ones; they are final, as batches run in turn."""
        base = self.table.base()
        earlier = [s for s in self.table.segments(base.number if base else 0) if self._batch(s) < batch_id]
        if len(earlier) >= self.fold_every:
            self.table.fold(self._folded, earlier[-1].number)
            self.table.vacuum()

    def _folded(self, base: DataFrame | None, segments: DataFrame) -> DataFrame:
        rows = segments if base is None else base.unionByName(segments)
        return rows.distinct().repartition("prefix")
