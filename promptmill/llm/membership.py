"""A filter of fixed size over 64-bit hashes: the broadcast that does not grow with the data."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the filter, 4 MiB; more hashes than bits only let more candidates through.
BITS = 25


def membership(hashes: DataFrame, column: str) -> Broadcast:
    """Broadcast a bitmap with the bit of every hash of ``column`` set.

    The bitmap is gathered as at most ``2 ** (BITS - 6)`` words, whatever the number of hashes.
    """
    bit = F.pmod(F.col(column), F.lit(1 << BITS))
    words = (
        hashes.select(bit.alias("_bit"))
        .groupBy(F.shiftright("_bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(_bit % 64 AS INT))")).alias("bits"))
        .collect()
    )
    table = np.zeros(1 << (BITS - 6), np.int64)
    if words:
        table[[row["word"] for row in words]] = [row["bits"] for row in words]
    return hashes.sparkSession.sparkContext.broadcast(table.view(np.uint8))


def passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the set; all that are in it pass."""
    bit = hashes & np.uint64((1 << BITS) - 1)
    return (table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
