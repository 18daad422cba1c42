"""A filter of fixed size over 64-bit keys, so that rows that cannot join stay where they are."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter, 4 MiB; more keys than bits only let more rows through.
BITS = 25


def key_filter(keys: DataFrame) -> Callable[[Column], Column]:
    """Tells of a column whether its key may be among ``key``; all that are pass. A bitmap is broadcast, whatever the number of keys."""
    bit = F.pmod("key", F.lit(1 << BITS))
    words = (
        keys.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")).alias("bits"))
        .collect()
    )
    table = np.zeros(1 << (BITS - 6), np.int64)
    if words:
        table[[row["word"] for row in words]] = [row["bits"] for row in words]
    known = keys.sparkSession.sparkContext.broadcast(table.view(np.uint8))

    @F.arrow_udf("boolean")
    def among(column: pa.Array) -> pa.Array:
        own = column.to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64((1 << BITS) - 1)
        return pa.array((known.value[own >> np.uint64(3)] >> (own & np.uint64(7)).astype(np.uint8)) & 1 == 1)

    return among
