"""Which texts share MinHash bands, found on rows of two numbers.

A text goes by a name of 40 bits of its digest and a band by a key of as many. Names that two texts have in common and keys that
two bands have in common only let more candidates through, which the comparison of texts sorts out. A row of a band is 80 bits,
sent once; rows of a key lie side by side in a sorted stream, which leaves those of keys that one text alone has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions.minhash import BandShape, band_hashes, signing
from promptmill.session import materialise

_BITS = 40
_LOW = np.uint64((1 << 64 - _BITS) - 1)
#: Texts signed at a time, and names a task remembers so that it signs copies once.
_TEXTS, _SEEN = 1024, 1 << 17
#: Up to so many rows of a bucket are paired to count what they share.
CROWD = 32
_BUCKET = ["h1", "h2"]


def text_name(digest: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(digest), 64 - _BITS)


def _bands(shape: BandShape, num_perm: int):
    """Rows ``a, b`` for each band of a text: ``a`` is the key and the low bits of the name, ``b`` the other bits."""
    signer_of_task = signing(num_perm)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, seen = signer_of_task(), set()
        for batch in batches:
            names = batch.column("name").to_numpy()
            fresh = [i for i in np.sort(np.unique(names, return_index=True)[1]).tolist() if int(names[i]) not in seen]
            for low in range(0, len(fresh), _TEXTS):
                part = fresh[low : low + _TEXTS]
                texts = [text or "" for text in batch.column("norm").take(pa.array(part)).to_pylist()]
                keys = band_hashes(signer.sign(texts), shape, _BITS)
                name = names[part].astype(np.uint64)[:, None]
                a, b = keys << np.uint64(64 - _BITS) | name & _LOW, np.broadcast_to(name >> np.uint64(64 - _BITS), keys.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.reshape(-1).view(np.int64)), pa.array(b.reshape(-1).astype(np.int64))], ["a", "b"]
                )
            if len(seen) > _SEEN:
                seen.clear()
            seen.update(names[fresh].tolist())

    return rows


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, name`` of the rows of a sorted stream whose key has another name too; equal rows count once."""

    def found(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        name = b.view(np.uint64) << np.uint64(64 - _BITS) | a.view(np.uint64) & _LOW
        key = a.view(np.uint64) >> np.uint64(64 - _BITS)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(name.view(np.int64))], ["key", "name"])

    # The last row waits for the next batch, with whether it shares its key with the row before.
    a, b, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), False
    for batch in batches:
        a = np.concatenate([a, batch.column("a").to_numpy()])
        b = np.concatenate([b, batch.column("b").to_numpy()])
        if not len(a):
            continue
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b = a[new], b[new]
        key = a.view(np.uint64) >> np.uint64(64 - _BITS)
        same = key[1:] == key[:-1]
        shares = np.zeros(len(a), bool)
        shares[1:] |= same
        shares[:-1] |= same
        shares[0] |= waiting
        yield found(a[:-1][shares[:-1]], b[:-1][shares[:-1]])
        a, b, waiting = a[-1:], b[-1:], bool(shares[-1])
    if waiting:
        yield found(a, b)


def shared_bands(texts: DataFrame, shape: BandShape, num_perm: int) -> DataFrame:
    """``key, name`` for each band that two of the ``texts`` share; they have ``name`` and ``norm``."""
    rows = texts.select("name", "norm").mapInArrow(_bands(shape, num_perm), "a bigint, b bigint")
    dealt = rows.repartition(F.shiftrightunsigned("a", 64 - _BITS)).sortWithinPartitions("a", "b")
    return dealt.mapInArrow(_shared, "key bigint, name bigint")


def likely(buckets: DataFrame, votes: int) -> DataFrame:
    """The ``n`` of the rows that may share ``votes`` buckets with another row.

    Buckets of up to ``CROWD`` rows are counted pair by pair. Two rows share at most as many of the crowded ones as either is in.
    """
    if votes == 1:
        return buckets.select("n").distinct()
    sized = buckets.withColumn("rows", F.count("*").over(Window.partitionBy(*_BUCKET)))
    crowds = sized.filter(F.col("rows") > CROWD).groupBy("n").agg(F.count("*").alias("crowds"))
    few = sized.filter(F.col("rows") <= CROWD).select(*_BUCKET, "n")
    pairs = few.join(few.withColumnRenamed("n", "lead"), _BUCKET).filter("lead < n").groupBy("n", "lead").agg(F.count("*").alias("times"))
    crowds = materialise(crowds)
    most = F.least(F.coalesce("crowds", F.lit(0)), F.coalesce("others", F.lit(0)))
    met = (
        pairs.join(crowds, "n", "left")
        .join(crowds.select(F.col("n").alias("lead"), F.col("crowds").alias("others")), "lead", "left")
        .filter(F.col("times") + most >= votes)
    )
    alone = crowds.filter(F.col("crowds") >= votes).select("n")
    return met.select(F.explode(F.array("n", "lead")).alias("n")).unionByName(alone).distinct()
