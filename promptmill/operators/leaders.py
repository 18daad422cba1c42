"""Verified keep-first removal of near-duplicates, many leaders a round.

A row falls when an earlier kept row shares enough buckets with it and their shingle sets are alike. Each round takes the first
open rows of every bucket, its leaders. A row that leads all its buckets has every earlier row it could fall to among the
leaders, so the leaders are settled among themselves: their pairs are compared once, and narrow link rows are walked until
each such row is kept or dropped. Then every other open row is compared with the kept leaders of its buckets. Work is linear
in the rows of a bucket for a set of near copies, which fall to its first rows, and a bucket of many unlike rows takes in the end
one round for every ``LEADERS`` of them. Which pairs to compare is found on rows of numbers; buckets with the same leaders are merged
there. Texts lie in a bucketed table and go to blocks of rows: one of a row, and one of a leader for each block that asks for it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions.minhash import shingle_sets
from promptmill.operators.skew import attach
from promptmill.session import discard, materialise, release, shared_dir

#: Leaders of a bucket in a round and of a task, and rows that a task compares with them at a time.
LEADERS, BLOCK = 512, 512
#: Leaders of a bucket in the first round, four times as many in the next. Most rows of a crowd are near copies of its first few.
FIRST = 16
_BUCKET, _TASK = ["h1", "h2"], ["head", "part", "cut"]


def _alike(one: list[np.ndarray], other: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets of ``one`` and ``other`` have a Jaccard similarity above ``threshold``; two empty sets are equal."""
    sizes = np.array([len(s) for s in one]), np.array([len(s) for s in other])
    common = np.zeros((len(one), len(other)), np.int64)
    _, place = np.unique(np.concatenate([np.zeros(0, np.uint64), *one, *other]), return_inverse=True)
    left = np.repeat(np.arange(len(one)), sizes[0])
    right = np.repeat(np.arange(len(other)), sizes[1])
    at, beside = place[: len(left)], place[len(left) :]
    order, back = np.argsort(at, kind="stable"), np.argsort(beside, kind="stable")
    at, left, beside, right = at[order], left[order], beside[back], right[back]
    width = 4096  # shingles whose incidence is held at once
    for low in range(0, int(place.max(initial=-1)) + 1, width):
        a, b = np.searchsorted(at, [low, low + width])
        c, d = np.searchsorted(beside, [low, low + width])
        if a < b and c < d:
            first, second = np.zeros((len(one), width), np.float32), np.zeros((len(other), width), np.float32)
            first[left[a:b], at[a:b] - low] = 1
            second[right[c:d], beside[c:d] - low] = 1
            common += (first @ second.T).round().astype(np.int64)
    union = sizes[0][:, None] + sizes[1][None, :] - common
    return np.where(union == 0, 1.0, common / np.maximum(union, 1)) > threshold


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[list[dict], list[dict]]]:
    """Per task of a sorted stream its leaders, and the rows that ask for some of them, at most some ``BLOCK`` at a time.

    Leaders come first; one may ask for others.
    """
    current, leaders, held = None, [], []
    for batch in batches:
        for low in range(0, len(batch), 256):
            for row in batch.slice(low, 256).to_pylist():
                task = tuple(row[k] for k in keys)
                if task != current:
                    if held:
                        yield leaders, held
                    current, leaders, held = task, [], []
                elif len(held) >= BLOCK and not row["leads"]:
                    yield leaders, held
                    held = []
                if row["leads"]:
                    leaders.append(row)
                if row["asks"]:
                    held.append(row)
    if held:
        yield leaders, held


def _links(threshold: float):
    """Link rows ``n, lead`` of the rows of tasks to those leaders they ask for that they are alike with."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sets = None, []
        for leaders, held in _runs(batches, _TASK):
            if leaders is not last:
                last, sets = leaders, shingle_sets([r["norm"] for r in leaders])
            alike = _alike(shingle_sets([r["norm"] for r in held]), sets, threshold)
            number, lead = np.array([r["n"] for r in held]), np.array([r["n"] for r in leaders])
            for row, asking in zip(alike, held, strict=True):
                row &= np.isin(lead, asking["asks"])
            i, j = np.nonzero(alike)
            yield pa.RecordBatch.from_arrays([pa.array(number[i]), pa.array(lead[j])], ["n", "lead"])

    return link


class _Texts:
    """Texts in a bucketed scratch table, so that rows that ask for some of them come to the texts."""

    def __init__(self, texts: DataFrame, names: DataFrame | None):
        self.spark, self.names, self.key = texts.sparkSession, names, "n" if names is None else "ord"
        scratch = uuid.uuid4().hex
        self.table, self.path = f"alike_texts_{scratch}", f"{shared_dir(self.spark)}/alike-texts-{scratch}"
        buckets = min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 10_000)
        at = F.xxhash64(self.key).alias("at")
        stored = texts.select(at, F.col(self.key).alias("_key"), "norm").repartition(buckets, "at")
        writer = stored.write.option("path", self.path).option("compression", "zstd")
        writer.bucketBy(buckets, "at").saveAsTable(self.table)

    def beside(self, rows: DataFrame) -> DataFrame:
        """``rows``, which have ``n``, with ``norm``."""
        named = rows if self.names is None else rows.join(self.names, "n")
        asked = named.withColumn("at", F.xxhash64(self.key)).hint("merge")
        # Not an equality, which would become a key of the join: the table is bucketed by ``at`` alone and stays where it is.
        same = (F.col("_key") <= F.col(self.key)) & (F.col("_key") >= F.col(self.key))
        return self.spark.table(self.table).join(asked, "at").filter(same).select(*rows.columns, "norm")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.table}")
        discard(self.spark, self.path)


def _compared(pairs: DataFrame, texts: _Texts, threshold: float) -> DataFrame:
    """``n, lead`` of the ``pairs`` ``n, h1`` that are alike.

    A row goes to a block of rows with the same first leader, and each leader that a row of the block asks for is sent there once.
    Blocks that ask for many are cut by leader. So texts are sent once a row and some times a leader, however many pairs there are.
    """
    asked = materialise(pairs.select("n", F.col("h1").alias("lead")))
    if asked.isEmpty():
        return asked
    headed = asked.withColumn("head", F.min("lead").over(Window.partitionBy("n")))
    sizes = headed.filter("lead = head").groupBy("head").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("n"), F.col("parts")).cast("int").alias("part")
    dealt = attach(headed, sizes, ["head"], F.col("n")).select("head", part, "n", "lead")
    counted = dealt.groupBy("head", "part").agg(F.ceil(F.count_distinct("lead") / LEADERS).alias("cuts"))
    cut = F.pmod(F.xxhash64("lead"), F.col("cuts")).cast("int").alias("cut")
    dealt = materialise(dealt.join(counted, ["head", "part"]).select("head", "part", cut, "n", "lead"))
    asking = dealt.groupBy(*_TASK, "n").agg(F.collect_list("lead").alias("asks")).withColumn("leads", F.lit(False))
    leading = dealt.select(*_TASK, F.col("lead").alias("n")).distinct()
    leading = leading.select(*_TASK, "n", F.array().cast("array<bigint>").alias("asks"), F.lit(True).alias("leads"))
    rows = asking.unionByName(leading).groupBy(*_TASK, "n").agg(
        F.flatten(F.collect_list("asks")).alias("asks"), F.max("leads").alias("leads")
    )
    sent = texts.beside(rows).repartition(*_TASK).sortWithinPartitions(*_TASK, F.desc("leads"), "n")
    return materialise(sent.mapInArrow(_links(threshold), "n bigint, lead bigint"))


def _same_leaders(held: DataFrame) -> DataFrame:
    """``h1, h2, s1, s2`` for each bucket of ``held``: buckets with the same leaders have the same ``s1, s2``.

    ``n`` is unique within a bucket, so two exclusive ors and the number of leaders name their set.
    """
    size = F.count("*")
    return held.groupBy(*_BUCKET).agg(
        F.xxhash64(F.bit_xor(F.xxhash64("n")), size).alias("s1"),
        F.xxhash64(size, F.bit_xor(F.xxhash64(F.lit("s"), "n"))).alias("s2"),
        size.alias("lead_count"),
    )


def _merged(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of the buckets in ``sets``, each once for a set of leaders, which takes the place of its ``times`` buckets."""
    met = rows.select(*_BUCKET, "n").join(sets, _BUCKET)
    return met.groupBy(F.col("s1").alias("h1"), F.col("s2").alias("h2"), "n").agg(F.count("*").alias("times"))


def _paired(rows: DataFrame, leaders: DataFrame | None = None, votes: int = 1) -> DataFrame:
    """Each pair of a row ``n`` and an earlier leader ``h1`` once, if they share ``votes`` buckets; without ``leaders`` all rows lead.

    ``leads`` is false, as ``n`` does not lead its pair.
    """
    earlier = (rows if leaders is None else leaders).select(*_BUCKET, F.col("n").alias("lead"))
    # Leaders are few in any bucket, other rows may be many.
    pairs = rows.join(earlier, _BUCKET) if leaders is None else attach(rows, earlier, _BUCKET, F.col("n"))
    shared = pairs.filter("lead < n").groupBy("n", "lead").agg(F.sum("times").alias("times")).filter(F.col("times") >= votes)
    return shared.select("n", F.col("lead").alias("h1"), F.lit(False).alias("leads"))


def _settled(ready: DataFrame, links: DataFrame) -> DataFrame:
    """``n, kept`` of leaders: one is dropped that links to a kept one, and kept once all it links to are dropped.

    ``ready`` are those that may be kept, ``links`` is stored. Each step works on link rows of undecided leaders alone; there are as many
    steps as the longest chain of links that hang on each other.
    """
    decided, left = None, ready
    while True:
        last = links.isEmpty()
        free = left if last else left.join(links.select("n").distinct(), "n", "left_anti")
        step = free.select("n", F.lit(True).alias("kept"))
        if not last:
            fallen = links.join(free.withColumnRenamed("n", "lead"), "lead", "left_semi").select("n").distinct()
            step = step.unionByName(fallen.select("n", F.lit(False).alias("kept")))
        step = materialise(step)
        decided = step if decided is None else decided.unionByName(step)
        if last or step.isEmpty():
            return decided
        out = step.filter("not kept").select("n")
        left = left.join(step.select("n"), "n", "left_anti")
        links = materialise(
            links.join(out, "n", "left_anti").join(out.withColumnRenamed("n", "lead"), "lead", "left_anti").select("n", "lead")
        )


def verified_drops(
    buckets: DataFrame, texts: DataFrame, threshold: float, leaders: int = LEADERS, votes: int = 1, names: DataFrame | None = None
) -> tuple[DataFrame, int]:
    """The ``n`` of the rows that fall, and the number of rounds.

    ``buckets`` has a row ``n, h1, h2`` for each row and bucket that others share; ``n`` numbers rows in input order. ``texts`` has
    ``n, norm``, or ``ord, norm`` where ``names`` has ``n, ord``. Rows are compared that share ``votes`` buckets: an open row and a row that
    may be kept lead or share all their buckets, so none is missed in the count.
    """
    stored = _Texts(texts, names)
    open_rows, dropped, rounds, size = buckets.select("n", *_BUCKET).repartition(*_BUCKET).distinct(), [], 0, min(leaders, FIRST)
    while True:
        # A row that shares no bucket any more stays.
        whole = Window.partitionBy(*_BUCKET)
        placed = open_rows.withColumns(
            {"place": F.row_number().over(whole.orderBy("n")), "several": F.count("*").over(whole)}
        )
        placed = materialise(placed.filter("several > 1").drop("several"))
        if placed.isEmpty():
            break
        rounds += 1
        first = placed.filter(F.col("place") <= size).select("n", *_BUCKET)
        ready = materialise(placed.groupBy("n").agg(F.max("place").alias("last")).filter(F.col("last") <= size).select("n"))
        dealt = first.repartition(*_BUCKET)
        merged = materialise(_merged(dealt, _same_leaders(dealt).filter("lead_count > 1")))
        settled = _settled(ready, _compared(_paired(merged, votes=votes), stored, threshold))
        dropped.append(settled.filter("not kept").select("n"))
        open_rows = materialise(placed.select("n", *_BUCKET).join(settled.select("n"), "n", "left_anti"))
        if open_rows.isEmpty():
            break
        # Of the leaders that are kept, those count that lead a bucket of a row that is still open.
        held = first.join(settled.filter("kept").select("n"), "n", "left_semi")
        each = F.lit(1).alias("times")
        hit = _compared(_paired(open_rows.select("*", each), held, votes), stored, threshold).select("n").distinct()
        dropped.append(hit)
        open_rows = open_rows.join(hit, "n", "left_anti")
        size = min(leaders, 4 * size)
        release(stored.spark)
    stored.drop()
    if not dropped:
        return buckets.select("n").limit(0), rounds
    return reduce(DataFrame.unionByName, dropped).distinct(), rounds
