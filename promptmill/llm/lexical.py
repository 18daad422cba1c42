"""Ranked lexical search of a query set over all documents, by buckets of vector norms.

A document is a vector of integer impacts over the terms of the queries, a query the 0/1 vector of its own terms; the score is
their inner product. Document vectors are stored in buckets of falling norm. The buckets are searched one after the other,
each by many tasks; after each the k-th best score of every query is its threshold, and a later bucket, or the vectors at
its end, is left unread where the Cauchy-Schwarz bound stays below it. Inside a bucket the exact values of a query's heaviest
coordinates with the same bound on the others leave few candidates, which are scored in whole numbers.

Queries are worked through in blocks of bounded size, each over all documents. Only a block's own terms and thresholds
are broadcast.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promptmill.llm.words import light, ragged, signed, strided, word_hashes
from promptmill.session import discard, materialise, shared_dir

#: Query terms in a block, about (one longer query makes a longer block); the bound of all that is broadcast.
BLOCK_TERMS = 1 << 18
#: Shares of the documents with the longest vectors at which a bucket ends.
BUCKETS = (1 / 64, 1 / 16, 1 / 4)
#: Heaviest coordinates of a query whose values are looked up before its other coordinates are bounded.
FOCUS = 12
#: Document coordinates worked on at once.
_SLICE = 1 << 19
#: Room for rounding in norms and bounds; scores are whole numbers.
_ROOM = 1 + 1e-9


def query_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item, item_id, term``: the distinct terms of each distinct (id, text), as hashes."""
    kind = items.select(item_id).schema[0].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in light(batches):
            words, bounds = word_hashes(batch.column("text"))
            sets = [np.unique(words[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            ends = np.cumsum([0, *map(len, sets)])
            terms = signed(np.concatenate([np.zeros(0, np.uint64), *sets]))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), ragged(terms, ends)], ["item_id", "terms"])

    given = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).distinct()
    split_up = given.mapInArrow(split, f"item_id {kind}, terms array<bigint>")
    numbered = materialise(split_up).withColumn("item", F.monotonically_increasing_id())
    return numbered.select("item", "item_id", F.explode("terms").alias("term"))


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of each item with the highest scores above 0.

    Terms are runs of digits, ASCII letters (case ignored) and other characters above ASCII. Equal scores are ordered by
    ascending document id, null first. Every document row counts on its own, also repeated ones; of repeated (item id, text)
    rows one is searched. Null or empty texts have no terms and are never found; an item without terms, an empty table of items
    or of documents gives no rows. Other columns are ignored. Scores use ``weights`` and ``impacts``.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    terms = materialise(query_terms(items, item_id, item_text))
    blocks = math.ceil(terms.count() / block_terms)
    block = F.pmod(F.xxhash64("item"), F.lit(max(blocks, 1)))
    found = [_search(given, terms.filter(block == number), k) for number in range(blocks)]
    found = [f for f in found if f is not None]
    if not found:
        empty = spark.createDataFrame([], "item bigint, score bigint")
        best = empty.join(given.select("doc_id").filter("false"), F.lit(True))
    else:
        best = found[0]
        for more in found[1:]:
            best = best.unionByName(more)
    names = terms.select("item", "item_id").distinct()
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def weights(n_docs: int, frequency: np.ndarray) -> np.ndarray:
    """Of a term by how many of the documents with terms hold it: floor(1000 ln((2N + 2) / (2 df + 1)))."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for f in frequency.tolist()], np.int64)


def impacts(times: np.ndarray, weight: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Of a term in a document of length factor m: w * ((10^9 tf) div (1000 tf + 20 m))."""
    return weight * ((1_000_000_000 * times) // (1000 * times + 20 * m))


def _search(given: DataFrame, terms: DataFrame, k: int) -> DataFrame | None:
    """``item, doc_id, score`` of one block of queries: the best ``k`` of each; None for a block without queries."""
    spark = given.sparkSession
    rows = terms.select("item", "term").collect()  # one block
    if not rows:
        return None
    vocabulary, place = np.unique(np.array([r["term"] for r in rows], np.int64).view(np.uint64), return_inverse=True)
    numbers, owner = np.unique(np.array([r["item"] for r in rows], np.int64), return_inverse=True)
    kind = given.schema["doc_id"].dataType.simpleString()
    words = spark.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value
        for batch in light(batches):
            hashes, bounds = word_hashes(batch.column("text"))
            at = np.searchsorted(known, hashes)
            hit = known[np.minimum(at, len(known) - 1)] == hashes
            n = np.diff(bounds)
            of = np.repeat(np.arange(len(n)), n)[hit]
            cell, times = np.unique(of * len(known) + at[hit], return_counts=True)
            ends = np.searchsorted(cell, np.arange(len(n) + 1) * len(known))
            lists = [ragged(pa.array(v.astype(np.int32)), ends) for v in (cell % len(known), times)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "times"])

    counted = materialise(given.mapInArrow(count, f"doc_id {kind}, n bigint, terms array<int>, times array<int>").filter("n > 0"))
    n_docs, length = counted.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return counted.select(F.lit(0).cast("bigint").alias("item"), "doc_id", F.lit(0).cast("bigint").alias("score"))
    frequency = np.zeros(len(vocabulary), np.int64)
    for term, found in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one block
        frequency[term] = found
    weight = spark.sparkContext.broadcast(weights(n_docs, frequency))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _strides(batch):
                own, ends = _flat(part.column("terms"))
                times, _ = _flat(part.column("times"))
                n = part.column("n").to_numpy()
                m = 100 - 50 + (50 * n * n_docs) // length
                values = impacts(times.astype(np.int64), weight.value[own], np.repeat(m, np.diff(ends)))
                kept = values > 0
                cuts = np.concatenate(([0], np.cumsum(kept)))[ends]
                norm = np.sqrt(_sums(values.astype(np.float64) ** 2, ends))
                lists = [ragged(pa.array(v[kept]), cuts) for v in (own, values)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(norm), *lists], ["doc_id", "norm", "terms", "impacts"])

    weighed = counted.mapInArrow(weigh, f"doc_id {kind}, norm double, terms array<int>, impacts array<bigint>").filter("norm > 0")
    return _waves(weighed, _Queries(numbers, owner, place, weight.value), k, kind)


class _Queries:
    """One block of queries: their numbers, and each one's term places, heaviest first."""

    def __init__(self, numbers: np.ndarray, owner: np.ndarray, place: np.ndarray, weight: np.ndarray):
        order = np.lexsort((place, -weight[place], owner))
        self.numbers, self.terms, self.size = numbers, place[order], len(weight)
        self.ends = np.searchsorted(owner[order], np.arange(len(numbers) + 1))

    def of(self, number: int) -> np.ndarray:
        return self.terms[self.ends[number] : self.ends[number + 1]]

    def lengths(self) -> np.ndarray:
        return np.sqrt(np.diff(self.ends))


def _waves(weighed: DataFrame, queries: _Queries, k: int, kind: str) -> DataFrame:
    """Search the buckets in falling order of norms, each with the thresholds that the earlier ones left."""
    spark = weighed.sparkSession
    cuts = weighed.agg(F.percentile_approx("norm", [1 - share for share in BUCKETS], 10_000)).first()[0]
    bounds = sorted({float(c) for c in cuts or []}, reverse=True)
    bucket = F.lit(len(bounds))
    for number, bound in reversed(list(enumerate(bounds))):
        bucket = F.when(F.col("norm") >= bound, number).otherwise(bucket)
    path = f"{shared_dir(spark)}/lexical-{uuid.uuid4()}"
    weighed.withColumn("bucket", bucket).write.partitionBy("bucket").parquet(path)
    stored = spark.read.schema(f"doc_id {kind}, norm double, terms array<int>, impacts array<bigint>, bucket int").parquet(path)

    shared = spark.sparkContext.broadcast(queries)
    lengths, least = queries.lengths(), np.ones(len(queries.numbers), np.int64)
    best = None
    for number in range(len(bounds) + 1):
        reach = float((least / lengths).min()) / _ROOM  # a shorter vector reaches no query's threshold
        if number and bounds[number - 1] < reach:
            break
        near = stored.filter((F.col("bucket") == number) & (F.col("norm") >= reach))
        found = near.mapInArrow(_searcher(shared, spark.sparkContext.broadcast(least), k), f"item bigint, doc_id {kind}, score bigint")
        best = materialise(_top(found if best is None else best.unionByName(found), k))
        ends = best.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") >= k)
        for row in ends.collect():  # one block of queries
            least[np.searchsorted(queries.numbers, row["item"])] = row["least"]
    discard(spark, path)
    return best


def _top(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each item, first within parts of them."""
    ordered = [F.desc("score"), F.asc("doc_id")]
    dealt = found.withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    for keys in (["item", "_part"], ["item"]):
        dealt = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*ordered))).filter(F.col("_rank") <= k)
    return dealt.drop("_part", "_rank")


def _searcher(shared, thresholds, k: int):
    """Per task and query, the documents whose score is at the threshold or above: the best ``k`` and none worse."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, least = shared.value, thresholds.value.copy()
        lengths = queries.lengths()
        wanted = np.zeros(queries.size, bool)
        held: dict[int, tuple[np.ndarray, pa.Array]] = {}
        for batch in batches:
            for part in _strides(batch):
                order = np.argsort(-part.column("norm").to_numpy(), kind="stable")
                part = part.take(pa.array(order))
                norm = part.column("norm").to_numpy()
                terms, ends = _flat(part.column("terms"))
                values, _ = _flat(part.column("impacts"))
                rows = np.repeat(np.arange(len(part)), np.diff(ends))
                posting = np.argsort(terms, kind="stable")
                first = np.searchsorted(terms[posting], np.arange(queries.size + 1))
                for number in range(len(lengths)):
                    near = int(np.searchsorted(-norm, -(least[number] / lengths[number] / _ROOM), "right"))
                    if not near:
                        continue
                    own = queries.of(number)
                    kept = _candidates(own, near, norm, rows, values, posting, first, least[number])
                    if not len(kept):
                        continue
                    wanted[own] = True
                    at, cuts = _spans(ends, kept)
                    score = _sums(values[at] * wanted[terms[at]], cuts)
                    wanted[own] = False
                    enough = score >= least[number]
                    _hold(held, least, number, k, score[enough], part.column("doc_id").take(pa.array(kept[enough])))
        for number, (score, ids) in held.items():
            items = pa.array(np.full(len(score), queries.numbers[number]), pa.int64())
            yield pa.RecordBatch.from_arrays([items, ids, pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    return search


def _candidates(own, near, norm, rows, values, posting, first, least) -> np.ndarray:
    """Documents among the ``near`` longest whose bound reaches ``least``: exact in the focus, Cauchy-Schwarz elsewhere."""
    exact, squares = np.zeros(near), np.zeros(near)
    for term in own[:FOCUS]:
        entries = posting[first[term] : first[term + 1]]
        entries = entries[: np.searchsorted(rows[entries], near)]  # postings are in the order of rows
        value = values[entries].astype(np.float64)
        exact[rows[entries]] += value
        squares[rows[entries]] += value * value
    rest = np.sqrt(np.maximum(norm[:near] ** 2 * _ROOM - squares, 0))
    bound = exact + math.sqrt(max(len(own) - FOCUS, 0)) * rest
    return np.flatnonzero(bound * _ROOM >= least)


def _hold(held: dict, least: np.ndarray, number: int, k: int, score: np.ndarray, ids: pa.Array) -> None:
    """Keep the best ``k`` of a query; the worst of them is its threshold here."""
    if number in held:
        score = np.concatenate((held[number][0], score))
        ids = pa.concat_arrays([held[number][1], ids])
    if len(score) > k:
        table = pa.table({"score": score, "id": ids, "at": np.arange(len(score))})
        order = table.sort_by([("score", "descending"), ("id", "ascending")])["at"].to_numpy()
        # Arrow puts nulls last, the ranking first.
        empty = ids.is_null().to_numpy(zero_copy_only=False)
        if empty.any():
            order = order[np.lexsort((np.arange(len(order)), ~empty[order], -score[order]))]
        order = order[:k]
        score, ids = score[order], ids.take(pa.array(order))
    if len(score):
        held[number] = (score, ids)
    if len(score) == k:
        least[number] = max(least[number], int(score.min()))


def _strides(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a bounded number of coordinates, or one document."""
    sizes = batch.column("terms").value_lengths().to_numpy()
    for lo, hi in strided(len(batch), np.concatenate(([0], np.cumsum(sizes))), _SLICE):
        yield batch.slice(lo, hi - lo)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column without nulls, and where each list starts, plus the end."""
    return lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sum of each run of values; 0 for empty ones."""
    out = np.zeros(len(ends) - 1, values.dtype)
    full = np.flatnonzero(np.diff(ends) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, ends[:-1][full])
    return out


def _spans(ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the coordinates of some rows, and where each row's start among them."""
    sizes = (ends[1:] - ends[:-1])[rows]
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    return np.arange(cuts[-1]) + np.repeat(ends[rows] - cuts[:-1], sizes), cuts
