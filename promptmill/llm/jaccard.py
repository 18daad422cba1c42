"""Near-duplicate links between texts: MinHash banding, then a check on the full n-gram sets.

Equal texts are one class and are joined once. Bands are matched on narrow rows of (class, band, key); only classes that
share a band with another go on. They are dealt into blocks of bounded size; a task compares two blocks. A pair is
decided in the first band it shares, so no pair is ever written: tasks first name the classes whose sets they need,
then only the texts of these are read again, one of each class, and the tasks return link counts per class and a
spanning forest of the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.components import components
from promptmill.llm.membership import membership, passes
from promptmill.llm.words import light, mix, ragged, shingle_hashes, signed, strided, word_hashes
from promptmill.operators.skew import attach
from promptmill.session import materialise

_SLICE = 1 << 14
#: Classes in a block, and words in one on average: a task holds the sets of two blocks.
BLOCK, BLOCK_WORDS = 512, 1 << 20


def banding(threshold: float, recall: float, rows: int = 5) -> int:
    """Bands of ``rows`` hashes after which a pair at ``threshold`` is missed with 1 - ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def _band_keys(shingles: np.ndarray, ends: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per text and band; texts without shingles get zeros."""
    factors = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    keys = np.zeros((len(ends) - 1, bands), np.uint64)
    for lo, hi in strided(len(ends) - 1, ends, _SLICE):
        own, cuts = shingles[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo]
        full = np.flatnonzero(np.diff(cuts) > 0)
        if not len(full):
            continue
        for band in range(bands):
            key = np.full(len(full), band + 1, np.uint64)
            for factor in factors[band * rows : (band + 1) * rows]:
                key = mix(key ^ np.minimum.reduceat(own * factor, cuts[full]))
            keys[lo + full, band] = np.maximum(key, 1)  # 0 stands for none
    return keys


def _shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    parts, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for lo, hi in strided(len(bounds) - 1, bounds, _SLICE):
        hashes, ends = shingle_hashes(words[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo], size)
        parts.append(hashes)
        counts.append(np.diff(ends))
    return np.concatenate(parts), np.cumsum(np.concatenate(counts))


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, list]]:
    """Runs of rows with the same (band, key, p, q) in a sorted stream, held one run at a time."""
    current, held = None, []
    for batch in batches:
        given = batch.to_pydict()
        tasks = zip(given["band"], given["key"], given["p"], given["q"])
        for task, *rest in zip(tasks, *(given[c] for c in columns)):
            if task != current:
                if len(held) > 1:
                    yield current, held
                current, held = task, []
            held.append(rest)
    if len(held) > 1:
        yield current, held


def _compared(keys: np.ndarray, block: np.ndarray, task: tuple) -> np.ndarray:
    """Index pairs (i < j) that this task decides: their first common band is the task's. A key of 0 is in no band."""
    band, _, p, q = task
    if p == q:
        i, j = np.triu_indices(len(keys), 1)
    else:
        one, two = np.flatnonzero(block == p), np.flatnonzero(block == q)
        i, j = np.repeat(one, len(two)), np.tile(two, len(one))
    later = np.zeros(len(i), bool)
    for earlier in range(band):
        later |= (keys[i, earlier] == keys[j, earlier]) & (keys[i, earlier] != 0)
    return np.stack([i[~later], j[~later]])


def _overlaps(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Common shingles of each index pair."""
    if pairs.shape[1] <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in pairs.T])
    value = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, times = np.unique(value, return_inverse=True, return_counts=True)
    shared = times[place] > 1
    place, owner = place[shared], owner[shared]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096  # columns of the incidence matrix that are held at once
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(place, [low, low + width])
        if a < b:
            part = np.zeros((len(sets), width), np.float32)
            part[owner[a:b], place[a:b] - low] = 1
            common += part @ part.T
    return common[pairs[0], pairs[1]].round().astype(np.int64)


def _digest(text: str):
    """16 bytes that tell texts apart; a null text has one of its own."""
    return F.coalesce(F.unhex(F.md5(F.col(text).cast("binary"))), F.lit(b"null"))


def _text_classes(docs: DataFrame, doc_id: str, text: str, size: int, threshold: float, recall: float) -> DataFrame:
    """``digest, copy_of, n_links, class_id, first``: per text; ``first`` is the digest that stands for its class."""
    rows = 5
    bands = banding(threshold, recall, rows)
    given = docs.select(F.col(doc_id).alias("doc_id"), _digest(text).alias("digest"), F.col(text).alias("text"))
    kind = docs.select(doc_id).schema[0].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in light(batches):
            words, bounds = word_hashes(batch.column("text"))
            keys = _band_keys(*_shingles(words, bounds, size), bands, rows)
            keys = ragged(signed(keys.reshape(-1)), np.arange(len(batch) + 1) * bands)
            counts = pa.array(np.diff(bounds), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), counts, keys], ["doc_id", "digest", "n_words", "keys"]
            )

    signed_docs = given.mapInArrow(sign, f"doc_id {kind}, digest binary, n_words bigint, keys array<bigint>")
    classes = materialise(
        signed_docs.groupBy("digest").agg(
            F.min("doc_id").alias("copy_of"), F.max("n_words").alias("n_words"), F.max("keys").alias("keys")
        )
    ).withColumn("cls", F.monotonically_increasing_id())

    # Classes that share a band, dealt into blocks; a task (band, key, p, q) compares blocks p and q.
    banded = classes.filter("n_words > 0").select("cls", "n_words", F.posexplode("keys").alias("band", "key"))
    crowded = materialise(banded.groupBy("band", "key").agg(F.count("*").alias("n"), F.sum("n_words").alias("words")).filter("n > 1"))
    # Both sides are shuffled as they are, so that Spark can split a key that a third of all classes share.
    met = banded.drop("n_words").join(crowded, ["band", "key"])
    blocks = F.ceil(F.least("n", F.greatest(F.col("n") / BLOCK, F.col("words") / BLOCK_WORDS))).cast("int")
    shared = met.groupBy("cls").agg(F.collect_list(F.struct("band", "key", blocks.alias("blocks"))).alias("met"))
    by_band = F.map_from_entries(F.transform("met", lambda m: F.struct(m["band"], m["key"])))
    own = F.pmod(F.xxhash64("cls"), F.col("m.blocks")).cast("int")
    dealt = (
        shared.withColumn("by_band", by_band)
        .withColumn("keys", F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.coalesce(F.element_at("by_band", b), F.lit(0).cast("bigint"))))
        .select("cls", "keys", F.explode("met").alias("m"))
        .select("cls", "keys", "m.band", "m.key", own.alias("block"), F.explode(F.sequence(F.lit(0), F.col("m.blocks") - 1)).alias("other"))
        .select("band", "key", "cls", "keys", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))
    )
    task = ["band", "key", "p", "q"]

    needed_kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32())

    def name_needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for where, held in _groups(batches, ["cls", "keys", "block"]):
            pairs = _compared(np.array([h[1] for h in held]), np.array([h[2] for h in held]), where)
            out += [(*where, *held[used]) for used in np.unique(pairs).tolist()]
            if len(out) > 5_000:
                yield as_batch(out, needed_kinds)
                out = []
        if out:
            yield as_batch(out, needed_kinds)

    def as_batch(found: list[tuple], kinds: tuple) -> pa.RecordBatch:
        columns = [pa.array(values, kind) for values, kind in zip(zip(*found), kinds)]
        return pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

    needed = materialise(
        dealt.repartition(*task)
        .sortWithinPartitions(*task)
        .mapInArrow(
            name_needed,
            "band int, key bigint, p int, q int, cls bigint, keys array<bigint>, block int",
        )
    )

    # The texts of the named classes, one of each. A bitmap of fixed size leaves most other rows where they are.
    named = materialise(needed.select("cls").distinct().join(classes.select("cls", "digest", "copy_of"), "cls"))
    standing = F.xxhash64("digest", "doc_id").alias("standing")
    wanted = membership(named.select(F.xxhash64("digest", F.col("copy_of").alias("doc_id")).alias("standing")), "standing")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("standing").to_numpy().view(np.uint64)
            kept = batch.filter(pa.array(passes(wanted.value, hashes)))
            if len(kept):
                yield pa.RecordBatch.from_arrays([kept.column("digest"), kept.column("text")], ["digest", "text"])

    picked = given.select("digest", "text", standing).mapInArrow(pick, "digest binary, text string")
    texts = picked.groupBy("digest").agg(F.max("text").alias("text"))
    asked = needed.join(named.select("cls", "digest"), "cls")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_out: list[tuple[int, int, int]] = []
        for where, held in _groups(batches, ["cls", "keys", "block", "text"]):
            words, bounds = word_hashes(pa.array([h[3] for h in held], pa.large_string()))
            shingles, ends = _shingles(words, bounds, size)
            sets = [np.unique(shingles[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            pairs = _compared(np.array([h[1] for h in held]), np.array([h[2] for h in held]), where)
            if not pairs.shape[1]:
                continue
            lengths = np.array([len(s) for s in sets])
            common = _overlaps(sets, pairs)
            union = lengths[pairs[0]] + lengths[pairs[1]] - common
            linked = pairs[:, common >= threshold * union - 1e-9]
            links = np.bincount(linked.reshape(-1), minlength=len(held))
            root = np.arange(len(held))
            for i, j in linked.T:  # a spanning forest: union by smallest index
                while root[i] != i:
                    root[i] = i = root[root[i]]
                while root[j] != j:
                    root[j] = j = root[root[j]]
                root[max(i, j)] = min(i, j)
            for i in np.flatnonzero(links).tolist():
                rows_out.append((held[i][0], int(links[i]), held[int(root[i])][0]))
            if len(rows_out) > 10_000:
                yield as_batch(rows_out, (pa.int64(),) * 3)
                rows_out = []
        if rows_out:
            yield as_batch(rows_out, (pa.int64(),) * 3)

    found = materialise(
        asked.join(texts, "digest")
        .select(*task, "cls", "keys", "block", "text")
        .repartition(*task)
        .sortWithinPartitions(*task)
        .mapInArrow(verify, "cls bigint, links bigint, near bigint")
    )
    links = found.groupBy("cls").agg(F.sum("links").alias("n_links"))
    groups = components(found.select(F.col("cls").alias("a"), F.col("near").alias("b")))
    members = (
        classes.join(links, "cls", "left")
        .join(groups.withColumnRenamed("node", "cls"), "cls", "left")
        .select("digest", "copy_of", "n_links", F.coalesce("root", "cls").alias("root"))
    )
    least = F.min(F.struct(F.col("copy_of").isNull(), "copy_of", "digest"))
    named_groups = members.groupBy("root").agg(least.alias("least"))
    return attach(members, named_groups, ["root"], F.col("digest")).select(
        "digest",
        "copy_of",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.col("least.copy_of").alias("class_id"),
        F.col("least.digest").alias("first"),
    )


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    recall: float = 0.9999,
) -> DataFrame:
    """Per document row ``doc_id, copy_of, class_id, n_links``.

    ``copy_of`` is the smallest id with an equal text, ``n_links`` counts the other texts whose sets of
    ``size``-word shingles have Jaccard similarity of ``threshold`` or more, and ``class_id`` is the smallest
    id reached over links and copies. A text of fewer words is one shingle; texts without words link to
    nothing, but equal ones are copies of each other (null equals null, empty equals empty). Repeated rows are
    copies; null ids stay in the rows and name a class only if it has no other; an empty table gives no rows;
    other columns are ignored. A link at the threshold is found with probability ``recall`` at least.
    """
    classes = _text_classes(docs, doc_id, text, size, threshold, recall)
    rows = docs.select(F.col(doc_id).alias("doc_id"), _digest(text).alias("digest"))
    return rows.join(classes, "digest").select("doc_id", "copy_of", "class_id", "n_links")


def one_of_each(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    recall: float = 0.9999,
) -> DataFrame:
    """All columns of one row of each class of ``near_duplicates``: that of the smallest id.

    Of repeated rows with that id and text one stays.
    """
    classes = _text_classes(docs, doc_id, text, size, threshold, recall)
    kept = classes.filter("digest = first").select(F.col("digest").alias("_first"), F.col("class_id").alias("_least"))
    rows = docs.select(F.col(doc_id).alias("_id"), _digest(text).alias("_digest"), F.struct(*docs.columns).alias("_row"))
    same = F.col("_id").eqNullSafe(F.col("_least")) & (F.col("_digest") == F.col("_first"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["_id", "_digest"]).select("_row.*")
