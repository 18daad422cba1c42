"""Which documents quote benchmark items: a prefix-filtered set join over item windows.

A window is a run of ``window`` words of an item (an item of fewer words is one window). As a set of
word shingles, a window lies in a text only if all its shingles do, so one necessary prefix token is
enough: the shingle that is rarest in the documents. Texts send only the positions of such
shingles to the join, which checks the position and length bounds and compares the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.membership import membership, passes
from promptmill.llm.words import light, ragged, shingle_hashes, signed, strided, word_hashes
from promptmill.session import materialise

_SLICE = 1 << 14


def _windows(items: DataFrame, item: str, text: str, window: int, shingle: int) -> DataFrame:
    """One row per item window: its words and its shingles, as hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, bounds = word_hashes(batch.column("text"))
            rows: dict[str, list] = {"item": [], "words": [], "shingles": []}
            for i, name in enumerate(batch.column("item").to_pylist()):
                own = words[bounds[i] : bounds[i + 1]]
                for at in range(max(len(own) - window + 1, min(len(own), 1))):
                    run = own[at : at + window]
                    parts, _ = shingle_hashes(run, np.array([0, len(run)]), min(shingle, len(run)))
                    rows["item"].append(name)
                    rows["words"].append(run.view(np.int64))
                    rows["shingles"].append(parts.view(np.int64))
            kinds = (pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], list(rows))

    given = items.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    return given.mapInArrow(cut, "item string, words array<bigint>, shingles array<bigint>")


def _runs(words: np.ndarray, bounds: np.ndarray, shingle: int, widths: list[int]):
    """Hashes of all word runs of the needed widths, with place in ``words``, text by text slice."""
    for lo, hi in strided(len(bounds) - 1, bounds, _SLICE):
        own, cuts = words[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
        for width in widths:
            hashes, ends = shingle_hashes(own, cuts, width)
            counts = np.diff(ends)
            place = np.arange(len(hashes)) + np.repeat(cuts[:-1] - ends[:-1], counts)
            whole = np.repeat(np.diff(cuts) >= width, counts)
            # A run shorter than the width is not a run of that width.
            yield lo, hashes[whole], place[whole] + bounds[lo], np.repeat(np.arange(lo, hi), counts)[whole]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    shingle: int = 5,
) -> DataFrame:
    """Per document row: ``doc_id, digest, n_words, n_hit, items`` (sorted item ids as strings).

    A word is hit when it lies inside any occurrence of an item window. Null and empty texts have
    no words and no hits; items without words match nothing and null item ids are left out of
    ``items``; ``digest`` is the text's hash, to find the row again; repeated rows each get their result; an empty item table gives no hits; other columns are ignored.
    """
    windows = materialise(_windows(items, item_id, item_text, window, shingle).distinct())
    widths = sorted(
        row[0] for row in windows.select(F.least(F.size("words"), F.lit(shingle))).distinct().collect()
    )  # at most ``shingle`` values
    given = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(doc_text).alias("_digest"), F.col(doc_text).alias("text")
    )
    known = membership(windows.select(F.explode("shingles").alias("h")), "h")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in light(batches):
            words, bounds = word_hashes(batch.column("text"))
            found = [h[passes(known.value, h)] for _, h, _, _ in _runs(words, bounds, shingle, widths)]
            if found:
                hashes, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([signed(hashes), pa.array(counts, pa.int64())], ["h", "n"])

    seen = given.select("text").mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "offset"))
    prefixes = materialise(
        windows.select("item", "words", F.posexplode("shingles").alias("offset", "h"))
        .join(seen, "h", "left")
        .groupBy("item", "words")
        .agg(rarest.alias("rarest"))
        .filter("rarest.n > 0")
        .select("item", "words", "rarest.h", "rarest.offset")
    )
    wanted = membership(prefixes, "h")
    before = window - min(widths, default=1)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in light(batches):
            words, bounds = word_hashes(batch.column("text"))
            hits = []
            for _, hashes, place, row in _runs(words, bounds, shingle, widths):
                good = np.flatnonzero(passes(wanted.value, hashes))
                if len(good):
                    hits.append((row[good], place[good], hashes[good]))
            row, place, hashes = (
                np.concatenate(x) if hits else np.zeros(0, np.int64) for x in (zip(*hits) if hits else ((), (), ()))
            )
            order = np.argsort(row, kind="stable")
            row, place, hashes = row[order], place[order], hashes[order].astype(np.uint64)
            left = np.minimum(place - bounds[row], before)
            right = np.minimum(bounds[row + 1] - place, window)
            ends = np.concatenate(([0], np.cumsum(left + right)))
            around = np.arange(ends[-1]) + np.repeat(place - left - ends[:-1], left + right)
            found = pa.StructArray.from_arrays(
                [signed(hashes), pa.array(place - bounds[row], pa.int64()), pa.array(left, pa.int64()), ragged(signed(words[around]), ends)],
                ["h", "at", "before", "around"],
            )
            per_text = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(batch)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_digest"), pa.array(np.diff(bounds), pa.int64()), ragged(found, per_text)],
                ["doc_id", "_digest", "n_words", "found"],
            )

    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    located = materialise(
        given.mapInArrow(
            locate,
            f"doc_id {kind}, _digest bigint, n_words bigint, "
            "found array<struct<h: bigint, at: bigint, before: bigint, around: array<bigint>>>",
        )
    )
    matches = (
        located.filter(F.size("found") > 0)
        .select("doc_id", "_digest", F.inline("found"))
        .join(prefixes, "h")
        .filter(F.col("before") >= F.col("offset"))
        .filter(F.size("around") - F.col("before") + F.col("offset") >= F.size("words"))
        .filter(F.slice("around", F.col("before").cast("int") - F.col("offset") + 1, F.size("words")) == F.col("words"))
        .select("doc_id", "_digest", "item", (F.col("at") - F.col("offset")).alias("start"), F.size("words").alias("size"))
    )

    def covered(done, span):
        end = span["start"] + span["size"]
        fresh = F.greatest(F.lit(0).cast("bigint"), end - F.greatest(span["start"], done["end"]))
        return F.struct((done["n"] + fresh).alias("n"), F.greatest(done["end"], end).alias("end"))

    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    per_doc = (
        matches.groupBy(F.col("doc_id").alias("_doc"), F.col("_digest").alias("_text"))
        .agg(
            F.sort_array(F.collect_set(F.struct("start", "size"))).alias("spans"),
            F.sort_array(F.collect_set("item")).alias("items"),
        )
        .select("_doc", "_text", "items", F.aggregate("spans", zero, covered)["n"].alias("n_hit"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_digest") == F.col("_text"))
    return located.join(per_doc, same, "left").select(
        "doc_id",
        F.col("_digest").alias("digest"),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def clean(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    share: float = 0.05,
    **names,
) -> DataFrame:
    """All columns of the rows of which less than ``share`` of the words is hit, or none."""
    found = contamination(docs, items, doc_id=doc_id, doc_text=doc_text, **names)
    dirty = found.filter((F.col("n_hit") > 0) & (F.col("n_hit") >= F.col("n_words") * share)).select(
        F.col("doc_id").alias("_dirty"), F.col("digest").alias("_digest")
    )
    same = docs[doc_id].eqNullSafe(dirty["_dirty"]) & (F.xxhash64(docs[doc_text]) == dirty["_digest"])
    return docs.join(dirty, same, "left_anti")
