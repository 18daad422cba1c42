"""Cross-entropy difference: how much better a target language model predicts a text than a background one.

Both models are bigram models interpolated with unigrams, over one vocabulary: every word and every bigram of the corpus
counts, at every size. Counts are never gathered in one place. Documents are dealt into blocks of some million words as
they are read; a block is stored with its words as numbers, and sends its counts of each distinct word and bigram, neighbours in
the order of keys in one row, as the gaps between them. The rows meet by the first bits of the keys and are summed by key; what
other blocks have counted goes back in the order in which a block has sent its keys, so that it needs neither keys nor places. The
stored blocks are bucketed by number, so that only the sums are shuffled to them, and texts never are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.words import light, mix, ragged, signed, word_hashes
from promptmill.session import discard, materialise, shared_dir

#: Weight of the bigram estimate where the history occurs.
PAIR_WEIGHT = 0.5
#: Words in a block, about; a longer text is a block of its own.
BLOCK_WORDS = 1_000_000
#: Bytes of text that are read at once, so that a block is not much larger.
_READ_BYTES = 1 << 19

#: What a block's words are mixed with for each kind of key: that of a word or of two words.
_WORD, _PAIR = (np.uint64(s) for s in (0x9E3779B97F4A7C15, 0x165667B19E3779F9))
#: The history of a text's first word.
_START = np.uint64(0x27D4EB2F165667C5)
#: First bits of a key that name its range, at least and at most; between them at least half as many ranges as blocks, of one or two million keys.
_LEAST_BITS, _MOST_BITS = 9, 16
#: Low bytes of the gaps between a block's keys, which are as good as random and are not compressed.
_PLAIN = 5


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers as the lowest bytes of all, then the next, and so on."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def _packed(*columns: np.ndarray, plain: int = 0) -> bytes:
    """64-bit columns of one length in few bytes; the lowest ``plain`` bytes of the first are left as they are."""
    raw, cut = b"".join(map(_planes, columns)), plain * len(columns[0])
    return raw[:cut] + pa.compress(raw[cut:], codec="zstd", asbytes=True)


def _unpacked(packed: bytes, columns: int, size: int, plain: int = 0) -> np.ndarray:
    cut = plain * size
    raw = packed[:cut] + pa.decompress(packed[cut:], 8 * columns * size - cut, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(columns, 8, size)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64).reshape(columns, size)


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order and the place of each value among them; ``np.unique`` holds twice as much meanwhile."""
    order = np.argsort(values)
    values = values[order]
    new = np.diff(values, prepend=-1) > 0
    place = np.empty(len(values), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return values[new], place


class _Block:
    """The texts of a block by number of word, and its own counts of all keys that it needs."""

    def __init__(self, words: np.ndarray, ids: np.ndarray, ends: np.ndarray, counted: np.ndarray, target: np.ndarray):
        size = len(words) + 1
        full = np.flatnonzero(np.diff(ends) > 0)
        before = np.concatenate((ids[:1], ids[:-1]))
        before[ends[:-1][full]] = size - 1  # the last number stands for the start
        pairs, self.pair = _numbered(before * size + ids)
        del before
        self.ends, self.size = ends, size
        self.before, self.after = (half.astype(np.int32) for half in np.divmod(pairs, size))
        named = np.concatenate((words, [_START]))
        keys = np.concatenate((mix(words ^ _WORD), mix(mix(named[self.before] ^ _PAIR) + named[self.after])))
        self.counts = []
        for flags in (counted, counted & target):
            pair = np.bincount(self.pair, np.repeat(flags.astype(float), np.diff(ends)), len(pairs))
            self.counts.append(np.concatenate((np.bincount(self.after, pair, size - 1), pair)).astype(np.int64))
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def ranges(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``bits`` of the keys in order, each once, and where the keys with them begin, plus the end."""
        first = (self.keys >> np.uint64(64 - bits)).astype(np.int32)
        begins = np.flatnonzero(np.diff(first, prepend=-1))
        return first[begins], np.append(begins, len(first))

    def losses(self, totals: list[np.ndarray], texts: list[int], tokens: list[int], vocabulary: int) -> Iterator[np.ndarray]:
        """Summed loss of each text under the counts ``totals`` of the block's keys, for the background and the target."""
        for counts, starts, whole in zip(totals, texts, tokens):
            word, pair = np.split(counts.astype(float), [self.size - 1])
            single = (word + 1) / (whole + vocabulary + 1)
            history = np.concatenate((word, [starts]))
            weight = np.where(history > 0, PAIR_WEIGHT, 0.0)
            seen = np.maximum(history, 1)
            chance = weight[self.before] * pair / seen[self.before] + (1 - weight[self.before]) * single[self.after]
            loss, out = -np.log(chance)[self.pair], np.zeros(len(self.ends) - 1)
            full = np.flatnonzero(np.diff(self.ends))
            if len(full):
                out[full] = np.add.reduceat(loss, self.ends[:-1][full])
            yield out


def _stored_blocks(rows: DataFrame, kind: str) -> DataFrame:
    """One row per block: its words' hashes, and per text its id, whether it counts, and its words by number."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in light(batches, most=_READ_BYTES):
            found, bounds = word_hashes(batch.column("text"))
            held.append((found, np.diff(bounds), batch))
            size += len(found)
            if size >= BLOCK_WORDS:
                yield block(number, held)
                number, held, size = number + 1, [], 0
        if held:
            yield block(number, held)

    def block(number: int, held: list) -> pa.RecordBatch:
        words, ids = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        lists = [pa.concat_arrays([h[2].column(c) for h in held]) for c in ("doc_id", "counted")]
        lengths = pa.array(np.concatenate([h[1] for h in held]), pa.int32())
        columns = [pa.array([number], pa.int64())]
        for values in (*lists, lengths, pa.array(ids.astype(np.int32)), signed(words)):
            columns.append(ragged(values, np.array([0, len(values)])))
        return pa.RecordBatch.from_arrays(columns, ["block", "doc_ids", "counted", "lengths", "ids", "words"])

    return rows.mapInArrow(
        deal,
        f"block bigint, doc_ids array<{kind}>, counted array<boolean>, lengths array<int>, "
        "ids array<int>, words array<bigint>",
    )


def _columns(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, ...]:
    """Hashes of the words, words of the texts by number, lengths of the texts, whether they count and whether as target."""

    def values(name: str) -> np.ndarray:
        return batch.column(name)[row].values.to_numpy(zero_copy_only=False)

    counted, marked = values("counted").astype(bool), batch.column("marked")[row].values
    target = np.zeros(len(counted), bool)
    if marked is not None:
        target[marked.to_numpy(zero_copy_only=False)] = True
    return values("words").view(np.uint64), values("ids").astype(np.int64), values("lengths").astype(np.int64), counted, target


def _read_block(batch: pa.RecordBatch, row: int) -> _Block:
    words, ids, lengths, counted, target = _columns(batch, row)
    return _Block(words, ids, np.concatenate(([0], np.cumsum(lengths))), counted, target)


def score(
    docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", counted: str | None = None
) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, difference`` per row: mean losses per word, in nats.

    The background model counts every row, or those where the column ``counted`` is true; the target model those of them whose
    id is in ``target``. A low difference marks a text like the target. A word or bigram has the counts that it has
    in the whole corpus, however rare. The last word of a text is followed by its end, which is counted and not scored; a history
    that a model has not seen leaves its word to the unigrams, whose counts are one up. A null or empty text has no words and zeros throughout; repeated rows count each time and score
    alike; without target rows the target model is uniform; null ids are in no target; an empty table gives no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    counts_too = F.coalesce(F.col(counted), F.lit(False)) if counted else F.lit(True)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), counts_too.alias("counted"))
    name, buckets = f"lm_blocks_{uuid.uuid4().hex}", min(int(spark.conf.get("spark.sql.shuffle.partitions")), 10_000)
    path = f"{shared_dir(spark)}/{name}"
    blocks = _stored_blocks(rows, kind)
    blocks.write.option("path", path).bucketBy(buckets, "block").sortBy("block").saveAsTable(name)
    placed = spark.table(name).select("block", F.posexplode("doc_ids").alias("at", "doc_id"))
    wanted = target.select(F.col(doc_id).alias("doc_id")).distinct()
    # Ids grow with the documents, so they are merged at every size.
    marked = placed.join(wanted.hint("merge"), "doc_id", "left_semi").groupBy("block").agg(F.collect_list("at").alias("marked"))
    stored = spark.table(name).join(materialise(marked).hint("merge"), "block", "left")

    bits = min(max((spark.table(name).count() - 1).bit_length() - 1, _LEAST_BITS), _MOST_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                block = _read_block(batch, row)
                first, ends = block.ranges(bits)
                gaps = np.diff(block.keys, prepend=np.uint64(0))  # also of texts that do not count
                gaps[ends[:-1]] = block.keys[ends[:-1]] & np.uint64((1 << 64 - bits) - 1)
                columns = [gaps, *(c[block.order] for c in block.counts)]
                bodies = [_packed(*(c[lo:hi] for c in columns), plain=_PLAIN) for lo, hi in zip(ends, ends[1:])]
                number = pa.array(np.full(len(first), batch.column("block")[row].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first), number, pa.array(np.diff(ends)), pa.array(bodies, pa.binary())], ["range", "block", "size", "body"]
                )

    def total(rows: pa.Table) -> pa.Table:
        sizes, bodies = rows.column("size").to_numpy(), rows.column("body").to_pylist()
        gaps, *own = np.concatenate([_unpacked(b, 3, n, _PLAIN) for b, n in zip(bodies, sizes)], axis=1)
        ends = np.cumsum(sizes)
        keys = np.concatenate([np.cumsum(g) for g in np.split(gaps, ends[:-1])])
        distinct, place = np.unique(keys, return_inverse=True)
        more = [np.bincount(place, c, len(distinct)).astype(np.int64)[place] - c for c in own]
        replies = [_packed(*(c[hi - n : hi] for c in more)) for hi, n in zip(ends, sizes)]
        return rows.select(["block", "range"]).append_column("body", pa.array(replies, pa.binary()))

    # Each key occurs once per block, so a word of every text is in no more rows than there are blocks.
    sent = stored.mapInArrow(count, "range int, block bigint, size bigint, body binary")
    # What the other blocks count: of keys that a block alone holds, nothing.
    back = sent.groupBy("range").applyInArrow(total, "block bigint, range int, body binary")
    known = back.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("range", "body")))["body"].alias("more"))
    texts, tokens, vocabulary = _sizes(stored)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                block = _read_block(batch, row)
                totals = [c.copy() for c in block.counts]
                ends, bodies = block.ranges(bits)[1], batch.column("more")[row].as_py() or []
                for lo, hi, body in zip(ends[:-1], ends[1:], bodies, strict=True):
                    for own, more in zip(totals, _unpacked(body, 2, hi - lo)):
                        own[block.order[lo:hi]] += more
                words = np.diff(block.ends)
                background, wanted = (loss / np.maximum(words, 1) for loss in block.losses(totals, texts, tokens, vocabulary))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[row].values, pa.array(words), pa.array(wanted), pa.array(background), pa.array(wanted - background)],
                    ["doc_id", "n_tokens", "target_loss", "background_loss", "difference"],
                )

    joined = stored.join(known.hint("merge"), "block", "left")
    scored = joined.mapInArrow(apply, f"doc_id {kind}, n_tokens bigint, target_loss double, background_loss double, difference double")
    # Stored, so that the blocks can go.
    scored = materialise(scored)
    spark.sql(f"DROP TABLE {name}")
    discard(spark, path)
    return scored


def _sizes(stored: DataFrame) -> tuple[list[int], list[int], int]:
    """Texts with words and words, each of the background and of the target, and distinct words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                words, ids, lengths, counted, target = _columns(batch, row)
                each = [np.repeat(flags, lengths).astype(float) for flags in (counted, counted & target)]
                n, t = (np.bincount(ids, e, len(words)).astype(np.int64) for e in each)
                n_texts, t_texts = (int((flags & (lengths > 0)).sum()) for flags in (counted, counted & target))
                known = n > 0
                # A row without key counts the block's texts.
                keys = pa.concat_arrays([signed(words[known]), pa.nulls(1, pa.int64())])
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(np.append(n[known], n_texts)), pa.array(np.append(t[known], t_texts))], ["key", "n", "t"]
                )

    by_word = stored.mapInArrow(count, "key bigint, n bigint, t bigint").groupBy("key").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    found = by_word.groupBy(F.col("key").isNull().alias("texts")).agg(F.count("*").alias("keys"), F.sum("n").alias("n"), F.sum("t").alias("t"))
    sums = {r["texts"]: r for r in found.collect()}
    texts, words = ([sums[k]["n"], sums[k]["t"]] if k in sums else [0, 0] for k in (True, False))
    return texts, words, sums[False]["keys"] if False in sums else 0
