"""Quality rules: zstandard ratios of whole texts and of fixed chunks, within limits for their lengths.

A text that says little new compresses to a small part of its size, noise hardly at all. What is usual depends on the
length, as a short text has little to refer back to, so limits belong to bands of lengths. Whole ratios see repetition
at a distance, chunk ratios a repetitive or incompressible passage inside an ordinary text. One pass, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.words import byte_values, light, shingle_hashes, text_bytes, word_hashes


@dataclass(frozen=True)
class Band:
    """Limits of the ratio (compressed size by size) for texts of ``size`` bytes up to the next band's."""

    size: int
    low: float
    high: float


#: Production limits. Texts below the first band are too short for a ratio to say anything.
BANDS = (
    Band(128, 0.40, 1.10),
    Band(256, 0.32, 0.92),
    Band(512, 0.28, 0.86),
    Band(1024, 0.24, 0.82),
    Band(2048, 0.20, 0.78),
    Band(4096, 0.17, 0.75),
    Band(8192, 0.15, 0.72),
    Band(65536, 0.10, 0.70),
)
#: Bytes in a chunk; a remainder of half a chunk or more is one too, a shorter one belongs to the chunk before it.
CHUNK = 2048
#: Share of a text's bytes that may lie in chunks outside their limits.
CHUNK_SHARE = 0.34
#: Fixed, so that verdicts are the same on every machine.
LEVEL = 3

#: Fixed values of the base rules.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30

_BYTES = np.arange(256)
_WORDS = byte_values(_BYTES, ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))))
_LINES = byte_values(_BYTES, _BYTES != 0x0A)
_SYMBOL = np.isin(_BYTES, [ord(c) for c in "#*$%&|<>"])
_BEGINS = (_BYTES & 0xC0) != 0x80  # the first byte of a code point


def _per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many marked bytes each text has."""
    total = np.concatenate(([0], np.cumsum(marks)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _owners(ends: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(ends) - 1), np.diff(ends))


def _repeats(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of values in the order of their texts: which occur in their text before, and which there at all more than once."""
    order = np.lexsort((np.arange(len(value)), value, owner))
    same = np.zeros(len(value), bool)
    same[1:] = (owner[order][1:] == owner[order][:-1]) & (value[order][1:] == value[order][:-1])
    again, shared = np.zeros(len(value), bool), np.zeros(len(value), bool)
    again[order] = same
    shared[order] = same | np.concatenate((same[1:], [False]))
    return again, shared


def _lines_again(texts: pa.Array, is_space: np.ndarray, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text, its lines with a word that equal an earlier line."""
    lines, ends = word_hashes(texts, _LINES)
    begins = np.zeros(len(raw) + 1, bool)
    begins[bounds] = True
    inside = raw != 0x0A
    first = inside & (begins[:-1] | np.concatenate(([True], ~inside[:-1])))
    with_word = np.add.reduceat((~is_space & inside).astype(np.int64), np.flatnonzero(first)) > 0 if first.any() else np.zeros(0, bool)
    again, _ = _repeats(_owners(ends), lines)
    total = np.concatenate(([0], np.cumsum(again & with_word)))
    return total[ends[1:]] - total[ends[:-1]]


def _words_again(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text, its words inside runs of ``WINDOW`` words that occur in it twice or more."""
    counts = np.diff(bounds)
    runs, ends = shingle_hashes(words, bounds, WINDOW)
    owner = _owners(ends)
    _, shared = _repeats(owner, runs)
    shared &= counts[owner] >= WINDOW  # a shorter text has no window
    # A word is covered where a shared run began less than a window before it.
    change = np.zeros(len(words) + WINDOW + 1, np.int64)
    starts = (np.arange(len(runs)) - ends[owner] + bounds[owner])[shared]
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    total = np.concatenate(([0], np.cumsum(np.cumsum(change)[: len(words)] > 0)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _verdict(raw: memoryview, compressor: zstandard.ZstdCompressor, bands: Sequence[Band], chunk: int) -> tuple[float | None, bool, float]:
    """The whole ratio (null below the first band), whether it is outside its limits, and the share of bytes in bad chunks."""
    size = len(raw)
    ratio = _ratio(raw, compressor)
    if size < bands[0].size:
        return None, False, 0.0
    bad, at = 0, 0
    while at < size and size > chunk:
        end = at + chunk if size - at - chunk >= chunk // 2 else size
        if _outside(_ratio(raw[at:end], compressor), end - at, bands):
            bad += end - at
        at = end
    return ratio, _outside(ratio, size, bands), bad / size


def _ratio(raw: memoryview, compressor: zstandard.ZstdCompressor) -> float:
    return len(compressor.compress(raw)) / max(len(raw), 1)


def _outside(ratio: float, size: int, bands: Sequence[Band]) -> bool:
    band = next((b for b in reversed(bands) if size >= b.size), None)
    return band is not None and not band.low <= ratio <= band.high


def rules(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    bands: Sequence[Band] = BANDS,
    chunk: int = CHUNK,
    chunk_share: float = CHUNK_SHARE,
) -> DataFrame:
    """Per document row its counts, ratios and verdicts.

    ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (words are ``[^\\x20\\x09-\\x0D]+``),
    ``base_failed`` (under 20 words, or over 30 % of them in repeated windows of 8 words), ``ratio`` (compressed by whole
    UTF-8 size; null for texts shorter than the first band), ``bad_chunks`` (share of bytes in chunks outside their limits),
    ``compression_failed`` and ``kept``. A null text is an empty one and has no words. Repeated rows and null ids stay;
    an empty table gives no rows; other columns are ignored. Whole texts are compressed, however long.
    """
    bands = tuple(sorted(bands, key=lambda b: b.size))
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=True)
        for batch in light(batches):
            texts = batch.column("text")
            raw, cuts = text_bytes(texts)
            words, bounds = word_hashes(texts, _WORDS)
            is_space = _WORDS[raw] == 0
            view = memoryview(np.ascontiguousarray(raw))
            found = [_verdict(view[a:b], compressor, bands, chunk) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            ratio, outside, bad = zip(*found) if found else ((), (), ())
            n_words, repeated = np.diff(bounds), _words_again(words, bounds)
            base_failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n_words)
            failed = np.array(outside, bool) | (np.array(bad, float) > chunk_share)
            counts = (n_words, _per_text(_BEGINS[raw] & ~is_space, cuts), _per_text(_SYMBOL[raw], cuts), _lines_again(texts, is_space, raw, cuts), repeated)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array(base_failed),
                    pa.array(ratio, pa.float64()),
                    pa.array(bad, pa.float64()),
                    pa.array(failed),
                    pa.array(~base_failed & ~failed),
                ],
                [f"c{i}" for i in range(11)],
            )

    return given.mapInArrow(
        measure,
        f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, ratio double, bad_chunks double, compression_failed boolean, kept boolean",
    )
