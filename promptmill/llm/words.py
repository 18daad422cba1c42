"""Word and shingle hashes of whole Arrow text columns, computed on the raw UTF-8 bytes.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z: in UTF-8 that is a run of
digits, ASCII letters and bytes from 0x80 on, so no decoding is needed. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The same words as a pattern, for SQL and for plain Python models.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_CHUNK = 1 << 13
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_SHINGLE = np.uint64(0xD1342543DE82EF95)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits; a bijection."""
    values = values ^ (values >> np.uint64(33))
    values = values * _MIX[0]
    values = values ^ (values >> np.uint64(33))
    values = values * _MIX[1]
    return values ^ (values >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    table = np.full(n, base, np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


def byte_values(byte: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A 64-bit value for each of the 256 bytes, by what it counts as; 0 for those that separate words."""
    return np.where(word, mix(byte.astype(np.uint64) + _BASE) | np.uint64(1), np.uint64(0))


def _folded() -> np.ndarray:
    """Values that are equal for A-Z and a-z, for words of digits, ASCII letters and bytes from 0x80 on."""
    byte = np.arange(256)
    lower = np.where((byte >= 0x41) & (byte <= 0x5A), byte + 32, byte)
    word = ((lower >= 0x30) & (lower <= 0x39)) | ((lower >= 0x61) & (lower <= 0x7A)) | (lower >= 0x80)
    return byte_values(lower, word)


_VALUES = _folded()
_UP, _DOWN = _powers(_BASE, _CHUNK), _powers(_INVERSE, _CHUNK)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text starts in them, plus the end."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_hashes(texts: pa.Array, values: np.ndarray = _VALUES) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word in order, and where each text's words start, plus the end.

    ``values`` says what each byte counts as (``byte_values``). The bytes are worked through in pieces that end between words, so memory beyond the hashes
    does not depend on how long a text is (only on its longest word).
    """
    raw, bounds = text_bytes(texts)
    is_word = values != 0
    begins = np.zeros(len(raw) + 1, bool)
    begins[bounds] = True
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    at = 0
    while at < len(raw):
        end = min(at + _CHUNK, len(raw))
        if end < len(raw):
            gaps = np.flatnonzero(~is_word[raw[at:end]] | begins[at:end])
            if len(gaps) and gaps[-1]:
                end = at + int(gaps[-1])
            else:  # one word fills the piece: take it whole
                step = _CHUNK
                while end < len(raw):
                    later = np.flatnonzero(~is_word[raw[end : end + step]] | begins[end : end + step][: len(raw[end : end + step])])
                    if len(later):
                        end += int(later[0])
                        break
                    end = min(end + step, len(raw))
        piece = raw[at:end]
        own = values[piece]
        word = own != 0
        first = word.copy()
        first[1:] &= ~word[:-1] | begins[at + 1 : end]
        starts = np.flatnonzero(first)
        if len(starts):
            n = len(piece)
            up, down = (_UP, _DOWN) if n <= _CHUNK else (_powers(_BASE, n), _powers(_INVERSE, n))
            places.append(starts + at)
            hashes.append(np.add.reduceat(own * up[:n], starts) * down[starts])
        at = end
    place = np.concatenate(places)
    return mix(np.concatenate(hashes)), np.searchsorted(place, bounds)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of ``size`` words of a text, and where each text's runs start, plus the end.

    A text with fewer words, but not none, has one run of all its words.
    """
    counts = np.diff(bounds)
    runs = np.maximum(counts - size + 1, (counts > 0).astype(counts.dtype))
    ends = np.concatenate(([0], np.cumsum(runs)))
    first = np.arange(ends[-1]) + np.repeat(bounds[:-1] - ends[:-1], runs)
    width = np.repeat(counts, runs) if (counts < size).any() else None
    total = np.zeros(len(first), np.uint64)
    for j in range(size):
        if width is None:
            total = total * _SHINGLE + words[first + j]
        else:
            inside = width > j
            total = total * _SHINGLE + np.where(inside, words[np.where(inside, first + j, 0)], np.uint64(0))
    return mix(total), ends


def light(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of text, or one row: hashes take several times the text."""
    for batch in batches:
        bounds = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())))
        for lo, hi in strided(len(batch), bounds, most):
            yield batch.slice(lo, hi - lo)


def strided(rows: int, bounds: np.ndarray, most: int):
    """Ranges of texts that hold at most ``most`` items together, or one text."""
    at = 0
    while at < rows:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
        yield at, min(end, rows)
        at = min(end, rows)


def ragged(values: pa.Array, ends: np.ndarray) -> pa.Array:
    """A list column of ``values`` cut at ``ends`` (the first is 0)."""
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), values).cast(pa.list_(values.type))


def signed(values: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's signed longs."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))
