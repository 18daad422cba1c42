"""MinHash signatures and band keys.

Signatures use the widespread public scheme (32 bits of SHA-1 per shingle, universal hashing modulo
the Mersenne prime 2**61-1, permutations drawn from a seeded Mersenne Twister), so the same
text gets the same signature as with the common Python MinHash packages.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SHINGLE_SIZE = 5

# Modulus and output range of the universal hash family.
_PRIME = np.uint64((1 << 61) - 1)
_MAX_HASH = np.uint64((1 << 32) - 1)

_BITS = np.uint64(61)
_ONE = np.uint64(1)

# A task forgets its shingle cache beyond so many shingles or low hash values and reads texts in chunks of so many
# windows. Together they bound its memory to some 200 MB whatever the length of a text.
_KNOWN, _CACHE_VALUES = 1_000_000, 6_000_000
_CHUNK = 200_000
_LOW = np.uint64(1 << 26)


@dataclass(frozen=True)
class BandShape:
    """``bands`` groups of ``rows`` signature values each."""

    bands: int
    rows: int

    def hit_probability(self, similarity: float) -> float:
        return 1.0 - (1.0 - similarity**self.rows) ** self.bands


@lru_cache(maxsize=64)
def balanced_shape(threshold: float, num_perm: int = 128) -> BandShape:
    """The shape with the least expected error around ``threshold``.

    False positives below and false negatives above the threshold weigh the same; both areas
    are midpoint sums over the S-curve of the band hit probability.
    """
    step = 0.001
    below = np.arange(0.0, threshold, step) + step / 2
    above = np.arange(threshold, 1.0, step) + step / 2
    best, least = BandShape(1, 1), float("inf")
    for bands in range(1, num_perm + 1):
        for rows in range(1, num_perm // bands + 1):
            miss_below = (1.0 - below**rows) ** bands
            miss_above = (1.0 - above**rows) ** bands
            error = 0.5 * step * ((1.0 - miss_below).sum() + miss_above.sum())
            if error < least:
                best, least = BandShape(bands, rows), error
    return best


@lru_cache(maxsize=64)
def recall_shape(threshold: float, num_perm: int = 128, miss: float = 1e-6) -> BandShape:
    """The most selective shape that misses a pair at ``threshold`` with at most ``miss``."""
    for rows in range(num_perm, 0, -1):
        shape = BandShape(num_perm // rows, rows)
        if 1.0 - shape.hit_probability(threshold) <= miss:
            return shape
    return BandShape(num_perm, 1)


@lru_cache(maxsize=64)
def voting_shape(threshold: float, num_perm: int, votes: int = 3, miss: float = 1e-6) -> tuple[BandShape, int]:
    """The most selective shape of which a pair at ``threshold`` shares ``votes`` bands, but with at most ``miss``.

    Unlike texts that share a band or two by chance are left out. Fewer permutations may not afford votes: then one band is enough.
    """
    for rows in range(num_perm // votes, 0, -1):
        hit = threshold**rows

        def missed(bands: int) -> float:
            return sum(comb(bands, k) * hit**k * (1.0 - hit) ** (bands - k) for k in range(votes))

        bands = num_perm // rows
        if missed(bands) <= miss:
            while bands > votes and missed(bands - 1) <= miss:
                bands -= 1
            return BandShape(bands, rows), votes
    return recall_shape(threshold, num_perm, miss), 1


@lru_cache(maxsize=8)
def permutations(num_perm: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of the hash family, drawn pairwise from the seeded generator."""
    source = np.random.RandomState(seed)
    draws = [
        source.randint(low, int(_PRIME), dtype=np.uint64)
        for _ in range(num_perm)
        for low in (1, 0)
    ]
    return np.array(draws[0::2], dtype=np.uint64), np.array(draws[1::2], dtype=np.uint64)


class _Signer:
    """Signs texts in chunks by the low hash values of their shingles.

    Nearly all minima of a text with some hundred shingles lie below ``_LOW``, which one hash value in 64 does. A shingle's low values
    are found once while the cache lasts; texts gather those alone. Where a minimum is not among them, it is taken over
    all hash values, so the signature is exact for every text.
    """

    def __init__(self, multipliers: np.ndarray, offsets: np.ndarray):
        self.a, self.b = multipliers, offsets
        self.num_perm = len(multipliers)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # of known shingles, sorted
        self.hashes = np.zeros(0, np.uint64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.used = 0
        self.perm, self.value = np.zeros(4096, np.int16), np.zeros(4096, np.uint32)  # low values, by shingle

    def sign(self, texts: list[str]) -> np.ndarray:
        """One row of ``num_perm`` values per text."""
        signatures = np.full((len(texts), self.num_perm), _MAX_HASH, dtype=np.uint32)
        pieces: list[tuple[int, str]] = []
        pending = 0
        for number, text in enumerate(texts):
            windows = len(text) - SHINGLE_SIZE + 1
            for first in range(0, windows, _CHUNK):
                last = min(first + _CHUNK, windows)
                pieces.append((number, text[first : last + SHINGLE_SIZE - 1]))
                pending += last - first
                if pending >= _CHUNK:
                    self._sign_pieces(pieces, signatures)
                    pieces, pending = [], 0
        if pieces:
            self._sign_pieces(pieces, signatures)
        return signatures

    def _sign_pieces(self, pieces: list[tuple[int, str]], signatures: np.ndarray) -> None:
        if len(self.keys) > _KNOWN or self.used > _CACHE_VALUES:
            self._forget()
        joined = "".join(piece for _, piece in pieces)
        overlap = SHINGLE_SIZE - 1
        lengths = np.array([len(piece) for _, piece in pieces])
        ends = np.cumsum(lengths)
        inside = np.ones(len(joined) - overlap, dtype=bool)
        for back in range(1, overlap + 1):
            inside[ends[:-1] - back] = False
        starts = np.flatnonzero(inside)
        window_keys = _window_keys(joined)[starts]
        codes, keys = pd.factorize(window_keys)
        places = self._places(keys, codes, starts, joined)
        # A row of a text is the number of its piece; a shingle that comes again in a piece counts once.
        piece = np.repeat(np.arange(len(pieces)), lengths - overlap)
        distinct = pd.unique(piece * len(keys) + codes)
        piece, codes = distinct // len(keys), distinct % len(keys)
        lows = np.full((len(pieces), self.num_perm), _MAX_HASH, dtype=np.uint32)
        self._scatter(piece, places[codes], lows)
        bounds = np.searchsorted(piece, np.arange(len(pieces) + 1))
        absent = lows >= _LOW
        for i in np.flatnonzero(absent.any(axis=1)).tolist():
            perms = np.flatnonzero(absent[i])
            grams = self.hashes[places[codes[bounds[i] : bounds[i + 1]]]]
            for j in range(0, len(grams), 4096):
                least = self._hashed(grams[j : j + 4096], perms).min(axis=0).astype(np.uint32)
                lows[i, perms] = np.minimum(lows[i, perms], least)
        for i, (number, _) in enumerate(pieces):
            np.minimum(signatures[number], lows[i], out=signatures[number])

    def _scatter(self, piece: np.ndarray, place: np.ndarray, lows: np.ndarray) -> None:
        """Lower ``lows`` of each piece to the low values of the shingles at ``place``."""
        step = max(1, _CHUNK * 128 // self.num_perm)
        flat = lows.reshape(-1)
        for low in range(0, len(piece), step):
            count = self.count[place[low : low + step]]
            row = np.repeat(piece[low : low + step] * self.num_perm, count)
            at = np.arange(len(row)) + np.repeat(self.first[place[low : low + step]] - (np.cumsum(count) - count), count)
            np.minimum.at(flat, row + self.perm[at], self.value[at])

    def _places(self, keys: np.ndarray, codes: np.ndarray, starts: np.ndarray, joined: str) -> np.ndarray:
        """Where the shingles ``keys`` are known; new ones are hashed."""
        order = np.argsort(keys)
        ranked = keys[order]
        at = np.searchsorted(self.keys, ranked)
        known = np.zeros(len(keys), dtype=bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == ranked
        new = order[~known]
        if len(new):
            example = np.empty(len(keys), np.int64)
            example[codes] = starts
            hashes, first, count = self._learn([joined[i : i + SHINGLE_SIZE] for i in example[new].tolist()])
            self.keys = np.insert(self.keys, at[~known], ranked[~known])
            self.hashes = np.insert(self.hashes, at[~known], hashes)
            self.first = np.insert(self.first, at[~known], first)
            self.count = np.insert(self.count, at[~known], count)
        places = np.empty(len(keys), np.int64)
        # New shingles before one move it up.
        places[order] = at + np.cumsum(~known) - ~known
        return places

    def _learn(self, grams: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The hashes of new shingles, and where their low values are."""
        digests = b"".join([hashlib.sha1(g.encode("utf-8")).digest()[:4] for g in grams])
        hashes = np.frombuffer(digests, dtype="<u4").astype(np.uint64)
        every, count = np.arange(self.num_perm), np.zeros(len(hashes), np.int64)
        begin = self.used
        for low in range(0, len(hashes), 512):
            values = self._hashed(hashes[low : low + 512], every)
            row, perm = np.nonzero(values < _LOW)
            count[low : low + 512] = np.bincount(row, minlength=len(values))
            end = self.used + len(row)
            if end > len(self.perm):
                self.perm, self.value = (np.resize(kept, end + end // 2) for kept in (self.perm, self.value))
            self.perm[self.used : end], self.value[self.used : end] = perm, values[row, perm]
            self.used = end
        return hashes, begin + np.cumsum(count) - count, count

    def _hashed(self, hashes: np.ndarray, perms: np.ndarray) -> np.ndarray:
        """The hash values of shingles, a column per permutation."""
        x = hashes[:, None] * self.a[perms]
        x += self.b[perms]
        # Reduce modulo 2**61-1 by folding the high bits, the second time with a carry.
        high = x >> _BITS
        x &= _PRIME
        x += high
        np.add(x, _ONE, out=high)
        high >>= _BITS
        x += high
        x &= _MAX_HASH
        return x


def _window_keys(text: str) -> np.ndarray:
    """A 64-bit key per window of five code points, mixed from its 105 bits."""
    c = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    n = len(c) - SHINGLE_SIZE + 1
    low = c[:n] | (c[1 : n + 1] << np.uint64(21)) | (c[2 : n + 2] << np.uint64(42))
    high = c[3 : n + 3] | (c[4 : n + 4] << np.uint64(21))
    low = low * np.uint64(0x9E3779B97F4A7C15)
    low ^= low >> np.uint64(32)
    return low * np.uint64(0xD6E8FEB86659FD93) + high * np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The distinct 5-grams of each text as sorted 64-bit keys."""
    return [
        np.unique(_window_keys(text)) if text and len(text) >= SHINGLE_SIZE else np.zeros(0, np.uint64) for text in texts
    ]


def band_hashes(signatures: np.ndarray, shape: BandShape, bits: int) -> np.ndarray:
    """One key of ``bits`` bits per text and band of a matrix of signatures."""
    keys = np.empty((len(signatures), shape.bands), np.uint64)
    mixed, spread = np.uint64(0xD6E8FEB86659FD93), np.uint64(32)
    for band in range(shape.bands):
        key = np.full(len(signatures), band + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for row in signatures[:, band * shape.rows : (band + 1) * shape.rows].T:
            key = (key ^ row.astype(np.uint64)) * mixed
            key ^= key >> spread
        keys[:, band] = key * mixed >> np.uint64(64 - bits)
    return keys


def signing(num_perm: int, seed: int = 1) -> Callable[[], _Signer]:
    """Makes a task's signer, whose ``sign`` gives a row of ``num_perm`` values for each text."""
    family = permutations(num_perm, seed)
    return lambda: _Signer(*family)


def minhash(normalized: Column, num_perm: int = 128, seed: int = 1) -> Column:
    """``ARRAY<BIGINT>`` signature of the distinct 5-grams of a normalised text.

    Arrow batches go through numpy; equal texts within a batch are signed once.
    """
    family = permutations(num_perm, seed)
    signers: list[_Signer] = []

    @F.arrow_udf("array<bigint>")
    def sign_batch(texts: pa.Array) -> pa.Array:
        encoded = texts.dictionary_encode()
        distinct = [text or "" for text in encoded.dictionary.to_pylist()]
        codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if not signers:
            signers.append(_Signer(*family))
        values = signers[0].sign(distinct)[codes].astype(np.int64).reshape(-1)
        offsets = np.arange(0, len(values) + 1, num_perm, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

    return sign_batch(F.coalesce(normalized, F.lit("")))


def band_keys(signature: Column, shape: BandShape) -> Column:
    """One 128-bit key per band as ``ARRAY<STRUCT<h1 BIGINT, h2 BIGINT>>``.

    Two 64-bit hashes with the band number in different places keep accidental collisions out
    even at 1e12 keys.
    """

    def key(band: Column) -> Column:
        rows = F.slice(signature, band * shape.rows + 1, F.lit(shape.rows))
        return F.struct(
            F.xxhash64(band, rows).alias("h1"), F.xxhash64(rows, band).alias("h2")
        )

    return F.transform(F.sequence(F.lit(0), F.lit(shape.bands - 1)), key)
