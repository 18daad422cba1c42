"""Minimax contiguous sharding: the smallest shard capacity that ordered atomic groups allow.

Groups (equal texts) are ordered by a hash. The driver sees atoms: ranges of that order with their totals. The capacity is
found by binary search; a greedy walk over the atoms checks it and gives the cuts. An atom of several groups may hold a
better cut inside, so the search runs twice, once with atoms that may not be cut and once with atoms that may be cut anywhere:
the capacity of the groups lies between. Atoms where the two walks can end a shard are split by further bits of the hash, in
Spark, until both agree. Rows are then numbered within their shard by one sort over narrow rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.operators.ranks import numbered
from promptmill.session import materialise

#: Bits of the hash order in a first atom, and by which an atom is split further.
FIRST_BITS, MORE_BITS = 16, 8


def fits(upto: np.ndarray, shards: int, capacity: int) -> list[int] | None:
    """Greedy cuts: where each shard ends, if ``shards`` shards of ``capacity`` hold all sizes.

    ``upto`` are running totals of the sizes, with a leading 0.
    """
    cuts, done = [], 0
    for _ in range(shards):
        done = int(np.searchsorted(upto, upto[done] + capacity, "right")) - 1
        cuts.append(done)
    return cuts if done == len(upto) - 1 else None


def reaches(upto: np.ndarray, whole: np.ndarray, shards: int, capacity: int) -> list[int]:
    """The totals at which shards end if atoms that are not ``whole`` may be cut anywhere; the last is that of all if they fit."""
    ends, done = [], 0
    for _ in range(shards):
        done += capacity
        at = int(np.searchsorted(upto, done, "right")) - 1
        if at >= len(whole):
            done = int(upto[-1])
        elif whole[at]:
            done = int(upto[at])
        ends.append(done)
    return ends


def _least(low: int, high: int, enough) -> int:
    while low < high:
        middle = (low + high) // 2
        if enough(middle):
            high = middle
        else:
            low = middle + 1
    return low


def minimax_cuts(sizes: Sequence[int], shards: int) -> list[int]:
    """End positions of ``shards`` contiguous runs whose largest total is as small as can be."""
    upto = np.concatenate(([0], np.cumsum(np.asarray(sizes, np.int64))))
    total, largest = int(upto[-1]), int(max(sizes, default=0))
    return fits(upto, shards, _least(max(largest, -(-total // shards)), total, lambda c: fits(upto, shards, c) is not None))


@dataclass(frozen=True)
class _Atom:
    """Groups whose order shares its first ``bits`` bits: the prefix, the first group's place, totals, and the number of groups."""

    bits: int
    prefix: int
    first: int
    size: int
    rows: int
    groups: int


def _prefix(order: Column, bits: int) -> Column:
    """The first bits of an order whose sign is turned, so that prefixes rise with it."""
    return F.shiftright(order, 64 - bits)


def _atoms(groups: DataFrame, bits: int, within: list[_Atom] | None = None) -> list[_Atom]:
    """Totals by prefix, of all groups or of those in some atoms."""
    if within is not None:
        by_bits = {b: [a.prefix for a in within if a.bits == b] for b in {a.bits for a in within}}
        groups = groups.filter(reduce(or_, (_prefix(F.col("_order"), b).isin(*prefixes) for b, prefixes in by_bits.items())))
    found = groups.groupBy(_prefix(F.col("_order"), bits).alias("prefix")).agg(
        F.min("_order").alias("first"), F.sum("size").alias("size"), F.sum("rows").alias("rows"), F.count("*").alias("groups")
    )
    return [_Atom(bits, r["prefix"], r["first"], r["size"], r["rows"], r["groups"]) for r in found.collect()]


def _settled_atoms(groups: DataFrame, shards: int, largest: int) -> tuple[list[_Atom], list[int]]:
    """Atoms, in order, and where shards end among them at the smallest capacity that the groups allow."""
    atoms, bits = sorted(_atoms(groups, FIRST_BITS), key=lambda a: a.first), FIRST_BITS
    while True:
        upto = np.concatenate(([0], np.cumsum([a.size for a in atoms], dtype=np.int64)))
        whole, total = np.array([a.groups == 1 for a in atoms], bool), int(upto[-1])
        lowest = max(largest, -(-total // shards))
        high = _least(lowest, total, lambda c: fits(upto, shards, c) is not None)
        low = _least(lowest, high, lambda c: reaches(upto, whole, shards, c)[-1] == total)
        cuts = fits(upto, shards, high)
        if low == high or bits == 64:
            return atoms, cuts
        # A greedy end can lie from where the lower walk cuts, or would if atoms were whole, to where the upper one does.
        doubtful: set[int] = set()
        early = fits(upto, len(atoms) + shards, low) or []
        for k in range(shards):
            ends = (reaches(upto, whole, shards, low)[k], reaches(upto, whole, shards, high)[k])
            first = min(int(np.searchsorted(upto, ends[0], "right")) - 1, early[k] if k < len(early) else len(atoms))
            last = max(int(np.searchsorted(upto, ends[1], "left")), cuts[k])
            doubtful |= {i for i in range(max(first, 0), min(last + 1, len(atoms))) if not whole[i]}
        if not doubtful:
            return atoms, cuts
        bits = min(64, max(atoms[i].bits for i in doubtful) + MORE_BITS)
        finer = _atoms(groups, bits, [atoms[i] for i in sorted(doubtful)])
        atoms = sorted([*(a for i, a in enumerate(atoms) if i not in doubtful), *finer], key=lambda a: a.first)


def shard(
    docs: DataFrame,
    shards: int = 24,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    row_overhead: int = 8,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` with near-equal bytes per shard, equal texts together.

    The largest shard is as small as shards that are contiguous in the order of the groups can have it. ``size`` is the UTF-8
    length plus ``row_overhead``; ``slot`` counts from 0 without gaps in each shard. A null text has no bytes and is a group of
    its own beside empty texts; repeated rows get places of their own; an empty table gives no rows. A group larger than
    the mean shard makes its shard that large. Other columns are ignored.
    """
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(body) + F.lit(row_overhead)).cast("bigint").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(text).bitwiseXOR(F.lit(-(1 << 63)).cast("bigint")).alias("_order"),
        )
    )
    groups = materialise(rows.groupBy("_order").agg(F.sum("size").alias("size"), F.count("*").alias("rows")))
    largest = groups.agg(F.max("size")).first()[0] or 0
    atoms, cuts = _settled_atoms(groups, shards, largest)
    # The first group of each shard, and how many rows lie before it: two short literal lists.
    upto = np.concatenate(([0], np.cumsum([a.rows for a in atoms]))).astype(int).tolist()
    begins = [b for b in [0, *cuts[:-1]] if b < len(atoms)]
    firsts = [atoms[b].first for b in begins]
    number = [[0, *cuts[:-1]].index(b) for b in begins]  # a shard that stays empty has the same beginning as the next one
    place = F.size(F.filter(F.array(*(F.lit(f).cast("bigint") for f in firsts)), lambda first: first <= F.col("_order"))) - 1
    literal = lambda values, kind: F.array(*(F.lit(v).cast(kind) for v in values or [0]))
    placed = numbered(rows, ["_order", "doc_id"], "_number").withColumn("_place", F.greatest(place, F.lit(0)))
    before = literal([upto[b] for b in begins], "bigint")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        literal(number, "int")[F.col("_place")].alias("shard"),
        (F.col("_number") - 1 - before[F.col("_place")]).alias("slot"),
    )
