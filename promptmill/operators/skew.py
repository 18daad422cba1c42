"""Joins whose key may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(
    big: DataFrame,
    keyed: DataFrame,
    on: Sequence[str],
    spread: Column,
    salts: int | None = None,
) -> DataFrame:
    """Inner join of ``big`` with the few ``keyed`` rows per key, hot keys split by a salt.

    ``spread`` names something that varies within a key (a row id). ``salts`` is how many parts a key
    may be split into, by default as many as there are shuffle partitions, so that a hot key reaches
    them all however large they make the cluster. Only the (key, salt) combinations that ``big`` really
    has are given a copy of the keyed rows, so a rare key costs as many copies as it has rows at most.
    """
    salts = salts or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    slots = salted.select(*on, "_salt").distinct().join(keyed, list(on))
    return salted.join(slots, [*on, "_salt"]).drop("_salt")
