"""Exact order statistics and row numbers without sorting one key in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.session import materialise

# Accuracy of the sketch that says roughly where a rank lies; no result depends on it.
_SKETCH = 20_000


def values_at_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    ranks: Mapping[str, tuple[float, Column]],
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The exact value at chosen 0-based ranks of ``value`` within each group.

    ``ranks`` maps an output name to ``(fraction, rank)``: ``rank`` is a column over ``n``, the
    number of non-null values, and ``fraction`` says roughly where it lies. A bounded quantile sketch
    cuts each group closely around the ranks. Equal values are counted together, the parts between the cuts
    are counted exactly, and a running total orders only the part that a rank falls into: a sliver of a
    large group, or a larger part should the sketch be off, with the same result. ``also`` are aggregates over the
    column ``_x`` of the values, computed in the sketch's pass.
    """
    keys = list(keys)
    on = keys or ["_all"]
    rows = df.filter(F.col(value).isNotNull()).select(
        *(keys or [F.lit(0).alias("_all")]), F.col(value).cast("double").alias("_x")
    )
    margin = 2.0 / _SKETCH
    edges = [
        edge
        for fraction, _ in ranks.values()
        for edge in (max(0.0, fraction - margin), min(1.0, fraction + margin))
    ]
    also = also or {}
    whole = ["n", *also]
    outline = rows.groupBy(*on).agg(
        F.count("_x").alias("n"),
        F.percentile_approx("_x", edges, _SKETCH).alias("_edges"),
        *(aggregate.alias(name) for name, aggregate in also.items()),
    )
    # Cells of one group are salted, and each (group, salt) that occurs gets a copy of what is known of the group. The
    # sum makes both uses of the cells one and the same plan, so that they are counted and shuffled once.
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = rows.groupBy(*on, "_x").agg(F.count("*").alias("_rows"))
    cells = cells.withColumn("_salt", F.pmod(F.xxhash64("_x"), F.lit(salts)))
    slots = cells.groupBy(*on, "_salt").agg(F.sum("_rows").alias("_in_slot"))

    def beside(known: DataFrame) -> DataFrame:
        return cells.join(slots.filter("_in_slot > 0").join(known, on), [*on, "_salt"])

    part = F.size(F.filter("_edges", lambda edge: edge < F.col("_x")))

    # A group has at most one part more than edges, so its parts are a short list.
    parts = (
        beside(outline)
        .groupBy(*on, *whole, "_edges", part.alias("_part"))
        .agg(F.sum("_rows").alias("_total"))
        .withColumn("_before", F.sum("_total").over(Window.partitionBy(*on).orderBy("_part")) - F.col("_total"))
    )
    holds = [(rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_total")) for _, rank in ranks.values()]
    chosen = (
        parts.filter(reduce(or_, holds))
        .groupBy(*on, *whole, "_edges")
        .agg(F.map_from_entries(F.collect_list(F.struct("_part", "_before"))).alias("_wanted"))
    )
    upto = F.col("_wanted")[F.col("_part")] + F.sum("_rows").over(Window.partitionBy(*on, "_part").orderBy("_x"))
    counted = (
        beside(chosen)
        .withColumn("_part", part)
        .filter(F.map_contains_key("_wanted", F.col("_part")))
        .withColumn("_upto", upto)
    )
    picks = [F.min(F.when(F.col("_upto") > rank, F.col("_x"))).alias(name) for name, (_, rank) in ranks.items()]
    result = counted.groupBy(*on, *whole).agg(*picks)
    return result if keys else result.drop("_all")


#: How far beyond the sketched place of a limit the rows may be cut off; the first is the sketch's own error.
_BEYOND = (2e-4, 1e-3, 1e-2, 1e-1)


def _scale(df: DataFrame, name: str) -> Column:
    """A number that never falls where the column rises; null is the lowest."""
    kind = df.schema[name].dataType.simpleString()
    if kind in ("string", "binary"):
        body = F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 7)), 14, "0")
        value = F.conv(body, 16, 10).cast("double")
    elif kind.startswith("timestamp"):
        value = F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    elif kind == "date":
        value = F.unix_date(name).cast("double")
    elif kind == "boolean":
        value = F.col(name).cast("int").cast("double")
    else:
        value = F.col(name).cast("double")
    return F.coalesce(value, F.lit(float("-inf")))


def _within_cut(df: DataFrame, name: str, n: int) -> DataFrame:
    """The rows up to some value of the first order column, ``n`` of them at least if there are so many.

    A sketch of the column gives values to cut at, a count of the rows up to each says which is enough: a filter, whatever
    ``n`` is, and no sort. Many rows of one value stay together.
    """
    scale = _scale(df, name)
    total = df.count()
    shares = [n / max(total, 1) + more for more in _BEYOND if n / max(total, 1) + more < 1]
    if not shares:
        return df
    cuts = sorted(set(df.agg(F.percentile_approx(scale, shares, 10_000)).first()[0]))
    place = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < scale))
    upto = 0
    for at, rows in sorted((r["at"], r["count"]) for r in df.groupBy(place.alias("at")).count().collect()):
        upto += rows
        if upto >= n and at < len(cuts):
            return df.filter(scale <= cuts[at])
    return df


def first_rows(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of a total order, whose columns identify a row.

    Rows beyond a cut-off in the first column are filtered out; of the others only the order columns are sorted and
    numbered. The rows themselves stay where they are.
    """
    near = _within_cut(df.select(*order_by), order_by[0], n)
    chosen = numbered(near, order_by, "_n").filter(F.col("_n") <= n)
    chosen = chosen.select(*(F.col(c).alias(f"_first_{c}") for c in order_by))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_first_{c}")) for c in order_by))
    return df.join(chosen, same, "left_semi")


def numbered(df: DataFrame, order_by: Sequence[Column | str], name: str) -> DataFrame:
    """Add a 1-based row number over a total order of the whole frame.

    The frame is range-partitioned and sorted once and kept; the partitions' row counts then
    give each partition its offset. No window spans the data, only the partition counts.
    """
    ordered = materialise(df.orderBy(*order_by)).withColumn(
        "_position", F.monotonically_increasing_id()
    )
    ordered = ordered.withColumn("_part", F.shiftright("_position", 33)).withColumn(
        "_row", F.col("_position").bitwiseAND(F.lit((1 << 33) - 1))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort: bounded by the shuffle partition count.
    offsets = (
        ordered.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row") + 1)
        .drop("_position", "_part", "_row", "_offset")
    )
