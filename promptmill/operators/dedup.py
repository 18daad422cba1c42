"""Near-duplicate removal: the first kept row of a lookalike set wins.

A row is dropped when an earlier *kept* row shares at least one MinHash band with it. Within one
band bucket at most one row is ever kept, so the rule needs no pairs: each round takes the
earliest open row of every bucket, keeps those rows that lead all their buckets, and closes
the buckets they lead. Rounds repeat until no row is open. They work on rows whose buckets are shared, never on
texts, and every aggregate is combined before its shuffle. ``verify=True``, the default, takes bands tuned for recall and
compares the shingle sets of rows that share three (:mod:`promptmill.operators.buckets`, :mod:`promptmill.operators.leaders`).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions.minhash import (
    SHINGLE_SIZE,
    BandShape,
    balanced_shape,
    band_keys,
    minhash,
    recall_shape,
    voting_shape,
)
from promptmill.functions.text import jaccard, normalize_text, shingles
from promptmill.operators.buckets import likely, shared_bands, text_name
from promptmill.operators.keyfilter import key_filter
from promptmill.operators.leaders import verified_drops
from promptmill.operators.ranks import numbered
from promptmill.operators.skew import attach
from promptmill.session import materialise, release

NUM_PERM = 128
# More permutations afford longer bands at the same recall, so fewer unlike rows share a bucket.
VERIFY_PERM = 512
_BUCKET = ["h1", "h2"]


def order_key(order_by: Sequence[str]) -> Column:
    """One comparable column for the input order; its columns must identify a row."""
    return F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)


def shape_for(threshold: float, verify: bool, num_perm: int | None = None) -> BandShape:
    """Verified matching wants recall from its bands, unverified matching wants balance."""
    choose = recall_shape if verify else balanced_shape
    return choose(threshold, permutation_count(verify, num_perm))


def permutation_count(verify: bool, num_perm: int | None = None) -> int:
    return num_perm or (VERIFY_PERM if verify else NUM_PERM)


def _normalised(df: DataFrame, text: Column, order_by: Sequence[str]) -> DataFrame:
    return df.select(order_key(order_by).alias("ord"), normalize_text(text).alias("norm"))


def fingerprints(
    df: DataFrame, text: Column, order_by: Sequence[str], shape: BandShape,
    num_perm: int = NUM_PERM,
) -> DataFrame:
    """``ord``, a digest of the normalised text, and its band keys. Narrow: no shuffle."""
    signed = _normalised(df, text, order_by).select(
        "ord",
        _digest().alias("digest"),
        minhash(F.col("norm"), num_perm).alias("signature"),
    )
    return signed.select("ord", "digest", band_keys(F.col("signature"), shape).alias("bands"))


def _digest() -> Column:
    return F.unhex(F.sha2("norm", 256))


def _first_copies(df: DataFrame, text: Column, order_by: Sequence[str]) -> DataFrame:
    """``digest``, the first ``ord`` and the number of ``copies`` of each distinct text: no bands."""
    rows = _normalised(df, text, order_by).select("ord", _digest().alias("digest"))
    # A text without a key in some row has none, as the least of its rows.
    first = F.when(F.max(F.col("ord").isNull()), F.lit(None)).otherwise(F.min("ord"))
    return rows.groupBy("digest").agg(first.alias("ord"), F.count("*").alias("copies"))


def exact_duplicates(df: DataFrame, text: Column, order_by: Sequence[str]) -> DataFrame:
    """Per distinct normalised text: its first row ``ord`` and the number of ``copies``."""
    return (
        df.select(
            order_key(order_by).alias("ord"),
            F.unhex(F.sha2(normalize_text(text), 256)).alias("digest"),
        )
        .groupBy("digest")
        .agg(F.min("ord").alias("ord"), F.count("*").alias("copies"))
        .drop("digest")
    )


def first_of_each(prints: DataFrame) -> DataFrame:
    """Collapse exact copies to their first row; the partial minimum absorbs hot texts."""
    return (
        prints.groupBy("digest")
        .agg(F.min(F.struct("ord", "bands")).alias("first"), F.count("*").alias("copies"))
        .select("first.ord", "first.bands", "copies")
    )


def rows_per_bucket(prints: DataFrame) -> DataFrame:
    return prints.select("ord", F.explode("bands").alias("key")).select("ord", "key.*")


def _matches(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Add the exact shingle ``jaccard`` of ``ord`` and ``lead`` to each pair.

    Comparing texts costs far more than moving them, so the pairs are dealt out evenly first; the
    scores are kept, as a filter on them would otherwise repeat the comparison.
    """
    left = pairs.join(texts.withColumnRenamed("norm", "_mine"), "ord")
    right = texts.select(F.col("ord").alias("lead"), F.col("norm").alias("_other"))
    both = attach(left, right, ["lead"], spread=F.col("ord"))
    session = pairs.sparkSession
    tasks = max(
        int(session.conf.get("spark.sql.shuffle.partitions")),
        session.sparkContext.defaultParallelism,
    )
    grams = both.repartition(tasks, "ord", "lead").select(
        "ord",
        "lead",
        shingles(F.col("_mine"), SHINGLE_SIZE).alias("_mine"),
        shingles(F.col("_other"), SHINGLE_SIZE).alias("_other"),
    )
    return materialise(
        grams.select("ord", "lead", jaccard(F.col("_mine"), F.col("_other")).alias("jaccard"))
    )


def _shared_buckets(firsts: DataFrame) -> DataFrame:
    """``ord, h1, h2`` of rows in buckets that others share."""
    rows = rows_per_bucket(firsts)
    shared = rows.groupBy(*_BUCKET).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    return attach(rows, shared, _BUCKET, spread=F.col("ord"))


def dropped_rows(firsts: DataFrame) -> DataFrame:
    """The ``ord`` of rows the keep-first rule drops among distinct texts; ``firsts`` has ``ord`` and ``bands``."""
    open_rows = _shared_buckets(firsts).withColumn("buckets", F.count("*").over(Window.partitionBy("ord")))
    open_rows = materialise(open_rows)
    dropped = []
    while not open_rows.isEmpty():
        leads = (
            open_rows.groupBy(*_BUCKET)
            .agg(F.min(F.struct("ord", "buckets")).alias("first"))
            .select(*_BUCKET, F.col("first.ord").alias("lead"), "first.buckets")
        )
        kept = (
            leads.groupBy("lead", "buckets")
            .agg(F.count("*").alias("leading"))
            .filter(F.col("leading") == F.col("buckets"))
            .select("lead")
        )
        closing = leads.drop("buckets").join(kept, "lead", "left_semi")
        hits = attach(open_rows.drop("buckets"), closing, _BUCKET, spread=F.col("ord"))
        decided = materialise(
            hits.groupBy("ord").agg(F.max(F.col("ord") != F.col("lead")).alias("drop"))
        )
        dropped.append(decided.filter("drop").select("ord"))
        open_rows = materialise(open_rows.join(decided, "ord", "left_anti"))
    if not dropped:
        return firsts.select("ord").limit(0)
    return reduce(DataFrame.unionByName, dropped)


def _texts_of(df: DataFrame, text: Column, order_by: Sequence[str], places: DataFrame) -> DataFrame:
    """``ord, norm`` of the rows named in ``places`` and of a few others that share a bit of a filter of fixed size with one."""
    known = key_filter(places.select(F.xxhash64("ord").alias("key")))
    rows = df.select(order_key(order_by).alias("ord"), text.alias("text"))
    return rows.filter(known(F.xxhash64("ord"))).select("ord", normalize_text(F.col("text")).alias("norm"))


def dropped_alike(
    firsts: DataFrame, df: DataFrame, text: Column, order_by: Sequence[str], threshold: float, num_perm: int | None = None
) -> DataFrame:
    """The same where a kept row only drops rows whose Jaccard similarity exceeds ``threshold``.

    ``firsts`` has ``ord`` and ``digest``. Texts are read to be signed, and those of rows that share bands enough once more to be compared.
    """
    perms = permutation_count(True, num_perm)
    shape, votes = voting_shape(threshold, perms)
    named = _normalised(df, text, order_by).select(text_name(_digest()).alias("name"), "norm")
    shared = materialise(shared_bands(named, shape, perms))
    rows = firsts.select(text_name(F.col("digest")).alias("name"), "ord").join(shared.select("name").distinct(), "name")
    rows = materialise(rows)
    places = materialise(numbered(rows.select("ord").distinct(), ["ord"], "n"))
    numbers = rows.join(places, "ord").select("name", "n")
    buckets = shared.join(numbers, "name").select("n", F.col("key").alias("h1"), F.lit(0).cast("bigint").alias("h2"))
    buckets = materialise(buckets)
    chosen = materialise(likely(buckets, votes))
    release(df.sparkSession)
    near = places.join(chosen, "n", "left_semi")
    texts = _texts_of(df, text, order_by, near)
    dropped, _ = verified_drops(buckets.join(chosen, "n", "left_semi"), texts, threshold, votes=votes, names=near)
    return places.join(dropped, "n", "left_semi").select("ord")


def kept_rows(
    firsts: DataFrame, df: DataFrame, text: Column, order_by: Sequence[str],
    threshold: float, verify: bool, num_perm: int | None = None,
) -> DataFrame:
    dropped = dropped_alike(firsts, df, text, order_by, threshold, num_perm) if verify else dropped_rows(firsts)
    return firsts.select("ord").join(dropped, "ord", "left_anti")


def near_dedup(
    df: DataFrame,
    *,
    text: Column,
    order_by: Sequence[str],
    threshold: float = 0.85,
    num_perm: int | None = None,
    verify: bool = True,
) -> DataFrame:
    """The rows of ``df`` that survive, unchanged."""
    kept = surviving_keys(
        df, text=text, order_by=order_by, threshold=threshold, num_perm=num_perm, verify=verify
    )
    return rows_with_keys(df, kept, order_by)


def distinct_prints(
    df: DataFrame,
    *,
    text: Column,
    order_by: Sequence[str],
    threshold: float = 0.85,
    num_perm: int | None = None,
    verify: bool = True,
) -> DataFrame:
    """``ord`` and the number of ``copies`` of each distinct text, stored, with its ``bands`` or, to be verified, its ``digest``.

    Unverified, signatures are computed once and only they are kept between rounds, some 200 bytes a row.
    """
    if verify:
        return materialise(_first_copies(df, text, order_by))
    shape = shape_for(threshold, verify, num_perm)
    return materialise(
        first_of_each(fingerprints(df, text, order_by, shape, permutation_count(verify, num_perm)))
    )


def surviving_keys(
    df: DataFrame,
    *,
    text: Column,
    order_by: Sequence[str],
    threshold: float = 0.85,
    num_perm: int | None = None,
    verify: bool = True,
) -> DataFrame:
    """The order keys ``ord`` of the rows that survive."""
    firsts = distinct_prints(
        df, text=text, order_by=order_by, threshold=threshold, num_perm=num_perm, verify=verify
    )
    return kept_rows(firsts, df, text, order_by, threshold, verify, num_perm)


def rows_with_keys(df: DataFrame, keys: DataFrame, order_by: Sequence[str]) -> DataFrame:
    return (
        df.withColumn("_ord", order_key(order_by))
        .join(keys.withColumnRenamed("ord", "_ord"), "_ord", "left_semi")
        .drop("_ord")
    )


def near_dup_pairs(
    df: DataFrame,
    *,
    text: Column,
    order_by: Sequence[str],
    threshold: float = 0.85,
    num_perm: int | None = None,
    verify: bool = True,
) -> DataFrame:
    """Each dropped row ``ord`` with the earlier kept rows ``lead`` it matches, and ``jaccard``.

    Unverified, a bucket holds one kept row at most, so a row has at most one pair per band.
    """
    shape = shape_for(threshold, verify, num_perm)
    prints = materialise(
        fingerprints(df, text, order_by, shape, permutation_count(verify, num_perm))
    )
    firsts = first_of_each(prints)
    distinct = materialise(_first_copies(df, text, order_by)) if verify else firsts
    kept = kept_rows(distinct, df, text, order_by, threshold, verify, num_perm)
    leads = rows_per_bucket(firsts.join(kept, "ord", "left_semi")).withColumnRenamed(
        "ord", "lead"
    )
    pairs = (
        attach(rows_per_bucket(prints), leads, _BUCKET, spread=F.col("ord"))
        .filter(F.col("lead") < F.col("ord"))
        .select("ord", "lead")
        .distinct()
    )
    pairs = materialise(pairs)
    named = pairs.select("ord").union(pairs.select("lead")).distinct()
    texts = _normalised(df, text, order_by).join(named, "ord", "left_semi")
    scored = _matches(pairs, materialise(texts))
    return scored.filter(F.col("jaccard") > threshold) if verify else scored
