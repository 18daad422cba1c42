"""I-Match fingerprints of whole texts, as column expressions.

The lexicon holds the terms whose inverse document frequency lies in a chosen band. A text's distinct lexicon terms
are sorted and hashed; the same is done for several randomised parts of the lexicon, thinned to different
degrees, so that some parts survive an edit whatever the text's length. Each part gives one hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from promptmill.functions.binding import bind

#: Slots of the lexicon table, 2 ** 18. The band holds at most (mean distinct words of a text / band[0]) terms, so
#: the table's size does not grow with the number of texts.
SLOT_BITS = 18
#: Lexicon parts: for each degree d, ``PARTS`` parts that keep one term in 2 ** d.
DEGREES = (2, 4, 6, 8, 10, 12)
PARTS = 8
#: Document frequency band, as shares of the texts: rarer terms and commoner ones are left out.
BAND = (2e-4, 0.15)
#: A text with fewer lexicon terms has its parts drawn from all its terms.
FEW = 8

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-cased words."""
    words = F.filter(F.split(F.lower(text), _BREAK), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def _slot(term: Column) -> Column:
    return F.shiftrightunsigned(term, 64 - SLOT_BITS).cast("int")


def lexicon(texts: DataFrame, text: str = "text", band: tuple[float, float] = BAND) -> DataFrame:
    """One row with one array: at each slot the lexicon terms of that slot, sorted.

    Document frequencies count distinct texts, so that a group of copies counts once. A term must occur in two texts
    at least.
    """
    digest = F.xxhash64(F.lit("first"), F.col(text)), F.xxhash64(F.lit("second"), F.col(text))
    count = texts.agg(F.count_distinct(*digest).alias("n"))
    frequencies = texts.select(text).distinct().select(F.explode(terms(F.col(text))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n = count.scalar()
    kept = frequencies.filter(
        (F.col("df") >= F.greatest(F.lit(2), F.ceil(n * band[0]))) & (F.col("df") <= F.greatest(F.lit(2), n * band[1]))
    )
    chosen = kept.groupBy(_slot(F.col("term")).alias("slot")).agg(F.sort_array(F.collect_list("term")).alias("terms"))
    slots = texts.sparkSession.range(1 << SLOT_BITS).select(F.col("id").cast("int").alias("slot"))
    filled = slots.join(chosen, "slot", "left").select("slot", F.coalesce("terms", F.array().cast("array<bigint>")).alias("terms"))
    table = F.transform(F.sort_array(F.collect_list(F.struct("slot", "terms"))), lambda s: s["terms"])
    return filled.agg(table.alias("table"))


def _hashes(text: Column, table: Column) -> Column:
    """An array of hashes: one of the whole lexicon's terms, then one for each part; 0 where a part has none.

    A text without lexicon terms is hashed by all its terms, so that it equals only its like. The parts of a text with few
    lexicon terms are drawn from all its terms, so that an edit leaves some of them as well.
    """

    def of_drawn(held: Column, drawn_from: Column, all_terms: Column) -> Column:
        whole = F.when(F.size(held) > 0, F.xxhash64(held)).otherwise(F.xxhash64(F.lit("none"), all_terms))

        def part(degree: int, number: int) -> Column:
            # Seven bits on for each part, so that parts of one degree are drawn nearly independently.
            bits, drawn = F.lit(((1 << degree) - 1) << 7 * number), F.lit(DEGREES.index(degree) << 7 * number)
            kept = F.filter(drawn_from, lambda r: r.bitwiseAND(bits) == drawn)
            return bind(kept, lambda k: F.when(F.size(k) > 0, F.xxhash64(k)).otherwise(F.lit(0).cast("bigint")))

        return F.array(whole, *(part(d, p) for d in DEGREES for p in range(PARTS)))

    def of_terms(found: Column) -> Column:
        held = F.filter(found, lambda t: F.array_contains(F.get(table, _slot(t)), t))
        # The lexicon's slot is a term's first bits, so parts are drawn by a second hash.
        again = lambda some: F.transform(some, lambda t: F.xxhash64(t))

        def of_held(h: Column) -> Column:
            return bind(F.when(F.size(h) < FEW, again(found)).otherwise(h), lambda drawn_from: of_drawn(h, drawn_from, found))

        return bind(again(held), of_held)

    return bind(F.sort_array(terms(text)), of_terms)


def with_hashes(rows: DataFrame, table: DataFrame, texts: list[str], name: str) -> DataFrame:
    """Add ``name``: the fingerprints of the columns ``texts``, as an array in that order.

    The lexicon is a scalar subquery, read once for the job. It is named by a single expression, which Spark
    therefore folds into that expression, so that no row carries the table.
    """
    each = bind(F.col("_table"), lambda t: F.transform(F.array(*texts), lambda text: _hashes(text, t)))
    return rows.withColumn("_table", table.scalar()).select(*rows.columns, each.alias(name))


def likeness(one: Column, other: Column) -> Column:
    """1 for equal fingerprints; else the best share of equal hashes among the parts of one degree.

    Parts that are empty in both count for nothing, and a degree counts where three parts are filled.
    """

    def share(degree: int) -> Column:
        low = 2 + degree * PARTS
        pairs = F.zip_with(F.slice(one, low, PARTS), F.slice(other, low, PARTS), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        filled = F.filter(pairs, lambda p: (p["a"] != 0) | (p["b"] != 0))
        return bind(
            filled,
            lambda f: F.when(F.size(f) >= 3, F.size(F.filter(f, lambda p: p["a"] == p["b"])) / F.size(f)).otherwise(F.lit(0.0)),
        )

    best = F.greatest(*(share(d) for d in range(len(DEGREES))))
    return F.when(one.isNull() | other.isNull(), F.lit(0.0)).when(one == other, F.lit(1.0)).otherwise(best)


def written(hashes: Column) -> Column:
    """A fingerprint as text: eight hexadecimal digits a hash, empty for an empty part."""
    return F.array_join(
        F.transform(hashes, lambda h: F.when(h == 0, F.lit("")).otherwise(F.lower(F.lpad(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")))), "."
    )


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, hashes`` of every text; a null text counts as empty; other columns are ignored.

    Every row has its own result, equal for equal texts; an empty table gives no rows.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return with_hashes(own, lexicon(own), ["text"], "_all").select("doc_id", "text", F.col("_all")[0].alias("hashes"))


#: Rows between two cuts of the id order, and the most cuts: beyond that blocks grow and sort on disk.
BLOCK_ROWS, MOST_CUTS = 2048, 4096


def neighbours(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text`` dealt into blocks of neighbours in id order, for windows over ``following()``.

    The id order is cut at ids that occur, so that one shuffle brings a block of neighbours together; the row at a cut
    is also sent to the block before it, marked ``_ghost``, and the first row of all follows the last. Rows of equal ids
    follow each other by the hash of their text, null ids come first, and null texts count as empty. Ids are integers.
    """
    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))
    rows = docs.select(key.alias("_key"), F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = rows.select("_key")
    count, first = ids.agg(F.count("*"), F.min("_key")).first()
    parts = max(1, min(MOST_CUTS, count // BLOCK_ROWS))
    shares = [i / parts for i in range(1, parts)]
    cuts = ids.agg(F.percentile_approx("_key", shares, 100_000)).first()[0] if shares else []
    cuts = sorted({first if first is not None else 0, *(cuts or [])})
    literal = F.array(*(F.lit(c).cast("bigint") for c in cuts))
    block = F.size(F.filter(literal, lambda c: c <= F.col("_key"))) - 1
    own = F.struct(F.col("_block").alias("_block"), F.lit(False).alias("_ghost"))
    ghost = F.struct(F.pmod(F.col("_block") - 1, F.lit(len(cuts))).alias("_block"), F.lit(True).alias("_ghost"))
    at_cut = F.col("_key") == literal[F.col("_block")]
    return (
        rows.withColumn("_block", block)
        .withColumn("_place", F.explode(F.when(at_cut, F.array(own, ghost)).otherwise(F.array(own))))
        .select("_place.*", "_key", F.xxhash64("text").alias("_digest"), "doc_id", "text")
    )


def following() -> WindowSpec:
    """The window of a row of ``neighbours`` and those after it; ghosts come last and are dropped afterwards."""
    return Window.partitionBy("_block").orderBy("_ghost", "_key", "_digest")
