"""Personal data replaced by keyed surrogates of the same kind, as column expressions.

Detected entities are gathered into one row per kind and canonical value. A keyed hash draws a surrogate that keeps script,
gender, length and format; surrogates that two entities share, or that are real entities of the corpus, are drawn again
until none is left, after ``DRAWS_AS_IS`` draws with more and more places. The same entity has the same surrogate in every
text, whatever its spelling.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions.binding import bind
from promptmill.session import materialise

# Given names by script and gender; a surrogate's given name is drawn from the list of the original's.
GIVEN = {
    ("latin", "female"): "Alice Amelia Barbara Carolina Charlotte Christine Clara Deborah Elisabeth Emily Emma Hannah Isabella Jennifer Jessica Julia Karin Laura Margaret Martha Michelle Natalie Olivia Patricia Rebecca Sandra Sophie Susan Victoria Yvonne",
    ("latin", "male"): "Adam Albert Andreas Benjamin Carlos Charles Christopher Daniel David Edward Francisco Frank George Henry Jacob James Javier John Joseph Kevin Lukas Martin Michael Nicholas Oliver Patrick Richard Robert Thomas William",
    ("cyrillic", "female"): "Анна Мария Ольга Елена Наталья Татьяна Ирина Светлана Екатерина Юлия Дарья Вера",
    ("cyrillic", "male"): "Иван Пётр Сергей Алексей Дмитрий Николай Андрей Михаил Владимир Павел Егор Антон",
    ("greek", "female"): "Μαρία Ελένη Αικατερίνη Βασιλική Σοφία Αγγελική Δέσποινα Ειρήνη",
    ("greek", "male"): "Γεώργιος Ιωάννης Κωνσταντίνος Δημήτριος Νικόλαος Παναγιώτης Βασίλειος Χρήστος",
}
# Syllables that surrogate family names are made of, by script.
SYLLABLES = {
    "latin": "bar bel cor dan fer gar hol jan kel lam mar nor pel ros sal tor vel wes yar zim",
    "cyrillic": "бор вол гор дан зор кал лук мир ник ост пет рог сол тар фил цел",
    "greek": "αλ βασ γαλ δημ καρ λαμ μαν νικ παπ ροδ σαν τσι φιλ χαλ",
}

_NAMES = "|".join(sorted({n for names in GIVEN.values() for n in names.split()}))
#: Patterns by kind, in the order they are tried at a place. A group that is repeated without limit matches single
#: characters only, because Java recurses for each repetition of a group of varying width.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-](?:(?!\.\.)[A-Za-z0-9.-])*\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![0-9A-Za-z.+-])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z.+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "ip": r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9A-Za-z]|\.[0-9])",
    "phone": r"(?<![0-9A-Za-z.+-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3}[ .-]?[0-9]{3,4}(?![0-9A-Za-z])",
    "name": rf"(?<![\p{{L}}\p{{M}}])(?:{_NAMES})\x20(?:\p{{Lu}}\.\x20)?\p{{Lu}}[\p{{L}}'-]+\p{{L}}(?![\p{{L}}\p{{M}}])",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())

#: Draws in an entity's own length; each later draw is one place longer, so that a full space does not end the search.
DRAWS_AS_IS = 16


def _kind(value: Column) -> Column:
    """Which pattern a match came from; patterns are told apart by the value alone."""
    result = F.lit("name")
    for kind in reversed([k for k in PATTERNS if k != "name"]):
        result = F.when(value.rlike(rf"\A(?:{PATTERNS[kind]})\z"), F.lit(kind)).otherwise(result)
    return result


def _canonical(kind: Column, value: Column) -> Column:
    """One value for all spellings: digits only, or lower case."""
    return (
        F.when(kind.isin("card", "phone", "ssn"), F.regexp_replace(value, "[^0-9]", ""))
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .when(kind == "ip", value)
        .otherwise(F.lower(value))
    )


def mentions(text: Column) -> Column:
    """Array of ``(kind, value, canonical)`` in order of place; matches do not overlap."""

    def describe(value: Column) -> Column:
        return bind(
            _kind(value), lambda kind: F.struct(kind.alias("kind"), value.alias("value"), _canonical(kind, value).alias("canonical"))
        )

    return F.transform(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), describe)


def _number(seed: Column, at: Column | int, below: Column | int) -> Column:
    """A keyed number in [0, below) for a place in a value."""
    place = F.lit(at) if isinstance(at, int) else at
    drawn = F.conv(F.substring(F.sha2(F.concat_ws(":", seed, place.cast("string")).cast("binary"), 256), 1, 12), 16, 10)
    return F.pmod(drawn.cast("bigint"), F.lit(below) if isinstance(below, int) else below).cast("int")


def _pick(words: str, seed: Column, at: int) -> Column:
    options = words.split()
    return F.array(*map(F.lit, options))[_number(seed, at, len(options))]


def _each(value: Column) -> Column:
    """The characters of a string as an array."""
    return F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0))


def _characters(value: Column, change) -> Column:
    """Apply ``change(character, place)`` to every character."""
    return F.array_join(F.transform(_each(value), change), "")


def _digit(seed: Column, at: Column) -> Column:
    return F.substring(F.lit("0123456789"), _number(seed, at, 10) + 1, F.lit(1))


def _letter(seed: Column, at: Column) -> Column:
    return F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), _number(seed, at, 26) + 1, F.lit(1))


def _scrambled(value: Column, seed: Column) -> Column:
    """Letters for letters and digits for digits, all else as it is."""

    def change(c: Column, i: Column) -> Column:
        return F.when(c.rlike("[0-9]"), _digit(seed, i)).when(c.rlike("[a-z]"), _letter(seed, i)).when(c.rlike("[A-Z]"), F.upper(_letter(seed, i))).otherwise(c)

    return _characters(value, change)


def _luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string, whose last digit counts once."""

    def weigh(c: Column, i: Column) -> Column:
        doubled = c.cast("int") * F.when((F.length(digits) - i) % 2 == 0, 2).otherwise(1)
        return doubled - F.when(doubled > 9, 9).otherwise(0)

    return F.aggregate(F.transform(_each(digits), weigh), F.lit(0), lambda a, b: a + b)


def _more(seed: Column, drawn) -> Column:
    """The places by which a late draw is longer."""
    return F.when(F.col("draw") < DRAWS_AS_IS, F.lit("")).otherwise(
        F.array_join(F.transform(F.sequence(F.lit(1000), 1000 + F.col("draw") - DRAWS_AS_IS), lambda i: drawn(seed, i)), "")
    )


def _card(value: Column, seed: Column) -> Column:
    """Random digits; one that passes the Luhn check keeps passing it."""
    drawn = F.concat(_characters(F.expr("left(canonical, length(canonical) - 1)"), lambda c, i: _digit(seed, i)), _more(seed, _digit))
    check = F.pmod(F.lit(10) - _luhn_sum(F.concat(drawn, F.lit("0"))) % 10, F.lit(10))
    valid = _luhn_sum(value) % 10 == 0
    return F.concat(drawn, F.when(valid, check.cast("string")).otherwise(_digit(seed, F.lit(99))))


def _ip(value: Column, seed: Column) -> Column:
    octets = [(_number(seed, i, 254) + 1).cast("string") for i in range(4)]
    # An address of four octets cannot be longer; a late draw is a private one of the longer kind.
    groups = F.regexp_replace(F.substring(F.sha2(seed.cast("binary"), 256), 1, 28), "(.{4})(?=.)", "$1:")
    return F.when(F.col("draw") < DRAWS_AS_IS, F.concat_ws(".", *octets)).otherwise(F.concat(F.lit("fd00:"), groups))


def _email(value: Column, seed: Column, key: str) -> Column:
    """The local part and the host are drawn apart, so that addresses of one host stay together; the top domain stays."""
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    host, top = F.regexp_replace(domain, r"\.[^.]*$", ""), F.substring_index(domain, ".", -1)
    drawn = bind(_digest(F.lit(key + "|host|"), domain), lambda s: _scrambled(host, s))
    return F.concat(_scrambled(local, seed), _more(seed, _letter), F.lit("@"), drawn, F.lit("."), top)


def _digest(*parts: Column) -> Column:
    """A seed as long for every value: what is drawn from it costs the same for each character."""
    return F.sha2(F.concat_ws("|", *parts).cast("binary"), 256)


def _name(value: Column, seed: Column) -> Column:
    given, family = F.substring_index(value, " ", 1), F.substring_index(value, " ", -1)
    middle = F.regexp_extract(value, r" (.)\. ", 1)
    first, script = F.lit(""), F.lit("latin")
    for (alphabet, gender), names in GIVEN.items():
        own = given.isin(*(n.lower() for n in names.split()))
        first = F.when(own, F.lower(_pick(names, F.concat(seed, F.lit(gender)), 0))).otherwise(first)
        script = F.when(own, F.lit(alphabet)).otherwise(script)
    last = F.lit("")
    for alphabet, syllables in SYLLABLES.items():
        parts = [_pick(syllables, seed, i) for i in range(1, 5)]
        options = syllables.split()
        more = _more(seed, lambda s, i, o=options: F.array(*map(F.lit, o))[_number(s, i, len(o))])
        last = F.when(script == alphabet, F.concat(*parts[:3], F.when(F.length(family) > 9, parts[3]).otherwise(F.lit("")), more)).otherwise(last)
    initial = F.when(middle != "", F.concat(middle, F.lit(". "))).otherwise(F.lit(""))
    return F.concat(first, F.lit(" "), initial, last)


def _draw(key: str) -> Column:
    """The surrogate of ``kind``, ``canonical`` at draw number ``draw``."""
    kind, value = F.col("kind"), F.col("canonical")
    return bind(_digest(F.lit(key), kind, value, F.col("draw").cast("string")), lambda seed: _of_kind(kind, value, seed, key))


def _of_kind(kind: Column, value: Column, seed: Column, key: str) -> Column:
    iban = F.concat(F.substring(value, 1, 2), _scrambled(F.expr("substring(canonical, 3)"), seed), _more(seed, _digit))
    return (
        F.when(kind == "email", _email(value, seed, key))
        .when(kind == "card", _card(value, seed))
        .when(kind == "ip", _ip(value, seed))
        .when(kind == "iban", iban)
        .when(kind == "name", _name(value, seed))
        .otherwise(F.concat(_scrambled(value, seed), _more(seed, _digit)))
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, canonical, surrogate``, one to one within a kind, and never a real entity.

    Each round draws for the entities that are left; a surrogate drawn by several goes to none but the first of them, and one
    that is taken or real to none. The space grows with each late round, so that every entity gets a surrogate.
    """
    entities = materialise(entities.select("kind", "canonical").distinct())
    real = entities.select("kind", F.col("canonical").alias("surrogate"))
    settled, left = None, entities
    for number in itertools.count():
        drawn = left.withColumn("draw", F.lit(number)).withColumn("surrogate", _draw(key)).select("kind", "canonical", "surrogate")
        taken = real if settled is None else real.unionByName(settled.select("kind", "surrogate"))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        fresh = materialise(first.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "canonical", "surrogate"))
        settled = fresh if settled is None else materialise(settled.unionByName(fresh))
        left = materialise(left.join(fresh, ["kind", "canonical"], "left_anti"))
        if left.isEmpty():
            return settled


def _spelled(mention: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's format: its separators, or its upper-case letters."""

    def with_separators(given: Column) -> Column:
        start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

        def step(done: Column, c: Column) -> Column:
            own = c.rlike("[0-9A-Za-z]")
            return F.struct(
                (done["at"] + own.cast("int")).alias("at"),
                F.concat(done["out"], F.when(own, F.substring(surrogate, done["at"], F.lit(1))).otherwise(c)).alias("out"),
            )

        # What a longer surrogate has left goes to the end.
        return F.aggregate(_each(given), start, step, lambda done: F.concat(done["out"], F.substring(surrogate, done["at"], F.length(surrogate))))

    value = mention["value"]
    cased = F.array_join(
        F.zip_with(
            _each(surrogate), _each(value), lambda s, v: F.when(v.isNotNull() & v.rlike(r"\p{Lu}"), F.upper(s)).otherwise(s)
        ),
        "",
    )
    named = F.when(value == F.upper(value), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return (
        F.when(mention["kind"].isin("card", "phone", "ssn", "iban"), with_separators(value))
        .when(mention["kind"] == "name", named)
        .when(mention["kind"] == "email", F.substring(cased, F.lit(1), F.length(surrogate)))
        .otherwise(surrogate)
    )


def pseudonymised(docs: DataFrame, key: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, n_entities``: texts with every detected entity replaced, and how many were.

    A null text stays null with 0 entities and an empty one empty; repeated rows change alike; an empty table gives no
    rows; other columns are ignored. ``key`` is secret: with it, and only with it, surrogates can be drawn again.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("_row", F.xxhash64("doc_id", "text")).withColumn("_found", mentions(F.coalesce("text", F.lit(""))))
    # The distinct entities of each text, narrow rows without the text.
    named = materialise(
        rows.filter(F.size("_found") > 0)
        .select("_row", F.explode(F.array_distinct(F.transform("_found", lambda m: F.struct(m["kind"], m["canonical"])))).alias("m"))
        .select("_row", "m.kind", "m.canonical")
        .distinct()
    )
    chosen = surrogates(named, key)
    tag = F.concat_ws("|", "kind", "canonical")
    per_text = (
        named.join(chosen, ["kind", "canonical"])
        .groupBy("_row")
        .agg(F.map_from_entries(F.collect_list(F.struct(tag, "surrogate"))).alias("_chosen"))
    )

    def rebuilt() -> Column:
        gaps = F.split("text", PATTERN, -1)

        def replaced(m: Column) -> Column:
            return bind(F.element_at("_chosen", F.concat_ws("|", m["kind"], m["canonical"])), lambda s: _spelled(m, s))

        pieces = F.zip_with(gaps, F.transform("_found", replaced), lambda g, s: F.concat(g, F.coalesce(s, F.lit(""))))
        return F.when(F.size("_found") > 0, F.array_join(pieces, "")).otherwise(F.col("text"))

    return rows.join(per_text, "_row", "left").select("doc_id", rebuilt().alias("text"), F.size("_found").cast("bigint").alias("n_entities"))
