"""Secret scans over a trigram inverted index.

Each rule's regular expression is read into a Boolean query over trigrams that a match must contain. Postings of
the trigrams that any query names are gathered and intersected into candidate texts, and only those are
searched; rules without a mandatory trigram search every text. All steps are column expressions.
"""

from __future__ import annotations

import re._constants as kinds
import re._parser as parser
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions.binding import bind


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters, or the match is dropped."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0


#: The three base rules.
BASE_RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED_RULES = (
    Rule("pem", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    # Guarded in front, else a run of "eyJ" without a dot would be read anew from each.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + ADDED_RULES

#: A query is True (any text), a trigram, or ("and" | "or", parts).
Query = bool | str | tuple
_MOST = 64  # strings followed at once while a pattern is read


def _both(*parts: Query) -> Query:
    kept = tuple(dict.fromkeys(p for p in parts if p is not True))
    return True if not kept else kept[0] if len(kept) == 1 else ("and", kept)


def _either(*parts: Query) -> Query:
    kept = tuple(dict.fromkeys(parts))
    return True if True in kept else kept[0] if len(kept) == 1 else ("or", kept)


def _of_strings(strings: set[str]) -> Query:
    """Any of the strings must occur; a string whose trigrams include another's asks nothing more."""
    asked = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    least = [a for a in asked if not any(b < a for b in asked)]
    return _either(*(_both(*sorted(a)) for a in sorted(least, key=sorted)))


def _strings(op, value) -> set[str] | None:
    """All strings an element can match, lower-cased, if they are few."""
    if op is kinds.LITERAL:
        return {chr(value).lower()}
    if op is kinds.IN:
        found: set[str] = set()
        for kind, what in value:
            if kind is kinds.LITERAL:
                found.add(chr(what).lower())
            elif kind is kinds.RANGE and what[1] - what[0] < 4:
                found |= {chr(c).lower() for c in range(what[0], what[1] + 1)}
            else:
                return None
        return found if len(found) <= 4 else None
    if op is kinds.SUBPATTERN:
        return _sequence_strings(value[3])
    if op is kinds.BRANCH:
        options = [_sequence_strings(branch) for branch in value[1]]
        return None if None in options else set().union(*options)
    if op is kinds.MAX_REPEAT and value[1] <= 3:
        once = _sequence_strings(value[2])
        if once is not None:
            return {"".join(p) for n in range(value[0], value[1] + 1) for p in product(once, repeat=n)}
    return None


def _sequence_strings(parsed) -> set[str] | None:
    found = {""}
    for op, value in parsed:
        own = _strings(op, value)
        if own is None or len(found) * len(own) > _MOST:
            return None
        found = {a + b for a in found for b in own}
    return found


def _query(parsed) -> Query:
    run, parts = {""}, []
    for op, value in parsed:
        own = _strings(op, value)
        if own is not None and len(run) * len(own) <= _MOST:
            run = {a + b for a in run for b in own}
            continue
        parts.append(_of_strings(run))
        run = own if own is not None else {""}
        if own is None and op is kinds.SUBPATTERN:
            parts.append(_query(value[3]))
        elif own is None and op is kinds.BRANCH:
            parts.append(_either(*(_query(branch) for branch in value[1])))
        elif own is None and op is kinds.MAX_REPEAT and value[0] > 0:
            parts.append(_query(value[2]))
    return _both(*parts, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """Trigrams, in lower case, that any text with a match contains once it is lower-cased."""
    return _query(parser.parse(pattern))


def trigrams_of(query: Query) -> set[str]:
    if isinstance(query, str):
        return {query}
    return set() if query is True else set().union(*map(trigrams_of, query[1]))


def _satisfied(query: Query, held: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(held, query)
    joined = [_satisfied(part, held) for part in query[1]]
    return reduce((lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b), joined)


def postings(keyed: DataFrame, text: str, rules: Sequence[Rule]) -> DataFrame:
    """``trigram, _key``: the texts that hold each trigram some rule names."""
    named = sorted(set().union(*(trigrams_of(trigram_query(rule.pattern)) for rule in rules)))
    if not named:
        return keyed.select(F.lit("").alias("trigram"), "_key").filter(F.lit(False))
    held = bind(F.lower(text), lambda low: F.filter(F.array(*map(F.lit, named)), lambda t: F.contains(low, t)))
    return keyed.select("_key", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``_key, _rules``: the rules whose queries a text's postings satisfy."""
    queries = {rule.name: trigram_query(rule.pattern) for rule in rules}
    passed = F.filter(
        F.array(*(F.when(_satisfied(q, F.col("held")), F.lit(name)) for name, q in queries.items() if q is not True)),
        lambda name: name.isNotNull(),
    )
    held = index.groupBy("_key").agg(F.collect_set("trigram").alias("held"))
    return held.select("_key", passed.alias("_rules")).filter(F.size("_rules") > 0)


_SPAN = "struct<start: bigint, rank: int, kind: string, end: bigint>"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Leftmost matches that do not overlap, with code point offsets.

    The text between two matches and the matches themselves give each match's place.
    """
    nothing = F.array().cast(f"array<{_SPAN}>")

    def place(matches: Column) -> Column:
        between = F.slice(F.split(text, rule.pattern, -1), 1, F.size(matches))
        start = F.struct(F.lit(0).cast("bigint").alias("at"), nothing.alias("spans"))

        def step(done: Column, pair: Column) -> Column:
            begin = done["at"] + F.length(pair["gap"])
            end = begin + F.length(pair["match"])
            part = pair["match"] if rule.group == 0 else F.regexp_extract(pair["match"], rule.pattern, rule.group)
            span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.name).alias("kind"), end.alias("end"))
            kept = F.when(F.length(part) >= rule.least, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
            return F.struct(end.alias("at"), kept.cast(f"array<{_SPAN}>").alias("spans"))

        pairs = F.zip_with(matches, between, lambda m, g: F.struct(m.alias("match"), g.alias("gap")))
        return F.when(F.size(matches) > 0, F.aggregate(pairs, start, step)["spans"]).otherwise(nothing)

    return bind(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), place)


def with_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``secrets``: the spans of each row's text, by start and then by the order of the rules.

    Spans of different rules may overlap. A null text counts as empty and has none; repeated rows each get theirs; an
    empty table gives no rows; a column ``secrets`` is replaced.
    """
    nothing = F.array().cast(f"array<{_SPAN}>")
    kept = [c for c in docs.columns if c != "secrets"]
    row = F.struct(*kept).alias("_row")
    keyed = docs.select(row, F.coalesce(F.col(text), F.lit("")).alias("_own"), F.xxhash64(doc_id, text).alias("_key"))
    found = candidates(postings(keyed, "_own", rules), rules)
    spans = []
    for rank, rule in enumerate(rules):
        own = _spans(F.col("_own"), rule, rank)
        if trigram_query(rule.pattern) is not True:
            own = F.when(F.coalesce(F.array_contains("_rules", rule.name), F.lit(False)), own).otherwise(nothing)
        spans.append(own)
    return keyed.join(found, "_key", "left").select("_row.*", F.sort_array(F.concat(*spans)).alias("secrets"))


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, secrets`` of every row, as ``with_secrets`` finds them; other columns are ignored."""
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return with_secrets(given, rules).select("doc_id", "secrets")


def written(secrets: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, secrets: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by one mark; overlapping spans share one."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        fresh = span["start"] >= done["at"]
        gap = F.substring(text, done["at"].cast("int") + 1, (span["start"] - done["at"]).cast("int"))
        out = F.when(fresh, F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), out.alias("out"))

    def close(done: Column) -> Column:
        rest = F.substring(text, done["at"].cast("int") + 1, F.length(text))
        return F.concat(done["out"], rest)

    return F.when(F.size(secrets) > 0, F.aggregate(secrets, start, step, close)).otherwise(text)
