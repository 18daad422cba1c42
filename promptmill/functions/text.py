"""Column expressions over prompt/response text. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from promptmill.functions.binding import bind
from promptmill.functions.numbers import round_exact

# The default blocklist, whole words, case ignored.
BLOCKLIST = ("kill", "murder", "rape", "terrorist", "bomb", "suicide")

# Fixed value: estimated model tokens per word.
TOKENS_PER_WORD = 1.3

# Unicode White_Space plus the four ASCII separators that Python's str.split() also splits on.
_SPACE = r"(?U)[\s\x1c-\x1f]+"
_WORD_CHARS = r"\p{L}\p{N}_"


def sample_text(prompt: Column, response: Column) -> Column:
    """The text a sample is judged by; a missing side counts as empty."""
    return F.concat_ws(" ", F.coalesce(prompt, F.lit("")), F.coalesce(response, F.lit("")))


def words(text: Column) -> Column:
    """Whitespace-separated words as an array, without empty ones."""
    return F.filter(F.split(text, _SPACE), lambda word: word != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def approx_tokens(text: Column) -> Column:
    return word_count(text) * F.lit(TOKENS_PER_WORD)


def _share(count: Column, text: Column) -> Column:
    return count / F.greatest(F.length(text), F.lit(1))


def alpha_ratio(text: Column) -> Column:
    """Letters (Unicode category L) as a share of all characters."""
    return _share(F.length(F.regexp_replace(text, r"\P{L}+", "")), text)


def punct_score(text: Column) -> Column:
    """1 at five percent sentence punctuation, falling to 0 ten points away."""
    marks = F.length(text) - F.length(F.translate(text, ".!?,;:", ""))
    distance = F.abs(_share(marks, text) - F.lit(0.05)) * F.lit(10.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - distance))


def _distinct_pair_share(tokens: Column) -> Column:
    pairs = F.size(tokens) - 1
    # Words hold no blank, so each word that another follows starts one pair.
    bigrams = F.regexp_extract_all(
        F.array_join(tokens, " "), F.lit("(?=([^ ]++ [^ ]++))[^ ]++"), F.lit(1)
    )
    return F.when(pairs > 0, F.size(F.array_distinct(bigrams)) / pairs).otherwise(F.lit(1.0))


def bigram_unique_ratio(text: Column) -> Column:
    """Distinct word pairs over all word pairs; 1 when there is no pair."""
    return bind(words(text), _distinct_pair_share)


def quality_score(text: Column, tokens: Column | None = None) -> Column:
    """Weighted letter share, punctuation and repetition in [0, 1]; 0 for blank text.

    ``tokens`` are the words of ``text`` where the caller has them already.
    """

    def weigh(given: Column) -> Column:
        score = (
            alpha_ratio(given["text"]) * F.lit(0.5)
            + punct_score(given["text"]) * F.lit(0.2)
            + _distinct_pair_share(given["tokens"]) * F.lit(0.3)
        )
        rounded = bind(score, lambda value: round_exact(value, 4))
        return F.when(F.size(given["tokens"]) > 0, rounded).otherwise(F.lit(0.0))

    tokens = words(text) if tokens is None else tokens
    return bind(F.struct(text.alias("text"), tokens.alias("tokens")), weigh)


def is_toxic(text: Column, blocklist: Sequence[str] = BLOCKLIST) -> Column:
    """Whole-word match of any blocklist entry (entries are regular expressions)."""
    alternatives = "|".join(blocklist)
    return text.rlike(
        rf"(?iu)(?<![{_WORD_CHARS}])(?:{alternatives})(?![{_WORD_CHARS}])"
    )


def normalize_text(text: Column) -> Column:
    """Lower case, inner whitespace collapsed to one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), _SPACE, " "))


def shingles(normalized: Column, size: int = 5) -> Column:
    """Distinct character n-grams by code point; empty when the text is shorter than ``size``.

    The lookahead captures an overlapping window and the trailing dot consumes one code point,
    so characters outside the basic plane are never cut in half.
    """
    pattern = rf"(?s)(?=(.{{{size}}}))."
    return F.array_distinct(F.regexp_extract_all(normalized, F.lit(pattern), F.lit(1)))


def jaccard(left: Column, right: Column) -> Column:
    """Overlap of two distinct arrays; two empty arrays are equal."""

    def share(common: Column) -> Column:
        union = F.size(left) + F.size(right) - common
        return F.when(union == 0, F.lit(1.0)).otherwise(common / union)

    return bind(F.size(F.array_intersect(left, right)), share)


def id_prefix(identifier: Column, length: int = 8) -> Column:
    return F.substring(identifier, 1, length)


def chat_messages(prompt: Column, response: Column) -> Column:
    """One user and one assistant message, the shape chat fine-tuning reads."""
    return F.array(
        F.struct(F.lit("user").alias("role"), prompt.alias("content")),
        F.struct(F.lit("assistant").alias("role"), response.alias("content")),
    )


def chat_json(prompt: Column, response: Column) -> Column:
    return F.to_json(
        F.struct(chat_messages(prompt, response).alias("messages")),
        {"ignoreNullFields": "false"},
    )


def sft_text(messages: Column, eos_token: str) -> Column:
    """Plain training text for tokenizers without a chat template; other roles are skipped."""
    known = F.filter(messages, lambda m: m["role"].isin("user", "assistant"))
    blocks = F.transform(
        known,
        lambda m: F.concat(
            F.when(m["role"] == "user", F.lit("### User:\n")).otherwise(
                F.lit("### Assistant:\n")
            ),
            F.coalesce(m["content"], F.lit("")),
        ),
    )
    return F.concat(F.array_join(blocks, "\n\n"), F.lit(eos_token))
