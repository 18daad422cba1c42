"""Text functions against a plain row model."""

import re

import pytest
from pyspark.sql import functions as F

from promptmill.functions import text as tx
from promptmill.functions.numbers import fixed, round_exact

TEXTS = [
    "", " ", "\t\n ", "one", "Yes.", "a b", "a b a b a b", "word " * 200,
    "non breaking space", "unit\x1cseparated\x1fwords", "漢字 と かな。", "İstanbul ΣΑΣ",
    "emoji 😀😃😄 twice 😀😃😄", "abcd", "abcde", "1234 5678!?", "x́kill", "line\nbreak\r\nend",
    "The quick, brown fox; jumps: over the lazy dog. Really? Yes!",
]


def model_quality(text):
    words = text.split()
    if not words:
        return 0.0
    alpha = sum(c.isalpha() for c in text) / len(text)
    punct = sum(c in ".!?,;:" for c in text) / len(text)
    punct = max(0.0, min(1.0, 1.0 - abs(punct - 0.05) * 10))
    pairs = list(zip(words, words[1:]))
    unique = len(set(pairs)) / len(pairs) if pairs else 1.0
    return round(alpha * 0.5 + punct * 0.2 + unique * 0.3, 4)


def model_norm(text):
    return re.sub(r"\s+", " ", text.lower().strip())


@pytest.fixture(scope="module")
def rows(spark):
    t = F.col("t")
    norm = tx.normalize_text(t)
    return (
        spark.createDataFrame([(x,) for x in TEXTS], "t string")
        .select(
            "t",
            tx.word_count(t).alias("words"),
            tx.approx_tokens(t).alias("tokens"),
            tx.quality_score(t).alias("quality"),
            norm.alias("norm"),
            tx.shingles(norm).alias("grams"),
            tx.is_toxic(t).alias("toxic"),
        )
        .collect()
    )


def test_words_and_tokens(rows):
    for r in rows:
        assert r.words == len(r.t.split()), repr(r.t)
        assert r.tokens == len(r.t.split()) * 1.3


def test_quality(rows):
    for r in rows:
        assert r.quality == model_quality(r.t), repr(r.t)


def test_normalised(rows):
    for r in rows:
        assert r.norm == model_norm(r.t), repr(r.t)


def test_shingles(rows):
    for r in rows:
        n = model_norm(r.t)
        assert sorted(r.grams) == sorted({n[i : i + 5] for i in range(len(n) - 4)})


def test_repeated_words_score_low(spark):
    score = spark.range(1).select(tx.quality_score(F.lit("word " * 200))).first()[0]
    assert score < 0.8


@pytest.mark.parametrize(
    "text, hit",
    [
        ("they KILL it", True), ("skill", False), ("kill-switch", True), ("ékill", False),
        ("kill_all", False), ("x́kill", True), ("(bomb)", True), ("bombs", False), ("", False),
    ],
)
def test_toxic_words(spark, text, hit):
    assert spark.range(1).select(tx.is_toxic(F.lit(text))).first()[0] is hit


def test_jaccard_of_empty_sets(spark):
    empty = F.array().cast("array<string>")
    one = F.array(F.lit("a"), F.lit("b"))
    row = spark.range(1).select(
        tx.jaccard(empty, empty), tx.jaccard(empty, one), tx.jaccard(one, one)
    ).first()
    assert tuple(row) == (1.0, 0.0, 1.0)


def test_rounding_follows_binary_value(spark):
    values = [2.675, 0.8445, 0.8455, 0.8125, 0.5, 1.5, 1 / 3, 1e-7, 0.99995, 0.0, 13 / 32]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 3, 4, 6):
        got = [r[0] for r in df.select(round_exact(F.col("v"), digits)).collect()]
        assert got == [round(v, digits) for v in values]
    texts = df.select(fixed(F.col("v"), 3), fixed(F.col("v"), 0)).collect()
    assert [tuple(t) for t in texts] == [(f"{v:.3f}", f"{v:.0f}") for v in values]


def test_chat_and_training_text(spark):
    df = spark.createDataFrame([('say "hi"', "hi\n😀")], "prompt string, response string")
    messages = tx.chat_messages(F.col("prompt"), F.col("response"))
    line, text = df.select(
        tx.chat_json(F.col("prompt"), F.col("response")), tx.sft_text(messages, "<eos>")
    ).first()
    import json

    assert json.loads(line) == {
        "messages": [
            {"role": "user", "content": 'say "hi"'},
            {"role": "assistant", "content": "hi\n😀"},
        ]
    }
    assert text == '### User:\nsay "hi"\n\n### Assistant:\nhi\n😀<eos>'
