"""Whitening, compression rules and lexical search against plain models."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from promptmill.llm import compression, lexical, whitening
from promptmill.llm.queries import QUERIES
from promptmill.llm.spectrum import count_above, leading

# ---- whitening


def symmetric(seed, values):
    draw = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(draw.standard_normal((len(values), len(values))))
    made = turn @ np.diag(values) @ turn.T
    return (made + made.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        [9.0, 5.0, 3.0, 2.0, 1.0, 0.5],
        [5.0, 5.0, 5.0, 4.0, 1.0],  # equal
        [1e6, 1e6 * (1 + 1e-12), 3.0, 3.0, 1e-3],  # nearly equal
        [2.0, 1.0, 0.0, 0.0, 0.0],  # rank 2
        [3.0],
    ],
)
def test_leading_pairs(values):
    for seed in range(5):
        matrix = symmetric(seed, values)
        found, vectors = leading(matrix, 4)
        wanted = sorted(values, reverse=True)[:4]
        scale = max(values)
        assert len(found) == sum(v > 0 for v in wanted)
        assert np.allclose(found, wanted[: len(found)], rtol=0, atol=1e-13 * scale)
        assert np.abs(matrix @ vectors.T - vectors.T * found).max() <= 1e-13 * scale
        assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-12


def test_inertia_counts():
    draw = np.random.default_rng(3)
    for n in (1, 2, 7, 40):
        made = draw.standard_normal((n, n))
        matrix = made + made.T
        values = np.linalg.eigvalsh(matrix)
        for shift in [*((values[1:] + values[:-1]) / 2), values[0] - 1, values[-1] + 1]:
            assert count_above(matrix, shift) == (values > shift).sum()
    assert count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1  # no diagonal pivot
    assert count_above(np.zeros((3, 3)), 0.0) == 0


def vectors(seed=1, n=200, length=7):
    draw = np.random.default_rng(seed)
    made = (draw.standard_normal((n, length)) * np.arange(1, length + 1) ** 0.7 + 0.3).astype(np.float32)
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(made)]
    rows += [rows[0], rows[0], (None, rows[3][1]), (901, [v + 1e-5 for v in rows[4][1]])]  # repeats, and nearly one
    bad = [(902, None), (903, []), (904, [None] * length), (905, [1.0] * (length + 1)), (906, [float("nan")] + [0.0] * (length - 1))]
    bad += [(907, [float("-inf")] + [0.0] * (length - 1)), (908, [1e30] + [0.0] * (length - 1)), (909, [0.1] * (length - 1) + [None])]
    return rows, bad


@pytest.fixture(scope="module")
def embedded(spark):
    rows, bad = vectors()
    frame = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<float>")
    clash = ["_id", "_vector", "packed", "length", "whitened", "deviation", "value", "i", "component"]
    return frame.select("*", *(F.lit("mine").alias(c) for c in clash)).repartition(3)


def on_grid(rows):
    return [tuple(math.floor(256 * float(np.float32(v))) for v in row[1]) for row in rows]


def test_whitening_is_that_of_a_plain_model(embedded):
    rows, _ = vectors()
    grid = on_grid(rows)
    distinct = np.array(sorted(set(grid)), float)
    fitted = whitening.fit_list(embedded)
    model = whitening.fit(fitted, 4)
    values, found = np.linalg.eigh(np.cov(distinct.T, bias=True))
    values, found = values[::-1][:4], found[:, ::-1][:, :4]
    assert model.n == len(distinct)
    assert list(model.sums) == [int(s) for s in distinct.sum(axis=0)]
    assert np.allclose(model.values, values, rtol=1e-12)
    assert np.allclose(model.explained, values / np.cov(distinct.T, bias=True).trace(), rtol=1e-12)
    assert whitening.identity_error(fitted, model) < 1e-10
    got = whitening.whiten(embedded, model).collect()
    exact = Counter((row[0], sum((model.n * x - s) ** 2 for x, s in zip(own, model.sums))) for row, own in zip(rows, grid))
    assert Counter((r["vec_id"], int(r["deviation"])) for r in got) == exact
    signs = np.sign((model.vectors * found.T).sum(axis=1))
    wanted = {row[0]: (np.array(own) - distinct.mean(axis=0)) @ found / np.sqrt(values) * signs for row, own in zip(rows, grid)}
    assert all(np.allclose(r["whitened"], wanted[r["vec_id"]], atol=1e-9) for r in got)


def test_whitening_does_not_depend_on_the_deal(embedded):
    one, other = (whitening.fit(whitening.fit_list(embedded.repartition(p)), 4) for p in (1, 8))
    assert one.sums == other.sums and (one.values == other.values).all() and (one.vectors == other.vectors).all()


def test_whitening_of_wide_numbers_stays_exact(spark):
    rows = [(i, [float(v * (1 << 30) + i), float(i % 3)]) for i, v in enumerate([1, -2, 3, 1, 2, -3])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    model = whitening.fit(whitening.fit_list(frame), 4)
    grid = [[math.floor(256 * v) for v in r[1]] for r in rows]
    assert list(model.sums) == [sum(g[j] for g in grid) for j in range(2)]
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(frame, model).collect()}
    assert got == {i: sum((6 * x - s) ** 2 for x, s in zip(g, model.sums)) for i, g in enumerate(grid)}


def test_whitening_of_few_vectors(spark, embedded):
    empty = embedded.filter("false")
    model = whitening.fit(whitening.fit_list(empty))
    assert model.n == 0 and not len(model.values)
    assert whitening.whiten(empty, model).count() == 0
    alone = embedded.filter("vec_id = 5")
    model = whitening.fit(whitening.fit_list(alone))
    assert model.n == 1 and not len(model.values)
    assert [list(r["whitened"]) for r in whitening.whiten(alone, model).collect()] == [[]]
    two = embedded.filter("vec_id IN (5, 6)")
    assert len(whitening.fit(whitening.fit_list(two)).values) == 1


def test_whitening_query(spark):
    df = QUERIES["op11_embedding_whitening"](spark, "/root/testdata/sf0.001")
    rows = df.collect()
    given = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()
    assert len(rows) == 4 * given and {r["component"] for r in rows} == {1, 2, 3, 4}
    assert dict(df.dtypes) | {"n": "bigint", "deviation": "bigint", "component": "int", "whitened": "double"} == dict(df.dtypes)
    assert all(r["identity_error"] < 1e-4 for r in rows)


# ---- compression rules


def plain_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(8)}
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def plain_verdict(text):
    raw, squeeze = (text or "").encode(), zstandard.ZstdCompressor(level=3)
    if len(raw) < 128:
        return True

    def fine(part):
        low, high = next(((b.low, b.high) for b in reversed(compression.BANDS) if b.size <= len(part)), (0, 9))
        return low <= len(squeeze.compress(part)) / len(part) <= high

    chunks = [raw[i : i + 2048] for i in range(0, len(raw), 2048)] if len(raw) > 2048 else []
    if len(chunks) > 1 and len(chunks[-1]) < 1024:
        chunks[-2:] = [chunks[-2] + chunks[-1]]
    return fine(raw) and sum(len(c) for c in chunks if not fine(c)) <= compression.CHUNK_SHARE * len(raw)


def prose(seed, n):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdefghiklmnoprstuvwäß", k=draw.randint(2, 9))) for _ in range(800)]
    return " ".join(draw.choices(vocabulary, k=n))


def noise(n):
    return base64.b64encode(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n))).decode()


LONG = prose(9, 60_000)
RULED = [
    None, "", " \n\t", "a", "one two three", prose(1, 19), prose(2, 20), prose(3, 400), prose(4, 3000), LONG,
    "again and again " * 300, "line one is here\n" * 5 + "\n \n\n" + "other\r\nother\r\nlast", "x" * 300_000, "é😀 " * 50,
    prose(5, 100) + " " + prose(5, 100), "a b c d e f g h a b c d e f g h", "# * $ % & | < > word" * 3, "\x00\x0b\x0c\x1cword w v",
    " ".join(noise(100)[i : i + 12] for i in range(0, 4000, 12)), noise(400), prose(6, 700) + " " + "tail tail " * 900,
    prose(7, 300) + "\n" + prose(7, 300), "same\nsame\nsame", "\n".join([prose(8, 30)] * 4),
]


@pytest.fixture(scope="module")
def ruled(spark):
    rows = [*enumerate(RULED), (3, RULED[3]), (None, RULED[7])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    clash = ["n_words", "ratio", "kept", "base_failed", "c0"]
    return rows, frame.select("*", *(F.lit("mine").alias(c) for c in clash)).repartition(3)


def test_rules_are_those_of_a_plain_model(ruled):
    rows, docs = ruled
    got = Counter(tuple(r) for r in compression.rules(docs).drop("ratio", "bad_chunks", "compression_failed").collect())
    wanted = Counter()
    for doc_id, text in rows:
        counts = plain_rules(text)
        wanted[(doc_id, *counts, not counts[-1] and plain_verdict(text))] += 1
    assert got == wanted


def test_rules_see_repetition_and_noise(ruled):
    _, docs = ruled
    failed = {r["doc_id"] for r in compression.rules(docs).filter("compression_failed").collect()}
    assert {10, 12, 19, 20} <= failed  # repeated phrase, one letter, noise, repetitive tail
    assert not failed & {5, 6, 7, 8, 9}


def test_rules_of_an_empty_table(ruled):
    assert compression.rules(ruled[1].filter("false")).count() == 0


def test_rules_with_own_limits(ruled):
    _, docs = ruled
    strict = compression.rules(docs, bands=[compression.Band(1, 5.0, 6.0)], chunk=512, chunk_share=0.0)
    kept = {r["doc_id"] for r in strict.filter("not compression_failed").collect()}
    assert kept == {0, 1}


def test_rules_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op12_quality_rules"](spark, folder).collect():
        counts = plain_rules(texts[r["doc_id"]])
        assert tuple(r)[1:7] == counts
        assert r["kept"] == (not counts[-1] and plain_verdict(texts[r["doc_id"]]))


# ---- lexical search

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms_of(text):
    return [t.translate(LOWER) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain_ranking(docs, items, k):
    counts = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in set(items):
        own = set(terms_of(text))
        found = []
        for doc_id, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // length
            score = 0
            for t in own & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, doc_id is not None, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(sorted(found)[:k], 1)]
    return Counter(out)


def corpus(seed=4, n=300):
    draw = random.Random(seed)
    words = [f"{a}{b}" for a in "ka lo ti ve pu".split() for b in "ba do mi xu na é ß".split()]
    shares = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(draw.choices(words, shares, k=draw.randint(1, 60)))) for i in range(n)]
    docs += [(1000 + i, docs[7][1]) for i in range(120)]  # ties beyond k
    docs += [docs[0], docs[0], (None, docs[7][1]), (None, docs[1][1]), (2000, None), (2001, ""), (2002, "... -- "), (2003, None)]
    docs += [(2004, "KABA, Kaba: kaba" + " lodo" * 20_000), (2005, "Éß KA-BA x9"), (2006, "ka" * 30_000)]
    items = [(i, " ".join(draw.sample(words, draw.randint(1, 12)))) for i in range(25)]
    items += [(50, docs[7][1]), (50, docs[7][1]), (51, None), (52, ""), (53, "?!"), (54, "nowhere"), (None, "kaba tiba"), (3, "Lodo KAÉ x9")]
    return docs, items


@pytest.mark.parametrize("block_terms", [1 << 18, 60])
def test_ranking_is_that_of_a_plain_model(spark, block_terms):
    docs, items = corpus()
    clash = [F.lit("mine").alias(c) for c in ("term", "score", "rank", "bucket", "norm", "item", "_part")]
    given = spark.createDataFrame(docs, "doc_id bigint, text string").select("*", *clash).repartition(5)
    asked = spark.createDataFrame(items, "item_id bigint, text string").select("*", *clash)
    got = Counter(tuple(r) for r in lexical.rank(given, asked, 20, block_terms=block_terms).collect())
    assert got == plain_ranking(docs, items, 20)


def test_ranking_without_documents_or_items(spark):
    docs, items = corpus()
    given = spark.createDataFrame(docs, "doc_id bigint, text string")
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    assert lexical.rank(given.filter("false"), asked).collect() == []
    assert lexical.rank(given, asked.filter("false")).collect() == []
    assert lexical.rank(given.filter("doc_id = 2000"), asked).collect() == []


def test_pruning_leaves_work_out_but_no_result(spark):
    """A query of rare terms: most vectors are cut off by their norm or by the coordinate bound."""
    queries = lexical._Queries(np.array([0]), np.zeros(3, int), np.array([0, 1, 2]), np.array([500, 300, 10]))
    norm = np.array([900.0, 500.0, 400.0, 50.0])
    rows = np.array([0, 1, 1, 2, 3])
    values = np.array([900, 300, 400, 400, 50])
    terms = np.array([2, 0, 1, 0, 1])
    posting = np.argsort(terms, kind="stable")
    first = np.searchsorted(terms[posting], np.arange(4))
    kept = lexical._candidates(queries.of(0), 4, norm, rows, values, posting, first, 600)
    assert kept.tolist() == [0, 1]
