import hashlib
import random

import pytest
from pyspark.sql import functions as F

from promptmill.functions.minhash import balanced_shape, minhash, permutations, recall_shape
from promptmill.functions.text import sample_text
from promptmill.operators import dedup
from promptmill.plans.curation import dedup_logs
from promptmill.plans.queries import QUERIES

NET = (
    "A neural network stacks layers of simple units. Every unit weighs its inputs, adds them up "
    "and passes the result through a curve before the next layer reads it."
)


def model_signature(norm):
    a, b = permutations(128, 1)
    signature = [2**32 - 1] * 128
    for gram in {norm[i : i + 5] for i in range(len(norm) - 4)}:
        h = int.from_bytes(hashlib.sha1(gram.encode()).digest()[:4], "little")
        for k in range(128):
            value = ((int(a[k]) * h + int(b[k])) % 2**64) % (2**61 - 1) & 0xFFFFFFFF
            signature[k] = min(signature[k], value)
    return signature


def model_keep(texts, shape):
    index, kept = set(), []
    for i, text in enumerate(texts):
        s = model_signature(text)
        keys = [(b, tuple(s[b * shape.rows : (b + 1) * shape.rows])) for b in range(shape.bands)]
        if not any(k in index for k in keys):
            index.update(keys)
            kept.append(i)
    return kept


def kept_ids(spark, texts, threshold=0.85, verify=False, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").repartition(3)
    rows = dedup.near_dedup(df, text=F.col("t"), order_by=["id"], threshold=threshold, verify=verify, **options)
    return sorted(r.id for r in rows.collect())


def variants(seed, families=6, copies=8):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "ember", "field", "quiet"]
    texts = []
    for _ in range(families):
        base = [rng.choice(words) + str(rng.randrange(50)) for _ in range(60)]
        for _ in range(copies):
            edited = list(base)
            for _ in range(rng.randrange(0, 7)):
                edited[rng.randrange(60)] = f"edit{rng.randrange(999)}"
            texts.append(" ".join(edited))
    rng.shuffle(texts)
    return texts


def test_signature_matches_plain_model(spark):
    texts = ["", "abcd", "hello world", NET.lower(), "emoji 😀😃 text", "x" * 300]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", minhash(F.col("t")).alias("s")).collect():
        assert list(row.s) == model_signature(row.t)


def test_signature_of_long_text_is_not_a_prefix(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    df = spark.createDataFrame([(long,)], "t string")
    grams = {long[i : i + 5] for i in range(len(long) - 4)}
    assert list(df.select(minhash(F.col("t"))).first()[0]) == model_signature_fast(grams)


def model_signature_fast(grams):
    import numpy as np

    a, b = permutations(128, 1)
    best = np.full(128, 2**32 - 1, dtype=np.uint64)
    for g in grams:
        h = np.uint64(int.from_bytes(hashlib.sha1(g.encode()).digest()[:4], "little"))
        best = np.minimum(best, ((a * h + b) % np.uint64(2**61 - 1)) & np.uint64(2**32 - 1))
    return [int(v) for v in best]


def test_shapes():
    assert (balanced_shape(0.85).bands, balanced_shape(0.85).rows) == (8, 16)
    assert (balanced_shape(0.6).bands, balanced_shape(0.6).rows) == (18, 7)
    assert (balanced_shape(0.3).bands, balanced_shape(0.3).rows) == (37, 3)
    assert 1 - recall_shape(0.85).hit_probability(0.85) <= 1e-6


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_keep_first_rule_matches_sequential_model(spark, seed):
    texts = variants(seed)
    assert kept_ids(spark, texts) == model_keep(texts, balanced_shape(0.85))


def test_chain_is_greedy_not_components(spark):
    """a~b, b~c, a!~c: b falls to a, and c stays as only the dropped b resembles it."""
    rows = [(1, [(1, 1), (9, 9)]), (2, [(1, 1), (2, 2)]), (3, [(2, 2), (8, 8)])]
    firsts = spark.createDataFrame(rows, "ord long, bands array<struct<h1: long, h2: long>>")
    assert [r.ord for r in dedup.dropped_rows(firsts).collect()] == [2]


def test_verified_drops_only_above_threshold(spark):
    texts = variants(4)
    grams = [{t[i : i + 5] for i in range(len(t) - 4)} for t in texts]
    kept = []
    for i, g in enumerate(grams):
        if not any(len(g & grams[k]) / len(g | grams[k]) > 0.6 for k in kept):
            kept.append(i)
    assert kept_ids(spark, texts, threshold=0.6, verify=True) == kept


def sequential(n, links):
    kept = []
    for i in range(n):
        if not any(j in links.get(i, ()) for j in kept):
            kept.append(i)
    return kept


def test_verification_is_the_default(spark):
    import inspect

    assert inspect.signature(dedup.near_dedup).parameters["verify"].default is True


@pytest.mark.parametrize("size", [1, 3, 512])
def test_leaders_settle_as_the_sequential_rule(spark, size):
    """Rows in several buckets, linked at random; whatever the number of leaders, the kept rows are the same."""
    from promptmill.operators.leaders import verified_drops

    rng = random.Random(8)
    texts = variants(9, families=5, copies=12)
    grams = [{t[i : i + 5] for i in range(len(t) - 4)} for t in texts]
    buckets = {(i, rng.randrange(7)) for i in range(len(texts)) for _ in range(3)}
    together = {(i, j) for i, a in buckets for j, b in buckets if a == b and j < i}
    links = {}
    for i, j in together:
        if len(grams[i] & grams[j]) / len(grams[i] | grams[j]) > 0.6:
            links.setdefault(i, set()).add(j)
    frame = spark.createDataFrame([(i, b, -b) for i, b in buckets], "n bigint, h1 bigint, h2 bigint")
    norm = spark.createDataFrame(list(enumerate(texts)), "n bigint, norm string")
    dropped, rounds = verified_drops(frame, norm, 0.6, leaders=size)
    assert sorted(set(range(len(texts))) - {r.n for r in dropped.collect()}) == sequential(len(texts), links)
    assert size == 1 or rounds < 20


def test_a_bucket_of_unlike_rows_ends_in_few_rounds(spark):
    from promptmill.operators.leaders import verified_drops

    n = 5000
    frame = spark.createDataFrame([(i, 7, 7) for i in range(n)], "n bigint, h1 bigint, h2 bigint")
    words = "river stone cloud ember field quiet lantern harbor".split()
    texts = [(i, f"{words[i % 8]} {i * 7919 % 100_003} {words[i // 8 % 8]} {i * 104_729 % 1_000_003} {i}") for i in range(n - 50)]
    texts += [(i, texts[i - n + 50][1]) for i in range(n - 50, n)]  # the last ones repeat the first
    norm = spark.createDataFrame(texts, "n bigint, norm string")
    dropped, rounds = verified_drops(frame, norm, 0.85)
    assert sorted(r.n for r in dropped.collect()) == list(range(n - 50, n))
    assert rounds < 20


def test_one_text_fills_a_third_of_the_rows(spark):
    texts = ["same old text over and over"] * 300 + [f"text number {i} {i * 7919}" * 3 for i in range(600)]
    random.Random(5).shuffle(texts)
    assert kept_ids(spark, texts) == model_keep(texts, balanced_shape(0.85))


def test_unique_exact_and_short_texts(spark):
    assert kept_ids(spark, ["first one here", "something else", "third thing"]) == [0, 1, 2]
    assert kept_ids(spark, [NET, NET.upper(), "  " + NET]) == [0]
    assert kept_ids(spark, ["ab", "", "cd", "longer text"]) == [0, 3]
    assert kept_ids(spark, [NET]) == [0]


def test_near_duplicates_at_low_threshold(spark):
    texts = ["What? " + NET, "What? " + NET + " It learns.", "What? " + NET + " Layers help."]
    assert kept_ids(spark, texts, threshold=0.6) == [0]


def test_empty_input(spark):
    logs = spark.createDataFrame([], "timestamp timestamp, log_id string, prompt string, response string")
    assert dedup_logs(logs, 0.85).count() == 0


def test_order_by_several_columns_keeps_the_first(spark):
    rows = [("2024-01-02", "a", "Q?", NET), ("2024-01-01", "b", "Q?", NET), ("2024-01-01", "c", "Q?", NET)]
    logs = spark.createDataFrame(rows, "timestamp string, log_id string, prompt string, response string")
    assert [r.log_id for r in dedup_logs(logs, 0.85).collect()] == ["b"]


def test_matches_name_the_kept_row(spark):
    texts = [NET, "unrelated words entirely", NET + "!", NET]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    pairs = dedup.near_dup_pairs(df, text=F.col("t"), order_by=["id"], verify=False).collect()
    assert {(p.ord, p["lead"]) for p in pairs} == {(2, 0), (3, 0)}
    assert {p.jaccard for p in pairs if p.ord == 3} == {1.0}


def test_sample_text_joins_with_one_blank(spark):
    row = spark.range(1).select(sample_text(F.lit(None).cast("string"), F.lit("x"))).first()
    assert row[0] == " x"


def test_a_table_in_part_files_is_streamed_whole(spark, tmp_path):
    rows = [(i, f"{NET} Number {i} has {' '.join(f'part{i * k}' for k in range(9))}.", "en", "web", 9) for i in range(30)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    streamed = QUERIES["incremental_curation"](spark, str(tmp_path)).collect()
    assert sorted(streamed) == sorted(QUERIES["curated_samples"](spark, str(tmp_path)).collect()) != []


def test_signing_keeps_few_values_of_a_shingle(spark):
    from promptmill.functions.minhash import _Signer

    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefghijkl ") for _ in range(n)) for n in (5, 40, 300, 2000, 30_000)] + ["xy" * 400]
    signer = _Signer(*permutations(128, 1))
    signed = signer.sign(texts)
    assert [list(s) for s in signed[:3]] == [model_signature(t) for t in texts[:3]]
    for text, signature in zip(texts[3:], signed[3:]):
        assert list(signature) == list(model_signature_fast({text[i : i + 5] for i in range(len(text) - 4)}))
    # One value in 64 below the limit, not all 128 of each shingle.
    assert signer.used < 4 * len(signer.keys)


def test_rows_that_share_many_buckets_are_compared_once(spark):
    from promptmill.operators.leaders import _merged, _paired, _same_leaders

    rows = [(n, h, h) for h in range(50) for n in (1, 2)] + [(n, 99, 99) for n in (1, 2, 3)]
    buckets = spark.createDataFrame(rows, "n bigint, h1 bigint, h2 bigint")
    few = _merged(buckets, _same_leaders(buckets))
    assert sorted(r.n for r in few.collect()) == [1, 1, 2, 2, 3]
    pairs = [(r.h1, r.n) for r in _paired(few).collect() if not r.leads]
    assert sorted(pairs) == [(1, 2), (1, 3), (2, 3)]


def test_a_batch_is_signed_once(spark, tmp_path, monkeypatch):
    from promptmill.operators import dedup as operator
    from promptmill.streaming import incremental

    signed = []
    real = operator.minhash
    monkeypatch.setattr(operator, "minhash", lambda *a: signed.append(1) or real(*a))
    if hasattr(incremental, "minhash"):
        monkeypatch.setattr(incremental, "minhash", operator.minhash)
    rows = [(f"{i}", f"{NET} {i * 7919} {'again ' if i % 2 else ''}{i}", "", "web") for i in range(8)]
    schema = "log_id string, response string, prompt string, model string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    incremental.start_curation(
        spark.readStream.schema(schema).parquet(str(tmp_path / "in")), output=str(tmp_path / "out"),
        checkpoint=str(tmp_path / "checkpoint"), order_by=["log_id"], across_batches=True,
    ).awaitTermination()
    assert len(signed) == 1


def test_voting_shape_misses_as_little_and_meets_fewer_unlike_texts():
    from math import comb

    from promptmill.functions.minhash import voting_shape

    def met(shape, votes, similarity):
        hit = similarity**shape.rows
        return 1 - sum(comb(shape.bands, k) * hit**k * (1 - hit) ** (shape.bands - k) for k in range(votes))

    for threshold in (0.85, 0.6):
        shape, votes = voting_shape(threshold, 512)
        assert votes == 3 and shape.bands * shape.rows <= 512
        assert 1 - met(shape, votes, threshold) <= 1e-6
        unlike = recall_shape(threshold, 512).hit_probability(threshold / 2)
        assert met(shape, votes, threshold / 2) < (0.01 if threshold > 0.8 else 1) * unlike
    assert voting_shape(0.85, 8) == (recall_shape(0.85, 8), 1)


def test_shared_bands_leave_out_what_one_text_alone_has(spark):
    from promptmill.functions.minhash import BandShape
    from promptmill.operators.buckets import shared_bands

    alone = "a text with words that no other one has at all"
    rows = [(1, NET), (2, NET + "!"), (3, alone), (3, alone), (4, None), (5, "ab")]
    texts = spark.createDataFrame(rows, "name bigint, norm string").repartition(3)
    found = shared_bands(texts, BandShape(64, 2), 128).collect()
    assert len(found) == len(set(found))
    bands = {}
    for row in found:
        bands.setdefault(row.key, set()).add(row.name)
    assert set(map(frozenset, bands.values())) == {frozenset({1, 2}), frozenset({4, 5})}
    assert sum(names == {4, 5} for names in bands.values()) == 64


def test_verified_rows_store_no_bands(spark):
    """What a verified run keeps of a text without near copies is a few numbers, not a key for each band."""
    from pathlib import Path

    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(80)) for _ in range(3000)]
    folder = Path(spark.conf.get("spark.checkpoint.dir"))

    def stored():
        return {f: f.stat().st_size for f in folder.rglob("part-*")}

    before = stored()
    assert kept_ids(spark, texts, verify=True) == list(range(len(texts)))
    assert sum(size for f, size in stored().items() if f not in before) < 400 * len(texts)


def test_texts_are_sent_once_a_block(spark, monkeypatch):
    """Near copies that share many buckets, each with leaders of its own."""
    from promptmill.operators import leaders

    sent, beside = [], leaders._Texts.beside
    monkeypatch.setattr(leaders._Texts, "beside", lambda self, rows: sent.append(rows.count()) or beside(self, rows))
    rng = random.Random(4)
    base = [f"word{rng.randrange(999)}" for _ in range(200)]
    texts = [" ".join(base[:i] + [f"edit{i}"] + base[i + 1 :]) for i in range(200)]
    rows = [(i, b, 0) for i in range(len(texts)) for b in rng.sample(range(60), 20)]
    buckets = spark.createDataFrame(rows, "n bigint, h1 bigint, h2 bigint")
    norm = spark.createDataFrame(list(enumerate(texts)), "n bigint, norm string")
    dropped, _ = leaders.verified_drops(buckets, norm, 0.85, votes=3)
    together = {i: {b for j, b, _ in rows if j == i} for i in range(len(texts))}
    links = {i: {j for j in range(i) if len(together[i] & together[j]) >= 3} for i in range(len(texts))}
    assert sorted(set(range(len(texts))) - {r.n for r in dropped.collect()}) == sequential(len(texts), links)
    assert sum(sent) < 4 * len(texts)


def test_workers_need_no_copy_of_the_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from promptmill.functions.minhash import BandShape
    from promptmill.operators import buckets, leaders

    sent = cloudpickle.dumps((buckets._bands(BandShape(4, 2), 8), buckets._shared, leaders._links(0.85)))
    (tmp_path / "sent").write_bytes(sent)
    read = "import pickle, sys; pickle.load(open('sent', 'rb')); assert 'promptmill' not in sys.modules"
    subprocess.run([sys.executable, "-c", read], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})
