"""The registered queries over whole tables, one per operator, and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import functions as F

from promptmill.llm import (
    compression,
    decontamination,
    html_text,
    jaccard,
    lexical,
    lm_scoring,
    packing,
    pii,
    quality,
    secrets,
    sharding,
    whitening,
)
from promptmill.llm import fingerprints as fp

QUERIES = {}
ORACLES = {}

#: Key of the surrogate query; a real run brings its own.
SURROGATE_KEY = "example key"


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_lm_scoring(spark, sf_dir):
    """Documents against two models: of those labelled as good, and of all."""
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    scored = lm_scoring.score(table(spark, sf_dir, "documents"), good)
    losses = [F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "difference")]
    return scored.select("doc_id", "n_tokens", *losses)


@query
def op2_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    packed = packing.pack(packing.token_pieces(docs, word_tokenizer()))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op3_document_fingerprints(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = fp.lexicon(docs.select(F.coalesce("text", F.lit("")).alias("text")))
    kept = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - floor(length(text) / 4))"), F.substring("next", F.lit(1), kept))
    rows = fp.neighbours(docs).withColumn("next", F.lead("text").over(fp.following())).withColumn("edited", edited)
    hashed = fp.with_hashes(rows.drop("next"), lexicon, ["text", "edited"], "hashes")
    own, changed, following = F.col("hashes")[0], F.col("hashes")[1], F.col("following")
    hashed = hashed.withColumn("following", F.lead(own).over(fp.following())).filter("not _ghost")
    return hashed.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fp.written(own).alias("fingerprint"),
        fp.written(changed).alias("edited_fingerprint"),
        fp.likeness(own, changed).alias("near_edited"),
        fp.likeness(own, following).alias("near_next"),
    )


@query
def op4_sharding(spark, sf_dir):
    placed = sharding.shard(table(spark, sf_dir, "documents"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op5_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.classified(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query
def op6_secret_scans(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = [rule.name for rule in secrets.BASE_RULES]

    def count(name):
        return F.size(F.filter("secrets", lambda s: s["kind"] == name)).cast("bigint").alias(f"n_{name}")

    of_base = secrets.written(F.filter("secrets", lambda s: s["kind"].isin(*base)))
    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(of_base.cast("binary"), 256).alias("base_sha256"),
        secrets.written(F.col("secrets")).alias("spans"),
    )


@query
def op7_benchmark_decontamination(spark, sf_dir):
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"),
    )


@query
def op8_html_extraction(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op9_ngram_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_surrogate_generation(spark, sf_dir):
    return pii.pseudonymised(table(spark, sf_dir, "documents"), SURROGATE_KEY)


@query
def op11_embedding_whitening(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    fitted = whitening.fit_list(vectors)
    model = whitening.fit(fitted, 4)
    error = whitening.identity_error(fitted, model)
    explained = F.array(*(F.lit(float(e)) for e in model.explained)).cast("array<double>")
    rows = whitening.whiten(vectors, model).select(
        "vec_id", F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.posexplode("whitened").alias("place", "whitened")
    )
    return rows.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


@query
def op12_quality_rules(spark, sf_dir):
    return compression.rules(table(spark, sf_dir, "documents"))


@query
def op13_ranked_lexical_search(spark, sf_dir):
    """The 50 best documents of each benchmark item."""
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (
    rf"list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
)

ORACLES["op1_lm_scoring"] = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS target FROM documents),
tokens AS (SELECT r, target, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM texts),
paired AS (SELECT r, target, w, coalesce(lag(w) OVER (PARTITION BY r ORDER BY pos), '^') AS h FROM tokens),
pairs AS (
  SELECT h, w, count(*)::DOUBLE AS n, coalesce(sum(target::INT), 0)::DOUBLE AS t FROM paired GROUP BY h, w),
single AS (SELECT w, sum(n) AS n, sum(t) AS t FROM pairs GROUP BY w),
total AS (SELECT sum(n) AS n, sum(t) AS t, count(*) + 1 AS size FROM single),
history AS (
  SELECT w AS h, n, t FROM single
  UNION ALL SELECT '^', count(*)::DOUBLE, coalesce(sum(target::INT), 0)::DOUBLE FROM texts WHERE len(words) > 0),
chances AS (
  SELECT h, w, (single.n + 1) / (total.n + size) AS pn, (single.t + 1) / (total.t + size) AS pt,
         pairs.n / history.n AS bn, CASE WHEN history.t > 0 THEN pairs.t / history.t END AS bt
  FROM pairs JOIN single USING (w) JOIN history USING (h), total),
scored AS (
  SELECT r, -ln(coalesce(0.5::DOUBLE * bt + 0.5::DOUBLE * pt, pt)) AS lt, -ln(0.5::DOUBLE * bn + 0.5::DOUBLE * pn) AS ln
  FROM paired JOIN chances USING (h, w)),
means AS (SELECT r, avg(lt) AS lt, avg(ln) AS ln FROM scored GROUP BY r)
SELECT doc_id, len(words) AS n_tokens, coalesce(round(lt, 6), 0) AS target_loss,
       coalesce(round(ln, 6), 0) AS background_loss, coalesce(round(lt - ln, 6), 0) AS difference
FROM texts LEFT JOIN means USING (r)
"""

ORACLES["op7_benchmark_decontamination"] = rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
starts AS (
  SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 12, 1))) AS pos
  FROM items WHERE len(words) > 0),
windows AS (SELECT DISTINCT item_id, list_slice(words, pos, pos + 12) AS win FROM starts),
sizes AS (SELECT DISTINCT len(win) AS m FROM windows),
runs AS (
  SELECT r, m, words, unnest(generate_series(1, len(words) - m + 1)) AS pos
  FROM texts, sizes WHERE len(words) >= m),
found AS (
  SELECT r, pos, m, item_id FROM (SELECT r, pos, m, list_slice(words, pos, pos + m - 1) AS win FROM runs)
  JOIN windows USING (win)),
hits AS (
  SELECT r, count(DISTINCT place) AS n_hit
  FROM (SELECT r, unnest(generate_series(pos, pos + m - 1)) AS place FROM found) GROUP BY r),
named AS (
  SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM found GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM texts LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

ORACLES["op9_ngram_jaccard_join"] = rf"""
WITH RECURSIVE texts AS (
  SELECT coalesce(text, chr(1)) AS text, min(doc_id) AS c, any_value({_WORDS}) AS words
  FROM documents GROUP BY coalesce(text, chr(1))),
shingles AS (
  SELECT DISTINCT c, list_slice(words, pos, pos + 4) AS s
  FROM (SELECT c, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS pos FROM texts WHERE len(words) > 0)),
sizes AS (SELECT c, count(*) AS n FROM shingles GROUP BY c),
common AS (
  SELECT a.c AS a, b.c AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.c <> b.c GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.c = a JOIN sizes y ON y.c = b
  WHERE common.n * 5 >= 4 * (x.n + y.n - common.n)),
reach AS (SELECT c, c AS root FROM texts UNION SELECT reach.c, links.b FROM reach JOIN links ON links.a = reach.root),
classes AS (SELECT c, min(root) AS class_id FROM reach GROUP BY c),
counts AS (SELECT a AS c, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, c AS copy_of, class_id, coalesce(n_links, 0) AS n_links
FROM documents JOIN texts ON coalesce(documents.text, chr(1)) = texts.text JOIN classes USING (c) LEFT JOIN counts USING (c)
"""

ORACLES["op13_ranked_lexical_search"] = rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT DISTINCT item_id, {_WORDS} AS words, text FROM benchmark),
wanted AS (SELECT item_id, text, unnest(list_distinct(words)) AS t FROM items),
whole AS (SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM texts WHERE len(words) > 0),
counted AS (
  SELECT r, doc_id, t, n, count(*) AS tf FROM (SELECT r, doc_id, len(words) AS n, unnest(words) AS t FROM texts)
  WHERE t IN (SELECT t FROM wanted) GROUP BY r, doc_id, t, n),
weighed AS (
  SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counted, whole GROUP BY t),
scored AS (
  SELECT item_id, text, r, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM wanted JOIN counted USING (t) JOIN weighed USING (t), whole GROUP BY item_id, text, r, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 50
"""
