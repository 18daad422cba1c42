"""DuckDB SQL that answers the registered queries independently."""

from __future__ import annotations

import numpy as np

from promptmill.config import CANDIDATES, DEFAULT_PRICE, PRICING
from promptmill.plans.queries import DATA_BLOCKLIST, DATA_CRITERIA
from promptmill.plans.standins import EVENT_MODELS, EVENT_STAGES

ORACLES: dict[str, str] = {}

_SPACE = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{_SPACE}+'), lambda w: w <> '')"


def _round(x: str, digits: int) -> str:
    """Half-even rounding of the exact binary value."""
    s = f"{10**digits}::DOUBLE"
    high = "(v * 134217729::DOUBLE - (v * 134217729::DOUBLE - v))"
    error = f"(({high} * {s} - v * {s}) + (v - {high}) * {s})"
    part = f"(v * {s} - floor(v * {s}))"
    even = f"(CASE WHEN floor(v * {s}) % 2 = 0 THEN floor(v * {s}) ELSE floor(v * {s}) + 1 END)"
    whole = (
        f"(CASE WHEN {part} < 0.5 OR ({part} = 0.5 AND {error} < 0) THEN floor(v * {s}) "
        f"WHEN {part} > 0.5 OR {error} > 0 THEN floor(v * {s}) + 1 ELSE {even} END)"
    )
    return f"list_transform([({x})::DOUBLE], lambda v: {whole} / {s})[1]"


def _alpha(t: str) -> str:
    return f"length(regexp_replace({t}, '\\P{{L}}+', '', 'g')) / greatest(length({t}), 1)::DOUBLE"


def _punct(t: str) -> str:
    marks = f"(length({t}) - length(translate({t}, '.!?,;:', '')))"
    share = f"({marks} / greatest(length({t}), 1)::DOUBLE)"
    return f"greatest(0::DOUBLE, least(1::DOUBLE, 1::DOUBLE - abs({share} - 0.05::DOUBLE) * 10::DOUBLE))"


def _bigrams(w: str) -> str:
    pairs = f"list_transform(list_zip({w}[:-2], {w}[2:]), lambda p: p[1] || ' ' || p[2])"
    return (
        f"CASE WHEN len({w}) > 1 THEN len(list_distinct({pairs})) / (len({w}) - 1)::DOUBLE "
        "ELSE 1::DOUBLE END"
    )


def _scores(text: str) -> str:
    """CTE ``s``: doc_id, words ``w`` and the quality parts of ``text`` per document."""
    return f"""
t AS (SELECT doc_id, text, source, lang, {text} AS x FROM documents),
u AS (SELECT *, {_words('x')} AS w FROM t),
s AS (SELECT *, {_alpha('x')} AS alpha_ratio, {_punct('x')} AS punct_score,
             {_bigrams('w')} AS bigram_unique_ratio FROM u),
q AS (SELECT *, CASE WHEN len(w) = 0 THEN 0::DOUBLE ELSE {_round(
    'alpha_ratio * 0.5::DOUBLE + punct_score * 0.2::DOUBLE + bigram_unique_ratio * 0.3::DOUBLE', 4
)} END AS quality_score FROM s)"""


def _toxic(text: str, words) -> str:
    edge = r"[^\p{L}\p{N}_]"
    return f"regexp_matches({text}, '(?i)(^|{edge})({'|'.join(words)})($|{edge})')"


DEFAULT_WORDS = ("kill", "murder", "rape", "terrorist", "bomb", "suicide")


def _tagged(quality: float, words) -> str:
    return f"""{_scores("' ' || text")},
tagged AS (SELECT *, CASE
  WHEN len({_words('text')}) < 20 THEN 'too_short'
  WHEN len(w) * 1.3::DOUBLE > 2048 THEN 'too_long'
  WHEN quality_score < {quality}::DOUBLE THEN 'low_quality'
  WHEN {_toxic('x', words)} THEN 'toxic' END AS drop_reason FROM q)"""


_NORM = f"trim(regexp_replace(lower(text), '{_SPACE}+', ' ', 'g'))"

# --- text and filters ----------------------------------------------------------------------------

ORACLES["word_stats"] = f"""
SELECT doc_id, len({_words('text')}) AS words, len({_words('text')}) * 1.3::DOUBLE AS approx_tokens,
       length(text) AS characters FROM documents"""
ORACLES["quality_parts"] = f"""
WITH {_scores('text')} SELECT doc_id, alpha_ratio, punct_score, bigram_unique_ratio FROM q"""
ORACLES["quality_score"] = f"WITH {_scores('text')} SELECT doc_id, quality_score FROM q"
ORACLES["toxic_flag"] = f"""
SELECT doc_id, {_toxic('text', DATA_BLOCKLIST)} AS flagged,
       {_toxic('text', DEFAULT_WORDS)} AS flagged_by_default FROM documents"""
ORACLES["normalized_text"] = f"SELECT doc_id, {_NORM} AS normalized FROM documents"

_GRAMS = f"""
n AS (SELECT doc_id, source, {_NORM} AS norm FROM documents),
c AS (SELECT doc_id, string_split(norm, '') AS c FROM n),
z AS (SELECT doc_id, unnest(list_zip(c, c[2:], c[3:], c[4:], c[5:])) AS z FROM c),
g AS (SELECT DISTINCT doc_id, z[1] || z[2] || z[3] || z[4] || z[5] AS gram FROM z
      WHERE z[5] IS NOT NULL AND z[5] <> '')"""
ORACLES["shingle_counts"] = f"""
WITH {_GRAMS}
SELECT n.doc_id, count(gram) AS shingles FROM n LEFT JOIN g USING (doc_id) GROUP BY n.doc_id"""

ORACLES["drop_reasons"] = f"""
WITH {_tagged(0.7, DEFAULT_WORDS)}
SELECT coalesce(drop_reason, 'kept') AS drop_reason, count(*) AS n FROM tagged GROUP BY 1"""
ORACLES["drop_reason_rows"] = f"""
WITH {_tagged(0.5, DATA_BLOCKLIST)} SELECT doc_id AS log_id, drop_reason FROM tagged"""
ORACLES["drop_rate"] = f"""
WITH {_tagged(0.7, DEFAULT_WORDS)}
SELECT count(*) AS total, count(*) - count(drop_reason) AS kept, count(drop_reason) AS dropped,
       count(drop_reason) / count(*)::DOUBLE * 100::DOUBLE AS drop_rate_pct FROM tagged"""
ORACLES["label_agreement"] = f"""
WITH {_tagged(0.7, DEFAULT_WORDS)}
SELECT quality, toxic, coalesce(drop_reason, 'kept') AS drop_reason, count(*) AS n
FROM tagged JOIN labels USING (doc_id) GROUP BY 1, 2, 3"""

# --- redaction -----------------------------------------------------------------------------------

_EDGE = r"[^\p{L}\p{N}_]"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_CARD = "[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{1,7}|3[0-9]{3}[- ]?[0-9]{6}[- ]?[0-9]{4,5}"
_IBAN = "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"


def _bounded(text: str, pattern: str, name: str, before: str = _EDGE) -> str:
    """Replace between non-word characters; twice, as neighbours share a separator."""
    for _ in range(2):
        text = (
            f"regexp_replace({text}, '(^|{before})(?:{pattern})($|{_EDGE})', '\\1[{name}]\\2', 'g')"
        )
    return text


_DIGITS = "list_reverse(list_transform(string_split(regexp_replace(h, '[ -]', '', 'g'), ''), lambda d: d::INTEGER))"
_LUHN = f"""(list_sum(list_transform({_DIGITS}, lambda d, i:
  CASE WHEN i % 2 = 1 THEN d WHEN d > 4 THEN d * 2 - 9 ELSE d * 2 END)) % 10 = 0)"""
_TURNED = "(substr(replace(h, ' ', ''), 5) || substr(replace(h, ' ', ''), 1, 4))"
_MOD97 = f"""(list_reduce(list_prepend(0::BIGINT, list_transform(string_split({_TURNED}, ''), lambda ch:
  (CASE WHEN ch BETWEEN 'A' AND 'Z' THEN ascii(ch) - 55 ELSE ascii(ch) - 48 END)::BIGINT)),
  lambda a, b: (CASE WHEN b > 9 THEN a * 100 + b ELSE a * 10 + b END) % 97) = 1)"""


def _checked(text: str, pattern: str, check: str, name: str) -> str:
    hits = f"list_distinct(regexp_extract_all({text}, '(?:^|{_EDGE})({pattern})\\b', 1))"
    good = f"list_filter({hits}, lambda h: {check})"
    return (
        f"list_reduce(list_prepend({text}, {good}), lambda acc, h: replace(acc, h, '[{name}]'))"
    )


_EMAIL = r"regexp_replace(text, '[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}', '[EMAIL_ADDRESS]', 'g')"
_URL = (
    f"regexp_replace(x, '(^|{_EDGE})(?:https?://|www\\.)[^\\s<>\"'']+', '\\1[URL]', 'g')"
)
_IP = rf"(?:{_OCTET}\.){{3}}{_OCTET}"
_PHONE = (
    r"(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}"
    r"|\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,4}"
)
_SSN = "[0-9]{3}-[0-9]{2}-[0-9]{4}"


def _redacted(source: str) -> str:
    return f"""
r1 AS (SELECT *, {_EMAIL} AS x1 FROM {source}),
r2 AS (SELECT *, {_URL.replace('(x,', '(x1,')} AS x2 FROM r1),
r3 AS (SELECT *, {_checked('x2', _CARD, _LUHN, 'CREDIT_CARD')} AS x3 FROM r2),
r4 AS (SELECT *, {_checked('x3', _IBAN, _MOD97, 'IBAN_CODE')} AS x4 FROM r3),
r5 AS (SELECT *, {_bounded('x4', _IP, 'IP_ADDRESS')} AS x5 FROM r4),
r6 AS (SELECT *, {_bounded('x5', _SSN, 'US_SSN')} AS x6 FROM r5),
r7 AS (SELECT *, {_bounded('x6', _PHONE, 'PHONE_NUMBER', '[^\\p{L}\\p{N}_+]')} AS redacted FROM r6)"""


ORACLES["redact"] = f"WITH {_redacted('documents')} SELECT doc_id, redacted FROM r7"
ORACLES["redact_recognised"] = """
SELECT doc_id, regexp_replace(text, '[0-9]+', '[NUMBER]', 'g') AS redacted FROM documents"""
ORACLES["filtered_logs"] = f"""
WITH {_tagged(0.7, DEFAULT_WORDS)},
kept AS (SELECT doc_id, text FROM tagged WHERE drop_reason IS NULL), {_redacted('kept')}
SELECT doc_id AS log_id, redacted AS response FROM r7"""

# --- near-duplicates -----------------------------------------------------------------------------

# The bands of the common LSH index at threshold 0.85 and 128 permutations.
_BANDS, _ROWS = 8, 16


def _drawn(count: int) -> list[tuple[int, int]]:
    """Multiplier and offset of each permutation, as the public scheme draws them with seed 1."""
    draw = np.random.RandomState(1)
    return [tuple(int(draw.randint(low, 2**61 - 1, dtype=np.uint64)) for low in (1, 0)) for _ in range(count)]


def _signatures(grams: str) -> str:
    """CTE ``sig``: the signature list of every document, from ``n`` (all rows) and ``g`` (grams)."""
    hashed = ", ".join(
        f"((({a}::HUGEINT * h + {b}) % 18446744073709551616) "
        f"% 2305843009213693951 & 4294967295)::BIGINT AS p{i}"
        for i, (a, b) in enumerate(_drawn(128))
    )
    least = ", ".join(f"coalesce(min(p{i}), 4294967295)" for i in range(128))
    digits = "substr(sha1(gram), 7, 2) || substr(sha1(gram), 5, 2) || substr(sha1(gram), 3, 2) || substr(sha1(gram), 1, 2)"
    return f"""{grams},
v AS (SELECT gram, ('0x' || {digits})::HUGEINT AS h FROM (SELECT DISTINCT gram FROM g)),
p AS (SELECT gram, {hashed} FROM v),
sig AS (SELECT n.doc_id, [{least}] AS sig FROM n LEFT JOIN g USING (doc_id) LEFT JOIN p USING (gram)
        GROUP BY n.doc_id),
bands AS (SELECT doc_id, k AS band, sig[k * {_ROWS} + 1 : (k + 1) * {_ROWS}] AS key
          FROM sig, range({_BANDS}) AS r(k))"""


def _walk(edges: str) -> str:
    """CTE ``kept``: one document after the other, kept unless an earlier kept one is a neighbour."""
    return f"""{edges},
nodes AS MATERIALIZED (SELECT id, list(earlier) AS earlier, row_number() OVER (ORDER BY id) AS rn
          FROM edges GROUP BY id),
walk AS (
  SELECT 0::BIGINT AS rn, []::BIGINT[] AS dropped
  UNION ALL
  SELECT w.rn + 1, CASE WHEN len(list_filter(n.earlier, lambda e: NOT list_contains(w.dropped, e))) > 0
                        THEN list_append(w.dropped, n.id) ELSE w.dropped END
  FROM walk w JOIN nodes n ON n.rn = w.rn + 1),
fallen AS (SELECT unnest(dropped) AS id FROM walk WHERE rn = (SELECT max(rn) FROM walk)),
kept AS (SELECT doc_id, source FROM n WHERE doc_id NOT IN (SELECT id FROM fallen))"""


_LSH_EDGES = """edges AS (SELECT DISTINCT b.doc_id AS id, a.doc_id AS earlier
          FROM bands a JOIN bands b ON a.band = b.band AND a.key = b.key AND a.doc_id < b.doc_id)"""
_OVERLAP = """sets AS (SELECT doc_id, list(gram) AS grams FROM g GROUP BY doc_id)"""

ORACLES["minhash_signature"] = f"""
WITH {_signatures(_GRAMS)}
SELECT doc_id, array_to_string(sig, ',') AS signature FROM sig"""
ORACLES["lsh_buckets"] = f"""
WITH {_signatures(_GRAMS)},
sizes AS (SELECT band, key, count(*) AS members FROM bands GROUP BY band, key)
SELECT band, members, count(*) AS buckets FROM sizes GROUP BY band, members"""
ORACLES["exact_dups"] = f"""
SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY {_NORM}"""
ORACLES["near_dups"] = f"""
WITH RECURSIVE {_signatures(_GRAMS)}, {_walk(_LSH_EDGES)} SELECT doc_id, source FROM kept"""
ORACLES["near_dup_matches"] = f"""
WITH RECURSIVE {_signatures(_GRAMS)}, {_walk(_LSH_EDGES)}, {_OVERLAP},
pairs AS (SELECT id, earlier FROM edges WHERE earlier IN (SELECT doc_id FROM kept))
SELECT id AS dropped_id, earlier AS kept_id,
       CASE WHEN a.grams IS NULL AND b.grams IS NULL THEN 1::DOUBLE
            ELSE len(list_intersect(a.grams, b.grams))
                 / len(list_distinct(list_concat(a.grams, b.grams)))::DOUBLE END AS jaccard
FROM pairs LEFT JOIN sets a ON a.doc_id = id LEFT JOIN sets b ON b.doc_id = earlier"""
ORACLES["near_dups_verified"] = f"""
WITH RECURSIVE {_GRAMS},
v AS MATERIALIZED (SELECT gram, row_number() OVER (ORDER BY count(*), gram)::INTEGER AS gid
     FROM g GROUP BY gram),
ids AS MATERIALIZED (SELECT doc_id, gid, count(*) OVER (PARTITION BY doc_id) AS size,
     row_number() OVER (PARTITION BY doc_id ORDER BY gid) AS rn FROM g JOIN v USING (gram)),
rare AS MATERIALIZED (SELECT * FROM ids WHERE rn <= size - ceil(0.85 * size) + 1),
sets AS MATERIALIZED (SELECT doc_id, list(gid) AS grams, count(*) AS size FROM ids GROUP BY doc_id),
close AS MATERIALIZED (SELECT DISTINCT a.doc_id AS earlier, b.doc_id AS id
     FROM rare a JOIN rare b ON a.gid = b.gid AND a.doc_id < b.doc_id
      AND least(a.size, b.size) >= 0.85 * greatest(a.size, b.size)),
blank AS (SELECT doc_id FROM n WHERE doc_id NOT IN (SELECT doc_id FROM sets)),
common AS MATERIALIZED (SELECT id, earlier, a.size AS s, b.size AS t,
     len(list_intersect(a.grams, b.grams)) AS same
     FROM close JOIN sets a ON a.doc_id = id JOIN sets b ON b.doc_id = earlier),
edges AS (SELECT id, earlier FROM common WHERE same / (s + t - same)::DOUBLE > 0.85
          UNION ALL SELECT b.doc_id, a.doc_id FROM blank a JOIN blank b ON a.doc_id < b.doc_id),
{_walk('unused AS (SELECT 1)')} SELECT doc_id, source FROM kept"""


def _log_grams(source: str) -> str:
    """Grams of kept logs, whose sample text starts with the blank after an empty prompt."""
    return _GRAMS.replace("FROM documents", f"FROM {source}")


ORACLES["curation_funnel"] = f"""
WITH RECURSIVE {_tagged(0.7, DEFAULT_WORDS)},
survivors AS (SELECT doc_id, text, source FROM tagged WHERE drop_reason IS NULL),
{_signatures(_log_grams('survivors'))}, {_walk(_LSH_EDGES)}
SELECT 'completed' AS status, NULL::VARCHAR AS reason,
       (SELECT count(*) FROM documents) AS logs_pulled,
       (SELECT count(*) FROM survivors) AS samples_after_filter,
       (SELECT count(*) FROM kept) AS samples_after_dedup"""


def _curated(edges: str = _LSH_EDGES, undo: str = "", more: str = "") -> str:
    """Filter, redact, then deduplicate the redacted text. ``undo`` turns the ids of edges into document ids."""
    walk = _walk(edges).replace("unnest(dropped) AS id", f"unnest(dropped){undo} AS id")
    return f"""
WITH RECURSIVE {_tagged(0.7, DEFAULT_WORDS)},
survivors AS (SELECT doc_id, text, source FROM tagged WHERE drop_reason IS NULL),
{_redacted('survivors')},
clean AS (SELECT doc_id, redacted AS text, source FROM r7),
{_signatures(_log_grams('clean'))}, {walk}
SELECT doc_id AS log_id, text AS response{more} FROM clean
WHERE doc_id IN (SELECT doc_id FROM kept)"""


ORACLES["curated_samples"] = _curated()
ORACLES["incremental_curation"] = _curated()
_BATCH = ", (doc_id % 4)::INTEGER AS batch_id"
ORACLES["curation_in_batches"] = _curated(
    _LSH_EDGES.replace("a.doc_id < b.doc_id", "a.doc_id < b.doc_id AND a.doc_id % 4 = b.doc_id % 4"), "", _BATCH
)
# Batches in turn: ids are led by the number of their batch.
_IN_TURN = "({0}.doc_id % 4) * 1000000000000 + {0}.doc_id"
ORACLES["curation_across_batches"] = _curated(
    _LSH_EDGES.replace("a.doc_id < b.doc_id", f"{_IN_TURN.format('a')} < {_IN_TURN.format('b')}")
    .replace("b.doc_id AS id", f"{_IN_TURN.format('b')} AS id")
    .replace("a.doc_id AS earlier", f"{_IN_TURN.format('a')} AS earlier"),
    " % 1000000000000",
    _BATCH,
)
ORACLES["capped_samples"] = f"SELECT * FROM ({_curated()}) ORDER BY log_id LIMIT 100"

# --- logs and datasets ---------------------------------------------------------------------------

_LOGS = """
logs AS (
  SELECT printf('%08d-%04d', u.conv_id, u.turn) AS log_id, u.conv_id, u.text AS prompt,
         a.text AS response, 'llama-3.1-8b' AS model
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'),
waiting AS (SELECT * FROM logs WHERE conv_id NOT IN
            (SELECT conv_id FROM conversations WHERE role = 'system'))"""
ORACLES["log_pairs"] = f"WITH {_LOGS} SELECT log_id, prompt, response FROM logs"
ORACLES["unconsumed"] = f"""
WITH {_LOGS} SELECT log_id, prompt, response, model, length(response)::INTEGER AS latency_ms,
conv_id::VARCHAR AS session_id FROM waiting"""
ORACLES["oldest_unconsumed"] = f"""
WITH {_LOGS} SELECT log_id, length(response)::INTEGER AS latency_ms FROM waiting
ORDER BY conv_id, log_id LIMIT 100"""
ORACLES["readiness"] = f"""
WITH {_LOGS} SELECT CASE WHEN count(*) < 200 THEN 'skipped' ELSE 'started' END AS status,
CASE WHEN count(*) < 200 THEN 'insufficient_logs' END AS reason, count(*) AS new_logs,
200::BIGINT AS min_required FROM waiting"""
ORACLES["unconsumed_after_pulls"] = f"""
WITH {_LOGS} SELECT log_id, response FROM logs
WHERE conv_id % 4 = 3 OR (conv_id % 4 = 2 AND length(response) >= 200)"""
ORACLES["ledger_round_trip"] = f"""
WITH {_LOGS} SELECT 'run-1' AS run_id, count(*) AS consumed FROM waiting
UNION ALL SELECT 'waiting', 0"""
ORACLES["dataset_round_trip"] = f"""
WITH {_LOGS} SELECT 'ds-1' AS dataset_id, row_number() OVER (ORDER BY conv_id, log_id) AS seq,
log_id, prompt, response FROM logs"""
ORACLES["chat_export"] = f"""
WITH {_LOGS} SELECT '{{"messages":[{{"role":"user","content":' || to_json(prompt)::VARCHAR
|| '}},{{"role":"assistant","content":' || to_json(response)::VARCHAR || '}}]}}' AS line FROM logs"""
ORACLES["sft_text"] = f"""
WITH {_LOGS} SELECT log_id, '### User:' || chr(10) || prompt || chr(10) || chr(10)
|| '### Assistant:' || chr(10) || response || '</s>' AS text FROM logs"""
ORACLES["judge_prompts"] = f"""
WITH {_LOGS} SELECT log_id, 'Prompt: ' || prompt || chr(10) || chr(10) || 'Reference response: '
|| response || chr(10) || chr(10) || 'Candidate response: ' || upper(model) || chr(10) || chr(10)
|| 'Score the Candidate response.' AS judge_prompt FROM logs"""

# --- experiments ---------------------------------------------------------------------------------

_OFFER = " UNION ALL ".join(
    f"SELECT '{c.id}' AS model_id, '{c.model}' AS model_name, '{c.hf_model}' AS hf_model, "
    f"'{kind}' AS experiment_type"
    for c in CANDIDATES
    for kind in c.experiments
)
_PLANNED = f"""
ds AS (SELECT DISTINCT source AS dataset_id, 'run-' || source AS run_id FROM documents),
offer AS ({_OFFER}),
planned AS (SELECT substr(sha256(concat_ws('|', run_id, model_id, experiment_type)), 1, 32) AS experiment_id,
  run_id, model_id, model_name, hf_model, experiment_type,
  CASE experiment_type WHEN 'icl' THEN 'pending_eval' ELSE 'training' END AS status, dataset_id
  FROM ds, offer)"""
ORACLES["plan_experiments"] = f"WITH {_PLANNED} SELECT * FROM planned"
ORACLES["plan_remaining"] = f"""
WITH {_PLANNED},
done AS (SELECT DISTINCT 'run-' || source AS run_id FROM documents WHERE lang = 'fr')
SELECT run_id, experiment_id FROM planned WHERE NOT (
  model_id = 'qwen-0.5b' AND experiment_type = 'lora_sft' AND run_id IN (SELECT run_id FROM done))
UNION SELECT run_id, 'old-' || run_id FROM done"""
ORACLES["experiment_samples"] = f"""
WITH {_PLANNED} SELECT experiment_id, model_name, doc_id AS log_id
FROM planned JOIN documents ON source = dataset_id WHERE status = 'pending_eval'"""
ORACLES["paired_responses"] = """
WITH e AS (SELECT printf('e%012d', event_id) AS experiment_id, strftime(ts, '%Y%m%d%H%M') AS sample_id,
                  event_type = 'purchase' AS teaches, props FROM events),
t AS (SELECT sample_id, arg_min(props, experiment_id) AS reference FROM e WHERE teaches GROUP BY 1)
SELECT experiment_id, sample_id, props AS candidate, reference
FROM e JOIN t USING (sample_id) WHERE NOT teaches"""
ORACLES["model_responses"] = f"""
WITH {_LOGS} SELECT 'exp-1' AS experiment_id, log_id AS sample_id, model AS model_name,
'candidate' AS role, replace(prompt, ' ', '_') AS response, length(prompt)::DOUBLE AS latency_ms,
length(model)::INTEGER AS input_tokens,
(length(prompt) - length(replace(prompt, ' ', '')))::INTEGER AS output_tokens FROM logs"""
ORACLES["model_verdicts"] = f"""
WITH {_LOGS}, j AS (SELECT log_id, length('Prompt: ' || prompt || 'xx' || 'Reference response: '
|| response || 'xx' || 'Candidate response: ' || prompt || 'xx' || 'Score the Candidate response.') AS size
FROM logs)
SELECT 'exp-1' AS experiment_id, log_id AS sample_id, (1 + size % 5)::INTEGER AS score,
'attempt ' || (1 + size % 2) AS reason FROM j"""

_BATCHED = f"""{_LOGS},
asked AS (SELECT 'exp-' || conv_id % 3 AS experiment_id, log_id AS sample_id, 'model-' || conv_id % 3 AS model_name,
  conv_id % 3 = 2 AS gone, length(prompt) % 10 = 7 AS odd, prompt, response FROM logs),
answered AS (SELECT experiment_id, sample_id, model_name, 'candidate' AS role,
  CASE WHEN NOT gone AND NOT odd THEN replace(prompt, ' ', '_') END AS response,
  CASE WHEN NOT gone AND NOT odd THEN length(prompt)::DOUBLE END AS latency_ms,
  CASE WHEN NOT gone AND NOT odd THEN length(model_name)::INTEGER END AS input_tokens,
  CASE WHEN NOT gone AND NOT odd THEN (length(prompt) - length(replace(prompt, ' ', '')))::INTEGER END AS output_tokens,
  CASE WHEN gone THEN 'ConnectionError: out of reach' WHEN odd THEN 'ValueError: odd prompt' END AS error FROM asked)"""
ORACLES["batch_responses"] = f"WITH {_BATCHED} SELECT * FROM answered"
ORACLES["failed_experiments"] = f"""
WITH {_BATCHED} SELECT experiment_id, count(*) AS failed, min(error) AS error FROM answered
WHERE error IS NOT NULL GROUP BY 1"""
ORACLES["batch_verdicts"] = f"""
WITH {_BATCHED}, j AS (SELECT *, length('Prompt: ' || prompt || 'xx' || 'Reference response: '
|| response || 'xx' || 'Candidate response: ' || prompt || 'xx' || 'Score the Candidate response.') AS size FROM asked)
SELECT experiment_id, sample_id, (1 + size % 5)::INTEGER AS score FROM j"""

# --- evaluation ----------------------------------------------------------------------------------


def _case(key: str, entries: dict, item: int) -> str:
    arms = " ".join(f"WHEN '{name}' THEN '{values[item]}'" for name, values in entries.items())
    return f"CASE {key} {arms} END"


_EVENTS = f"""
e AS (SELECT *, (props::JSON->>'$.k')::INTEGER AS k, 'run-' || user_id AS run_id,
             'exp-' || user_id || '-' || event_type AS experiment_id,
             {_case('event_type', EVENT_MODELS, 0)} AS model_id,
             {_case('event_type', EVENT_MODELS, 1)} AS model_name,
             {_case('event_type', EVENT_MODELS, 2)} AS experiment_type,
             event_id % 100 AS output_tokens FROM events),
exps AS (SELECT experiment_id, run_id, model_id, model_name, experiment_type, min(event_id) AS seq,
                min(ts) AS created_at FROM e GROUP BY ALL)""".replace(
    "min(ts) AS created_at FROM e GROUP BY ALL", "min(ts) AS created_at FROM e GROUP BY 1, 2, 3, 4, 5"
)
_PRICES = ", ".join(f"('{m}', {i}::DOUBLE, {o}::DOUBLE)" for m, i, o in PRICING)


def _latency(source: str, keys: str) -> str:
    picks = ", ".join(
        f"{_round(f'l[least(floor({p}::DOUBLE * len(l))::BIGINT, len(l) - 1) + 1]', 2)} AS {name}"
        for p, name in ((0.5, "p50_ms"), (0.95, "p95_ms"), (0.99, "p99_ms"))
    )
    return f"""(SELECT {keys}, {picks}, {_round('m', 2)} AS mean_ms FROM (
  SELECT {keys}, list(value ORDER BY value) AS l, avg(value) AS m FROM {source} GROUP BY {keys}))"""


def _cost(source: str, keys: str) -> str:
    total = (
        f"(i / 1000000::DOUBLE * coalesce(input, {DEFAULT_PRICE}::DOUBLE)"
        f" + o / 1000000::DOUBLE * coalesce(output, {DEFAULT_PRICE}::DOUBLE))"
    )
    per_1k = f"CASE WHEN i + o = 0 THEN 0::DOUBLE ELSE {total} / (i + o) * 1000 END"
    return f"""(SELECT {keys}, i::BIGINT AS total_input_tokens, o::BIGINT AS total_output_tokens,
  {_round(per_1k, 6)} AS cost_per_1k_tokens_usd, {_round(total, 6)} AS total_cost_usd
  FROM (SELECT {keys}, sum(k)::BIGINT AS i, sum(output_tokens)::BIGINT AS o FROM {source} GROUP BY {keys})
  LEFT JOIN (VALUES {_PRICES}) AS prices(model_name, input, output) USING (model_name))"""


_VERDICTS = """
raws AS (SELECT experiment_id, event_id::VARCHAR AS sample_id, attempt, k,
                (k + 3 * (attempt - 1)) % 10 AS shape
         FROM e, (VALUES (1), (2), (3)) AS a(attempt)),
raw AS (SELECT *, CASE shape
  WHEN 0 THEN 'not valid json at all'
  WHEN 1 THEN '{"score": 99, "reason": "off the scale"}'
  WHEN 2 THEN '{"score": "4", "reason": "text"}'
  WHEN 3 THEN '{"score": 4.7}'
  WHEN 4 THEN '{"score": "4.5", "reason": "not an integer"}'
  WHEN 5 THEN '{"score": null}'
  WHEN 6 THEN '[1]'
  WHEN 7 THEN '{"score": 3} trailing'
  WHEN 8 THEN '{"score": true, "reason": "boolean"}'
  ELSE '{"score": ' || (k // 20 + 1) || ', "reason": "r' || k || '"}' END AS raw FROM raws),
kinds AS (SELECT *, CASE WHEN json_valid(raw) THEN raw END AS doc,
                 CASE WHEN json_valid(raw) THEN json_type(raw, '$.score') END AS kind FROM raw),
parsed AS (SELECT *, (CASE
    WHEN kind IN ('UBIGINT', 'BIGINT', 'DOUBLE')
      THEN greatest(1, least(5, trunc((doc->>'$.score')::DOUBLE)))
    WHEN kind = 'VARCHAR' AND regexp_full_match(doc->>'$.score', '\\s*[+-]?[0-9]+\\s*')
      THEN greatest(1, least(5, (doc->>'$.score')::DOUBLE))
    WHEN kind = 'BOOLEAN' THEN 1 END)::INTEGER AS score FROM kinds),
read AS (SELECT *, CASE WHEN score IS NOT NULL THEN
    CASE WHEN json_type(doc, '$.reason') IS NULL THEN '' ELSE doc->>'$.reason' END END AS reason
  FROM parsed),
firsts AS (SELECT experiment_id, sample_id,
    coalesce(arg_min(score, attempt) FILTER (score IS NOT NULL), 1) AS score,
    CASE WHEN count(score) = 0 THEN 'parse_error'
         ELSE arg_min(reason, attempt) FILTER (score IS NOT NULL) END AS reason
  FROM read GROUP BY 1, 2)"""
_JUDGED = f"""
judged AS (SELECT experiment_id, n AS sample_count, {_round('total / n', 4)} AS mean_score,
    {_round('wins / n', 4)} AS win_rate, score_1, score_2, score_3, score_4, score_5 FROM (
  SELECT experiment_id, count(*) AS n, sum(score)::DOUBLE AS total,
    count(*) FILTER (score >= 4)::DOUBLE AS wins,
    count(*) FILTER (score = 1) AS score_1, count(*) FILTER (score = 2) AS score_2,
    count(*) FILTER (score = 3) AS score_3, count(*) FILTER (score = 4) AS score_4,
    count(*) FILTER (score = 5) AS score_5 FROM firsts GROUP BY 1))"""
_EVALS = f"""{_EVENTS}, {_VERDICTS}, {_JUDGED},
evals AS (SELECT experiment_id, model_id, exps.model_name, run_id, experiment_type,
    win_rate AS accuracy, mean_score, p50_ms AS latency_p50_ms, p95_ms AS latency_p95_ms,
    p99_ms AS latency_p99_ms, cost_per_1k_tokens_usd, total_cost_usd, sample_count, seq,
    score_1, score_2, score_3, score_4, score_5
  FROM exps JOIN judged USING (experiment_id)
  JOIN {_latency('e', 'experiment_id')} USING (experiment_id)
  JOIN {_cost('e', 'experiment_id, model_name')} c USING (experiment_id))"""
_MAIN = (
    "experiment_id, model_id, model_name, run_id, experiment_type, accuracy, mean_score, "
    "latency_p50_ms, latency_p95_ms, latency_p99_ms, cost_per_1k_tokens_usd, total_cost_usd, "
    "sample_count"
)

ORACLES["latency_stats"] = f"WITH {_EVENTS} SELECT * FROM {_latency('e', 'event_type')}"
ORACLES["latency_overall"] = f"""
WITH {_EVENTS}, w AS (SELECT 'all' AS g, value FROM e) SELECT * FROM {_latency('w', 'g')}"""
ORACLES["cost_stats"] = f"WITH {_EVENTS} SELECT * FROM {_cost('e', 'event_type, model_name')}"
ORACLES["verdict_parse"] = f"""
WITH {_EVENTS}, {_VERDICTS} SELECT sample_id, attempt, score, reason FROM read"""
ORACLES["first_attempt"] = f"""
WITH {_EVENTS}, {_VERDICTS} SELECT experiment_id, sample_id, score, reason FROM firsts"""
ORACLES["judge_summary"] = f"WITH {_EVENTS}, {_VERDICTS}, {_JUDGED} SELECT * FROM judged"
ORACLES["evaluations"] = f"WITH {_EVALS} SELECT {_MAIN} FROM evals"
_BEST = """
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id
  ORDER BY accuracy DESC, cost_per_1k_tokens_usd, seq) AS place FROM evals) WHERE place = 1)"""
ORACLES["best_candidate"] = f"""
WITH {_EVALS}, {_BEST} SELECT run_id, experiment_id, accuracy,
cost_per_1k_tokens_usd AS cost_per_1k_tokens FROM best"""
_C = DATA_CRITERIA
_FAILS = {
    "accuracy": f"accuracy < {_C.min_accuracy}::DOUBLE",
    "latency": f"latency_p95_ms > {_C.max_latency_p95_ms}::DOUBLE",
    "cost": f"cost_per_1k_tokens_usd > {_C.max_cost_per_1k_tokens}::DOUBLE",
    "sample_size": f"sample_count < {_C.min_eval_sample_size}",
}
_ANY_FAIL = " OR ".join(_FAILS.values())
ORACLES["promotion_gate"] = f"""
WITH {_EVALS} SELECT experiment_id, NOT ({_ANY_FAIL}) AS passed,
CASE WHEN {_FAILS['accuracy']} THEN printf('%.3f', {_round('accuracy', 3)}) || ' < required {_C.min_accuracy}' END AS accuracy_failure,
CASE WHEN {_FAILS['latency']} THEN round_even(latency_p95_ms, 0)::BIGINT || 'ms > max {_C.max_latency_p95_ms}ms' END AS latency_failure,
CASE WHEN {_FAILS['cost']} THEN '$' || printf('%.5f', {_round('cost_per_1k_tokens_usd', 5)}) || ' > max ${_C.max_cost_per_1k_tokens}' END AS cost_failure,
CASE WHEN {_FAILS['sample_size']} THEN sample_count || ' < required {_C.min_eval_sample_size}' END AS sample_size_failure
FROM evals"""
ORACLES["pass_count"] = f"""
WITH {_EVALS} SELECT count(*) FILTER (NOT ({_FAILS['accuracy']} OR {_FAILS['latency']} OR {_FAILS['cost']})) AS passed,
count(*) AS total FROM evals"""
_NAMED = " || ".join(f"CASE WHEN {c} THEN ',{n}' ELSE '' END" for n, c in _FAILS.items())
ORACLES["promotion_decisions"] = f"""
WITH {_EVALS}, {_BEST},
g AS (SELECT *, NOT ({_ANY_FAIL}) AS passed, substr({_NAMED}, 2) AS failed FROM best)
SELECT 'run-' || c_custkey AS run_id, coalesce(passed, false) AS promoted,
  CASE WHEN passed THEN experiment_id END AS promoted_model_id,
  CASE WHEN passed THEN model_name END AS promoted_model_name,
  CASE WHEN experiment_id IS NULL THEN 'no_candidate' WHEN NOT passed THEN 'criteria_not_met' END AS reason,
  CASE WHEN NOT passed THEN failed END AS detail
FROM customer LEFT JOIN g ON g.run_id = 'run-' || c_custkey"""

# --- registry ------------------------------------------------------------------------------------

_RANKED = f"""{_EVALS},
ranked AS (SELECT *, row_number() OVER (ORDER BY accuracy DESC, experiment_id) AS place FROM evals)"""
ORACLES["registry_promote"] = f"""
WITH {_RANKED} SELECT experiment_id AS model_id, run_id,
CASE place WHEN 1 THEN 'archived' WHEN 2 THEN 'production' ELSE 'candidate' END AS status, accuracy,
'2024-02-01' AS created_at, CASE place WHEN 1 THEN '2024-02-02' WHEN 2 THEN '2024-02-03' END AS promoted_at,
CASE place WHEN 1 THEN '2024-02-03' END AS archived_at FROM ranked"""
ORACLES["registry_register"] = f"""
WITH {_RANKED} SELECT experiment_id AS model_id, run_id,
CASE WHEN accuracy < 0.5 AND place = 1 THEN 'production' ELSE 'candidate' END AS status, accuracy,
CASE WHEN accuracy >= 0.5 THEN '2024-02-03' ELSE '2024-02-01' END AS created_at,
CASE WHEN accuracy < 0.5 AND place = 1 THEN '2024-02-02' END AS promoted_at,
NULL::VARCHAR AS archived_at FROM ranked"""
ORACLES["registry_snapshot"] = f"""
WITH {_RANKED} SELECT experiment_id AS model_id, 'production' AS status, NULL::VARCHAR AS promoted_at
FROM ranked WHERE place = 1"""

ORACLES["promotion_history"] = f"""
WITH {_RANKED} SELECT experiment_id AS model_id,
CASE place WHEN 1 THEN 'archived' ELSE 'production' END AS status,
CASE place WHEN 1 THEN '2024-02-02' ELSE '2024-02-03' END AS promoted_at FROM ranked WHERE place <= 2"""
ORACLES["archived_models"] = f"""
WITH {_RANKED} SELECT experiment_id AS model_id, 'archived' AS status,
CASE place WHEN 1 THEN '2024-02-03' ELSE '2024-02-04' END AS archived_at FROM ranked WHERE place <= 2"""
ORACLES["recently_promoted"] = f"""
WITH {_RANKED} SELECT experiment_id AS model_id,
CASE place WHEN 1 THEN 'archived' WHEN 2 THEN 'production' ELSE 'candidate' END AS status,
CASE place WHEN 1 THEN '2024-02-02' WHEN 2 THEN '2024-02-03' END AS promoted_at
FROM ranked ORDER BY promoted_at DESC NULLS LAST, model_id LIMIT 100"""
ORACLES["promotion_metric_log"] = f"""
WITH {_EVALS}, {_BEST}, won AS (SELECT * FROM best WHERE NOT ({_ANY_FAIL})) """ + " UNION ALL ".join(
    f"SELECT 'promotion-' || model_id AS run_name, run_id, '{key}' AS key, {column} AS value FROM won"
    for key, column in (
        ("accuracy", "accuracy"), ("latency_p95_ms", "latency_p95_ms"),
        ("cost_per_1k_tokens", "cost_per_1k_tokens_usd"),
    )
)
ORACLES["completed_experiments"] = f"""
WITH {_EVALS} SELECT experiment_id, evals.run_id, 'completed' AS status, created_at, accuracy, latency_p95_ms
FROM evals JOIN exps USING (experiment_id) WHERE sample_count >= 10"""

# --- runs and reports ----------------------------------------------------------------------------

_STAGES = f"""
staged AS (SELECT *, {_case('event_type', EVENT_STAGES, 0)} AS stage,
    coalesce({_case('event_type', EVENT_STAGES, 1)}, 'failed') AS run_status,
    CASE WHEN k >= 30 THEN 'completed' WHEN k >= 15 THEN 'skipped' ELSE 'running' END AS outcome FROM e),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, stage
    ORDER BY ts DESC, event_id DESC) AS place FROM staged WHERE stage IS NOT NULL) WHERE place = 1),
lastrow AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id
    ORDER BY ts DESC, event_id DESC) AS place, min(ts) OVER (PARTITION BY run_id) AS started_at
    FROM staged) WHERE place = 1),
runs AS (SELECT l.run_id, l.run_status AS status, l.started_at, l.ts AS updated_at,
    CASE WHEN l.event_type = 'error' THEN 'failed event' END AS error,
    c.outcome AS curation_status, f.outcome AS finetuning_status, v.outcome AS evaluation_status,
    p.outcome AS promotion_status, c.k AS ck, c.event_id AS cid
  FROM lastrow l
  LEFT JOIN latest c ON c.run_id = l.run_id AND c.stage = 'curation'
  LEFT JOIN latest f ON f.run_id = l.run_id AND f.stage = 'finetuning'
  LEFT JOIN latest v ON v.run_id = l.run_id AND v.stage = 'evaluation'
  LEFT JOIN latest p ON p.run_id = l.run_id AND p.stage = 'promotion')"""
_RUNS = f"{_EVENTS}, {_STAGES}"
ORACLES["run_fold"] = f"""
WITH {_RUNS} SELECT run_id, status, started_at, updated_at, error, curation_status, finetuning_status,
evaluation_status, promotion_status, (ck * 10)::BIGINT AS logs_pulled FROM runs"""
ORACLES["resume_point"] = f"""
WITH {_RUNS}, points AS (SELECT *, CASE
  WHEN curation_status IS DISTINCT FROM 'completed' THEN 'curation'
  WHEN coalesce(finetuning_status, '') NOT IN ('completed', 'skipped') THEN 'finetuning'
  WHEN coalesce(evaluation_status, '') NOT IN ('completed', 'skipped') THEN 'evaluation'
  ELSE 'promotion' END AS resume_from FROM runs)
SELECT points.run_id, resume_from, outcome AS carried_status,
  CASE WHEN k >= 30 THEN 'dataset-' || event_id END AS dataset_id
FROM points LEFT JOIN latest ON latest.run_id = points.run_id AND latest.stage =
  CASE resume_from WHEN 'finetuning' THEN 'curation' WHEN 'evaluation' THEN 'finetuning'
                   WHEN 'promotion' THEN 'evaluation' END"""
ORACLES["stage_skips"] = f"""
WITH {_RUNS} SELECT run_id,
CASE WHEN ck IS NULL OR ck < 30 THEN 'no_dataset_from_curation' END AS finetuning_skip,
CASE WHEN run_id NOT IN (SELECT run_id FROM exps WHERE experiment_type = 'lora_sft')
  THEN 'no_experiments_from_finetuning' END AS evaluation_skip FROM runs"""
_CYCLES = f"""{_RUNS},
cycles AS (SELECT run_id, started_at, row_number() OVER (ORDER BY started_at, run_id) AS cycle FROM runs)"""
ORACLES["cycle_number"] = f"WITH {_CYCLES} SELECT run_id, started_at, cycle FROM cycles"
ORACLES["funnel_by_cycle"] = f"""
WITH {_RUNS}, done AS (SELECT *, row_number() OVER (ORDER BY started_at, run_id) AS cycle FROM runs
WHERE status = 'completed')
SELECT cycle, (ck * 10)::BIGINT AS logs_pulled, (ck * 7)::BIGINT AS after_filter,
(ck * 5)::BIGINT AS after_dedup FROM done WHERE curation_status = 'completed'"""
ORACLES["accuracy_by_cycle"] = f"""
WITH {_EVALS}, {_STAGES}, cycles AS (SELECT run_id, row_number() OVER (ORDER BY started_at, run_id) AS cycle FROM runs)
SELECT cycle, round(avg(accuracy), 6) AS accuracy FROM evals JOIN cycles USING (run_id) GROUP BY 1"""
ORACLES["cost_by_cycle"] = f"""
WITH {_EVALS}, {_STAGES}, cycles AS (SELECT run_id, row_number() OVER (ORDER BY started_at, run_id) AS cycle FROM runs)
SELECT cycle, round(avg(cost_per_1k_tokens_usd), 9) AS cost FROM evals JOIN cycles USING (run_id) GROUP BY 1"""
ORACLES["list_runs"] = f"""
WITH {_RUNS} SELECT run_id, started_at FROM runs WHERE status = 'failed'
ORDER BY started_at DESC, run_id LIMIT 20"""
ORACLES["list_experiments"] = f"""
WITH {_EVENTS} SELECT experiment_id, created_at FROM exps ORDER BY created_at DESC, experiment_id LIMIT 50"""
ORACLES["evaluable_chosen"] = f"""
WITH {_EVENTS} SELECT experiment_id, run_id FROM exps WHERE experiment_type = 'lora_sft'"""
ORACLES["run_fold_incremental"] = ORACLES["run_fold"]
ORACLES["guarded_runs"] = f"""
WITH {_EVENTS}, r AS (SELECT run_id, coalesce({_case('event_type', EVENT_STAGES, 1)}, 'failed') AS status,
  (event_id % 3)::INTEGER AS attempt, ts, event_id FROM e),
p AS (SELECT *, CASE status WHEN 'curating' THEN 1 WHEN 'training' THEN 2 WHEN 'evaluating' THEN 3 ELSE 5 END AS far FROM r),
w AS (SELECT run_id, arg_max({{'status': status, 'attempt': attempt, 'ts': ts, 'event_id': event_id}},
  (attempt, far, ts, event_id)) AS w FROM p GROUP BY run_id),
n AS (SELECT run_id, w['status'] AS status, w['attempt'] AS attempt, w['ts'] AS ts, w['event_id'] AS event_id FROM w)
SELECT n.run_id, n.status, n.attempt, n.ts AS updated_at,
  count(*) FILTER ((p.ts, p.event_id) > (n.ts, n.event_id)) AS ignored
FROM n JOIN p USING (run_id) GROUP BY n.run_id, n.status, n.attempt, n.ts"""
ORACLES["iso_stamps"] = """
SELECT event_id, CASE event_id % 5
  WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00'
  WHEN 1 THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '.250000+00:00'
  WHEN 2 THEN strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S') || '+00:00'
  WHEN 3 THEN strftime(ts, '%Y-%m-%d') || 'T00:00:00+00:00' END AS stamp FROM events"""
ORACLES["registered_runs"] = """
SELECT 'run-' || user_id AS run_id, 'pending' AS status, min(ts) AS started_at, 'manual' AS triggered_by,
true AS run_icl, false AS run_lora_sft, false AS dry_run, 'curation' AS resume_from
FROM events GROUP BY user_id"""
ORACLES["one_run"] = f"WITH {_RUNS} SELECT run_id, status, started_at FROM runs WHERE run_id = 'run-7'"
ORACLES["one_experiment"] = f"""
WITH {_EVENTS} SELECT experiment_id, run_id, created_at FROM exps WHERE experiment_id = 'exp-7-click'"""
ORACLES["experiment_fold"] = """
SELECT user_id AS experiment_id, min(ts) AS created_at, max(ts) AS updated_at,
arg_max(event_type, (ts, event_id)) AS status,
arg_max(props, (ts, event_id)) FILTER (event_type = 'error') AS error,
arg_max(value, (ts, event_id)) FILTER (event_type = 'purchase') AS accuracy
FROM events GROUP BY 1"""
ORACLES["experiment_fold_incremental"] = ORACLES["experiment_fold"]
ORACLES["value_counts"] = "SELECT event_type, count(*) AS n FROM events GROUP BY 1"
ORACLES["distinct_values"] = "SELECT DISTINCT source FROM documents"


def _histogram(ctes: str, source: str, column: str, bins: int, group: str = "") -> str:
    """Bins by comparing each value with the edges, not by dividing."""
    label = f"boxes.grp AS {group}, " if group else ""
    edges = f"CASE WHEN bin = {bins} THEN hi ELSE lo + bin * ((hi - lo) / {bins}::DOUBLE) END"
    return f"""
WITH {ctes}
vals AS (SELECT {group or 0} AS grp, {column}::DOUBLE AS x FROM {source}),
span AS (SELECT grp, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM vals GROUP BY grp),
edges AS (SELECT grp, bin, {edges} AS low FROM span, range({bins + 1}) AS r(bin)),
boxes AS (SELECT a.grp, a.bin, a.low, b.low AS high FROM edges a JOIN edges b
          ON a.grp = b.grp AND b.bin = a.bin + 1)
SELECT {label}bin, low, high, count(x) AS n FROM boxes LEFT JOIN vals
ON vals.grp = boxes.grp AND x >= low AND (x < high OR (bin = {bins - 1} AND x = high))
GROUP BY boxes.grp, bin, low, high"""


ORACLES["latency_histogram"] = _histogram("", "events", "value", 30)
ORACLES["length_histogram"] = _histogram("", "documents", "length(text)", 30)
ORACLES["quality_histogram"] = _histogram(_scores("text") + ",", "q", "quality_score", 30)
ORACLES["accuracy_histogram"] = _histogram(_EVALS + ",", "evals", "accuracy", 10, "experiment_type")
ORACLES["quality_describe"] = f"""
WITH {_scores('text')} SELECT count(*) AS count, round(avg(quality_score), 6) AS mean,
round(stddev_samp(quality_score), 6) AS std, round(min(quality_score), 6) AS min,
round(quantile_cont(quality_score, 0.25), 6) AS q25, round(quantile_cont(quality_score, 0.5), 6) AS q50,
round(quantile_cont(quality_score, 0.75), 6) AS q75, round(max(quality_score), 6) AS max FROM q"""
ORACLES["accuracy_pivot"] = f"""
WITH {_EVALS} SELECT model_id, round(avg(accuracy) FILTER (experiment_type = 'icl'), 6) AS icl,
round(avg(accuracy) FILTER (experiment_type = 'lora_sft'), 6) AS lora_sft FROM evals GROUP BY 1"""
ORACLES["compare_types"] = f"""
WITH {_EVALS} SELECT model_id, experiment_type, {_round('sum(accuracy::DECIMAL(24,6))::DOUBLE / count(accuracy)', 4)} AS accuracy,
{_round('sum(latency_p95_ms::DECIMAL(24,6))::DOUBLE / count(latency_p95_ms)', 4)} AS latency_p95_ms,
{_round('sum(cost_per_1k_tokens_usd::DECIMAL(24,6))::DOUBLE / count(cost_per_1k_tokens_usd)', 4)} AS cost_per_1k_tokens_usd FROM evals GROUP BY 1, 2"""
_KEYS = (
    "accuracy", "mean_score", "latency_p50_ms", "latency_p95_ms", "latency_p99_ms",
    "cost_per_1k_tokens_usd", "total_cost_usd", "sample_count",
    "score_1", "score_2", "score_3", "score_4", "score_5",
)
ORACLES["evaluation_metric_log"] = f"WITH {_EVALS} " + " UNION ALL ".join(
    f"SELECT model_name || '_' || substr(experiment_id, 1, 8) AS run_name, experiment_id, "
    f"'{key}' AS key, {key}::DOUBLE AS value FROM evals"
    for key in _KEYS
)
ORACLES["metric_log_wide"] = (
    f"WITH {_EVALS} SELECT model_name || '_' || substr(experiment_id, 1, 8) AS run_name, "
    "model_name AS tag_model_name, experiment_id AS tag_experiment_id, "
    + ", ".join(f"{key}::DOUBLE AS {key}" for key in _KEYS)
    + " FROM evals"
)
ORACLES["first_documents"] = "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 10"
ORACLES["last_runs"] = f"""
WITH {_RUNS} SELECT run_id, status, started_at FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 10"""
