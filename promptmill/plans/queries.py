"""The registered queries, one or more per operator, over the benchmark tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill import schemas
from promptmill.config import Criteria, CurationConfig, RunConfig
from promptmill.functions import text as tx
from promptmill.functions.minhash import band_keys, balanced_shape, minhash
from promptmill.functions.stamps import iso_stamp, parse_iso
from promptmill.functions.redact import recognise, redact_pii, replace_spans
from promptmill.functions.verdicts import judge_prompt, parse_verdict
from promptmill.operators import evaluate as ev
from promptmill.operators import experiments as ex
from promptmill.operators import filters, gate, lifecycle, registry, reports, runs
from promptmill.operators.dedup import exact_duplicates, near_dedup, near_dup_pairs
from promptmill.plans import standins as st
from promptmill.plans.curation import curate, curation_counts
from promptmill.responders import failures, judge, judge_many, respond, respond_many
from promptmill.session import materialise, shared_dir
from promptmill.sources import folded
from promptmill.sources import logs as log_source
from promptmill.sources import metric_log, state
from promptmill.sources.datasets import export_chat_jsonl, read_dataset, write_dataset
from promptmill.sources.pulls import LogPulls
from promptmill.streaming.incremental import start_curation

QUERIES = {}

# Words that occur in the benchmark texts, for the blocklist query.
DATA_BLOCKLIST = ("the", "elle", "und")
# A gate that about half of the derived runs pass.
DATA_CRITERIA = Criteria(
    min_accuracy=0.5, max_latency_p95_ms=200, max_cost_per_1k_tokens=0.0005, min_eval_sample_size=10
)


def query(function):
    QUERIES[function.__name__] = function
    return function


def _scratch(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(spark)}/scratch-{uuid.uuid4()}"


def _text():
    return F.col("text")


# --- text ----------------------------------------------------------------------------------------


@query
def word_stats(spark, sf_dir):
    return st.table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.word_count(_text()).alias("words"),
        tx.approx_tokens(_text()).alias("approx_tokens"),
        F.length("text").alias("characters"),
    )


@query
def quality_parts(spark, sf_dir):
    return st.table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.alpha_ratio(_text()).alias("alpha_ratio"),
        tx.punct_score(_text()).alias("punct_score"),
        tx.bigram_unique_ratio(_text()).alias("bigram_unique_ratio"),
    )


@query
def quality_score(spark, sf_dir):
    return st.table(spark, sf_dir, "documents").select(
        "doc_id", tx.quality_score(_text()).alias("quality_score")
    )


@query
def toxic_flag(spark, sf_dir):
    return st.table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.is_toxic(_text(), DATA_BLOCKLIST).alias("flagged"),
        tx.is_toxic(_text()).alias("flagged_by_default"),
    )


@query
def normalized_text(spark, sf_dir):
    return st.table(spark, sf_dir, "documents").select(
        "doc_id", tx.normalize_text(_text()).alias("normalized")
    )


@query
def shingle_counts(spark, sf_dir):
    grams = tx.shingles(tx.normalize_text(_text()))
    return st.table(spark, sf_dir, "documents").select(
        "doc_id", F.size(grams).alias("shingles")
    )


@query
def redact(spark, sf_dir):
    return st.table(spark, sf_dir, "documents").select(
        "doc_id", redact_pii(_text()).alias("redacted")
    )


def _digit_runs(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), "NUMBER") for m in re.finditer("[0-9]+", text)]


@query
def redact_recognised(spark, sf_dir):
    """The recogniser hook, with a stand-in that finds runs of digits."""
    found = recognise(_digit_runs)
    spotted = st.table(spark, sf_dir, "documents").select(
        "doc_id", "text", found(_text()).alias("spans")
    )
    return spotted.select("doc_id", replace_spans(_text(), F.col("spans")).alias("redacted"))


# --- filters -------------------------------------------------------------------------------------


@query
def drop_reasons(spark, sf_dir):
    return filters.drop_counts(filters.tag_logs(st.document_logs(spark, sf_dir)))


@query
def drop_reason_rows(spark, sf_dir):
    cfg = CurationConfig(min_quality_score=0.5, blocklist=DATA_BLOCKLIST)
    tagged = filters.tag_logs(st.document_logs(spark, sf_dir), cfg)
    return tagged.select("log_id", "drop_reason")


@query
def drop_rate(spark, sf_dir):
    return filters.drop_rate(filters.tag_logs(st.document_logs(spark, sf_dir)))


@query
def filtered_logs(spark, sf_dir):
    return filters.filter_logs(st.document_logs(spark, sf_dir)).select("log_id", "response")


@query
def label_agreement(spark, sf_dir):
    """Drop decisions beside the quality labels."""
    tagged = filters.tag_logs(st.document_logs(spark, sf_dir))
    labels = st.table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "log_id")
    return (
        tagged.join(labels, "log_id")
        .groupBy("quality", "toxic", F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason"))
        .agg(F.count("*").alias("n"))
    )


# --- near-duplicates -----------------------------------------------------------------------------


@query
def minhash_signature(spark, sf_dir):
    signed = st.table(spark, sf_dir, "documents").select(
        "doc_id", minhash(tx.normalize_text(_text())).alias("signature")
    )
    return signed.select("doc_id", F.array_join("signature", ",").alias("signature"))


@query
def lsh_buckets(spark, sf_dir):
    """How many band buckets hold how many documents."""
    signed = st.table(spark, sf_dir, "documents").select(
        minhash(tx.normalize_text(_text())).alias("signature")
    )
    keys = signed.select(F.posexplode(band_keys(F.col("signature"), balanced_shape(0.85))))
    sizes = keys.groupBy("pos", "col.h1", "col.h2").agg(F.count("*").alias("members"))
    return sizes.groupBy(F.col("pos").alias("band"), "members").agg(F.count("*").alias("buckets"))


@query
def exact_dups(spark, sf_dir):
    found = exact_duplicates(st.table(spark, sf_dir, "documents"), _text(), ["doc_id"])
    return found.select(F.col("ord").alias("doc_id"), "copies")


@query
def near_dups(spark, sf_dir):
    """The documents that survive; the rule of the band index."""
    docs = st.table(spark, sf_dir, "documents")
    return near_dedup(docs, text=_text(), order_by=["doc_id"], verify=False).select("doc_id", "source")


@query
def near_dups_verified(spark, sf_dir):
    """The same with an exact similarity test on every match."""
    docs = st.table(spark, sf_dir, "documents")
    kept = near_dedup(docs, text=_text(), order_by=["doc_id"])
    return kept.select("doc_id", "source")


@query
def near_dup_matches(spark, sf_dir):
    docs = st.table(spark, sf_dir, "documents")
    return near_dup_pairs(docs, text=_text(), order_by=["doc_id"], verify=False).select(
        F.col("ord").alias("dropped_id"), F.col("lead").alias("kept_id"), "jaccard"
    )


@query
def curation_funnel(spark, sf_dir):
    return curation_counts(st.document_logs(spark, sf_dir), CurationConfig(remove_pii=False), ["log_id"])


@query
def curated_samples(spark, sf_dir):
    return curate(st.document_logs(spark, sf_dir), order_by=["log_id"]).select(
        "log_id", "response"
    )


@query
def capped_samples(spark, sf_dir):
    """The cap is the feature: the first samples in input order."""
    capped = curate(st.document_logs(spark, sf_dir), CurationConfig(max_samples=100), ["log_id"])
    return capped.select("log_id", "response")


# --- logs and datasets ---------------------------------------------------------------------------


@query
def log_pairs(spark, sf_dir):
    return st.conversation_logs(spark, sf_dir).select("log_id", "prompt", "response")


@query
def unconsumed(spark, sf_dir):
    fresh = log_source.read_unconsumed(
        st.full_logs(spark, sf_dir), st.consumed_ledger(spark, sf_dir)
    )
    return fresh.select("log_id", "prompt", "response", "model", "latency_ms", "session_id")


@query
def oldest_unconsumed(spark, sf_dir):
    """The pull limit, a feature of the pull."""
    fresh = log_source.read_unconsumed(
        st.full_logs(spark, sf_dir), st.consumed_ledger(spark, sf_dir), limit=100
    )
    return fresh.select("log_id", "latency_ms")


@query
def readiness(spark, sf_dir):
    waiting = log_source.count_unconsumed(
        st.full_logs(spark, sf_dir), st.consumed_ledger(spark, sf_dir)
    )
    return gate.readiness(waiting, min_new_logs=200)


@query
def ledger_round_trip(spark, sf_dir):
    """Consume the waiting logs, then ask again what is unconsumed."""
    path = f"{_scratch(spark)}/ledger"
    full, first = st.full_logs(spark, sf_dir), st.consumed_ledger(spark, sf_dir)
    log_source.append_ledger(log_source.read_unconsumed(full, first), "run-1", path)
    ledger = log_source.read_ledger(spark, path)
    return ledger.groupBy("run_id").agg(F.count("*").alias("consumed")).unionByName(
        log_source.count_unconsumed(full, ledger.unionByName(first)).select(
            F.lit("waiting").alias("run_id"), F.col("new_logs").alias("consumed")
        )
    )


@query
def unconsumed_after_pulls(spark, sf_dir):
    """Logs land in four parts; a run takes the first two, one the short answers of the third. What waits is read from open files only."""
    work = _scratch(spark)
    pulls = LogPulls(spark, f"{work}/logs", f"{work}/ledger")
    full = materialise(st.full_logs(spark, sf_dir))
    part = F.pmod(F.col("session_id").cast("bigint"), F.lit(4))
    for number in range(4):
        full.filter(part == number).write.mode("append").parquet(pulls.logs)
        if number in (1, 2):
            taken = pulls.unconsumed()
            if number == 2:
                taken = taken.filter(F.length("response") < 200)
            log_source.append_ledger(taken, f"run-{number}", pulls.ledger)
            pulls.settle()
    return pulls.unconsumed().select("log_id", "response")


@query
def dataset_round_trip(spark, sf_dir):
    path = _scratch(spark)
    write_dataset(st.full_logs(spark, sf_dir), "ds-1", "run-1", path)
    return read_dataset(spark, path, "ds-1").select("dataset_id", "seq", "log_id", "prompt", "response")


@query
def chat_export(spark, sf_dir):
    path = f"{_scratch(spark)}/chat"
    export_chat_jsonl(st.conversation_logs(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query
def sft_text(spark, sf_dir):
    messages = F.array_insert(
        tx.chat_messages(F.col("prompt"), F.col("response")),
        1,
        F.struct(F.lit("system").alias("role"), F.lit("skipped").alias("content")),
    )
    return st.conversation_logs(spark, sf_dir).select(
        "log_id", tx.sft_text(messages, "</s>").alias("text")
    )


@query
def judge_prompts(spark, sf_dir):
    return st.conversation_logs(spark, sf_dir).select(
        "log_id",
        judge_prompt(F.col("prompt"), F.col("response"), F.upper("model")).alias("judge_prompt"),
    )


# --- experiments ---------------------------------------------------------------------------------


def _planned(spark, sf_dir, existing=None):
    datasets = (
        st.table(spark, sf_dir, "documents")
        .select(F.col("source").alias("dataset_id"))
        .distinct()
        .withColumn("run_id", F.concat(F.lit("run-"), "dataset_id"))
    )
    return ex.plan_experiments(ex.candidates_table(spark), datasets, RunConfig(), existing)


@query
def plan_experiments(spark, sf_dir):
    return _planned(spark, sf_dir)


@query
def plan_remaining(spark, sf_dir):
    """Planning again when French sources already trained their first candidate."""
    trained = (
        st.table(spark, sf_dir, "documents")
        .filter("lang = 'fr'")
        .select(F.concat(F.lit("run-"), "source").alias("run_id"))
        .distinct()
        .select(
            "run_id",
            F.lit("qwen-0.5b").alias("model_id"),
            F.lit("lora_sft").alias("experiment_type"),
            F.lit("completed").alias("status"),
            F.concat(F.lit("old-"), "run_id").alias("experiment_id"),
        )
    )
    planned = _planned(spark, sf_dir, trained)
    return ex.run_experiment_ids(planned, trained)


@query
def experiment_samples(spark, sf_dir):
    waiting = ex.evaluable(_planned(spark, sf_dir))
    samples = st.table(spark, sf_dir, "documents").select(
        F.col("source").alias("dataset_id"), F.col("doc_id").alias("log_id")
    )
    return ex.experiment_samples(waiting, samples).select("experiment_id", "model_name", "log_id")


@query
def evaluable_chosen(spark, sf_dir):
    """Waiting experiments, limited to those a plan names."""
    known = st.experiments(spark, sf_dir)
    chosen = known.filter("experiment_type = 'lora_sft'").select("experiment_id")
    return ex.evaluable(known, chosen).select("experiment_id", "run_id")


@query
def paired_responses(spark, sf_dir):
    """Events of one minute share a sample; purchases teach, the others are candidates."""
    minute = F.date_format(F.date_trunc("minute", "ts"), "yyyyMMddHHmm")
    answers = st.table(spark, sf_dir, "events").select(
        F.format_string("e%012d", "event_id").alias("experiment_id"),
        minute.alias("sample_id"),
        F.when(F.col("event_type") == "purchase", "teacher").otherwise("candidate").alias("role"),
        F.col("props").alias("response"),
    )
    return ev.pair_responses(answers)


def _echo(model: str, prompt: str):
    return prompt.replace(" ", "_"), float(len(prompt)), len(model), prompt.count(" ")


@query
def model_responses(spark, sf_dir):
    """The responder hook, with a stand-in model."""
    requests = st.conversation_logs(spark, sf_dir).select(
        F.lit("exp-1").alias("experiment_id"),
        F.col("log_id").alias("sample_id"),
        F.col("model").alias("model_name"),
        F.lit("candidate").alias("role"),
        "prompt",
    )
    return respond(requests, _echo)


def _echo_or_fail(model: str, prompts):
    if model == "model-2":
        raise ConnectionError("out of reach")
    return [ValueError("odd prompt") if len(p) % 10 == 7 else _echo(model, p) for p in prompts]


def _asked_in_batches(spark, sf_dir):
    """Conversations dealt to three experiments with a model each."""
    third = F.pmod(F.col("conv_id"), F.lit(3)).cast("string")
    return st.conversation_logs(spark, sf_dir).select(
        F.concat(F.lit("exp-"), third).alias("experiment_id"),
        F.col("log_id").alias("sample_id"),
        F.concat(F.lit("model-"), third).alias("model_name"),
        F.lit("candidate").alias("role"),
        "prompt",
        "response",
    )


@query
def batch_responses(spark, sf_dir):
    """The batch hook: one model is out of reach, the others refuse some prompts."""
    return respond_many(_asked_in_batches(spark, sf_dir), _echo_or_fail)


@query
def failed_experiments(spark, sf_dir):
    return failures(batch_responses(spark, sf_dir))


def _stub_judge_many(system: str, prompts, attempt: int):
    if attempt == 1 and any(len(p) % 13 == 0 for p in prompts):
        raise TimeoutError("busy")
    return [_stub_judge(system, p, 2) for p in prompts]


@query
def batch_verdicts(spark, sf_dir):
    """The batch judge: a call that fails costs an attempt and no verdict."""
    pairs = _asked_in_batches(spark, sf_dir).select(
        "experiment_id", "sample_id", "prompt", F.col("response").alias("reference"), F.col("prompt").alias("candidate")
    )
    replies = judge_many(pairs, _stub_judge_many, lambda reply: reply.startswith("{"))
    read = ev.first_verdicts(replies.filter("error IS NULL"))
    return read.select("experiment_id", "sample_id", "score")


def _stub_judge(system: str, prompt: str, attempt: int) -> str:
    if len(prompt) % 2 and attempt == 1:
        return "I would say 4"
    return '{"score": %d, "reason": "attempt %d"}' % (1 + len(prompt) % 5, attempt)


@query
def model_verdicts(spark, sf_dir):
    """The judge hook, with a stand-in that fails its first attempt on odd prompts."""
    pairs = st.conversation_logs(spark, sf_dir).select(
        F.lit("exp-1").alias("experiment_id"),
        F.col("log_id").alias("sample_id"),
        "prompt",
        F.col("response").alias("reference"),
        F.col("prompt").alias("candidate"),
    )
    raw = judge(pairs, _stub_judge, lambda reply: reply.startswith("{"))
    return ev.first_verdicts(raw)


# --- evaluation ----------------------------------------------------------------------------------


@query
def latency_stats(spark, sf_dir):
    return ev.latency_stats(st.responses(spark, sf_dir), ["event_type"])


@query
def latency_overall(spark, sf_dir):
    return ev.latency_stats(st.responses(spark, sf_dir).withColumn("g", F.lit("all")), ["g"])


@query
def cost_stats(spark, sf_dir):
    return ev.cost_stats(
        st.responses(spark, sf_dir), ev.pricing_table(spark), ["event_type", "model_name"]
    )


@query
def verdict_parse(spark, sf_dir):
    parsed = st.verdicts(spark, sf_dir).withColumn("v", parse_verdict(F.col("raw")))
    return parsed.select("sample_id", "attempt", "v.score", "v.reason")


@query
def first_attempt(spark, sf_dir):
    return ev.first_verdicts(st.verdicts(spark, sf_dir))


@query
def judge_summary(spark, sf_dir):
    read = ev.first_verdicts(st.verdicts(spark, sf_dir))
    summary = ev.judge_summary(read, ["experiment_id"])
    return summary.select(
        "experiment_id", "sample_count", "mean_score", "win_rate",
        *(F.col("score_distribution")[s].alias(f"score_{s}") for s in ev.SCORES),
    )


@query
def evaluations(spark, sf_dir):
    return st.evaluations(spark, sf_dir).drop("score_distribution", "adapter_repo_id")


@query
def best_candidate(spark, sf_dir):
    return gate.best_candidate(st.scored(spark, sf_dir)).select(
        "run_id", "experiment_id", "accuracy", "cost_per_1k_tokens"
    )


@query
def promotion_gate(spark, sf_dir):
    reasons = gate.failure_reasons(DATA_CRITERIA)
    return st.scored(spark, sf_dir).select(
        "experiment_id",
        gate.passes_criteria(DATA_CRITERIA).alias("passed"),
        *(
            reasons[name].alias(f"{name}_failure")
            for name in ("accuracy", "latency", "cost", "sample_size")
        ),
    )


@query
def pass_count(spark, sf_dir):
    return gate.pass_count(st.scored(spark, sf_dir), DATA_CRITERIA)


@query
def promotion_decisions(spark, sf_dir):
    """Every customer has a run; those without events scored no candidate."""
    scored = st.scored(spark, sf_dir)
    all_runs = st.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("run-"), F.col("c_custkey").cast("string")).alias("run_id")
    )
    decided = gate.promotion_decisions(all_runs, scored, DATA_CRITERIA)
    return decided.withColumn("detail", F.array_join(F.map_keys("detail"), ","))


# --- registry ------------------------------------------------------------------------------------


def _registry(spark, sf_dir):
    """All scored experiments registered as candidates."""
    now = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    empty = spark.createDataFrame([], schemas.MODEL_REGISTRY)
    scored = materialise(st.scored(spark, sf_dir))
    return registry.register(empty, scored, now), scored


def _flat(frame: DataFrame) -> DataFrame:
    return frame.select(
        "model_id", "run_id", "status", F.col("metrics.accuracy").alias("accuracy"),
        *(F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("created_at", "promoted_at", "archived_at")),
    )


@query
def registry_promote(spark, sf_dir):
    """Two promotions in a row leave one production and one archived model."""
    models, scored = _registry(spark, sf_dir)
    first, second = (
        r[0] for r in scored.orderBy(F.desc("accuracy"), "experiment_id").select("experiment_id").limit(2).collect()
    )
    models = registry.promote(models, first, F.to_timestamp(F.lit("2024-02-02 00:00:00")))
    return _flat(registry.promote(models, second, F.to_timestamp(F.lit("2024-02-03 00:00:00"))))


@query
def registry_register(spark, sf_dir):
    """Registering a part again resets those rows, the production row included."""
    models, scored = _registry(spark, sf_dir)
    best = scored.orderBy(F.desc("accuracy"), "experiment_id").first()["experiment_id"]
    models = registry.promote(models, best, F.to_timestamp(F.lit("2024-02-02 00:00:00")))
    again = scored.filter(F.col("accuracy") >= 0.5)
    return _flat(registry.register(models, again, F.to_timestamp(F.lit("2024-02-03 00:00:00"))))


def _after_two_promotions(spark, sf_dir):
    models, scored = _registry(spark, sf_dir)
    best = scored.orderBy(F.desc("accuracy"), "experiment_id").select("experiment_id").limit(2)
    for day, row in enumerate(best.collect(), start=2):
        models = registry.promote(models, row[0], F.to_timestamp(F.lit(f"2024-02-0{day} 00:00:00")))
    return models


@query
def promotion_history(spark, sf_dir):
    history = registry.promotion_history(_after_two_promotions(spark, sf_dir))
    return _flat(history).select("model_id", "status", "promoted_at")


@query
def archived_models(spark, sf_dir):
    """Archiving the active model by hand leaves two archived ones and no active one."""
    models = _after_two_promotions(spark, sf_dir)
    active = registry.active_model(models).first()["model_id"]
    models = registry.archive(models, active, F.to_timestamp(F.lit("2024-02-04 00:00:00")))
    return _flat(registry.list_models(models, "archived")).select(
        "model_id", "status", "archived_at"
    )


@query
def recently_promoted(spark, sf_dir):
    """The model listing, a top-k report: promoted ones first."""
    listed = registry.recently_promoted(_after_two_promotions(spark, sf_dir))
    return _flat(listed).select("model_id", "status", "promoted_at")


@query
def promotion_metric_log(spark, sf_dir):
    """Metrics logged for the experiments that runs would promote."""
    scored = st.scored(spark, sf_dir)
    chosen = gate.promotion_decisions(
        scored.select("run_id").distinct(), scored, DATA_CRITERIA
    ).filter("promoted").select(F.col("promoted_model_id").alias("experiment_id"))
    log = metric_log.promotions_to_metric_log(scored.join(chosen, "experiment_id", "left_semi"))
    return log.select("run_name", F.col("tags")["run_id"].alias("run_id"), "key", "value")


@query
def completed_experiments(spark, sf_dir):
    """Partial updates folded, completed rows kept, their metrics flattened."""
    planned = st.experiments(spark, sf_dir).select(
        "experiment_id", "run_id", "status", "created_at",
        F.col("created_at").alias("updated_at"), F.lit(1).alias("seq"),
    )
    metrics = F.struct("accuracy", "mean_score", "latency_p95_ms", "cost_per_1k_tokens_usd")
    finished = st.evaluations(spark, sf_dir).filter("sample_count >= 10").select(
        "experiment_id", "run_id", F.lit("completed").alias("status"), metrics.alias("metrics")
    )
    dates = planned.select("experiment_id", "created_at")
    finished = (
        finished.join(dates, "experiment_id")
        .withColumn("updated_at", F.col("created_at"))
        .withColumn("seq", F.lit(2))
    )
    folded = ex.current_experiments(planned.unionByName(finished, allowMissingColumns=True))
    flat = reports.flatten_metrics(reports.completed(folded))
    return flat.select("experiment_id", "run_id", "status", "created_at", "accuracy", "latency_p95_ms")


@query
def registry_snapshot(spark, sf_dir):
    """Write, promote, write again, archive, read the current version and its active model."""
    path = f"{_scratch(spark)}/registry"
    models, scored = _registry(spark, sf_dir)
    state.write_snapshot(models, path)
    best = scored.orderBy(F.desc("accuracy"), "experiment_id").first()["experiment_id"]
    current = state.read_snapshot(spark, path, schemas.MODEL_REGISTRY)
    state.write_snapshot(registry.promote(current, best, F.current_timestamp(), stamp=False), path)
    current = state.read_snapshot(spark, path, schemas.MODEL_REGISTRY)
    return registry.active_model(current).select("model_id", "status", "promoted_at").withColumn(
        "promoted_at", F.col("promoted_at").cast("string")
    )


# --- runs and reports ----------------------------------------------------------------------------


def _runs(spark, sf_dir):
    return runs.fold_runs(st.run_events(spark, sf_dir))


def _run_rows(found: DataFrame) -> DataFrame:
    return found.select(
        "run_id", "status", "started_at", "updated_at", "error",
        *(
            F.col("stages")[stage]["status"].alias(f"{stage}_status")
            for stage in schemas.STAGES
        ),
        F.col("stages")["curation"]["logs_pulled"].alias("logs_pulled"),
    )


@query
def run_fold(spark, sf_dir):
    return _run_rows(_runs(spark, sf_dir))


@query
def run_fold_incremental(spark, sf_dir):
    """Events in four segments, in no order of time, one of them repeated, folded after the second: the same as the whole history."""
    unguarded = folded.Folding(runs.lift_runs, runs.merge_runs, runs.finish_runs)
    kept = folded.run_events(spark, f"{_scratch(spark)}/runs", unguarded)
    events = materialise(st.run_events(spark, sf_dir))
    for number in (2, 0, 3, 1):
        piece = events.filter(F.pmod("seq", F.lit(4)) == number)
        kept.append(piece if number != 1 else piece.unionByName(events.filter(F.pmod("seq", F.lit(4)) == 2)))
        if number == 0:
            kept.fold()
    return _run_rows(kept.read())


@query
def guarded_runs(spark, sf_dir):
    """Statuses by attempt and how far along they are, with how many events came too late to count."""
    attempt = F.pmod("seq", F.lit(3)).cast("int")
    events = materialise(st.run_events(spark, sf_dir).withColumn("attempt", attempt))
    ignored = lifecycle.ignored_events(events).groupBy("run_id").agg(F.sum("n").alias("ignored"))
    return runs.fold_runs(events, guarded=True).join(ignored, "run_id", "left").select(
        "run_id", "status", "attempt", "updated_at", F.coalesce("ignored", F.lit(0)).alias("ignored")
    )


@query
def iso_stamps(spark, sf_dir):
    """Stamps with and without offset and fraction, read and written back."""
    shape, at = F.pmod("event_id", F.lit(5)), F.col("ts")
    plain = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(shape == 0, F.concat(plain, F.lit("Z")))
        .when(shape == 1, F.concat(plain, F.lit(".250000+02:00")))
        .when(shape == 2, F.concat(plain, F.lit("-05:30")))
        .when(shape == 3, F.date_format(at, "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("at "), plain))
    )
    events = st.table(spark, sf_dir, "events")
    return events.select("event_id", text.alias("text")).select("event_id", iso_stamp(parse_iso(F.col("text"))).alias("stamp"))


@query
def registered_runs(spark, sf_dir):
    """A run registered for every user, folded to its first state."""
    ids = st.table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("at"))
    started = runs.registration(
        ids.select(st.run_id().alias("run_id"), "at"), F.col("at"), "manual", run_lora_sft=False
    )
    point = runs.resume_points(runs.fold_runs(started))
    return point.select(
        "run_id", "status", "started_at", "triggered_by", "config.run_icl", "config.run_lora_sft",
        "config.dry_run", "resume_from",
    )


@query
def one_run(spark, sf_dir):
    """The point lookup is the feature."""
    return runs.get_run(_runs(spark, sf_dir), "run-7").select("run_id", "status", "started_at")


@query
def one_experiment(spark, sf_dir):
    """The point lookup is the feature."""
    return ex.get_experiment(st.experiments(spark, sf_dir), "exp-7-click").select("experiment_id", "run_id", "created_at")


@query
def resume_point(spark, sf_dir):
    resumed = runs.resume_points(_runs(spark, sf_dir))
    return resumed.select(
        "run_id",
        "resume_from",
        F.col("carried.status").alias("carried_status"),
        F.col("carried.dataset_id").alias("dataset_id"),
    )


@query
def stage_skips(spark, sf_dir):
    planned = st.experiments(spark, sf_dir).filter("experiment_type = 'lora_sft'")
    return runs.stage_skips(_runs(spark, sf_dir), planned)


@query
def cycle_number(spark, sf_dir):
    return reports.cycles(_runs(spark, sf_dir).select("run_id", "started_at"))


@query
def funnel_by_cycle(spark, sf_dir):
    return reports.funnel_by_cycle(_runs(spark, sf_dir))


@query
def accuracy_by_cycle(spark, sf_dir):
    by_cycle = reports.metric_by_cycle(
        st.evaluations(spark, sf_dir), _runs(spark, sf_dir), "accuracy"
    )
    return by_cycle.select("cycle", F.round("accuracy", 6).alias("accuracy"))


@query
def cost_by_cycle(spark, sf_dir):
    by_cycle = reports.metric_by_cycle(
        st.evaluations(spark, sf_dir), _runs(spark, sf_dir), "cost_per_1k_tokens_usd"
    )
    return by_cycle.select("cycle", F.round("cost_per_1k_tokens_usd", 9).alias("cost"))


@query
def list_runs(spark, sf_dir):
    return runs.list_runs(_runs(spark, sf_dir), status="failed").select("run_id", "started_at")


@query
def list_experiments(spark, sf_dir):
    return ex.list_experiments(st.experiments(spark, sf_dir)).select(
        "experiment_id", "created_at"
    )


def _experiment_updates(spark, sf_dir):
    return st.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("experiment_id"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("status"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("accuracy"),
    )


@query
def experiment_fold(spark, sf_dir):
    """Partial updates folded to the latest known value per column."""
    return ex.current_experiments(_experiment_updates(spark, sf_dir))


@query
def experiment_fold_incremental(spark, sf_dir):
    """The same from segments, folded twice while updates still come."""
    updates = materialise(_experiment_updates(spark, sf_dir))
    folding = folded.Folding(ex.lift_experiments, ex.merge_experiments, ex.finish_experiments)
    kept = folded.FoldedEvents(spark, f"{_scratch(spark)}/experiments", updates.schema, folding)
    for number in (1, 2, 0):
        kept.append(updates.filter(F.pmod("seq", F.lit(3)) == number), f"part-{number}")
        if number:
            kept.fold()
    return kept.read()


@query
def value_counts(spark, sf_dir):
    return reports.value_counts(st.table(spark, sf_dir, "events"), "event_type")


@query
def distinct_values(spark, sf_dir):
    return reports.distinct_values(st.table(spark, sf_dir, "documents"), "source")


@query
def latency_histogram(spark, sf_dir):
    return reports.histogram(st.responses(spark, sf_dir), "latency_ms", 30)


@query
def length_histogram(spark, sf_dir):
    lengths = st.table(spark, sf_dir, "documents").select(F.length("text").alias("characters"))
    return reports.histogram(lengths, "characters", 30)


@query
def quality_histogram(spark, sf_dir):
    return reports.histogram(quality_score(spark, sf_dir), "quality_score", 30)


@query
def accuracy_histogram(spark, sf_dir):
    return reports.histogram(st.evaluations(spark, sf_dir), "accuracy", 10, by="experiment_type")


@query
def quality_describe(spark, sf_dir):
    described = reports.describe(quality_score(spark, sf_dir), "quality_score")
    return described.select("count", *(F.round(c, 6).alias(c) for c in described.columns[1:]))


@query
def accuracy_pivot(spark, sf_dir):
    wide = reports.accuracy_pivot(st.evaluations(spark, sf_dir))
    return wide.select("model_id", *(F.round(t, 6).alias(t) for t in schemas.EXPERIMENT_TYPES))


@query
def compare_types(spark, sf_dir):
    return reports.compare_types(st.evaluations(spark, sf_dir))


@query
def evaluation_metric_log(spark, sf_dir):
    log = metric_log.to_metric_log(st.evaluations(spark, sf_dir))
    return log.select("run_name", F.col("tags")["experiment_id"].alias("experiment_id"), "key", "value")


@query
def metric_log_wide(spark, sf_dir):
    path = f"{_scratch(spark)}/metrics"
    state.append_events(metric_log.to_metric_log(st.evaluations(spark, sf_dir)), path)
    return metric_log.read_metric_log(spark.read.schema(schemas.METRIC_LOG).parquet(path))


@query
def first_documents(spark, sf_dir):
    """The preview of a table, a top-k report."""
    return reports.head(st.table(spark, sf_dir, "documents").select("doc_id", "n_chars"), ["doc_id"])


@query
def last_runs(spark, sf_dir):
    folded = _runs(spark, sf_dir).select("run_id", "status", "started_at")
    return reports.tail(folded, ["started_at", "run_id"])


# --- streaming -----------------------------------------------------------------------------------


_STREAMED = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def _as_logs(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("log_id"), F.lit("").alias("prompt"),
        F.col("text").alias("response"), F.col("source").alias("model"),
    )


@query
def incremental_curation(spark, sf_dir):
    """Documents streamed through curation once; equals the batch result."""
    work = _scratch(spark)
    # The table may be a file or a folder of part files; a stream takes a single file by a pattern only.
    stream = _as_logs(spark.readStream.schema(_STREAMED).parquet(f"{sf_dir}/documents.parque[t]"))
    start_curation(
        stream, output=f"{work}/out", checkpoint=f"{work}/checkpoint", order_by=["log_id"]
    ).awaitTermination()
    return spark.read.parquet(f"{work}/out/samples").select("log_id", "response")


def _in_four_batches(spark, sf_dir, **options):
    """A source that grows by a quarter of the documents at a time; the stream is started again for each."""
    work = _scratch(spark)
    documents = st.table(spark, sf_dir, "documents")
    for number in range(4):
        documents.filter(F.pmod("doc_id", F.lit(4)) == number).write.mode("append").parquet(f"{work}/in")
        start_curation(
            _as_logs(spark.readStream.schema(_STREAMED).parquet(f"{work}/in")),
            output=f"{work}/out", checkpoint=f"{work}/checkpoint", order_by=["log_id"], **options,
        ).awaitTermination()
    return spark.read.parquet(f"{work}/out/samples").select("log_id", "response", "batch_id")


@query
def curation_in_batches(spark, sf_dir):
    """Every batch keeps the first of its own near-duplicates; nothing is read twice."""
    return _in_four_batches(spark, sf_dir)


@query
def curation_across_batches(spark, sf_dir):
    """A sample also falls to one that an earlier batch kept, found in the band index, which is folded on the way."""
    return _in_four_batches(spark, sf_dir, across_batches=True, fold_every=2, prefix_bits=4)
