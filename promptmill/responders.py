"""Where models plug in. Calls run inside Spark partitions.

``respond`` and ``judge`` take functions that answer one prompt and let their errors end the job. ``respond_many`` and
``judge_many`` take functions that answer several prompts of one experiment at once, keep a bounded number of calls open, and
turn an error into an ``error`` column of the rows it concerns, so that one bad experiment leaves the others alone.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.config import JUDGE_SYSTEM_PROMPT
from promptmill.functions.verdicts import judge_prompt

# (model_name, prompt) -> (response, latency_ms, input_tokens, output_tokens)
Responder = Callable[[str, str], tuple[str, float, int, int]]
# (system_prompt, user_prompt, attempt) -> raw reply
Judge = Callable[[str, str, int], str]

# (model_name, prompts) -> for each prompt (response, latency_ms, input_tokens, output_tokens), or an exception
BatchResponder = Callable[[str, Sequence[str]], Sequence]
# (system_prompt, user_prompts, attempt) -> for each prompt the raw reply, or an exception
BatchJudge = Callable[[str, Sequence[str], int], Sequence]

MAX_ATTEMPTS = 3
#: Prompts of one call, and calls that a task has open at a time.
CALL_SIZE, OPEN_CALLS = 16, 4


def respond(requests: DataFrame, responder: Responder) -> DataFrame:
    """Answer rows of ``experiment_id, sample_id, model_name, role, prompt``.

    A model server is slow and billed, so callers persist the result once and reuse it.
    """

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [responder(m, p) for m, p in zip(batch["model_name"], batch["prompt"])]
            columns = ["response", "latency_ms", "input_tokens", "output_tokens"]
            yield pd.concat(
                [
                    batch.drop(columns="prompt").reset_index(drop=True),
                    pd.DataFrame(answers, columns=columns),
                ],
                axis=1,
            )

    schema = (
        "experiment_id string, sample_id string, model_name string, role string, "
        "response string, latency_ms double, input_tokens int, output_tokens int"
    )
    columns = ["experiment_id", "sample_id", "model_name", "role", "prompt"]
    return requests.select(*columns).mapInPandas(answer, schema)


def judge(pairs: DataFrame, ask: Judge, is_verdict: Callable[[str], bool]) -> DataFrame:
    """Ask for a verdict on ``experiment_id, sample_id, prompt, reference, candidate`` rows.

    Emits every raw reply with its attempt number and stops at the first that ``is_verdict``
    accepts. Scores are read from the replies afterwards, by native expressions.
    """
    prompts = pairs.select(
        "experiment_id",
        "sample_id",
        judge_prompt(F.col("prompt"), F.col("reference"), F.col("candidate")).alias("prompt"),
    )

    def verdicts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for experiment_id, sample_id, prompt in batch.itertuples(index=False):
                for attempt in range(1, MAX_ATTEMPTS + 1):
                    raw = ask(JUDGE_SYSTEM_PROMPT, prompt, attempt)
                    rows.append((experiment_id, sample_id, attempt, raw))
                    if is_verdict(raw):
                        break
            yield pd.DataFrame(rows, columns=["experiment_id", "sample_id", "attempt", "raw"])

    return prompts.mapInPandas(
        verdicts, "experiment_id string, sample_id string, attempt int, raw string"
    )


def one_by_one(answer: Callable) -> Callable:
    """A batch function from one that takes a single prompt; an error concerns its own prompt only."""

    def answer_all(name: str, prompts: Sequence[str], *rest) -> list:
        out = []
        for prompt in prompts:
            try:
                out.append(answer(name, prompt, *rest))
            except Exception as error:  # handed on as a value
                out.append(error)
        return out

    return answer_all


def _said(error: BaseException) -> str:
    return f"{type(error).__name__}: {error}"


def _called(call: Callable[[], Sequence], size: int) -> list:
    """The answers of a call; a call that fails, or gives another number of answers, fails for all its prompts."""
    try:
        found = list(call())
        if len(found) != size:
            raise ValueError(f"{len(found)} answers to {size} prompts")
        return found
    except Exception as error:  # handed on as a value
        return [error] * size


def _in_turn(calls: Iterable[Callable[[], list]], width: int) -> Iterator[list]:
    """Results in the order of the calls, with at most ``width`` of them under way."""
    with ThreadPoolExecutor(width) as pool:
        waiting: deque[Future] = deque()
        for call in calls:
            waiting.append(pool.submit(call))
            if len(waiting) >= width:
                yield waiting.popleft().result()
        while waiting:
            yield waiting.popleft().result()


def _calls(batches: Iterator[pd.DataFrame], keys: list[str], size: int) -> Iterator[list[tuple]]:
    """Rows in groups of at most ``size`` that agree on ``keys``, so that a call never mixes experiments."""
    for batch in batches:
        places = [batch.columns.get_loc(k) for k in keys]
        ordered = batch.sort_values(keys, kind="stable", na_position="first").astype(object)
        ordered = ordered.where(ordered.notna(), None)
        for _, rows in groupby(ordered.itertuples(index=False, name=None), key=lambda r: tuple(r[p] for p in places)):
            held = list(rows)
            for at in range(0, len(held), size):
                yield held[at : at + size]


ANSWERS = (
    "experiment_id string, sample_id string, model_name string, role string, "
    "response string, latency_ms double, input_tokens int, output_tokens int, error string"
)


def respond_many(
    requests: DataFrame, responder: BatchResponder, call_size: int = CALL_SIZE, open_calls: int = OPEN_CALLS
) -> DataFrame:
    """One row per request, answered or with an ``error`` and no response.

    ``requests`` has ``experiment_id, sample_id, model_name, role, prompt``. Persist the result and ask again for the rows
    that :func:`unanswered` names.
    """
    columns = ["experiment_id", "sample_id", "model_name", "role", "prompt"]

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def asked(rows: list[tuple]) -> list[tuple]:
            found = _called(lambda: responder(rows[0][2], [r[4] for r in rows]), len(rows))
            return [
                (*r[:4], None, None, None, None, _said(a)) if isinstance(a, BaseException) else (*r[:4], *a, None)
                for r, a in zip(rows, found)
            ]

        groups = _calls(batches, ["experiment_id", "model_name"], call_size)
        for rows in _in_turn(((lambda g=g: asked(g)) for g in groups), open_calls):
            yield _frame(rows, ANSWERS)

    return requests.select(*columns).mapInPandas(answer, ANSWERS)


REPLIES = "experiment_id string, sample_id string, attempt int, raw string, error string"


def judge_many(
    pairs: DataFrame,
    ask: BatchJudge,
    is_verdict: Callable[[str], bool],
    call_size: int = CALL_SIZE,
    open_calls: int = OPEN_CALLS,
) -> DataFrame:
    """Ask for verdicts on ``experiment_id, sample_id, prompt, reference, candidate`` rows, several at a time.

    Emits every raw reply with its attempt; the prompts whose reply ``is_verdict`` does not accept are asked together
    again. A failed call counts as an attempt and leaves a row with an ``error`` and no reply.
    """
    prompts = pairs.select(
        "experiment_id",
        "sample_id",
        judge_prompt(F.col("prompt"), F.col("reference"), F.col("candidate")).alias("prompt"),
    )

    def verdicts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def asked(rows: list[tuple]) -> list[tuple]:
            out, left = [], rows
            for attempt in range(1, MAX_ATTEMPTS + 1):
                found = _called(lambda: ask(JUDGE_SYSTEM_PROMPT, [r[2] for r in left], attempt), len(left))
                failed = [isinstance(a, BaseException) for a in found]
                out += [(*r[:2], attempt, None, _said(a)) if f else (*r[:2], attempt, a, None) for r, a, f in zip(left, found, failed)]
                left = [r for r, a, f in zip(left, found, failed) if f or not is_verdict(a)]
                if not left:
                    break
            return out

        groups = _calls(batches, ["experiment_id"], call_size)
        for rows in _in_turn(((lambda g=g: asked(g)) for g in groups), open_calls):
            yield _frame(rows, REPLIES)

    return prompts.mapInPandas(verdicts, REPLIES)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names, kinds = zip(*(part.strip().split(" ") for part in schema.split(",")))
    frame = pd.DataFrame(rows, columns=list(names), dtype=object)
    return frame.astype({n: {"int": "Int32", "double": "Float64"}[k] for n, k in zip(names, kinds) if k != "string"})


def unanswered(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """The requests that no stored row answers; rows with an ``error`` answer nothing."""
    good = answers.filter(F.col("error").isNull()).select("experiment_id", "sample_id", "role")
    return requests.join(good, ["experiment_id", "sample_id", "role"], "left_anti")


def failures(answers: DataFrame, keys: Sequence[str] = ("sample_id",)) -> DataFrame:
    """``experiment_id, failed, error``: experiments with requests that only errors answer, how many, and one error.

    ``keys`` tell the requests of an experiment apart.
    ``answers`` are stored rows of one or more attempts of ``respond_many`` or ``judge_many``; a later answer heals an
    earlier error.
    """
    of_row = answers.groupBy("experiment_id", *keys).agg(
        F.bool_and(F.col("error").isNotNull()).alias("lost"), F.min("error").alias("error")
    )
    return of_row.filter("lost").groupBy("experiment_id").agg(F.count("*").alias("failed"), F.min("error").alias("error"))
