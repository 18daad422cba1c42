"""A text quality classifier as a sparse ensemble of rules.

Trees are grown over text statistics; every path to a node below a root is a conjunctive rule; a logistic
model with a lasso penalty weighs the rules and drops most; what is left is one Spark column expression.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptmill.llm.words import light, shingle_hashes, strided, text_bytes, word_hashes
from promptmill.session import materialise

#: Labelled rows a model is fitted on, chosen by a hash of the id: the bound of the sample.
FIT_ROWS = 20_000

STATISTICS = (
    "bytes", "words", "word_bytes", "upper", "digits", "space", "lines", "stops", "commas",
    "shouts", "marks", "wide", "distinct", "top_word", "distinct_pairs", "repeats",
)


def _byte_classes() -> dict[str, np.ndarray]:
    byte = np.arange(256)
    chosen = lambda text: np.isin(byte, list(text.encode()))
    return {
        "upper": (byte >= 65) & (byte <= 90),
        "digits": (byte >= 48) & (byte <= 57),
        "space": chosen(" \t\r"),
        "lines": chosen("\n"),
        "stops": chosen("."),
        "commas": chosen(",;:"),
        "shouts": chosen("!?"),
        "marks": chosen("#$%&*+/<=>@[\\]^_`{|}~|\"'()-"),
        "wide": byte >= 128,
    }


_CLASSES = _byte_classes()


def _statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    raw, bounds = text_bytes(texts)
    n = len(bounds) - 1
    out = {name: np.zeros(n) for name in STATISTICS}
    out["bytes"] = np.diff(bounds).astype(float)
    for lo, hi in strided(n, bounds, 1 << 16):
        piece, cuts = raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
        full = np.flatnonzero(np.diff(cuts) > 0)
        if len(full):
            for name, members in _CLASSES.items():
                counts = np.add.reduceat(members[piece].astype(np.int64), cuts[full])
                out[name][lo + full] = counts / np.diff(cuts)[full]
    words, starts = word_hashes(texts)
    out["words"] = np.diff(starts).astype(float)
    letters = out["bytes"] * (1 - sum(out[c] for c in _CLASSES if c not in ("upper", "digits", "wide")))
    out["word_bytes"] = letters / np.maximum(out["words"], 1)
    for row in np.flatnonzero(out["words"]):
        own = words[starts[row] : starts[row + 1]]
        _, times = np.unique(own, return_counts=True)
        pairs, _ = shingle_hashes(own, np.array([0, len(own)]), 2)
        out["distinct"][row] = len(times) / len(own)
        out["top_word"][row] = times.max() / len(own)
        out["distinct_pairs"][row] = len(np.unique(pairs)) / len(pairs)
        out["repeats"][row] = np.count_nonzero(own[1:] == own[:-1]) / len(own)
    return out


def with_statistics(docs: DataFrame, *, text: str = "text", prefix: str = "_q_") -> DataFrame:
    """All columns of ``docs`` and the text statistics, each named ``prefix`` + name.

    Shares are of bytes or words; a null or empty text has zeros throughout. Columns of those names are replaced.
    """
    names = [prefix + name for name in STATISTICS]
    kept = docs.select(*(c for c in docs.columns if c not in names))
    schema = T.StructType([*kept.schema.fields, *(T.StructField(name, T.DoubleType()) for name in names)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in light(batches, text):
            found = _statistics(batch.column(text))
            columns = [*batch.columns, *(pa.array(found[name], pa.float64()) for name in STATISTICS)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *names])

    return kept.mapInArrow(add, schema)


#: (statistic, is at most, threshold)
Condition = tuple[str, bool, float]


@dataclass(frozen=True)
class RuleModel:
    """``intercept`` plus the weights of the rules that hold, on the log-odds scale."""

    intercept: float = 0.0
    rules: Sequence[tuple[float, Sequence[Condition]]] = field(default_factory=list)

    def score(self, prefix: str = "_q_") -> Column:
        total = F.lit(self.intercept)
        for weight, rule in self.rules:
            total = total + F.when(holds(rule, prefix), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(rule: Sequence[Condition], prefix: str = "_q_") -> Column:
    """The rule as a column expression."""
    tests = [F.col(prefix + s) <= F.lit(t) if below else F.col(prefix + s) > F.lit(t) for s, below, t in rule]
    return reduce(lambda a, b: a & b, tests)


def _paths(node, path: tuple[Condition, ...] = ()) -> Iterator[tuple[Condition, ...]]:
    """The conditions to every node of a fitted tree but its root."""
    if path:
        yield path
    if node.subtreeDepth() > 0:
        split = node.split()
        name, threshold = STATISTICS[split.featureIndex()], float(split.threshold())
        yield from _paths(node.leftChild(), (*path, (name, True, threshold)))
        yield from _paths(node.rightChild(), (*path, (name, False, threshold)))


def fit(
    rows: DataFrame, label: str, *, prefix: str = "_q_", trees: int = 20, depth: int = 4, penalty: float = 0.001, seed: int = 7
) -> RuleModel:
    """Fit on rows with statistics and a 0/1 ``label``; null labels are left out.

    Without rows the model scores 0.5 for all, with rows of one label it scores close to that label.
    """
    rows = rows.filter(F.col(label).isin(0, 1)).select(F.col(label).cast("double").alias("label"), *(prefix + s for s in STATISTICS))
    # Stored first: fewer tasks would also scan the texts in fewer tasks.
    rows = materialise(materialise(rows).coalesce(6))
    count, positive = rows.agg(F.count("*"), F.sum("label")).first()
    if not count or positive in (0, count):
        share = ((positive or 0) + 1) / (count + 2)
        return RuleModel(math.log(share / (1 - share)))
    gathered = VectorAssembler(inputCols=[prefix + s for s in STATISTICS], outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=5, seed=seed, featureSubsetStrategy="0.5").fit(gathered)
    rules = sorted({path for tree in forest.trees for path in _paths(tree._java_obj.rootNode())})
    if not rules:
        return RuleModel(math.log(positive / (count - positive)))
    indicators = [holds(rule, prefix).cast("double").alias(f"r{i}") for i, rule in enumerate(rules)]
    applied = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(
        rows.select("label", *indicators)
    )
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(applied.select("label", "features"))
    weights = lasso.coefficients.toArray()
    kept = [(float(w), rule) for w, rule in zip(weights, rules) if w != 0]
    return RuleModel(float(lasso.intercept), kept)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    fit_rows: int = FIT_ROWS,
) -> RuleModel:
    """Fit on at most ``fit_rows`` labelled documents outside the held-out third.

    Labels of ids that no document has, and null ids or labels, teach nothing; an id with several labels
    counts once for each.
    """
    chosen = (
        labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(doc_id))
        .select(F.col(doc_id).alias("_id"), F.col(label).alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(fit_rows)
    )
    texts = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("text"))
    # At most ``fit_rows`` rows of two numbers are broadcast.
    taught = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("text", "_label")
    return fit(with_statistics(taught), "_label")


def classified(docs: DataFrame, model: RuleModel, *, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5), replacing such columns.

    Every row is scored from its own text, so repeated rows score alike; an empty table stays empty.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    scored = with_statistics(docs.select(*kept), text=text).withColumn("score", model.score())
    return scored.select(*kept, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
