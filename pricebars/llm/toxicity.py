"""Toxicity by non-negative positive-unlabelled learning.

The classifiers see confirmed toxic documents and unlabelled ones, whatever their label.  With the class prior p the
risk of a scorer f is  p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)]) : the second term estimates the
risk on clean text and may not go below zero; where a batch sends it there, the step goes the other way.

Words and word beginnings that are significantly more or less frequent in toxic than in unlabelled documents are the
features (present or not, so length gives no credit); a few linear classifiers with different batches are averaged.  Fitting uses a bounded
sample (``POSITIVES``, ``UNLABELLED``); the class prior is counted over all labels and every text is scored whole.
"""

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.llm.sampling import bounded, with_text
from pricebars.llm.text import remainder
from pricebars.sources.store import materialise

POSITIVES = 3_000
UNLABELLED = 12_000
#: Most features, and how many standard errors a word's frequencies must lie apart.
FEATURES = 4_096
SIGNIFICANT = 4.5
CLASSIFIERS = 3
PREFIX = 4
_WORD = re.compile(r"\w+")


def features(text: str) -> set[str]:
    """Words of a text, and their beginnings, marked with a star."""
    found = set(_WORD.findall(text.lower()))
    return found | {w[:PREFIX] + "*" for w in found if len(w) > PREFIX}


@dataclass(frozen=True)
class Model:
    """``weights[k, i]`` is what classifier k gives for word i; ``constant`` is the score where nothing was learnt."""

    words: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    constant: float | None = None

    def score(self, text: str) -> float:
        if self.constant is not None:
            return self.constant
        found = [i for i in map(self.words.get, features(text)) if i is not None]
        logits = self.weights[:, sorted(found)].sum(axis=1) + self.bias
        return float((1 / (1 + np.exp(-np.clip(logits, -40, 40)))).mean())


def fit_linear(
    rows: list[np.ndarray], positive: np.ndarray, features: int, prior: float, seed: int,
    epochs: int = 100, batches: int = 4, rate: float = 0.15, decay: float = 1e-6,
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the sigmoid loss l(f) = s(-f), by Adam over batches.

    ``rows`` hold the features present in each document; ``positive`` marks the confirmed ones.  The loss is bounded,
    so no document weighs more than its share in the difference that estimates the risk on clean text.
    """
    draw = np.random.default_rng(seed)
    held = np.array([len(r) + 1 for r in rows])  # every document also has the bias
    all_flat = np.concatenate([np.r_[r, features] for r in rows]).astype(np.int64)
    first = np.cumsum(held) - held
    w = np.zeros(features + 1)
    w[features] = np.log(prior / (1 - prior))
    m, v, step = np.zeros(features + 1), np.zeros(features + 1), 0
    groups = [np.flatnonzero(positive), np.flatnonzero(~positive)]
    batches = max(1, min(batches, *(len(g) // 8 for g in groups)))
    for _ in range(epochs):
        parts = [np.array_split(draw.permutation(g), batches) for g in groups]
        for p, u in zip(*parts):
            chosen = np.r_[p, u]
            lengths = held[chosen]
            starts = np.cumsum(lengths) - lengths
            flat = all_flat[np.repeat(first[chosen] - starts, lengths) + np.arange(lengths.sum())]
            f = np.add.reduceat(w[flat], starts)
            s = 1 / (1 + np.exp(-np.clip(f, -40, 40)))
            n, steep = len(p), s * (1 - s)
            clean = s[n:].mean() - prior * s[:n].mean()
            slope = np.r_[prior * steep[:n] / n, steep[n:] / len(u)]
            if clean >= 0:
                slope[:n] *= -2
            else:
                slope[n:] *= -1
            grad = np.bincount(flat, np.repeat(slope, lengths), features + 1)
            grad[:features] += decay * w[:features]
            step += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:features], float(w[features])


def _word_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(features(t or "")) for t in batch.column("text").to_pylist()]
        yield pa.record_batch({"toxic": batch.column("toxic"), "words": pa.array(found, pa.list_(pa.string()))})


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the training folds; labels that are null are ignored and repeated ones count as the highest.

    Without a toxic or without an unlabelled example every score is 0.
    """
    known = labels.where(F.col("toxic").isNotNull() & (remainder() != 0)).groupBy("doc_id")
    known = known.agg(F.max("toxic").alias("toxic"))
    total, toxic = known.agg(F.count("doc_id"), F.sum(F.expr("int(toxic = 1)"))).first()
    nothing = Model({}, np.zeros((1, 0)), np.zeros(1), constant=0.0)
    if not toxic:
        return nothing
    prior = min(max(toxic / total, 0.005), 0.5)
    positives = bounded(known.where("toxic = 1").select("doc_id"), POSITIVES, 1).withColumn("toxic", F.lit(True))
    others = docs.where(remainder() != 0).select("doc_id")
    unlabelled = bounded(others, UNLABELLED, 2).withColumn("toxic", F.lit(False))
    sample = with_text(docs, positives.unionByName(unlabelled)).select("toxic", "text")
    sets = materialise(sample.mapInArrow(_word_sets, "toxic boolean, words array<string>"), "sample")
    n1, n0 = sets.agg(F.sum(F.expr("int(toxic)")), F.sum(F.expr("int(not toxic)"))).first()
    if not n1 or not n0:
        return nothing
    share = [F.sum(F.expr(f"int({x})")) / F.lit(float(n)) for x, n in (("toxic", n1), ("not toxic", n0))]
    counted = sets.select("toxic", F.explode("words").alias("word")).groupBy("word")
    counted = counted.agg(F.count("toxic").alias("n"), (share[0] - share[1]).alias("apart"))
    mean = (F.col("n") + 1) / float(n1 + n0 + 2)
    z = F.abs(F.col("apart")) / F.sqrt(mean * (1 - mean) * (1 / n1 + 1 / n0))
    chosen = counted.where((F.col("n") >= 3) & (z >= SIGNIFICANT)).orderBy(z.desc(), "word").limit(FEATURES)
    index = {row.word: i for i, row in enumerate(chosen.select("word").collect())}

    def present(batches):
        for batch in batches:
            rows = [[i for i in map(index.get, row) if i is not None] for row in batch.column("words").to_pylist()]
            yield pa.record_batch({"toxic": batch.column("toxic"), "found": pa.array(rows, pa.list_(pa.int32()))})

    table = sets.mapInArrow(present, "toxic boolean, found array<int>").toArrow()
    positive = table.column("toxic").to_numpy()
    rows = [np.array(sorted(r), np.int64) for r in table.column("found").to_pylist()]
    order = sorted(range(len(rows)), key=lambda i: (positive[i], rows[i].tobytes()))  # the same rows in any order
    rows, positive = [rows[i] for i in order], positive[order]
    fitted = [fit_linear(rows, positive, len(index), prior, seed) for seed in range(CLASSIFIERS)]
    return Model(index, np.array([w for w, _ in fitted]).reshape(CLASSIFIERS, len(index)), np.array([b for _, b in fitted]))


def _scored(model: Model) -> Callable:
    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array([model.score(t or "") for t in column.to_pylist()], pa.float64())

    return scored


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``; every text is read whole, null and empty texts get the classifiers' bias.

    Rows are scored one by one: repeated ones alike, none for an empty table.  A column ``score`` is replaced.
    """
    return docs.withColumn("score", _scored(model)("text"))


def clean(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``least``, all columns as they are."""
    return docs.where(_scored(model)("text") < least)
