"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are complete and lie flat in two arrays, so a batch of documents goes through all trees level by level in
numpy.  Fitting uses a bounded sample of labelled documents (``LABELLED``); every text is scored whole.
"""

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.llm.sampling import bounded, with_text
from pricebars.llm.text import remainder, texts
from pricebars.sources.store import materialise

LABELLED = 20_000
TREES, DEPTH, BINS = 120, 4, 64
RATE, RIDGE, LEAST = 0.1, 1.0, 5.0

#: Classes of bytes whose shares are statistics.
_CLASSES = (
    bytes(range(ord("A"), ord("Z") + 1)), bytes(range(ord("a"), ord("z") + 1)), b"0123456789", b" ", b"\n", b".", b",",
    b"!?", b"\"'()-:;", b"#$%&*+/<=>@[]^_`{|}~\\", bytes(range(128, 256)), b"aeiouAEIOU", bytes(range(32)),
)
STATISTICS = len(_CLASSES) + 17


def statistics(text: bytes) -> list[float]:
    """Statistics of one whole text; an empty one has zeros."""
    if not text:
        return [0.0] * STATISTICS
    size = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = [float(counts[list(c)].sum()) / size for c in _CLASSES]
    used = counts[counts > 0] / size
    found = text.split()
    n = len(found)
    repeated = Counter(found)
    lengths = np.fromiter(map(len, found), np.int64, n) if n else np.zeros(1, np.int64)
    lines = text.split(b"\n")
    line_lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    top = max(repeated.values(), default=0)
    return [
        *shares,
        float(-(used * np.log2(used)).sum()),
        float(counts.max()) / size,
        float(np.log1p(size)),
        float(np.log1p(n)),
        len(repeated) / max(n, 1),
        top / max(n, 1),
        sum(map(eq, found, found[1:])) / max(n, 1),
        sum(map(eq, found, found[2:])) / max(n, 1),
        float(lengths.mean()),
        float(lengths.std()),
        float(lengths.max()),
        float((lengths <= 2).mean()),
        float((lengths >= 12).mean()),
        float(np.log1p(len(lines))),
        len(set(lines)) / len(lines),
        float(line_lengths.std() / (line_lengths.mean() + 1)),
        len(zlib.compress(text, 1)) / size,
    ]


@dataclass(frozen=True)
class Forest:
    """``feature[t, node]`` and ``limit[t, node]`` of inner nodes, heap-ordered; ``value[t, leaf]``."""

    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        logit = np.full(len(x), self.start)
        trees = np.arange(len(self.feature))[None, :]
        for begin in range(0, len(x), 4096):
            part = x[begin : begin + 4096]
            node = np.zeros((len(part), len(self.feature)), np.int64)
            if node.size:
                rows = np.arange(len(part))[:, None]
                for _ in range(int(np.log2(self.value.shape[1]))):
                    node = 2 * node + 1 + (part[rows, self.feature[trees, node]] > self.limit[trees, node])
                logit[begin : begin + 4096] += self.value[trees, node - self.feature.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Forest:
    """Boosted trees with logistic loss; each level is split on histograms of gradients over quantile bins."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    start = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), start)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    width, count = bins, x.shape[1]
    logit = np.full(len(y), start)
    feature, limit = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, here = (1 << level) - 1, 1 << level
            slot = (node - first) * width
            sums = np.array([[np.bincount(slot + b, s, here * width) for b in binned.T] for s in (g, h)])
            left = sums.reshape(2, count, here, width).cumsum(axis=3)
            whole = left[..., -1:]
            right = whole - left
            gain = (left[0] ** 2 / (left[1] + RIDGE) + right[0] ** 2 / (right[1] + RIDGE)
                    - whole[0] ** 2 / (whole[1] + RIDGE))
            gain[(left[1] < LEAST / 4) | (right[1] < LEAST / 4)] = 0
            best = gain.transpose(1, 0, 2).reshape(here, -1)
            pick = best.argmax(axis=1)
            for k in range(here):
                f, b = divmod(int(pick[k]), width)
                if best[k, pick[k]] > 1e-9 and b < len(edges[f]):
                    feature[t, first + k], limit[t, first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > limit[t, node])
        leaf = node - inner
        value[t] = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + RIDGE)
        logit += value[t, leaf]
    return Forest(feature, limit, value, start)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [statistics(t) for t in texts(batch.column("text"))]
        yield pa.record_batch({"quality": batch.column("quality"), "x": pa.array(found, pa.list_(pa.float64()))})


def fit(docs: DataFrame, labels: DataFrame) -> Forest:
    """Trees from the training folds; null labels are ignored, repeated ones count as the highest.

    Without labels every score is one half, with labels of one kind the smoothed share of label 1.
    """
    known = labels.where(F.col("quality").isNotNull() & (remainder() != 0)).groupBy("doc_id")
    sample = bounded(known.agg(F.max("quality").alias("quality")), LABELLED, 3)
    measured = with_text(docs, sample).select("quality", "text").mapInArrow(_measured, "quality int, x array<double>")
    table = materialise(measured, "statistics").toArrow()
    y = table.column("quality").to_numpy().astype(np.float64)
    x = np.array(table.column("x").to_pylist()).reshape(len(y), STATISTICS)
    order = np.lexsort((*x.T, y))  # the same trees whatever order the rows come in
    return fit_forest(x[order], y[order])


def score(docs: DataFrame, model: Forest) -> DataFrame:
    """``docs`` with ``score``; every text is read whole, null and empty ones score alike."""
    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        x = np.array([statistics(t) for t in texts(column)]).reshape(-1, STATISTICS)
        return pa.array(model.score(x), pa.float64())

    return docs.withColumn("score", scored("text"))
