"""Quality classifier: histogram gradient-boosted trees over statistics of a document."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import named, stored

#: Bound of the labelled rows that training sees (about; a share by hash of the id).
TRAINING_ROWS = 20_000
BINS, DEPTH, TREES, RATE, SMOOTH, LEAST = 64, 4, 60, 0.15, 1.0, 4.0
FEATURES = 18

_BYTES = np.arange(256)
_CLASSES = np.stack([
    (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 97) & (_BYTES <= 122),
    (_BYTES >= 48) & (_BYTES <= 57), np.isin(_BYTES, list(b".,;:?'\"()-")),
    np.isin(_BYTES, list(b"#*$%&|<>@~^_=+{}[]\\/`")), _BYTES == 33, _BYTES == 124, _BYTES >= 128,
]).T.astype(float)


def statistics(text: str | None) -> list[float]:
    """Shares and averages of the whole text; all 0 for a null or empty one."""
    data = (text or "").encode()
    found = data.split()
    if not found:
        return [0.0] * FEATURES
    n = len(found)
    classes = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASSES
    letters = max(classes[0] + classes[1] + classes[7], 1.0)
    lines = [line for line in map(bytes.strip, data.split(b"\n")) if line]
    often = Counter(found)
    threes = Counter(zip(found, found[1:], found[2:]))
    repeated = sum(c for c in threes.values() if c > 1)
    return [
        np.log1p(n), sum(map(len, found)) / n, len(often) / n, often.most_common(1)[0][1] / n,
        repeated / max(n - 2, 1), len(set(lines)) / max(len(lines), 1), n / max(len(lines), 1),
        sum(line[-1:] in (b".", b"?", b"!") for line in lines) / max(len(lines), 1),
        classes[0] / letters, classes[1] / letters, classes[2] / len(data), classes[3] / n,
        classes[4] / n, classes[5] / n, classes[6] / n, classes[7] / letters,
        sum(len(w) == 1 for w in found) / n, max(map(len, found)) / 100,
    ]


def features(text: Column) -> Column:
    def each(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    return F.pandas_udf(each, "array<double>")(text)


class Trees(NamedTuple):
    """All trees as arrays. Node i of a tree has children 2i + 1 and 2i + 2; leaves follow."""
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Every row walks down all trees at once."""
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(DEPTH):
            value = np.take_along_axis(x, self.feature[trees, at], axis=1)
            at = 2 * at + 1 + (value > self.threshold[trees, at])
        return self.base + self.leaf[trees, at - self.feature.shape[1]].sum(axis=1)


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    """Boosting on logistic loss; splits are sought over sums per bin of each feature.

    Without labels of both kinds the score is the share of label 1, smoothed.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    nodes = 2**DEPTH - 1
    feature = np.zeros((trees, nodes), np.int64)
    threshold = np.full((trees, nodes), np.inf)
    leaf = np.zeros((trees, nodes + 1))
    if len(set(y.tolist())) < 2:
        return Trees(feature, threshold, leaf, base)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], axis=1)
    cells = binned + np.arange(x.shape[1]) * BINS
    score = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(at == node)
                split = _best_split(cells[rows], gradient[rows], weight[rows], x.shape[1])
                if split is not None and split[1] < len(edges[split[0]]):
                    feature[t, node], threshold[t, node] = split[0], edges[split[0]][split[1]]
                right = x[rows, feature[t, node]] > threshold[t, node]
                at[rows] = 2 * node + 1 + right
        ends = at - nodes
        total = np.bincount(ends, gradient, nodes + 1)
        leaf[t] = RATE * total / (np.bincount(ends, weight, nodes + 1) + SMOOTH)
        score += leaf[t, ends]
    return Trees(feature, threshold, leaf, base)


def _best_split(cells: np.ndarray, gradient: np.ndarray, weight: np.ndarray, n: int):
    """Feature and bin after which to split, or None if no split is worth it."""
    flat = cells.ravel()
    g = np.bincount(flat, np.repeat(gradient, n), n * BINS).reshape(n, BINS).cumsum(axis=1)
    w = np.bincount(flat, np.repeat(weight, n), n * BINS).reshape(n, BINS).cumsum(axis=1)
    all_g, all_w = gradient.sum(), weight.sum()
    gain = g**2 / (w + SMOOTH) + (all_g - g) ** 2 / (all_w - w + SMOOTH)
    gain[(w < LEAST / 4) | (all_w - w < LEAST / 4)] = -np.inf
    best = int(gain.argmax())
    worth = gain.flat[best] > all_g**2 / (all_w + SMOOTH) + 1e-9
    return divmod(best, BINS) if worth else None


def training_rows(measured: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``id``, ``label`` and the other columns of about ``most`` labelled rows.

    The share that is taken depends on the number of labels alone, the choice on a hash of the
    id. Of several labels of one id the smallest counts; null labels do not.
    """
    known = labels.select(named("doc_id").alias("id"), named(label).alias("label")).where(
        "label IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(F.min("label").alias("label"))
    count = known.count()
    chosen = known
    if count > most:
        chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int((1 << 20) * most / count))
    return measured.join(chosen, "id")


def quality_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id",
                   text_column: str = "text", label: str = "quality",
                   training: int = TRAINING_ROWS,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Every row as the struct ``row`` of ``columns`` (all), with ``score``: the chance of label 1.

    ``labels`` holds doc_id and the label; whoever holds rows out leaves them out of it. Texts
    are read once, for their statistics; training and scoring work on these. Null and
    empty texts are scored like any other, from zeros. Rows with a null id are scored but never
    trained on, repeated rows score alike. Of several texts under one id the one with the least
    statistics is learned from. Without labels every score is 0.5.
    """
    measured = stored(docs.select(
        F.struct(*[named(c) for c in columns or docs.columns]).alias("row"),
        named(id_column).alias("id"), features(named(text_column)).alias("features"),
    ), "quality-features")
    sample = training_rows(measured.select("id", "features"), labels, label, training)
    least = F.min(F.struct("features", "label")).alias("x")
    rows = sorted(sample.groupBy("id").agg(least).select("id", "x.features", "x.label").collect())
    x = np.array([r["features"] for r in rows], float).reshape(-1, FEATURES)
    y = np.array([r["label"] for r in rows], float)
    model = docs.sparkSession.sparkContext.broadcast(train(x, y))

    def score(values: pd.Series) -> pd.Series:
        x = np.array(values.tolist(), float).reshape(-1, FEATURES)
        return pd.Series(1 / (1 + np.exp(-model.value.logits(x))))

    return measured.select("row", F.pandas_udf(score, "double")("features").alias("score"))
