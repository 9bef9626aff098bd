"""Toxicity: linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios.

Features are the distinct lower-cased n-grams (``SIZES`` characters) of a text, hashed into ``2 ** CELLS`` cells. From labelled rows come
document counts per cell and class; a cell's log-count ratio scales its feature, and a logistic regression on the
``FEATURES`` cells whose shares in the two classes differ most, in standard errors, gives the weights.

Training uses at most ``TRAIN_ROWS`` labelled rows of each class, those with the smallest hash of their id. So what the join broadcasts and
what one task gathers for the regression are bounded; the classes' true shares, counted over all labelled rows, correct
the intercept. Scoring is one pass over all documents without a shuffle.

Defined results: a null or empty text has no features and scores by the intercept alone; without labelled rows of both classes the score is
the share of toxic rows (0.0 if there are no rows); labels of repeated ids count once, toxic if any says so; extra columns stay in ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.arrays import LOWER, U64, Sums, slices, text_of, tidy, whole

SIZES = (3, 4, 5)
CELLS = 18
TRAIN_ROWS = 6000
FEATURES = 1000
STEPS = 300
RIDGE = 1e-4
RATE = 0.05


def _grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, cell) of all n-grams of one size after another."""
    lower = LOWER[data]
    start = np.flatnonzero((data & 0xC0) != 0x80)
    row = np.searchsorted(offsets, start, side="right") - 1
    ends, sums = np.append(start, len(data)), Sums(lower)
    for size in SIZES:
        if len(start) >= size:
            whole_ = row[size - 1 :] == row[: len(row) - size + 1]
            at = np.flatnonzero(whole_)
            yield row[at], (sums.of(start[at], ends[at + size]) >> U64(64 - CELLS)).astype(np.int64)


def _features(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, cell), ascending; only ``wanted`` cells if given."""
    keys = [np.zeros(0, dtype=np.int64)]
    for row, cell in _grams(data, offsets):
        if wanted is not None:
            on = wanted[cell]
            row, cell = row[on], cell[on]
        keys.append((row << CELLS) | cell)
    key = np.sort(np.concatenate(keys))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]] if len(key) else key
    return key >> CELLS, key & ((1 << CELLS) - 1)


def _regression(row: np.ndarray, feature: np.ndarray, label: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of scaled 0/1 features by gradient steps with momentum and scaling (Adam), classes weighted alike."""
    n, k = len(label), len(scale)
    cost = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    w, b = np.zeros(k + 1), 0.0
    first, second = np.zeros(k + 1), np.zeros(k + 1)
    value = scale[feature]
    for t in range(1, STEPS + 1):
        margin = np.bincount(row, weights=value * w[feature], minlength=n) + b
        error = cost * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label)
        slope = np.bincount(feature, weights=value * error[row], minlength=k + 1)
        slope[k] = error.sum()
        slope[:k] += RIDGE * w[:k]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        step = RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        w[:k] -= step[:k]
        b -= step[k]
    return w[:k] * scale, b


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Weight per cell and intercept; ``labels`` are the rows to learn from."""
    known = labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull()).groupBy(F.col(id).alias("id")).agg(F.max(label).cast("int").alias("label"))
    share = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    weights, total = np.zeros(1 << CELLS, dtype=np.float32), sum(share.values())
    if not share.get(0) or not share.get(1):
        odds = share.get(1, 0) / total if total else 0.0
        return weights, 30.0 if odds == 1 else -30.0
    part = lambda y: known.filter(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(train_rows)
    sample = F.broadcast(part(0).union(part(1)))  # at most 2 * train_rows rows of 12 bytes
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).join(sample, "id").select("label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts = np.zeros((2, 1 << CELLS), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            for first, n, data, offsets in slices(batch.column(1)):
                row, cell = _features(data, offsets)
                own = y[first : first + n]
                for c in (0, 1):
                    seen[c] += np.bincount(cell[own[row] == c], minlength=1 << CELLS)
                    texts[c] += int((own == c).sum())
        full = np.flatnonzero(seen.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(full, -1)), pa.array(np.append(seen[0, full], texts[0])), pa.array(np.append(seen[1, full], texts[1]))], names=["cell", "n0", "n1"])

    counted = rows.mapInArrow(tidy(count), "cell long, n0 long, n1 long").groupBy("cell").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    cell, n = counted["cell"].to_numpy(), np.stack([counted["n0"].to_numpy(), counted["n1"].to_numpy()])
    texts, n, cell = n[:, cell < 0].sum(axis=1), n[:, cell >= 0], cell[cell >= 0]
    ratio = np.log((n[1] + 1) / (texts[1] + 2)) - np.log((n[0] + 1) / (texts[0] + 2))
    share_of = n / texts[:, None]
    error = np.sqrt((share_of * (1 - share_of) / texts[:, None]).sum(axis=0) + 1e-6)
    best = np.argsort(-np.abs(share_of[1] - share_of[0]) / error, kind="stable")[:FEATURES]
    chosen, scale = cell[best], ratio[best]
    number = np.full(1 << CELLS, -1, dtype=np.int32)
    number[chosen] = np.arange(len(chosen))

    def reduce_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n_, data, offsets in slices(batch.column(1)):
                row, cell_ = _features(data, offsets, number >= 0)
                split = np.searchsorted(row, np.arange(n_ + 1))
                own = number[cell_]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n_), pa.array([own[a:b].tobytes() for a, b in zip(split[:-1], split[1:])], pa.binary())], names=["label", "features"])

    def train(table: pd.DataFrame) -> pd.DataFrame:
        features = [np.frombuffer(x, dtype=np.int32) for x in table["features"]]
        row = np.repeat(np.arange(len(features)), [len(x) for x in features])
        w, b = _regression(row, np.concatenate(features).astype(np.int64), table["label"].to_numpy(), scale)
        return pd.DataFrame({"weights": [w.astype("<f8").tobytes()], "intercept": [b]})

    # One task, of bounded size: at most 2 * train_rows texts by their chosen features.
    model = rows.mapInArrow(tidy(reduce_), "label int, features binary").groupBy().applyInPandas(train, "weights binary, intercept double").first()
    if model is None:
        return weights, float(np.log(share[1] / share[0]))
    weights[chosen] = np.frombuffer(model["weights"], dtype="<f8")
    # The classes weighed alike in training; their true shares move the line.
    return weights, float(model["intercept"] + np.log(share[1] / share[0]))


def toxicity(docs: DataFrame, weights: np.ndarray, intercept: float, text: str = "text") -> DataFrame:
    """One row per document: ``doc`` and score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    at = docs.columns.index(text)
    rows = docs.select(whole(docs))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for first, n, data, offsets in slices(text_of(batch, at)):
                row, cell = _features(data, offsets, w != 0)
                margin = np.bincount(row, weights=w[cell], minlength=n) + intercept
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(1 / (1 + np.exp(-np.clip(margin, -500, 500))))], names=["doc", "score"])

    return rows.mapInArrow(tidy(score), T.StructType([rows.schema["doc"], T.StructField("score", T.DoubleType())]))
