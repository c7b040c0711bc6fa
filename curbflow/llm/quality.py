"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares of byte classes, word shape, repetition within
the line and the document, and the same figures of the lines before and after it; neighbouring
labels are tied by transition weights. Forward-backward gives each line's probability of being
good, and a document's share of good text is the mean of these, weighted by line length. A
logistic curve, fitted on the training documents, turns that share into the score.

Labels exist for documents only, so the lines of good documents are good, and those of bad ones
start as bad; after each round of fitting, lines of bad documents that the field finds good are
taken for good, except that each bad document keeps its worst line as bad.

The fit uses a bounded sample of labelled rows (``FIT_ROWS``); scoring is one pass without a
shuffle, in blocks of whole documents.

Defined results: a null or empty text is one empty line. Null ids are kept, repeated rows are
scored each for itself, a table without labels of both kinds gives every document the share of
label 1 (1 without any labels). Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm import textbytes as tb
from curbflow.llm.classify import held_out, training_rows

THRESHOLD = 0.7
FIT_ROWS = 4_000  # labelled documents that the field is fitted on, at most
ROUNDS, STEPS, RIDGE = 3, 80, 1e-4

_CLASSES = [
    tb.byte_table(lambda b: chr(b).isalpha() and b < 128 or b >= 0xC3),  # letters, by their first byte
    tb.byte_table(lambda b: 65 <= b <= 90),
    tb.byte_table(lambda b: 48 <= b <= 57),
    tb.byte_table(lambda b: b in b".,;:'\"?-()"),
    tb.byte_table(lambda b: b in b"!"),
    tb.byte_table(lambda b: b in b"|/\\<>{}[]=_~^`"),
    tb.byte_table(lambda b: b in b"#$%&*@+"),
]
_INNER = tb.byte_table(lambda b: b not in b" \t\r")
_OWN = len(_CLASSES) + 6
_NEAR = len(_CLASSES) + 2  # of these, also the neighbours' values
WIDTH = 1 + _OWN + 2 * (_NEAR + 1)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, line lengths, n + 1 offsets of each document's lines)."""
    edge = np.zeros(len(data) + 1, bool)
    newline = data == 10
    # a line begins at each document's start and after each newline
    begin = np.sort(np.concatenate([offsets[:-1], np.flatnonzero(newline) + 1]), kind="stable")
    rows = np.concatenate([[0], np.cumsum(np.bincount(np.searchsorted(offsets, np.flatnonzero(newline), side="right") - 1, minlength=len(offsets) - 1) + 1)])
    ends = np.append(begin[1:], len(data))
    ends = ends - ((ends > begin) & (np.append(newline, False)[np.maximum(ends - 1, 0)]))
    ends[rows[1:] - 1] = offsets[1:]
    length = ends - begin
    size = np.maximum(length, 1)
    sums = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    count = lambda mask: (lambda s: s[ends] - s[begin])(sums(mask))
    shares = [count(table[data]) / size for table in _CLASSES]
    shares[1] = shares[1] * size / np.maximum(1, shares[0] * size)  # capitals among letters
    starts, stops = tb.runs(_INNER[data] & ~newline, offsets, edge[:-1])
    first, last = np.searchsorted(starts, begin), np.searchsorted(starts, ends)
    words = last - first
    hashes = tb.span_hash(tb.prefix_sums(data), starts, stops)
    line = np.repeat(np.arange(len(begin)), words)
    new = np.unique(np.stack([line.astype(np.uint64), hashes]), axis=1)[0].astype(np.int64) if len(line) else line
    distinct = np.bincount(new, minlength=len(begin)) / np.maximum(words, 1)
    distinct[words == 0] = 1
    repeated = np.where(words >= 8, 1 - distinct, 0)
    whole = tb.span_hash(tb.prefix_sums(data), begin, ends)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(rows))
    key = whole ^ tb.mixed(doc.astype(np.uint64) + np.uint64(1))
    _, at = np.unique(key, return_index=True)
    again = np.ones(len(begin))
    again[at] = 0
    own = np.stack(
        [*shares, 1 - distinct, repeated, again * (length > 0), np.log1p(length) / 8, np.minimum(length / np.maximum(words, 1), 40) / 10, (length == 0) * 1.0],
        axis=1,
    )
    near = own[:, :_NEAR]
    out = np.zeros((len(begin), WIDTH), np.float32)
    out[:, 0] = 1
    out[:, 1 : 1 + _OWN] = own
    has_before, has_after = np.ones(len(begin), bool), np.ones(len(begin), bool)
    has_before[rows[:-1]] = False
    has_after[rows[1:] - 1] = False
    a, b = 1 + _OWN, 1 + _OWN + _NEAR + 1
    out[1:, a : a + _NEAR] = near[:-1]
    out[:, a : a + _NEAR] *= has_before[:, None]
    out[:, a + _NEAR] = ~has_before
    out[:-1, b : b + _NEAR] = near[1:]
    out[:, b : b + _NEAR] *= has_after[:, None]
    out[:, b + _NEAR] = ~has_after
    return out, length, rows


def forward_backward(scores: np.ndarray, rows: np.ndarray, transitions: np.ndarray):
    """Marginals of state 1 (good) of each line, and expected transition counts.

    ``scores`` are the lines' log potentials for good against bad; documents go side by side.
    """
    psi = np.exp(np.stack([-np.logaddexp(0, scores), -np.logaddexp(0, -scores)], axis=1))
    psi = np.maximum(psi, 1e-12)
    a = np.exp(transitions - transitions.max())
    order = np.argsort(-np.diff(rows), kind="stable")
    start, n = rows[:-1][order], np.diff(rows)[order]
    longest = int(n[0]) if len(n) else 0
    alive = np.searchsorted(-n, -np.arange(longest), side="left")  # documents with more than t lines
    forward, backward = np.zeros_like(psi), np.ones_like(psi)
    expected = np.zeros((2, 2))
    for t in range(longest):
        at = start[: alive[t]] + t
        message = psi[at] if t == 0 else (forward[at - 1] @ a) * psi[at]
        forward[at] = message / message.sum(1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        at = start[: alive[t + 1]] + t
        message = (backward[at + 1] * psi[at + 1]) @ a.T
        backward[at] = message / message.sum(1, keepdims=True)
    both = forward * backward
    marginal = both / both.sum(1, keepdims=True)
    inner = np.ones(len(scores), bool)
    inner[rows[1:][np.diff(rows) > 0] - 1] = False
    i = np.flatnonzero(inner)
    if len(i):
        joint = forward[i][:, :, None] * a[None] * (psi[i + 1] * backward[i + 1])[:, None, :]
        expected = (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    return marginal[:, 1], expected, i


@dataclass
class QualityModel:
    weights: np.ndarray
    transitions: np.ndarray
    slope: float
    shift: float

    def lines(self, data: np.ndarray, offsets: np.ndarray):
        features, length, rows = line_features(data, offsets)
        good, _, _ = forward_backward(features @ self.weights, rows, self.transitions)
        return good, length, rows

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        good, length, rows = self.lines(data, offsets)
        return 1 / (1 + np.exp(-np.clip(self.slope * share(good, length, rows) + self.shift, -50, 50)))


def share(good: np.ndarray, length: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The length-weighted mean of the lines' probabilities."""
    weight = np.maximum(length, 1)
    return np.add.reduceat(good * weight, rows[:-1]) / np.add.reduceat(weight, rows[:-1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = FIT_ROWS) -> QualityModel:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.utf8(batch.column(0))
            kinds = batch.column(1).to_pylist()
            for first, last in tb.blocks(offsets):
                part = data[offsets[first] : offsets[last]]
                features, length, rows = line_features(part, offsets[first : last + 1] - offsets[first])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kinds[first:last], pa.int32()),
                        pa.array([features[a:b].tobytes() for a, b in zip(rows, rows[1:])], pa.binary()),
                        pa.array([length[a:b].astype(np.int64).tobytes() for a, b in zip(rows, rows[1:])], pa.binary()),
                    ],
                    names=["label", "features", "lengths"],
                )

    sample = training_rows(docs, labels, label, limit).mapInArrow(task, "label int, features binary, lengths binary").toPandas()
    sample = sample.sort_values(["label", "lengths", "features"], ignore_index=True)
    y = sample["label"].to_numpy()
    if len(set(y)) < 2:
        known = float(np.clip(y.mean() if len(y) else 1.0, 1e-9, 1 - 1e-9))
        return QualityModel(np.zeros(WIDTH), np.zeros((2, 2)), 0.0, float(np.log(known / (1 - known))))
    x = np.concatenate([np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in sample["features"]]).astype(float)
    parts = [np.frombuffer(b, np.int64) for b in sample["lengths"]]
    length, rows = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    doc = np.repeat(np.arange(len(y)), np.diff(rows))
    target = y[doc].astype(float)
    weights, transitions = np.zeros(WIDTH), np.zeros((2, 2))
    for _ in range(ROUNDS):
        weights, transitions = _descend(x, rows, target, weights, transitions)
        good, _, _ = forward_backward(x @ weights, rows, transitions)
        target = np.where(y[doc] == 1, 1.0, (good > 0.5) * 1.0)
        worst = np.lexsort((good, doc))[rows[:-1]]
        target[worst[y == 0]] = 0.0
    slope, shift = _logistic(share(good, length, rows), y)
    return QualityModel(weights, transitions, slope, shift)


def _adam(parameters: np.ndarray, gradient, steps: int, rate: float) -> np.ndarray:
    m, v = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, steps + 1):
        g = gradient(parameters)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        parameters = parameters - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return parameters


def _descend(x, rows, target, weights, transitions):
    """Minimises the field's negative log-likelihood of the given line labels."""
    state = target.astype(int)

    def gradient(p):
        good, expected, inner = forward_backward(x @ p[:WIDTH], rows, p[WIDTH:].reshape(2, 2))
        seen = np.bincount(2 * state[inner] + state[inner + 1], minlength=4).reshape(2, 2)
        return np.concatenate([x.T @ (good - target) / len(x) + RIDGE * p[:WIDTH], ((expected - seen) / len(x)).ravel()])

    out = _adam(np.concatenate([weights, transitions.ravel()]), gradient, STEPS, 0.2)
    return out[:WIDTH], out[WIDTH:].reshape(2, 2)


def _logistic(value: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    def gradient(p):
        d = (1 / (1 + np.exp(-np.clip(p[0] * value + p[1], -50, 50))) - y) / len(y)
        return np.array([d @ value, d.sum()])

    slope, shift = _adam(np.array([10.0, -5.0]), gradient, 500, 0.2)
    return float(slope), float(shift)


def score(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        data, offsets = tb.utf8(pa.array(texts, pa.string(), from_pandas=True))
        out = np.zeros(len(texts))
        for first, last in tb.blocks(offsets):
            out[first:last] = model.scores(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        return pd.Series(out)

    out = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), scored(F.col("text").cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
