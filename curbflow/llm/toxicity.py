"""A toxicity classifier with a counterfactual penalty.

Features are the distinct lower-case words of a text (runs of letters). The vocabulary is chosen
by how much a word tells about the label; a logistic regression learns a weight for each word. In
every labelled text that mentions a group, the identity terms are swapped for others, and for a
neutral word, and the squared change of the score is part of the loss: a word that only names a
group can then not carry the verdict, and neutral mentions are not taken for attacks. Identity
terms are always in the vocabulary, so that the penalty can hold them.

The model is fitted on a bounded sample of labelled rows (``training_rows``): word counts by label
come from one grouped pass over the sample, and the fit sees a matrix of at most ``limit`` rows and
``VOCABULARY`` columns. Scoring is one pass over the documents without a shuffle.

Defined results: a null or empty text has no words and gets the score of the intercept alone.
Null ids are kept. Repeated rows are scored each for itself. Without labelled rows of both kinds
every score is the share of label 1 (0 without any labels). Only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.classify import TRAINING_ROWS, held_out, training_rows
from curbflow.llm.workers import give_back, lean

THRESHOLD = 0.3
VOCABULARY = 4096
LEAST_TEXTS = 3  # a word of fewer sampled texts is no feature
SMOOTHING = 0.5
RIDGE = 1e-3
PENALTY = 10.0
NEUTRAL = "people"

# Groups of identity terms that may stand for one another.
IDENTITY_TERMS = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"], ["girl", "boy"], ["female", "male"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino"], ["gay", "straight", "lesbian", "bisexual", "transgender"],
    ["immigrants", "natives", "refugees"], ["old", "young"], ["disabled", "blind", "deaf"],
    ["frauen", "männer"], ["muslime", "christen", "juden"], ["femmes", "hommes"],
    ["musulmans", "chrétiens", "juifs"], ["mujeres", "hombres"], ["musulmanes", "cristianos", "judíos"],
]

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    intercept: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        known = self.weights.keys()
        logits = np.array([sum(sorted(map(self.weights.__getitem__, known & words(t)))) for t in texts], float)
        return 1 / (1 + np.exp(-np.clip(logits + self.intercept, -50, 50)))


def word_counts(sample: DataFrame) -> DataFrame:
    """Of each word: texts that hold it, by label (word, plain, toxic)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
                for word in words(text):
                    counts.setdefault(word, [0, 0])[label] += 1
            columns = [pa.array(counts, pa.string()), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "plain", "toxic"])

    partial = sample.mapInArrow(lean(task), "word string, plain long, toxic long")
    return partial.groupBy("word").agg(F.sum("plain").alias("plain"), F.sum("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = TRAINING_ROWS, penalty: float = PENALTY) -> ToxicityModel:
    sample = training_rows(docs, labels, label, limit).persist()
    try:
        totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
        plain, toxic = totals.get(0, 0), totals.get(1, 0)
        if not plain or not toxic:
            share = np.clip(toxic / max(1, plain + toxic), 1e-9, 1 - 1e-9)
            return ToxicityModel({}, float(np.log(share / (1 - share))))
        a, b = (F.col("toxic") + SMOOTHING) / (toxic + 2 * SMOOTHING), (F.col("plain") + SMOOTHING) / (plain + 2 * SMOOTHING)
        ratio = F.log(a / (1 - a)) - F.log(b / (1 - b))
        telling = (
            word_counts(sample).where(F.col("plain") + F.col("toxic") >= LEAST_TEXTS)
            # how much the word's presence tells: share of texts times evidence
            .select("word", ratio.alias("ratio"), (F.abs(a - b) * F.abs(ratio)).alias("use"))
            .orderBy(F.desc("use"), "word").limit(VOCABULARY).collect()
        )
        scale = {r["word"]: r["ratio"] for r in telling}
        terms = [t for group in IDENTITY_TERMS for t in group] + [NEUTRAL]
        vocabulary = sorted(scale.keys() | set(terms))
        at = {w: i for i, w in enumerate(vocabulary)}
        # log-count ratios scale the features; identity terms start from 1
        scales = np.array([scale.get(w, 1.0) for w in vocabulary])
        x, y, swapped, origin = _matrix(sample, at)
        w, intercept = _descend(x, y, swapped, origin, scales, penalty)
        return ToxicityModel({v: float(c) for v, c in zip(vocabulary, w * scales) if c}, intercept)
    finally:
        sample.unpersist()
        give_back()


def swaps(present: set[str]) -> list[set[str]]:
    """The text's words with each mentioned identity term in another's place, and in a neutral word's."""
    out = []
    for group in IDENTITY_TERMS:
        for term in present.intersection(group):
            rest = present - {term}
            out += [rest | {other} for other in group if other != term and other not in present]
            out.append(rest | {NEUTRAL})
    return out


def _matrix(sample: DataFrame, at: dict[str, int]):
    """Sparse rows (as flat column lists) of the sample and of its counterfactuals."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
                present = words(text)
                number = lambda s: sorted(at[w] for w in s if w in at)
                rows.append((label, number(present), [number(s) for s in swaps(present)]))
            lists = pa.list_(pa.int32())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), lists, pa.list_(lists)))]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "own", "swapped"])

    rows = sample.mapInArrow(lean(task), "label int, own array<int>, swapped array<array<int>>").toArrow()
    labels, own, many = rows["label"].to_numpy(), _arrays(rows["own"]), [_arrays(m) for m in rows["swapped"]]
    order = sorted(range(len(own)), key=lambda i: (labels[i], own[i].astype(">i4").tobytes()))
    swapped = [s for i in order for s in many[i]]
    origin = np.repeat(np.arange(len(order)), [len(many[i]) for i in order])
    return _Sparse([own[i] for i in order], len(at)), labels[order].astype(float), _Sparse(swapped, len(at)), origin


def _arrays(lists) -> list[np.ndarray]:
    """The rows of an Arrow column (or a list scalar) of integer lists."""
    return [row.values.to_numpy() for row in (lists.values if isinstance(lists, pa.ListScalar) else lists)]


class _Sparse:
    """A 0/1 matrix by rows: products with a vector from both sides."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.width, self.n = width, len(rows)
        self.columns = np.concatenate(rows).astype(int) if rows else np.zeros(0, int)
        self.rows = np.repeat(np.arange(self.n), [len(r) for r in rows]) if rows else np.zeros(0, int)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, w[self.columns], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, g[self.rows], self.width)


def _descend(x: _Sparse, y: np.ndarray, swapped: _Sparse, origin: np.ndarray, scales: np.ndarray, penalty: float, steps: int = 300):
    """Adam on the logistic loss, a ridge, and the squared score changes under swaps."""
    n, w, b = len(y), np.zeros(x.width), 0.0
    m, v = np.zeros(x.width + 1), np.zeros(x.width + 1)
    for step in range(1, steps + 1):
        ws = w * scales
        logits = x.times(ws) + b
        g = (1 / (1 + np.exp(-np.clip(logits, -50, 50))) - y) / n
        gradient, gb = x.back(g) * scales + RIDGE * w, g.sum()
        if swapped.n:
            change = swapped.times(ws) - x.times(ws)[origin]
            c = 2 * penalty * change / swapped.n
            gradient += (swapped.back(c) - x.back(np.bincount(origin, c, n))) * scales
        full = np.append(gradient, gb)
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def _scored(model: ToxicityModel):
    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        scores = pa.array(model.score(texts.to_pylist()))
        give_back()
        return scores

    return scored


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""

    scored = _scored(model)
    out = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), scored(F.col("text").cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with their columns."""

    return docs.where(_scored(model)(F.col("text").cast("string")) < threshold)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model)
