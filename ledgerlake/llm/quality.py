"""A quality classifier learned from positive and unlabelled documents.

Documents with a trusted label 1 are the positives; all documents, their labels unread, are the unlabelled ones.
Rows that are held out take no part. The class prior is the share of label 1 among the labelled rows
that may be learned from. A linear model on the shape of a text minimises the unbiased risk

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)])    with    l(z) = log(1 + exp(-z)),

whose second part is kept from going below zero by shortening steps. As l(f) - l(-f) = -f, the risk is
convex and Newton steps need sums over the unlabelled rows only. All rows take part in these sums, which
Spark adds up; the driver gets one number per pair of features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored, work_folder

ship(__name__)

THRESHOLD = 0.7
STEPS = 12
RIDGE = 1e-4
TOLERANCE = 1e-5
BANDS = tuple(bytes(b) for b in (range(97, 123), range(65, 91), range(48, 58), b" ", b"\n", b"|", b"$%&*#@^~", b".,", b"!?;:'\"()-", b"<>[]{}=/\\_+`"))
SHAPES = len(BANDS) + 11
WIDTH = 2 * SHAPES + 1


def shape(text: str) -> list[float]:
    """Shares of kinds of bytes and words, and how much a text repeats itself. Zeros for an empty one."""
    data = text.encode()
    if not data:
        return [0.0] * SHAPES
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = len(data)
    bands = [float(counts[list(b)].sum()) / n for b in BANDS]
    words = text.split()
    k = len(words) or 1
    distinct = len(set(words))
    repeats = sum(map(str.__eq__, words, words[1:]))
    lines = text.split("\n")
    long_words = sum(len(w) > 20 for w in words)
    titled = sum(map(str.istitle, words))
    alone = sum(1 for w in words if not any(c.isalnum() for c in w[:2]))
    return [
        *bands,
        float(counts[128:].sum()) / n,
        float(np.log1p(n)) / 10,
        float(np.log1p(k)) / 10,
        distinct / k,
        float(np.log1p(distinct)) / float(np.log1p(k)) if words else 0.0,
        repeats / k,
        min(n / k, 50.0) / 50,
        len(set(lines)) / len(lines),
        long_words / k,
        titled / k,
        alone / k,
    ]


def shapes(texts) -> np.ndarray:
    return np.array([shape(t or "") for t in texts], np.float32).reshape(-1, SHAPES)


@dataclass(frozen=True)
class Model:
    """Weights over standardised shapes, their squares and one."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def scores(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(widen(raw, self.mean, self.scale) @ self.weights, -30, 30)))


def widen(raw: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((raw.astype(np.float64) - mean) / scale, -8, 8)
    return np.concatenate([z, np.minimum(z * z, 16.0) / 4, np.ones((len(z), 1))], axis=1)


def _summed(rows: DataFrame, sums) -> np.ndarray:
    """The sum over tasks of a vector that ``sums`` makes of each batch of (x, is_positive)."""

    def run(batches):
        total = None
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<f4").reshape(-1, SHAPES)
            here = sums(raw, batch.column(1).to_numpy(zero_copy_only=False))
            total = here if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["k", "v"])

    parts = rows.select("x", "is_positive").mapInArrow(run, "k int, v double")
    found = {r["k"]: r["v"] for r in parts.groupBy("k").agg(F.sum("v").alias("v")).collect()}
    return np.array([found.get(k, 0.0) for k in range(max(found, default=-1) + 1)])


def fit(rows: DataFrame, prior: float, steps: int = STEPS) -> Model:
    """The model that minimises the non-negative risk over rows (x, is_positive)."""

    def moments(raw, positive):
        r = raw.astype(np.float64)
        return np.concatenate([[positive.sum(), len(r) - positive.sum(), len(r)], r.sum(0), (r * r).sum(0)])

    total = _summed(rows, moments)
    if not len(total) or total[0] == 0 or total[1] == 0:
        return Model(np.zeros(SHAPES), np.ones(SHAPES), np.zeros(WIDTH), prior)
    n_positive, n_unlabelled, n = total[:3]
    mean = total[3 : 3 + SHAPES] / n
    scale = np.sqrt(np.maximum(total[3 + SHAPES :] / n - mean**2, 1e-8))

    def centre(raw, positive):
        return widen(raw[positive], mean, scale).sum(0)

    positives = _summed(rows, centre) / n_positive

    def parts(weights):
        def sums(raw, positive):
            x = widen(raw, mean, scale)
            f = x @ weights
            loss, p = np.logaddexp(0, f), 1 / (1 + np.exp(-f))
            u = ~positive
            xu, pu = x[u], p[u]
            return np.concatenate([[loss[u].sum(), loss[positive].sum()], pu @ xu, ((xu * (pu * (1 - pu))[:, None]).T @ xu).ravel()])

        s = _summed(rows, sums)
        negative = s[0] / n_unlabelled - prior * s[1] / n_positive
        risk = prior * (s[1] / n_positive - positives @ weights) + max(0.0, negative) + RIDGE / 2 * weights @ weights
        gradient = s[2 : 2 + WIDTH] / n_unlabelled - prior * positives + RIDGE * weights
        return risk, negative, gradient, s[2 + WIDTH :].reshape(WIDTH, WIDTH) / n_unlabelled + RIDGE * np.eye(WIDTH)

    weights = np.zeros(WIDTH)
    weights[-1] = np.log(max(prior, 1e-3) / max(1 - prior, 1e-3))
    risk, _, gradient, curve = parts(weights)
    for _ in range(steps):
        move, size = np.linalg.solve(curve, gradient), 1.0
        while size > 1e-3:
            there = parts(weights - size * move)
            if there[1] >= 0 and there[0] < risk:
                break
            size /= 2
        else:
            break
        gain = risk - there[0]
        weights = weights - size * move
        risk, _, gradient, curve = there
        if gain < TOLERANCE:
            break
    return Model(mean, scale, weights, prior)


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def shaped(docs: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """(doc_id, held_out, quality, x) of every row, stored. ``quality`` is null without a label.

    Of several labels of one id the smallest counts.
    """
    def run(batches):
        for batch in batches:
            raw = shapes(v.as_py() for v in batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in raw], pa.binary())], names=["doc_id", "x"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, x binary")
    known = labels.select(F.col("doc_id").cast("long"), "quality").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    joined = rows.join(known, "doc_id", "left").withColumn("held_out", held_out(F.col("doc_id")))
    return stored(joined.select("doc_id", "held_out", "quality", "x"), folder, "shapes")


def train(rows: DataFrame) -> Model:
    """The model from the rows of ``shaped`` that are not held out.

    Without positives every score is one half.
    """
    free = rows.filter(~F.col("held_out"))
    n = free.agg(F.count(F.when(F.col("quality") == 1, 1)).alias("good"), F.count("quality").alias("known")).first()
    prior = (n["good"] + 1) / (n["known"] + 2)
    positives = free.filter(F.col("quality") == 1).withColumn("is_positive", F.lit(True))
    return fit(positives.unionByName(free.withColumn("is_positive", F.lit(False))), prior)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    A null text is empty and is scored like any text. Repeated and null ids stay; a null id has no label.
    Neither labels nor any column but the text are inputs of a score. No rows give no rows.
    """
    rows = shaped(docs, labels, work_folder(docs.sparkSession, "quality"))
    model = train(rows)

    def run(batches):
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<f4").reshape(-1, SHAPES)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.scores(raw))], names=["doc_id", "held_out", "score"])

    scored = rows.select("doc_id", "held_out", "x").mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns.

    A null text is scored as an empty one; repeated rows and null ids stay or go by their texts alone. The shape
    of a text is worked out again rather than joined, so that no text is shuffled. No rows give no rows.
    """
    model = train(shaped(docs, labels, work_folder(docs.sparkSession, "quality")))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(shapes(texts)))

    return docs.filter(score(F.col("text")) >= threshold)
