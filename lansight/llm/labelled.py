"""Labelled documents and small model fits shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lansight.llm.common import ship, within

ship(__name__)

#: Labels are broadcast up to this many rows (two small columns); beyond it the join is a shuffled one.
BROADCAST_LABELS = 2_000_000


def remainder(modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo (null ids: as the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column) -> DataFrame:
    """(doc_id, text, label) of the documents with a label that may be learnt from.  A doc_id with
    several labels counts with the largest; null labels and null ids are no labels."""
    own = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(learn).groupBy("doc_id") \
        .agg(F.max("label").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    if within(labels, BROADCAST_LABELS):
        own = F.broadcast(own)
    return docs.select("doc_id", "text").join(own, "doc_id")


def sample_labels(labels: DataFrame, label: str, learn: Column, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, the same ones each time: those of the smallest hash."""
    return labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select("doc_id", label) \
        .distinct().orderBy(F.xxhash64("doc_id"), "doc_id", label).limit(rows)


def fit_logistic(x, y, ridge: float = 1.0, steps: int = 30):
    """Weights (the last is the bias) of a logistic regression, by Newton steps on standardised columns;
    returned for the columns as they are.  One class only, or no rows: a bias alone."""
    import numpy as np

    x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
    width = x.shape[1]
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 0.5) / (len(y) + 1.0)
        return np.concatenate([np.zeros(width), [np.log(p / (1 - p))]])
    mean, dev = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.column_stack([(x - mean) / dev, np.ones(len(x))])
    w = np.zeros(width + 1)
    pull = np.concatenate([np.full(width, ridge), [1e-6]])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + pull * w
        h = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(pull)
        move = np.linalg.solve(h, g)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    slope = w[:-1] / dev
    return np.concatenate([slope, [w[-1] - (slope * mean).sum()]])


def logistic(x, w):
    import numpy as np

    return 1.0 / (1.0 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
