"""A bounded sample of labelled documents, and a logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(folds: int = FOLDS) -> Column:
    """crc32(doc_id as text) modulo ``folds`` is 0; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))


def sample_ids(labels: DataFrame, target: str, per_class: int) -> DataFrame:
    """(doc_id, y): at most ``per_class`` documents of each label, least hash first, none held out.

    A document labelled twice counts once, with the larger label.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max(target).cast("int").alias("y"))
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    return parts[0].union(parts[1])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights with the intercept last, means, scales) by Newton steps."""
    mean, scale = (x.mean(0), x.std(0) + 1e-9) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + ridge * len(y) * w
        h = (z * (p * (1 - p))[:, None]).T @ z + (ridge * len(y) + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def logistic_score(model, x: np.ndarray) -> np.ndarray:
    w, mean, scale = model
    return 1 / (1 + np.exp(-np.clip((x - mean) / scale @ w[:-1] + w[-1], -30, 30)))
