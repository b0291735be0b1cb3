"""Small linear models and bounded training samples, shared by the two classifiers."""

from __future__ import annotations

import dataclasses

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from sparkledger.llm.common import store

FOLDS = 5


def fold(id_column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id has the remainder of the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % FOLDS


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, n: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, y) of at most n rows of each label (0 or 1), stored, and how many ids each label has.

    Only rows that are not held out are taken, by the hash of the id. An id that is labelled twice has the larger
    label; labels without a document or text fall away. The ids are chosen first: as there are 2 n of them at most,
    they can be broadcast, and no other text moves.
    """
    y = F.col(f"`{label}`").cast("int")
    given = labels.filter(F.col("doc_id").isNotNull() & y.isin(0, 1)).groupBy("doc_id").agg(F.max(y).alias("y"))
    given = store(given.filter(fold() != 0), "labels")
    shares = {r["y"]: r["n"] for r in given.groupBy("y").agg(F.count("*").alias("n")).collect()}
    ranked = given.withColumn("_order", F.xxhash64("doc_id"))
    zeros, ones = (ranked.filter(F.col("y") == v).orderBy("_order", "doc_id").limit(n) for v in (0, 1))
    chosen = zeros.unionByName(ones).drop("_order")
    return store(docs.filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id"), "labelled"), shares


@dataclasses.dataclass(frozen=True)
class Linear:
    """Logistic regression on standardised inputs."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def constant(n: int, share: float) -> Linear:
    """The same probability for all rows, where there is nothing to learn from."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Linear(np.zeros(n), np.ones(n), np.zeros(n), float(np.log(share / (1 - share))))


def fit_newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3, steps: int = 40) -> Linear:
    """Few inputs: Newton's method. `weight` counts each row as so many."""
    if len(y) == 0 or y.min() == y.max():
        return constant(x.shape[1], float(y.mean()) if len(y) else 0.5)
    weight = np.ones(len(y)) if weight is None else weight
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    penalty = ridge * np.eye(len(w)) * weight.sum() / len(w)
    penalty[-1, -1] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (weight * (p * (1 - p) + 1e-9))[:, None]) + penalty, a.T @ (weight * (p - y)) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Linear(mean, scale, w[:-1], float(w[-1]))


def fit_gradient(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, steps: int = 300) -> Linear:
    """Many inputs: Nesterov's accelerated gradient with a step from the largest possible curvature."""
    n = x.shape[1]
    if len(y) == 0 or y.min() == y.max():
        return constant(n, float(y.mean()) if len(y) else 0.5)
    weight = weight / weight.sum()
    w, bias, vw, vb = np.zeros(n), 0.0, np.zeros(n), 0.0
    rate = 4 / (float((weight * (np.square(x).sum(1) + 1)).sum()) + 4 * ridge)
    for k in range(1, steps + 1):
        g = weight * (1 / (1 + np.exp(-np.clip(x @ vw + vb, -30, 30))) - y)
        new_w, new_b = vw - rate * (x.T @ g + ridge * vw), vb - rate * float(g.sum())
        vw, vb = new_w + (k - 1) / (k + 2) * (new_w - w), new_b + (k - 1) / (k + 2) * (new_b - bias)
        w, bias = new_w, new_b
    return Linear(np.zeros(n), np.ones(n), w, bias)
