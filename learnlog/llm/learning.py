"""Bounded labelled samples and a small logistic fit, shared by the learned operators."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog.llm.shared import crc_part


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, most: int
) -> tuple[DataFrame, dict[int, int]]:
    """Texts with their labels to learn from, and how many rows of each class there are.

    At most ``most`` documents of each class, those with the smallest hashes of their ids;
    the rest of the rows is counted, not read. Ids with the held-out remainder, NULL ids
    and NULL labels do not occur. Of an id with several labels the smallest counts.
    """
    rows = labels.where(F.col(label).isin(0, 1) & (crc_part(modulus) != held_out))
    rows = rows.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    draw = F.xxhash64("doc_id")
    chosen = [rows.where(F.col("label") == c).orderBy(draw, "doc_id").limit(most) for c in (0, 1)]
    sample = chosen[0].unionByName(chosen[1])
    texts = docs.select("doc_id", "text").where("doc_id is not null")
    # 2 * most ids: a bounded broadcast.
    return texts.join(F.broadcast(sample), "doc_id"), counts


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_logistic(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-3, steps: int = 60
) -> np.ndarray:
    """Weights, the intercept last, by Newton steps on the penalized likelihood."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    penalty = np.full(len(w), l2)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 5 / max(1e-9, np.abs(step).max()))
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def class_weights(y: np.ndarray, counts: dict[int, int]) -> np.ndarray:
    """Weights with which a sample stands for all rows of each class."""
    return np.array([counts.get(int(c), 0) / max(1, int((y == c).sum())) for c in y], float)
