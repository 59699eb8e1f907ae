"""A bounded sample of labelled documents to train on, and logistic models of a few features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.llm.base import crc_of_id, id_filter, stored

FOLDS = 5
SAMPLE = 20_000  # labelled rows that a classifier is fit on, at most


def held_out(doc_id):
    return F.coalesce(crc_of_id(doc_id) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int = SAMPLE) -> DataFrame:
    """doc_id, text, label of at most so many labelled rows outside the held-out fold, chosen by a hash of the id.

    Labels other than 0 and 1 are passed by; of several labels of an id the largest counts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("doc_id is not null and label in (0, 1)").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    known = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "labels")
    _, wanted = id_filter(known, "doc_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.filter("doc_id is not null").filter(wanted("doc_id")).join(known, "doc_id")
    return stored(rows, "training")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 30) -> np.ndarray:
    """Weights of a logistic model without bias, by Newton's method with a ridge; zeros if there is nothing to learn."""
    w = np.zeros(x.shape[1])
    if len(x) == 0:
        return w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) / len(x) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(x) + (ridge + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w
