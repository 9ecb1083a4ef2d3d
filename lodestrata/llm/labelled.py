"""A bounded sample of labelled texts, training on it inside a task, and what the trained classifiers share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.worker import let_go

Model = TypeVar("Model")

#: Characters of a text that a sample holds at most, where whole texts are not asked for.
LONGEST = 200_000


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    id: str,
    text: str,
    label: str,
    sample: int,
    held_out: Callable[[str], Column],
    whole: bool = False,
) -> tuple[DataFrame, float]:
    """(text, label) of at most ``sample`` ids of each label, and the share of label 1 among all labelled ids.

    Ids are chosen by hash among those not held out. An id that is labelled more than once has its highest
    label; one with several texts gives the first of them in order, so rows that repeat push out no others. Missing
    ids and labels are left out, missing texts are empty. Texts are ``whole``, as the classifiers ask for, or have
    their first ``LONGEST`` characters.
    """
    full = F.coalesce(F.col(text), F.lit(""))
    known = (
        labels.select(F.col(id).alias("_id"), F.col(label).cast("int").alias("_label"))
        .filter(F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~held_out("_id"))
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
    )
    counts = {row["_label"]: row["n"] for row in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    mark = F.xxhash64(F.lit(11), "_id")
    zeros, ones = (
        known.filter(F.col("_label") == value).orderBy(mark, "_id").limit(sample) for value in (0, 1)
    )
    rows = (
        docs.select(F.col(id).alias("_id"), (full if whole else F.substring(full, 1, LONGEST)).alias("_text"))
        .join(F.broadcast(zeros.unionByName(ones)), "_id")  # at most two samples of (id, label)
        .groupBy("_id", "_label")
        .agg(F.min("_text").alias("_text"))
    )
    total = sum(counts.values())
    return rows, counts.get(1, 0) / total if total else 0.5


def trained_in_task(rows: DataFrame, train: Callable[[list[str], list[int]], Model]) -> Model:
    """What ``train`` makes of the sample's texts and labels. They meet in one task, and only the model, whose size
    is fixed, comes to the driver."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        found = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        model = train([text for _, text, _ in found], [label for *_, label in found])
        del found
        let_go()
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    model = rows.select("_id", "_text", "_label").repartition(1).mapInArrow(task, "model binary").collect()
    return pickle.loads(model[0]["model"]) if model else train([], [])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic fit of one variable, by Newton steps with a weak pull to 1 and 0."""
    a, b = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-(a * x + b)))
        e, c = weight * (q - y), weight * q * (1 - q)
        grad = np.array([(e * x).sum() + 0.5 * (a - 1), e.sum() + 0.5 * b])
        hess = np.array([[(c * x * x).sum() + 0.5, (c * x).sum()], [(c * x).sum(), c.sum() + 0.5]])
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        a, b = a - step[0], b - step[1]
    return max(float(a), 1e-3), float(b)
