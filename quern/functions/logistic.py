"""Logistic regression by Newton steps, and the scoring stage it gives.

A step needs the gradient and the curvature of the loss. Both are sums over rows, so each task
adds up its own, groups of tasks are added again, and the driver solves one small system.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SUMS = "sums array<double>"
#: Halvings of a step before it counts as no improvement.
_HALVINGS = 30


class Fit(NamedTuple):
    """``terms`` holds the intercept first; ``steps`` counts the Newton steps taken."""

    terms: np.ndarray
    steps: int
    converged: bool


def _row(sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64()))], ["sums"])


def moments(rows: DataFrame, terms: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and curvature at ``terms`` over rows (``x`` array, ``y`` in 0 to 1, ``w`` weight).

    The driver receives as many rows as the square root of the shuffle partitions, whatever the data.
    """
    size = len(terms)
    length = 1 + size + size * size

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size - 1)
            x = np.column_stack([np.ones(len(x)), x])
            y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            margin = x @ terms
            p = 0.5 * (1 + np.tanh(margin / 2))
            total[0] += w @ (np.logaddexp(0.0, margin) - y * margin)
            total[1 : size + 1] += x.T @ (w * (p - y))
            total[size + 1 :] += ((x.T * (w * p * (1 - p))) @ x).ravel()
        yield _row(total)

    def of_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            total += batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, length).sum(axis=0)
        yield _row(total)

    groups = math.isqrt(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    merged = rows.select("x", "y", "w").mapInArrow(of_rows, _SUMS).repartition(groups).mapInArrow(of_sums, _SUMS)
    total = np.sum([r["sums"] for r in merged.collect()], axis=0)
    return float(total[0]), total[1 : size + 1], total[size + 1 :].reshape(size, size)


def fit(rows: DataFrame, width: int, penalty: float = 0.0, max_iter: int = 1_000, tolerance: float = 1e-10) -> Fit:
    """Minimise the weighted log loss plus ``penalty`` / 2 times the squared slopes.

    A step that raises the loss is halved. Directions without curvature (collinear columns) are
    left where they are. Rows of one class only, or no rows, have no fit and raise ValueError.
    """
    terms = np.zeros(width + 1)
    ridge = np.full(width + 1, penalty)
    ridge[0] = 0.0

    def at(place: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, gradient, curvature = moments(rows, place)
        return loss + ridge @ place**2 / 2, gradient + ridge * place, curvature + np.diag(ridge)

    loss, gradient, curvature = at(terms)
    # At zero every chance is one half: the curvature holds the weight, the gradient that of the ones.
    weight, ones = 4 * curvature[0, 0], 2 * curvature[0, 0] - gradient[0]
    if not 0 < ones < weight:
        raise ValueError("A logistic fit needs weight on both classes.")
    for step in range(1, max_iter + 1):
        move = np.linalg.lstsq(curvature, -gradient, rcond=None)[0]
        if np.abs(move).max() <= tolerance * max(1.0, np.abs(terms).max()):
            return Fit(terms + move, step, True)
        for _ in range(_HALVINGS):
            reached = at(terms + move)
            if reached[0] <= loss + 1e-12 * abs(loss):
                break
            move = move / 2
        else:
            return Fit(terms, step, False)
        terms, (loss, gradient, curvature) = terms + move, reached
    return Fit(terms, max_iter, False)


class LinearScore(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage adding intercept + slopes * vector as a double column."""

    slopes = Param(Params._dummy(), "slopes", "one per vector component", TypeConverters.toListFloat)
    offset = Param(Params._dummy(), "offset", "the intercept", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, slopes=None, offset=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.getOrDefault(self.slopes))

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.offset)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name = f"{self.uid}_x"
        margin = F.lit(self.intercept)
        for i, slope in enumerate(self.getOrDefault(self.slopes)):
            margin = margin + F.lit(slope) * F.col(name)[i]
        return dataset.withColumn(name, vector_to_array(self.getInputCol())).withColumn(self.getOutputCol(), margin).drop(name)
