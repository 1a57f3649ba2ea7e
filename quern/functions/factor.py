"""Tall-skinny QR: the upper triangle of a whole table, and the least squares it gives.

Each task folds its rows into a triangle of one row per column, triangles are folded again in
groups, and what is left of them is one small row. Unlike sums of squares, the triangle keeps
the full precision of badly scaled or nearly collinear columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FOLDED = "n long, dropped long, r array<double>"
#: Rows a task folds at once.
_ROWS = 4096
#: Singular values (of columns scaled to length one) below this share of the largest are zero.
RANK_TOLERANCE = 1000 * np.finfo(float).eps


def fold(rows: np.ndarray) -> np.ndarray:
    """The triangle of these rows, square whatever their number."""
    width = rows.shape[1]
    if not np.isfinite(rows).all():
        return np.full((width, width), np.nan)
    made = np.linalg.qr(rows, mode="r") if len(rows) else np.zeros((0, width))
    return np.vstack([made, np.zeros((width - len(made), width))])


def _row(n: int, dropped: int, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([n]), pa.array([dropped]), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], ["n", "dropped", "r"]
    )


def triangles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``parts``, triangles over a leading column of ones and ``columns`` of the complete rows.

    Their number is the square root of the number of shuffle partitions, whatever the size of the data.
    """
    width = len(columns) + 1
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])

    def rows_to_triangle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = dropped = 0
        r = np.zeros((width, width))
        for batch in batches:
            given = np.array([c.fill_null(0).to_numpy(zero_copy_only=False) for c in batch.columns]).reshape(width - 1, -1).T
            missing = np.array([c.is_null().to_numpy(zero_copy_only=False) for c in batch.columns]).reshape(width - 1, -1)
            given = given[~missing.any(axis=0)]
            n, dropped = n + len(given), dropped + batch.num_rows - len(given)
            for at in range(0, len(given), _ROWS):
                part = given[at : at + _ROWS]
                r = fold(np.vstack([r, np.column_stack([np.ones(len(part)), part])]))
        yield _row(n, dropped, r)

    def triangles_to_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = dropped = 0
        r = np.zeros((width, width))
        for batch in batches:
            for part in batch.to_pylist():
                n, dropped = n + part["n"], dropped + part["dropped"]
                r = fold(np.vstack([r, np.reshape(part["r"], (width, width))]))
        yield _row(n, dropped, r)

    groups = math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    merged = values.mapInArrow(rows_to_triangle, _FOLDED).repartition(groups).mapInArrow(triangles_to_one, _FOLDED)
    return merged.agg(F.collect_list(F.struct("n", "dropped", "r")).alias("parts"))


class LeastSquares:
    """Minimum-norm least squares of the last column on the others, from triangles.

    The rank is that of the columns scaled to length one, so that a column of tiny values still
    counts. Of all solutions of collinear columns the one of least norm is taken; its covariance
    is the pseudo-inverse of the normal matrix.
    """

    def __init__(self, parts: Sequence):
        self.n = sum(p["n"] for p in parts)
        self.dropped = sum(p["dropped"] for p in parts)
        width = math.isqrt(len(parts[0]["r"]))
        r = fold(np.vstack([np.reshape(p["r"], (width, width)) for p in parts]))
        design, target = r[:, :-1], r[:, -1]
        terms = width - 1
        # Below the first row are the parts beyond the mean.
        self.total_ss = float(target[1:] @ target[1:])
        if not np.isfinite(r).all() or not self.n:
            self.rank, self.condition, self.residual_ss = 0, math.nan, math.nan
            self.coefficients = self.unscaled = np.full(terms, math.nan)
            return
        length = np.linalg.norm(design, axis=0)
        length[length == 0] = 1.0
        left, size, right = np.linalg.svd(design / length)
        self.rank = rank = int((size > size[0] * RANK_TOLERANCE).sum())
        back = right[:rank].T / size[:rank]
        slopes = back @ (left[:, :rank].T @ target) / length
        inverse = back @ back.T / np.outer(length, length)
        if rank < terms:
            free, _ = np.linalg.qr(right[rank:].T / length[:, None])
            keep = np.eye(terms) - free @ free.T
            slopes, inverse = keep @ slopes, keep @ inverse @ keep
        rest = target - design @ slopes
        self.residual_ss = float(rest @ rest)
        self.coefficients, self.unscaled = slopes, np.maximum(np.diag(inverse), 0.0)
        spread = np.linalg.svd(design, compute_uv=False)
        self.condition = float(spread[0] / spread[-1]) if spread[-1] > 0 else math.inf

    @property
    def df_residual(self) -> int:
        return self.n - self.rank

    @property
    def errors(self) -> np.ndarray:
        if self.df_residual < 1:
            return np.full(len(self.coefficients), math.nan)
        return np.sqrt(self.unscaled * (self.residual_ss / self.df_residual))
