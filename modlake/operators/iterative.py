"""Linear models trained by loops of block sums: L1 logistic regression by proximal steps, the
squared-hinge support vector machine by Newton steps.

Rows are packed once into blocks (matrices of a bounded number of rows) and written; each pass sends the
coefficients to the tasks, which add up fixed-size sums of their blocks.  The driver
holds p numbers, or p * p for Newton steps, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 8192


@dataclass(frozen=True)
class Descent:
    """Where a loop ended: intercept, coefficients, steps, and the last change and whether it was small enough."""

    intercept: float
    coef: np.ndarray
    steps: int
    change: float
    converged: bool


def blocks(df: DataFrame, features: Sequence[str | Column], label: str, weight: str | None, folder: str) -> DataFrame:
    """Rows of (features, 0/1 label, weight) packed into matrices, written to ``folder``."""
    width = len(features) + 2

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.float64)
            parts = [table[i : i + BLOCK_ROWS] for i in range(0, len(table), BLOCK_ROWS)]
            yield pa.RecordBatch.from_pydict({"block": pa.array([p.tobytes() for p in parts], pa.binary())})

    columns = [F.col(f) if isinstance(f, str) else f for f in features]
    columns += [F.col(label), F.col(weight) if weight else F.lit(1.0)]
    plain = df.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    missing = F.raise_error(F.lit("a row lacks a feature, label or weight"))
    whole = plain.select(*[F.coalesce(F.col(f"c{i}"), missing).alias(f"c{i}") for i in range(width)])
    whole.mapInArrow(pack, "block binary").write.parquet(folder)
    return df.sparkSession.read.schema("block binary").parquet(folder)


def block_sums(packed: DataFrame, fn: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], width: int, size: int) -> np.ndarray:
    """The sum over all blocks of ``fn(x, y, w)``, ``size`` numbers; ``width`` features."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for raw in batch.column(0):
                m = np.frombuffer(raw.as_buffer(), np.float64).reshape(-1, width + 2)
                total += fn(m[:, :width], m[:, width], m[:, width + 1])
        yield pa.RecordBatch.from_pydict({"s": pa.array([total.tolist()], pa.list_(pa.float64()))})

    sums = packed.mapInArrow(work, "s array<double>")
    row = sums.agg(F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(size)]).alias("s")).first()
    return np.array([0.0 if v is None else v for v in row["s"]])


def l1_descent(
    packed: DataFrame, width: int, *, alpha: float = 0.01, rate: float = 0.1, tol: float = 1e-4, max_iter: int = 2000,
    trace: list | None = None,
) -> Descent:
    """Proximal-gradient steps from zero: gradients are weighted means, coefficients are shrunk by alpha * rate
    (the intercept is not), until no number changes by ``tol`` or more.  ``trace`` collects every step."""
    coef, intercept, change, step = np.zeros(width), 0.0, np.inf, 0
    while step < max_iter:
        def sums(x, y, w, coef=coef, intercept=intercept):
            r = w * (1 / (1 + np.exp(-np.clip(x @ coef + intercept, -500, 500))) - y)
            return np.concatenate([x.T @ r, [r.sum(), w.sum()]])

        got = block_sums(packed, sums, width, width + 2)
        if not got[-1] > 0:
            raise ValueError("the weights must have a positive total")
        moved = coef - rate * got[:width] / got[-1]
        fresh = np.sign(moved) * np.maximum(np.abs(moved) - alpha * rate, 0)
        start = intercept - rate * got[width] / got[-1]
        change = max(float(np.abs(fresh - coef).max(initial=0)), abs(start - intercept))
        coef, intercept, step = fresh, float(start), step + 1
        if trace is not None:
            trace.append((intercept, coef.copy()))
        if change < tol:
            break
    return Descent(intercept, coef, step, change, change < tol)


def squared_hinge(packed: DataFrame, width: int, *, c: float = 1.0, tol: float = 1e-9, max_iter: int = 50) -> Descent:
    """Minimum of (|coef|^2 + intercept^2) / 2 + c * sum of weight * max(0, 1 - margin)^2.

    The intercept is penalised like a coefficient.  Newton steps on the rows inside the margin; a second pass
    tries shorter steps at once and takes the best, so the loss never rises.
    ``change`` is the largest entry of the gradient by the sum of weights.
    """
    halves = 0.5 ** np.arange(12)
    theta, step, change = np.zeros(width + 1), 0, np.inf

    def sides(x, y):
        return np.column_stack([x, np.ones(len(x))]), 2 * y - 1

    while step < max_iter:
        def sums(x, y, w, theta=theta):
            a, s = sides(x, y)
            gap = np.maximum(0, 1 - s * (a @ theta))
            inside = a * (w * (gap > 0))[:, None]
            return np.concatenate([-2 * a.T @ (w * s * gap), (2 * a.T @ inside).ravel(), [w.sum()]])

        p = width + 1
        got = block_sums(packed, sums, width, p + p * p + 1)
        gradient = theta + c * got[:p]
        change = float(np.abs(gradient).max()) / max(got[-1] * c, 1.0)
        if change < tol:
            break
        direction = np.linalg.solve(np.eye(p) + c * got[p:-1].reshape(p, p), -gradient)
        tried = theta + halves[:, None] * direction

        def losses(x, y, w, tried=tried):
            a, s = sides(x, y)
            return (w[:, None] * np.maximum(0, 1 - s[:, None] * (a @ tried.T)) ** 2).sum(axis=0)

        loss = c * block_sums(packed, losses, width, len(halves)) + (tried**2).sum(axis=1) / 2
        theta, step = tried[int(loss.argmin())], step + 1
    return Descent(float(theta[-1]), theta[:-1], step, change, change < tol)
