"""Fits by sufficient statistics: normal mixtures of any dimension, linear and logistic regression.

Each round sums what the fit needs over all rows in the tasks and then in Spark; a few
numbers for each pair of columns come to the driver, whatever the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators.arrow import with_arrays

#: Added to the diagonal of a covariance, as a share of its mean variance.
RIDGE = 1e-6


def _known(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as doubles by number, rows with a null or NaN left out."""
    x = df.select(*(F.col(c).cast("double").alias(f"v{k}") for k, c in enumerate(columns)))
    return x.filter(" AND ".join(f"v{k} IS NOT NULL AND NOT isnan(v{k})" for k in range(len(columns))))


def summed(x: DataFrame, cells: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows (a matrix of doubles a batch) of what ``part`` makes of them, ``cells`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        for b in batches:
            total += part(np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells)), pa.array(total)], ["cell", "v"])

    out = np.zeros(cells)
    for cell, v in x.mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():  # as many rows as cells
        out[cell] = v
    return out


@dataclass
class Mixture:
    """Normal components: means (k x d), covariances (k x d x d), shares, mean log likelihood, rounds taken."""

    mean: np.ndarray
    cov: np.ndarray
    share: np.ndarray
    likelihood: float
    rounds: int

    def logs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row and component the log of share times density, and the squared Mahalanobis distance."""
        out, far = np.empty((len(x), len(self.share))), np.empty((len(x), len(self.share)))
        for k, (m, c, s) in enumerate(zip(self.mean, self.cov, self.share, strict=True)):
            low = np.linalg.cholesky(c)
            far[:, k] = (np.linalg.solve(low, (x - m).T) ** 2).sum(axis=0)
            out[:, k] = math.log(max(s, 1e-300)) - np.log(np.diag(low)).sum() - 0.5 * (far[:, k] + x.shape[1] * math.log(2 * math.pi))
        return out, far


def normal_mixture(df: DataFrame, columns: list[str], means: list[list[float]] | None = None, rounds: int = 100, tolerance: float = 1e-9) -> Mixture:
    """Components by expectation-maximisation, from the given means or from two along the axis of greatest spread.

    A component's covariance starts as that of all rows.  Stops when the mean log likelihood
    grows by less than ``tolerance``.  Fewer than two rows give components with no share.
    """
    d = len(columns)
    x = _known(df, columns).persist()
    moments = summed(x, 1 + d + d * d, lambda v: np.concatenate([[len(v)], v.sum(axis=0), (v.T @ v).ravel()]))
    n = moments[0]
    k = len(means) if means else 2
    if n < 2:
        return Mixture(np.zeros((k, d)), np.tile(np.eye(d), (k, 1, 1)), np.zeros(k), float("nan"), 0)
    centre = moments[1 : 1 + d] / n
    cov = moments[1 + d :].reshape(d, d) / n - np.outer(centre, centre)
    cov += np.eye(d) * (np.trace(cov) / d * RIDGE + 1e-12)
    if means is None:
        value, axis = np.linalg.eigh(cov)
        way = axis[:, -1] * math.sqrt(value[-1])
        way = way if way[np.abs(way).argmax()] > 0 else -way
        means = [centre - way, centre + way]
    now = Mixture(np.array(means, float), np.tile(cov, (k, 1, 1)), np.full(k, 1 / k), -math.inf, 0)
    cells = 1 + d + d * d
    for step in range(1, rounds + 1):

        def part(v: np.ndarray, now: Mixture = now) -> np.ndarray:
            logs, _ = now.logs(v)
            top = logs.max(axis=1, keepdims=True)
            total = np.exp(logs - top).sum(axis=1, keepdims=True)
            w = np.exp(logs - top) / total
            each = [np.concatenate([[w[:, j].sum()], w[:, j] @ v, ((v * w[:, j, None]).T @ v).ravel()]) for j in range(k)]
            return np.concatenate([[(top + np.log(total)).sum()], *each])

        sums = summed(x, 1 + k * cells, part)
        likelihood, before = sums[0] / n, now.likelihood
        each = sums[1:].reshape(k, cells)
        weight = np.maximum(each[:, 0], 1e-12)
        mean = each[:, 1 : 1 + d] / weight[:, None]
        spread = each[:, 1 + d :].reshape(k, d, d) / weight[:, None, None] - np.einsum("ki,kj->kij", mean, mean)
        spread = (spread + spread.transpose(0, 2, 1)) / 2 + np.eye(d) * (np.trace(cov) / d * RIDGE + 1e-12)
        now = Mixture(mean, spread, weight / weight.sum(), float(likelihood), step)
        if likelihood - before < tolerance:
            break
    x.unpersist()
    return now


def with_posterior(df: DataFrame, columns: list[str], model: Mixture) -> DataFrame:
    """Adds ``posterior`` (chances of the components), ``component`` (the likeliest) and ``distance`` (Mahalanobis, to that one); nulls where a value is null."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(c: dict[str, pa.Array]) -> list[pa.Array]:
        v = np.stack([c[n].cast(pa.float64()).to_numpy(zero_copy_only=False) for n in columns], axis=1)
        bad = np.isnan(v).any(axis=1)
        logs, far = shared.value.logs(np.where(bad[:, None], 0, v))
        chance = np.exp(logs - logs.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        best = chance.argmax(axis=1)
        k = chance.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * k), pa.array(chance.ravel()))
        lists = pa.array([None if b else x for b, x in zip(bad.tolist(), lists.to_pylist(), strict=True)], pa.list_(pa.float64())) if bad.any() else lists
        return [lists, pa.array(best.astype(np.int32), mask=bad), pa.array(np.sqrt(far[np.arange(len(v)), best]), mask=bad)]

    return with_arrays(df, [T.StructField("posterior", T.ArrayType(T.DoubleType())), T.StructField("component", T.IntegerType()), T.StructField("distance", T.DoubleType())], work)


@dataclass
class Fit:
    """Intercept and coefficients, their standard errors and two-sided p-values, and the rows they come from."""

    names: list[str]
    value: np.ndarray
    error: np.ndarray
    p: np.ndarray
    n: int
    rounds: int

    def rows(self) -> list[tuple[str, float, float, float]]:
        return list(zip(self.names, self.value.tolist(), self.error.tolist(), self.p.tolist(), strict=True))


def _judged(names: list[str], value: np.ndarray, cov: np.ndarray, n: int, rounds: int) -> Fit:
    error = np.sqrt(np.maximum(np.diag(cov), 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        z = np.abs(value / error)
    return Fit(["intercept", *names], value, error, np.array([math.erfc(t / math.sqrt(2)) if np.isfinite(t) else float("nan") for t in z]), n, rounds)


def linear(df: DataFrame, features: list[str], target: str) -> Fit:
    """Least squares in one pass, from sums of products around the means (normal p-values)."""
    d = len(features) + 1
    x = _known(df, [*features, target])
    first = summed(x, 1 + d, lambda v: np.concatenate([[len(v)], v.sum(axis=0)]))
    n, mean = int(first[0]), first[1:] / max(first[0], 1)
    cross = summed(x, d * d, lambda v: (v - mean).T @ (v - mean)).reshape(d, d)
    inverse = np.linalg.pinv(cross[:-1, :-1])
    slope = inverse @ cross[:-1, -1]
    rest = max(cross[-1, -1] - slope @ cross[:-1, -1], 0) / max(n - d, 1)
    at = mean[:-1]
    cov = np.zeros((d, d))
    cov[1:, 1:] = inverse * rest
    cov[0, 0] = rest / max(n, 1) + at @ inverse @ at * rest
    return _judged(features, np.concatenate([[mean[-1] - slope @ at], slope]), cov, n, 1)


def logistic(df: DataFrame, features: list[str], label: str, ridge: float = 0.0, rounds: int = 50, tolerance: float = 1e-10) -> Fit:
    """Logistic regression by iteratively reweighted least squares; ``label`` is 0 or 1.

    Features are scaled by their means and spreads on the way.  ``ridge`` is taken off the
    log likelihood for each squared scaled coefficient; without it, classes that a plane
    parts have no fit, and the rounds end with coefficients that still grow.
    """
    d = len(features)
    x = _known(df, [*features, label]).persist()
    sums = summed(x, 1 + 2 * d, lambda v: np.concatenate([[len(v)], v[:, :d].sum(axis=0), (v[:, :d] ** 2).sum(axis=0)]))
    n = int(sums[0])
    if not n:
        return _judged(features, np.full(d + 1, np.nan), np.full((d + 1, d + 1), np.nan), 0, 0)
    mean = sums[1 : 1 + d] / n
    scale = np.sqrt(np.maximum(sums[1 + d :] / n - mean**2, 0))
    scale[scale == 0] = 1
    b, penalty = np.zeros(d + 1), np.diag([0.0, *[2 * ridge] * d])
    step = 0
    for step in range(1, rounds + 1):

        def part(v: np.ndarray, b: np.ndarray = b) -> np.ndarray:
            z = np.concatenate([np.ones((len(v), 1)), (v[:, :d] - mean) / scale], axis=1)
            p = 1 / (1 + np.exp(-np.clip(z @ b, -500, 500)))
            return np.concatenate([z.T @ (v[:, d] - p), ((z * (p * (1 - p))[:, None]).T @ z).ravel()])

        got = summed(x, (d + 1) * (d + 2), part)
        hessian = got[d + 1 :].reshape(d + 1, d + 1) + penalty
        move = np.linalg.pinv(hessian) @ (got[: d + 1] - penalty @ b)
        b = b + np.clip(move, -5, 5)
        if np.abs(move).max() < tolerance:
            break
    x.unpersist()
    turn = np.eye(d + 1)
    turn[0, 1:] = -mean / scale
    turn[1:, 1:] = np.diag(1 / scale)
    return _judged(features, turn @ b, turn @ np.linalg.pinv(hessian) @ turn.T, n, step)


def clonality(df: DataFrame, flows: str, most_positive: float = 0.84, least_posterior: float = 0.5, model: Mixture | None = None) -> DataFrame:
    """Adds ``ppf`` (share of positive flows), ``ssq`` (squares of what flows are off whole numbers), ``posterior`` of the clonal component and ``clonal``.

    The components of (ppf, ssq) are fitted to all rows; the clonal one has fewer positive flows.
    """
    from granary.functions import trims

    x = df.withColumns({"ppf": trims.positive_share(F.col(flows)), "ssq": trims.fractional_squares(F.col(flows))})
    known = x.filter(F.col("ppf") <= most_positive)
    model = model or normal_mixture(known, ["ppf", "ssq"])
    low = int(model.mean[:, 0].argmin())
    judged = with_posterior(x, ["ppf", "ssq"], model).withColumn("posterior", F.get("posterior", F.lit(low))).drop("component", "distance")
    return judged.withColumn("clonal", F.coalesce((F.col("ppf") <= most_positive) & (F.col("posterior") >= least_posterior), F.lit(False)))
