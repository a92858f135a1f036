"""Probabilities of variant calls as Spark expressions and Arrow-batched functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.arrays import beta_tail


def log_sum_exp(logs: Column) -> Column:
    """ln of the sum of the exponentials of an array, without overflow."""
    top = F.array_max(logs)
    return F.when(F.size(logs) > 0, top + F.ln(F.aggregate(logs, F.lit(0.0), lambda s, x: s + F.exp(x - top))))


def log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series from 10 on and by a sum of logarithms below."""
    x = n.cast("double") + 1
    series = (x - 0.5) * F.ln(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5.0)))
    small = F.aggregate(F.sequence(F.lit(1), F.greatest(n.cast("int"), F.lit(1))), F.lit(0.0), lambda s, k: s + F.ln(k.cast("double")))
    return F.when(n < 10, small).otherwise(series)


def log_binomial(k: Column, n: Column, p: Column) -> Column:
    """ln of the chance of k successes in n trials; null where it is 0."""
    choose = log_factorial(n) - log_factorial(k) - log_factorial(n - k)
    hits = F.when(k == 0, 0.0).otherwise(k * F.ln(p))
    misses = F.when(k == n, 0.0).otherwise((n - k) * F.ln(1 - p))
    return F.when((k >= 0) & (k <= n), choose + hits + misses)


def call_score(alt: Column, depth: Column, cutoff: float, alpha: float = 1.0, beta: float = 1.0) -> Column:
    """Phred of the chance that the true frequency is below the cut-off, from a beta posterior."""

    @F.pandas_udf("double")
    def score(alt: pd.Series, depth: pd.Series) -> pd.Series:
        import numpy as np

        below = [float(beta_tail(alpha + a, beta + d - a, np.array([cutoff]))[0]) if pd.notna(a) and pd.notna(d) else None for a, d in zip(alt, depth, strict=True)]
        return pd.Series([None if b is None else -10 * np.log10(max(b, 1e-30)) for b in below], dtype="float64")

    return score(alt.cast("double"), depth.cast("double"))


def detection_limit(depth: Column, error: float, score: float) -> Column:
    """The least frequency whose expected reads reach a score over the error rate: Newton's steps on n(x ln(x/e) - (x - e))."""
    need = score / 10 * 2.302585092994046 / depth
    zero = F.lit(error) + F.sqrt(2 * need * error) + need

    def step(x: Column, _: Column) -> Column:
        f = x * F.ln(x / error) - (x - error) - need
        return F.greatest(x - f / F.ln(x / error), F.lit(error * 1.000001))

    return F.least(F.aggregate(F.sequence(F.lit(1), F.lit(40)), zero, step), F.lit(1.0))


def fisher_exact(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Two-sided p-value of a 2x2 table: the chance of tables with its margins that are no likelier, worked out in logarithms.

    The work grows with the least margin.  Null where a count is null or negative.
    """
    a, b, c, d = (x.cast("long") for x in (a, b, c, d))
    row, column, n = a + b, a + c, a + b + c + d
    low, high = F.greatest(F.lit(0).cast("long"), row + column - n), F.least(row, column)
    fixed = log_factorial(row) + log_factorial(n - row) + log_factorial(column) + log_factorial(n - column) - log_factorial(n)

    def log_share(x: Column) -> Column:
        return -log_factorial(x) - log_factorial(row - x) - log_factorial(column - x) - log_factorial(n - row - column + x)

    def total(s: Column) -> Column:
        logs = F.transform(F.sequence(low, high), lambda x: s["fixed"] + log_share(x))
        return F.aggregate(F.filter(logs, lambda x: x <= s["most"]), F.lit(0.0), lambda t, x: t + F.exp(x))

    good = (a >= 0) & (b >= 0) & (c >= 0) & (d >= 0)
    # an array of one, so that what is the same for all tables is worked out once for a row
    once = F.struct(fixed.alias("fixed"), (fixed + log_share(a) + 1e-7).alias("most"))
    p = F.when(good, F.transform(F.array(once), total)[0])
    return F.when(good, F.least(p, F.lit(1.0)))
