"""Signal arrays: smoothing, slopes, change points, weighted edit distance, alignment, mixtures.

What arrays need beyond Spark's own functions runs as Arrow-batched numpy on one row's array.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moving_mean(a: Column, span: int) -> Column:
    """Mean over ``span`` places to either side, fewer at the ends."""

    def at(i: Column) -> Column:
        first = F.greatest(i - span, F.lit(0))
        part = F.slice(a, first + 1, F.least(i + span, F.size(a) - 1) - first + 1)
        return F.aggregate(part, F.lit(0.0), lambda s, x: s + x) / F.size(part)

    return F.transform(F.sequence(F.lit(0), F.size(a) - 1), at)


def rise_time(a: Column, low: float = 0.1, high: float = 0.9) -> Column:
    """Places between the first value over ``low`` and the first over ``high`` of the range."""
    floor, top = F.array_min(a), F.array_max(a)

    def first_over(share: float) -> Column:
        return F.array_position(F.transform(a, lambda x: x >= floor + (top - floor) * share), F.lit(True))

    return (first_over(high) - first_over(low)).cast("long")


def rms(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x) / F.size(a))


def change_point(a: Column) -> Column:
    """The split (at, sse) of an array into two straight lines with the least sum of squares, 3 points a side at least."""

    def one(y: np.ndarray) -> tuple[int | None, float | None]:
        n = len(y)
        if n < 6:
            return None, None
        x = np.arange(n, dtype=float)
        sums = [np.concatenate([[0.0], np.cumsum(v)]) for v in (np.ones(n), x, y, x * x, x * y, y * y)]

        def cost(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
            m, sx, sy, sxx, sxy, syy = (s[hi] - s[lo] for s in sums)
            vx, vy, c = sxx - sx * sx / m, syy - sy * sy / m, sxy - sx * sy / m
            return np.maximum(vy - np.where(vx > 0, c * c / np.where(vx > 0, vx, 1), 0), 0)

        k = np.arange(3, n - 2)
        total = cost(np.zeros_like(k), k) + cost(k, np.full_like(k, n))
        best = int(total.argmin())
        return int(k[best]), float(total[best])

    @F.pandas_udf("struct<at:int,sse:double>")
    def split(a: pd.Series) -> pd.DataFrame:
        found = [one(np.asarray(v, float)) if v is not None else (None, None) for v in a]
        return pd.DataFrame({"at": pd.array([f[0] for f in found], "Int32"), "sse": [f[1] for f in found]})

    return split(a)


def weighted_edit(swap: int | None = None, substitute: int = 2, insert: int = 1, delete: int = 3):
    """Edit distance with a cost for each operation and, if ``swap`` is given, for swapping neighbours."""

    @F.pandas_udf("int")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(s: str | None, t: str | None) -> int | None:
            if s is None or t is None:
                return None
            y = np.array([ord(c) for c in t], np.int64)
            puts = np.arange(len(t) + 1) * insert
            before2, before, last = None, puts.copy(), -1
            for i, c in enumerate(map(ord, s), 1):
                base = before + delete
                base[1:] = np.minimum(base[1:], before[:-1] + np.where(y == c, 0, substitute))
                if swap is not None and i > 1:
                    base[2:] = np.where((y[:-1] == c) & (y[1:] == last), np.minimum(base[2:], before2[:-2] + swap), base[2:])
                before2, before, last = before, np.minimum.accumulate(base - puts) + puts, c
            return int(before[-1])

        return pd.Series([one(s, t) for s, t in zip(a, b, strict=True)], dtype="Int32")

    return distance


def local_alignment(match: int = 2, mismatch: int = -3, gap: int = -4):
    """The best local alignment of two strings: score and where it ends in each (Smith-Waterman, linear gaps)."""

    @F.pandas_udf("struct<score:int,a_end:int,b_end:int>")
    def align(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        def one(s: str | None, t: str | None) -> tuple[int, int, int]:
            if not s or not t:
                return 0, 0, 0
            y = np.array([ord(c) for c in t])
            steps = np.arange(len(t) + 1) * gap
            row, best = np.zeros(len(t) + 1, int), (0, 0, 0)
            for i, c in enumerate(s, 1):
                up = np.maximum(row[1:] + gap, row[:-1] + np.where(y == ord(c), match, mismatch))
                base = np.maximum(np.concatenate([[0], up]), 0)
                row = np.maximum.accumulate(base - steps) + steps  # gaps along the row
                j = int(row.argmax())
                if row[j] > best[0]:
                    best = int(row[j]), i, j
            return best

        return pd.DataFrame([one(s, t) for s, t in zip(a, b, strict=True)], columns=["score", "a_end", "b_end"])

    return align


def mixture(df: DataFrame, value: str, bins: int = 512, rounds: int = 200) -> DataFrame:
    """Two normal components of a column by EM: one row of means, spreads and the second's share.

    EM runs on a histogram of the column (bounded by ``bins``), counted over all rows in Spark.
    """
    low, high = df.agg(F.min(value), F.max(value)).first()
    schema = "mean0 double, sd0 double, mean1 double, sd1 double, share1 double, n long"
    if low is None:
        return df.sparkSession.createDataFrame([], schema)
    width = (high - low) / bins or 1.0
    rows = df.filter(F.col(value).isNotNull()).groupBy(F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).alias("b")).agg(F.count("*").alias("n"), F.avg(value).alias("x")).orderBy("b").collect()
    x, n = np.array([r["x"] for r in rows], float), np.array([r["n"] for r in rows], float)
    middle = (n * x).sum() / n.sum()
    mean, spread, share = np.array([x[x <= middle].mean(), x[x >= middle].mean()]), np.full(2, max(np.sqrt((n * (x - middle) ** 2).sum() / n.sum()), 1e-9)), np.array([0.5, 0.5])
    for _ in range(rounds):
        p = share * np.exp(-0.5 * ((x[:, None] - mean) / spread) ** 2) / spread + 1e-300
        w = n[:, None] * p / p.sum(axis=1, keepdims=True)
        total = w.sum(axis=0)
        new = (w * x[:, None]).sum(axis=0) / total
        spread = np.maximum(np.sqrt((w * (x[:, None] - new) ** 2).sum(axis=0) / total), 1e-9)
        share, moved, mean = total / total.sum(), np.abs(new - mean).max(), new
        if moved < 1e-12:
            break
    row = (float(mean[0]), float(spread[0]), float(mean[1]), float(spread[1]), float(share[1]), int(n.sum()))
    return df.sparkSession.createDataFrame([row], schema)


def segments(df: DataFrame, by: str, order: str, value: str, change: float = 20.0) -> DataFrame:
    """Each group's ordered counts cut into runs of like level, by least Poisson-like cost (Viterbi).

    Levels are squares of whole numbers, so that they lie closer where counts
    are small; going to another level costs ``change``.  A group is held by one
    task: group by a bounded stretch (a chunk of a contig).
    """
    from pyspark.sql import types as T

    schema = T.StructType([df.schema[by], T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("level", T.LongType()), T.StructField("n", T.LongType())])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([order])
        y = pdf[value].to_numpy(float)
        levels = np.arange(0, int(np.sqrt(y.max() if len(y) else 0)) + 2, dtype=float) ** 2
        rate = np.maximum(levels, 0.1)
        cost = rate[None, :] - y[:, None] * np.log(rate)[None, :]
        back = np.zeros(cost.shape, int)
        total = cost[0].copy()
        for i in range(1, len(y)):
            best = int(total.argmin())
            stay = total <= total[best] + change
            back[i] = np.where(stay, np.arange(len(levels)), best)
            total = np.where(stay, total, total[best] + change) + cost[i]
        path = np.zeros(len(y), int)
        path[-1] = int(total.argmin())
        for i in range(len(y) - 1, 0, -1):
            path[i - 1] = back[i, path[i]]
        starts = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
        ends = np.concatenate([starts[1:], [len(y)]])
        at = pdf[order].to_numpy()
        return pd.DataFrame({by: [pdf[by].iloc[0]] * len(starts), "first": at[starts], "last": at[ends - 1], "level": levels[path[starts]].astype(int), "n": ends - starts})

    return df.select(by, order, value).groupBy(by).applyInPandas(one, schema)


def beta_tail(a: float, b: float, x: np.ndarray) -> np.ndarray:
    """The regularised incomplete beta function by its continued fraction."""
    from math import lgamma

    x = np.clip(np.asarray(x, float), 0.0, 1.0)

    def fraction(a: float, b: float, x: np.ndarray) -> np.ndarray:
        tiny = 1e-300
        c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
        d = 1 / np.where(np.abs(d) < tiny, tiny, d)
        h = d.copy()
        for m in range(1, 200):
            for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1 + top * d
                d = 1 / np.where(np.abs(d) < tiny, tiny, d)
                c = 1 + top / c
                c = np.where(np.abs(c) < tiny, tiny, c)
                h = h * d * c
        return h

    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * np.log(x) + b * np.log1p(-x))
        direct = front * fraction(a, b, x) / a
        mirrored = 1 - front * fraction(b, a, 1 - x) / b
    out = np.where(x < (a + 1) / (a + b + 2), direct, mirrored)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, out))


def t_test_p(t: Column, df: Column) -> Column:
    """Two-sided p of Student's t with df degrees of freedom."""

    @F.pandas_udf("double")
    def p(t: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series([float(beta_tail(d / 2, 0.5, np.array([d / (d + v * v)]))[0]) if pd.notna(v) and pd.notna(d) and d > 0 else None for v, d in zip(t, df, strict=True)], dtype="float64")

    return p(t, df)


def neighbour_mean(df: DataFrame, x: str, y: str, value: Column) -> DataFrame:
    """Sums and counts of each cell of a grid, and the mean over the cell and its eight neighbours.

    Each cell is sent to its neighbours, nine rows a cell, so no join is needed.
    """
    cells = df.groupBy(x, y).agg(F.sum(value).alias("total"), F.count("*").alias("n"))
    shifts = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    spread = cells.withColumn("s", shifts).groupBy((F.col(x) + F.col("s.i")).alias(x), (F.col(y) + F.col("s.j")).alias(y)).agg(
        (F.sum("total") / F.sum("n")).alias("around"), F.sum(F.when((F.col("s.i") == 0) & (F.col("s.j") == 0), F.col("total"))).alias("total"), F.sum(F.when((F.col("s.i") == 0) & (F.col("s.j") == 0), F.col("n"))).alias("n")
    )
    return spread.filter(F.col("n").isNotNull())


#: Predicted signals below this are zero, and those of one base are between the two.
ZERO, ONE = 0.3, (0.5, 1.5)


def window_drift(measured: Column, predicted: Column, window: int) -> Column:
    """Of each window of places an (offset, gain): the mean of what is measured where nothing is predicted, and the slope through zero of the rest where one base is.

    A window without such places has what the one before it has, the first ones 0 and 1.
    """
    pairs = F.arrays_zip(measured.alias("m"), predicted.alias("p"))
    starts = F.sequence(F.lit(1), F.greatest(F.size(measured), F.lit(1)), F.lit(window))

    def mean(part: Column, what) -> Column:
        return F.try_divide(F.aggregate(part, F.lit(0.0), lambda s, x: s + what(x)), F.size(part))

    def found(part: Column) -> Column:
        quiet = F.filter(part, lambda x: x["p"] < ZERO)
        return F.struct(mean(quiet, lambda x: x["m"] - x["p"]).alias("offset"), F.filter(part, lambda x: (x["p"] >= ONE[0]) & (x["p"] <= ONE[1])).alias("ones"))

    raw = F.transform(starts, lambda k: found(F.slice(pairs, k, F.lit(window))))
    first = F.struct(F.lit(0.0).alias("offset"), F.lit(1.0).alias("gain"))

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        offset = F.coalesce(x["offset"], last["offset"])
        up = F.aggregate(x["ones"], F.lit(0.0), lambda s, y: s + (y["m"] - offset) * y["p"])
        gain = F.coalesce(F.try_divide(up, F.aggregate(x["ones"], F.lit(0.0), lambda s, y: s + y["p"] * y["p"])), last["gain"])
        return F.concat(done, F.array(F.struct(offset.alias("offset"), gain.alias("gain"))))

    return F.aggregate(raw, F.array(first), step, lambda done: F.slice(done, 2, F.size(done) - 1))


def windowed_normalised(df: DataFrame, measured: str, predicted: str, window: int, name: str = "normalised") -> DataFrame:
    """Adds measured signals without the drift of their windows, which goes in a line from one window's begin to the next one's; null where a signal is.

    A window's gain of zero or less changes nothing.
    """
    x = df.withColumn("__drift", window_drift(F.col(measured), F.col(predicted), window))

    def at(i: Column, field: str) -> Column:
        k = F.floor(i / window).cast("int")
        here = F.get("__drift", k)[field]
        return here + (F.coalesce(F.get("__drift", k + 1)[field], here) - here) * ((i % window) / F.lit(float(window)))

    def corrected(m: Column, i: Column) -> Column:
        gain = at(i, "gain")
        return (m - at(i, "offset")) / F.when(gain > 0, gain).otherwise(1.0)

    return x.withColumn(name, F.transform(measured, corrected)).drop("__drift")
