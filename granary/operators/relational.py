"""Catalogue-style operators: pages, states, links, latest rows, grids, reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page(df: DataFrame, order: str, allowed: Iterable[str], key: str, limit: int, offset: int = 0) -> DataFrame:
    """A page of rows by an allowed column, ``-`` before its name for falling order; ties by the key."""
    name = order.removeprefix("-")
    if name not in set(allowed):
        raise ValueError(f"can't order by {name}")
    return df.orderBy(F.desc(name) if order.startswith("-") else F.asc(name), F.asc(key)).offset(offset).limit(limit)


def state_counts(df: DataFrame, by: str, state: Column, states: dict[str, object]) -> DataFrame:
    """One row a group, one count a state, and all."""
    return df.groupBy(by).agg(*(F.count_if(state == v).alias(n) for n, v in states.items()), F.count("*").alias("total"))


def latest(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Each group's last row by ``order``, without a sort: the greatest struct wins."""
    rest = [c for c in df.columns if c not in by]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*by).agg(best.alias("__r")).select(*by, *(f"__r.{c}" for c in rest))


def bin_2d(df: DataFrame, x: str, y: str, z: str, bins: int, least: int) -> DataFrame:
    """Counts and means of z on a grid of equal bins; cells of fewer than ``least`` rows go."""
    ends = df.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")).first()
    if ends["x0"] is None:
        return df.select(F.lit(0).cast("long").alias("cell_x"), F.lit(0).cast("long").alias("cell_y"), F.lit(0).cast("long").alias("n"), F.col(z).alias("mean")).limit(0)

    def cell(c: str, low: float, high: float) -> Column:
        return F.least(F.floor(bins * (F.col(c) - low) / ((high - low) or 1.0)), F.lit(bins - 1)).cast("long")

    cells = df.groupBy(cell(x, ends["x0"], ends["x1"]).alias("cell_x"), cell(y, ends["y0"], ends["y1"]).alias("cell_y"))
    return cells.agg(F.count("*").alias("n"), F.avg(z).alias("mean")).filter(F.col("n") >= least)


def upper_median(values: Column) -> Column:
    """The middle element of an array, the upper one of two."""
    ordered = F.array_sort(values)
    return F.get(ordered, F.floor(F.size(ordered) / 2).cast("int"))


def orphans(df: DataFrame, known: DataFrame, on: str) -> DataFrame:
    return df.join(known.select(on).distinct(), on, "left_anti")


#: Labels whose centroids are literals of the plan at most; of more they are joined.
LITERAL_LABELS = 256


def nearest(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``key``, ``label`` and ``distance`` (squared) of the nearest mean vector of a label; ties go to the smaller label."""
    each = df.select(key, label, F.posexplode(vector).alias("i", "v"))
    means = each.groupBy(label, "i").agg(F.avg("v").alias("mean"))
    if df.select(label).distinct().count() > LITERAL_LABELS:
        apart = each.select(key, "i", "v").join(means, "i").groupBy(key, label).agg(F.sum((F.col("v") - F.col("mean")) * (F.col("v") - F.col("mean"))).alias("d"))
        return apart.groupBy(key).agg(F.min(F.struct(F.round("d", 9).alias("k"), F.col(label).alias("label"), "d")).alias("b")).select(key, F.col("b.label").alias(label), F.col("b.d").alias("distance"))
    codes = means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "mean"))), lambda x: x["mean"]).alias("c")).collect()  # as many as LITERAL_LABELS
    scored = [(F.aggregate(F.zip_with(vector, F.array(*map(F.lit, c)), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x), name) for name, c in codes]
    least = F.array_min(F.array(*(F.struct(F.round(d, 9).alias("k"), F.lit(name).alias("label"), d.alias("d")) for d, name in scored)))
    return df.select(key, least.alias("b")).select(key, F.col("b.label").alias(label), F.col("b.d").alias("distance"))
