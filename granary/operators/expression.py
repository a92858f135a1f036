"""Expression matrices: counts by gene and sample, normalised, compared and correlated."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matrix(df: DataFrame, gene: str, sample: str, samples: list[str], value: Column | None = None) -> DataFrame:
    """One row a gene, one column a sample (0 where there is none)."""
    value = F.count("*") if value is None else value
    return df.groupBy(gene).pivot(sample, samples).agg(value).na.fill(0)


def rpm(counts: DataFrame, gene: str, sample: str, n: str = "n") -> DataFrame:
    """Adds reads per million of the sample and log2(rpm + 1)."""
    total = counts.groupBy(sample).agg(F.sum(n).alias("__t"))  # one row a sample
    x = counts.join(F.broadcast(total), sample)
    per = F.col(n) * 1e6 / F.col("__t")
    return x.select(gene, sample, n, per.alias("rpm"), F.log2(per + 1).alias("log2_rpm"))


def differential(wide: DataFrame, samples: list[str], least: float, ratio: float) -> DataFrame:
    """Lowest, highest and mean of each row's samples, their ratio, and whether it tells."""
    low, high = F.least(*samples), F.greatest(*samples)
    mean = sum((F.col(s) for s in samples), F.lit(0.0)) / len(samples)
    fold = F.try_divide(high, low)
    return wide.withColumns({"low": low, "high": high, "mean": mean, "ratio": fold, "log2_ratio": F.when(fold > 0, F.log2(fold))}).withColumn("differs", F.coalesce((F.col("high") >= least) & (F.col("ratio") >= ratio), F.lit(False)))


def fold_change(df: DataFrame, gene: str, group: Column, value: str) -> DataFrame:
    """Fold change of the two groups' means (true over false) and Welch's t with its degrees of freedom."""
    a, b = F.when(group, F.col(value)), F.when(~group, F.col(value))
    x = df.groupBy(gene).agg(F.count(a).alias("n1"), F.count(b).alias("n0"), F.avg(a).alias("m1"), F.avg(b).alias("m0"), F.var_samp(a).alias("v1"), F.var_samp(b).alias("v0"))
    e1, e0 = F.col("v1") / F.col("n1"), F.col("v0") / F.col("n0")
    return x.select(
        gene,
        "n1",
        "n0",
        F.try_divide("m1", "m0").alias("fold"),
        F.try_divide(F.col("m1") - F.col("m0"), F.sqrt(e1 + e0)).alias("t"),
        F.try_divide((e1 + e0) * (e1 + e0), F.try_divide(e1 * e1, F.col("n1") - 1) + F.try_divide(e0 * e0, F.col("n0") - 1)).alias("df"),
    )


def correlations(wide: DataFrame, samples: list[str]) -> DataFrame:
    """Pearson's correlation of every pair of samples, in one pass over the matrix."""
    pairs = list(combinations(samples, 2))
    row = wide.agg(*(F.corr(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs)))
    return row.select(F.inline(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{k}").alias("r")) for k, (a, b) in enumerate(pairs)))))
