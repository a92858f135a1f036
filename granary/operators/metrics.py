"""Mergeable metrics: histograms, moments, prefixes by error, quantiles, comparisons, fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.prefix import running_sums

#: Half of the width in which a normal distribution has its middle half, times two.
IQR_SIGMA = 1.35


def clamped_histogram(df: DataFrame, value: Column, bins: int, width: int = 1) -> DataFrame:
    """bin, n, total: counts and sums with all that is too large in the last bin."""
    return df.select(value.alias("v")).groupBy(F.least(F.floor(F.col("v") / width), F.lit(bins - 1)).cast("long").alias("bin")).agg(F.count("*").alias("n"), F.sum("v").cast("long").alias("total"))


def prefix_length(errors: Column, limit: Column) -> Column:
    """Length of the longest prefix of an array of integers whose sum is at most limit(length)."""
    start = F.struct(F.lit(0).alias("i"), F.lit(0).cast("long").alias("sum"), F.lit(0).alias("best"))

    def step(s: Column, x: Column) -> Column:
        i, total = s["i"] + 1, s["sum"] + x
        return F.struct(i.alias("i"), total.alias("sum"), F.when(total <= limit * i, i).otherwise(s["best"]).alias("best"))

    return F.aggregate(errors, start, step, lambda s: s["best"])


def moments(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """n, total, squares: what merges by addition."""
    return df.groupBy(*by).agg(F.count(value).alias("n"), F.sum(value).alias("total"), F.sum(F.col(value) * F.col(value)).alias("squares"))


def merged(parts: DataFrame, by: list[str]) -> DataFrame:
    """Moments of groups from the moments of their parts: n, mean, var_pop."""
    x = parts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"))
    mean = F.col("total") / F.col("n")
    return x.select(*by, "n", mean.alias("mean"), (F.col("squares") / F.col("n") - mean * mean).alias("var_pop"))


def snr(df: DataFrame, by: list[str], key: str, low: Column, high: Column, value: str) -> DataFrame:
    """Per key the gap of two means over the mean of both spreads, averaged over the keys.

    Averaging the spreads (not the variances) is kept as it is known.
    """
    each = df.groupBy(*by, key).agg(
        (F.avg(F.when(high, F.col(value))) - F.avg(F.when(low, F.col(value)))).alias("gap"),
        ((F.stddev_pop(F.when(high, F.col(value))) + F.stddev_pop(F.when(low, F.col(value)))) / 2).alias("spread"),
    )
    return each.groupBy(*by).agg(F.avg(F.try_divide("gap", "spread")).alias("snr"), F.count("*").alias("keys"))


def compare(df: DataFrame, by: list[str], a: str, b: str, epsilon: float) -> DataFrame:
    """n, different, max_difference, correlation of two columns; two NaN or like infinities are equal."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    same = x.eqNullSafe(y) | (F.isnan(x) & F.isnan(y)) | (F.abs(x - y) <= epsilon)
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(~F.coalesce(same, F.lit(False))).alias("different"), F.max(F.abs(x - y)).alias("max_difference"), F.corr(x, y).alias("correlation"))


def even_chunks(df: DataFrame, value: str, chunks: int = 128) -> Column:
    """A number that rises with the value and gives about as many rows to each chunk, whatever the values' spread: for running sums."""
    shares = [k / chunks for k in range(1, chunks)]
    bounds = sorted(set(df.agg(F.percentile_approx(F.col(value).cast("double"), shares, 10 * chunks)).first()[0] or []))  # one number a chunk
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col(value).cast("double")))


def upper_median(hist: DataFrame, by: list[str], value: str, n: str) -> DataFrame:
    """The value at place n // 2 (from 0) of each group, from how often each value occurs."""
    ranked = running_sums(hist, by, value, even_chunks(hist, value), {"__upto": F.col(n)})
    total = hist.groupBy(*by).agg(F.sum(n).alias("__all"))
    joined = ranked.join(total, by) if by else ranked.crossJoin(F.broadcast(total))  # one row
    return joined.filter(F.col("__upto") > F.floor(F.col("__all") / 2)).groupBy(*by).agg(F.min(value).alias(value))


def quantiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float], chunks: int = 128) -> DataFrame:
    """Exact quantiles of each group, between two values as by ``percentile``; nulls don't count.

    Distinct values are counted first and then ranked in chunks of about equally many
    values, so neither a hot value nor a hot group nor a few far values put the work into one task.
    """
    known = df.select(*by, F.col(value).cast("double").alias("__v")).filter("__v IS NOT NULL")
    distinct = known.groupBy(*by, "__v").agg(F.count("*").alias("__n"))
    ranked = running_sums(distinct, by, "__v", even_chunks(known, "__v", chunks), {"__upto": F.col("__n")})
    total = distinct.groupBy(*by).agg(F.sum("__n").alias("__all"))

    def at(place: Column) -> Column:
        return F.min(F.when(F.col("__upto") > place, F.col("__v")))

    parts = {}
    for name, q in shares.items():
        place = q * (F.col("__all") - 1)
        parts |= {f"__low_{name}": at(F.floor(place)), f"__high_{name}": at(F.ceil(place)), f"__part_{name}": F.max(place - F.floor(place))}
    found = ranked.join(total, by).groupBy(*by).agg(*(x.alias(n) for n, x in parts.items()))
    return found.select(*by, *((F.col(f"__low_{n}") + F.col(f"__part_{n}") * (F.col(f"__high_{n}") - F.col(f"__low_{n}"))).alias(n) for n in shares))


def sample(df: DataFrame, key: Column, k: int, seed: int) -> DataFrame:
    """k rows, the same ones in every run: those of the least digest of key and seed."""
    return df.withColumn("__d", F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))).orderBy("__d").limit(k).drop("__d")


def histogram_quantile(hist: DataFrame, by: list[str], value: str, n: str, share: float) -> DataFrame:
    """The least value with at least ``share`` of a histogram's counts at or below it."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy(*by)
    x = hist.withColumns({"__c": F.sum(n).over(w), "__t": F.sum(n).over(total)})
    return x.filter(F.col("__c") >= share * F.col("__t")).groupBy(*by).agg(F.min(value).alias(value))
