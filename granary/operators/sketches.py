"""Metrics of parts that merge to those of the whole: moments, extremes, histograms, quantile and distinct sketches.

A part is one row: numbers, a histogram as a map, and two sketches as binary columns.
Parts of parts merge to the same numbers in any grouping and order; quantiles and
distinct counts are as exact as their sketches.  ``to_json`` and ``from_json`` carry a
part through text files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sizes of the sketches: quantiles to about 1.3 % of the ranks at 200, distinct counts to about 1.6 % at 12 bits.
QUANTILE_K, DISTINCT_BITS = 200, 12
NUMBERS = ("n", "nulls", "total", "squares", "least", "most")
_SCHEMA = "struct<n:bigint,nulls:bigint,total:double,squares:double,least:double,most:double,bins:map<string,bigint>,quantiles:string,distinct:string>"


def partial(df: DataFrame, by: list[str], value: str, item: str | None = None, width: float = 1.0, bins: int | None = None) -> DataFrame:
    """One mergeable row of each group; what is beyond the last of ``bins`` bins is in it, what is below 0 in bin 0 then."""
    v, x = F.col(value).cast("double"), df
    bin_ = F.floor(v / width).cast("long")
    if bins is not None:
        bin_ = F.greatest(F.least(bin_, F.lit(bins - 1)), F.lit(0)).cast("long")
    cells = x.filter(v.isNotNull()).groupBy(*by, bin_.alias("__bin")).agg(F.count("*").alias("__n"))
    maps = cells.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__bin", "__n")))).alias("bins"))  # a row a bin, not a row a value
    whole = x.groupBy(*by).agg(
        F.count(v).alias("n"),
        F.count_if(v.isNull()).alias("nulls"),
        F.sum(v).alias("total"),
        F.sum(v * v).alias("squares"),
        F.min(v).alias("least"),
        F.max(v).alias("most"),
        F.kll_sketch_agg_double(v, F.lit(QUANTILE_K)).alias("quantiles"),
        F.hll_sketch_agg((F.col(item) if item else F.col(value)).cast("string"), F.lit(DISTINCT_BITS)).alias("distinct"),
    )
    if not by:
        return whole.crossJoin(F.broadcast(maps))  # one row each
    return whole.join(maps, by, "left")


def merged(parts: DataFrame, by: list[str]) -> DataFrame:
    """The mergeable row of each group from its parts."""
    cells = parts.select(*by, F.explode("bins").alias("__bin", "__n")).groupBy(*by, "__bin").agg(F.sum("__n").alias("__n"))
    maps = cells.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__bin", "__n")))).alias("bins"))
    whole = parts.groupBy(*by).agg(
        *(F.sum(c).alias(c) for c in ("n", "nulls", "total", "squares")),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.kll_merge_agg_double("quantiles", F.lit(QUANTILE_K)).alias("quantiles"),
        F.hll_union_agg("distinct", F.lit(False)).alias("distinct"),
    )
    return whole.crossJoin(F.broadcast(maps)) if not by else whole.join(maps, by, "left")


def final(parts: DataFrame, by: list[str], shares: dict[str, float] | None = None) -> DataFrame:
    """What the merged rows say: n, mean, var_pop, least, most, distinct, the bins, and quantiles by name."""
    mean = F.try_divide("total", "n")
    said = {name: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(q)))) for name, q in (shares or {}).items()}
    return parts.select(
        *by, "n", "nulls", mean.alias("mean"), F.greatest(F.try_divide("squares", "n") - mean * mean, F.lit(0.0)).alias("var_pop"), "least", "most",
        F.hll_sketch_estimate("distinct").alias("distinct"), "bins", *(c.alias(n) for n, c in said.items()),
    )


def bins_at_least(bins: Column, level: int) -> Column:
    """How many values are in bins of ``level`` or more."""
    return F.aggregate(F.filter(F.map_entries(bins), lambda e: e["key"] >= level), F.lit(0).cast("long"), lambda s, e: s + e["value"])


def to_json(parts: DataFrame, by: list[str]) -> DataFrame:
    """The group's columns and ``payload``, the part as a JSON text."""
    fields = [*(F.col(c) for c in NUMBERS), F.col("bins"), *(F.base64(c).alias(c) for c in ("quantiles", "distinct"))]
    return parts.select(*by, F.to_json(F.struct(*fields)).alias("payload"))


def from_json(texts: DataFrame, by: list[str], payload: str = "payload") -> DataFrame:
    """Parts from their JSON texts; one that is none of them is left out."""
    x = texts.withColumn("__p", F.from_json(payload, _SCHEMA)).filter("__p.n IS NOT NULL")
    bins = F.transform_keys("__p.bins", lambda k, _: k.cast("long"))
    return x.select(*by, *(F.col(f"__p.{c}") for c in NUMBERS), bins.alias("bins"), *(F.unbase64(F.col(f"__p.{c}")).alias(c) for c in ("quantiles", "distinct")))


def weighted_mean(blocks: DataFrame, by: list[str], value: str, weight: str, positive: bool = False) -> DataFrame:
    """``value`` averaged over blocks by their weights; if ``positive``, over blocks whose value is above 0 alone."""
    x = blocks.filter(F.col(value) > 0) if positive else blocks.filter(F.col(value).isNotNull())
    return x.groupBy(*by).agg(F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias(value), F.sum(weight).alias(weight))


def traces_merged(blocks: DataFrame, by: list[str], trace: str, weight: str) -> DataFrame:
    """Traces (arrays of one length) averaged place by place by the blocks' weights."""
    places = blocks.filter(F.col(trace).isNotNull()).select(*by, weight, F.posexplode(trace).alias("__at", "__v"))
    each = places.groupBy(*by, "__at").agg(F.try_divide(F.sum(F.col("__v") * F.col(weight)), F.sum(weight)).alias("__v"))
    return each.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", "__v"))), lambda p: p["__v"]).alias(trace))  # as long as one trace
