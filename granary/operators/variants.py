"""Allele counts, substitution spectra, class-wise filters and unions by priority."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.probability import fisher_exact
from granary.operators.arrow import with_arrays


def allele_counts(df: DataFrame, locus: list[str], allele: str, forward: Column) -> DataFrame:
    """Per locus and allele: depth, forward and reverse counts, and the share of the locus."""
    x = df.groupBy(*locus, allele).agg(F.count("*").alias("n"), F.count_if(forward).alias("fwd"), F.count_if(~forward).alias("rev"))
    return x.withColumn("depth", F.sum("n").over(Window.partitionBy(*locus))).withColumn("share", F.col("n") / F.col("depth"))


def spectrum(counts: DataFrame, reference: str, allele: str, least: int = 30, low: float = 0.001, high: float = 0.15) -> DataFrame:
    """Counts of (reference, allele) at loci with enough reads on both strands and a share that may be noise."""
    noise = (F.col("fwd_depth") >= least) & (F.col("rev_depth") >= least) & (F.col("share") > low) & (F.col("share") < high)
    return counts.filter(noise & (F.col(reference) != F.col(allele))).groupBy(reference, allele).agg(F.count("*").alias("loci"), F.sum("n").alias("reads"))


def by_class(variants: DataFrame, thresholds: DataFrame, kind: str = "class") -> DataFrame:
    """Adds ``passes`` by the thresholds of each variant's class (a table of few rows, broadcast).

    Thresholds: min_cov, min_cov_strand, max_bias, min_share.
    """
    bias = F.try_divide(F.greatest("fwd", "rev"), F.col("n"))
    good = (F.col("depth") >= F.col("min_cov")) & (F.least("fwd", "rev") >= F.col("min_cov_strand")) & (bias <= F.col("max_bias")) & (F.col("share") >= F.col("min_share"))
    return variants.join(F.broadcast(thresholds), kind, "left").withColumn("passes", F.coalesce(good, F.lit(False)))


def priority_union(sources: list[DataFrame], key: list[str], tie: list[str]) -> DataFrame:
    """Rows of all sources with the first source's row for each key; ``source`` is its number."""
    rows = sources[0].withColumn("source", F.lit(0).cast("long"))
    for k, s in enumerate(sources[1:], 1):
        rows = rows.unionByName(s.withColumn("source", F.lit(k).cast("long")))
    w = Window.partitionBy(*key).orderBy("source", *tie)
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def normalised(df: DataFrame, pos: str = "pos", ref: str = "ref", alt: str = "alt") -> DataFrame:
    """Alleles without the bases that both share, so that one change is written in one way."""

    def shared(a: str, b: str, most: int) -> int:
        n = 0
        while n < most and a[n] == b[n]:
            n += 1
        return n

    def work(c: dict[str, pa.Array]) -> list[pa.Array]:
        at, a, b = c[pos].to_pylist(), c[ref].to_pylist(), c[alt].to_pylist()
        for k, (x, y) in enumerate(zip(a, b, strict=True)):
            if x and y and min(len(x), len(y)) > 1:
                room = min(len(x), len(y)) - 1
                tail = shared(x[::-1], y[::-1], room)
                head = shared(x, y, room - tail)
                a[k], b[k] = x[head : len(x) - tail], y[head : len(y) - tail]
                at[k] = None if at[k] is None else at[k] + head
        return [pa.array(at, c[pos].type), pa.array(a, pa.string()), pa.array(b, pa.string())]

    # in a batch, as Spark would put copies of so deep an expression wherever one of its columns is used
    fields = [T.StructField(n, t) for n, t in ((pos, df.schema[pos].dataType), (ref, T.StringType()), (alt, T.StringType()))]
    return with_arrays(df, fields, work).select(*df.columns)


def annotated(calls: DataFrame, hints: DataFrame, by: list[str]) -> DataFrame:
    """Calls with the columns of the hints of the same change, however either is written; ``by`` and pos, ref and alt are the key."""
    return normalised(calls).join(normalised(hints), [*by, "pos", "ref", "alt"], "left")


def strand_bias(df: DataFrame, fwd: str = "fwd", rev: str = "rev", other_fwd: str = "other_fwd", other_rev: str = "other_rev") -> DataFrame:
    """Adds ``bias`` (how far the allele's share of forward reads is from that of all other reads) and ``bias_p``, its exact p-value."""
    share = F.coalesce(F.try_divide(fwd, F.col(fwd) + F.col(rev)), F.lit(0.5))
    other = F.coalesce(F.try_divide(other_fwd, F.col(other_fwd) + F.col(other_rev)), F.lit(0.5))
    return df.withColumns({"bias": F.abs(share - other), "bias_p": fisher_exact(F.col(fwd), F.col(rev), F.col(other_fwd), F.col(other_rev))})


def unbiased(max_bias: float, max_p: float) -> Column:
    """A variant is biased if its bias is over the threshold and no chance: p is no more than ``max_p`` (see ``strand_bias``)."""
    return ~((F.col("bias") > max_bias) & (F.col("bias_p") <= max_p))
