"""Depth of coverage by a sweep over the ends of ranges.

A range adds one where it begins and takes one off where it ends.  The changes
are summed by position first, so what is swept is bounded by the number of
positions, and the sweep runs in chunks of positions (see ``prefix``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.operators.prefix import running_sums

CHUNK = 1 << 16
UNIFORM = 0.2
BIAS_SHARE, BIAS_DEPTH = 0.7, 10


def chunk(order: str, size: int = CHUNK) -> Column:
    return F.floor(F.col(order) / size)


def steps(reads: DataFrame, size: int = CHUNK) -> DataFrame:
    """contig, lo, hi, depth, fwd, rev: stretches of equal depth between the first and last position."""
    forward = F.col("forward").cast("long") if "forward" in reads.columns else F.lit(1).cast("long")
    ends = F.explode(F.array(F.struct(F.col("lo").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("hi").alias("pos"), F.lit(-1).alias("d"))))
    changes = reads.filter("hi > lo").select("contig", forward.alias("f"), ends.alias("e")).groupBy("contig", F.col("e.pos").alias("pos")).agg(F.sum(F.col("e.d") * F.col("f")).alias("df"), F.sum(F.col("e.d") * (1 - F.col("f"))).alias("dr"))
    swept = running_sums(changes, ["contig"], "pos", chunk("pos", size), {"fwd": F.col("df"), "rev": F.col("dr")})
    return swept.filter("__next is not null").select("contig", F.col("pos").alias("lo"), F.col("__next").alias("hi"), (F.col("fwd") + F.col("rev")).alias("depth"), "fwd", "rev")


def per_base(reads: DataFrame) -> DataFrame:
    """contig, pos, fwd, rev of every covered position."""
    return steps(reads).filter("depth > 0").select("contig", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("pos"), "fwd", "rev")


def histogram(found: DataFrame) -> DataFrame:
    """contig, depth, positions."""
    return found.groupBy("contig", "depth").agg(F.sum(F.col("hi") - F.col("lo")).alias("positions"))


def cumulative(found: DataFrame) -> DataFrame:
    """contig, depth, positions, at_least, norm_depth, pct: positions of at least that depth."""
    h = histogram(found)
    total = h.groupBy("contig").agg(F.sum("positions").alias("span"), F.sum(F.col("depth") * F.col("positions")).alias("bases"))
    down = Window.partitionBy("contig").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        h.withColumn("at_least", F.sum("positions").over(down))
        .join(total, "contig")
        .select("contig", "depth", "positions", "at_least", (F.col("depth") * F.col("span") / F.col("bases")).alias("norm_depth"), (100.0 * F.col("at_least") / F.col("span")).alias("pct"))
    )


def report(found: DataFrame, levels: tuple[int, ...] = (1, 20, 100, 500)) -> DataFrame:
    """One row a contig: span, bases, mean depth, uniformity, share at each level, share without strand bias."""
    width = F.col("hi") - F.col("lo")
    biased = (F.col("depth") >= BIAS_DEPTH) & (F.greatest("fwd", "rev") > BIAS_SHARE * F.col("depth"))
    h = found.groupBy("contig", "depth").agg(F.sum(width).alias("positions"), F.sum(F.when(biased, width).otherwise(0)).alias("biased"))
    mean = h.groupBy("contig").agg(F.sum("positions").alias("span"), F.sum(F.col("depth") * F.col("positions")).alias("bases"))
    x = h.join(mean, "contig").withColumn("t", UNIFORM * F.col("bases") / F.col("span"))

    def share(at_least: Column) -> Column:
        return F.sum(F.when(F.col("depth") >= at_least, F.col("positions")).otherwise(0)) / F.max("span")

    part = F.max(F.col("t") - F.floor("t"))
    uniform = (1 - part) * share(F.floor("t")) + part * share(F.floor("t") + 1)
    return x.groupBy("contig").agg(
        F.max("span").alias("span"),
        F.max("bases").alias("bases"),
        (F.max("bases") / F.max("span")).alias("mean_depth"),
        (100 * uniform).alias("uniformity"),
        *((100.0 * share(F.lit(n))).alias(f"pct_{n}x") for n in levels),
        (100.0 * (1 - F.sum("biased") / F.max("span"))).alias("pct_no_bias"),
    )


def coarse(found: DataFrame, minor: int, major: int) -> DataFrame:
    """Base counts in bins of two widths: contig, width, bin, fwd_bases, rev_bases."""
    cells = F.explode(F.sequence(F.floor(F.col("lo") / minor).cast("long"), F.floor((F.col("hi") - 1) / minor).cast("long")))
    inside = F.least("hi", (F.col("bin") + 1) * minor) - F.greatest("lo", F.col("bin") * minor)
    small = found.filter("depth > 0").withColumn("bin", cells).groupBy("contig", "bin").agg(F.sum(inside * F.col("fwd")).alias("fwd_bases"), F.sum(inside * F.col("rev")).alias("rev_bases"))
    large = small.groupBy("contig", F.floor(F.col("bin") * minor / major).cast("long").alias("bin")).agg(F.sum("fwd_bases").alias("fwd_bases"), F.sum("rev_bases").alias("rev_bases"))
    return small.withColumn("width", F.lit(minor).cast("long")).unionByName(large.withColumn("width", F.lit(major).cast("long"))).select("contig", "width", "bin", "fwd_bases", "rev_bases")
