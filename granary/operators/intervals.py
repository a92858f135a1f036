"""Joins and unions of half-open ranges ``[lo, hi)`` on contigs.

Spark joins ranges by comparing all pairs of a contig; here both sides are
dealt to bins first.  Bins come in levels, each eight times as wide as the one
before; a range belongs to the finest level on which it spans few bins, and a
pair meets on the coarser of its two levels, in the first bin that both share.
So a long range costs no more rows than a short one, and no pair comes twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.operators import coverage
from granary.operators.prefix import running_sums

LEVELS, FACTOR, SPAN = 7, 8, 8


def _own_level(size: int) -> Column:
    """The finest level on which a range spans few bins."""
    own = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        first, last = _bins(size * FACTOR**k)
        own = F.when(last - first < SPAN, F.lit(k)).otherwise(own)
    return own


def _bins(width: int) -> tuple[Column, Column]:
    lo, hi = F.col("lo"), F.greatest(F.col("hi"), F.col("lo") + 1)
    return F.floor(lo / width).cast("long"), F.floor((hi - 1) / width).cast("long")


def _binned(df: DataFrame, size: int, prefix: str, others: list[int] | None = None) -> DataFrame:
    """A row for each bin in which a range can meet another one; ``others``: the levels of all those, if known."""
    own = _own_level(size)
    most = range(LEVELS) if others is None else range(min(others, default=LEVELS - 1), LEVELS)
    levels = F.array(*(F.struct(F.lit(k).alias("level"), *(x.alias(n) for x, n in zip(_bins(size * FACTOR**k), ("first", "last"), strict=True))) for k in most))
    # a pair meets on the coarser of its two levels
    kept = F.filter(levels, lambda x: (x["level"] == F.col("__own")) | ((x["level"] > F.col("__own")) & (F.lit(True) if others is None else x["level"].isin(others))))
    cells = F.flatten(F.transform(kept, lambda x: F.transform(F.sequence(x["first"], x["last"]), lambda b: F.struct(x["level"].alias("level"), b.alias("bin")))))
    named = df.withColumn("__own", own).withColumn("__cell", F.explode(cells))
    return named.select(*(F.col(c).alias(f"{prefix}{c}") for c in df.columns), F.col("__own").alias(f"{prefix}own"), F.col("__cell.level").alias("__level"), F.col("__cell.bin").alias("__bin"))


def levels_of(ranges: DataFrame, size: int = 64) -> list[int]:
    """The levels on which the ranges are, a few numbers."""
    return sorted(r[0] for r in ranges.select(_own_level(size).alias("level")).distinct().collect())


def overlap_join(left: DataFrame, right: DataFrame, size: int = 64, right_levels: list[int] | None = None) -> DataFrame:
    """All pairs with a common position, as columns ``l_*`` and ``r_*``; with ``right_levels`` (see ``levels_of``) the left side is fewer rows."""
    a, b = _binned(left, size, "l_", right_levels), _binned(right, size, "r_")
    a = a.withColumnRenamed("l_contig", "__contig")
    b = b.withColumnRenamed("r_contig", "__contig")
    joined = a.join(b, ["__contig", "__level", "__bin"]).filter(
        (F.col("l_lo") < F.col("r_hi"))
        & (F.col("r_lo") < F.col("l_hi"))
        & (F.col("__level") == F.greatest("l_own", "r_own"))
        & (F.col("__bin") == F.floor(F.greatest("l_lo", "r_lo") / (F.lit(size) * F.pow(F.lit(float(FACTOR)), F.col("__level")))).cast("long"))
    )
    rest = [c for c in joined.columns if c not in ("__contig", "__level", "__bin", "l_own", "r_own")]
    return joined.select(F.col("__contig").alias("contig"), *rest)


def best_match(pairs: DataFrame, read: list[str], order: list[Column]) -> DataFrame:
    """The first pair of each read (columns ``read``) by ``order``."""
    w = Window.partitionBy(*read).orderBy(*order)
    return pairs.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def union(ranges: DataFrame) -> DataFrame:
    """The ranges' union as disjoint ranges; touching ranges are one."""
    steps = coverage.steps(ranges)
    islands = running_sums(steps.withColumn("gap", (F.col("depth") == 0).cast("long")), ["contig"], "lo", coverage.chunk("lo"), {"island": F.col("gap")}).drop("__next")
    return islands.filter("depth > 0").groupBy("contig", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("island")


def gaps(ranges: DataFrame) -> DataFrame:
    """What lies between the ranges of each contig."""
    return coverage.steps(ranges).filter("depth = 0").select("contig", "lo", "hi")


def semi_overlapping(rows: DataFrame, disjoint: DataFrame, lo: str = "lo", hi: str = "hi", size: int = 64) -> DataFrame:
    """Rows that have a position in common with any of the disjoint ranges, each once: it meets the first of them alone."""
    before = F.lag("hi").over(Window.partitionBy("contig").orderBy("lo"))  # of ranges, not of rows
    left = rows.select("contig", F.col(lo).alias("lo"), F.col(hi).alias("hi"), F.struct(*rows.columns).alias("row"))
    pairs = overlap_join(left, disjoint.select("contig", "lo", "hi").withColumn("before", before), size, levels_of(disjoint, size))
    return pairs.filter("r_before IS NULL OR r_before <= l_lo").select("l_row.*")
