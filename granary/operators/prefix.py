"""Running sums over long orders without one long window.

An order (positions of a contig, values of a column) is cut into chunks.  The
chunks' sums are added up in one short window over the chunks, and each chunk's
running sum is a window of its own, so a contig with most of the rows is many
tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, by: list[str], order: str, chunk: Column, sums: dict[str, Column], tie: list[str] | None = None) -> DataFrame:
    """Adds for each name in ``sums`` the sum of its expression over all rows up to this one.

    ``chunk`` must rise with ``order``; rows of equal order are ordered by ``tie``.
    Also adds ``__next``, the next value of ``order`` within ``by``.
    """
    cut = df.withColumn("__chunk", chunk)
    keys = [*by, "__chunk"]
    parts = cut.groupBy(*keys).agg(*(F.sum(x).alias(f"__{n}") for n, x in sums.items()), F.min(order).alias("__first"))
    over = Window.partitionBy(*by).orderBy("__chunk")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*keys, *(F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in sums), F.lead("__first").over(over).alias("__after"))
    own = Window.partitionBy(*keys).orderBy(order, *(tie or []))
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    joined = cut.join(offsets, keys)
    return joined.select(
        *df.columns,
        *((F.sum(x).over(upto) + F.col(f"__{n}")).alias(n) for n, x in sums.items()),
        F.coalesce(F.lead(order).over(own), F.col("__after")).alias("__next"),
    )


def ranked(df: DataFrame, by: list[str], order: str, chunk: Column, tie: list[str] | None = None, name: str = "rank") -> DataFrame:
    """Adds the rank (from 1) of each row by ``order``."""
    return running_sums(df, by, order, chunk, {name: F.lit(1)}, tie).drop("__next")
