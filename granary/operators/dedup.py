"""Duplicate reads and molecular families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mark_duplicates(reads: DataFrame) -> DataFrame:
    """Adds ``duplicate`` to reads of contig, adapter, strand and start (end if reverse).

    Within a group the read of the highest flow stays.  Another read is a
    duplicate unless it reached its adapter at a flow strictly below that of
    every earlier read that did.  Reads of one flow are taken with those that
    reached the adapter first; equal reads are alike.
    """
    anchor = F.when(F.col("forward"), F.col("lo")).otherwise(F.col("hi"))
    w = Window.partitionBy("contig", "adapter", "forward", "__anchor").orderBy(F.desc("flow"), F.desc("has_adapter"))
    least = F.min(F.when(F.col("has_adapter"), F.col("flow"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = reads.withColumn("__anchor", anchor).withColumns({"__n": F.row_number().over(w), "__least": least})
    distinct = F.col("has_adapter") & (F.col("__least").isNull() | (F.col("flow") < F.col("__least")))
    return x.withColumn("duplicate", (F.col("__n") > 1) & ~distinct).drop("__anchor", "__n", "__least")


def duplicate_counts(reads: DataFrame) -> DataFrame:
    """``mark_duplicates`` as counts of reads and duplicates by contig, adapter, strand, ends, flow and adapter mark.

    Equal reads are counted before they are ranked, so a position that very
    many reads begin at is no more rows than it has flows.  Of equal reads one
    at most stays.
    """
    cell = ["contig", "adapter", "forward", "lo", "hi", "flow", "has_adapter"]
    cells = reads.groupBy(*cell).agg(F.count("*").alias("reads"))
    anchored = cells.withColumn("__anchor", F.when(F.col("forward"), F.col("lo")).otherwise(F.col("hi")))
    w = Window.partitionBy("contig", "adapter", "forward", "__anchor").orderBy(F.desc("flow"), F.desc("has_adapter"), "lo", "hi")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    least = F.min(F.when(F.col("has_adapter"), F.col("flow"))).over(before)
    x = anchored.withColumns({"__n": F.row_number().over(w), "__least": least})
    stays = (F.col("__n") == 1) | (F.col("has_adapter") & (F.col("__least").isNull() | (F.col("flow") < F.col("__least"))))
    return x.select(*cell, "reads", (F.col("reads") - stays.cast("long")).alias("duplicates"))


def majority(df: DataFrame, family: list[str], value: Column, name: str) -> DataFrame:
    """Each family's most frequent value (ties: the least), its votes and the family's size."""
    votes = df.groupBy(*family, value.alias(name)).agg(F.count("*").alias("votes"))
    best = F.min_by(F.struct(F.col(name), F.col("votes")), F.struct(-F.col("votes"), F.col(name)))
    return votes.groupBy(*family).agg(F.sum("votes").alias("size"), best.alias("__b")).select(*family, "size", f"__b.{name}", "__b.votes")


def exact(df: DataFrame, value: Column, key: str) -> DataFrame:
    """Groups of rows with one value: digest, how many, and the least key."""
    return df.groupBy(F.sha2(value, 256).alias("digest")).agg(F.count("*").alias("copies"), F.min(key).alias("first"))
