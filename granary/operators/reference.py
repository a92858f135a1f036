"""A reference kept in blocks of bases: windows of it beside rows, alleles shifted left, homopolymer contexts.

Blocks: ``contig``, ``block``, ``seq``; block k holds the bases from ``k * size`` on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators.arrow import with_arrays
from granary.operators.variants import normalised

BLOCK = 4096
#: Bases looked at in the first round of a shift; each later round looks at eight times as many.
FIRST_REACH, GROWTH = 64, 8


def blocks(bases: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks from one row a base: ``contig``, ``pos`` (from 0), ``base``; a place without a row is ``N``."""
    # a block is at most ``size`` bases, whatever the contig
    keyed = bases.select("contig", F.floor(F.col("pos") / size).cast("long").alias("block"), F.struct((F.col("pos") % size).cast("int").alias("at"), F.col("base").alias("base")).alias("b"))
    held = keyed.groupBy("contig", "block").agg(F.array_sort(F.collect_list("b")).alias("m"))

    def filled(b: Column, k: Column) -> Column:
        gap = b["at"] - F.coalesce(F.get("m", k - 1)["at"], F.lit(-1)) - 1
        return F.concat(F.when(gap < 0, F.raise_error(F.lit("two bases at one place"))).otherwise(F.repeat(F.lit("N"), gap)), F.coalesce(b["base"], F.lit("N")))

    return held.select("contig", "block", F.array_join(F.transform("m", filled), "").alias("seq"))


def lengthened(reference: DataFrame, over: int, size: int = BLOCK) -> DataFrame:
    """Blocks with ``over`` more bases from the blocks behind them."""
    more = -(-over // size)
    copies = reference.select("contig", F.explode(F.sequence(F.greatest(F.col("block") - more, F.lit(0)), "block")).alias("to"), "block", "seq")
    joined = copies.groupBy("contig", F.col("to").alias("block")).agg(F.array_sort(F.collect_list(F.struct("block", "seq"))).alias("parts"))  # more + 1 blocks at most
    own = F.filter("parts", lambda p: p["block"] == F.col("block"))
    # a contig's blocks are all there, so parts in their order are bases in their order
    return joined.filter(F.size(own) > 0).select("contig", "block", F.substr(F.array_join(F.transform("parts", lambda p: p["seq"]), ""), F.lit(1), F.lit(size + over)).alias("seq"))


def with_window(rows: DataFrame, reference: DataFrame, lo: Column, hi: Column, over: int, name: str = "ref", size: int = BLOCK) -> DataFrame:
    """Adds ``name``, the reference bases of [lo, hi) of each row's contig, cut off at the contig's ends; ``hi - lo`` is ``over`` at most.

    One join on contig and block: rows meet the block in which they begin, which is longer by ``over``.
    """
    low = F.greatest(lo, F.lit(0)).cast("long")
    keyed = rows.withColumns({"__lo": low, "__hi": F.greatest(hi.cast("long"), low)}).withColumn("block", F.floor(F.col("__lo") / size).cast("long"))
    long = lengthened(reference, over, size).withColumnRenamed("seq", "__seq")
    found = F.substr("__seq", (F.col("__lo") - F.col("block") * size + 1).cast("int"), (F.col("__hi") - F.col("__lo")).cast("int"))
    return keyed.join(long, ["contig", "block"], "left").withColumn(name, F.coalesce(found, F.lit(""))).drop("__lo", "__hi", "__seq", "block")


def _periodic_tails(c: dict[str, pa.Array]) -> list[pa.Array]:
    """How many letters at the end of ``__upper`` are equal to the one ``__length`` letters before; ``N`` equals nothing."""
    from granary.operators.matches import letters

    code, first = letters(c["__upper"])
    period, n = c["__length"].to_numpy(zero_copy_only=False).astype(np.int64), np.diff(first)
    room = np.maximum(n - period, 0)
    row = np.repeat(np.arange(len(n)), room)
    at = np.repeat(first[1:] - room - (np.cumsum(room) - room), room) + np.arange(len(row))
    before = code[at - period[row]]
    differs = np.flatnonzero((code[at] != before) | (before == ord("N")))
    # of each row the last place that differs, or the one before its first
    last = first[1:] - room - 1
    np.maximum.at(last, row[differs], at[differs])
    return [pa.array((first[1:] - 1 - last).astype(np.int32))]


def left_aligned(variants: DataFrame, reference: DataFrame, size: int = BLOCK, first_reach: int = FIRST_REACH) -> DataFrame:
    """Alleles trimmed, and insertions and deletions at the leftmost of the places that give the same sequence.

    Columns: contig, pos (from 0), ref, alt and any others.  A change of length by L whose
    bases are S can go left while the base before it is the one L behind that: the reference
    before the change and S in a row have the period L there.  How far, is looked up in a
    window before the change; what is equal up to its edge goes on in a larger window, so
    rounds grow with the logarithm of the longest repeat, and few rows take part in later ones.
    A change stops with the base before it at a contig's first place; ``N`` equals nothing.
    """
    x = normalised(variants)
    first_same = F.substr("ref", F.lit(1), F.lit(1)) == F.substr("alt", F.lit(1), F.lit(1))
    indel = (F.least(F.length("ref"), F.length("alt")) == 1) & (F.length("ref") != F.length("alt")) & first_same
    x = x.withColumn("__open", F.coalesce(indel, F.lit(False)))
    done, open_, reach = x.filter("not __open"), x.filter("__open"), first_reach
    while True:
        shifted = _shifted(open_, reference, reach, size).persist()  # the next round reads it, and the result
        done = done.unionByName(shifted.filter("not __open"))
        open_ = shifted.filter("__open")
        if not open_.take(1):
            return done.drop("__open")
        reach *= GROWTH


def _shifted(rows: DataFrame, reference: DataFrame, reach: int, size: int) -> DataFrame:
    """Each change as far left as a window of ``reach`` bases shows; ``__open`` where it may go on."""
    own = F.when(F.length("ref") > 1, F.substr("ref", F.lit(2))).otherwise(F.substr("alt", F.lit(2)))
    # the window ends with the base before the change
    seen = with_window(rows, reference, F.col("pos") + 1 - reach, F.col("pos") + 1, reach, "__before", size)
    seen = seen.withColumn("__own", own).withColumn("__all", F.concat("__before", "__own"))
    seen = with_arrays(seen.withColumns({"__upper": F.upper("__all"), "__length": F.length("__own")}), [T.StructField("__same", T.IntegerType())], _periodic_tails)
    length = F.col("__length")
    # the base before the change stays one of the reference
    most = F.greatest(F.length("__before") - 1, F.lit(0))
    seen = seen.withColumn("__most", most).withColumn("__k", F.least("__same", "__most"))
    end = F.length("__all") - F.col("__k")
    moved, anchor = F.substr("__all", end - length + 1, length), F.substr("__all", end - length, F.lit(1))
    deletion, shift = F.length("ref") > 1, F.col("__k") > 0
    return seen.select(
        *(c for c in rows.columns if c not in ("pos", "ref", "alt", "__open")),
        (F.col("pos") - F.col("__k")).alias("pos"),
        F.when(~shift, F.col("ref")).when(deletion, F.concat(anchor, moved)).otherwise(anchor).alias("ref"),
        F.when(~shift, F.col("alt")).when(deletion, anchor).otherwise(F.concat(anchor, moved)).alias("alt"),
        (shift & (F.col("__k") == F.col("__most")) & (F.col("pos") > F.col("__k"))).alias("__open"),
    )


def annotated(calls: DataFrame, hints: DataFrame, reference: DataFrame, by: list[str] | None = None, size: int = BLOCK) -> DataFrame:
    """Calls with the columns of the hints of the same change, wherever in a repeat either is written."""
    return left_aligned(calls, reference, size).join(left_aligned(hints, reference, size), [*(by or ["contig"]), "pos", "ref", "alt"], "left")


#: Homopolymers of these lengths or more, and how long insertions and deletions in them may be.
HRUN, INSERTED, DELETED = (7, 8), (0, 0), (0, 0)


def homopolymer_context(variants: DataFrame, reference: DataFrame, longest: int = 64, size: int = BLOCK) -> DataFrame:
    """Adds ``hrun`` and ``change``: of an insertion or deletion of one kind of base, how long the run of that base behind its place is, and by how much it changes.

    ``change`` is negative for a deletion, 0 where the variant is none of this kind; runs are
    looked at up to ``longest`` bases.  Variants are shifted left first, so a run begins behind its place.
    """
    x = left_aligned(variants, reference, size)
    moved = F.when(F.length("ref") > 1, F.substr("ref", F.lit(2))).otherwise(F.substr("alt", F.lit(2)))
    kind = F.upper(F.substr(moved, F.lit(1), F.lit(1)))
    indel = (F.least(F.length("ref"), F.length("alt")) == 1) & (F.length("ref") != F.length("alt")) & (F.length(F.replace(F.upper(moved), kind, F.lit(""))) == 0)
    seen = with_window(x, reference, F.col("pos") + 1, F.col("pos") + 1 + longest, longest, "__behind", size)
    run = F.length("__behind") - F.length(F.ltrim(F.upper("__behind"), kind))
    return seen.withColumns({"change": F.when(indel, F.length("alt") - F.length("ref")).otherwise(0), "hrun": F.when(indel, run).otherwise(0)}).drop("__behind")


def passes_homopolymer(hrun: tuple[int, ...] = HRUN, inserted: tuple[int, ...] = INSERTED, deleted: tuple[int, ...] = DELETED) -> Column:
    """Whether the change is no longer than allowed for every run length that its run reaches (see ``homopolymer_context``)."""
    good = F.lit(True)
    for n, put, gone in zip(hrun, inserted, deleted, strict=True):
        good = good & ~((F.col("hrun") >= n) & ((F.col("change") > put) | (-F.col("change") > gone)))
    return good
