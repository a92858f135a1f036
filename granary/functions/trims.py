"""Trims and small calls on reads, as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_prefix(seq: Column, prefix: str) -> Column:
    """The sequence without a key, null where it doesn't begin with it."""
    return F.when(seq.startswith(prefix), F.substr(seq, F.lit(len(prefix) + 1)))


def adapter_start(seq: Column, adapter: str, least: int) -> Column:
    """Where (from 0) the adapter or, at the end, at least ``least`` of its first bases begin; null if nowhere."""
    whole = F.locate(adapter, seq)
    tails = [F.when(seq.endswith(adapter[:n]), F.length(seq) - n) for n in range(len(adapter) - 1, least - 1, -1)]
    return F.coalesce(F.when(whole > 0, whole - 1), *tails)


def trimmed(seq: Column, adapter: str, least: int = 4) -> Column:
    return F.coalesce(F.substr(seq, F.lit(1), adapter_start(seq, adapter, least)), seq)


def expected_error_length(errors: Column, most: float) -> Column:
    """The longest prefix whose expected errors (a sum of probabilities) are at most ``most``."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("sum"), F.lit(True).alias("on"))

    def step(s: Column, e: Column) -> Column:
        on = s["on"] & (s["sum"] + e <= most)
        return F.struct(F.when(on, s["n"] + 1).otherwise(s["n"]).alias("n"), (s["sum"] + e).alias("sum"), on.alias("on"))

    return F.aggregate(errors, zero, step, lambda s: s["n"])


def positive_share(flows: Column, threshold: float = 0.25) -> Column:
    """Share of flows with a signal over the threshold; a mixture of templates has many."""
    return F.size(F.filter(flows, lambda x: x > threshold)) / F.size(flows)


def fractional_squares(flows: Column) -> Column:
    """Sum of the squares of what the flows are off whole numbers."""
    return F.aggregate(flows, F.lit(0.0), lambda s, x: s + (x - F.round(x)) * (x - F.round(x)))


def trimmed_alleles(pos: Column, ref: Column, alt: Column) -> Column:
    """An allele without the bases both share, at the end first and then at the start, one left of each: (pos, ref, alt)."""
    room = F.least(F.length(ref), F.length(alt)) - 1

    def shared(a: Column, b: Column, most: Column) -> Column:
        n = F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
        return F.size(F.filter(n, lambda k: F.substr(a, F.lit(1), k) == F.substr(b, F.lit(1), k)))

    tail = shared(F.reverse(ref), F.reverse(alt), room)
    ref1, alt1 = F.substr(ref, F.lit(1), F.length(ref) - tail), F.substr(alt, F.lit(1), F.length(alt) - tail)
    head = shared(ref1, alt1, room - tail)
    return F.struct((pos + head).alias("pos"), F.substr(ref1, head + 1).alias("ref"), F.substr(alt1, head + 1).alias("alt"))


def mismatches(md: Column) -> Column:
    """The reference bases that an MD tag says were read otherwise; deletions are left out."""
    return F.regexp_extract_all(F.regexp_replace(md, r"\^[A-Za-z]+", ""), F.lit("[A-Za-z]"), F.lit(0))


def gene_label(info: Column) -> Column:
    """The gene of ``GENE_ID=a;..`` text; fusions' two genes are joined by ``-/-``."""
    genes = F.array_distinct(F.regexp_extract_all(info, F.lit(r"GENE_ID=([^;,]*)"), F.lit(1)))
    return F.array_join(F.filter(genes, lambda g: g != ""), "-/-")


def sex_call(y_reads: Column, reads: Column, least_reads: int, least_percent: float) -> Column:
    """``M`` from a percentage of reads on Y, else ``F``; ``N/A`` of too few reads."""
    return F.when(reads < least_reads, "N/A").when(100.0 * y_reads / reads >= least_percent, "M").otherwise("F")
