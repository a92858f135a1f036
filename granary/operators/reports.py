"""Reports: named aggregates, rules and what breaks them, sums of several reports, ratios to controls, blocks of flows, consensus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def processed(df: DataFrame, by: list[str], processors: list[tuple[str, Column]]) -> DataFrame:
    """Each group's row of named aggregates; the list is the report's header, and names must differ."""
    names = [n for n, _ in processors]
    if len(set(names)) < len(names):
        raise ValueError(f"names that come twice: {sorted({n for n in names if names.count(n) > 1})}")
    return df.groupBy(*by).agg(*(x.alias(n) for n, x in processors))


def violations(df: DataFrame, keep: list[str], rules: dict[str, Column]) -> DataFrame:
    """One row for each rule that a row breaks; a rule that is null for a row counts as broken."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items())))
    return df.select(*keep, F.explode(broken).alias("rule"))


def added(reports: list[DataFrame], key: str) -> DataFrame:
    """Several reports of the same numeric columns as one, row by row of ``key``; a row that a report lacks adds nothing."""
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out.groupBy(key).agg(*(F.sum(c).alias(c) for c in reports[0].columns if c != key))


def control_ratios(df: DataFrame, by: list[str], kind: str, control: str) -> DataFrame:
    """Counts of each kind in each group, and their ratio to the group's count of ``control`` (null if it has none)."""
    counts = df.groupBy(*by, kind).agg(F.count("*").alias("n"))
    controls = counts.filter(F.col(kind) == control).select(*by, F.col("n").alias("controls"))
    return counts.join(controls, by, "left").select(*by, kind, "n", F.try_divide("n", "controls").alias("ratio"))


def flow_blocks(spec: str, total: int) -> list[tuple[int, int]]:
    """Blocks (first flow, size) of ``start:size,start:size`` up to ``total`` flows; a size may change at a block's end only."""
    parts = [tuple(map(int, x.split(":"))) for x in spec.split(",")] if spec else [(0, 20)]
    if parts[0][0] != 0 or any(n <= 0 for _, n in parts):
        raise ValueError(f"blocks must begin at 0 and have flows: {spec!r}")
    out, at = [], 0
    for (start, size), (end, _) in zip(parts, [*parts[1:], (total, 0)], strict=True):
        if start != at or end < start:
            raise ValueError(f"a block does not end at {start}: {spec!r}")
        while at < end:
            out.append((at, min(size, total - at)))
            at += size
    return out


def block_of(flow: Column, blocks: list[tuple[int, int]]) -> Column:
    """The number of the block that a flow is in, null behind the last one."""
    out = F.lit(None).cast("int")
    for k, (first, size) in reversed(list(enumerate(blocks))):
        out = F.when((flow >= first) & (flow < first + size), F.lit(k)).otherwise(out)
    return out


#: Reads of a family that are counted in one task, about.
SALT_READS = 1_000_000


def consensus(df: DataFrame, family: list[str], sequence: str, least: int = 1, salt_reads: int = SALT_READS) -> DataFrame:
    """``bases`` and ``reads`` of each family of at least ``least`` reads: the base that most have at each place, the smaller of two.

    Whole reads are dealt by family, those of a very large one over salts, and taken apart there, so
    that a read is shuffled once, whatever the order of the rows, and then the sums of each family.
    """
    counts = df.groupBy(*family).agg(F.count("*").alias("reads"))
    # a row for each ``salt_reads`` reads at most
    large = counts.filter(F.col("reads") > salt_reads).select(*family, F.ceil(F.col("reads") / salt_reads).cast("int").alias("__salts"))
    salt = F.pmod(F.monotonically_increasing_id(), F.coalesce("__salts", F.lit(1)))
    reads = df.select(*family, F.col(sequence).alias("__bases")).join(F.broadcast(large), family, "left").select(*family, "__bases", salt.alias("__salt"))
    each = reads.repartition(*family, "__salt").select(*family, "__salt", F.posexplode(F.filter(F.split("__bases", ""), lambda b: b != "")).alias("place", "base"))
    votes = each.groupBy(*family, "__salt", "place", "base").agg(F.count("*").alias("n"))
    # all that follows goes by family, so this is the last shuffle of votes
    votes = votes.repartition(*family).groupBy(*family, "place", "base").agg(F.sum("n").alias("n"))
    best = votes.groupBy(*family, "place").agg(F.min_by("base", F.struct(-F.col("n"), "base")).alias("base"))
    rows = best.groupBy(*family).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "base"))), lambda x: x["base"]), "").alias("bases"))
    return rows.join(counts.filter(F.col("reads") >= least), family)


def parsed_time(text: Column, formats: list[str], fallback: Column) -> Column:
    """The time of a log line by the first format that fits, or ``fallback``."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats), fallback)
