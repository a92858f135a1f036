"""Predicates: bit masks, ordered cascades with accounts, lookups by name, windowed trims."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSED = "passed"


def mask_any(mask: Column, bits: int) -> Column:
    return mask.bitwiseAND(F.lit(bits)) != 0


def mask_all(mask: Column, bits: int) -> Column:
    return mask.bitwiseAND(F.lit(bits)) == bits


def mask_only(mask: Column, bits: int) -> Column:
    return mask == bits


def first_fail(rules: Mapping[str, Column]) -> Column:
    """The name of the first rule that a row fails (its expression is true), or ``passed``."""
    out = F.lit(PASSED)
    for name, fails in reversed(rules.items()):
        out = F.when(fails, F.lit(name)).otherwise(out)
    return out


def accounts(df: DataFrame, rules: Mapping[str, Column], bases: Column) -> DataFrame:
    """Each stage in order: reads and bases that go there, and what is left after it."""
    reason = first_fail(rules)
    names = list(rules)
    sums = df.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(bases), F.lit(0)).alias("b"),
        *(F.count_if(reason == name).alias(f"n{k}") for k, name in enumerate(names)),
        *(F.coalesce(F.sum(F.when(reason == name, bases)), F.lit(0)).alias(f"b{k}") for k, name in enumerate(names)),
    )

    def gone(kind: str, k: int) -> Column:
        return reduce(lambda a, b: a + b, (F.col(f"{kind}{j}") for j in range(k + 1)))

    stages = F.array(
        *(
            F.struct(
                F.lit(k).alias("stage"),
                F.lit(name).alias("reason"),
                F.col(f"n{k}").alias("reads"),
                F.col(f"b{k}").cast("long").alias("bases"),
                (F.col("n") - gone("n", k)).alias("reads_left"),
                (F.col("b") - gone("b", k)).cast("long").alias("bases_left"),
            )
            for k, name in enumerate(names)
        )
    )
    return sums.select(F.inline(stages))


_LOOKUPS = {
    "exact": lambda c, v: c == v,
    "iexact": lambda c, v: F.lower(c) == str(v).lower(),
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
    "in": lambda c, v: c.isin(list(v)),
    "contains": lambda c, v: c.contains(v),
    "icontains": lambda c, v: F.lower(c).contains(str(v).lower()),
    "startswith": lambda c, v: c.startswith(v),
    "endswith": lambda c, v: c.endswith(v),
    "range": lambda c, v: c.between(*v),
    "isnull": lambda c, v: c.isNull() if v else c.isNotNull(),
    "regex": lambda c, v: c.rlike(v),
    "iregex": lambda c, v: c.rlike(f"(?i){v}"),
}


def lookup(**conditions: object) -> Column:
    """``lookup(name__icontains="x", size__gte=3)``: all conditions at once."""
    out = F.lit(True)
    for name, value in conditions.items():
        column, _, kind = name.partition("__")
        out = out & _LOOKUPS[kind or "exact"](F.col(column), value)
    return out


def trimmed_length(quality: Column, threshold: int, least: int = 1) -> Column:
    """Length left after a trim from the far end: windows of a tenth of the length, integer means.

    The scan goes from the last place to the first and stops at the first window
    (cut short at the end) whose mean reaches the threshold; what stands before
    that window is kept, and nothing if no window does or it is below ``least``.
    """
    size = F.size(quality)
    window = F.greatest(F.lit(1), F.floor(size / 10).cast("int"))
    starts = F.sequence(size - 1, F.lit(0), F.lit(-1))

    def good(k: Column) -> Column:
        width = F.least(window, size - k)
        return F.floor(F.aggregate(F.slice(quality, k + 1, width), F.lit(0), lambda a, x: a + x) / width) >= threshold

    found = F.when(size > 0, F.coalesce(F.get(F.filter(starts, good), F.lit(0)), F.lit(0))).otherwise(0)
    return F.when(found >= least, found).otherwise(0)


def clip_and_bin(df: DataFrame, rank: str, total: Column, low: float, high: float, bins: int) -> DataFrame:
    """Rows whose rank lies between two shares of ``total``, with ``bin`` of equally many ranks each."""
    first = F.floor(total * low)
    count = F.floor(total * high) - first
    place = F.col(rank) - 1 - first
    return df.filter((place >= 0) & (place < count)).withColumn("bin", F.floor(place * bins / count).cast("long"))


#: Rows of a table of cuts at most: it goes into each row's expression.
TABLE_ROWS = 10_000


def looked_up(df: DataFrame, table: DataFrame, order: str, cuts: dict[str, str], value: str, other: int) -> DataFrame:
    """Adds ``value`` of the first row of ``table`` by ``order`` all of whose cuts are no less than the predictors, ``other`` where there is none.

    ``cuts``: predictor column to the table's column.
    """
    rows = table.orderBy(order).limit(TABLE_ROWS + 1).collect()
    if len(rows) > TABLE_ROWS:
        raise ValueError(f"a table of cuts has {TABLE_ROWS} rows at most")
    one = F.broadcast(df.sparkSession.createDataFrame([([tuple(float(r[c]) for c in cuts.values()) + (int(r[value]),) for r in rows],)], f"__table array<struct<{', '.join(f'c{k}:double' for k in range(len(cuts)))}, v:int>>"))
    fits = lambda t: F.forall(F.array(*(F.col(p).cast("double") <= t[f"c{k}"] for k, p in enumerate(cuts))), lambda x: x)
    first = F.get(F.filter("__table", fits), F.lit(0))["v"]
    return df.crossJoin(one).withColumn(value, F.coalesce(first, F.lit(other))).drop("__table")  # one row
