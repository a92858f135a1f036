"""Array expressions whose time grows with the array and not with its square."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Numbers that are added up in one array.
CHUNK = 512


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def running(numbers: Column) -> Column:
    """Sums of the numbers before each place: ``inner`` in its chunk, ``before`` of its chunk; no long array is copied at each step."""

    def sums(x: Column) -> Column:
        return F.aggregate(x, F.array(F.lit(0).cast("long")), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))

    starts = F.sequence(F.lit(1), F.greatest(F.size(numbers), F.lit(1)), F.lit(CHUNK))
    inner = F.transform(starts, lambda k: sums(F.slice(numbers, k, F.lit(CHUNK))))
    return bound(inner, lambda chunks: F.struct(chunks.alias("inner"), sums(F.transform(chunks, lambda c: F.element_at(c, -1))).alias("before")))


def sum_before(sums: Column, i: Column) -> Column:
    """From ``running``, the sum of the numbers before place ``i``."""
    k = F.floor(i / CHUNK).cast("int")
    return F.get(sums["before"], k) + F.get(F.get(sums["inner"], k), i % CHUNK)
