"""Operators by name, with the columns they say they return.

An operator is a function from a DataFrame (and parameters) to a DataFrame.
Registering one makes it callable by name; what it returns is held against the
columns it declared before anything runs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Operator:
    name: str
    function: Callable[..., DataFrame]
    columns: Mapping[str, str]
    needs: tuple[str, ...] = ()


OPERATORS: dict[str, Operator] = {}


def operator(name: str, columns: Mapping[str, str], needs: tuple[str, ...] = ()) -> Callable:
    """Registers a function under ``name``; ``needs`` are the columns it reads."""

    def register(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        if name in OPERATORS:
            raise ValueError(f"{name} is registered twice")
        OPERATORS[name] = Operator(name, function, dict(columns), needs)
        return function

    return register


def run(name: str, df: DataFrame, **parameters: object) -> DataFrame:
    found = OPERATORS[name]
    if missing := [c for c in found.needs if c not in df.columns]:
        raise ValueError(f"{name} needs {missing}")
    out = found.function(df, **parameters)
    kinds = dict(out.dtypes)
    if wrong := {c: kinds.get(c) for c, t in found.columns.items() if kinds.get(c) != t}:
        raise TypeError(f"{name} returned {wrong}, not {dict(found.columns)}")
    return out


def _builtin() -> None:
    from granary.operators import coverage, dedup, intervals

    ranges = {"contig": "string", "lo": "bigint", "hi": "bigint"}
    operator("depth", ranges | {"depth": "bigint", "fwd": "bigint", "rev": "bigint"}, ("contig", "lo", "hi"))(coverage.steps)
    operator("union", ranges, ("contig", "lo", "hi"))(intervals.union)
    operator("gaps", ranges, ("contig", "lo", "hi"))(intervals.gaps)
    operator("duplicates", {"duplicate": "boolean"}, ("contig", "adapter", "forward", "lo", "hi", "flow", "has_adapter"))(dedup.mark_duplicates)


_builtin()
