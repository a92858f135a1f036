"""Columns worked out in Arrow batches, beside columns of any names."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Work = Callable[[dict[str, pa.Array]], list[pa.Array]]
#: Rows of a batch that are worked on at a time, so that what they are spread out to stays bounded.
ROWS = 2048


def with_arrays(df: DataFrame, fields: list[T.StructField], work: Work, rows: int = ROWS, only: Sequence[str] | None = None) -> DataFrame:
    """Adds ``fields``, which ``work`` makes from the columns of some rows by name; a column that is there already is replaced.

    Columns go by their number on the way, so any name will do; with ``only``, others are not returned.
    """
    names = df.columns
    new = [f.name for f in fields]
    wanted = [k for k, c in enumerate(new) if only is None or c in only]
    kept = [k for k, c in enumerate(names) if c not in new and (only is None or c in only)]
    schema = T.StructType([T.StructField(f"c{k}", df.schema[k].dataType) for k in kept] + [T.StructField(f"n{k}", fields[k].dataType) for k in wanted])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                part = batch.slice(low, rows)
                made = work(dict(zip(names, part.columns, strict=True)))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in kept), *(made[k] for k in wanted)], schema.names)

    return df.toDF(*(f"c{k}" for k in range(len(names)))).mapInArrow(run, schema).toDF(*(names[k] for k in kept), *(new[k] for k in wanted))


def chained(*steps: tuple[list[T.StructField], Work]) -> tuple[list[T.StructField], Work]:
    """Several steps of ``with_arrays`` as one, so that rows go to Python once; each step sees what those before it made."""
    fields = {f.name: f for some, _ in steps for f in some}

    def work(c: dict[str, pa.Array]) -> list[pa.Array]:
        c = dict(c)
        for some, made in steps:
            c.update(zip((f.name for f in some), made(c), strict=True))
        return [c[name] for name in fields]

    return list(fields.values()), work


def dealt(df: DataFrame) -> DataFrame:
    """The rows over as many tasks as a shuffle has, for work that takes long for a row: a file of few row groups is few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def lists(offsets, *columns: tuple[str, pa.Array]) -> pa.Array:
    """A list column of structs from flat columns."""
    inner = pa.StructArray.from_arrays([a for _, a in columns], names=[n for n, _ in columns])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), inner)
