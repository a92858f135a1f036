"""Streams: windows, sessions, late rows, ordered release, and running them to a table."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


#: Buckets of keys whose rows wait for the watermark together; the number can't change between runs of one stream.
BUCKETS = 512
_NO_KEY = -1


@dataclass
class Ends:
    """A folder of rows far behind all others: once they are read, everything before them is closed."""

    path: str
    rows: DataFrame

    def add(self) -> None:
        self.rows.write.mode("append").parquet(self.path)


def read(spark: SparkSession, path: str, time: str, files_per_trigger: int = 8) -> DataFrame:
    """A stream of Parquet files; files a trigger takes are limited, so a backlog is read in steps."""
    schema = spark.read.parquet(path).schema
    out = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{path}*")  # a file or a folder of files
    return out.withColumn(time, F.col(time).cast("timestamp"))


def read_to_end(spark: SparkSession, path: str, time: str, files_per_trigger: int = 8) -> tuple[DataFrame, Ends]:
    """The stream of what is there, and the end of it for ``materialised``: a row without values, years behind the last."""
    stream, known = read(spark, path, time, files_per_trigger), spark.read.parquet(path)
    at = f"{_shared(spark)}/stream-ends-{uuid.uuid4().hex}"
    last = known.agg(F.coalesce(F.max(time).cast("timestamp"), F.lit(0).cast("timestamp")).alias("last"))
    late = (F.col("last") + F.expr("INTERVAL 20 YEARS")).cast(known.schema[time].dataType)
    rows = last.select(*((late if f.name == time else F.lit(None).cast(f.dataType)).alias(f.name) for f in known.schema))
    rows.limit(0).write.parquet(at)
    return stream.unionByName(spark.readStream.schema(known.schema).parquet(at).withColumn(time, F.col(time).cast("timestamp"))), Ends(at, rows)


def tumbling(df: DataFrame, time: str, width: str, by: list[str], late: str, *aggregates) -> DataFrame:
    """Aggregates of windows; in append mode a window comes out when the watermark passes it, and rows later than ``late`` are left out of it."""
    return df.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *by).agg(*aggregates)


def sliding(df: DataFrame, time: str, width: str, step: str, by: list[str], late: str, *aggregates) -> DataFrame:
    return df.withWatermark(time, late).groupBy(F.window(time, width, step).alias("w"), *by).agg(*aggregates)


def sessions(df: DataFrame, time: str, gap: str, by: list[str], late: str, *aggregates) -> DataFrame:
    return df.withWatermark(time, late).groupBy(*by, F.session_window(time, gap).alias("w")).agg(*aggregates)


def deduplicated(df: DataFrame, time: str, key: list[str], late: str) -> DataFrame:
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def in_order(df: DataFrame, key: str, time: str, row: str, late: int, grace: int = 30 * 86_400, buckets: int = BUCKETS) -> DataFrame:
    """Rows of each key in the order of time, as the watermark (``late`` seconds behind the latest row of all) passes them.

    Rows wait in the state of their key's bucket until then, in arrays, as a call for each key takes
    far longer than what is done for it; a timer at the earliest of them brings them out although
    there are no more rows, so a bucket's state is what is not yet passed, and none when nothing
    waits.  A row that comes behind the watermark is given out at once as late; one that comes more
    than ``grace`` seconds later than that is dropped and counted by Spark.
    Columns: key, time, row, late.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, at long, {row} long, late boolean"
    state_schema = f"keys array<{kind}>, codes binary, times binary, ids binary, nulls binary"
    more = grace * 1_000_000

    def walk(bucket: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs() * 1000
        passed = watermark + more if watermark > 0 else -(1 << 62)
        kept = state.get if state.exists else ([], b"", b"", b"", b"")
        n = len(kept[2]) // 8
        new = [] if state.hasTimedOut else list(parts)
        # rows without a key have a bucket of their own, so that no column of keys holds both
        keys = [*kept[0], *(x for p in new for x in ([None] * len(p) if bucket[0] == _NO_KEY else p["__key"].tolist()))]
        code, known = pd.factorize(pd.Series(keys, dtype=object), use_na_sentinel=False)
        code = np.concatenate([code[: len(kept[0])][np.frombuffer(kept[1], np.int32)], code[len(kept[0]) :]]).astype(np.int32)
        at, ids = (np.concatenate([np.frombuffer(x, np.int64), *(p[c].to_numpy(np.int64) for p in new)]) for c, x in (("at", kept[2]), ("__row", kept[3])))
        null = np.concatenate([np.frombuffer(kept[4], bool), *(p["__null"].to_numpy(bool) for p in new)])
        out, behind = at <= passed, at <= passed
        behind = behind & (np.arange(len(at)) >= n)  # these come when the watermark has passed them
        order = np.lexsort((ids, null, at))
        said = np.concatenate([order[(out & ~behind)[order]], order[behind[order]]])
        rest = order[~out[order]]
        if len(rest):
            own, codes = np.unique(code[rest], return_inverse=True)
            state.update(([known[k] for k in own.tolist()], codes.astype(np.int32).tobytes(), at[rest].tobytes(), ids[rest].tobytes(), null[rest].tobytes()))
            # Spark's own watermark is behind this one by the grace
            state.setTimeoutTimestamp(max((int(at[rest[0]]) - more) // 1000, watermark // 1000 + 1))
        elif state.exists:
            state.remove()
        if len(said):
            yield pd.DataFrame({key: pd.Series([known[k] for k in code[said].tolist()], dtype=object), "at": at[said], row: pd.arrays.IntegerArray(ids[said], null[said]), "late": behind[said]})

    bucket = F.when(F.col(key).isNull(), F.lit(_NO_KEY)).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    number = F.col(row).cast("long")
    rows = df.select(bucket.alias("__bucket"), F.col(key).alias("__key"), F.col(time), F.unix_micros(time).alias("at"), F.coalesce(number, F.lit(0).cast("long")).alias("__row"), number.isNull().alias("__null")).withWatermark(time, f"{late + grace} seconds")
    found = rows.groupBy("__bucket").applyInPandasWithState(walk, schema, state_schema, "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(key, F.timestamp_micros("at").alias(time), row, "late")


def to_batches(df: DataFrame, mode: str, act: Callable[[DataFrame, int], None], checkpoint: str):
    """Starts a stream that hands each batch to ``act`` (a sink, a call to another service)."""
    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(act).start()


def _shared(spark: SparkSession) -> str:
    """The folder that all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-granary-"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def materialised(df: DataFrame, mode: str, ends: Ends | None = None) -> DataFrame:
    """Runs a stream over all that is there and returns its table: the last state, or all rows if appended.

    With ``ends`` (see ``read_to_end``) what still waits for the watermark comes out too.  Each
    batch has a folder of its own, written anew if the batch is run again.
    """
    spark = df.sparkSession
    at = f"{_shared(spark)}/stream-{uuid.uuid4().hex}"

    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/out" if mode == "complete" else f"{at}/out/__epoch={epoch}")

    to_batches(df, mode, put, f"{at}/state").awaitTermination()
    for _ in range(2 if ends else 0):  # the first end moves the watermark, the next batch goes by it
        ends.add()
        to_batches(df, mode, put, f"{at}/state").awaitTermination()
    # a path that says which folders to read, so that names beginning with two underscores are read too
    return spark.read.schema(df.schema).parquet(f"{at}/out" if mode == "complete" else f"{at}/out/__epoch=*")
