"""Streaming queries, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.plans.catalog import query
from granary.streaming import events


def _stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, events.Ends]:
    return events.read_to_end(spark, f"{sf_dir}/events.parquet", "ts")


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, ends = _stream(spark, sf_dir)
    out = events.materialised(events.tumbling(stream, "ts", "1 hour", ["event_type"], "30 minutes", F.count("*").alias("n")), "append", ends)
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("WITH w AS (SELECT unnest([time_bucket(INTERVAL '6 hours', ts), time_bucket(INTERVAL '6 hours', ts) - INTERVAL '6 hours']) AS start FROM events) SELECT start, count(*) AS n FROM w GROUP BY start")
def stream_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, ends = _stream(spark, sf_dir)
    out = events.materialised(events.sliding(stream, "ts", "12 hours", "6 hours", [], "30 minutes", F.count("*").alias("n")), "append", ends)
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query(
    """WITH l AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events), s AS (SELECT *, count(*) FILTER (p IS NULL OR ts >= p + INTERVAL '4 hours') OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM l)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k"""
)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, ends = _stream(spark, sf_dir)
    out = events.materialised(events.sessions(stream, "ts", "4 hours", ["user_id"], "30 minutes", F.count("*").alias("n")), "append", ends)
    return out.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("SELECT event_id, user_id FROM events")
def stream_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = events.read(spark, f"{sf_dir}/events.parquet", "ts")
    return events.materialised(events.deduplicated(x.union(x), "ts", ["event_id"], "30 days").select("event_id", "user_id"), "append")


@query("SELECT user_id, ts, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events")
def stream_ordered_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of each user as they come out, in order; ``before`` is the one given out before it."""
    stream, ends = _stream(spark, sf_dir)
    out = events.materialised(events.in_order(stream, "user_id", "ts", "event_id", 3600), "append", ends)
    before = F.lag("event_id").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return out.select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", before.alias("before"))
