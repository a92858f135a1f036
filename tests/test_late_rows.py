"""Streams in batches of one file each: late rows, closed windows, ordered release, and what is left in the state."""

from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

from granary.plans.stream_queries import stream_ordered_release
from granary.streaming import events

START = datetime.datetime(2024, 1, 1)


def files(spark, at, batches):
    """One file a batch, in their order; rows are (event_id, user_id, hours)."""
    at.mkdir(parents=True)
    for k, rows in enumerate(batches):
        data = [(i, u, START + datetime.timedelta(hours=h)) for i, u, h in rows]
        spark.createDataFrame(data, "event_id long, user_id long, ts timestamp").coalesce(1).write.parquet(str(at.parent / f"{at.name}-one{k}"))
        part = next((at.parent / f"{at.name}-one{k}").glob("part-*.parquet"))
        part.rename(at / f"part-{k}.parquet")
        os.utime(at / f"part-{k}.parquet", (1_700_000_000 + 60 * k,) * 2)
    return str(at)


def test_rows_behind_an_earlier_batch_are_released(spark, tmp_path):
    # more files than a batch takes, the latest event in the oldest file
    files(spark, tmp_path / "events.parquet", [[(k, 1, 20 - 2 * k)] for k in range(10)])
    got = stream_ordered_release(spark, str(tmp_path)).collect()
    assert sorted(r["event_id"] for r in got) == list(range(10))


BATCHES = [[(1, 1, 1.0), (2, 2, 1.5)], [(3, 1, 10.0)], [(4, 1, 10.2)], [(5, 1, 1.2), (6, 1, 9.9), (7, 2, 10.3)], [(8, 1, 12.0)]]


@pytest.mark.parametrize(
    ("kind", "wanted"),
    [
        # row 5 comes when its window has been closed by row 3; row 6 is early enough
        ("tumbling", {(1, 1): 1, (2, 1): 1, (1, 9): 1, (1, 10): 2, (2, 10): 1, (1, 12): 1}),
        ("sessions", {(1, 1): 1, (2, 1.5): 1, (1, 9.9): 3, (2, 10.3): 1, (1, 12): 1}),
    ],
)
def test_late_rows_are_left_out_of_closed_windows(spark, tmp_path, kind, wanted):
    stream, ends = events.read_to_end(spark, files(spark, tmp_path / "in", BATCHES), "ts", 1)
    count = F.count("*").alias("n")
    df = events.tumbling(stream, "ts", "1 hour", ["user_id"], "30 minutes", count) if kind == "tumbling" else events.sessions(stream, "ts", "1 hour", ["user_id"], "30 minutes", count)
    got = events.materialised(df, "append", ends).collect()
    assert {(r["user_id"], (r["w"]["start"] - START).total_seconds() / 3600): r["n"] for r in got} == wanted


def test_sliding_windows_leave_late_rows_out(spark, tmp_path):
    stream, ends = events.read_to_end(spark, files(spark, tmp_path / "in", BATCHES), "ts", 1)
    got = events.materialised(events.sliding(stream, "ts", "2 hours", "1 hour", [], "30 minutes", F.count("*").alias("n")), "append", ends).collect()
    assert {(r["w"]["start"] - START).total_seconds() / 3600: r["n"] for r in got} == {0: 2, 1: 2, 8: 1, 9: 4, 10: 3, 11: 1, 12: 1}


def test_rows_come_in_order_late_ones_are_marked_and_the_state_is_freed(spark, tmp_path):
    stream, ends = events.read_to_end(spark, files(spark, tmp_path / "in", BATCHES), "ts", 1)
    out, kept = [], []

    def put(batch, epoch):
        out.extend((epoch, r["user_id"], r["event_id"], r["late"]) for r in batch.collect())

    df = events.in_order(stream, "user_id", "ts", "event_id", 1800)
    for n in range(3):
        if n:
            ends.add()
        query = events.to_batches(df, "append", put, str(tmp_path / "state"))
        query.awaitTermination()
        kept.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1])
    assert [r[2] for r in out if r[1] == 1 and not r[3]] == [1, 6, 3, 4, 8]
    assert [r[2] for r in out if r[1] == 2] == [2, 7]
    assert [r[2] for r in out if r[3]] == [5]
    epochs = {r[2]: r[0] for r in out}
    assert epochs[1] < epochs[3]  # not all at the end
    assert epochs[1] <= epochs[2] < epochs[7]  # user 2 had no more rows yet: the timer brings its row out
    assert kept[-1] <= 1  # the end's own row waits


def test_keys_share_a_call_and_keep_their_order(spark, tmp_path):
    rows = [(k if k % 7 else None, k * 4_000_000_000_000_007 if k % 5 else None, START + datetime.timedelta(seconds=(k * 7919) % 4000)) for k in range(2000)]
    events_ = spark.createDataFrame(rows, "user_id long, event_id long, ts timestamp").repartition(3)
    events_.write.parquet(str(tmp_path / "in"))
    stream, ends = events.read_to_end(spark, str(tmp_path / "in"), "ts", 1)
    given = []

    df = events.in_order(stream, "user_id", "ts", "event_id", 5000, buckets=4)
    query = events.to_batches(df, "append", lambda batch, _: given.extend(map(tuple, batch.collect())), str(tmp_path / "state"))
    query.awaitTermination()
    # rows of all keys wait in the four buckets, and in the one of rows without a key
    assert [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1] == 5
    for _ in range(2):
        ends.add()
        events.to_batches(df, "append", lambda batch, _: given.extend(map(tuple, batch.collect())), str(tmp_path / "state")).awaitTermination()
    wanted = sorted(rows, key=lambda r: (r[2], r[1] is None, r[1] or 0))
    for user in (None, 1, 2, 1999):
        assert [(u, i, t) for u, t, i, late in given if u == user and not late] == [(u, i, t) for u, i, t in wanted if u == user]
    assert len(given) == 2000
