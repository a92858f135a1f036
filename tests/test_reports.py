"""Reports worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from granary.operators import reports


def test_flow_blocks_change_size_at_ends_only():
    assert reports.flow_blocks("", 45) == [(0, 20), (20, 20), (40, 5)]
    assert reports.flow_blocks("0:10,20:5", 32) == [(0, 10), (10, 10), (20, 5), (25, 5), (30, 2)]
    for wrong in ("5:10", "0:10,15:5", "0:0"):
        with pytest.raises(ValueError, match="block"):
            reports.flow_blocks(wrong, 40)


def test_consensus_is_by_place(spark):
    rows = [("f", "ACG"), ("f", "ACT"), ("f", "GC"), ("g", "T"), ("h", "AC"), ("h", "CA")]
    got = {r["fam"]: (r["bases"], r["reads"]) for r in reports.consensus(spark.createDataFrame(rows, "fam string, s string"), ["fam"], "s", 2).collect()}
    assert got == {"f": ("ACG", 3), "h": ("AA", 2)}


def test_rules_sums_and_ratios(spark):
    x = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "k int, v int")
    assert {(r["k"], r["rule"]) for r in reports.violations(x, ["k"], {"positive": F.col("v") > 0, "known": F.col("v").isNotNull()}).collect()} == {(2, "positive"), (2, "known"), (3, "positive")}
    assert {tuple(r) for r in reports.added([x.filter("k < 3"), x], "k").collect()} == {(1, 10), (2, None), (3, -1)}
    kinds = spark.createDataFrame([("a", "ctl"), ("a", "x"), ("a", "x"), ("b", "x")], "g string, kind string")
    assert {tuple(r) for r in reports.control_ratios(kinds, ["g"], "kind", "ctl").collect()} == {("a", "ctl", 1, 1.0), ("a", "x", 2, 2.0), ("b", "x", 1, None)}
    with pytest.raises(ValueError, match="twice"):
        reports.processed(x, ["k"], [("n", F.count("*")), ("n", F.max("v"))])


def test_quantiles_are_exact(spark):
    import random
    import statistics

    from granary.operators import metrics

    rng = random.Random(2)
    rows = [(g, rng.choice([1.5, 2.0, rng.uniform(-9, 9)])) for g in "aab" for _ in range(rng.randint(30, 90))] + [("c", 4.0), ("c", None), ("d", None)]
    got = {r["g"]: r for r in metrics.quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, chunks=8).collect()}
    for g in "ab":
        want = statistics.quantiles([v for k, v in rows if k == g], n=4, method="inclusive")
        assert [got[g][q] for q in ("q1", "q2", "q3")] == pytest.approx(want)
    assert got["c"]["q1"] == got["c"]["q3"] == 4 and "d" not in got
    assert metrics.quantiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", {"q": 0.5}).count() == 0
