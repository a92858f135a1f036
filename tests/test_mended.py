"""Order of merged rows, quantiles with far values, tables of cuts, weighted edits against a version cell by cell."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.functions import arrays
from granary.operators import alignments as al
from granary.operators import filters, metrics


def test_disorder_is_seen_within_and_between_partitions(spark):
    x = spark.range(1000).select(F.lit("c").alias("contig"), F.col("id").alias("start"))
    assert tuple(al.disorder(al.merged([x.filter("start % 2 = 0"), x.filter("start % 2 = 1")]), ["contig", "start"]).first()) == (1000, 0)
    parts = spark.createDataFrame([("a", 1), ("a", 5), ("a", 4), ("b", 0)], "contig string, start long").coalesce(1)
    assert tuple(al.disorder(parts, ["contig", "start"]).first()) == (4, 1)
    # in order within each of two partitions, but the second begins below the first one's end
    two = spark.sparkContext.parallelize([("a", 1), ("a", 9), ("a", 2), ("a", 3)], 2).toDF("contig string, start long")
    assert tuple(al.disorder(two, ["contig", "start"]).first()) == (4, 1)
    assert tuple(al.disorder(parts.limit(0), ["contig", "start"]).first()) == (0, 0)


def test_quantiles_with_a_far_value_are_exact_and_dealt_evenly(spark):
    rng = np.random.default_rng(2)
    values = [*rng.normal(0, 1, 3000).tolist(), 1e15]
    df = spark.createDataFrame([(1, v) for v in values] + [(2, None)], "g int, v double")
    got = metrics.quantiles(df, ["g"], "v", {"a": 0.25, "b": 0.999}).collect()
    assert [(r["g"], pytest.approx(r["a"]), pytest.approx(r["b"])) for r in got] == [(1, np.quantile(values, 0.25), np.quantile(values, 0.999))]
    sizes = [r["count"] for r in df.filter("v is not null").groupBy(metrics.even_chunks(df, "v").alias("c")).count().collect()]
    assert max(sizes) < 3000 / 20
    hist = spark.createDataFrame([(1, 3, 2), (1, 7, 2), (2, 5, 1)], "g int, v int, n int")
    assert {r["g"]: r["v"] for r in metrics.upper_median(hist, ["g"], "v", "n").collect()} == {1: 7, 2: 5}
    assert metrics.upper_median(hist, [], "v", "n").first()[0] == 5


def test_the_first_row_of_cuts_that_holds_decides(spark):
    table = spark.createDataFrame([(2, 20, 5.0, 5.0), (1, 30, 1.0, 9.0), (3, 10, 9.0, 9.0)], "row int, q int, a double, b double")
    df = spark.createDataFrame([(0.5, 8.0), (1.0, 9.0), (4.0, 5.0), (4.0, 5.1), (10.0, 0.0), (None, 0.0)], "x double, y double")
    got = filters.looked_up(df, table, "row", {"x": "a", "y": "b"}, "q", 5).collect()
    assert [r["q"] for r in got] == [30, 30, 20, 10, 5, 5]


@pytest.mark.parametrize("swap", [None, 1])
def test_weighted_edits_are_those_of_a_version_cell_by_cell(spark, swap):
    def plain(s, t, sub=2, put=1, gone=3):
        d = [[0] * (len(t) + 1) for _ in range(len(s) + 1)]
        for i in range(len(s) + 1):
            for j in range(len(t) + 1):
                if i or j:
                    ways = [d[i - 1][j] + gone] if i else []
                    ways += [d[i][j - 1] + put] if j else []
                    if i and j:
                        ways.append(d[i - 1][j - 1] + (0 if s[i - 1] == t[j - 1] else sub))
                    if swap is not None and i > 1 and j > 1 and s[i - 1] == t[j - 2] and s[i - 2] == t[j - 1]:
                        ways.append(d[i - 2][j - 2] + swap)
                    d[i][j] = min(ways)
        return d[-1][-1]

    rng = random.Random(4)
    rows = [tuple("".join(rng.choice("abé") for _ in range(rng.randrange(0, 9))) for _ in range(2)) for _ in range(200)]
    df = spark.createDataFrame([*rows, (None, "a")], "s string, t string")
    got = [r["d"] for r in df.select(arrays.weighted_edit(swap=swap)("s", "t").alias("d")).collect()]
    assert got == [*(plain(s, t) for s, t in rows), None]


def test_planted_drift_is_removed_window_by_window(spark):
    rng = np.random.default_rng(7)
    rows = []
    for k in range(5):
        p = rng.integers(0, 4, 200).astype(float)
        t = np.arange(200) / 200
        rows.append((k, (p * (1 - 0.3 * t) + 0.05 + 0.2 * t + rng.normal(0, 0.01, 200)).tolist(), p.tolist()))
    rows += [(9, [], []), (10, [2.0], [2.0]), (11, None, [1.0])]
    got = {r["k"]: r for r in arrays.windowed_normalised(spark.createDataFrame(rows, "k int, m array<double>, p array<double>"), "m", "p", 20, "c").collect()}
    for k, m, p in rows[:5]:
        before, after = np.abs(np.subtract(m, p)).max(), np.abs(np.subtract(got[k]["c"], p))
        assert after.max() < 0.15 < before and after.mean() < 0.03
    assert got[9]["c"] == [] and got[10]["c"] == [2.0] and got[11]["c"] is None


def test_alignments_are_selected_once_however_many_regions_they_meet(spark):
    rows = [("a", "c", 5, 0, "10M", 60), ("b", "c", 5, 0, "4M2I4M", 20), ("d", "c", 50, 0, "10M", 60), ("e", "x", 5, 4, "10M", 60), ("f", "c", 0, 0, "2M", 60)]
    df = spark.createDataFrame(rows, "name string, contig string, start long, flag int, cigar string, mapq int").withColumn("lo", F.lit("own"))
    regions = spark.createDataFrame([("c", 6, 8), ("c", 9, 12), ("c", 7, 10), ("c", 14, 16), ("y", 0, 99)], "contig string, lo long, hi long")
    names = lambda **k: sorted(r["name"] for r in al.selected(df, **k).collect())
    assert names(regions=regions) == ["a", "b"]
    assert names(excluded=4, min_mapq=30) == ["a", "d", "f"]
    assert names(required=4) == ["e"]
    assert names(min_length=10, max_length=10, regions=regions) == ["a", "b"]
    assert al.filtered_and_merged([df, df], regions=regions).count() == 4
    spikes = al.spike_counts(df, spark.createDataFrame([("c",), ("c",), ("z",)], "contig string"), forward_only=True)
    assert [tuple(r) for r in spikes.collect()] == [("c", 3, 60.0)]
