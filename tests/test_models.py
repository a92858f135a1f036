"""Fits against numpy, mergeable metrics against the whole, exact tests against an enumeration, homopolymer contexts against a walk."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.functions import probability
from granary.operators import models, reference, sketches, variants
from tests.test_bases import leftmost, table_of


def planted(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    a = rng.multivariate_normal([1.0, 5.0], [[0.3, 0.1], [0.1, 0.5]], n)
    b = rng.multivariate_normal([4.0, 1.0], [[1.0, -0.4], [-0.4, 0.6]], n // 2)
    return np.concatenate([a, b])


def em(x, mean, cov, share, rounds):
    """The same steps on one matrix."""
    ridge = np.eye(x.shape[1]) * (np.trace(np.cov(x.T, bias=True)) / x.shape[1] * models.RIDGE + 1e-12)
    for _ in range(rounds):
        density = np.stack([s * np.exp(-0.5 * np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m)) / np.sqrt(np.linalg.det(2 * np.pi * c)) for m, c, s in zip(mean, cov, share)], axis=1)
        w = density / density.sum(axis=1, keepdims=True)
        mean = np.stack([w[:, k] @ x / w[:, k].sum() for k in range(w.shape[1])])
        cov = np.stack([(x - mean[k]).T @ ((x - mean[k]) * w[:, k, None]) / w[:, k].sum() + ridge for k in range(w.shape[1])])
        share = w.mean(axis=0)
    return mean, cov, share


def test_mixture_is_that_of_numpy_and_finds_what_was_planted(spark):
    x = planted()
    df = spark.createDataFrame([*map(tuple, x.tolist()), (None, 1.0), (float("nan"), 2.0)], "a double, `b.c` double").repartition(5).withColumnRenamed("b.c", "b")
    start = np.cov(x.T, bias=True)
    start = start + np.eye(2) * (np.trace(start) / 2 * models.RIDGE + 1e-12)
    five = models.normal_mixture(df, ["a", "b"], [[0, 6], [5, 0]], 5, -1)
    mean, cov, share = em(x, np.array([[0.0, 6], [5, 0]]), np.stack([start] * 2), np.array([0.5, 0.5]), 5)
    assert np.allclose(five.mean, mean, atol=1e-6) and np.allclose(five.cov, cov, atol=1e-6) and np.allclose(five.share, share, atol=1e-8)
    found = models.normal_mixture(df, ["a", "b"])
    k = int(found.mean[:, 0].argmin())
    assert np.allclose(found.mean[[k, 1 - k]], [[1, 5], [4, 1]], atol=0.1)
    assert np.allclose(found.cov[k], [[0.3, 0.1], [0.1, 0.5]], atol=0.06) and abs(found.share[k] - 2 / 3) < 0.02
    assert found.rounds < 100
    rows = models.with_posterior(df.withColumn("x.y", F.lit(1)), ["a", "b"], found).collect()
    assert len(rows) == len(x) + 2 and sum(r["component"] is None for r in rows) == 2
    row = next(r for r in rows if r["component"] is not None)
    v = np.array([row["a"], row["b"]]) - found.mean[row["component"]]
    assert row["distance"] == pytest.approx(math.sqrt(v @ np.linalg.inv(found.cov[row["component"]]) @ v))
    assert sum(row["posterior"]) == pytest.approx(1) and row["x.y"] == 1


def test_a_mixture_of_nothing_has_no_share(spark):
    assert models.normal_mixture(spark.createDataFrame([], "a double"), ["a"]).share.sum() == 0
    assert np.isfinite(models.normal_mixture(spark.createDataFrame([(1.0,)] * 9, "a double"), ["a"]).mean).all()


def test_clonal_reads_have_fewer_positive_flows(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(400):
        clonal = k % 2 == 0
        flows = np.where(rng.random(60) < (0.5 if clonal else 0.75), rng.integers(1, 4, 60), 0) + rng.normal(0, 0.03 if clonal else 0.25, 60)
        rows.append((clonal, flows.tolist()))
    rows.append((False, [1.0] * 60))
    got = models.clonality(spark.createDataFrame(rows, "truth boolean, flows array<double>"), "flows").collect()
    assert sum(r["truth"] == r["clonal"] for r in got) >= 0.97 * len(got)
    assert not next(r for r in got if r["ppf"] == 1)["clonal"]


def test_logistic_fit_is_that_of_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, [1, 20], (2000, 2)) + [0, 300]
    y = (rng.random(2000) < 1 / (1 + np.exp(-(0.5 + 1.2 * x[:, 0] - 0.03 * (x[:, 1] - 300))))).astype(float)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)] + [(None, 1.0, 1.0)], "u double, v double, y double").repartition(4)
    fit = models.logistic(df, ["u", "v"], "y")
    z = np.concatenate([np.ones((2000, 1)), x], axis=1)
    b = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-z @ b))
        h = (z * (p * (1 - p))[:, None]).T @ z
        b = b + np.linalg.solve(h, z.T @ (y - p))
    assert np.allclose(fit.value, b, rtol=1e-6) and np.allclose(fit.error, np.sqrt(np.diag(np.linalg.inv(h))), rtol=1e-5)
    assert fit.names == ["intercept", "u", "v"] and fit.p[1] < 1e-6 and fit.n == 2000
    parted = models.logistic(df.withColumn("y", (F.col("u") > 0).cast("double")), ["u"], "y", ridge=0.1)
    assert np.isfinite(parted.value).all() and parted.value[1] > 0


def test_linear_fit_is_that_of_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(1e6, 1, (500, 2))
    y = x @ [2.0, -3.0] + 7 + rng.normal(0, 0.1, 500)
    fit = models.linear(spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "u double, v double, y double"), ["u", "v"], "y")
    z = np.concatenate([np.ones((500, 1)), x - 1e6], axis=1)
    b, rest, *_ = np.linalg.lstsq(z, y, rcond=None)
    cov = np.linalg.inv(z.T @ z) * rest[0] / 497
    assert np.allclose(fit.value[1:], b[1:], atol=1e-6) and np.allclose(fit.error[1:], np.sqrt(np.diag(cov))[1:], rtol=1e-5)


@pytest.mark.parametrize("split", [["g", "b"], ["g", "b", "c"]])
def test_parts_merge_to_the_whole_in_any_grouping(spark, split):
    rng = np.random.default_rng(6)
    rows = [(int(g), int(b), int(c), None if rng.random() < 0.1 else float(v), int(i)) for g, b, c, v, i in zip(*rng.integers(0, 4, (3, 4000)), rng.gamma(2, 10, 4000), rng.integers(0, 900, 4000))]
    df = spark.createDataFrame(rows, "g int, b int, c int, v double, i int").repartition(3)
    whole = {r["g"]: r for r in sketches.final(sketches.partial(df, ["g"], "v", "i", 5.0, 12), ["g"], {"q": 0.9}).collect()}
    parts = sketches.from_json(sketches.to_json(sketches.partial(df, split, "v", "i", 5.0, 12), split), split)
    merged = {r["g"]: r for r in sketches.final(sketches.merged(sketches.merged(parts, split[:2]), ["g"]), ["g"], {"q": 0.9}).collect()}
    for g in range(4):
        own = [r[3] for r in rows if r[0] == g and r[3] is not None]
        a, b = whole[g], merged[g]
        assert (a["n"], a["nulls"], a["least"], a["most"], a["bins"]) == (b["n"], b["nulls"], b["least"], b["most"], b["bins"])
        assert a["n"] == len(own) and sum(a["bins"].values()) == len(own) and max(a["bins"]) <= 11
        assert b["mean"] == pytest.approx(np.mean(own)) and b["var_pop"] == pytest.approx(np.var(own))
        items = len({r[4] for r in rows if r[0] == g})
        assert abs(b["distinct"] - items) < 0.06 * items
        assert abs(np.mean([v <= b["q"] for v in own]) - 0.9) < 0.03
    everything = sketches.final(sketches.merged(parts, []), [], {"q": 0.5}).first()
    assert everything["n"] == sum(r[3] is not None for r in rows)


def test_blocks_are_averaged_by_weight(spark):
    df = spark.createDataFrame([(1, 0.5, 10, [1.0, 2.0]), (1, 0.0, 30, [3.0, 4.0]), (1, None, 5, None), (2, 2.0, 0, [1.0, 1.0])], "g int, v double, w long, t array<double>")
    got = {r["g"]: r["v"] for r in sketches.weighted_mean(df, ["g"], "v", "w").collect()}
    assert got == {1: 0.125, 2: None}
    assert {r["g"]: r["v"] for r in sketches.weighted_mean(df, ["g"], "v", "w", True).collect()}[1] == 0.5
    assert {r["g"]: r["t"] for r in sketches.traces_merged(df, ["g"], "t", "w").collect()}[1] == [2.5, 3.5]


def test_exact_test_is_that_of_an_enumeration(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(12), rng.randrange(12), rng.randrange(12), rng.randrange(40)) for _ in range(80)] + [(0, 0, 0, 0), (5, 0, 0, 5), (300, 280, 290, 310)]

    def exact(a, b, c, d):
        def chance(x):
            return math.comb(a + b, x) * math.comb(c + d, a + c - x)

        low, high = max(0, a + c - c - d), min(a + b, a + c)
        return sum(chance(x) for x in range(low, high + 1) if chance(x) <= chance(a)) / math.comb(a + b + c + d, a + c)

    df = spark.createDataFrame([*rows, (None, 1, 1, 1), (-1, 1, 1, 1)], "a int, b int, c int, d int")
    got = [r["p"] for r in df.select(probability.fisher_exact(*map(F.col, "abcd")).alias("p")).collect()]
    assert got[: len(rows)] == pytest.approx([exact(*r) for r in rows], abs=1e-6) and got[len(rows) :] == [None, None]
    biased = variants.strand_bias(spark.createDataFrame([(30, 0, 50, 50), (2, 0, 50, 50)], "fwd long, rev long, other_fwd long, other_rev long"))
    assert [r["p"] for r in biased.select(variants.unbiased(0.4, 0.01).alias("p")).collect()] == [False, True]


def test_homopolymer_contexts_are_those_of_a_walk(spark):
    rng = random.Random(8)
    ref = "".join(rng.choice("ACGT") * rng.choice([1, 1, 2, 5, 9, 20]) for _ in range(60))
    rows = []
    for k in range(200):
        p, w = rng.randrange(0, len(ref) - 8), rng.randrange(1, 4)
        rows.append((("c", p, ref[p : p + 1 + w], ref[p]) if k % 2 else ("c", p, ref[p], ref[p] + rng.choice([ref[p + 1] * w, rng.choice("ACGT") * w, "AC"]))) + (k,))
    rows.append(("c", 3, "A", "T", 900))
    df = spark.createDataFrame(rows, "contig string, pos long, ref string, alt string, k int")
    blocks = reference.blocks(table_of(spark, {"c": ref}), 32)
    x = reference.homopolymer_context(df, blocks, 16, 32)
    got = {r["k"]: (r["hrun"], r["change"], r["good"]) for r in x.withColumn("good", reference.passes_homopolymer()).collect()}
    for _, pos, r, a, k in rows:
        pos, r, a = leftmost(ref, pos, r, a)
        moved = r[1:] or a[1:]
        if min(len(r), len(a)) > 1 or len(r) == len(a) or len(set(moved)) > 1:
            wanted = (0, 0)
        else:
            behind = ref[pos + 1 : pos + 17]
            wanted = (len(behind) - len(behind.lstrip(moved[0])), len(a) - len(r))
        assert got[k] == (*wanted, not (wanted[0] >= 7 and wanted[1] != 0)), (k, pos, r, a)
