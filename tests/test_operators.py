"""Small tables with answers worked out by hand, and rules held against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from granary.functions import arrays, sequence
from granary.operators import coverage, dedup, expression, filters, intervals, metrics, prefix, relational, variants

READS = "contig string, lo long, hi long, forward boolean"


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_steps_keep_gaps_and_split_strands(spark):
    r = spark.createDataFrame([("a", 0, 10, True), ("a", 5, 12, False), ("a", 20, 21, True), ("b", 3, 4, False)], READS)
    assert rows(coverage.steps(r)) == [("a", 0, 5, 1, 1, 0), ("a", 5, 10, 2, 1, 1), ("a", 10, 12, 1, 0, 1), ("a", 12, 20, 0, 0, 0), ("a", 20, 21, 1, 1, 0), ("b", 3, 4, 1, 0, 1)]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_steps_do_not_depend_on_chunks(spark, size):
    rng = random.Random(size)
    data = [(rng.choice("ab"), lo := rng.randint(0, 60), lo + rng.randint(1, 30), rng.random() < 0.5) for _ in range(80)]
    r = spark.createDataFrame(data, READS)
    deep = {}
    for c, lo, hi, _ in data:
        for p in range(lo, hi):
            deep[c, p] = deep.get((c, p), 0) + 1
    got = {(c, p): d for c, lo, hi, d, _, _ in map(tuple, coverage.steps(r, size).collect()) for p in range(lo, hi) if d}
    assert got == deep


def test_strand_bias_counts_from_depth_ten(spark):
    nine = spark.createDataFrame([("a", 0, 1, True)] * 9, READS)
    ten = spark.createDataFrame([("a", 0, 1, True)] * 10, READS)
    assert coverage.report(coverage.steps(nine)).first()["pct_no_bias"] == 100.0
    assert coverage.report(coverage.steps(ten)).first()["pct_no_bias"] == 0.0


def test_uniformity_is_interpolated(spark):
    # depths 1, 1, 1, 13: mean 4, threshold 0.8 lies between depths 0 and 1
    r = spark.createDataFrame([("a", 0, 4, True)] + [("a", 3, 4, True)] * 12, READS)
    x = coverage.report(coverage.steps(r)).first()
    assert x["mean_depth"] == 4.0 and x["uniformity"] == pytest.approx(100.0)


@pytest.mark.parametrize("size", [1, 16, 64])
def test_overlap_join_is_the_brute_force_join(spark, size):
    rng = random.Random(size)

    def some(n, longest):
        return [(rng.choice("ab"), lo := rng.randint(0, 3000), lo + rng.randint(1, rng.choice([3, longest])), k) for k in range(n)]

    a, b = some(120, 2000), some(90, 50)
    schema = "contig string, lo long, hi long, k long"
    got = intervals.overlap_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), size).select("l_k", "r_k")
    want = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    assert rows(got) == want


def test_union_and_gaps(spark):
    r = spark.createDataFrame([("a", 0, 5, True), ("a", 5, 7, True), ("a", 9, 12, True), ("a", 1, 3, True), ("b", 4, 6, True)], READS)
    assert rows(intervals.union(r)) == [("a", 0, 7), ("a", 9, 12), ("b", 4, 6)]
    assert rows(intervals.gaps(r)) == [("a", 7, 9)]


def test_ranks_run_over_chunks(spark):
    x = spark.createDataFrame([(v,) for v in (5, 1, 9, 22, 3, 40)], "v long")
    assert rows(prefix.ranked(x, [], "v", F.floor(F.col("v") / 10))) == [(1, 1), (3, 2), (5, 3), (9, 4), (22, 5), (40, 6)]


def test_accounts_add_up(spark):
    x = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 40)], "v int, b long")
    got = filters.accounts(x, {"one": F.col("v") == 1, "small": F.col("v") < 3}, F.col("b"))
    assert rows(got) == [(0, "one", 1, 10, 3, 90), (1, "small", 1, 20, 2, 70)]


def test_trim_stops_at_the_first_good_window(spark):
    x = spark.createDataFrame([([30] * 10 + [2] * 10,), ([2, 2],), ([],)], "q array<int>")
    assert [r[0] for r in x.select(filters.trimmed_length(F.col("q"), 16)).collect()] == [9, 0, 0]


def test_lookups(spark):
    x = spark.createDataFrame([("Abc", 1), ("xbz", 5), (None, 3)], "name string, n int")
    assert rows(x.filter(filters.lookup(name__icontains="B", n__gte=2))) == [("xbz", 5)]
    assert rows(x.filter(filters.lookup(name__isnull=True))) == [(None, 3)]


def test_duplicates_with_ties_and_adapters(spark):
    schema = "contig string, adapter long, forward boolean, lo long, hi long, flow long, has_adapter boolean, k long"
    data = [("a", 1, True, 0, 9, 50, False, 0), ("a", 1, True, 0, 8, 40, True, 1), ("a", 1, True, 0, 8, 40, True, 2), ("a", 1, True, 0, 7, 30, True, 3), ("a", 1, True, 0, 6, 20, False, 4), ("a", 1, False, 0, 9, 10, False, 5)]
    got = {r["k"]: r["duplicate"] for r in dedup.mark_duplicates(spark.createDataFrame(data, schema)).collect()}
    assert got[0] is False and got[3] is False and got[4] is True and got[5] is False
    assert sorted([got[1], got[2]]) == [False, True]


def test_duplicate_counts_are_those_of_marked_reads(spark):
    rng = random.Random(2)
    data = [("a", 1, rng.random() < 0.5, lo := rng.randint(0, 3), lo + (n := rng.randint(1, 6)), n, rng.random() < 0.5) for _ in range(300)]
    x = spark.createDataFrame(data, "contig string, adapter long, forward boolean, lo long, hi long, flow long, has_adapter boolean")
    marked = dedup.mark_duplicates(x).groupBy("forward").agg(F.count("*").alias("n"), F.count_if("duplicate").alias("d"))
    counted = dedup.duplicate_counts(x).groupBy("forward").agg(F.sum("reads").alias("n"), F.sum("duplicates").alias("d"))
    assert rows(marked) == rows(counted)


def test_majority_breaks_ties_by_value(spark):
    x = spark.createDataFrame([("f", "b"), ("f", "a"), ("g", "c")], "fam string, v string")
    assert rows(dedup.majority(x, ["fam"], F.col("v"), "v")) == [("f", 2, "a", 1), ("g", 1, "c", 1)]


def test_partial_moments_merge(spark):
    x = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("a", 2, 9.0)], "g string, block int, v double")
    got = metrics.merged(metrics.moments(x, ["g", "block"], "v"), ["g"]).first()
    assert got["n"] == 3 and got["mean"] == pytest.approx(5) and got["var_pop"] == pytest.approx(26 / 3)


def test_compare_takes_nan_as_nan(spark):
    x = spark.createDataFrame([("g", float("nan"), float("nan")), ("g", 1.0, 1.5), ("g", float("inf"), float("inf")), ("g", None, 1.0)], "g string, a double, b double")
    assert metrics.compare(x, ["g"], "a", "b", 0.1).first()["different"] == 2


def test_prefix_by_error(spark):
    x = spark.createDataFrame([([1, 1, 9, 1],), ([9],), ([],)], "q array<int>")
    assert [r[0] for r in x.select(metrics.prefix_length(F.col("q"), F.lit(3))).collect()] == [4, 0, 0]


def test_differential_and_fold(spark):
    w = spark.createDataFrame([("g", 10, 40), ("h", 0, 5)], "gene string, a long, b long")
    got = {r["gene"]: (r["ratio"], r["differs"]) for r in expression.differential(w, ["a", "b"], 20, 2).collect()}
    assert got == {"g": (4.0, True), "h": (None, False)}


def test_priority_union(spark):
    a, b = (spark.createDataFrame(d, "k long, v long") for d in ([(1, 5)], [(1, 7), (2, 8)]))
    assert rows(variants.priority_union([a, b], ["k"], ["v"])) == [(1, 5, 0), (2, 8, 1)]


def test_page_takes_allowed_columns_only(spark):
    x = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a")], "id long, name string")
    assert [r["id"] for r in relational.page(x, "name", ["name"], "id", 2).collect()] == [2, 3]
    with pytest.raises(ValueError):
        relational.page(x, "id", ["name"], "id", 2)


def test_sequences(spark):
    x = spark.createDataFrame([("TTACCG", "ACGT", "3M1D2M2I1M4S", "a=1,2;b; a=3")], "s string, t string, c string, kv string")
    r = x.select(
        sequence.reverse_complement(F.col("s")).alias("rc"),
        sequence.hamming(F.col("s"), F.col("t")).alias("ham"),
        sequence.flows(F.col("s")).alias("flows"),
        sequence.sequence_of(sequence.flows(F.col("s"))).alias("back"),
        sequence.kmers(F.col("t"), 3).alias("k"),
        sequence.covered_blocks(F.lit(10), sequence.cigar_ops(F.col("c"))).alias("blocks"),
        sequence.cigar_length(sequence.cigar_ops(F.col("c")), "MIS=X").alias("read"),
        sequence.iupac(F.lit("G"), F.lit("A")).alias("iupac"),
        sequence.key_values(F.col("kv")).alias("kv"),
        sequence.clean_key(F.lit(" Run  Name/ID ")).alias("key"),
    ).first()
    assert r["rc"] == "CGGTAA" and r["ham"] == 6 and r["flows"] == [2, 1, 2, 1] and r["back"] == "TTACCG"
    assert r["k"] == ["ACG", "CGT"] and [tuple(b) for b in r["blocks"]] == [(10, 13), (14, 16), (16, 17)]
    assert r["read"] == 12 and r["iupac"] == "R" and r["kv"] == {"a": ["3"], "b": [""]} and r["key"] == "run_name_id"


def test_array_functions(spark):
    x = spark.createDataFrame([([0.0, 0.0, 0.0, 0.0, 5.0, 10.0, 15.0, 20.0], "kitten", "sitting", "xxACGTxx", "yACGTy")], "a array<double>, s string, t string, p string, q string")
    r = x.select(
        arrays.moving_mean(F.col("a"), 1).alias("m"),
        arrays.rise_time(F.col("a")).alias("rise"),
        arrays.change_point(F.col("a")).alias("c"),
        arrays.weighted_edit(substitute=1, insert=1, delete=1)("s", "t").alias("d"),
        arrays.weighted_edit(swap=1)(F.lit("ab"), F.lit("ba")).alias("swap"),
        arrays.local_alignment()("p", "q").alias("sw"),
        arrays.t_test_p(F.lit(2.0), F.lit(10.0)).alias("p"),
    ).first()
    assert r["m"][0] == 0.0 and r["m"][4] == 5.0 and r["rise"] == 3 and r["c"]["at"] in (3, 4) and r["c"]["sse"] < 1e-9
    assert r["d"] == 3 and r["swap"] == 1 and tuple(r["sw"]) == (8, 6, 5) and r["p"] == pytest.approx(0.0733880, abs=1e-6)


def test_segments_find_a_jump(spark):
    x = spark.createDataFrame([("c", i, 4 if i < 50 else 100) for i in range(100)], "g string, p long, n long")
    assert rows(arrays.segments(x, "g", "p", "n")) == [("c", 0, 49, 4, 50), ("c", 50, 99, 100, 50)]


def test_mixture_finds_two_normals(spark):
    rng = random.Random(3)
    x = spark.createDataFrame([(rng.gauss(0, 1) if rng.random() < 0.4 else rng.gauss(10, 2),) for _ in range(4000)], "v double")
    r = arrays.mixture(x, "v").first()
    assert r["mean0"] == pytest.approx(0, abs=0.2) and r["mean1"] == pytest.approx(10, abs=0.3) and r["share1"] == pytest.approx(0.6, abs=0.05)


def test_probabilities(spark):
    from math import comb, log

    from granary.functions import probability

    x = spark.createDataFrame([(3, 20, 0.1, [-1000.0, -1000.0])], "k long, n long, p double, l array<double>")
    r = x.select(
        probability.log_sum_exp(F.col("l")).alias("lse"),
        probability.log_binomial(F.col("k"), F.col("n"), F.col("p")).alias("b"),
        probability.call_score(F.lit(10), F.lit(20), 0.1).alias("high"),
        probability.call_score(F.lit(0), F.lit(20), 0.1).alias("low"),
        probability.detection_limit(F.lit(1000.0), 0.001, 20.0).alias("lod"),
    ).first()
    assert r["lse"] == pytest.approx(-1000 + log(2)) and r["b"] == pytest.approx(log(comb(20, 3) * 0.1**3 * 0.9**17), abs=1e-7)
    assert r["high"] > 30 > 5 > r["low"] and 0.001 < r["lod"] < 0.05
    lod = r["lod"]
    assert lod * log(lod / 0.001) - (lod - 0.001) == pytest.approx(2 * log(10) / 1000, rel=1e-6)


def test_trims_and_alleles(spark):
    from granary.functions import trims

    x = spark.createDataFrame([("TCAGACGTATCACC", [0.1, 0.1, 0.5, 0.1], "10A3^ACC2T", "GENE_ID=A;X=1;GENE_ID=B")], "s string, e array<double>, md string, info string")
    r = x.select(
        trims.without_prefix(F.col("s"), "TCAG").alias("key"),
        trims.trimmed(F.col("s"), "ATCACC").alias("t"),
        trims.trimmed(F.lit("GGGGATCA"), "ATCACC").alias("tail"),
        trims.expected_error_length(F.col("e"), 0.5).alias("n"),
        trims.trimmed_alleles(F.lit(10), F.lit("GCACA"), F.lit("GCA")).alias("a"),
        trims.trimmed_alleles(F.lit(10), F.lit("AT"), F.lit("AG")).alias("snp"),
        trims.mismatches(F.col("md")).alias("md"),
        trims.gene_label(F.col("info")).alias("g"),
    ).first()
    assert (r["key"], r["t"], r["tail"], r["n"]) == ("ACGTATCACC", "TCAGACGT", "GGGG", 2)
    assert tuple(r["a"]) == (10, "GCA", "G") and tuple(r["snp"]) == (11, "T", "G") and r["md"] == ["A", "T"] and r["g"] == "A-/-B"
