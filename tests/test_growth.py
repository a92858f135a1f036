"""What larger tables showed: orders without ties, and steps that grow with their input alone."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.functions import gapped, sequence
from granary.functions.probability import fisher_exact
from granary.llm import line_dedup
from granary.operators import alignments as al
from granary.operators import intervals, reference, reports, variants
from granary.plans import base_queries, coverage_queries, table_queries
from granary.sources import tables
from tests.compare import sql_rows

SF = "/root/testdata/sf0.001"


def test_windows_of_the_union_have_no_ties():
    sql = f"WITH {coverage_queries._UNION_SQL} SELECT contig, lo, hi FROM m GROUP BY ALL HAVING count(*) > 1"
    assert sql_rows(sql, SF)[2] == []


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_short_ranges_meet_short_ones_in_few_bins(spark):
    rows = spark.createDataFrame([("c", 60 * k, 60 * k + 30) for k in range(200)], "contig string, lo long, hi long")
    near = spark.createDataFrame([("c", 100 * k, 100 * k + 5) for k in range(40)], "contig string, lo long, hi long")
    far = near.union(spark.createDataFrame([("c", 5000, 9000), ("d", 0, 10**6)], near.schema))
    assert intervals.levels_of(near) == [0] and len(intervals.levels_of(far)) > 1
    assert intervals._binned(rows, 64, "l_", [0]).count() <= 2 * 200
    for ranges in (near, far):
        want = {(a, b) for c, a, b in rows.collect() if any(c == d and a < y and x < b for d, x, y in ranges.collect())}
        got = [(r.lo, r.hi) for r in intervals.semi_overlapping(rows, ranges).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert intervals.semi_overlapping(rows, near.limit(0)).count() == 0


def test_lengths_of_operations_in_one_pass(spark):
    texts = ["3M1D2M", "4S3=2X1I7N5H", "*", "", "M3", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    for kinds in ("MI=X", "MDN=X"):
        a, b = sequence.cigar_sum(F.col("c"), kinds), sequence.cigar_length(sequence.cigar_ops(F.col("c")), kinds)
        assert df.filter(~a.eqNullSafe(b)).count() == 0


def test_bases_of_reads_are_made_in_batches_or_left_out(spark):
    assert "CATG" not in _plan(tables.sequenced(spark, SF))
    short = tables.sequenced(spark, SF, bases=False)
    whole = tables.sequenced(spark, SF)
    assert short.columns == ["name", "contig", "start", "flag", "cigar"]
    assert short.exceptAll(whole.select(*short.columns)).count() == 0 and short.count() == whole.count()


def test_piled_reads_are_sorted_before_they_are_summed(spark):
    plan = _plan(al.pileup(tables.sequenced(spark, SF)))
    assert "Sort [contig" in plan


def test_top_alleles_are_found_without_sorting_arrays(spark):
    assert not [x for x in _plan(base_queries.top_alleles(spark, SF)).splitlines() if "fwd_a" in x and "array_sort" in x]


def test_no_sketch_is_kept_for_every_user(spark):
    plan = table_queries.approx_distinct_users(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "user_id" in x.split("functions=")[0] and "approx_count" in x and "keys=" in x]


def test_scores_of_many_paths_are_those_of_each():
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"ACGT", np.uint8)
    paths = [[("M", 3), ("D", 2), ("M", 2), ("I", 3), ("M", 1)], [("D", 1), ("M", 4), ("D", 2)], [("I", 2), ("M", 2)], [("M", 1)], [], [("I", 3)], [("=", 2), ("X", 1), ("D", 1), ("M", 1)]]
    queries = [letters[rng.integers(0, 4, sum(n for o, n in p if o != "D"))] for p in paths]
    references = [letters[rng.integers(0, 2, sum(n for o, n in p if o != "I"))] for p in paths]
    for scale in ("none", "extend", "both"):
        s = gapped.Scores(4, -6, 5, 2, scale)
        assert gapped.path_scores(queries, references, paths, s) == pytest.approx([gapped.path_score(*x, s) for x in zip(queries, references, paths, strict=True)])
    assert gapped.flat_runs(queries).tolist() == [n for q in queries for n in gapped.run_lengths(q).tolist()]


def test_alignments_do_not_depend_on_how_pairs_are_cut_into_slices(monkeypatch):
    rng = np.random.default_rng(6)
    letters = np.frombuffer(b"ACGT", np.uint8)
    pairs = [tuple(letters[rng.integers(0, 4, rng.integers(0, 25))] for _ in "ab") for _ in range(60)]
    queries, references = zip(*pairs, strict=True)
    found = []
    for cells in (1, 200, gapped.ROW_CELLS):
        monkeypatch.setattr(gapped, "ROW_CELLS", cells)
        out = gapped.align(queries, references, mode="read")
        found.append((np.nan_to_num(out.score).tolist(), out.r_lo.tolist(), out.ops))
    assert found[0] == found[1] == found[2]


def test_a_file_of_one_group_is_aligned_by_many_tasks(spark):
    assert tables.sequenced(spark, SF).rdd.getNumPartitions() == 1
    for df in (base_queries.read_alignments(spark, SF), al.realigned(al.with_md(tables.sequenced(spark, SF)))):
        assert "RepartitionByExpression" in _plan(df) or "Repartition 8" in _plan(df)


def test_reads_are_realigned_in_one_pass_and_dealt_while_narrow(spark):
    df = base_queries.realigned_reads(spark, SF)
    plan = _plan(df)
    assert plan.count("MapInArrow") == 1
    # neither bases nor windows are dealt, but what is read of the line items
    below = plan.split("Repartition 8")[1].split("parquet")[0]
    assert "l_orderkey" in below and "Join" not in below and "MapInArrow" not in below
    x = al.realigned(al.with_md(tables.sequenced(spark, SF)))
    want = x.groupBy("contig", "flag").agg(F.count("*"), F.count_if("changed"), F.sum(F.length("cigar")), F.sum("start"))
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))


def test_paths_that_score_no_more_than_known_ones_are_not_followed():
    sides = [gapped.Flat.of([np.frombuffer(x, np.uint8) for x in side]) for side in ((b"ACGT", b"AATTT", b""), (b"ACGT", b"AATTTT", b"A"))]
    free = gapped.aligned(*sides, mode="read")
    assert np.diff(free.first).tolist() == [1, 1, 0] and free.score.tolist()[:2] == [16, 20]
    held = gapped.aligned(*sides, mode="read", known=np.array([16.0, 19.0, 0.0]))
    assert np.diff(held.first).tolist() == [0, 1, 0] and held.score.tolist() == free.score.tolist()
    assert (held.kind.tobytes(), held.size.tolist(), held.r_hi.tolist()[1]) == (b"M", [5], 5)


def test_what_is_the_same_for_all_tables_of_the_exact_test_is_worked_out_once(spark):
    df = spark.createDataFrame([(3, 1, 1, 3), (0, 5, 5, 0), (-1, 2, 2, 2), (10, 0, 2, 9)], "a int, b int, c int, d int")
    p = fisher_exact(*(F.col(x) for x in "abcd"))
    got = [r[0] for r in df.select(p).collect()]
    assert got[2] is None and [got[k] for k in (0, 1, 3)] == pytest.approx([0.48571428571, 2 / 252, 78 / 352716], rel=1e-3)
    assert "AS fixed" in df.select(p)._jdf.queryExecution().analyzed().toString()


def test_alleles_are_trimmed_and_shifted_in_batches(spark):
    calls = spark.createDataFrame([("c", 2, "AAT", "AAGT"), ("c", 1, None, "A"), ("c", 5, "CAC", "C")], "contig string, pos long, ref string, alt string")
    assert [tuple(r) for r in variants.normalised(calls).collect()] == [("c", 3, "A", "AG"), ("c", 1, None, "A"), ("c", 5, "CAC", "C")]
    assert "MapInArrow" in _plan(variants.normalised(calls))
    bases = spark.createDataFrame([("c", k, b) for k, b in enumerate("GTACACACG") if k != 1], "contig string, pos long, base string")
    blocks = reference.blocks(bases, 4)
    assert {r.block: r.seq for r in blocks.collect()} == {0: "GNAC", 1: "ACAC", 2: "G"}
    moved = reference.left_aligned(spark.createDataFrame([("c", 5, "CAC", "C")], calls.schema), blocks, 4)
    assert [tuple(r[c] for c in calls.columns) for r in moved.collect()] == [("c", 1, "NAC", "N")]


def test_all_grams_are_counted(spark):
    docs = spark.range(20_000).select(F.col("id").alias("uid"), F.lit("a b c d e f g h i j").alias("text"))
    counts = line_dedup.gram_counts(docs, grams=line_dedup.Grams(0.8, 5), min_words=5)
    assert set(counts[counts > 0].tolist()) == {20_000}


def test_reads_are_dealt_before_they_are_taken_apart(spark):
    rows = [(k % 3, "ACGT"[k % 4] + "AACC"[k % 4] + "T" * (k % 2)) for k in range(60)] + [(3, "A"), (4, ""), (5, None), (None, "A")]
    df = spark.createDataFrame(rows, "f int, s string").repartition(4)
    found = [reports.consensus(df, ["f"], "s", 2, salt_reads=n) for n in (7, 1000)]
    plan = found[1]._jdf.queryExecution().executedPlan().toString()
    # a read's bases are rows above the shuffle only
    assert "REPARTITION_BY_COL" in plan[plan.index("Generate") :]
    for got in found:
        assert sorted(tuple(r) for r in got.select("f", "bases", "reads").collect()) == [(0, "AAT", 20), (1, "AAT", 20), (2, "AAT", 20)]


def test_counts_of_grams_travel_in_few_rows(spark):
    docs = spark.range(2_000, numPartitions=60).select(F.col("id").alias("uid"), F.concat(F.lit("a b c d e f g h "), F.col("id").cast("string")).alias("text"))
    grams = line_dedup.Grams(0.8, 5)
    frame, sent = type(docs), []
    repartition = frame.repartition
    frame.repartition = lambda self, *a: sent.append(self.count()) or repartition(self, *a)
    try:
        counts = line_dedup.gram_counts(docs, grams, 5)
    finally:
        frame.repartition = repartition
    assert sent and sent[0] <= spark.sparkContext.defaultParallelism * line_dedup.COUNTERS // line_dedup.COUNTED_TOGETHER
    assert counts.max() >= 2_000


def test_signatures_are_packed_in_fewer_bytes():
    rng = np.random.default_rng(1)
    n = 5_000
    bucket, salt = np.sort(rng.integers(0, 40, n)), np.full(n, -1)
    token, words, place = rng.integers(0, 1 << 36, n).astype(np.uint64), rng.integers(5, 16_000, n), rng.integers(0, 1 << 14, n)
    words[: n // 2] %= line_dedup.LONG
    cid, odd, odd2 = (rng.integers(-(1 << 62), 1 << 62, n) for _ in range(3))
    rows = line_dedup._packed(bucket, salt, token, words, place, cid, odd, odd2)
    assert len(rows) == len(np.unique(bucket))
    got = [x.tolist() for x in line_dedup._unpacked(rows.slice(3, 20))]
    some = (bucket >= 3) & (bucket < 23)
    assert got == [x[some].tolist() for x in (token, words, place, cid, odd, np.where(words >= line_dedup.LONG, odd2, 0))]


def test_counts_of_grams_reach_the_driver_in_few_bytes(spark):
    docs = spark.range(2_000).select(F.col("id").alias("uid"), F.concat(F.lit("a b c d e f g h "), F.col("id").cast("string")).alias("text"))
    frame, sent = type(docs), []
    to_arrow = frame.toArrow
    frame.toArrow = lambda self: sent.append(to_arrow(self)) or sent[-1]
    try:
        counts = line_dedup.gram_counts(docs, line_dedup.Grams(0.8, 5), 5)
    finally:
        frame.toArrow = to_arrow
    assert counts.max() == 2_000 and sum(t.nbytes for t in sent) < line_dedup.COUNTERS * 8 // 3


def test_links_of_a_frequent_signature_are_verified_where_they_are_found(spark):
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(60):  # too many words are others in two of these, in some of them few
        words = [f"w{k}" for k in range(30)]
        for k in rng.choice(30, int(rng.integers(2, 6)), replace=False):
            words[k] = f"other{rng.integers(1000)}"
        texts.append(words)
    symbols = [[hash(w) % 50_000 for w in t] for t in texts]
    begin, n = np.cumsum([0] + [len(t) for t in texts])[:-1], np.array([len(t) for t in texts])
    a, b = np.triu_indices(60, 1)
    want = np.array([edit_distance(symbols[x], symbols[y]) <= 6 for x, y in zip(a, b)])
    assert want.any() and not want.all()
    assert line_dedup._alike(np.concatenate(symbols).astype(np.uint32), begin, n, a, b, 0.8).tolist() == want.tolist()
    hot = spark.createDataFrame([(k, t) for k in range(60) for t in (7, 8)], "b long, token long")
    table = spark.createDataFrame([(k, "".join(chr(0x10000 + x) for x in s)) for k, s in enumerate(symbols)], "cid long, symbols string")
    links, _ = line_dedup.other_links(hot, spark.createDataFrame([], "node long, root long"), table, 0.8)
    got = [(r.a, r.b) for r in links.collect()]
    root = list(range(60))
    for x, y in zip(a[want].tolist(), b[want].tolist()):
        root = [root[x] if r == root[y] else r for r in root]
    # links that join two groups and no more; the pairs that are not alike are no rows
    assert len(got) == 60 - len(set(root)) and set(got) <= set(zip(a[want].tolist(), b[want].tolist())) | set(zip(b[want].tolist(), a[want].tolist()))


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _distance(x, y):
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        before, row = row, [i]
        for j, d in enumerate(y, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != d)))
    return row[-1]


def test_long_pairs_are_told_by_whole_numbers():
    rng = np.random.default_rng(3)
    for _ in range(60):
        x = rng.integers(0, 30, rng.integers(1, 90)).tolist()
        y = [int(rng.integers(0, 30)) if rng.random() < 0.2 else c for c in x if rng.random() < 0.9] + [1]
        d = _distance(x, y)
        assert [line_dedup._within_edits(x, y, e) for e in (d - 1, d, d + 3)] == [False, True, True]


def test_only_shared_signatures_travel_with_their_classes(spark):
    words = [f"{a}{b}" for a in "bcdfghklmn" for b in ("a", "e", "i", "o", "u", "an", "en", "in", "on", "un")]
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(words, 30).tolist()) for _ in range(300)]
    near = texts[:20]
    docs = spark.createDataFrame([(k, k, t) for k, t in enumerate([*texts, *(" ".join(t.split()[1:]) for t in near)])], "uid long, key long, text string").repartition(4)
    grams = line_dedup.Grams(0.8, 5)
    coded = line_dedup.read_lines(docs, 5).filter("words IS NOT NULL").select("words", "sizes", "cids").cache()
    counts = line_dedup.gram_counts(coded, grams, 5)
    assert counts.sum() == line_dedup.gram_counts(docs, grams, 5).sum()
    order = spark.sparkContext.broadcast(line_dedup.Order(counts))
    shared = line_dedup.shared_signatures(coded, order, grams, 5, 12, 8)
    sent, every = (line_dedup._members(coded, order, marks, grams, 5, 12) for marks in (shared, _All()))
    found = [{(r.a, r.b) for r in line_dedup.candidates(m, 0.8, 12).filter("a IS NOT NULL").collect()} for m in (sent, every)]
    assert found[0] == found[1] and len(found[0]) >= len(near)
    size = [m.agg(F.sum(F.length("cid"))).first()[0] for m in (sent, every)]
    assert size[0] < size[1] / 3


class _All:
    def has(self, token):
        return np.ones(len(token), bool)
