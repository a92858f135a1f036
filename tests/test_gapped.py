"""Alignments with gaps against a version cell by cell, and realignments."""

from __future__ import annotations

import random

import numpy as np
import pytest

from granary.functions import gapped as g
from granary.operators import alignments as al
from tests.test_bases import SCHEMA, made, parsed, under

LOW = -1e30


def coded(x):
    return np.frombuffer(x.encode(), np.uint8)


def begin(i, m, centre, band):
    return min(max(centre[i] - band, 0), max(m - 2 * band, 0))


def plain(q, r, s, mode, centre=None, band=None):
    """The best score by three matrices, one cell after the other."""
    n, m = len(q), len(r)
    hq, hr = g.run_lengths(coded(q)), g.run_lengths(coded(r))

    def opening(h):
        return s.open / h if s.scale == "both" else s.open

    def going(h):
        return s.extend / h if s.scale != "none" else s.extend

    best, (H, D, P) = LOW, ([[LOW] * (m + 1) for _ in range(n + 1)] for _ in range(3))
    for i in range(n + 1):
        for j in range(m + 1):
            if band is not None and not begin(i, m, centre, band) <= j <= begin(i, m, centre, band) + 2 * band:
                continue
            cell = 0 if i == 0 and (j == 0 or mode != "global") else LOW
            if i and j:
                cell = max(cell, H[i - 1][j - 1] + (s.match if q[i - 1] == r[j - 1] else s.mismatch))
            if i:
                P[i][j] = max(H[i - 1][j] - opening(hq[i - 1]), P[i - 1][j]) - going(hq[i - 1])
            if j and not (mode == "read" and i == 0):
                D[i][j] = max(H[i][j - 1] - opening(hr[j - 1]), D[i][j - 1]) - going(hr[j - 1])
            H[i][j] = max(cell, P[i][j], D[i][j], 0 if mode == "local" else LOW)
            best = max(best, H[i][j]) if mode == "local" else best
    return best if mode == "local" else H[n][m] if mode == "global" else max(H[n])


def walked(q, r, s, a, k):
    """The score of the steps that were returned."""
    i, j, total = a.q_lo[k], a.r_lo[k], 0.0
    hq, hr = g.run_lengths(coded(q)), g.run_lengths(coded(r))
    for op, n in a.ops[k]:
        if op == "M":
            total += sum(s.match if q[i + x] == r[j + x] else s.mismatch for x in range(n))
            i, j = i + n, j + n
            continue
        runs = hr[j : j + n] if op == "D" else hq[i : i + n]
        total -= s.open / (runs[0] if s.scale == "both" else 1) + sum(s.extend / (h if s.scale != "none" else 1) for h in runs)
        i, j = i + n * (op == "I"), j + n * (op == "D")
    assert (i, j) == (a.q_hi[k], a.r_hi[k])
    return total


def pairs(rng, n):
    """References of runs, and queries of them with bases put in, left out, doubled and replaced."""
    out = []
    for _ in range(n):
        r = "".join(rng.choice("ACGT") * rng.choice([1, 1, 2, 4]) for _ in range(rng.randrange(0, 9)))
        q = list(r)
        for _ in range(rng.randrange(0, 4)):
            if q:
                x = rng.randrange(len(q))
                q[x : x + 1] = rng.choice([[], [rng.choice("ACGT")], [q[x], rng.choice("ACGT")], [q[x]] * 2])
        out.append(("".join(q) if rng.random() < 0.8 else "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 12))), r))
    return out


@pytest.mark.parametrize("mode", ["local", "global", "read"])
@pytest.mark.parametrize("scale", ["none", "extend", "both"])
@pytest.mark.parametrize("cells", [g.CELLS, 400])
def test_scores_and_steps_are_the_best(monkeypatch, mode, scale, cells):
    monkeypatch.setattr(g, "CELLS", cells)
    s, some = g.Scores(scale=scale), pairs(random.Random(mode + scale), 120)
    sides = [[coded(p[k]) for p in some] for k in (0, 1)]
    centres = [np.arange(len(q) + 1) for q, _ in some]
    for band in (None, 2):
        a = g.align(*sides, s, mode, centres, band)
        for k, (q, r) in enumerate(some):
            best = plain(q, r, s, mode, centres[k], band)
            if best < LOW / 2:
                assert np.isnan(a.score[k])
            else:
                assert a.score[k] == pytest.approx(best) == pytest.approx(walked(q, r, s, a, k))


def test_gaps_stand_leftmost_and_in_their_run():
    s = g.Scores(scale="both")
    a = g.align([coded("GATTTTCA"), coded("GCACACAT")], [coded("GATTTTTCA"), coded("GCACACACAT")], s, "global")
    assert [g.cigar(x) for x in a.ops] == ["2M1D6M", "1M2D7M"]


def test_column_of_alignments(spark):
    rows = [(1, "TTTACGTACGTAAAC", "GGACGTACGTGG"), (2, None, "A"), (3, "", "ACG"), (4, "ACGTTTACG", "ACGTTTTACG"), (5, "A", None)]
    df = spark.createDataFrame(rows, "k int, q string, r string")
    got = {x["k"]: x["a"] for x in df.select("k", g.gapped_alignment()("q", "r").alias("a")).collect()}
    assert tuple(got[1]) == (32.0, 3, 11, 2, 10, "3S8M4S")
    assert got[2] is None or got[2]["score"] is None
    assert got[3]["score"] == 0 and got[3]["cigar"] == ""
    assert got[4]["cigar"] == "3M1D6M" and got[4]["score"] == 29


def test_a_shifted_gap_goes_to_its_run(spark):
    # one T of the run of five is missing, but the gap was put beside the run, at the price of a mismatch
    rows = [("a", "c", 100, 0, "2S3M1D5M", "NNGATTTTCA", "3^T5", 1)]
    ref = "GATTTTTCA"
    wrong = [("b", "c", 100, 0, "2S7M1D1M1S", "NNGATTTTCAN", "6T^C1", 1)]
    df = spark.createDataFrame(rows + wrong, SCHEMA + ", `a.b` int")
    got = {r["name"]: r for r in al.realigned(df).collect()}
    assert (got["a"]["start"], got["a"]["cigar"], got["a"]["md"], got["a"]["changed"]) == (100, "2S3M1D5M", "3^T5", False)
    assert (got["b"]["start"], got["b"]["cigar"], got["b"]["md"], got["b"]["changed"]) == (100, "2S2M1D6M1S", "2^T6", True)
    assert got["b"]["a.b"] == 1
    assert al.rebuilt(spark.createDataFrame([tuple(got["b"][c] for c in ("name", "contig", "start", "flag", "cigar", "seq", "md"))], SCHEMA)).first()["ref"] == ref


def test_realigned_reads_keep_their_bases_and_reference(spark):
    ref, rows = made(random.Random(12), 200)
    odd = [("x", "c1", 5, 0, None, "ACGT", None), ("y", "c1", 5, 0, "4M", "ACGT", None), ("z", "c1", None, 0, "3M", "ACG", "3"), ("w", "c1", 5, 0, "4M", "ACGT", "9")]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    got = {r["name"]: r for r in al.realigned(df).collect()}
    assert len(got) == len(rows) + len(odd)
    changed = 0
    for name, _, start, _, cigar, seq, md in rows:
        r = got[name]
        if not r["changed"]:
            assert (r["start"], r["cigar"], r["md"]) == (start, cigar, md)
            continue
        changed += 1
        ops = parsed(r["cigar"])
        assert sum(n for o, n in ops if o in "MIS=X") == len(seq)
        clips = [n for o, n in parsed(cigar) if o in "SH"]
        assert [n for o, n in ops if o in "SH"] == clips
        # what the new strings say of the reference is what stands there
        again = al.cigars.reference(al.cigars.walked(al.pa.array([r["cigar"]])), al.pa.array([seq]), al.pa.array([r["md"]]))
        assert again.base.tobytes().decode() == under(ref, r["start"], r["cigar"])[0]
    assert changed > 20
    for name, _, start, _, cigar, _, md in odd:
        assert (got[name]["start"], got[name]["cigar"], got[name]["md"], got[name]["changed"]) == (start, cigar, md, False)


def test_bands_that_lie_apart_and_long_pairs_keep_their_scores(monkeypatch):
    rng = random.Random(31)
    some, centres = pairs(rng, 30), []
    for k in range(30):
        r = "".join(rng.choice("ACGT") for _ in range(rng.randrange(20, 60)))
        low, high = sorted(rng.sample(range(len(r)), 2))
        some.append((r[:low] + r[high:], r) if k % 2 else (r[:low] + "".join(rng.choice("ACGT") for _ in range(12)) + r[low:], r))
    for q, r in some:
        # paths that jump to and fro
        at = sorted(rng.randrange(len(r) + 1) for _ in range(len(q) + 1))
        centres.append(np.array(at if rng.random() < 0.7 else rng.sample(at, len(at))))
    sides, s = [[coded(p[k]) for p in some] for k in (0, 1)], g.Scores(scale="both")
    for apart, cells in ((g.APART, g.CELLS), (1, 1), (10**6, 3000)):
        monkeypatch.setattr(g, "APART", apart)
        monkeypatch.setattr(g, "CELLS", cells)
        for mode in ("read", "global", "local"):
            a = g.align(*sides, s, mode, centres, 4)
            for k, (q, r) in enumerate(some):
                best = plain(q, r, s, mode, centres[k], 4)
                assert np.isnan(a.score[k]) if best < LOW / 2 else a.score[k] == pytest.approx(best) == pytest.approx(walked(q, r, s, a, k))


def test_realignments_do_not_depend_on_what_is_done_together(spark, monkeypatch):
    _, rows = made(random.Random(13), 80)
    df = spark.createDataFrame(rows, SCHEMA).select("cigar", "seq", "md", "start").toArrow().combine_chunks()
    columns = {n: df[n].chunk(0) for n in df.column_names}
    want = [x.to_pylist() for x in al.realigning()[1](columns)]
    assert 10 < sum(want[3]) < 80
    for bases in (1, 300):
        monkeypatch.setattr(al, "BASES", bases)
        assert [x.to_pylist() for x in al.realigning()[1](columns)] == want
    none = [x.slice(0, 0) for x in columns.values()]
    assert [len(x) for x in al.realigning()[1](dict(zip(columns, none, strict=True)))] == [0] * 4


def test_realignments_by_the_reference_are_those_by_md_strings():
    ref, rows = made(random.Random(14), 80)
    columns = {n: al.pa.array([r[k] for r in rows]) for k, n in ((2, "start"), (4, "cigar"), (5, "seq"), (6, "md"))}
    start, cigar, _, changed = (x.to_pylist() for x in al.realigning()[1](columns))
    fields, work = al.realigning(ref="ref")
    assert [f.name for f in fields] == ["start", "cigar", "changed"] and sum(changed) > 10
    # longer than needed, too short, and none
    windows = [ref[r[2] : r[2] + 150] for r in rows]
    assert [x.to_pylist() for x in work(columns | {"ref": al.pa.array(windows)})] == [start, cigar, changed]
    for none in ("", None):
        got = work(columns | {"ref": al.pa.array([none] * len(rows), al.pa.string())})
        assert [x.to_pylist() for x in got] == [columns["start"].to_pylist(), columns["cigar"].to_pylist(), [False] * len(rows)]
