"""Walks over CIGAR and MD strings, pile-ups and leftmost alleles against plain walks base by base."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from granary.functions import cigars
from granary.operators import alignments as al
from granary.operators import reference


def made(rng, n=60, size=400):
    """Random alignments to a random reference with many repeats: rows of (name, contig, start, flag, cigar, seq, md)."""
    ref = "".join(rng.choice("ACGT") * rng.choice([1, 1, 2, 3, 6]) for _ in range(size))[:size]
    rows = []
    for k in range(n):
        start = at = rng.randrange(0, size - 120)
        ops, seq, md, same = [], "", "", 0
        for end in (0, 1):
            if end:
                for _ in range(rng.randrange(1, 6)):
                    kind = rng.choice("MMM=XIDDN") if ops and ops[-1][0] in "M=X" else rng.choice("M=X")
                    w = rng.randrange(1, 12)
                    ops.append((kind, w))
                    if kind in "M=X":
                        for _ in range(w):
                            b = ref[at] if rng.random() < 0.85 else rng.choice("ACGTN")
                            seq += b
                            same, md = (same + 1, md) if b == ref[at] else (0, md + f"{same}{ref[at]}")
                            at += 1
                    elif kind == "I":
                        seq += "".join(rng.choice([ref[at - 1], ref[at], "A"]) for _ in range(w))
                    elif kind == "D":
                        same, md = 0, md + f"{same}^{ref[at : at + w]}"
                        at += w
                    else:
                        at += w
            if rng.random() < 0.4:
                w = rng.randrange(1, 5)
                ops.append(("S", w))
                seq += "".join(rng.choice("ACGT") for _ in range(w))
            if rng.random() < 0.2:
                ops.insert(0 if not end else len(ops), ("H", 3))
        rows.append((f"r{k}", "c1", start, rng.choice([0, 16]), "".join(f"{w}{o}" for o, w in ops), seq, md + str(same)))
    return ref, rows


def parsed(cigar):
    out, n = [], ""
    for c in cigar or "":
        if c.isdigit():
            n += c
        else:
            out.append((c, int(n)))
            n = ""
    return out


def piled(rows):
    out = {}
    for _, contig, start, flag, cigar, seq, _ in rows:
        at, q, steps = start, 0, []
        for op, w in parsed(cigar):
            if op in "M=X":
                steps += [(at + k, seq[q + k]) for k in range(w)]
                at, q = at + w, q + w
            elif op == "D":
                steps += [(at + k, "D") for k in range(w)]
                at += w
            elif op == "N":
                at += w
                steps.append(None)
            elif op == "I":
                steps.append("+")
                q += w
            elif op == "S":
                q += w
        for k, s in enumerate(steps):
            if s in (None, "+"):
                continue
            c = out.setdefault((contig, s[0]), Counter())
            c["coverage"] += 1
            behind = k + 1 < len(steps) and steps[k + 1] == "+"
            ahead = k > 1 and steps[k - 1] == "+" and steps[k - 2] not in (None, "+")
            if behind:
                c["inserted"] += 1
            if behind or ahead:
                c["discounted"] += 1
            elif s[1] == "D":
                c["deleted"] += 1
            else:
                c[f"{'rev' if flag & 16 else 'fwd'}_{s[1].lower()}"] += 1
    return out


SCHEMA = "name string, contig string, start long, flag int, cigar string, seq string, md string"


def test_pileup_is_that_of_a_walk(spark):
    _, rows = made(random.Random(1), 150)
    odd = [("x", "c1", 5, 0, None, "ACGT", None), ("y", "c1", 5, 0, "*", "*", None), ("z", "c1", None, 0, "3M", "ACG", "3"), ("w", None, 3, 0, "3M", "ACG", "3")]
    got = al.pileup(spark.createDataFrame(rows + odd, SCHEMA).repartition(3)).collect()
    assert {(r["contig"], r["pos"]): +Counter({c: r[c] for c in ("coverage", *cigars.PILED)}) for r in got} == piled(rows)


def test_a_deep_place_is_a_few_rows_a_batch(spark):
    rows = spark.range(50_000).select(F.lit("c").alias("contig"), F.lit(7).cast("long").alias("start"), F.lit(0).alias("flag"), F.lit("2M").alias("cigar"), F.lit("AC").alias("seq"))
    assert [(r["pos"], r["coverage"], r["fwd_a"], r["fwd_c"]) for r in al.pileup(rows).orderBy("pos").collect()] == [(7, 50_000, 50_000, 0), (8, 50_000, 0, 50_000)]


def under(ref, start, cigar):
    """Reference bases under an alignment, skips left out, and with them."""
    at, out = start, ""
    for op, w in parsed(cigar):
        if op in "M=XD":
            out += ref[at : at + w]
        if op in "M=XDN":
            at += w
    return out, ref[start:at]


def test_the_reference_is_rebuilt_and_md_strings_come_back(spark):
    ref, rows = made(random.Random(2), 200)
    df = spark.createDataFrame([(*r, under(ref, r[2], r[4])[1]) for r in rows], SCHEMA + ", ref string")
    got = {r["name"]: r for r in al.rebuilt(df.drop("ref")).collect()}
    again = {r["name"]: r["md"] for r in al.with_md(df.drop("md")).collect()}
    for name, _, start, _, cigar, _, md in rows:
        assert got[name]["ref"] == under(ref, start, cigar)[0]
        assert again[name] == md


def test_errors_are_those_of_a_walk(spark):
    ref, rows = made(random.Random(3), 200)
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", `a.b` int")
    got = {r["name"]: r for r in al.with_errors(df).collect()}
    for name, _, start, _, cigar, seq, _ in rows:
        at, q, pos, wanted = start, 0, 0, []
        for op, w in parsed(cigar):
            if op in "M=X":
                wanted += [(pos + k, "sub", 1) for k in range(w) if ref[at + k] != seq[q + k]]
                at, q, pos = at + w, q + w, pos + w
            elif op == "I":
                wanted.append((pos, "ins", w))
                q, pos = q + w, pos + w
            elif op == "D":
                wanted.append((pos, "del", w))
                at += w
            elif op == "N":
                at += w
            elif op == "S":
                q += w
        assert [tuple(e) for e in got[name]["errors"]] == sorted(wanted)
        assert got[name]["bases"] == pos and got[name]["a.b"] == 1


def test_homopolymers_are_those_of_a_walk(spark):
    ref, rows = made(random.Random(4), 200)
    wanted = Counter()
    for _, _, start, _, cigar, seq, _ in rows:
        bases, gone, put, q = "", [], {}, 0
        for op, w in parsed(cigar):
            if op in "M=X":
                bases, gone, q = bases + ref[start : start + w], gone + [False] * w, q + w
            elif op == "D":
                bases, gone = bases + ref[start : start + w], gone + [True] * w
            elif op == "I":
                put[len(bases)] = put.get(len(bases), "") + seq[q : q + w]
                q += w
            elif op == "S":
                q += w
            if op in "M=XDN":
                start += w
        runs = []
        for k, b in enumerate(bases):
            if k and bases[k - 1] == b:
                runs[-1][2] = k + 1
            else:
                runs.append([b, k, k + 1])
        for b, lo, hi in runs[1:-1]:
            more = sum(text.count(b) for at, text in put.items() if lo <= at <= hi)
            wanted[b, min(hi - lo, 6), min(max(hi - lo - sum(gone[lo:hi]) + more, 0), 6)] += 1
    got = al.homopolymer_errors(spark.createDataFrame(rows, SCHEMA), ["contig"], 6).collect()
    assert {(r["base"], r["ref_len"], r["read_len"]): r["runs"] for r in got} == dict(wanted)


def test_a_long_alignment_takes_linear_time():
    n = 200_000
    walk = cigars.walked(pa.array(["5M1I3M2D" * n + "1M"]))
    found = cigars.errors(walk, pa.array([("8^AC" * n) + "1"]))
    assert len(found.pos) == 2 * n and found.pos[-1] == 9 * n


def table_of(spark, ref):
    return spark.createDataFrame([(c, k, b) for c, s in ref.items() for k, b in enumerate(s)], "contig string, pos long, base string")


def leftmost(ref, pos, r, a):
    """Shifts one base at a time while the change ends with the base that stands before it."""
    while len(r) > 1 and len(a) > 1 and r[-1] == a[-1]:
        r, a = r[:-1], a[:-1]
    while len(r) > 1 and len(a) > 1 and r[0] == a[0]:
        pos, r, a = pos + 1, r[1:], a[1:]
    if min(len(r), len(a)) > 1 or len(r) == len(a) or r[0] != a[0]:
        return pos, r, a
    while pos > 0 and r[0] != "N" and (r + a)[len(r) + len(a) - 1 if len(a) > 1 else len(r) - 1] == r[0]:
        before = ref[pos - 1]
        r, a = (before + r)[:-1] if len(r) > 1 else before, (before + a)[:-1] if len(a) > 1 else before
        pos -= 1
    return pos, r, a


@pytest.mark.parametrize(("size", "reach"), [(reference.BLOCK, reference.FIRST_REACH), (16, 3)])
def test_alleles_are_shifted_as_far_as_they_go(spark, size, reach):
    rng = random.Random(6)
    ref = {"c1": "".join(rng.choice(["A", "AC", "ACG", "T", "N"]) * rng.choice([1, 2, 9, 30]) for _ in range(60)), "c2": "A" * 300 + "C" + "GT" * 100}
    rows = []
    for k in range(400):
        c = rng.choice(["c1", "c2"])
        s, pos = ref[c], rng.randrange(0, len(ref[c]) - 12)
        w, more = rng.randrange(1, 5), rng.randrange(0, 3)
        kind = rng.randrange(4)
        tail = s[pos + 1 + (w if kind == 0 else 0) :][:more]
        if kind == 0:
            r, a = s[pos : pos + 1 + w] + tail, s[pos] + tail
        elif kind == 1:
            r, a = s[pos] + tail, s[pos] + s[pos + 1 : pos + 1 + w] + tail
        elif kind == 2:
            r, a = s[pos] + tail, s[pos] + "".join(rng.choice("ACGT") for _ in range(w)) + tail
        else:
            r, a = s[pos : pos + w], "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 4)))
        rows.append((c, pos, r, a, k))
    rows.append(("c3", 4, "AT", "A", 900))  # a contig without a reference stays as it is
    df = spark.createDataFrame(rows, "contig string, pos long, ref string, alt string, k int")
    blocks = reference.blocks(table_of(spark, ref), size)
    got = {r["k"]: (r["pos"], r["ref"], r["alt"]) for r in reference.left_aligned(df, blocks, size, reach).collect()}
    wanted = {k: leftmost(ref.get(c, ""), pos, r, a) if c in ref else (pos, r, a) for c, pos, r, a, k in rows}
    assert got == wanted


def test_equivalent_calls_meet_their_hint(spark):
    ref = {"c": "GG" + "CA" * 40 + "TT"}
    blocks = reference.blocks(table_of(spark, ref), 16)
    calls = spark.createDataFrame([("c", p, ref["c"][p : p + 3], ref["c"][p], p) for p in range(1, 79)], "contig string, pos long, ref string, alt string, k int")
    hints = spark.createDataFrame([("c", 1, "GCA", "G", "here")], "contig string, pos long, ref string, alt string, hint string")
    got = reference.annotated(calls, hints, blocks, size=16).collect()
    assert len(got) == 78 and {r["hint"] for r in got} == {"here"}


def test_windows_are_pieces_of_the_contig(spark):
    ref = {"c1": "".join(random.Random(9).choice("ACGT") for _ in range(100)), "c2": "ACG"}
    rows = [(c, lo, lo + w) for c in ref for lo in range(-3, 99, 7) for w in (0, 1, 20, 40)]
    df = reference.with_window(spark.createDataFrame(rows, "contig string, lo long, hi long"), reference.blocks(table_of(spark, ref), 16), F.col("lo"), F.col("hi"), 40, "bases", 16)
    for r in df.collect():
        assert r["bases"] == ref[r["contig"]][max(r["lo"], 0) : max(r["hi"], 0)], r
    assert df.count() == len(rows)


def test_numbers_at_the_border_of_two_strings_stay_apart():
    found = cigars.letters(pa.array(["3A10", "5C2", None, "", "7", "12G0"]))
    assert list(zip(found.owner.tolist(), found.place.tolist(), found.base.tobytes().decode(), strict=True)) == [(0, 3, "A"), (1, 5, "C"), (5, 12, "G")]
    assert np.array_equal(cigars.walked(pa.array(["3M", None, "*", "2D1M"])).on_ref, [3, 0, 0, 3])


def test_numbers_and_texts_are_written_behind_one_another():
    text = np.frombuffer(b"M^ACGTI", np.uint8)
    got = cigars.written(np.array([7, 10, 0, 1234567]), text, np.array([1, 5, 0, 1]), np.array([0, 0, 2, 2]), 4)
    assert got.to_pylist() == ["7M10^ACGT", "", "01234567I", ""]
    assert cigars.written(*(np.zeros(0, np.int64) for _ in range(4)), 1).to_pylist() == [""]


def test_md_strings_of_long_stretches_and_of_none():
    ref = "ACGTACGTACGT" * 20
    seq = ref[:99] + "T" + ref[103:120] + "GG" + ref[120:200]
    strings = ["100M3D17M2I80M", None, "*", "2S3N1M", "3D", "4M"]
    got = cigars.md_strings(cigars.walked(pa.array(strings)), pa.array([seq, "A", "A", "GGA", "", "ACGT"]), pa.array([ref, ref, ref, "CCCA", "ACG", "TCGA"]))
    assert got.to_pylist() == [f"100^{ref[100:103]}97" if ref[99] == "T" else f"99{ref[99]}0^{ref[100:103]}97", "0", "0", "1", "0^ACG0", "0T2A0"]
