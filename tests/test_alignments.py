"""Alignments worked out by hand, and by a plain walk over CIGAR and MD."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from granary.functions import arrays, sequence
from granary.operators import alignments, filters, relational
from granary.streaming import events

SCHEMA = "name string, contig string, start long, flag int, cigar string, md string"


def walked(cigar, md):
    """Errors (pos, kind, n), aligned bases and lengths at one error in 5, 10, 50 and 100 bases, op by op."""
    ops = [(int(n), k) for n, k in re.findall(r"(\d+)([MIDS])", cigar)]
    marks = []
    for x in re.findall(r"\d+|\^[A-Z]+|[A-Z]", md):
        marks += ["="] * int(x) if x.isdigit() else ["-"] * (len(x) - 1) if x[0] == "^" else ["x"]
    errors, bases, wrong, best = [], 0, 0, [0, 0, 0, 0]

    def seen():
        for k, one_in in enumerate((5, 10, 50, 100)):
            if wrong * one_in <= bases:
                best[k] = bases

    for n, kind in ops:
        if kind == "M":
            for _ in range(n):
                if marks.pop(0) == "x":
                    errors.append((bases, "sub", 1))
                    wrong += 1
                bases += 1
                seen()
        elif kind == "I":
            errors.append((bases, "ins", n))
            bases, wrong = bases + n, wrong + n
            seen()
        elif kind == "D":
            del marks[:n]
            errors.append((bases, "del", n))
            wrong += n
            seen()
    return sorted(errors), bases, best


def drawn(rng):
    """A random alignment: matching parts with substitutions, insertions and deletions between them."""
    cigar, md, run = "", "", 0
    if rng.random() < 0.3:
        cigar += f"{rng.randint(1, 9)}S"
    for k in range(rng.randint(1, 5)):
        if k:
            if rng.random() < 0.5:
                cigar += f"{rng.randint(1, 4)}I"
            else:
                n = rng.randint(1, 3)
                cigar, md, run = f"{cigar}{n}D", f"{md}{run}^{'ACG'[:n]}", 0
        n = rng.randint(1, 40)
        cigar += f"{n}M"
        for _ in range(n):
            if rng.random() < 0.05:
                md, run = f"{md}{run}T", 0
            else:
                run += 1
    return cigar, f"{md}{run}"


def test_errors_and_lengths_as_by_a_walk(spark):
    rng = random.Random(3)
    rows = [(str(k), "c", 5, 0, *drawn(rng)) for k in range(400)]
    found = alignments.with_errors(spark.createDataFrame(rows, SCHEMA))
    lengths = [alignments.length_at(F.col("errors"), F.col("bases"), n).alias(f"n{n}") for n in (5, 10, 50, 100)]
    for r in found.select("cigar", "md", "errors", "bases", *lengths).collect():
        errors, bases, best = walked(r["cigar"], r["md"])
        assert sorted(map(tuple, r["errors"])) == errors and r["bases"] == bases
        assert [r[f"n{n}"] for n in (5, 10, 50, 100)] == best, (r, best)


def test_filters_and_depth(spark):
    rows = [("a", "c", 10, 0, "2S3M1D2M", "3^A2"), ("b", "c", 12, 16, "2M1I1M", "3"), ("u", "c", 0, 4, "5M", "5"), ("d", "c", 0, 1024, "5M", "5"), ("q", "c", 0, 512, "5M", "5")]
    core = alignments.core(spark.createDataFrame(rows, SCHEMA))
    assert {r["name"] for r in core.collect()} == {"a", "b"}
    got = {(r["lo"], r["hi"]): (r["fwd"], r["rev"]) for r in alignments.depth(core).filter("depth > 0").collect()}
    assert got == {(10, 12): (1, 0), (12, 13): (1, 1), (13, 14): (0, 1), (14, 15): (1, 1), (15, 16): (1, 0)}
    assert [r["start"] for r in alignments.merged([core.filter("name = 'b'"), core.filter("name = 'a'")]).coalesce(1).collect()] == [10, 12]


def test_accuracy_at_a_length(spark):
    found = alignments.with_errors(spark.createDataFrame([("a", "c", 0, 0, "20M", "5A14"), ("b", "c", 0, 0, "9M", "9"), ("e", "c", 0, 0, "20M", "20")], SCHEMA))
    assert {r["name"] for r in alignments.accurate(found, 10, 0.9).collect()} == {"a", "e"}
    assert {r["name"] for r in alignments.accurate(found, 10, 0.95).collect()} == {"e"}


def test_read_names(spark):
    got = spark.createDataFrame([("R1:12:345",), ("R1:12",), (None,)], "n string").select(sequence.read_name_fields(F.col("n")).alias("f")).collect()
    assert [tuple(r["f"]) for r in got] == [("R1", 12, 345), (None, None, None), (None, None, None)]


def test_trim_keeps_what_stands_before_the_first_good_window(spark):
    rows = [([30] * 20,), ([30] * 10 + [2] * 10,), ([2] * 20,), ([],)]
    got = spark.createDataFrame(rows, "q array<int>").select(filters.trimmed_length(F.col("q"), 20).alias("n")).collect()
    # windows of two: the last place alone is good; the window of places 9 and 10 has a mean of 16, that of 8 and 9 one of 30
    assert [r["n"] for r in got] == [19, 8, 0, 0]


def test_swaps_may_be_free_or_off(spark):
    x = spark.createDataFrame([("ab", "ba")], "a string, b string")
    free, off = (x.select(arrays.weighted_edit(swap=s, substitute=2)("a", "b").alias("d")).first()["d"] for s in (0, None))
    assert (free, off) == (0, 4)


def test_nearest_by_join_and_by_literals(spark, monkeypatch):
    x = spark.createDataFrame([(k, k % 3, [float(k % 3), float(k)]) for k in range(30)], "id long, label int, v array<double>")
    one = sorted(map(tuple, relational.nearest(x, "id", "v", "label").collect()))
    monkeypatch.setattr(relational, "LITERAL_LABELS", 1)
    two = sorted(map(tuple, relational.nearest(x, "id", "v", "label").collect()))
    assert [r[:2] for r in one] == [r[:2] for r in two] and all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(one, two, strict=True))


def test_a_batch_that_is_run_again_is_written_once(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([(k, 10 * k)], "user long, t long").write.parquet(str(tmp_path / f"in/part{k}"))
    stream = spark.readStream.schema("user long, t long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    out = events.materialised(stream, "append")
    assert sorted(map(tuple, out.collect())) == [(0, 0), (1, 10), (2, 20)] and out.columns == ["user", "t"]
