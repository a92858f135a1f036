"""BAM files written by the test, read as a data source: all rows, in several tasks, by region."""

from __future__ import annotations

import random

import pytest

from granary.sources import bam, formats


def rows(rng, n, contigs):
    out = []
    for k in range(n):
        mapped = rng.random() < 0.95
        w = rng.randrange(1, 120)
        cigar = f"{rng.randrange(1, 9)}S{w}M{rng.randrange(1, 4)}D3M" if mapped else "*"
        size = w + 3 + int(cigar.split("S")[0]) if mapped else rng.randrange(0, 30)
        seq = "".join(rng.choice("ACGTN") for _ in range(size)) or "*"
        qual = "*" if seq == "*" or rng.random() < 0.1 else "".join(chr(33 + rng.randrange(60)) for _ in seq)
        tags = {"MD": ("Z", f"{w}^AC3"), "NM": ("C", "2")} if mapped else {}
        if rng.random() < 0.3:
            tags |= {"XA": ("A", "q"), "XI": ("i", "-70000"), "XS": ("s", "-3"), "XF": ("f", "1.5"), "XB": ("B", "S,1,500,7"), "XH": ("H", "1AE3"), "XE": ("Z", "")}
        out.append((f"read:{k}", rng.choice([0, 16, 1024]) if mapped else 4, rng.choice(contigs)[0] if mapped else "*", rng.randrange(0, 9000) if mapped else -1, rng.randrange(60), cigar, seq, qual, tags))
    place = {c: k for k, (c, _) in enumerate(contigs)} | {"*": len(contigs)}
    return sorted(out, key=lambda r: (place[r[2]], r[3]))


CONTIGS = [("chr1", 10_000), ("chr10", 10_000), ("chr2", 10_000)]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    at = tmp_path_factory.mktemp("bam")
    some = rows(random.Random(4), 4000, CONTIGS)
    # small blocks, so that records lie over their borders
    (at / "x.bam").write_bytes(b"".join(bam.encoded(iter(some), CONTIGS, block=3000)))
    lines = ["@HD\tVN:1.6\tSO:coordinate", *("\t".join([r[0], str(r[1]), r[2], str(r[3] + 1), str(r[4]), r[5], "*", "0", "0", r[6], r[7], *(f"{k}:{'i' if t in 'cCsSiI' else t}:{v}" for k, (t, v) in r[8].items())]) for r in some)]
    (at / "x.sam").write_text("\n".join(lines) + "\n")
    return str(at), some


def test_rows_are_those_of_the_sam_text(spark, files):
    got = bam.read_as_sam(spark, f"{files[0]}/x.bam")
    wanted = formats.read_sam(spark, f"{files[0]}/x.sam")
    assert got.columns == wanted.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, wanted.collect())))


@pytest.mark.parametrize("size", [2000, 7001, 40_000])
def test_every_record_is_read_once_whatever_the_ranges(spark, files, size):
    df = bam.read(spark, f"{files[0]}/x.bam", ["read_id", "start"], range_bytes=size)
    assert df.rdd.getNumPartitions() > 3
    assert sorted(tuple(r) for r in df.collect()) == sorted((r[0], r[3]) for r in files[1])


@pytest.mark.parametrize(("contig", "low", "high"), [("chr10", 3000, 3500), ("chr1", 0, 10), ("chr2", 8990, 20_000), ("*", -5, 5), ("none", 0, 9)])
def test_a_region_reads_fewer_ranges(spark, files, contig, low, high):
    path = f"file://{files[0]}/x.bam"
    df, part = bam.read(spark, path, ["read_id"], range_bytes=8000), bam.read(spark, path, ["read_id"], (contig, low, high), 8000)
    assert sorted(r["read_id"] for r in part.collect()) == sorted(r[0] for r in files[1] if r[2] == contig and low <= r[3] < high)
    assert part.rdd.getNumPartitions() < df.rdd.getNumPartitions() / 3
    assert df.count() == len(files[1])


def test_large_records_over_many_blocks(spark, tmp_path):
    some = [(f"r{k}", 0, "chr1", k, 9, f"{n}M", "ACGT" * (n // 4), "*", {}) for k, n in enumerate([40_000, 8, 120_000, 12, 12])]
    (tmp_path / "y.bam").write_bytes(b"".join(bam.encoded(iter(some), CONTIGS, block=5000)))
    got = bam.read(spark, [str(tmp_path / "y.bam")], ["read_id", "cigar", "seq"], range_bytes=3000)
    assert sorted(tuple(r) for r in got.collect()) == sorted((r[0], r[5], r[6]) for r in some)


def test_no_records_and_no_bam(spark, tmp_path):
    (tmp_path / "e.bam").write_bytes(b"".join(bam.encoded(iter([]), CONTIGS)))
    (tmp_path / "n.bam").write_bytes(b"plain text, no blocks")
    assert bam.read(spark, str(tmp_path / "e.bam")).collect() == []
    with pytest.raises(Exception, match="BGZF"):
        bam.read(spark, str(tmp_path / "n.bam")).collect()
