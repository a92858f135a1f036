"""Text formats: what is written is read back, and what is odd about them."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.sources import formats


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_bed(spark, tmp_path):
    p = write(tmp_path, "a.bed", "track name=x\nchr1\t5\t9\tr1\tGENE=A,B;HOTSPOTS_ONLY\nchr2\t7\t3\tr2\t.\nchr9\tx\t3\n")
    bed = formats.read_bed(spark, p)
    got = {r["name"]: r for r in bed.collect()}
    assert got["r1"]["info"] == {"GENE": ["A", "B"], "HOTSPOTS_ONLY": [""]} and got["r1"]["lo"] == 5
    contigs = spark.createDataFrame([("chr1", 8), ("chr2", 100)], "contig string, size long")
    faults = {r["contig"]: r["faults"] for r in formats.bed_faults(bed, contigs).collect()}
    assert faults == {"chr1": ["end beyond the contig"], "chr2": ["end not after start"], "chr9": ["start is no number", "unknown contig"]}
    assert formats.padded(bed.filter("contig = 'chr1'"), contigs, 6).select("lo", "hi").first() == (0, 8)


def test_sam(spark, tmp_path):
    p = write(tmp_path, "a.sam", "@HD\tVN:1\nr1\t16\tchr1\t11\t60\t3M2D2M\t*\t0\t0\tACGTA\tIIIII\tNM:i:2\tRG:Z:a:b\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\n")
    a, b = formats.read_sam(spark, p).orderBy("read_id").collect()
    assert (a["lo"], a["hi"], a["forward"], a["tags"]) == (10, 17, False, {"NM": "2", "RG": "a:b"})
    assert b["mapped"] is False


def test_fastq_round_trip(spark, tmp_path):
    p = write(tmp_path, "a.fastq", "@r1 x\nACG\n+\n@@I\n@r2\nT\n+\nI\n")
    reads = formats.read_fastq(spark, p)
    assert sorted(map(tuple, reads.collect())) == [("r1 x", "ACG", "@@I"), ("r2", "T", "I")]
    formats.fastq_lines(reads).write.text(str(tmp_path / "out"))
    assert sorted(map(tuple, formats.read_fastq(spark, str(tmp_path / "out")).collect())) == sorted(map(tuple, reads.collect()))


def test_vcf_round_trip_and_targets(spark, tmp_path):
    p = write(tmp_path, "a.vcf", "##x\n#CHROM\nchr2\t3\t.\tA\tC,G\t9.5\tPASS\tDP=7;HS\tGT:DP\t0/1:7\nchr1\t5\tid\tT\tA\t.\tPASS\tDP=1\n")
    v = formats.read_vcf(spark, p)
    r = v.filter("contig = 'chr2'").first()
    assert r["pos"] == 2 and r["alt"] == ["C", "G"] and r["info"] == {"DP": ["7"], "HS": [""]} and r["sample"] == {"GT": "0/1", "DP": "7"}
    contigs = spark.createDataFrame([("chr1", 1), ("chr2", 0)], "contig string, place int")
    lines = [x["value"] for x in formats.vcf_lines(v, contigs).collect()]
    assert lines == ["chr2\t3\t.\tA\tC,G\t9.5\tPASS\tDP=7;HS", "chr1\t5\tid\tT\tA\t.\tPASS\tDP=1"]
    targets = formats.read_bed(spark, write(tmp_path, "t.bed", "chr1\t0\t9\ta\tHOTSPOTS_ONLY\nchr2\t0\t9\tb\tHOTSPOTS_ONLY=\n"))
    only = targets.withColumn("info", F.create_map(F.lit("HOTSPOTS_ONLY"), F.array(F.lit(""))))
    assert [x["contig"] for x in formats.filter_by_target(v, only).collect()] == ["chr2"]


def test_csv_types(spark, tmp_path):
    p = write(tmp_path, "a.csv", 'a,b,c\n"1,000",,x\n2,2.5,\n')
    x = formats.read_csv(spark, p, {"a": "long", "c": "double"})
    assert [r["a"] for r in x.collect()] == [1000, 2] and [r["c"] for r in x.collect()] == [None, None]
    raw = formats.read_csv(spark, p)
    assert {r["name"]: r["type"] for r in formats.guess_types(raw, ["a", "b", "c"]).collect()} == {"a": "integer", "b": "real", "c": "text"}


def test_log(spark, tmp_path):
    p = write(tmp_path, "explog.txt", "Run Name: a:b\nBlockStatus: one\nnoise\nBlockStatus: two\nRun Name: last\n")
    r = formats.read_log(spark, p).first()
    assert r["fields"] == {"run_name": "last"} and r["lists"] == {"blockstatus": ["one", "two"]}


def test_file_selection(spark):
    f = spark.createDataFrame([("a.bam",), ("a.tmp",), ("keep.tmp",), ("b.bam.bai",)], "path string")
    assert sorted(r[0] for r in formats.selected_files(f, [r"\.bam", r"\.tmp$"], [r"\.tmp$", "bai"], ["keep"]).collect()) == ["a.bam", "keep.tmp"]


def test_sorted_store_reads_a_range(spark, tmp_path):
    from granary.sources import stores

    x = spark.range(1000).selectExpr("if(id % 2 = 0, 'a', 'b') AS contig", "id AS pos")
    stores.write_sorted(x, str(tmp_path / "cov"), ["contig", "pos"], 4)
    got = stores.read_range(spark, str(tmp_path / "cov"), "a", 10, 20)
    assert sorted(r["pos"] for r in got.collect()) == [10, 12, 14, 16, 18]
    assert "PushedFilters: [IsNotNull(contig), IsNotNull(pos), EqualTo(contig,a)" in got._jdf.queryExecution().toString()


def test_reference_bases(spark, tmp_path):
    from granary.sources import stores

    ref = stores.read_fasta(spark, write(tmp_path, "r.fa", ">chr1 first\nACGT\nacgt\n>chr2\nTT\n"), block=3)
    points = spark.createDataFrame([("chr1", 0), ("chr1", 7), ("chr1", 9), ("chr2", 1), ("chr3", 0)], "contig string, pos long")
    assert sorted(map(tuple, stores.with_base(points, ref, 3).collect()), key=str) == sorted([("chr1", 0, "A"), ("chr1", 7, "T"), ("chr1", 9, None), ("chr2", 1, "T"), ("chr3", 0, None)], key=str)


def test_formats_and_names(spark, tmp_path):
    from granary.sources import stores

    x = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for form, more in (("json", {}), ("csv", {}), ("orc", {}), ("xml", {"rowTag": "row"})):
        stores.write(x, str(tmp_path / form), form, **more)
        back = spark.read.format(form).options(**({"header": "true"} if form == "csv" else {}), **more).schema("k int, v string").load(str(tmp_path / form))
        assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, "b")]
    twice = x.select("k", F.col("v").alias("k"), F.col("v").alias("k"))
    assert stores.renamed(twice).columns == ["k", "k_1", "k_2"]
    nested = x.select(F.struct("k", F.struct("v").alias("s")).alias("r"), "v")
    assert stores.flattened(nested).columns == ["r.k", "r.s.v", "v"]


def test_registry_checks_columns(spark):
    import pytest

    from granary.operators import registry

    x = spark.createDataFrame([("a", 0, 5), ("a", 7, 9)], "contig string, lo long, hi long")
    assert registry.run("gaps", x).collect() == [("a", 5, 7)]
    with pytest.raises(ValueError):
        registry.run("gaps", x.drop("hi"))
    registry.operator("odd", {"n": "string"})(lambda df: df.selectExpr("1 AS n"))
    with pytest.raises(TypeError):
        registry.run("odd", x)
