"""Text formats of sequencing as DataFrames: BED, SAM, FASTQ, VCF, logs, typed CSV.

Positions are half-open and count from 0 inside; formats that count from 1 are
converted where they are read and written.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.sequence import cigar_length, cigar_ops, clean_key, key_values


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def read_bed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """contig, lo, hi, name, info (a map of arrays); header, track and comment lines are left out."""
    x = _lines(spark, path).filter(~F.col("value").rlike(r"^(#|track\b|browser\b|\s*$)"))
    f = F.split("value", "\t")
    last = F.element_at(f, -1)
    info = F.when(last.contains("="), key_values(last)).otherwise(F.create_map().cast("map<string,array<string>>"))
    return x.select(F.get(f, F.lit(0)).alias("contig"), F.get(f, F.lit(1)).try_cast("long").alias("lo"), F.get(f, F.lit(2)).try_cast("long").alias("hi"), F.coalesce(F.get(f, F.lit(3)), F.lit(".")).alias("name"), info.alias("info"))


def bed_faults(bed: DataFrame, contigs: DataFrame) -> DataFrame:
    """Rows of ``read_bed`` with what is wrong about them; ``contigs`` has contig and size."""
    rules: Mapping[str, Column] = {
        "start is no number": F.col("lo").isNull(),
        "end is no number": F.col("hi").isNull(),
        "start below 0": F.col("lo") < 0,
        "end not after start": F.col("hi") <= F.col("lo"),
        "unknown contig": F.col("size").isNull(),
        "end beyond the contig": F.col("hi") > F.col("size"),
    }
    wrong = F.array_compact(F.array(*(F.when(cond, F.lit(name)) for name, cond in rules.items())))
    return bed.join(contigs, "contig", "left").withColumn("faults", wrong).filter(F.size("faults") > 0).drop("size")


def padded(bed: DataFrame, contigs: DataFrame, by: int) -> DataFrame:
    """Regions widened on both sides, within their contigs."""
    return bed.join(contigs, "contig").withColumns({"lo": F.greatest(F.col("lo") - by, F.lit(0)), "hi": F.least(F.col("hi") + by, F.col("size"))}).drop("size")


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Alignments with flags taken apart, CIGAR operations, the range on the reference, and tags as a map."""
    x = _lines(spark, path).filter(~F.col("value").startswith("@"))
    f = F.split("value", "\t")
    flag = F.get(f, F.lit(1)).cast("int")
    ops = cigar_ops(F.get(f, F.lit(5)))
    tags = F.map_from_entries(F.transform(F.slice(f, 12, F.greatest(F.size(f) - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.regexp_replace(t, "^[^:]*:[^:]*:", "").alias("v"))))
    lo = F.get(f, F.lit(3)).cast("long") - 1
    return x.select(
        F.get(f, F.lit(0)).alias("read_id"),
        flag.alias("flag"),
        (flag.bitwiseAND(F.lit(4)) == 0).alias("mapped"),
        (flag.bitwiseAND(F.lit(16)) == 0).alias("forward"),
        (flag.bitwiseAND(F.lit(512)) != 0).alias("failed"),
        (flag.bitwiseAND(F.lit(1024)) != 0).alias("duplicate"),
        F.get(f, F.lit(2)).alias("contig"),
        lo.alias("lo"),
        (lo + cigar_length(ops, "MDN=X")).alias("hi"),
        F.get(f, F.lit(4)).cast("int").alias("mapq"),
        ops.alias("cigar"),
        F.get(f, F.lit(9)).alias("seq"),
        f[10].alias("qual"),
        tags.alias("tags"),
    )


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """name, seq, qual: a file is one task's work, as its records can't be told apart from the middle."""
    whole = spark.read.text(path, wholetext=True)
    lines = F.split(F.rtrim(F.regexp_replace("value", "\r", "")), "\n")
    record = F.transform(F.sequence(F.lit(0), F.floor(F.size("l") / 4).cast("int") - 1), lambda i: F.struct(F.substring(F.get("l", i * 4), 2, 1 << 30).alias("name"), F.get("l", i * 4 + 1).alias("seq"), F.get("l", i * 4 + 3).alias("qual")))
    return whole.select(lines.alias("l")).filter(F.size("l") >= 4).select(F.inline(record))


def fastq_lines(reads: DataFrame) -> DataFrame:
    """One column ``value`` with four lines a read, to be written as text."""
    return reads.select(F.concat(F.lit("@"), "name", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value"))


def read_vcf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """contig, pos (from 0), id, ref, alt (array), quality, filter, info map, sample map."""
    x = _lines(spark, path).filter(~F.col("value").startswith("#"))
    f = F.split("value", "\t")
    names, values = F.split(F.get(f, F.lit(8)), ":"), F.split(F.get(f, F.lit(9)), ":")
    sample = F.when(F.size(f) > 9, F.map_from_arrays(names, F.transform(names, lambda _, i: F.get(values, i))))
    return x.select(F.get(f, F.lit(0)).alias("contig"), (F.get(f, F.lit(1)).cast("long") - 1).alias("pos"), F.get(f, F.lit(2)).alias("id"), F.get(f, F.lit(3)).alias("ref"), F.split(F.get(f, F.lit(4)), ",").alias("alt"), F.get(f, F.lit(5)).try_cast("double").alias("quality"), F.get(f, F.lit(6)).alias("filter"), key_values(F.get(f, F.lit(7))).alias("info"), sample.alias("sample"))


def vcf_lines(variants: DataFrame, contigs: DataFrame) -> DataFrame:
    """Lines of records in the order of ``contigs`` (contig, place) and position, range-partitioned."""
    info = F.array_join(F.transform(F.array_sort(F.map_entries("info")), lambda e: F.when(F.array_join(e["value"], "") == "", e["key"]).otherwise(F.concat(e["key"], F.lit("="), F.array_join(e["value"], ",")))), ";")
    line = F.concat_ws("\t", "contig", (F.col("pos") + 1).cast("string"), "id", "ref", F.array_join("alt", ","), F.coalesce(F.col("quality").cast("string"), F.lit(".")), "filter", F.when(info == "", ".").otherwise(info))
    x = variants.join(contigs, "contig").select("place", "pos", line.alias("value"))
    return x.repartitionByRange("place", "pos").sortWithinPartitions("place", "pos", "value").select("value")


def filter_by_target(variants: DataFrame, targets: DataFrame) -> DataFrame:
    """Variants inside a target; in targets with HOTSPOTS_ONLY only those with an HS mark."""
    from granary.operators.intervals import overlap_join

    points = variants.withColumns({"lo": F.col("pos"), "hi": F.col("pos") + 1})
    only = F.col("info").isNotNull() & F.map_contains_key("info", "HOTSPOTS_ONLY")
    pairs = overlap_join(points, targets.select("contig", "lo", "hi", F.coalesce(only, F.lit(False)).alias("only")))
    good = pairs.filter(~F.col("r_only") | F.map_contains_key("l_info", "HS"))
    rest = [c for c in variants.columns if c != "contig"]
    return good.select("contig", *(F.col(f"l_{c}").alias(c) for c in rest)).dropDuplicates(["contig", "pos", "id", "ref"])


def read_log(spark: SparkSession, path: str | list[str], repeated: tuple[str, ...] = ("blockstatus",)) -> DataFrame:
    """``name: value`` lines of each file as two maps: single values (the last counts) and lists."""
    x = spark.read.text(path).select(F.input_file_name().alias("file"), "value", F.monotonically_increasing_id().alias("n")).filter(F.col("value").contains(":"))
    x = x.select("file", "n", clean_key(F.substring_index("value", ":", 1)).alias("key"), F.trim(F.regexp_replace("value", "^[^:]*:", "")).alias("v"))
    many = F.col("key").isin(*repeated)
    lists = x.filter(many).groupBy("file", "key").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "v"))), lambda e: e["v"]).alias("v")).groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("key", "v"))).alias("lists"))
    single = x.filter(~many).groupBy("file", "key").agg(F.max_by("v", "n").alias("v")).groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("key", "v"))).alias("fields"))
    return single.join(lists, "file", "full")


def read_csv(spark: SparkSession, path: str | list[str], casts: Mapping[str, str] | None = None, sep: str = ",") -> DataFrame:
    """A table with a header; named columns are cast, values that can't be are null."""
    x = spark.read.option("header", True).option("sep", sep).csv(path)
    return x.withColumns({c: F.regexp_replace(c, ",", "").try_cast(t) for c, t in (casts or {}).items()})


def guess_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row a column: integer, real or text. Empty cells fit every type; commas in numbers are ignored.

    All rows are looked at, not the first hundred.
    """

    def fits(c: str, pattern: str) -> Column:
        v = F.regexp_replace(F.trim(F.coalesce(F.col(c), F.lit(""))), ",", "")
        return F.bool_and((v == "") | v.rlike(pattern))

    one = df.agg(*(F.when(fits(c, r"^[+-]?\d+$"), "integer").when(fits(c, r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), "real").otherwise("text").alias(c) for c in columns))
    return one.select(F.inline(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("type")) for c in columns))))


def selected_files(files: DataFrame, include: list[str], exclude: list[str], keep: list[str], name: str = "path") -> DataFrame:
    """Files that match an include pattern and no exclude pattern, and those that match a keep pattern."""

    def any_of(patterns: list[str]) -> Column:
        out = F.lit(False)
        for p in patterns:
            out = out | F.col(name).rlike(p)
        return out

    return files.filter((any_of(include) & ~any_of(exclude)) | any_of(keep))
