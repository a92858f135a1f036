"""Tables kept for range reads, reference sequences, and reads from and writes to other stores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_sorted(df: DataFrame, path: str, keys: list[str], files: int | None = None) -> None:
    """Parquet dealt and sorted by ``keys``, so that a range read skips files and row groups by their least and greatest."""
    dealt = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    dealt.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def read_range(spark: SparkSession, path: str, contig: str, lo: int, hi: int, position: str = "pos") -> DataFrame:
    """Rows of one contig with ``lo <= position < hi``; both conditions reach the scan."""
    return spark.read.parquet(path).filter((F.col("contig") == contig) & (F.col(position) >= lo) & (F.col(position) < hi))


def read_fasta(spark: SparkSession, path: str | list[str], block: int = 4096) -> DataFrame:
    """contig, block, seq: sequences in blocks of equal length; a file is one task's work."""
    whole = spark.read.text(path, wholetext=True)
    records = F.filter(F.split("value", ">"), lambda r: F.trim(r) != "")
    x = whole.select(F.explode(records).alias("r")).select(
        F.regexp_extract("r", r"^(\S+)", 1).alias("contig"), F.regexp_replace(F.regexp_replace("r", r"^[^\n]*\n?", ""), r"\s", "").alias("seq")
    )
    places = F.explode(F.sequence(F.lit(0), F.floor((F.greatest(F.length("seq"), F.lit(1)) - 1) / block).cast("int")))
    return x.withColumn("block", places).select("contig", F.col("block").cast("long").alias("block"), F.substr("seq", F.col("block") * block + 1, F.lit(block)).alias("seq"))


def with_base(points: DataFrame, reference: DataFrame, block: int = 4096, position: str = "pos") -> DataFrame:
    """Points (contig, position from 0) with the reference base there, null beyond it."""
    keyed = points.withColumn("block", F.floor(F.col(position) / block).cast("long"))
    at = (F.col(position) - F.col("block") * block + 1).cast("int")
    base = F.substr("seq", at, F.lit(1))
    return keyed.join(reference, ["contig", "block"], "left").withColumn("base", F.when(base != "", F.upper(base))).drop("block", "seq")


def read_jdbc(spark: SparkSession, url: str, query: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """A query of a database; give partitionColumn, lowerBound, upperBound and numPartitions in ``options`` to read in parallel."""
    return renamed(spark.read.format("jdbc").options(url=url, query=query, **(options or {})).load())


def renamed(df: DataFrame) -> DataFrame:
    """Columns of one name numbered from the second on: a, a_1, a_2."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        k = seen.get(c, 0)
        seen[c] = k + 1
        names.append(f"{c}_{k}" if k else c)
    return df.toDF(*names)


def write(df: DataFrame, path: str, form: str = "parquet", by: list[str] | None = None, **options: str) -> None:
    """Parquet, ORC, JSON, CSV (with a header), XML (give rowTag) or text, in folders by ``by`` if given."""
    out = df.write.mode("overwrite").options(**({"header": "true"} if form == "csv" else {}), **options)
    (out.partitionBy(*by) if by else out).format(form).save(path)


def flattened(df: DataFrame, sep: str = ".") -> DataFrame:
    """Structs, at any depth, as columns named by their path."""
    from pyspark.sql import types as T

    def leaves(schema: T.StructType, at: str = "") -> list[str]:
        out = []
        for f in schema:
            path = f"{at}`{f.name}`"
            out += leaves(f.dataType, f"{path}.") if isinstance(f.dataType, T.StructType) else [path]
        return out

    return df.select(*(F.col(p).alias(p.replace("`.`", sep).strip("`")) for p in leaves(df.schema)))
