"""Queries on alignments: filters, depth and errors from CIGAR and MD strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import sequence
from granary.operators import alignments as al
from granary.plans.catalog import query
from granary.sources.tables import ALIGNMENTS_SQL, alignments


@query(f"WITH {ALIGNMENTS_SQL} SELECT contig, count(*) AS kept, CAST(sum(bases) AS BIGINT) AS bases, count(*) FILTER (forward) AS forward FROM alignments WHERE NOT (unmapped OR duplicate OR failed) GROUP BY contig")
def alignment_core_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = al.core(alignments(spark, sf_dir)).withColumn("bases", sequence.cigar_length(sequence.cigar_ops(F.col("cigar")), "MI=X"))
    return x.groupBy("contig").agg(F.count("*").alias("kept"), F.sum("bases").alias("bases"), F.count_if(~al.has(F.col("flag"), al.REVERSE)).alias("forward"))


@query(
    f"""WITH {ALIGNMENTS_SQL}, b AS (SELECT contig, forward, unnest(range(start, start + 2 * p)) AS pos FROM alignments UNION ALL SELECT contig, forward, unnest(range(start + 2 * p + d, start + 3 * p + d)) FROM alignments),
c AS (SELECT contig, pos, count(*) AS depth, count(*) FILTER (forward) AS fwd FROM b GROUP BY contig, pos)
SELECT contig, depth, count(*) AS positions, CAST(sum(fwd) AS BIGINT) AS fwd_bases FROM c GROUP BY contig, depth"""
)
def cigar_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    width = F.col("hi") - F.col("lo")
    return al.depth(alignments(spark, sf_dir)).filter("depth > 0").groupBy("contig", "depth").agg(F.sum(width).alias("positions"), F.sum(width * F.col("fwd")).alias("fwd_bases"))


def _lengths_sql() -> str:
    best = ", ".join(f"coalesce(max(pos) FILTER (before * {k} <= pos), 0) AS q{q}" for q, k in al.ONE_IN.items())
    sums = ", ".join(f"CAST(sum(q{q}) AS BIGINT) AS aq{q}" for q in al.ONE_IN)
    return f"""WITH {ALIGNMENTS_SQL}, e AS (SELECT id, contig, pos, n FROM alignment_errors UNION ALL SELECT id, contig, bases, 0 FROM alignments),
o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY id ORDER BY pos, n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e), l AS (SELECT id, contig, {best} FROM o GROUP BY id, contig)
SELECT contig, count(*) AS reads, {sums} FROM l GROUP BY contig"""


@query(_lengths_sql())
def aligned_length_at_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = al.with_errors(alignments(spark, sf_dir))
    return x.groupBy("contig").agg(F.count("*").alias("reads"), *(F.sum(al.length_at(F.col("errors"), F.col("bases"), k)).alias(f"aq{q}") for q, k in al.ONE_IN.items()))


@query(
    f"""WITH {ALIGNMENTS_SQL}, d AS (SELECT contig, unnest(range(bases)) AS pos FROM alignments), g AS (SELECT contig, pos, count(*) AS depth FROM d GROUP BY contig, pos),
c AS (SELECT contig, pos, count(*) FILTER (kind = 'ins') AS ins, count(*) FILTER (kind = 'del') AS del, count(*) FILTER (kind = 'sub') AS sub FROM single_errors GROUP BY contig, pos)
SELECT contig, pos, coalesce(ins, 0) AS ins, coalesce(del, 0) AS del, coalesce(sub, 0) AS sub, depth FROM g LEFT JOIN c USING (contig, pos)"""
)
def error_kinds_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.errors_by_position(al.with_errors(alignments(spark, sf_dir)), ["contig"])


@query(f"WITH {ALIGNMENTS_SQL}, c AS (SELECT name, contig, pos, count(*) AS n FROM single_errors GROUP BY ALL) SELECT contig, n, count(*) AS places FROM c GROUP BY contig, n")
def consolidated_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.consolidated(al.with_errors(alignments(spark, sf_dir)), ["name", "contig"]).groupBy("contig", "n").agg(F.count("*").alias("places"))


@query(
    f"""WITH {ALIGNMENTS_SQL}, w AS (SELECT id, CAST(sum(n) AS BIGINT) AS wrong FROM alignment_errors WHERE pos < 20 GROUP BY id)
SELECT contig, count(*) AS reads FROM alignments LEFT JOIN w USING (id) WHERE bases >= 20 AND coalesce(wrong, 0) <= 20 AND (20 - coalesce(wrong, 0)) / 20 >= 0.9 GROUP BY contig"""
)
def accurate_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.accurate(al.with_errors(alignments(spark, sf_dir)), 20, 0.9).groupBy("contig").agg(F.count("*").alias("reads"))


@query("SELECT l_linenumber AS col, count(*) AS reads, min(l_orderkey) AS first_row, max(l_orderkey) AS last_row FROM lineitem GROUP BY l_linenumber")
def read_name_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = alignments(spark, sf_dir).select(sequence.read_name_fields(F.col("name")).alias("f"))
    return x.groupBy("f.col").agg(F.count("*").alias("reads"), F.min("f.row").cast("long").alias("first_row"), F.max("f.row").cast("long").alias("last_row"))


@query("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS disorder FROM lineitem")
def merged_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward and reverse alignments as two sets, merged to one: how many rows there are, and how many stand out of order."""
    x = alignments(spark, sf_dir)
    strands = [x.filter(al.has(F.col("flag"), al.REVERSE)), x.filter(~al.has(F.col("flag"), al.REVERSE))]
    return al.disorder(al.merged(strands), ["contig", "start"])
