"""Queries with fits, exact tests and mergeable metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators import matches, models, reference, sketches, variants
from granary.plans.base_queries import LEFT_ALIGNED_SQL, shifted_calls
from granary.plans.catalog import query
from granary.plans.read_queries import ALLELES_SQL, alleles
from granary.sources.tables import base_table, load


def _r(c, n: int = 6):
    return F.round(c, n)


def _log_chance(x: str) -> str:
    terms = (x, f"(fwd + rev - {x})", f"(fwd_depth - {x})", f"(rev_depth - rev - fwd + {x})")
    fixed = ("(fwd + rev)", "(depth - fwd - rev)", "fwd_depth", "rev_depth")
    return " + ".join(f"lgamma({t} + 1)" for t in fixed) + " - lgamma(depth + 1)" + "".join(f" - lgamma({t} + 1)" for t in terms)


@query(
    f"""WITH {ALLELES_SQL}, x AS (SELECT locus, ref, alt, fwd, rev, fwd_depth, rev_depth, depth, unnest(range(CAST(greatest(0, fwd + rev - rev_depth) AS BIGINT), CAST(least(fwd + rev, fwd_depth) + 1 AS BIGINT))) AS k FROM c),
p AS (SELECT locus, ref, alt, sum(exp({_log_chance("k")})) FILTER ({_log_chance("k")} <= {_log_chance("fwd")} + 1e-7) AS p FROM x GROUP BY locus, ref, alt)
SELECT locus, ref, alt, fwd, rev, round(abs(coalesce(fwd / nullif(fwd + rev, 0), 0.5) - coalesce((fwd_depth - fwd) / nullif(depth - fwd - rev, 0), 0.5)), 6) AS bias, round(least(p, 1.0), 6) AS bias_p FROM c JOIN p USING (locus, ref, alt)"""
)
def strand_bias_of_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = alleles(spark, sf_dir).withColumns({"other_fwd": F.col("fwd_depth") - F.col("fwd"), "other_rev": F.col("rev_depth") - F.col("rev")})
    return variants.strand_bias(x).select("locus", "ref", "alt", "fwd", "rev", _r("bias").alias("bias"), _r("bias_p").alias("bias_p"))


@query(
    f"""{LEFT_ALIGNED_SQL}, runs AS (SELECT contig, pos, base, count(*) OVER (PARTITION BY contig, base, run) - row_number() OVER (PARTITION BY contig, base, run ORDER BY pos) + 1 AS left_over
  FROM (SELECT *, pos - row_number() OVER (PARTITION BY contig, base ORDER BY pos) AS run FROM bases)),
k AS (SELECT a.*, CASE WHEN length(a.ref) > 1 THEN substr(a.ref, 2) ELSE substr(a.alt, 2) END AS moved FROM aligned a),
h AS (SELECT k.*, CASE WHEN replace(moved, substr(moved, 1, 1), '') = '' THEN length(alt) - length(ref) ELSE 0 END AS change,
  CASE WHEN replace(moved, substr(moved, 1, 1), '') = '' THEN CASE WHEN r.base = substr(moved, 1, 1) THEN least(left_over, 64) ELSE 0 END ELSE 0 END AS hrun FROM k LEFT JOIN runs r ON r.contig = k.contig AND r.pos = k.pos + 1)
SELECT CAST(hrun AS INTEGER) AS hrun, CAST(change AS INTEGER) AS change, NOT (hrun >= 4 AND (change > 1 OR -change > 1)) AND NOT (hrun >= 7 AND (change > 0 OR -change > 0)) AS passes, CAST(sum(n) AS BIGINT) AS calls FROM h GROUP BY ALL"""
)
def homopolymer_indel_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = reference.blocks(base_table(spark, sf_dir))
    x = reference.homopolymer_context(shifted_calls(spark, sf_dir), blocks)
    return x.withColumn("passes", reference.passes_homopolymer((4, 7), (1, 0), (1, 0))).groupBy("hrun", "change", "passes").agg(F.sum("n").alias("calls"))


@query(
    """WITH RECURSIVE g AS MATERIALIZED (SELECT l_quantity AS x, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS y FROM lineitem GROUP BY l_quantity),
fit AS (SELECT 0 AS step, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b UNION ALL
  SELECT step + 1, a + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), b + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) FROM (
    SELECT step, a, b, sum(y - n * p) AS g0, sum(x * (y - n * p)) AS g1, sum(n * p * (1 - p)) AS h00, sum(n * x * p * (1 - p)) AS h01, sum(n * x * x * p * (1 - p)) AS h11
    FROM (SELECT step, a, b, x, n, y, 1 / (1 + exp(-(a + b * x))) AS p FROM fit, g WHERE step < 25) GROUP BY step, a, b)),
l AS (SELECT a, b FROM fit WHERE step = 25)
SELECT 'intercept' AS name, round(a, 6) AS value FROM l UNION ALL SELECT 'l_quantity', round(b, 6) FROM l"""
)
def logistic_fit_of_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").select("l_quantity", (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    rows = models.logistic(x, ["l_quantity"], "returned").rows()
    return spark.createDataFrame([(n, round(v, 6)) for n, v, _, _ in rows], "name string, value double")


@query()
def clonality_by_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive flows and squares off whole numbers as two normal components; tests hold the fit against numpy."""
    x = load(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double") * 10).alias("flows"))
    out = models.clonality(x, "flows")
    return out.groupBy("label").agg(F.count("*").alias("reads"), F.count_if("clonal").alias("clonal"), _r(F.avg("ppf"), 4).alias("mean_ppf"))


@query(
    """SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS mean, round(var_pop(l_quantity), 4) AS var_pop, min(l_quantity) AS least, max(l_quantity) AS most, count(DISTINCT floor(l_quantity / 5)) AS bins, count(*) FILTER (l_quantity >= 25) AS large, true AS near FROM lineitem GROUP BY l_returnflag"""
)
def merged_block_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of blocks (line numbers), through JSON texts, merged to those of each flag; ``near``: sketches are within their errors."""
    x = load(spark, sf_dir, "lineitem")
    parts = sketches.to_json(sketches.partial(x, ["l_returnflag", "l_linenumber"], "l_quantity", "l_partkey", 5.0), ["l_returnflag", "l_linenumber"])
    said = sketches.final(sketches.merged(sketches.from_json(parts, ["l_returnflag", "l_linenumber"]), ["l_returnflag"]), ["l_returnflag"], {"q50": 0.5})
    exact = x.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.median("l_quantity").alias("median"))
    near = (F.abs(F.col("distinct") - F.col("parts")) <= F.greatest(0.06 * F.col("parts"), F.lit(2))) & (F.abs(F.col("q50") - F.col("median")) <= 3)
    return said.join(exact, "l_returnflag").select("l_returnflag", "n", _r("mean").alias("mean"), _r("var_pop", 4).alias("var_pop"), "least", "most", F.size("bins").cast("long").alias("bins"), sketches.bins_at_least(F.col("bins"), 5).alias("large"), near.alias("near"))


@query(
    """WITH i AS (SELECT item_id, p, substr(text, CAST(p + 1 AS BIGINT), 32) AS s FROM (SELECT item_id, text, unnest(range(length(text) - 31)) AS p FROM benchmark WHERE length(text) >= 32)),
d AS (SELECT doc_id, q, substr(text, CAST(q + 1 AS BIGINT), 32) AS s FROM (SELECT doc_id, text, unnest(range(length(text) - 31)) AS q FROM documents WHERE length(text) >= 32)),
m AS (SELECT item_id, doc_id, p, q, p - row_number() OVER (PARTITION BY item_id, doc_id, q - p ORDER BY p) AS run FROM i JOIN d USING (s))
SELECT item_id, doc_id AS contig, min(p) AS read_start, min(q) AS ref_start, count(*) + 31 AS length FROM m GROUP BY item_id, doc_id, q - p, run"""
)
def maximal_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of 32 characters or more of benchmark items in documents, as long as they go."""
    docs = load(spark, sf_dir, "documents")
    return matches.maximal(load(spark, sf_dir, "benchmark"), lambda over: matches.text_blocks(docs, "doc_id", "text", over=over), "item_id", "text", 32, 20, unknown=None)
