"""Queries on coverage and regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators import coverage, intervals
from granary.plans.catalog import query
from granary.sources.tables import READS_SQL, load, reads, sparse_reads, tiles, tiles_sql

_POSITIONS = f"""{READS_SQL},
ends AS (SELECT contig, min(lo) AS a, max(hi) AS b FROM reads GROUP BY contig),
pos AS (SELECT contig, unnest(range(a, b)) AS p FROM ends),
cov AS (SELECT contig, unnest(range(lo, hi)) AS p, forward FROM reads),
cnt AS (SELECT contig, p, count(*) FILTER (forward) AS fwd, count(*) FILTER (NOT forward) AS rev FROM cov GROUP BY contig, p),
base AS (SELECT contig, p, coalesce(fwd, 0) AS fwd, coalesce(rev, 0) AS rev, coalesce(fwd, 0) + coalesce(rev, 0) AS depth FROM pos LEFT JOIN cnt USING (contig, p))"""


def _round(x: str | Column, n: int = 6) -> Column:
    return F.round(x, n)


@query(
    f"""WITH {_POSITIONS},
m AS (SELECT contig, count(*) AS span, CAST(sum(depth) AS BIGINT) AS bases, 0.2 * sum(depth) / count(*) AS t FROM base GROUP BY contig),
s AS (SELECT contig, any_value(span) AS span, any_value(bases) AS bases, any_value(t) AS t,
  count(*) FILTER (depth >= floor(t)) / count(*) AS u0, count(*) FILTER (depth >= floor(t) + 1) / count(*) AS u1,
  count(*) FILTER (depth >= 1) / count(*) AS c1, count(*) FILTER (depth >= 20) / count(*) AS c20, count(*) FILTER (depth >= 100) / count(*) AS c100, count(*) FILTER (depth >= 500) / count(*) AS c500,
  count(*) FILTER (depth >= 10 AND greatest(fwd, rev) > 0.7 * depth) / count(*) AS biased
  FROM base JOIN m USING (contig) GROUP BY contig)
SELECT contig, span, bases, round(bases / span, 6) AS mean_depth, round(100 * ((1 - (t - floor(t))) * u0 + (t - floor(t)) * u1), 6) AS uniformity,
  round(100.0 * c1, 6) AS pct_1x, round(100.0 * c20, 6) AS pct_20x, round(100.0 * c100, 6) AS pct_100x, round(100.0 * c500, 6) AS pct_500x, round(100.0 * (1 - biased), 6) AS pct_no_bias FROM s"""
)
def coverage_depth_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = coverage.report(coverage.steps(reads(spark, sf_dir)))
    return out.select("contig", "span", "bases", *(_round(c).alias(c) for c in out.columns[3:]))


@query(f"WITH {_POSITIONS} SELECT contig, p AS pos, fwd, rev FROM base WHERE depth > 0")
def coverage_per_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.per_base(reads(spark, sf_dir))


@query(
    f"""WITH {_POSITIONS}, h AS (SELECT contig, depth, count(*) AS positions FROM base GROUP BY contig, depth),
t AS (SELECT contig, count(*) AS span, sum(depth) AS bases FROM base GROUP BY contig)
SELECT contig, depth, positions, CAST(sum(positions) OVER (PARTITION BY contig ORDER BY depth DESC) AS BIGINT) AS at_least,
 round(depth * span / bases, 6) AS norm_depth, round(100.0 * sum(positions) OVER (PARTITION BY contig ORDER BY depth DESC) / span, 6) AS pct FROM h JOIN t USING (contig)"""
)
def coverage_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = coverage.cumulative(coverage.steps(reads(spark, sf_dir)))
    return out.withColumns({c: _round(c) for c in ("norm_depth", "pct")})


@query(
    f"""WITH {_POSITIONS}, m AS (SELECT contig, p // 50 AS b, sum(fwd) AS f, sum(rev) AS r FROM base WHERE depth > 0 GROUP BY contig, b)
SELECT contig, CAST(50 AS BIGINT) AS width, b AS bin, CAST(f AS BIGINT) AS fwd_bases, CAST(r AS BIGINT) AS rev_bases FROM m
UNION ALL SELECT contig, CAST(500 AS BIGINT), b * 50 // 500 AS bin, CAST(sum(f) AS BIGINT), CAST(sum(r) AS BIGINT) FROM m GROUP BY contig, bin"""
)
def coverage_coarse_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.coarse(coverage.steps(reads(spark, sf_dir)), 50, 500)


@query(
    f"""WITH {_POSITIONS}, {tiles_sql("t", 30, 20)},
j AS (SELECT t.contig, t.lo, t.hi, p, fwd, rev, depth FROM t JOIN base ON t.contig = base.contig AND p >= t.lo AND p < t.hi WHERE depth > 0)
SELECT t.contig, t.lo, t.hi, count(p) AS covered, coalesce(min(p) - t.lo, t.hi - t.lo) AS uncovered_start, coalesce(t.hi - 1 - max(p), t.hi - t.lo) AS uncovered_end,
 round(coalesce(sum(depth), 0) / (t.hi - t.lo), 6) AS mean_depth, CAST(coalesce(sum(fwd), 0) AS BIGINT) AS fwd, CAST(coalesce(sum(rev), 0) AS BIGINT) AS rev
FROM t LEFT JOIN j USING (contig, lo, hi) GROUP BY t.contig, t.lo, t.hi"""
)
def region_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reads(spark, sf_dir)
    regions = tiles(rows, 30, 20)
    pairs = intervals.overlap_join(coverage.steps(rows).filter("depth > 0"), regions)
    lo, hi = F.greatest("l_lo", "r_lo"), F.least("l_hi", "r_hi")
    found = pairs.groupBy("contig", F.col("r_lo").alias("lo"), F.col("r_hi").alias("hi")).agg(
        F.sum(hi - lo).alias("covered"), F.min(lo).alias("first"), F.max(hi).alias("last"), F.sum((hi - lo) * F.col("l_fwd")).alias("fwd"), F.sum((hi - lo) * F.col("l_rev")).alias("rev")
    )
    size = F.col("hi") - F.col("lo")
    zero = F.lit(0).cast("long")
    return regions.join(found, ["contig", "lo", "hi"], "left").select(
        "contig",
        "lo",
        "hi",
        F.coalesce("covered", zero).alias("covered"),
        F.coalesce(F.col("first") - F.col("lo"), size).alias("uncovered_start"),
        F.coalesce(F.col("hi") - F.col("last"), size).alias("uncovered_end"),
        _round(F.coalesce(F.col("fwd") + F.col("rev"), zero) / size).alias("mean_depth"),
        F.coalesce("fwd", zero).alias("fwd"),
        F.coalesce("rev", zero).alias("rev"),
    )


@query(
    f"""WITH {READS_SQL}, {tiles_sql("a", 30, 20)}, {tiles_sql("b", 45, 40)}, t AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT t.contig, t.lo, t.hi, count(*) AS starts FROM t JOIN reads r ON t.contig = r.contig AND r.lo >= t.lo AND r.lo < t.hi GROUP BY t.contig, t.lo, t.hi"""
)
def region_point_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reads(spark, sf_dir)
    regions = tiles(rows, 30, 20).union(tiles(rows, 45, 40))
    points = rows.groupBy("contig", "lo").count().withColumn("hi", F.col("lo") + 1)
    pairs = intervals.overlap_join(points, regions)
    return pairs.groupBy("contig", F.col("r_lo").alias("lo"), F.col("r_hi").alias("hi")).agg(F.sum("l_count").alias("starts"))


_NEAR = 5
_BEST_SQL = f"""{READS_SQL}, {tiles_sql("t", 45, 40)},
d AS (SELECT contig, lo, hi, forward, count(*) AS n FROM reads WHERE hi > lo GROUP BY ALL),
p AS (SELECT d.contig, d.lo, d.hi, forward, n, t.lo AS rlo, t.hi AS rhi, least(d.hi, t.hi) - greatest(d.lo, t.lo) AS overlap,
 CASE WHEN forward THEN abs(d.lo - t.lo) ELSE abs(d.hi - t.hi) END AS d5, CASE WHEN forward THEN abs(d.hi - t.hi) ELSE abs(d.lo - t.lo) END AS d3
 FROM d JOIN t ON d.contig = t.contig AND d.lo < t.hi AND t.lo < d.hi),
b AS (SELECT *, row_number() OVER (PARTITION BY contig, lo, hi, forward ORDER BY CASE WHEN d5 <= {_NEAR} AND d3 <= {_NEAR} THEN 2 WHEN d5 <= {_NEAR} THEN 1 ELSE 0 END DESC, d5, overlap DESC, rlo) AS k FROM p)"""


def _matched(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All pairs of distinct reads and overlapping regions, and the best region of each read."""
    distinct = rows.filter("hi > lo").groupBy("contig", "lo", "hi", "forward").agg(F.count("*").alias("n"))
    pairs = intervals.overlap_join(distinct, tiles(rows, 45, 40))
    d_lo, d_hi = F.abs(F.col("l_lo") - F.col("r_lo")), F.abs(F.col("l_hi") - F.col("r_hi"))
    pairs = pairs.withColumns(
        {
            "overlap": F.least("l_hi", "r_hi") - F.greatest("l_lo", "r_lo"),
            "d5": F.when(F.col("l_forward"), d_lo).otherwise(d_hi),
            "d3": F.when(F.col("l_forward"), d_hi).otherwise(d_lo),
        }
    )
    pairs = pairs.withColumn("category", F.when((F.col("d5") <= _NEAR) & (F.col("d3") <= _NEAR), 2).when(F.col("d5") <= _NEAR, 1).otherwise(0))
    best = intervals.best_match(pairs, ["contig", "l_lo", "l_hi", "l_forward"], [F.desc("category"), F.asc("d5"), F.desc("overlap"), F.asc("r_lo")])
    return pairs, best


@query(
    f"""WITH {_BEST_SQL}
SELECT contig, rlo AS lo, rhi AS hi, CAST(sum(n) AS BIGINT) AS overlaps, CAST(coalesce(sum(n) FILTER (k = 1), 0) AS BIGINT) AS total,
 CAST(coalesce(sum(n) FILTER (k = 1 AND forward), 0) AS BIGINT) AS fwd, CAST(coalesce(sum(n) FILTER (k = 1 AND NOT forward), 0) AS BIGINT) AS rev,
 CAST(coalesce(sum(n) FILTER (k = 1 AND forward AND d5 <= {_NEAR} AND d3 <= {_NEAR}), 0) AS BIGINT) AS fwd_e2e,
 CAST(coalesce(sum(n) FILTER (k = 1 AND NOT forward AND d5 <= {_NEAR} AND d3 <= {_NEAR}), 0) AS BIGINT) AS rev_e2e
FROM b GROUP BY contig, rlo, rhi"""
)
def amplicon_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _amplicons(spark, sf_dir)


def _amplicons(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, best = _matched(reads(spark, sf_dir))
    region = ["contig", "r_lo", "r_hi"]
    overlaps = pairs.groupBy(*region).agg(F.sum("l_n").alias("overlaps"))

    def some(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("l_n")).otherwise(0))

    f, e2e = F.col("l_forward"), F.col("category") == 2
    counts = best.groupBy(*region).agg(F.sum("l_n").alias("total"), some(f).alias("fwd"), some(~f).alias("rev"), some(f & e2e).alias("fwd_e2e"), some(~f & e2e).alias("rev_e2e"))
    out = overlaps.join(counts, region, "left")
    return out.select("contig", F.col("r_lo").alias("lo"), F.col("r_hi").alias("hi"), "overlaps", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "fwd", "rev", "fwd_e2e", "rev_e2e")))


_AMPLICON_SQL = f"""{_BEST_SQL}, amp AS (SELECT contig, rlo AS lo, rhi AS hi, coalesce(sum(n) FILTER (k = 1), 0) AS total, coalesce(sum(n) FILTER (k = 1 AND forward), 0) AS fwd,
 coalesce(sum(n) FILTER (k = 1 AND NOT forward), 0) AS rev, coalesce(sum(n) FILTER (k = 1 AND d5 <= {_NEAR} AND d3 <= {_NEAR}), 0) AS e2e FROM b GROUP BY contig, rlo, rhi)"""


@query(
    f"""WITH {_AMPLICON_SQL}
SELECT contig, count(*) AS targets, CAST(sum(total) AS BIGINT) AS reads, round(avg(total), 6) AS mean_reads, round(stddev_samp(total), 6) AS sd_reads,
 round(100.0 * count(*) FILTER (total >= 1) / count(*), 6) AS pct_1, round(100.0 * count(*) FILTER (total >= 20) / count(*), 6) AS pct_20,
 round(100.0 * count(*) FILTER (total >= 100) / count(*), 6) AS pct_100, round(100.0 * count(*) FILTER (total >= 500) / count(*), 6) AS pct_500,
 round(100.0 * count(*) FILTER (total < 10 OR greatest(fwd, rev) <= 0.7 * total) / count(*), 6) AS pct_no_bias, round(100.0 * sum(e2e) / sum(total), 6) AS pct_e2e
FROM amp GROUP BY contig"""
)
def target_read_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _amplicons(spark, sf_dir)
    total, n = F.col("total"), F.count("*")
    return x.groupBy("contig").agg(
        n.alias("targets"),
        F.sum("total").alias("reads"),
        _round(F.avg("total")).alias("mean_reads"),
        _round(F.stddev_samp("total")).alias("sd_reads"),
        *(_round(100.0 * F.count_if(total >= k) / n).alias(f"pct_{k}") for k in (1, 20, 100, 500)),
        _round(100.0 * F.count_if((total < 10) | (F.greatest("fwd", "rev") <= 0.7 * total)) / n).alias("pct_no_bias"),
        _round(100.0 * F.sum(F.col("fwd_e2e") + F.col("rev_e2e")) / F.sum("total")).alias("pct_e2e"),
    )


@query(
    f"""WITH {_AMPLICON_SQL} SELECT contig, count(*) AS targets, """
    + ", ".join(f"count(*) FILTER (total >= {10**k}) AS at_{10**k}" for k in range(6))
    + " FROM amp GROUP BY contig"
)
def read_count_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _amplicons(spark, sf_dir)
    return x.groupBy("contig").agg(F.count("*").alias("targets"), *(F.count_if(F.col("total") >= 10**k).alias(f"at_{10**k}") for k in range(6)))


@query(
    f"""WITH {_POSITIONS} SELECT contig, count(*) FILTER (depth >= 10) AS deep, count(*) FILTER (depth >= 10 AND greatest(fwd, rev) > 0.55 * depth) AS biased,
 round(count(*) FILTER (depth >= 10 AND greatest(fwd, rev) > 0.55 * depth) / count(*) FILTER (depth >= 10), 6) AS rate FROM base GROUP BY contig"""
)
def strand_bias_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    width = F.col("hi") - F.col("lo")
    deep = F.col("depth") >= 10
    x = coverage.steps(reads(spark, sf_dir)).groupBy("contig").agg(F.sum(F.when(deep, width).otherwise(0)).alias("deep"), F.sum(F.when(deep & (F.greatest("fwd", "rev") > 0.55 * F.col("depth")), width).otherwise(0)).alias("biased"))
    return x.withColumn("rate", _round(F.try_divide("biased", "deep")))


@query(
    f"""WITH {READS_SQL}, {tiles_sql("a", 30, 20)}, {tiles_sql("b", 45, 40)}, {tiles_sql("c", 500, 500)}, t AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c),
d AS (SELECT contig, lo AS p, count(*) AS n FROM reads GROUP BY contig, lo),
k AS (SELECT d.contig, p, n, t.lo, t.hi, row_number() OVER (PARTITION BY d.contig, p ORDER BY t.hi - t.lo, least(p - t.lo, t.hi - 1 - p), p - t.lo, t.lo) AS k FROM d JOIN t ON d.contig = t.contig AND p >= t.lo AND p < t.hi)
SELECT contig, lo, hi, CAST(sum(n) AS BIGINT) AS points FROM k WHERE k = 1 GROUP BY contig, lo, hi"""
)
def smallest_enclosing_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reads(spark, sf_dir)
    regions = tiles(rows, 30, 20).union(tiles(rows, 45, 40)).union(tiles(rows, 500, 500))
    points = rows.groupBy("contig", "lo").agg(F.count("*").alias("n")).withColumn("hi", F.col("lo") + 1)
    pairs = intervals.overlap_join(points, regions)
    left, right = F.col("l_lo") - F.col("r_lo"), F.col("r_hi") - 1 - F.col("l_lo")
    best = intervals.best_match(pairs, ["contig", "l_lo"], [F.asc(F.col("r_hi") - F.col("r_lo")), F.asc(F.least(left, right)), F.asc(left), F.asc("r_lo")])
    return best.groupBy("contig", F.col("r_lo").alias("lo"), F.col("r_hi").alias("hi")).agg(F.sum("l_n").alias("points"))


#: Ranges are distinct, so that both windows over them have one order.
_UNION_SQL = """r AS (SELECT DISTINCT l_returnflag || ':' || l_suppkey AS contig, s AS lo, s + 1 + CAST(l_quantity AS BIGINT) // 5 AS hi FROM (SELECT *, date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS s FROM lineitem)),
m AS (SELECT contig, lo, hi, max(hi) OVER (PARTITION BY contig ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r),
g AS (SELECT *, count(*) FILTER (before IS NULL OR lo > before) OVER (PARTITION BY contig ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island FROM m),
u AS (SELECT contig, min(lo) AS lo, max(hi) AS hi FROM g GROUP BY contig, island)"""


@query(f"WITH {_UNION_SQL} SELECT contig, lo, hi FROM u")
def interval_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.union(sparse_reads(spark, sf_dir))


@query(f"WITH {_UNION_SQL} SELECT contig, hi AS lo, nxt AS hi FROM (SELECT *, lead(lo) OVER (PARTITION BY contig ORDER BY lo) AS nxt FROM u) WHERE nxt IS NOT NULL")
def interval_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.gaps(sparse_reads(spark, sf_dir))


@query(
    """WITH s AS (SELECT contig, lo, hi, count(*) FILTER (hi - lo < 5) AS short, count(*) AS n FROM (SELECT l_returnflag AS contig, 0 AS lo, CAST(l_quantity AS BIGINT) AS hi FROM lineitem) GROUP BY ALL)
SELECT contig, CAST(sum(n) AS BIGINT) AS reads, CAST(sum(n * (hi - lo)) AS BIGINT) AS bases, CAST(sum(short) AS BIGINT) AS short_reads FROM s GROUP BY contig"""
)
def contig_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("contig"))
    size = F.col("l_quantity").cast("long")
    return x.agg(F.count("*").alias("reads"), F.sum(size).alias("bases"), F.count_if(size < 5).alias("short_reads"))
