"""Queries on filters, metrics, duplicates, variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators import dedup, filters, metrics, variants
from granary.operators.prefix import ranked
from granary.plans.catalog import query
from granary.sources.tables import READS_SQL, load, reads


def _r(c, n: int = 6):
    return F.round(c, n)


_RULES = ("key", "flow < 3"), ("short", "hi - lo < 8"), ("adapter", "has_adapter AND flow < 20"), ("polyclonal", "adapter = 7"), ("quality", "(lo * 7 + flow) % 11 = 0")
_REASON = "CASE " + " ".join(f"WHEN {p} THEN '{n}'" for n, p in _RULES) + " ELSE 'passed' END"


def _rules() -> dict:
    return {n: F.expr(p) for n, p in _RULES}


@query(f"WITH {READS_SQL} SELECT {_REASON} AS reason, forward, count(*) AS reads, CAST(sum(hi - lo) AS BIGINT) AS bases FROM reads GROUP BY reason, forward")
def first_fail_filter_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = reads(spark, sf_dir).withColumn("reason", filters.first_fail(_rules()))
    return x.groupBy("reason", "forward").agg(F.count("*").alias("reads"), F.sum(F.col("hi") - F.col("lo")).alias("bases"))


@query(
    f"""WITH {READS_SQL}, r AS (SELECT {_REASON} AS reason, hi - lo AS b FROM reads),
s AS (SELECT * FROM (VALUES {", ".join(f"({k}, '{n}')" for k, (n, _) in enumerate(_RULES))}) AS v(stage, reason)),
c AS (SELECT s.stage, s.reason, count(b) AS reads, coalesce(sum(b), 0) AS bases FROM s LEFT JOIN r USING (reason) GROUP BY s.stage, s.reason)
SELECT CAST(stage AS INTEGER) AS stage, reason, reads, CAST(bases AS BIGINT) AS bases, CAST((SELECT count(*) FROM r) - sum(reads) OVER (ORDER BY stage) AS BIGINT) AS reads_left,
 CAST((SELECT sum(b) FROM r) - sum(bases) OVER (ORDER BY stage) AS BIGINT) AS bases_left FROM c"""
)
def filter_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.accounts(reads(spark, sf_dir), _rules(), F.col("hi") - F.col("lo"))


_MASK = "(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END + CASE WHEN l_returnflag = 'R' THEN 2 ELSE 0 END + CASE WHEN l_linestatus = 'F' THEN 4 ELSE 0 END + CASE WHEN l_discount > 0.05 THEN 8 ELSE 0 END + CASE WHEN l_tax > 0.04 THEN 16 ELSE 0 END)"


@query(
    f"""WITH m AS (SELECT {_MASK} AS m, CAST(l_quantity AS BIGINT) // 10 AS cell FROM lineitem)
SELECT cell, {", ".join(f"count(*) FILTER (m & {1 << k} <> 0) AS bit{k}" for k in range(5))}, count(*) FILTER (m & 12 <> 0) AS any_12, count(*) FILTER (m & 12 = 12) AS all_12, count(*) FILTER (m = 12) AS only_12, CAST(bit_or(m) AS BIGINT) AS seen FROM m GROUP BY cell"""
)
def mask_bit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").select(F.expr(_MASK).alias("m"), F.floor(F.col("l_quantity") / 10).cast("long").alias("cell"))
    m = F.col("m")
    return x.groupBy("cell").agg(
        *(F.count_if(filters.mask_any(m, 1 << k)).alias(f"bit{k}") for k in range(5)),
        F.count_if(filters.mask_any(m, 12)).alias("any_12"),
        F.count_if(filters.mask_all(m, 12)).alias("all_12"),
        F.count_if(filters.mask_only(m, 12)).alias("only_12"),
        F.bit_or("m").cast("long").alias("seen"),
    )


@query(
    """SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders WHERE lower(o_orderpriority) LIKE '%high%' AND o_totalprice >= 400000 AND o_orderstatus IN ('F', 'O')
AND o_orderdate < TIMESTAMP '1998-01-01' AND NOT regexp_matches(CAST(o_custkey AS VARCHAR), '7$')"""
)
def orm_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "orders").withColumn("cust", F.col("o_custkey").cast("string"))
    keep = filters.lookup(o_orderpriority__icontains="HIGH", o_totalprice__gte=400000, o_orderstatus__in=("F", "O")) & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp"))
    return x.filter(keep & ~filters.lookup(cust__iregex="7$")).select("o_orderkey", "o_orderpriority", "o_orderstatus")


_QUALITY = "[CAST(floor(abs(CAST(x AS DOUBLE)) * 100) AS INTEGER) for x in embedding]"


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 100).cast("int")).alias("q"))


@query(
    f"""WITH e AS (SELECT vec_id, {_QUALITY} AS q FROM embeddings), w AS (SELECT *, greatest(1, len(q) // 10) AS w FROM e),
p AS (SELECT vec_id, q, w, unnest(range(len(q))) AS k FROM w)
SELECT w.vec_id, CAST(coalesce(max(k) FILTER (list_sum(p.q[k + 1 : k + p.w]) // len(p.q[k + 1 : k + p.w]) >= 8), 0) AS INTEGER) AS trimmed FROM w LEFT JOIN p USING (vec_id) GROUP BY w.vec_id"""
)
def windowed_quality_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality(spark, sf_dir).select("vec_id", filters.trimmed_length(F.col("q"), 8).cast("int").alias("trimmed"))


@query(
    """WITH r AS (SELECT o_totalprice AS v, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS k, count(*) OVER () AS n FROM orders),
b AS (SELECT v, (k - floor(n * 0.05)) AS p, floor(n * 0.95) - floor(n * 0.05) AS c FROM r WHERE k >= floor(n * 0.05) AND k < floor(n * 0.95))
SELECT CAST(floor(p * 20 / c) AS BIGINT) AS bin, count(*) AS n, round(min(v), 6) AS low, round(max(v), 6) AS high, round(avg(v), 4) AS mean FROM b GROUP BY bin"""
)
def clip_and_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    x = ranked(x, [], "o_totalprice", metrics.even_chunks(x, "o_totalprice"), ["o_orderkey"])
    n = load(spark, sf_dir, "orders").count()
    y = filters.clip_and_bin(x, "rank", F.lit(n), 0.05, 0.95, 20)
    v = "o_totalprice"
    return y.groupBy("bin").agg(F.count("*").alias("n"), _r(F.min(v)).alias("low"), _r(F.max(v)).alias("high"), _r(F.avg(v), 4).alias("mean"))


@query("SELECT least(n_chars // 100, 49) AS bin, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS total, max(n_chars) AS longest, CAST(sum(n_chars) // count(*) AS BIGINT) AS mean FROM documents GROUP BY bin")
def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "documents")
    bins = metrics.clamped_histogram(x, F.col("n_chars"), 50, 100)
    longest = x.groupBy(F.least(F.floor(F.col("n_chars") / 100), F.lit(49)).cast("long").alias("bin")).agg(F.max("n_chars").alias("longest"))
    return bins.join(longest, "bin").withColumn("mean", F.floor(F.col("total") / F.col("n")).cast("long"))


@query(f"WITH q AS (SELECT unnest({_QUALITY}) AS q FROM embeddings) SELECT CAST(least(q, 63) AS BIGINT) AS bin, count(*) AS n, CAST(sum(q) AS BIGINT) AS total FROM q GROUP BY bin")
def qv_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.clamped_histogram(_quality(spark, sf_dir).select(F.explode("q").alias("q")), F.col("q"), 64)


@query(
    f"""WITH e AS (SELECT vec_id, {_QUALITY} AS q FROM embeddings), p AS (SELECT vec_id, q, unnest(range(1, len(q) + 1)) AS i FROM e), s AS (SELECT vec_id, i, list_sum(q[1:i]) AS s FROM p)
SELECT vec_id, {", ".join(f"CAST(coalesce(max(i) FILTER (s <= {k} * i), 0) AS INTEGER) AS len_{k}" for k in (7, 9, 11))} FROM s GROUP BY vec_id"""
)
def length_at_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality(spark, sf_dir).select("vec_id", *(metrics.prefix_length(F.col("q"), F.lit(k)).alias(f"len_{k}") for k in (7, 9, 11)))


@query(
    """WITH g AS (SELECT l_returnflag AS contig, l_linenumber AS k, avg(l_extendedprice) FILTER (l_linestatus = 'O') - avg(l_extendedprice) FILTER (l_linestatus = 'F') AS gap,
 (stddev_pop(l_extendedprice) FILTER (l_linestatus = 'O') + stddev_pop(l_extendedprice) FILTER (l_linestatus = 'F')) / 2 AS spread FROM lineitem GROUP BY ALL)
SELECT contig, round(avg(gap / spread), 6) AS snr, count(*) AS keys FROM g GROUP BY contig"""
)
def snr_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").withColumn("contig", F.col("l_returnflag"))
    out = metrics.snr(x, ["contig"], "l_linenumber", F.col("l_linestatus") == "F", F.col("l_linestatus") == "O", "l_extendedprice")
    return out.withColumn("snr", _r("snr"))


@query(
    """SELECT l_returnflag AS contig, count(*) AS n, count(*) FILTER (abs(l_discount - l_tax) > 0.0200001) AS different, round(max(abs(l_discount - l_tax)), 6) AS max_difference, round(corr(l_discount, l_tax), 6) AS correlation
FROM lineitem GROUP BY contig"""
)
def numeric_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").withColumn("contig", F.col("l_returnflag"))
    out = metrics.compare(x, ["contig"], "l_discount", "l_tax", 0.0200001)
    return out.withColumns({c: _r(c) for c in ("max_difference", "correlation")})


@query(
    """SELECT l_linenumber AS adapter, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(quantile_cont(l_extendedprice, 0.5), 4) AS q50, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75,
 round((quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)) / 1.35, 4) AS sigma FROM lineitem GROUP BY adapter"""
)
def iqr_sd(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = metrics.quantiles(load(spark, sf_dir, "lineitem").withColumn("adapter", F.col("l_linenumber")), ["adapter"], "l_extendedprice", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return x.select("adapter", *(_r(c, 4).alias(c) for c in ("q25", "q50", "q75")), _r((F.col("q75") - F.col("q25")) / metrics.IQR_SIGMA, 4).alias("sigma"))


@query(
    """WITH q AS (SELECT l_linenumber AS adapter, quantile_cont(l_quantity, 0.1) AS a, quantile_cont(l_quantity, 0.9) AS b FROM lineitem GROUP BY adapter)
SELECT adapter, count(*) AS n, round(avg(l_extendedprice), 4) AS mean FROM lineitem JOIN q ON adapter = l_linenumber WHERE l_quantity BETWEEN a AND b GROUP BY adapter"""
)
def trimmed_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").withColumn("adapter", F.col("l_linenumber"))
    q = metrics.quantiles(x, ["adapter"], "l_quantity", {"a": 0.1, "b": 0.9})
    return x.join(q, "adapter").filter(F.col("l_quantity").between(F.col("a"), F.col("b"))).groupBy("adapter").agg(F.count("*").alias("n"), _r(F.avg("l_extendedprice"), 4).alias("mean"))


@query(
    """SELECT l_returnflag AS contig, count(*) AS n, round(regr_slope(log2(l_extendedprice + 1), log2(l_quantity)), 6) AS slope, round(regr_intercept(log2(l_extendedprice + 1), log2(l_quantity)), 6) AS intercept,
 round(regr_r2(log2(l_extendedprice + 1), log2(l_quantity)), 6) AS r2 FROM lineitem GROUP BY contig"""
)
def dose_response_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    y, x = F.log2(F.col("l_extendedprice") + 1), F.log2("l_quantity")
    return load(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("contig")).agg(F.count("*").alias("n"), _r(F.regr_slope(y, x)).alias("slope"), _r(F.regr_intercept(y, x)).alias("intercept"), _r(F.regr_r2(y, x)).alias("r2"))


@query("SELECT l_returnflag AS contig, count(*) AS n, round(avg(l_quantity), 6) AS mean, round(var_pop(l_quantity), 6) AS var_pop FROM lineitem GROUP BY contig")
def partial_then_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("contig"), F.year("l_shipdate").alias("block"), "l_quantity")
    out = metrics.merged(metrics.moments(x, ["contig", "block"], "l_quantity"), ["contig"])
    return out.withColumns({c: _r(c) for c in ("mean", "var_pop")})


@query("SELECT event_id, event_type FROM events ORDER BY md5(CAST(event_id AS VARCHAR) || ':11') LIMIT 100")
def reservoir_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.sample(load(spark, sf_dir, "events").select("event_id", "event_type"), F.col("event_id"), 100, 11)


@query(
    """WITH h AS (SELECT source, least(n_chars // 10, 5000) AS bin, count(*) AS n FROM documents GROUP BY ALL), c AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY bin) AS c, sum(n) OVER (PARTITION BY source) AS t FROM h),
m AS (SELECT source, min(bin) FILTER (c >= 0.5 * t) AS median FROM c GROUP BY source), o AS (SELECT source, bin AS mode FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, bin) AS k FROM h) WHERE k = 1)
SELECT source, median, mode, n50, n100, n150 FROM m JOIN o USING (source) JOIN (SELECT source, count(*) FILTER (n_chars >= 50) AS n50, count(*) FILTER (n_chars >= 100) AS n100, count(*) FILTER (n_chars >= 150) AS n150 FROM documents GROUP BY source) USING (source)"""
)
def read_quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "documents")
    h = x.groupBy("source", F.least(F.floor(F.col("n_chars") / 10), F.lit(5000)).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    median = metrics.histogram_quantile(h, ["source"], "bin", "n", 0.5).withColumnRenamed("bin", "median")
    mode = h.groupBy("source").agg(F.min_by("bin", F.struct(-F.col("n"), F.col("bin"))).alias("mode"))
    counts = x.groupBy("source").agg(*(F.count_if(F.col("n_chars") >= k).alias(f"n{k}") for k in (50, 100, 150)))
    return median.join(mode, "source").join(counts, "source")


@query("SELECT CAST(least(l_linenumber, 7) AS BIGINT) AS hp, count(*) FILTER (l_linestatus = 'F') AS numer, count(*) AS denom, round(100.0 * count(*) FILTER (l_linestatus = 'F') / count(*), 6) AS accuracy FROM lineitem GROUP BY hp")
def homopolymer_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = F.count_if(F.col("l_linestatus") == "F")
    return load(spark, sf_dir, "lineitem").groupBy(F.least("l_linenumber", F.lit(7)).cast("long").alias("hp")).agg(good.alias("numer"), F.count("*").alias("denom"), _r(100.0 * good / F.count("*")).alias("accuracy"))


@query(
    f"""WITH e AS (SELECT label, {_QUALITY} AS q FROM embeddings), p AS (SELECT label, unnest(q) AS q, unnest(range(len(q))) AS pos FROM e)
SELECT label, pos, count(*) AS depth, count(*) FILTER (q >= 20) AS errors FROM p GROUP BY label, pos"""
)
def error_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _quality(spark, sf_dir).select("label", F.posexplode("q").alias("pos", "q"))
    return x.groupBy("label", F.col("pos").cast("long").alias("pos")).agg(F.count("*").alias("depth"), F.count_if(F.col("q") >= 20).alias("errors"))


_DUP_SQL = f"""{READS_SQL}, k AS (SELECT *, CASE WHEN forward THEN lo ELSE hi END AS anchor FROM reads),
w AS (SELECT *, row_number() OVER o AS n, min(CASE WHEN has_adapter THEN flow END) OVER (PARTITION BY contig, adapter, forward, anchor ORDER BY flow DESC, has_adapter DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS least_flow
 FROM k WINDOW o AS (PARTITION BY contig, adapter, forward, anchor ORDER BY flow DESC, has_adapter DESC)),
d AS (SELECT *, n > 1 AND NOT (has_adapter AND (least_flow IS NULL OR flow < least_flow)) AS duplicate FROM w)"""


@query(f"WITH {_DUP_SQL} SELECT contig, lo, hi, forward, adapter, has_adapter, count(*) AS reads, count(*) FILTER (duplicate) AS duplicates FROM d GROUP BY ALL")
def mark_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = dedup.duplicate_counts(reads(spark, sf_dir))
    return x.groupBy("contig", "lo", "hi", "forward", "adapter", "has_adapter").agg(F.sum("reads").alias("reads"), F.sum("duplicates").alias("duplicates"))


@query(f"WITH {_DUP_SQL} SELECT adapter, count(*) AS reads, count(*) FILTER (duplicate) AS duplicates, round(100.0 * count(*) FILTER (duplicate) / count(*), 6) AS pct FROM d GROUP BY adapter")
def duplicate_stats_by_adapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = dedup.duplicate_counts(reads(spark, sf_dir)).groupBy("adapter").agg(F.sum("reads").alias("reads"), F.sum("duplicates").alias("duplicates"))
    return x.withColumn("pct", _r(100.0 * F.col("duplicates") / F.col("reads")))


@query("SELECT sha256(text) AS digest, count(*) AS copies, min(doc_id) AS first FROM documents GROUP BY text HAVING count(*) > 1")
def exact_doc_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact(load(spark, sf_dir, "documents"), F.col("text"), "doc_id").filter("copies > 1")


@query(
    """WITH v AS (SELECT l_partkey, l_returnflag, l_shipdate AS value, count(*) AS votes FROM (SELECT l_partkey, l_returnflag, CAST(l_quantity AS BIGINT) // 10 AS l_shipdate FROM lineitem) GROUP BY ALL)
SELECT l_partkey, l_returnflag, size, value, votes FROM (SELECT *, CAST(sum(votes) OVER (PARTITION BY l_partkey, l_returnflag) AS BIGINT) AS size, row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY votes DESC, value) AS k FROM v) WHERE k = 1 AND size >= 3"""
)
def family_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.majority(load(spark, sf_dir, "lineitem"), ["l_partkey", "l_returnflag"], F.floor(F.col("l_quantity") / 10).cast("long"), "value").filter("size >= 3")


@query("WITH f AS (SELECT l_returnflag AS target, l_partkey, count(*) AS size FROM lineitem GROUP BY ALL) SELECT target, least(size, 20) AS size, count(*) AS families, CAST(sum(size) AS BIGINT) AS reads FROM f GROUP BY target, least(size, 20)".replace("sum(size)", "sum(f.size)"))
def family_size_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = load(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("target"), "l_partkey").agg(F.count("*").alias("n"))
    return f.groupBy("target", F.least("n", F.lit(20)).alias("size")).agg(F.count("*").alias("families"), F.sum("n").alias("reads"))


_ALLELE = "substr('ACGT', CAST(l_linenumber % 4 AS INTEGER) + 1, 1)"
_REF = "substr('ACGT', CAST(l_suppkey % 4 AS INTEGER) + 1, 1)"
ALLELES_SQL = f"""a AS (SELECT l_suppkey AS locus, {_REF} AS ref, {_ALLELE} AS alt, count(*) AS n, count(*) FILTER (l_linestatus = 'F') AS fwd, count(*) FILTER (l_linestatus <> 'F') AS rev FROM lineitem GROUP BY ALL),
c AS (SELECT *, CAST(sum(n) OVER p AS BIGINT) AS depth, n / sum(n) OVER p AS share, sum(fwd) OVER p AS fwd_depth, sum(rev) OVER p AS rev_depth FROM a WINDOW p AS (PARTITION BY locus))"""


def alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    x = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("locus"), F.expr(_REF).alias("ref"), F.expr(_ALLELE).alias("alt"), (F.col("l_linestatus") == "F").alias("forward"))
    counts = variants.allele_counts(x, ["locus", "ref"], "alt", F.col("forward"))
    w = Window.partitionBy("locus", "ref")
    return counts.withColumns({"fwd_depth": F.sum("fwd").over(w), "rev_depth": F.sum("rev").over(w)})


@query(f"WITH {ALLELES_SQL} SELECT locus, ref, alt, n, fwd, rev, depth, round(share, 6) AS share FROM c")
def allele_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alleles(spark, sf_dir).select("locus", "ref", "alt", "n", "fwd", "rev", "depth", _r("share").alias("share"))


@query(f"WITH {ALLELES_SQL} SELECT ref, alt, count(*) AS loci, CAST(sum(n) AS BIGINT) AS reads FROM c WHERE fwd_depth >= 30 AND rev_depth >= 30 AND share > 0.001 AND share < 0.15 AND ref <> alt GROUP BY ref, alt")
def substitution_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spectrum(alleles(spark, sf_dir), "ref", "alt")


_CLASSES = [("snp", 20, 5, 0.7, 0.1), ("mnp", 40, 8, 0.6, 0.2), ("hotspot", 10, 2, 0.9, 0.02)]
_CLASS = "CASE WHEN locus % 10 = 0 THEN 'hotspot' WHEN locus % 3 = 0 THEN 'mnp' WHEN ref = alt THEN 'none' ELSE 'snp' END"


@query(
    f"""WITH {ALLELES_SQL}, t AS (SELECT * FROM (VALUES {", ".join(map(str, _CLASSES))}) AS v(class, min_cov, min_cov_strand, max_bias, min_share)), k AS (SELECT *, {_CLASS} AS class FROM c)
SELECT class, count(*) AS alleles, count(*) FILTER (depth >= min_cov AND least(fwd, rev) >= min_cov_strand AND greatest(fwd, rev) / n <= max_bias AND share >= min_share) AS passed FROM k LEFT JOIN t USING (class) GROUP BY class"""
)
def variant_filter_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = spark.createDataFrame(_CLASSES, "class string, min_cov int, min_cov_strand int, max_bias double, min_share double")
    x = variants.by_class(alleles(spark, sf_dir).withColumn("class", F.expr(_CLASS)), t)
    return x.groupBy("class").agg(F.count("*").alias("alleles"), F.count_if("passes").alias("passed"))


@query(
    """WITH s AS (SELECT l_orderkey AS k, 0 AS source, CAST(max(l_quantity) AS BIGINT) AS v FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_orderkey UNION ALL SELECT l_orderkey, 1, CAST(max(l_quantity) AS BIGINT) FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey
 UNION ALL SELECT o_orderkey, 2, CAST(floor(o_totalprice) AS BIGINT) FROM orders)
SELECT k, CAST(source AS BIGINT) AS source, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY source, v) AS n FROM s) WHERE n = 1"""
)
def priority_union_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem")
    calls = [x.filter(F.col("l_returnflag") == f).groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_quantity").cast("long").alias("v")) for f in "AR"]
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.floor("o_totalprice").cast("long").alias("v"))
    return variants.priority_union([*calls, orders], ["k"], ["v"])


@query(
    f"""WITH {ALLELES_SQL}, h AS (SELECT DISTINCT p_partkey AS locus, substr('ACGT', CAST(p_size % 4 AS INTEGER) + 1, 1) AS alt, p_brand AS hint FROM part)
SELECT c.locus, c.ref, c.alt, c.n, h.hint FROM c LEFT JOIN h ON c.locus = h.locus AND c.alt = h.alt"""
)
def hotspot_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    hints = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("locus"), F.expr("substr('ACGT', CAST(p_size % 4 AS INTEGER) + 1, 1)").alias("alt"), F.col("p_brand").alias("hint")).distinct()
    return alleles(spark, sf_dir).join(hints, ["locus", "alt"], "left").select("locus", "ref", "alt", "n", "hint")
