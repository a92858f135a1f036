"""Queries that report: named aggregates, broken rules, sums, ratios, blocks, consensus, times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators import reports, variants
from granary.plans.catalog import query
from granary.sources.tables import READS_SQL, load, reads


@query(
    f"""WITH {READS_SQL} SELECT contig, count(*) AS counts, CAST(max(hi) - min(lo) AS BIGINT) AS length, count(DISTINCT lo) AS start_sites,
 round(stddev_pop(hi - lo) / avg(hi - lo), 6) AS length_cv, max(hi - lo) AS longest, min(hi - lo) AS shortest FROM reads GROUP BY contig"""
)
def contig_processors(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("hi") - F.col("lo")
    listed = [
        ("counts", F.count("*")),
        ("length", F.max("hi") - F.min("lo")),
        ("start_sites", F.count_distinct("lo")),
        ("length_cv", F.round(F.stddev_pop(size) / F.avg(size), 6)),
        ("longest", F.max(size)),
        ("shortest", F.min(size)),
    ]
    return reports.processed(reads(spark, sf_dir), ["contig"], listed)


@query(
    """SELECT o_orderkey, unnest(list_filter([CASE WHEN NOT coalesce(o_totalprice >= 1000, FALSE) THEN 'price' END, CASE WHEN NOT coalesce(o_orderstatus IN ('F', 'O'), FALSE) THEN 'status' END,
 CASE WHEN NOT coalesce(o_orderpriority LIKE '_-%', FALSE) THEN 'priority' END], lambda x: x IS NOT NULL)) AS rule FROM orders"""
)
def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"price": F.col("o_totalprice") >= 1000, "status": F.col("o_orderstatus").isin("F", "O"), "priority": F.col("o_orderpriority").like("_-%")}
    return reports.violations(load(spark, sf_dir, "orders"), ["o_orderkey"], rules)


@query("SELECT l_suppkey, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY l_suppkey")
def row_sum_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports by supplier of each flag, added up."""
    x = load(spark, sf_dir, "lineitem")
    each = [x.filter(F.col("l_returnflag") == f).groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")) for f in ("A", "N", "R")]
    return reports.added(each, "l_suppkey")


@query("WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) SELECT a.l_suppkey, a.l_returnflag, a.n, round(a.n / b.n, 6) AS ratio FROM c a LEFT JOIN c b ON a.l_suppkey = b.l_suppkey AND b.l_returnflag = 'A'")
def control_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.control_ratios(load(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_returnflag", "A").withColumn("ratio", F.round("ratio", 6))


@query(
    """WITH e AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(len(embedding))) AS i FROM embeddings)
SELECT label, CAST(CASE WHEN i < 24 THEN i // 12 ELSE 2 + (i - 24) // 8 END AS INTEGER) AS block, count(*) AS n, round(avg(v), 6) AS mean FROM e GROUP BY label, block"""
)
def flow_block_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "v")).withColumn("v", F.col("v").cast("double"))
    top = x.agg(F.max("i")).first()[0]
    blocks = reports.flow_blocks("0:12,24:8", 0 if top is None else int(top) + 1)
    return x.groupBy("label", reports.block_of(F.col("i"), blocks).alias("block")).agg(F.count("*").alias("n"), F.round(F.avg("v"), 6).alias("mean"))


_READ = "translate(CAST(10000 + l_partkey AS VARCHAR), '0123456789', 'ACGTACGTAC')"


@query(
    f"""WITH r AS (SELECT l_suppkey, l_linenumber, {_READ} AS s FROM lineitem), b AS (SELECT l_suppkey, l_linenumber, unnest(string_split(s, '')) AS base, unnest(range(length(s))) AS place FROM r),
v AS (SELECT l_suppkey, l_linenumber, place, base, count(*) AS n FROM b GROUP BY ALL), m AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_linenumber, place ORDER BY n DESC, base) AS k FROM v),
c AS (SELECT l_suppkey, l_linenumber, string_agg(base, '' ORDER BY place) AS bases FROM m WHERE k = 1 GROUP BY ALL), n AS (SELECT l_suppkey, l_linenumber, count(*) AS reads FROM r GROUP BY ALL HAVING count(*) >= 3)
SELECT l_suppkey, l_linenumber, bases, reads FROM c JOIN n USING (l_suppkey, l_linenumber)"""
)
def consensus_by_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", F.translate((F.lit(10000) + F.col("l_partkey")).cast("string"), "0123456789", "ACGTACGTAC").alias("s"))
    return reports.consensus(x, ["l_suppkey", "l_linenumber"], "s", 3)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '2000-01-01' ELSE date_trunc('second', CAST(o_orderdate AS TIMESTAMP)) END AS time FROM orders")
def log_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times read back from texts of two forms; where a text has neither, a given time."""
    t = F.col("o_orderdate").cast("timestamp")
    said = F.when(F.col("o_orderkey") % 5 == 0, F.lit("no time")).when(F.col("o_orderkey") % 2 == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(t, "dd.MM.yyyy HH.mm.ss"))
    x = load(spark, sf_dir, "orders").select("o_orderkey", said.alias("said"))
    time = reports.parsed_time(F.col("said"), ["yyyy-MM-dd HH:mm:ss", "dd.MM.yyyy HH.mm.ss"], F.lit("2000-01-01 00:00:00").cast("timestamp"))
    return x.select("o_orderkey", time.cast("timestamp_ntz").alias("time"))


def _allele_sql(kind: str, size: str) -> str:
    return f"CASE {kind} % 3 WHEN 0 THEN ['A', CASE WHEN {size} % 2 = 0 THEN 'C' ELSE 'G' END] WHEN 1 THEN ['A', 'A' || repeat('T', CAST(1 + {size} % 2 AS INTEGER))] ELSE ['A' || repeat('T', CAST(1 + {size} % 2 AS INTEGER)), 'A'] END"


def _allele(kind: F.Column, size: F.Column) -> tuple[F.Column, F.Column]:
    more = F.concat(F.lit("A"), F.repeat(F.lit("T"), (1 + size % 2).cast("int")))
    return F.when(kind % 3 == 2, more).otherwise("A"), F.when(kind % 3 == 0, F.when(size % 2 == 0, "C").otherwise("G")).when(kind % 3 == 1, more).otherwise("A")


@query(
    f"""WITH c AS (SELECT l_partkey * 10 AS pos, {_allele_sql("l_linenumber", "l_suppkey")} AS a FROM lineitem), h AS (SELECT p_partkey * 10 AS pos, {_allele_sql("p_size", "p_partkey")} AS a, p_brand AS hint FROM part)
SELECT c.pos, c.a[1] AS ref, c.a[2] AS alt, hint, count(*) AS n FROM c LEFT JOIN h ON c.pos = h.pos AND c.a = h.a GROUP BY ALL"""
)
def hints_by_normal_allele(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the calls are written with bases around the change; the hints are found all the same."""
    ref, alt = _allele(F.col("l_linenumber"), F.col("l_suppkey"))
    wide = F.col("l_quantity").cast("long") % 2 == 0

    def written(allele: F.Column) -> F.Column:
        return F.when(wide, F.concat(F.lit("GC"), allele, F.lit("GA"))).otherwise(allele)

    calls = load(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 10 - F.when(wide, 2).otherwise(0)).alias("pos"), written(ref).alias("ref"), written(alt).alias("alt"))
    ref, alt = _allele(F.col("p_size"), F.col("p_partkey"))
    hints = load(spark, sf_dir, "part").select((F.col("p_partkey") * 10).alias("pos"), ref.alias("ref"), alt.alias("alt"), F.col("p_brand").alias("hint"))
    return variants.annotated(calls, hints, []).groupBy("pos", "ref", "alt", "hint").agg(F.count("*").alias("n"))
