"""Queries on what is left of reads, variants, wells and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.functions import sequence, trims
from granary.operators import coverage, filters, intervals
from granary.operators.prefix import running_sums
from granary.plans.catalog import query
from granary.sources.tables import READS_SQL, load, reads, tiles, tiles_sql


def _r(c, n: int = 6):
    return F.round(c, n)


@query(
    f"""WITH {READS_SQL}, s AS (SELECT contig, lo, count(*) AS n FROM reads GROUP BY contig, lo)
SELECT contig, CAST(sum(n) AS BIGINT) AS reads, count(*) AS start_sites, round(count(*) / sum(n), 6) AS complexity, round(stddev_pop(n) / avg(n), 6) AS cv, max(n) AS most, min(n) AS least FROM s GROUP BY contig"""
)
def contig_start_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = reads(spark, sf_dir).groupBy("contig", "lo").agg(F.count("*").alias("n"))
    return s.groupBy("contig").agg(F.sum("n").alias("reads"), F.count("*").alias("start_sites"), _r(F.count("*") / F.sum("n")).alias("complexity"), _r(F.stddev_pop("n") / F.avg("n")).alias("cv"), F.max("n").alias("most"), F.min("n").alias("least"))


@query(
    f"""WITH {READS_SQL}, c AS (SELECT contig, unnest(range(lo, hi)) AS p FROM reads), d AS (SELECT contig, p, count(*) AS depth FROM c GROUP BY contig, p)
SELECT contig, p // 100 AS bin, max(depth) AS top FROM d GROUP BY contig, bin"""
)
def binned_max_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = coverage.steps(reads(spark, sf_dir)).filter("depth > 0")
    bins = F.explode(F.sequence(F.floor(F.col("lo") / 100).cast("long"), F.floor((F.col("hi") - 1) / 100).cast("long")))
    return x.select("contig", bins.alias("bin"), "depth").groupBy("contig", "bin").agg(F.max("depth").alias("top"))


@query(
    """WITH a AS (SELECT l_orderkey AS k, count(*) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'A' GROUP BY k), b AS (SELECT l_orderkey AS k, count(*) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY k)
SELECT CASE WHEN a.k IS NULL THEN 'right only' WHEN b.k IS NULL THEN 'left only' WHEN a.n <> b.n THEN 'count' WHEN a.q <> b.q THEN 'quantity' ELSE 'same' END AS verdict, count(*) AS n FROM a FULL JOIN b ON a.k = b.k GROUP BY verdict"""
)
def compare_by_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    a, b = (li.filter(F.col("l_returnflag") == f).groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias(f"n{f}"), F.sum("l_quantity").alias(f"q{f}")) for f in "AR")
    verdict = F.when(F.col("nA").isNull(), "right only").when(F.col("nR").isNull(), "left only").when(F.col("nA") != F.col("nR"), "count").when(F.col("qA") != F.col("qR"), "quantity").otherwise("same")
    return a.join(b, "k", "full").groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query(
    """WITH p AS (SELECT l_orderkey AS k, min(l_shipdate) AS a, max(l_shipdate) AS b FROM lineitem GROUP BY k HAVING count(*) = 2), d AS (SELECT k, date_diff('day', CAST(a AS DATE), CAST(b AS DATE)) AS size FROM p), m AS (SELECT avg(size) AS mean, stddev_pop(size) AS sd FROM d)
SELECT k, size, round(least(abs(size - mean) / sd, 3.0), 6) AS deviations FROM d, m"""
)
def pair_insert_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"), F.datediff(F.max("l_shipdate"), F.min("l_shipdate")).cast("long").alias("size")).filter("n = 2").select("k", "size")
    m = p.agg(F.avg("size").alias("mean"), F.stddev_pop("size").alias("sd")).first()  # one row
    if not m["sd"]:
        return p.withColumn("deviations", F.lit(0.0))
    return p.withColumn("deviations", _r(F.least(F.abs(F.col("size") - m["mean"]) / m["sd"], F.lit(3.0))))


_CODES = ("ACGTAC", "TTGCAA", "GGATCC", "CAGTTG")


@query(
    f"""WITH b AS (SELECT doc_id, substr(regexp_replace(upper(text), '[^ACGT]', '', 'g'), 1, 6) AS s FROM documents), c AS (SELECT unnest({list(_CODES)}) AS code, unnest(range({len(_CODES)})) AS k),
d AS (SELECT doc_id, code, k, hamming(s, code) AS d FROM b, c WHERE length(s) = 6), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY d, k) AS n, lead(d) OVER (PARTITION BY doc_id ORDER BY d, k) AS second FROM d)
SELECT doc_id, CASE WHEN d <= 4 AND second - d >= 1 THEN code END AS barcode, CAST(d AS INTEGER) AS distance FROM r WHERE n = 1"""
)
def barcode_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "documents").select("doc_id", F.substring(F.regexp_replace(F.upper("text"), "[^ACGT]", ""), 1, 6).alias("s")).filter(F.length("s") == 6)
    scored = F.array_sort(F.array(*(F.struct(sequence.hamming(F.col("s"), F.lit(c)).alias("d"), F.lit(k).alias("k"), F.lit(c).alias("code")) for k, c in enumerate(_CODES))))
    best = x.select("doc_id", scored.alias("b"))
    first, second = F.col("b")[0], F.col("b")[1]
    return best.select("doc_id", F.when((first["d"] <= 4) & (second["d"] - first["d"] >= 1), first["code"]).alias("barcode"), first["d"].alias("distance"))


@query(
    """WITH t AS (SELECT n_nationkey AS row, 40 - n_nationkey AS quality, 50.0 - 2 * n_nationkey AS c1, 0.004 * (n_nationkey + 1) + 0.0005 AS c2, 0.0505 + 0.003 * (n_nationkey % 5) AS c3 FROM nation),
q AS (SELECT id, arg_min(quality, row) AS q FROM (SELECT *, row_number() OVER () AS id FROM lineitem) LEFT JOIN t ON 50 - l_quantity <= c1 AND l_discount <= c2 AND l_tax <= c3 GROUP BY ALL)
SELECT CAST(coalesce(q, 5) AS INTEGER) AS q, count(*) AS n FROM q GROUP BY 1"""
)
def quality_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a table of cuts the quality of the first row whose cuts all hold, 5 where none does."""
    k = F.col("n_nationkey")
    cuts = load(spark, sf_dir, "nation").select(k.alias("row"), (40 - k).alias("quality"), (50.0 - 2 * k).alias("c1"), (0.004 * (k + 1) + 0.0005).alias("c2"), (0.0505 + 0.003 * (k % 5)).alias("c3"))
    x = load(spark, sf_dir, "lineitem").select((50 - F.col("l_quantity")).alias("p1"), F.col("l_discount").alias("p2"), F.col("l_tax").alias("p3"))
    return filters.looked_up(x, cuts, "row", {"p1": "c1", "p2": "c2", "p3": "c3"}, "quality", 5).groupBy(F.col("quality").cast("int").alias("q")).agg(F.count("*").alias("n"))


@query(
    """WITH e AS (SELECT vec_id, label, [CAST(x AS DOUBLE) * 10 for x in embedding] AS f FROM embeddings), s AS (SELECT vec_id, label, len([x for x in f if x > 0.25]) / len(f) AS ppf FROM e)
SELECT label, count(*) AS reads, count(*) FILTER (ppf > 0.5) AS polyclonal, round(avg(ppf), 6) AS mean_ppf FROM s GROUP BY label"""
)
def clonality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "embeddings").select("label", trims.positive_share(F.transform("embedding", lambda v: v.cast("double") * 10)).alias("ppf"))
    return x.groupBy("label").agg(F.count("*").alias("reads"), F.count_if(F.col("ppf") > 0.5).alias("polyclonal"), _r(F.avg("ppf")).alias("mean_ppf"))


@query("SELECT l_suppkey // 10 AS bx, l_linenumber // 2 AS cell_y, count(*) AS n, round(avg(l_extendedprice), 4) AS mean, round(var_pop(l_extendedprice) / avg(l_extendedprice), 4) AS vmr FROM lineitem GROUP BY ALL")
def block_variance_to_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").groupBy(F.floor(F.col("l_suppkey") / 10).cast("long").alias("bx"), F.floor(F.col("l_linenumber") / 2).cast("int").alias("cell_y"))
    v = "l_extendedprice"
    return x.agg(F.count("*").alias("n"), _r(F.avg(v), 4).alias("mean"), _r(F.var_pop(v) / F.avg(v), 4).alias("vmr"))


_N1 = f"""{READS_SQL}, {tiles_sql("t", 45, 40)}, d AS (SELECT contig, lo, hi, forward, count(*) AS n FROM reads WHERE hi - lo >= 5 GROUP BY ALL),
p AS (SELECT d.contig, d.lo, d.hi, forward, n, t.lo AS rlo, t.hi AS rhi, least(d.hi, t.hi) - greatest(d.lo, t.lo) AS overlap FROM d JOIN t ON d.contig = t.contig AND d.lo < t.hi AND t.lo < d.hi),
b AS (SELECT *, row_number() OVER (PARTITION BY contig, lo, hi, forward ORDER BY overlap DESC, rlo DESC) AS k FROM p)"""


@query(
    f"""WITH {_N1}, c AS (SELECT contig, rlo AS lo, rhi AS hi, sum(n) AS ov, coalesce(sum(n) FILTER (k = 1), 0) AS assigned, coalesce(sum(n) FILTER (k = 1 AND overlap >= 0.7 * (rhi - rlo)), 0) AS covered FROM b GROUP BY contig, rlo, rhi)
SELECT contig, lo, hi, CAST(ov AS BIGINT) AS overlaps, CAST(assigned AS BIGINT) AS assigned, CAST(covered AS BIGINT) AS covered, round(assigned / (hi - lo), 6) AS per_base, round(1e6 * assigned / sum(assigned) OVER (), 4) AS rpm FROM c"""
)
def target_read_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of a least length at their region of greatest overlap; of ties the last region."""
    rows = reads(spark, sf_dir)
    d = rows.filter("hi - lo >= 5").groupBy("contig", "lo", "hi", "forward").agg(F.count("*").alias("n"))
    pairs = intervals.overlap_join(d, tiles(rows, 45, 40)).withColumn("overlap", F.least("l_hi", "r_hi") - F.greatest("l_lo", "r_lo"))
    best = intervals.best_match(pairs, ["contig", "l_lo", "l_hi", "l_forward"], [F.desc("overlap"), F.desc("r_lo")])
    region = ["contig", "r_lo", "r_hi"]
    counts = best.groupBy(*region).agg(F.sum("l_n").alias("assigned"), F.sum(F.when(F.col("overlap") >= 0.7 * (F.col("r_hi") - F.col("r_lo")), F.col("l_n")).otherwise(0)).alias("covered"))
    c = pairs.groupBy(*region).agg(F.sum("l_n").alias("overlaps")).join(counts, region, "left").na.fill(0, ["assigned", "covered"])
    total = best.agg(F.sum("l_n")).first()[0]  # one number
    return c.select("contig", F.col("r_lo").alias("lo"), F.col("r_hi").alias("hi"), "overlaps", "assigned", "covered", _r(F.col("assigned") / (F.col("r_hi") - F.col("r_lo"))).alias("per_base"), _r(1e6 * F.col("assigned") / F.lit(total), 4).alias("rpm"))


@query("SELECT c_custkey, CASE WHEN n < 5 THEN 'N/A' WHEN 100.0 * y / n >= 30 THEN 'M' ELSE 'F' END AS call FROM (SELECT o_custkey AS c_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'O') AS y FROM orders GROUP BY o_custkey)")
def sex_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("y"))
    return x.select("c_custkey", trims.sex_call(F.col("y"), F.col("n"), 5, 30.0).alias("call"))


@query("SELECT o_orderkey, round(o_totalprice / 1e5, CASE WHEN o_totalprice < 1e5 THEN 3 WHEN o_totalprice < 1e6 THEN 2 ELSE 1 END) AS said FROM orders")
def significant_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_orderkey", sequence.significant(F.col("o_totalprice") / 1e5).alias("said"))


@query("SELECT CASE WHEN c_name LIKE 'Customer#00000%' THEN 'small' ELSE 'large' END AS kind, count(*) AS n, CAST(max(CAST(regexp_extract(c_name, '#0*([0-9]+)$', 1) AS BIGINT)) AS BIGINT) AS top FROM customer WHERE c_custkey > 0 GROUP BY kind")
def name_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "customer").filter("c_custkey > 0")
    return x.groupBy(F.when(F.col("c_name").startswith("Customer#00000"), "small").otherwise("large").alias("kind")).agg(F.count("*").alias("n"), F.max(F.regexp_extract("c_name", "#0*([0-9]+)$", 1).cast("long")).alias("top"))


@query("SELECT event_type, count(*) AS n FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL '48 hours' GROUP BY event_type")
def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    last = e.agg(F.max("ts")).first()[0]  # one value, so that the scan is filtered by it
    return e.filter(F.col("ts") >= F.lit(last).cast("timestamp_ntz") - F.expr("INTERVAL 48 HOURS")).groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    """WITH e AS (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings), m AS (SELECT label, i, avg(CAST(v AS DOUBLE)) AS m FROM e GROUP BY label, i)
SELECT label, count(*) AS flows, round(max(m), 6) AS top, round(sum(abs(d)), 6) AS travel FROM (SELECT *, m - lag(m) OVER (PARTITION BY label ORDER BY i) AS d FROM m) GROUP BY label"""
)
def average_wells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wells of a group averaged flow by flow, and how far the average moves from flow to flow."""
    x = load(spark, sf_dir, "embeddings").select("label", F.posexplode(F.transform("embedding", lambda v: v.cast("double"))).alias("i", "v"))
    m = x.groupBy("label", "i").agg(F.avg("v").alias("m"))
    d = m.withColumn("d", F.col("m") - F.lag("m").over(Window.partitionBy("label").orderBy("i")))
    return d.groupBy("label").agg(F.count("*").alias("flows"), _r(F.max("m")).alias("top"), _r(F.sum(F.abs("d"))).alias("travel"))


@query(
    """WITH a AS (SELECT l_suppkey AS x, l_linenumber AS y, bit_or(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END) AS m FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL), b AS (SELECT l_suppkey AS x, l_linenumber AS y, bit_or(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END) AS m FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL)
SELECT CAST(coalesce(a.m, 0) AS INTEGER) AS left_mask, CAST(coalesce(b.m, 0) AS INTEGER) AS right_mask, count(*) AS cells FROM a FULL JOIN b USING (x, y) GROUP BY ALL"""
)
def mask_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").withColumn("m", F.when(F.col("l_linestatus") == "F", 1).otherwise(2))
    a, b = (li.filter(F.col("l_returnflag") == f).groupBy("l_suppkey", "l_linenumber").agg(F.bit_or("m").alias(n)) for f, n in (("A", "left_mask"), ("N", "right_mask")))
    x = a.join(b, ["l_suppkey", "l_linenumber"], "full").na.fill(0)
    return x.groupBy("left_mask", "right_mask").agg(F.count("*").alias("cells"))


@query(
    """WITH l AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') SELECT 'kept' AS verdict, count(*) AS n FROM customer WHERE c_custkey IN (SELECT o_custkey FROM l) UNION ALL SELECT 'rejected', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM l)"""
)
def name_list_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = load(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    c = load(spark, sf_dir, "customer").select("c_custkey")
    kept, rejected = c.join(names, "c_custkey", "left_semi"), c.join(names, "c_custkey", "left_anti")
    return kept.agg(F.lit("kept").alias("verdict"), F.count("*").alias("n")).unionByName(rejected.agg(F.lit("rejected").alias("verdict"), F.count("*").alias("n")))


@query("SELECT doc_id, CASE WHEN strpos(s, 'ATCACC') > 0 THEN substr(s, 1, strpos(s, 'ATCACC') - 1) WHEN s LIKE '%ATCAC' THEN left(s, -5) WHEN s LIKE '%ATCA' THEN left(s, -4) ELSE s END AS trimmed FROM (SELECT doc_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS s FROM documents)")
def adapter_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "documents").select("doc_id", F.regexp_replace(F.upper("text"), "[^ACGT]", "").alias("s"))
    return x.select("doc_id", trims.trimmed(F.col("s"), "ATCACC").alias("trimmed"))


@query(
    """WITH b AS (SELECT o_orderpriority, o_custkey, arg_max(CAST(date_trunc('week', o_orderdate) AS DATE), (o_totalprice, -o_orderkey)) AS week, max(o_totalprice) AS best FROM orders WHERE o_totalprice > 0 GROUP BY ALL),
w AS (SELECT o_orderpriority, week, count(*) AS runs, sum(best) AS total FROM b GROUP BY ALL)
SELECT o_orderpriority, week, runs, CAST(sum(runs) OVER o AS BIGINT) AS runs_so_far, round(sum(total) OVER o, 2) AS cumulative FROM w WINDOW o AS (PARTITION BY o_orderpriority ORDER BY week)"""
)
def cumulative_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the best results of the customers add up to by and by, in the week of each; results of zero or less do not count."""
    x = load(spark, sf_dir, "orders").filter("o_totalprice > 0").withColumn("week", F.date_trunc("week", "o_orderdate").cast("date"))
    best = x.groupBy("o_orderpriority", "o_custkey").agg(F.max(F.struct("o_totalprice", (-F.col("o_orderkey")).alias("k"), "week")).alias("b"))
    weeks = best.groupBy("o_orderpriority", "b.week").agg(F.count("*").alias("runs"), F.sum("b.o_totalprice").alias("total"))
    upto = running_sums(weeks, ["o_orderpriority"], "week", F.year("week"), {"runs_so_far": F.col("runs"), "cumulative": F.col("total")})
    return upto.select("o_orderpriority", "week", "runs", "runs_so_far", _r("cumulative", 2).alias("cumulative"))


@query("SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice / l_quantity), 6) AS slope_mean, round(regr_slope(l_extendedprice, l_quantity), 6) AS gain, round(regr_intercept(l_extendedprice, l_quantity), 4) AS shift FROM lineitem GROUP BY ALL")
def linear_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    y, x = F.col("l_extendedprice"), F.col("l_quantity")
    return load(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(_r(F.avg(y / x)).alias("slope_mean"), _r(F.regr_slope(y, x)).alias("gain"), _r(F.regr_intercept(y, x), 4).alias("shift"))


@query("SELECT o_orderkey, '{\"status\":\"' || o_orderstatus || '\",\"customer\":' || o_custkey || '}' AS payload FROM orders")
def serialize_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer"))).alias("payload"))


_FOLD_SQL = "SELECT l_suppkey, log2(avg(l_extendedprice) FILTER (l_linestatus = 'F') / avg(l_extendedprice) FILTER (l_linestatus = 'O')) AS fold FROM lineitem GROUP BY l_suppkey"


@query(f"WITH f AS (SELECT l_suppkey, round(fold, 6) AS fold FROM ({_FOLD_SQL}) WHERE fold IS NOT NULL), r AS (SELECT *, row_number() OVER (ORDER BY fold, l_suppkey) AS low, row_number() OVER (ORDER BY fold DESC, l_suppkey) AS high FROM f) SELECT l_suppkey, fold, CASE WHEN low <= 5 THEN 'lowest' ELSE 'highest' END AS side FROM r WHERE low <= 5 OR high <= 5")
def top_bottom_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five least and the five largest fold changes; the report is this short by its nature."""
    price = F.col("l_extendedprice")
    mean = lambda status: F.avg(F.when(F.col("l_linestatus") == status, price))
    f = load(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.log2(mean("F") / mean("O")).alias("fold")).filter("fold IS NOT NULL").select("l_suppkey", _r("fold").alias("fold"))
    low, high = f.orderBy("fold", "l_suppkey").limit(5), f.orderBy(F.desc("fold"), "l_suppkey").limit(5)
    high = high.join(low.select("l_suppkey"), "l_suppkey", "left_anti")
    return low.withColumn("side", F.lit("lowest")).unionByName(high.withColumn("side", F.lit("highest")))


@query("SELECT x, y, bit_or(bits) AS bits, count(*) AS blocks FROM (SELECT l_linenumber + CASE WHEN l_linestatus = 'F' THEN 0 ELSE 4 END AS x, l_suppkey % 64 + CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 32 ELSE 48 END AS y, 1 << (l_partkey % 8) AS bits FROM lineitem) GROUP BY x, y")
def merged_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks of blocks, each moved by its block's offset, as one mask; what stands in several blocks has the bits of all."""
    move_x = F.when(F.col("l_linestatus") == "F", 0).otherwise(4)
    move_y = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 32).otherwise(48)
    cells = load(spark, sf_dir, "lineitem").select((F.col("l_linenumber") + move_x).alias("x"), (F.col("l_suppkey") % 64 + move_y).alias("y"), F.expr("1L << CAST(l_partkey % 8 AS INT)").alias("bits"))
    return cells.groupBy("x", "y").agg(F.bit_or("bits").alias("bits"), F.count("*").alias("blocks"))
