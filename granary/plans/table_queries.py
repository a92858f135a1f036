"""Queries on expression matrices, the run catalogue and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import arrays, sequence
from granary.operators import expression, metrics, relational
from granary.plans.catalog import query
from granary.sources.tables import load

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _r(c, n: int = 6):
    return F.round(c, n)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by brand and segment."""
    li, part = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "part")
    orders, customer = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    x = li.join(part, li["l_partkey"] == part["p_partkey"]).join(orders, li["l_orderkey"] == orders["o_orderkey"]).join(customer, orders["o_custkey"] == customer["c_custkey"])
    return x.groupBy(F.col("p_brand").alias("gene"), F.col("c_mktsegment").alias("sample")).agg(F.count("*").alias("n"))


_COUNTS_SQL = "c AS (SELECT p_brand AS gene, c_mktsegment AS sample, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"
_WIDE_SQL = f"{_COUNTS_SQL}, w AS (SELECT gene, {', '.join(f'''CAST(coalesce(sum(n) FILTER (sample = '{s}'), 0) AS BIGINT) AS {s}''' for s in SEGMENTS)} FROM c GROUP BY gene)"


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expression.matrix(_counts(spark, sf_dir), "gene", "sample", SEGMENTS, F.sum("n"))


@query(f"WITH {_WIDE_SQL} SELECT * FROM w")
def barcode_matrix_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(spark, sf_dir)


@query(f"WITH {_COUNTS_SQL} SELECT gene, sample, n, round(n * 1e6 / sum(n) OVER (PARTITION BY sample), 4) AS rpm, round(log2(n * 1e6 / sum(n) OVER (PARTITION BY sample) + 1), 6) AS log2_rpm FROM c")
def rpm_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = expression.rpm(_counts(spark, sf_dir), "gene", "sample")
    return x.withColumns({"rpm": _r("rpm", 4), "log2_rpm": _r("log2_rpm")})


_S = ", ".join(SEGMENTS)


@query(
    f"""WITH {_WIDE_SQL} SELECT gene, least({_S}) AS low, greatest({_S}) AS high, round(({" + ".join(SEGMENTS)}) / 5, 6) AS mean, round(CASE WHEN least({_S}) > 0 THEN greatest({_S}) / least({_S}) END, 6) AS ratio,
round(CASE WHEN least({_S}) > 0 THEN log2(greatest({_S}) / least({_S})) END, 6) AS log2_ratio, coalesce(greatest({_S}) >= 50 AND CASE WHEN least({_S}) > 0 THEN greatest({_S}) / least({_S}) END >= 1.25, false) AS differs FROM w"""
)
def differential_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = expression.differential(_wide(spark, sf_dir), SEGMENTS, 50, 1.25)
    return x.select("gene", "low", "high", _r("mean").alias("mean"), _r("ratio").alias("ratio"), _r("log2_ratio").alias("log2_ratio"), "differs")


_FOLD_SQL = """g AS (SELECT p_brand AS gene, count(*) FILTER (l_linestatus = 'F') AS n1, count(*) FILTER (l_linestatus <> 'F') AS n0, avg(l_extendedprice) FILTER (l_linestatus = 'F') AS m1, avg(l_extendedprice) FILTER (l_linestatus <> 'F') AS m0,
 var_samp(l_extendedprice) FILTER (l_linestatus = 'F') / count(*) FILTER (l_linestatus = 'F') AS e1, var_samp(l_extendedprice) FILTER (l_linestatus <> 'F') / count(*) FILTER (l_linestatus <> 'F') AS e0 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)"""


def _fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").join(load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).withColumn("gene", F.col("p_brand"))
    return expression.fold_change(x, "gene", F.col("l_linestatus") == "F", "l_extendedprice")


@query(f"WITH {_FOLD_SQL} SELECT gene, n1, n0, round(m1 / m0, 6) AS fold, round((m1 - m0) / sqrt(e1 + e0), 6) AS t, round((e1 + e0) * (e1 + e0) / (e1 * e1 / (n1 - 1) + e0 * e0 / (n0 - 1)), 4) AS df FROM g")
def fold_change_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fold(spark, sf_dir).select("gene", "n1", "n0", _r("fold").alias("fold"), _r("t").alias("t"), _r("df", 4).alias("df"))


@query()
def fold_change_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fold(spark, sf_dir).select("gene", _r("t").alias("t"), _r(arrays.t_test_p(F.col("t"), F.col("df"))).alias("p"))


@query(f"WITH {_WIDE_SQL} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM w" for i, a in enumerate(SEGMENTS) for b in SEGMENTS[i + 1 :]))
def correlation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expression.correlations(_wide(spark, sf_dir), SEGMENTS).withColumn("r", _r("r"))


@query(f"WITH {_COUNTS_SQL} SELECT sample, count(*) AS genes, round(quantile_cont(log2(n + 1), 0.05), 6) AS q05, round(quantile_cont(log2(n + 1), 0.95), 6) AS q95 FROM c WHERE n > 0 GROUP BY sample")
def nonzero_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _counts(spark, sf_dir).filter("n > 0").withColumn("v", F.log2(F.col("n") + 1))
    ends = metrics.quantiles(x, ["sample"], "v", {"q05": 0.05, "q95": 0.95})
    return x.groupBy("sample").agg(F.count("*").alias("genes")).join(ends, "sample").select("sample", "genes", _r("q05").alias("q05"), _r("q95").alias("q95"))


@query("WITH t AS (SELECT p_brand AS gene, sum(l_quantity) AS f, count(*) AS n FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY gene) SELECT gene, CAST(rank() OVER (ORDER BY n DESC, gene) AS INTEGER) AS place, n FROM t ORDER BY n DESC, gene LIMIT 5")
def top_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    x = load(spark, sf_dir, "lineitem").join(load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    best = x.groupBy(F.col("p_brand").alias("gene")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "gene").limit(5)
    return best.select("gene", F.rank().over(Window.orderBy(F.desc("n"), "gene")).alias("place"), "n")  # five rows


@query(
    """WITH g AS (SELECT p_partkey, p_size / 50.0 AS gc, count(l_partkey) AS n FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY ALL), q AS (SELECT quantile_cont(gc, 0.25) AS a, quantile_cont(gc, 0.75) AS b, 0.75 * avg(n) AS t FROM g),
s AS (SELECT count(*) FILTER (gc < a AND n < t) / count(*) FILTER (gc < a) AS low, count(*) FILTER (gc >= a AND gc <= b AND n < t) / count(*) FILTER (gc >= a AND gc <= b) AS mid, count(*) FILTER (gc > b AND n < t) / count(*) FILTER (gc > b) AS high FROM g, q)
SELECT round(low, 6) AS low, round(mid, 6) AS mid, round(high, 6) AS high, round(sqrt(((low - mid) * (low - mid) + (high - mid) * (high - mid)) / 2), 6) AS rms FROM s"""
)
def gc_bias_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    g = load(spark, sf_dir, "part").join(n, F.col("p_partkey") == F.col("l_partkey"), "left").select((F.col("p_size") / 50.0).alias("gc"), F.coalesce("n", F.lit(0)).alias("n"))
    one = metrics.quantiles(g.withColumn("all", F.lit(1)), ["all"], "gc", {"a": 0.25, "b": 0.75})
    ends = (one.first() or {"a": None, "b": None}), g.agg((0.75 * F.avg("n")).alias("t")).first()  # two single rows
    ends = {"a": ends[0]["a"], "b": ends[0]["b"], "t": ends[1]["t"]}
    gc, few = F.col("gc"), F.col("n") < ends["t"]

    def share(cond):
        return F.count_if(cond & few) / F.count_if(cond)

    s = g.agg(share(gc < ends["a"]).alias("low"), share((gc >= ends["a"]) & (gc <= ends["b"])).alias("mid"), share(gc > ends["b"]).alias("high"))
    a, b = F.col("low") - F.col("mid"), F.col("high") - F.col("mid")
    return s.select(_r("low").alias("low"), _r("mid").alias("mid"), _r("high").alias("high"), _r(F.sqrt((a * a + b * b) / 2)).alias("rms"))


@query(
    """WITH f AS (SELECT l_suppkey AS target, l_returnflag AS tag, count(*) AS size FROM lineitem GROUP BY ALL), t AS (SELECT target, CAST(sum(size) AS BIGINT) AS depth, list_sort(list(size)) AS sizes FROM f GROUP BY target),
m AS (SELECT list_sort(list(depth)) AS d FROM t), k AS (SELECT d[len(d) // 2 + 1] AS median FROM m)
SELECT count(*) AS targets, any_value(median) AS median, round(100.0 * count(*) FILTER (depth >= 0.5 * median AND depth <= 2 * median) / count(*), 6) AS pct_uniform, round(100.0 * count(*) FILTER (depth >= 0.8 * median) / count(*), 6) AS pct_08,
 count(*) FILTER (sizes[len(sizes) // 2 + 1] >= 20) AS large_families FROM t, k"""
)
def median_uniformity_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = load(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("target"), "l_returnflag").agg(F.count("*").alias("size"))
    sizes = f.groupBy("target", "size").agg(F.count("*").alias("n"))
    t = f.groupBy("target").agg(F.sum("size").alias("depth")).join(metrics.upper_median(sizes, ["target"], "size", "n").withColumnRenamed("size", "middle"), "target")
    depths = t.groupBy("depth").agg(F.count("*").alias("n"))
    median = metrics.upper_median(depths, [], "depth", "n").first()[0]
    d = F.col("depth")
    return t.agg(
        F.count("*").alias("targets"),
        F.lit(median).cast("long").alias("median"),
        _r(100.0 * F.count_if((d >= 0.5 * median) & (d <= 2 * median)) / F.count("*")).alias("pct_uniform"),
        _r(100.0 * F.count_if(d >= 0.8 * median) / F.count("*")).alias("pct_08"),
        F.count_if(F.col("middle") >= 20).alias("large_families"),
    )


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def semi_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = load(spark, sf_dir, "customer"), load(spark, sf_dir, "orders").filter("o_totalprice > 450000")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def anti_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = load(spark, sf_dir, "customer"), load(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").select("c_custkey", "c_name")


@query("SELECT r_name, n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY r_name, n_name")
def run_catalog_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp"))
    by = o.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("t"))
    x = by.join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return x.groupBy("r_name", "n_name").agg(F.sum("n").alias("orders"), _r(F.sum("t"), 2).alias("total"))


@query("SELECT s_name, p_brand, count(*) AS links FROM supplier JOIN (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) ON s_suppkey = l_suppkey JOIN part ON l_partkey = p_partkey GROUP BY s_name, p_brand")
def link_table_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
    x = load(spark, sf_dir, "supplier").join(link, F.col("s_suppkey") == F.col("l_suppkey")).join(load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return x.groupBy("s_name", "p_brand").agg(F.count("*").alias("links"))


@query(
    """WITH l AS (SELECT user_id, event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events WHERE event_type IN ('purchase', 'view')) WHERE n = 1)
SELECT c_custkey, c_name, event_id, k FROM customer LEFT JOIN l ON c_custkey = user_id"""
)
def left_join_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "view"))
    last = relational.latest(e.select("user_id", "ts", "event_id", "props"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return load(spark, sf_dir, "customer").join(last, F.col("c_custkey") == F.col("user_id"), "left").select("c_custkey", "c_name", "event_id", "k")


@query("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS archived, count(*) FILTER (o_orderstatus = 'O') AS local, count(*) FILTER (o_orderstatus = 'P') AS in_process, count(*) AS total FROM orders GROUP BY o_orderpriority")
def state_count_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.state_counts(load(spark, sf_dir, "orders"), "o_orderpriority", F.col("o_orderstatus"), {"archived": "F", "local": "O", "in_process": "P"})


@query("SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, round(sum(q), 2) AS quantity FROM (SELECT l_returnflag, l_orderkey, max(l_quantity) AS q FROM lineitem GROUP BY ALL) GROUP BY l_returnflag")
def distinct_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_orderkey").agg(F.max("l_quantity").alias("q"))
    return x.groupBy("l_returnflag").agg(F.count("*").alias("orders"), _r(F.sum("q"), 2).alias("quantity"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def page_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.page(load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "-o_totalprice", ["o_totalprice", "o_orderkey"], "o_orderkey", 20, 40)


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders WHERE o_totalprice > 0) WHERE n = 1")
def best_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "orders").filter("o_totalprice > 0").select("o_custkey", "o_totalprice", (-F.col("o_orderkey")).alias("k"))
    return relational.latest(x, ["o_custkey"], ["o_totalprice", "k"]).select("o_custkey", (-F.col("k")).alias("o_orderkey"), "o_totalprice")


@query("SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week, count(*) AS orders, round(max(o_totalprice), 2) AS best FROM orders GROUP BY week")
def weekly_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").groupBy(F.date_trunc("week", "o_orderdate").cast("date").alias("week")).agg(F.count("*").alias("orders"), _r(F.max("o_totalprice"), 2).alias("best"))


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'O') GROUP BY l_orderkey")
def orphan_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = load(spark, sf_dir, "orders").filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey"))
    return relational.orphans(load(spark, sf_dir, "lineitem"), known, "l_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query(
    """WITH a AS (SELECT l_suppkey AS x, l_linenumber AS y, avg(l_discount) AS v FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL), b AS (SELECT l_suppkey AS x, l_linenumber AS y, avg(l_discount) AS v FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL)
SELECT y, count(*) AS cells, count(*) FILTER (a.v IS NULL OR b.v IS NULL) AS missing, count(*) FILTER (abs(a.v - b.v) > 0.00501) AS different, round(corr(a.v, b.v), 6) AS correlation FROM a FULL JOIN b USING (x, y) GROUP BY y"""
)
def cell_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    a, b = (li.filter(F.col("l_linestatus") == s).groupBy(F.col("l_suppkey").alias("x"), F.col("l_linenumber").alias("y")).agg(F.avg("l_discount").alias(n)) for s, n in (("F", "a"), ("O", "b")))
    gap = F.abs(F.col("a") - F.col("b"))
    return a.join(b, ["x", "y"], "full").groupBy("y").agg(F.count("*").alias("cells"), F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("missing"), F.count_if(gap > 0.00501).alias("different"), _r(F.corr("a", "b")).alias("correlation"))


@query(
    """WITH e AS (SELECT min(l_quantity) AS x0, max(l_quantity) AS x1, min(l_extendedprice) AS y0, max(l_extendedprice) AS y1 FROM lineitem), c AS (SELECT CAST(least(floor(12 * (l_quantity - x0) / (x1 - x0)), 11) AS BIGINT) AS cell_x, CAST(least(floor(12 * (l_extendedprice - y0) / (y1 - y0)), 11) AS BIGINT) AS cell_y, l_discount AS z FROM lineitem, e)
SELECT cell_x, cell_y, count(*) AS n, round(avg(z), 6) AS mean FROM c GROUP BY cell_x, cell_y HAVING count(*) >= 20"""
)
def bin_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.bin_2d(load(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", "l_discount", 12, 20).withColumn("mean", _r("mean"))


@query("SELECT event_id, split_part(trim(both '{}' from props), ':', 1) AS key, CAST(trim(split_part(trim(both '{}' from props), ':', 2)) AS BIGINT) AS value FROM events")
def kvp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.explode(sequence.key_values(F.regexp_replace("props", r"[{}]", ""), ",", ":"))
    return load(spark, sf_dir, "events").select("event_id", pairs.alias("key", "v")).select("event_id", "key", F.trim(F.col("v")[0]).cast("long").alias("value"))


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total, max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS most FROM events GROUP BY event_type")
def json_extract_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.from_json("props", "k bigint")["k"]
    return load(spark, sf_dir, "events").select("event_type", k.alias("k")).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("total"), F.max("k").alias("most"))


@query("SELECT regexp_replace(lower(trim(p_name || ' / ' || p_brand)), '[\\s/]+', '_', 'g') AS name, count(*) AS n FROM part GROUP BY name")
def log_clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").groupBy(sequence.clean_key(F.concat("p_name", F.lit(" / "), "p_brand")).alias("name")).agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN grouping(r) = 1 THEN 'all' ELSE r END AS region, CASE WHEN grouping(s) = 1 THEN 'all' ELSE s END AS status, count(*) AS n, round(sum(p), 2) AS total FROM (SELECT o_orderpriority AS r, o_orderstatus AS s, o_totalprice AS p FROM orders) GROUP BY ROLLUP (r, s)")
def rollup_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "orders").rollup("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"), _r(F.sum("o_totalprice"), 2).alias("total"))
    return x.select(F.coalesce("o_orderpriority", F.lit("all")).alias("region"), F.coalesce("o_orderstatus", F.lit("all")).alias("status"), "n", "total")


@query("SELECT coalesce(l_returnflag, 'all') AS flag, coalesce(l_linestatus, 'all') AS status, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), _r(F.sum("l_quantity"), 2).alias("quantity"))
    return x.select(F.coalesce("l_returnflag", F.lit("all")).alias("flag"), F.coalesce("l_linestatus", F.lit("all")).alias("status"), "n", "quantity")


@query("SELECT event_type, count(DISTINCT user_id) AS users, true AS near FROM events GROUP BY event_type")
def approx_distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by a sketch beside the exact number; ``near``: it is off by no more than three of its standard errors."""
    x = load(spark, sf_dir, "events")
    # each by itself: beside an exact count Spark would keep a sketch for every user
    exact = x.select("event_type", "user_id").distinct().groupBy("event_type").agg(F.count("user_id").alias("users"))
    about = x.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("about"))
    x = exact.join(about, exact["event_type"].eqNullSafe(about["event_type"])).select(exact["event_type"], "users", "about")
    return x.select("event_type", "users", (F.abs(F.col("about") - F.col("users")) <= 0.06 * F.col("users") + 1).alias("near"))


@query("SELECT o_custkey AS k FROM orders WHERE o_totalprice > 300000 INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase'")
def intersect_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("k"))
    return a.intersect(load(spark, sf_dir, "events").filter("event_type = 'purchase'").select("user_id"))


@query("SELECT o_custkey AS k FROM orders EXCEPT SELECT user_id FROM events WHERE event_type = 'error'")
def include_minus_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).subtract(load(spark, sf_dir, "events").filter("event_type = 'error'").select("user_id"))


@query("SELECT DISTINCT p_type, p_brand FROM part WHERE regexp_matches(p_brand, '#1[0-9]?$') OR p_type LIKE 'PROMO%'")
def unique_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").filter(F.col("p_brand").rlike("#1[0-9]?$") | F.col("p_type").startswith("PROMO")).select("p_type", "p_brand").distinct()


@query("SELECT 'local' AS host, event_type, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY ALL UNION ALL SELECT 'remote', event_type, count(*) FROM events WHERE event_id % 2 = 1 GROUP BY ALL")
def federated_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    parts = [e.filter(F.col("event_id") % 2 == k).withColumn("host", F.lit(h)) for k, h in ((0, "local"), (1, "remote"))]
    return parts[0].unionByName(parts[1]).groupBy("host", "event_type").agg(F.count("*").alias("n"))


@query("SELECT p_brand, round(avg(TRY_CAST(p_size AS DOUBLE)) FILTER (p_size > 5), 6) AS mean_size, count(*) FILTER (p_size <= 5) AS skipped FROM part GROUP BY p_brand")
def mean_skipping_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.when(F.col("p_size") > 5, F.col("p_size").cast("string")).otherwise("error")
    x = load(spark, sf_dir, "part").select("p_brand", said.try_cast("double").alias("v"))
    return x.groupBy("p_brand").agg(_r(F.avg("v")).alias("mean_size"), F.count_if(F.col("v").isNull()).alias("skipped"))
