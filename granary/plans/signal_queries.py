"""Queries on arrays, texts as sequences, and time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import arrays, sequence
from granary.operators import coverage, relational
from granary.operators.prefix import running_sums
from granary.plans.catalog import query
from granary.sources.tables import READS_SQL, load, reads


def _r(c, n: int = 6):
    return F.round(c, n)


def _trace() -> F.Column:
    return F.transform("embedding", lambda x: x.cast("double"))


@query(
    """WITH c AS (SELECT label, list(v ORDER BY i) AS c FROM (SELECT label, i, avg(CAST(v AS DOUBLE)) AS v FROM (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY label, i) GROUP BY label),
d AS (SELECT vec_id, e.label, c.label AS near, sum((CAST(x AS DOUBLE) - y) * (CAST(x AS DOUBLE) - y)) AS d FROM (SELECT vec_id, e.label, c.label AS cl, unnest(e.embedding) AS x, unnest(c.c) AS y FROM embeddings e, c) t JOIN (SELECT label FROM c) c ON c.label = t.cl JOIN (SELECT vec_id AS v2, label FROM embeddings) e ON e.v2 = t.vec_id GROUP BY ALL)
SELECT vec_id, near, round(d, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(d, 9), near) AS n FROM d) WHERE n = 1"""
)
def nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "embeddings").select("vec_id", "label", _trace().alias("e"))
    out = relational.nearest(e, "vec_id", "e", "label")
    return out.select("vec_id", F.col("label").alias("near"), _r("distance").alias("distance"))


@query("WITH w AS (SELECT text FROM benchmark WHERE length(text) >= 5), k AS (SELECT lower(substr(text, CAST(i AS INTEGER), 5)) AS kmer FROM (SELECT text, unnest(range(1, length(text) - 3)) AS i FROM w)) SELECT kmer, count(*) AS n FROM k GROUP BY kmer HAVING count(*) >= 3")
def kmer_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = load(spark, sf_dir, "benchmark").select(F.explode(sequence.kmers(F.col("text"), 5)).alias("kmer"))
    return k.groupBy(F.lower("kmer").alias("kmer")).agg(F.count("*").alias("n")).filter("n >= 3")


_PARTS = "(SELECT DISTINCT p_name FROM part)"


@query(f"SELECT a.p_name AS a, b.p_name AS b, CAST(levenshtein(a.p_name, b.p_name) AS INTEGER) AS distance FROM {_PARTS} a JOIN {_PARTS} b ON split_part(a.p_name, ' ', 1) = split_part(b.p_name, ' ', 1) AND a.p_name < b.p_name")
def edit_distance_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = load(spark, sf_dir, "part").select("p_name", F.substring_index("p_name", " ", 1).alias("k")).distinct()
    a, b = names.select("k", F.col("p_name").alias("a")), names.select("k", F.col("p_name").alias("b"))
    return a.join(b, "k").filter("a < b").select("a", "b", F.levenshtein("a", "b").alias("distance"))


@query("SELECT doc_id, reverse(translate(regexp_replace(upper(text), '[^ACGT]', '', 'g'), 'ACGT', 'TGCA')) AS rc FROM documents")
def reverse_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", sequence.reverse_complement(F.regexp_replace(F.upper("text"), "[^ACGT]", "")).alias("rc"))


@query("SELECT doc_id, round((length(s) - length(replace(replace(s, 'G', ''), 'C', ''))) / nullif(length(s), 0), 6) AS gc FROM (SELECT doc_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS s FROM documents)")
def gc_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", _r(sequence.gc_share(F.regexp_replace(F.upper("text"), "[^ACGT]", ""))).alias("gc"))


@query(
    """WITH e AS (SELECT vec_id, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings), m AS (SELECT vec_id, i, avg(CAST(v AS DOUBLE)) OVER (PARTITION BY vec_id ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS m FROM e)
SELECT vec_id, round(max(m), 6) AS top, round(min(m), 6) AS low, round(sum(m * m), 6) AS energy FROM m GROUP BY vec_id"""
)
def moving_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "embeddings").select("vec_id", arrays.moving_mean(_trace(), 3).alias("m"))
    return x.select("vec_id", _r(F.array_max("m")).alias("top"), _r(F.array_min("m")).alias("low"), _r(F.aggregate("m", F.lit(0.0), lambda s, v: s + v * v)).alias("energy"))


@query(
    """WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(len(embedding))) AS i FROM embeddings), r AS (SELECT vec_id, min(v) AS a, max(v) AS b, sqrt(avg(v * v)) AS rms FROM e GROUP BY vec_id)
SELECT vec_id, min(i) FILTER (v >= a + (b - a) * 0.9) - min(i) FILTER (v >= a + (b - a) * 0.1) AS rise, round(any_value(rms), 6) AS rms FROM e JOIN r USING (vec_id) GROUP BY vec_id"""
)
def trace_rise_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select("vec_id", arrays.rise_time(_trace()).alias("rise"), _r(arrays.rms(_trace())).alias("rms"))


@query("WITH e AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(len(embedding))) AS i FROM embeddings) SELECT label, i // 20 AS block, count(*) AS n, round(avg(v), 6) AS mean FROM e GROUP BY label, block")
def tumbling_flow_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "embeddings").select("label", F.posexplode(_trace()).alias("i", "v"))
    return x.groupBy("label", F.floor(F.col("i") / 20).cast("long").alias("block")).agg(F.count("*").alias("n"), _r(F.avg("v")).alias("mean"))


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), _r(F.sum("value"), 4).alias("total"))
    return x.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


@query(
    """WITH w AS (SELECT unnest([time_bucket(INTERVAL '6 hours', ts), time_bucket(INTERVAL '6 hours', ts) - INTERVAL '6 hours']) AS start, value FROM events)
SELECT start, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY start"""
)
def sliding_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "events").groupBy(F.window("ts", "12 hours", "6 hours").alias("w")).agg(F.count("*").alias("n"), _r(F.sum("value"), 4).alias("total"))
    return x.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n", "total")


@query(
    """WITH l AS (SELECT user_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events), s AS (SELECT *, count(*) FILTER (p IS NULL OR ts >= p + INTERVAL '4 hours') OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM l)
SELECT user_id, min(ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, k"""
)
def sessions_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "4 hours").alias("w")).agg(F.count("*").alias("n"), _r(F.sum("value"), 4).alias("total"))
    return x.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n", "total")


@query(
    f"""WITH {READS_SQL}, c AS (SELECT lo // 100 AS x, flow // 5 AS y, sum(CASE WHEN forward THEN 1 ELSE 0 END) AS total, count(*) AS n FROM reads GROUP BY ALL)
SELECT a.x, a.y, any_value(a.n) AS n, round(sum(b.total) / sum(b.n), 6) AS around FROM c a JOIN c b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 GROUP BY a.x, a.y"""
)
def spatial_neighbour_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = reads(spark, sf_dir).select(F.floor(F.col("lo") / 100).cast("long").alias("x"), F.floor(F.col("flow") / 5).cast("long").alias("y"), F.col("forward").cast("int").alias("v"))
    return arrays.neighbour_mean(x, "x", "y", F.col("v")).select("x", "y", "n", _r("around").alias("around"))


@query(
    """WITH b AS (SELECT item_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS s FROM benchmark), c AS (SELECT item_id, s, unnest(string_split(s, '')) AS ch, unnest(range(length(s))) AS i FROM b WHERE s <> ''),
g AS (SELECT *, CASE WHEN ch = lag(ch) OVER (PARTITION BY item_id ORDER BY i) THEN 0 ELSE 1 END AS f FROM c), r AS (SELECT item_id, ch, i, sum(f) OVER (PARTITION BY item_id ORDER BY i) AS k FROM g), h AS (SELECT item_id, k, any_value(ch) AS ch, count(*) AS n FROM r GROUP BY item_id, k)
SELECT ch AS base, n AS length, count(*) AS runs FROM h GROUP BY ch, n"""
)
def homopolymer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.regexp_replace(F.upper("text"), "[^ACGT]", "")
    x = load(spark, sf_dir, "benchmark").select(F.explode(sequence.runs(s)).alias("r"))
    return x.groupBy("r.base", F.col("r.n").cast("long").alias("length")).agg(F.count("*").alias("runs"))


@query(
    """WITH b AS (SELECT item_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS s FROM benchmark), c AS (SELECT item_id, strpos('TACG', unnest(string_split(s, ''))) - 1 AS f, unnest(range(length(s))) AS i FROM b WHERE s <> ''),
g AS (SELECT item_id, f, coalesce(lag(f) OVER (PARTITION BY item_id ORDER BY i), -1) AS before FROM c), n AS (SELECT item_id, CAST(sum((f - before + 3) % 4 + 1) AS INTEGER) AS n FROM g WHERE f <> before GROUP BY item_id)
SELECT item_id, coalesce(n, 0) AS n_flows, TRUE AS same FROM b LEFT JOIN n USING (item_id)"""
)
def flow_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.regexp_replace(F.upper("text"), "[^ACGT]", "")
    x = load(spark, sf_dir, "benchmark").select("item_id", s.alias("s")).withColumn("flows", sequence.flows(F.col("s")))
    return x.select("item_id", F.size("flows").alias("n_flows"), (sequence.sequence_of(F.col("flows")) == F.col("s")).alias("same"))


def _line_sql(rows: str) -> str:
    """Sum of squares about a line."""
    return f"(SELECT vec_id, k, greatest(regr_syy(v, i) - coalesce(regr_sxy(v, i) ** 2 / nullif(regr_sxx(v, i), 0), 0), 0) AS sse FROM e JOIN ks USING (vec_id) WHERE {rows} GROUP BY vec_id, k)"


@query(
    f"""WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, CAST(unnest(range(len(embedding))) AS DOUBLE) AS i FROM embeddings), ks AS (SELECT vec_id, unnest(range(3, len(embedding) - 2)) AS k FROM embeddings),
s AS (SELECT vec_id, a.k, a.sse + b.sse AS sse FROM {_line_sql("i < k")} a JOIN {_line_sql("i >= k")} b USING (vec_id, k)), o AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(sse, 12), k) AS n FROM s)
SELECT e.vec_id, CAST(k AS INTEGER) AS "at", round(sse, 6) AS sse FROM embeddings e LEFT JOIN o ON o.vec_id = e.vec_id AND n = 1"""
)
def trace_change_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "embeddings").select("vec_id", arrays.change_point(_trace()).alias("c"))
    return x.select("vec_id", "c.at", _r("c.sse").alias("sse"))


@query()
def two_normal_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = arrays.mixture(load(spark, sf_dir, "lineitem"), "l_extendedprice")
    return out.select(*(_r(c, 4).alias(c) for c in out.columns[:5]), "n")


@query()
def depth_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = coverage.per_base(reads(spark, sf_dir)).select("contig", "pos", (F.col("fwd") + F.col("rev")).alias("n"))
    chunked = x.withColumn("chunk", F.concat_ws(":", "contig", F.floor(F.col("pos") / 4096).cast("string")))
    return arrays.segments(chunked, "chunk", "pos", "n")


@query()
def weighted_edit_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = load(spark, sf_dir, "part").select("p_name", F.substring_index("p_name", " ", -1).alias("k")).distinct()
    a, b = names.select("k", F.col("p_name").alias("a")), names.select("k", F.col("p_name").alias("b"))
    return a.join(b, "k").filter("a < b").select("a", "b", arrays.weighted_edit(swap=1)("a", "b").alias("distance"))


@query()
def local_alignment_of_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that share a rare 12-mer, aligned: seed by an index of k-mers, then score the best seed."""
    x = load(spark, sf_dir, "benchmark").select(F.col("item_id").alias("name"), F.col("text").alias("seq"))
    seeds = sequence.matches(x, x, 12).filter("read < ref")
    best = seeds.groupBy("read", "ref").agg(F.max("seeds").alias("seeds"))
    a, b = x.select(F.col("name").alias("read"), F.col("seq").alias("a")), x.select(F.col("name").alias("ref"), F.col("seq").alias("b"))
    scored = best.join(a, "read").join(b, "ref").select("read", "ref", "seeds", arrays.local_alignment()("a", "b").alias("s"))
    return scored.select("read", "ref", "seeds", "s.score", "s.a_end", "s.b_end")


@query(f"WITH {READS_SQL}, o AS (SELECT contig, lo, flow, lag(lo) OVER (PARTITION BY contig, adapter ORDER BY lo, flow) AS p FROM reads) SELECT contig, count(*) FILTER (p IS NULL) AS firsts, CAST(max(lo - p) AS BIGINT) AS widest, count(*) FILTER (lo - p > 2) AS jumps FROM o GROUP BY contig")
def lag_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = running_sums(reads(spark, sf_dir), ["contig", "adapter"], "lo", coverage.chunk("lo", 256), {"n": F.lit(1)}, ["flow"])
    gap = F.col("__next") - F.col("lo")
    return x.groupBy("contig").agg(F.count_if(F.col("__next").isNull()).alias("firsts"), F.max(gap).alias("widest"), F.count_if(gap > 2).alias("jumps"))


@query(
    """WITH e AS (SELECT vec_id, i, CAST(v AS DOUBLE) * 10 + 0.2 + i * 0.01 AS m, abs(round(CAST(v AS DOUBLE) * 10)) AS p FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings)),
w AS (SELECT vec_id, i // 8 AS k, avg(m - p) FILTER (p < 0.3) AS o FROM e GROUP BY ALL),
f AS (SELECT vec_id, k, coalesce(last_value(o IGNORE NULLS) OVER (PARTITION BY vec_id ORDER BY k), 0) AS o FROM w),
g AS (SELECT e.vec_id, f.k, f.o, sum((m - o) * p) FILTER (p >= 0.5 AND p <= 1.5) / sum(p * p) FILTER (p >= 0.5 AND p <= 1.5) AS g FROM e JOIN f ON f.vec_id = e.vec_id AND f.k = e.i // 8 GROUP BY e.vec_id, f.k, f.o),
h AS (SELECT vec_id, k, o, coalesce(last_value(g IGNORE NULLS) OVER (PARTITION BY vec_id ORDER BY k), 1) AS g FROM (SELECT e.vec_id, g.k, g.o, g.g FROM (SELECT DISTINCT vec_id FROM e) e JOIN g ON g.vec_id = e.vec_id)),
n AS (SELECT *, coalesce(lead(o) OVER (PARTITION BY vec_id ORDER BY k), o) AS o2, coalesce(lead(g) OVER (PARTITION BY vec_id ORDER BY k), g) AS g2 FROM h),
c AS (SELECT e.vec_id, (m - (o + (o2 - o) * ((i % 8) / 8.0))) / CASE WHEN g + (g2 - g) * ((i % 8) / 8.0) > 0 THEN g + (g2 - g) * ((i % 8) / 8.0) ELSE 1 END AS c FROM e JOIN n ON n.vec_id = e.vec_id AND n.k = e.i // 8)
SELECT vec_id, round(sum(c), 4) AS total, round(min(c), 4) AS least, round(max(c), 4) AS most FROM c GROUP BY vec_id"""
)
def windowed_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals with a drift in time, set right by windows of eight places against their rounded values."""
    x = load(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda v, i: v.cast("double") * 10 + 0.2 + i * 0.01).alias("m"), F.transform("embedding", lambda v: F.abs(F.round(v.cast("double") * 10))).alias("p")
    )
    c = arrays.windowed_normalised(x, "m", "p", 8, "c")
    return c.select("vec_id", _r(F.aggregate("c", F.lit(0.0), lambda s, v: s + v), 4).alias("total"), _r(F.array_min("c"), 4).alias("least"), _r(F.array_max("c"), 4).alias("most"))
