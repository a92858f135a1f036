"""Functions on nucleotide strings, flows, CIGARs and other texts, as Spark expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IUPAC = {"AA": "A", "CC": "C", "GG": "G", "TT": "T", "AG": "R", "CT": "Y", "CG": "S", "AT": "W", "GT": "K", "AC": "M"}
FLOW_ORDER = "TACG"


def reverse_complement(s: Column) -> Column:
    return F.reverse(F.translate(s, "ACGTacgt", "TGCAtgca"))


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two strings; what one is longer counts as differing."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (~x.eqNullSafe(y)).cast("int"))
    return F.aggregate(pairs, F.lit(0), lambda n, x: n + x)


def kmers(s: Column, k: int) -> Column:
    """All substrings of length k, in order; none if the text is shorter."""
    return F.when(F.length(s) >= k, F.transform(F.sequence(F.lit(1), F.length(s) - k + 1), lambda i: F.substring(s, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def gc_share(s: Column) -> Column:
    return F.try_divide(F.length(s) - F.length(F.translate(s, "GCgc", "")), F.length(s))


def iupac(a: Column, b: Column) -> Column:
    """The ambiguity code of two bases, ``N`` where there is none."""
    table = F.create_map(*(F.lit(x) for kv in IUPAC.items() for x in kv))
    return F.coalesce(table[F.concat(F.least(a, b), F.greatest(a, b))], F.lit("N"))


def cigar_ops(cigar: Column) -> Column:
    """``3M1D2M`` as an array of (op, len)."""
    sizes = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1))
    ops = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2))
    return F.zip_with(ops, sizes, lambda o, n: F.struct(o.alias("op"), n.cast("int").alias("len")))


def cigar_length(ops: Column, kinds: str) -> Column:
    """Sum of the lengths of some operations: ``MDN=X`` on the reference, ``MIS=X`` of the read."""
    return F.aggregate(F.filter(ops, lambda x: x["op"].isin(*kinds)), F.lit(0), lambda n, x: n + x["len"])


def cigar_sum(cigar: Column, kinds: str, finish: Callable[[Column], Column] | None = None) -> Column:
    """Sum of the lengths of some operations of a CIGAR string, by one pass over it, or what ``finish`` makes of it."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{kinds}]"), F.lit(1)), F.lit(0), lambda n, x: n + x.cast("int"), finish)


def covered_blocks(start: Column, ops: Column) -> Column:
    """Reference ranges (lo, hi) that M, N, = and X cover from ``start`` on; D breaks them, I, S, H and P take no room."""
    zero = F.struct(F.array().cast("array<struct<lo:bigint,hi:bigint>>").alias("out"), start.cast("long").alias("at"))

    def step(s: Column, x: Column) -> Column:
        covers, moves = x["op"].isin("M", "N", "=", "X"), x["op"].isin("M", "N", "=", "X", "D")
        after = s["at"] + F.when(moves, x["len"]).otherwise(0)
        out = F.when(covers, F.concat(s["out"], F.array(F.struct(s["at"].alias("lo"), after.alias("hi"))))).otherwise(s["out"])
        return F.struct(out.alias("out"), after.alias("at"))

    return F.aggregate(ops, zero, step, lambda s: s["out"])


def md_substitutions(md: Column) -> Column:
    """Places on the reference, from the alignment's start on, at which an MD string says that the base differs."""
    parts = F.regexp_extract_all(md, F.lit(r"(\d+|\^[A-Za-z]+|[A-Za-z])"), F.lit(1))
    zero = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(s: Column, x: Column) -> Column:
        number, gone = x.rlike("^[0-9]"), x.startswith("^")
        size = F.when(number, F.try_to_number(x, F.lit("999999")).cast("long")).when(gone, F.length(x) - 1).otherwise(1)
        out = F.when(number | gone, s["out"]).otherwise(F.concat(s["out"], F.array(s["at"])))
        return F.struct(out.alias("out"), (s["at"] + size).cast("long").alias("at"))

    return F.aggregate(parts, zero, step, lambda s: s["out"])


def alignment_errors(ops: Column, md: Column) -> Column:
    """Errors as (pos, kind, n) in order: ``pos`` counts the aligned bases of the read before it.

    ``ins`` and ``del`` come from the CIGAR, ``sub`` from the MD string; a
    deletion takes no base of the read, clipped bases are not counted.
    """
    kind = "array<struct<ref:bigint,pos:bigint,n:bigint>>"
    zero = F.struct(F.array().cast(kind).alias("ins"), F.array().cast(kind).alias("gone"), F.lit(0).cast("long").alias("ref"), F.lit(0).cast("long").alias("pos"))

    def step(s: Column, x: Column) -> Column:
        n, here = x["len"].cast("long"), F.array(F.struct(s["ref"].alias("ref"), s["pos"].alias("pos"), x["len"].cast("long").alias("n")))
        return F.struct(
            F.when(x["op"] == "I", F.concat(s["ins"], here)).otherwise(s["ins"]).alias("ins"),
            F.when(x["op"] == "D", F.concat(s["gone"], here)).otherwise(s["gone"]).alias("gone"),
            F.when(x["op"].isin("M", "=", "X", "D", "N"), s["ref"] + n).otherwise(s["ref"]).alias("ref"),
            F.when(x["op"].isin("M", "=", "X", "I"), s["pos"] + n).otherwise(s["pos"]).alias("pos"),
        )

    def total(some: Column) -> Column:
        return F.aggregate(some, F.lit(0).cast("long"), lambda t, x: t + x["n"])

    def said(pos: Column, name: str, n: Column) -> Column:
        return F.struct(pos.alias("pos"), F.lit(name).alias("kind"), n.alias("n"))

    def errors(w: Column) -> Column:
        subs = F.transform(md_substitutions(md), lambda r: said(r - total(F.filter(w["gone"], lambda g: g["ref"] < r)) + total(F.filter(w["ins"], lambda i: i["ref"] <= r)), "sub", F.lit(1).cast("long")))
        return F.array_sort(F.concat(F.transform(w["ins"], lambda i: said(i["pos"], "ins", i["n"])), F.transform(w["gone"], lambda g: said(g["pos"], "del", g["n"])), subs))

    return F.transform(F.array(F.aggregate(ops, zero, step)), errors)[0]


def read_name_fields(name: Column) -> Column:
    """``RUN1:12:345`` as (run, row, col); nulls where it is not of that form."""
    form = r"^([^:]+):(\d+):(\d+)$"
    part = lambda k: F.nullif(F.regexp_extract(name, form, k), F.lit(""))
    return F.struct(part(1).alias("run"), part(2).cast("int").alias("row"), part(3).cast("int").alias("col"))


def runs(s: Column) -> Column:
    """Homopolymers of a string as an array of (base, n)."""
    kind = "array<struct<base:string,n:int>>"

    def step(out: Column, x: Column) -> Column:
        last = F.element_at(out, -1)
        grown = F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(x.alias("base"), (last["n"] + 1).alias("n"))))
        return F.when((F.size(out) > 0) & (last["base"] == x), grown).otherwise(F.concat(out, F.array(F.struct(x.alias("base"), F.lit(1).alias("n")))))

    return F.aggregate(F.filter(F.split(s, ""), lambda c: c != ""), F.array().cast(kind), step)


def flows(s: Column, order: str = FLOW_ORDER) -> Column:
    """How many bases each flow of the cyclic order takes up, to the flow of the last base."""
    table = F.create_map(*(F.lit(x) for k, c in enumerate(order) for x in (c, k)))
    zero = F.struct(F.array().cast("array<int>").alias("out"), F.lit(-1).alias("at"))
    n = len(order)

    def step(st: Column, x: Column) -> Column:
        gap = F.pmod(table[x["base"]] - st["at"] - 1, F.lit(n))
        return F.struct(F.concat(st["out"], F.array_repeat(F.lit(0), gap), F.array(x["n"])).alias("out"), F.pmod(st["at"] + gap + 1, F.lit(n)).alias("at"))

    return F.aggregate(runs(s), zero, step, lambda st: st["out"])


def sequence_of(counts: Column, order: str = FLOW_ORDER) -> Column:
    """The bases of an array of flow counts."""
    return F.array_join(F.transform(counts, lambda n, i: F.repeat(F.substring(F.lit(order), i % len(order) + 1, F.lit(1)), n)), "")


def key_values(text: Column, outer: str = ";", inner: str = "=", flag: str = "") -> Column:
    """``a=1,2;b`` as a map of arrays; a key without a value has ``[flag]``."""
    parts = F.filter(F.transform(F.split(text, outer), lambda x: F.trim(x)), lambda x: x != "")
    value = lambda p: F.split(F.substr(p, F.length(F.substring_index(p, inner, 1)) + 1 + len(inner)), ",")
    entries = F.transform(parts, lambda p: F.struct(F.substring_index(p, inner, 1).alias("k"), F.when(p.contains(inner), value(p)).otherwise(F.array(F.lit(flag))).alias("v")))
    # of a key that comes twice the last value counts
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["k"] == e["k"]))
    return F.map_from_entries(last)


def clean_key(name: Column) -> Column:
    """A log key: printable, lower case, white space and slashes as one underscore."""
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(name, r"[^\x20-\x7e\t]", ""))), r"[\s/]+", "_")


def significant(v: Column) -> Column:
    """Fewer decimals the larger the number: 3 below 1, 2 below 10, 1 below 100, else none."""
    a = F.abs(v)
    return F.when(a < 1, F.round(v, 3)).when(a < 10, F.round(v, 2)).when(a < 100, F.round(v, 1)).otherwise(F.round(v, 0))


def phred(error: Column) -> Column:
    return -10 * F.log10(error)


def error_of(q: Column) -> Column:
    return F.pow(F.lit(10.0), -q / 10)


def matches(reads: DataFrame, reference: DataFrame, k: int, text: str = "seq", key: str = "name") -> DataFrame:
    """Places in the reference where each read's k-mers stand, by offset: seeds of a mapping.

    An inverted index of k-mers, joined; the offset with most k-mers is a read's candidate.
    """
    index = reference.select(F.col(key).alias("ref"), F.posexplode(kmers(F.col(text), k)).alias("at", "kmer"))
    seeds = reads.select(F.col(key).alias("read"), F.posexplode(kmers(F.col(text), k)).alias("pos", "kmer"))
    return seeds.join(index, "kmer").groupBy("read", "ref", (F.col("at") - F.col("pos")).alias("offset")).agg(F.count("*").alias("seeds"))
