"""Secret scans: candidate spans, and who else owns the same credential.

Only Spark expressions.  A kind's matches are found whole: the texts between
the matches and the matches alternate, so running sums of the lengths of both
give the places.  The hashes of all candidate values are counted over the corpus
by distinct owners (the ``source`` column) and distinct repositories (each
document is one, if no column says more); a value that many hold is a copied
example, one that is its owner's alone looks live.

Defined cases: a null text is empty and has no spans; repeated rows are scanned
each and count as one owner and one repository; null owners count as one owner
of their own, null repositories as one of each owner; ties of spans are ordered
by start, then by kind; very long texts are scanned whole, and no pattern takes
more than a time in proportion to the text's length; an empty table gives an
empty result; further columns do not matter, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.arrays import bound, running, sum_before
from granary.llm.storage import col, cut

UID = "__uid"
#: A value held by so many owners is a widely copied example,
COPIED_OWNERS = 3
#: and so is one that two owners hold in so many repositories.
COPIED_REPOSITORIES = 10
#: Digests of copied values that are broadcast at most (32 bytes each); beyond it the same join shuffles.
BROADCAST_DIGESTS = 100_000

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, pattern, group of the value, fewest characters of the value (or of all for group 0), strings of which
#: a text with a match holds one (lower-cased for assign); base kinds first.
BASE = (
    ("assign", ASSIGN, 2, 12, ("passw", "secret", "token", "apikey", "api_key")),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, ("AKIA",)),
    ("hex", r"[0-9a-f]{16,}", 0, 16, ()),  # no run of 16 is a part of a shorter one
)
MORE = (
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 30, ("eyJ",)),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----", 0, 40, ("PRIVATE KEY-----",)),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, ("xox",)),
    ("url", r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]{0,31}://[^\s/:@]+:[^\s/:@]+@[A-Za-z0-9.-]+", 0, 12, ("://",)),
)
KINDS = (*BASE, *MORE)
_HIT = "struct<start:bigint,rank:int,kind:string,end:bigint,value:string>"


def _spans(text: Column, kind: str, pattern: str, group: int, least: int, marks: tuple[str, ...], rank: int) -> Column:
    """The kind's matches in order, with places in code points, those with too short a value left out."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"), gaps.alias("gap"))

    def places(x: Column) -> Column:
        both = F.transform(x["whole"], lambda w, i: F.length(w) + F.get(x["gap"], i))

        def hits(sums: Column) -> Column:
            def hit(w: Column, i: Column) -> Column:
                start = sum_before(sums, i) + F.get(x["gap"], i)
                value = F.regexp_extract(w, pattern, group) if group else w  # a match by itself matches as it did in the text
                return F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), (start + F.length(w)).alias("end"), value.alias("value"))

            return F.filter(F.transform(x["whole"], hit), lambda h: F.length(h["value"]) >= least)

        return bound(running(both), hits)

    holds = text.rlike(pattern)
    if marks:
        body = F.lower(text) if rank == 0 else text
        some = F.contains(body, F.lit(marks[0]))
        for m in marks[1:]:
            some = some | F.contains(body, F.lit(m))
        holds = some & holds
    return F.when(holds, bound(found, places)).otherwise(F.array().cast(f"array<{_HIT}>"))


def scanned(docs: DataFrame, text: str = "text", key: str = "doc_id", owner: str = "source", repository: str | None = None) -> DataFrame:
    """``key``, ``owner``, ``repository`` and the array ``spans`` of (start, rank, kind, end, value), sorted."""
    rows = docs.select(col(key).alias("key"), F.coalesce(col(owner).cast("string"), F.lit("")).alias("owner"), F.coalesce(col(repository or key).cast("string"), F.lit("")).alias("repository"), F.coalesce(col(text), F.lit("")).alias("body"))
    kinds = [_spans(F.col("body"), *k, rank) for rank, k in enumerate(KINDS)]
    return rows.select("key", "owner", "repository", F.array_sort(F.concat(*kinds)).alias("spans"))


def ownership(hits: DataFrame, copied_owners: int = COPIED_OWNERS, copied_repositories: int = COPIED_REPOSITORIES) -> DataFrame:
    """``digest``, ``owners``, ``repositories``, ``places`` and ``copied`` of each distinct value, over all rows.

    Counts are summed by owner and repository first, so a value that very many
    rows hold is a few rows at each later step.
    """
    copied = (F.col("owners") >= copied_owners) | ((F.col("owners") >= 2) & (F.col("repositories") >= copied_repositories))
    return (
        hits.groupBy("digest", "owner", "repository")
        .agg(F.count("*").alias("places"))
        .groupBy("digest", "owner")
        .agg(F.count("*").alias("repositories"), F.sum("places").alias("places"))
        .groupBy("digest")
        .agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("places").alias("places"))
        .withColumn("copied", copied)
    )


def findings(docs: DataFrame, text: str = "text", key: str = "doc_id", owner: str = "source", repository: str | None = None) -> DataFrame:
    """One row a document: key, ``spans``, and how many of them are ``n_live`` and ``n_copied``."""
    digests = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["kind"].alias("kind"), x["end"].alias("end"), F.unhex(F.sha2(x["value"], 256)).alias("digest")))
    found = cut(scanned(docs, text, key, owner, repository).withColumn("spans", digests).withColumn(UID, F.monotonically_increasing_id()), "secrets")
    hits = found.filter(F.size("spans") > 0).select(UID, "owner", "repository", F.explode("spans.digest").alias("digest"))
    # written first, so that Spark can split the join of a value with very many rows if they are too many to broadcast
    copied = cut(ownership(hits).filter("copied").select("digest", "copied"), "copied")
    copied = F.broadcast(copied) if copied.count() <= BROADCAST_DIGESTS else copied
    judged = hits.join(copied, "digest", "left").groupBy(UID).agg(F.count_if(F.col("copied").isNull()).alias("n_live"), F.count_if("copied").alias("n_copied"))
    return found.join(judged, UID, "left").select(F.col("key").alias(key), "spans", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_live", "n_copied")))


def _said(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    base = F.filter("spans", lambda x: x["rank"] < len(BASE))
    ranks = F.transform("spans", lambda x: x["rank"])
    counts = [(F.size(ranks) - F.size(F.array_remove(ranks, k))).cast("long").alias(f"n_{kind[0]}") for k, kind in enumerate(BASE)]
    return found.select(col(key), *counts, F.sha2(_said(base), 256).alias("base_sha256"), _said(F.col("spans")).alias("spans"), "n_live", "n_copied")


def sql(docs: str) -> str:
    """The digest by DuckDB; matches and the texts between them are taken apart in the same way."""
    parts = []
    for rank, (kind, pattern, group, least, _) in enumerate(KINDS):
        p, lead = pattern.replace("'", "''"), "''"
        if behind := re.match(r"\(\?<!(\[[^]]+\])\)", p):  # DuckDB has no look-behind: the character before is matched too
            p = f"(^|[^{behind[1][1:]}){p[behind.end():]}"
            lead = "unnest(regexp_extract_all(t, '" + p + "', 1))"
        parts.append(
            f"""SELECT doc_id, owner, rank, kind, least, m, substr(v, length(lead) + 1) AS v, gap, lead, k FROM (SELECT doc_id, owner, {rank} AS rank, '{kind}' AS kind, {least} AS least, unnest(regexp_extract_all(t, '{p}')) AS m, unnest(regexp_extract_all(t, '{p}', {group})) AS v, {lead} AS lead,
 unnest(list_slice(string_split_regex(t, '{p}'), 1, len(regexp_extract_all(t, '{p}')))) AS gap, unnest(range(len(regexp_extract_all(t, '{p}')))) AS k FROM d WHERE regexp_matches(t, '{p}'))"""
        )
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM {docs}), m AS ({" UNION ALL ".join(parts)}),
p AS (SELECT *, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, rank ORDER BY k) AS BIGINT) AS stop FROM m),
s AS (SELECT *, stop - length(m) + length(lead) AS start FROM p WHERE length(v) >= least),
o AS (SELECT v, count(DISTINCT owner) >= {COPIED_OWNERS} OR (count(DISTINCT owner) >= 2 AND count(DISTINCT struct_pack(o := owner, d := doc_id)) >= {COPIED_REPOSITORIES}) AS copied FROM s GROUP BY v),
a AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
 string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}) AS base, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
 count(*) FILTER (NOT copied) AS n_live, count(*) FILTER (copied) AS n_copied FROM s JOIN o USING (v) GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
 coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied FROM d LEFT JOIN a USING (doc_id)"""
