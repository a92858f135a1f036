"""Benchmark decontamination by a stored positional inverted index of training terms.

The benchmark is the query: every 13 successive words of an item are a window.

1. One pass over the texts counts how often each benchmark term occurs in the
   corpus, so each window knows its rarest terms.
2. A second pass writes the index: postings (term, document, positions) of the
   rarest terms of all windows, stored by term, those of a frequent term dealt
   over several partitions.
3. For each window the list of its rarest term is intersected with those of the
   next two, positions adjusted by the terms' places in the window: what is left
   are the starts at which the three stand at their places, or near them.
4. At these starts, and in the documents that have some, the other terms of the
   window are looked at: all at their places is an exact phrase, most of them
   near their places is a proximity match.

All tables are joined by Spark; what goes to each task is two bitmaps of a fixed
size (which terms may be of interest), whose errors fall away in a later join.
So one index serves a benchmark of any size.

Words are runs of ASCII letters, digits and characters beyond ASCII, with A-Z
lower-cased, and are compared by 64-bit hashes of their bytes.

Defined cases: null and empty texts have no words and are never contaminated;
items without words are left out; an item of fewer words than a window is one
window; a window with a term that no document has can only be near, one of fewer
than ``NEAR_WORDS`` words only exact; ties of rarity go to the earlier place in
the window; repeated documents are judged row by row; repeated items count by
their id, null ids not at all; a text of any length is held whole by one task;
empty tables give an empty result or no hits;
columns of any name pass through ``clean_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from granary.llm import textbatch as tb
from granary.llm.storage import col, cut, discard, free_name

WIDTH = 13
#: A document is contaminated when at least one in so many of its words is hit.
SHARE = 20
#: Terms of a proximity match may stand so many words from their place,
SLOP = 3
#: and so many percent of a window's words must.
NEAR_PERCENT = 60
#: Windows of fewer words are looked for by exact phrase only.
NEAR_WORDS = 5
#: Rarest terms of a window whose lists are intersected.
LISTS = 3
#: Bits of a bitmap of terms.
BITS = 24
#: Postings of a term in one partition of the index, about.
SALT_PLACES = 1 << 20
#: Rows of windows, places or terms (to 200 bytes) that are broadcast at most; beyond it the same join shuffles.
BROADCAST_ROWS = 50_000
#: Row numbers (8 bytes each) that are broadcast at most.
BROADCAST_UIDS = 500_000
_OFFSET = 1 << 20


def words(found: tb.Texts) -> tuple[tb.Spans, np.ndarray]:
    lowered = found.lowered()
    at = tb.spans(lowered, tb.NOT_WORD)
    return at, tb.hashes(lowered.data, at.start, at.end)


def _few(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """A table for one side of a join: written, and broadcast up to a checked size (``rows``, where a row holds several); Spark can split the other side."""
    df = cut(df, name)
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


def _bitmap(terms: DataFrame) -> np.ndarray:
    """Which of ``BITS`` low bits the terms (column ``term``) have; as large for any number of terms."""
    bits = np.zeros(1 << BITS, bool)
    bits[terms.select(F.col("term").bitwiseAND(F.lit((1 << BITS) - 1)).cast("int").alias("bit")).distinct().toArrow().column(0).to_numpy()] = True
    return np.packbits(bits)


def _passing(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    low = hashed & np.uint64((1 << BITS) - 1)
    return (bits[(low >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (low & np.uint64(7))).astype(np.uint8)) & np.uint8(1) > 0


def item_windows(benchmark: DataFrame, text: str, key: str, width: int) -> DataFrame:
    """``item``, ``window`` (a hash of its terms) and ``terms`` (hashes) of each window of each item."""
    kind = benchmark.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tb.slices(batches, "text"):
            found = tb.texts(part.column("text"))
            at, hashed = words(found)
            first = at.first_of(len(found))
            n = np.diff(first)
            count = np.where(n > 0, np.maximum(n - width + 1, 1), 0)
            owner = np.repeat(np.arange(len(n)), count)
            low = first[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            size = np.minimum(n, width)[owner]
            offsets = np.concatenate([[0], np.cumsum(size)])
            flat = hashed[np.repeat(low, size) + np.arange(offsets[-1]) - np.repeat(offsets[:-1], size)]
            window = tb.sequence_hashes(flat, offsets, 5)
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("item").take(pa.array(owner)), pa.array(window.view(np.int64)), lists], ["item", "window", "terms"])

    schema = T.StructType([T.StructField("item", kind), T.StructField("window", T.LongType()), T.StructField("terms", T.ArrayType(T.LongType()))])
    rows = benchmark.select(col(key).alias("item"), col(text).alias("text")).filter("item IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(run, schema)


def counted(whole: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Of each text ``uid``, ``key`` and ``n_words``; and ``term`` and ``n``, how often a term that may be of interest occurs in a task."""
    shared = whole.sparkSession.sparkContext.broadcast(bitmap)
    schema = T.StructType([T.StructField("uid", T.LongType()), T.StructField("key", whole.schema["key"].dataType), *(T.StructField(c, T.LongType()) for c in ("n_words", "term", "n"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for part in tb.slices(batches, "text"):
            found = tb.texts(part.column("text"))
            at, hashed = words(found)
            none = pa.nulls(len(found), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("uid"), part.column("key"), pa.array(np.diff(at.first_of(len(found))), pa.int64()), none, none], schema.names)
            own, n = np.unique(hashed[_passing(shared.value, hashed)], return_counts=True)
            both = np.concatenate([seen, own])
            seen, which = np.unique(both, return_inverse=True)
            total = np.bincount(which, np.concatenate([total, n]), minlength=len(seen)).astype(np.int64)
        none = pa.nulls(len(seen), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.nulls(len(seen), to_arrow_type(schema["key"].dataType)), none, pa.array(seen.view(np.int64)), pa.array(total)], schema.names)

    return whole.mapInArrow(run, schema)


def plans(windows: DataFrame, frequency: DataFrame) -> DataFrame:
    """Of each distinct window ``window``, ``terms``, ``n_terms``, ``complete`` (each term occurs) and ``lists``, the (n, place, term) of its rarest terms that occur."""
    each = windows.groupBy("window").agg(F.first("terms").alias("terms"))
    terms = each.select("window", F.posexplode("terms").alias("place", "term")).join(frequency, "term")
    rarest = F.slice(F.array_sort(F.collect_list(F.struct("n", "place", "term"))), 1, LISTS)
    ranked = terms.groupBy("window").agg(rarest.alias("lists"), F.count("*").alias("occur"))
    return each.join(ranked, "window").select("window", "terms", F.size("terms").alias("n_terms"), (F.col("occur") == F.size("terms")).alias("complete"), "lists").filter(F.col("complete") | ((F.col("n_terms") >= NEAR_WORDS) & (F.size("lists") == LISTS)))


def index(whole: DataFrame, wanted: DataFrame) -> DataFrame:
    """The stored index: ``term``, ``uid``, ``places`` (rising) of the wanted terms (``term``, ``salts``), by term."""
    shared = whole.sparkSession.sparkContext.broadcast(_bitmap(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tb.slices(batches, "text"):
            found = tb.texts(part.column("text"))
            at, hashed = words(found)
            some = np.flatnonzero(_passing(shared.value, hashed))
            owner, term = at.owner[some], hashed[some]
            by = np.lexsort((some, term, owner))
            some, owner, term = some[by], owner[by], term[by]
            heads = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])])) if len(some) else some
            place = (some - at.first_of(len(found))[:-1][owner]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([heads, [len(some)]]).astype(np.int32)), pa.array(place))
            yield pa.RecordBatch.from_arrays([pa.array(term[heads].view(np.int64)), part.column("uid").take(pa.array(owner[heads])), lists], ["term", "uid", "places"])

    postings = whole.select("uid", "text").mapInArrow(run, "term long, uid long, places array<int>")
    dealt = postings.join(wanted, "term").withColumn("salt", F.pmod(F.xxhash64("uid"), "salts"))
    return cut(dealt.repartition("term", "salt").sortWithinPartitions("term", "uid").select("term", "uid", "places"), "index")


def starts(stored: DataFrame, planned: DataFrame, slop: int) -> DataFrame:
    """``uid``, ``window``, ``start``: where a window's rarest terms stand at their places, or up to ``slop`` words from them."""
    rows = planned.select("window", *(F.get("lists", F.lit(k))[c].alias(f"{c}{k}") for k in range(LISTS) for c in ("place", "term")))
    lists = [stored.select(F.col("term").alias(f"term{k}"), F.col("uid"), F.col("places").alias(f"places{k}")) for k in range(LISTS)]
    found = lists[0].join(rows, "term0")
    for k in range(1, LISTS):
        found = found.join(lists[k], [f"term{k}", "uid"], "left").filter(F.col(f"term{k}").isNull() | F.col(f"places{k}").isNotNull())
    found = found.select("uid", "window", *(x for k in range(LISTS) for x in (f"place{k}", f"places{k}")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first = b.column("places0")
            row = np.repeat(np.arange(len(b)), first.value_lengths().to_numpy())
            begin = first.flatten().to_numpy().astype(np.int64) - b.column("place0").to_numpy()[row]
            for k in range(1, LISTS):
                other = b.column(f"places{k}")
                free = other.is_null().to_numpy(zero_copy_only=False)
                size = other.value_lengths().fill_null(0).to_numpy()
                owner = np.repeat(np.arange(len(b)), size)
                shift = b.column(f"place{k}").fill_null(0).to_numpy()
                have = (owner << 32) + other.flatten().to_numpy() - shift[owner] + _OFFSET
                want = (row << 32) + begin + _OFFSET
                near = np.searchsorted(have, want - slop) < np.searchsorted(have, want + slop, side="right")
                keep = near | free[row]
                row, begin = row[keep], begin[keep]
            yield pa.RecordBatch.from_arrays([b.column("uid").take(pa.array(row)), b.column("window").take(pa.array(row)), pa.array(begin)], ["uid", "window", "start"])

    return found.mapInArrow(run, "uid long, window long, start long")


#: Starts of a document that are looked at together.
STARTS = 1 << 18
FOUND = "uid long, n_words long, n_hit long, exact array<long>, near array<long>"


def verified(whole: DataFrame, candidates: DataFrame, planned: DataFrame, slop: int) -> DataFrame:
    """Of each document with candidates ``uid``, ``n_words``, ``n_hit`` and the windows found as ``exact`` phrases and ``near``."""
    # a window's terms come once for a document, its starts as numbers
    full = candidates.groupBy("uid", "window").agg(F.collect_list("start").alias("starts")).join(_few(planned.select("window", "terms"), "windows"), "window")
    by_row = _few(full.groupBy("uid").agg(F.collect_list(F.struct("window", "starts", "terms")).alias("places")), "places", candidates.count())

    def judged(codes: np.ndarray, window: np.ndarray, owner: np.ndarray, starts: np.ndarray, terms: np.ndarray, sizes: np.ndarray) -> tuple[int, list[int], list[int]]:
        """``owner``: to which of the document's windows each start belongs."""
        n, width = len(codes), terms.shape[1]
        cover, is_exact, is_near = np.zeros(n + 1, np.int64), np.zeros(len(window), bool), np.zeros(len(window), bool)
        for low in range(0, len(starts), STARTS):
            own, start = owner[low : low + STARTS], starts[low : low + STARTS]
            size = sizes[own]
            inside, near = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
            for k in range(width):
                used, term = k < size, terms[own, k]
                there = np.zeros(len(start), bool)
                for shift in range(-slop, slop + 1):
                    at = start + k + shift
                    same = used & (at >= 0) & (at < n) & (codes[np.clip(at, 0, n - 1)] == term)
                    there |= same
                    if not shift:
                        inside += same
                near += there
            exact = inside == size
            np.add.at(cover, start[exact], 1)
            np.add.at(cover, (start + size)[exact], -1)
            is_exact[own[exact]] = True
            is_near[own[(100 * near >= NEAR_PERCENT * size) & (size >= NEAR_WORDS)]] = True
        return int((np.cumsum(cover)[:-1] > 0).sum()), np.unique(window[is_exact]).tolist(), np.unique(window[is_near]).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tb.slices(batches, "text"):
            found = tb.texts(part.column("text"))
            at, hashed = words(found)
            first = at.first_of(len(found))
            places = part.column("places")
            edge = np.concatenate([[0], np.cumsum(places.value_lengths().to_numpy())])
            flat = places.flatten()
            window, starts, lists = flat.field("window").to_numpy(), flat.field("starts"), flat.field("terms")
            size = lists.value_lengths().to_numpy().astype(np.int64)
            terms = np.zeros((len(size), int(size.max(initial=1))), np.int64)
            terms[np.arange(terms.shape[1]) < size[:, None]] = lists.flatten().to_numpy()
            upto = np.concatenate([[0], np.cumsum(starts.value_lengths().to_numpy())]).astype(np.int64)
            start, owner = starts.flatten().to_numpy(), np.repeat(np.arange(len(size)), np.diff(upto))
            rows = []
            for i in range(len(found)):
                low, high = edge[i], edge[i + 1]
                own = slice(upto[low], upto[high])
                rows.append(judged(hashed[first[i] : first[i + 1]].view(np.int64), window[low:high], owner[own] - low, start[own], terms[low:high], size[low:high]))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("uid"), pa.array(np.diff(first), pa.int64()), *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), longs, longs)))], ["uid", "n_words", "n_hit", "exact", "near"])

    texts, some = whole.select("uid", "text"), candidates.select("uid").distinct()
    if candidates.count() > BROADCAST_ROWS and (some := cut(some, "candidates")).count() <= BROADCAST_UIDS:
        texts = texts.join(F.broadcast(some), "uid", "left_semi")  # so that no other texts are shuffled
    return texts.join(by_row, "uid").select("uid", "text", "places").mapInArrow(run, FOUND)


def _searched(whole: DataFrame, benchmark: DataFrame, text: str, item: str, width: int, slop: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What ``counted`` says of each document (``uid``, ``key``, ``n_words``), what is found in those with candidates, and the items' windows."""
    windows = cut(item_windows(benchmark, text, item, width), "item-windows")
    terms = windows.select(F.explode("terms").alias("term")).distinct()
    seen = cut(counted(whole, _bitmap(terms)), "counts")
    frequency = _few(seen.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n")).join(terms, "term", "left_semi"), "frequency")
    planned = cut(plans(windows, frequency), "plans")
    salts = F.ceil(F.max("l.n") / SALT_PLACES).cast("long")
    wanted = _few(planned.select(F.explode("lists").alias("l")).groupBy(F.col("l.term").alias("term")).agg(salts.alias("salts")), "terms")
    stored = index(whole, wanted)
    few = F.broadcast(planned) if planned.count() <= BROADCAST_ROWS else planned
    candidates = cut(starts(stored, few, slop), "starts")
    found = cut(verified(whole, candidates, planned, slop), "found")
    discard(stored, candidates, planned)
    return seen.filter("uid IS NOT NULL").select("uid", "key", "n_words"), found, windows.select("window", "item").distinct()


def _contaminated(n_words: F.Column, n_hit: F.Column, share: int) -> F.Column:
    return (n_hit > 0) & (n_hit * share >= n_words)


def findings(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text", width: int = WIDTH, share: int = SHARE, slop: int = SLOP) -> DataFrame:
    """One row a document: key, n_words, n_hit, ``items`` by exact phrase and ``near_items`` by proximity only, contaminated."""
    whole = cut(docs.select(F.monotonically_increasing_id().alias("uid"), col(key).alias("key"), col(text).alias("text")), "documents")
    rows, found, windows = _searched(whole, benchmark, item_text, item, width, slop)
    windows = _few(windows, "items")
    exact, near = (found.select("uid", F.explode(c).alias("window")).join(windows, "window").groupBy("uid").agg(F.collect_set("item").alias(c)) for c in ("exact", "near"))
    # all of the documents with hits, so far fewer than documents
    hits = cut(found.select("uid", "n_hit").join(exact, "uid", "left").join(near, "uid", "left"), "hits")
    none = F.array().cast(T.ArrayType(benchmark.schema[item].dataType))
    items, near_items = (F.coalesce(c, none) for c in ("exact", "near"))
    return rows.join(hits, "uid", "left").select(
        F.col("key").alias(key), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), items.alias("items"), F.array_except(near_items, items).alias("near_items")
    ).withColumn("contaminated", _contaminated(F.col("n_words"), F.col("n_hit"), share))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The findings with the items as counts and digests of their sorted ids."""

    def sha(items: str) -> F.Column:
        return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda x: x.cast("string"))), ","), 256)

    return found.select(col(key), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), sha("items").alias("items_sha256"), "contaminated", F.size("near_items").cast("long").alias("n_near"), sha("near_items").alias("near_sha256"))


def sql(docs: str, benchmark: str, width: int = WIDTH, share: int = SHARE, slop: int = SLOP) -> str:
    """The digest by DuckDB, for tables small enough to write all windows and words out."""

    def tokens(table: str, key: str) -> str:
        lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return rf"(SELECT {key}, regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table})"

    near = "".join(f" JOIN p p{k} ON p{k}.doc_id = p0.doc_id AND p{k}.word = rarest[{k + 1}].word AND p{k}.place - rarest[{k + 1}].place BETWEEN p0.place - rarest[1].place - {slop} AND p0.place - rarest[1].place + {slop}" for k in range(1, LISTS))
    return f"""
WITH d AS {tokens(docs, "doc_id")}, b AS {tokens(benchmark, "item_id")},
items AS (SELECT DISTINCT item_id, least(len(w), {width}) AS n, w[i : i + {width} - 1] AS ws, array_to_string(w[i : i + {width} - 1], ' ') AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {width} + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0 AND item_id IS NOT NULL)),
places AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM items) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM places JOIN items USING (n, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
exact AS (SELECT DISTINCT doc_id, item_id FROM hits),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM d),
f AS (SELECT word, count(*) AS n FROM p GROUP BY word),
u AS (SELECT DISTINCT win, ws FROM items WHERE len(ws) >= {NEAR_WORDS}),
r AS (SELECT win, ws, list(struct_pack(word := word, place := place) ORDER BY f.n, place) AS rarest FROM (SELECT win, ws, unnest(ws) AS word, unnest(range(len(ws))) AS place FROM u) JOIN f USING (word) GROUP BY win, ws HAVING count(*) >= {LISTS}),
s AS (SELECT DISTINCT p0.doc_id, win, ws, p0.place - rarest[1].place AS start FROM r JOIN p p0 ON p0.word = rarest[1].word{near}),
near AS (SELECT DISTINCT doc_id, item_id FROM (SELECT DISTINCT s.doc_id, s.win FROM s JOIN d USING (doc_id) WHERE len(list_filter(range(len(ws)), lambda k: list_contains(d.w[greatest(start + k - {slop}, 0) + 1 : greatest(start + k + {slop} + 1, 0)], ws[k + 1]))) * 100 >= {NEAR_PERCENT} * len(ws)) JOIN items USING (win) ANTI JOIN exact USING (doc_id, item_id)),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS said FROM exact GROUP BY doc_id),
nearby AS (SELECT doc_id, count(*) AS n_near, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS near_said FROM near GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(said, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {share} * coalesce(n_hit, 0) >= len(w) AS contaminated,
 coalesce(n_near, 0) AS n_near, sha256(coalesce(near_said, '')) AS near_sha256
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN nearby USING (doc_id)"""


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with its columns as they were."""
    uid = free_name(docs, "__uid")
    whole = cut(docs.withColumn(uid, F.monotonically_increasing_id()), "documents")
    _, found, _ = _searched(whole.select(F.col(uid).alias("uid"), F.lit(0).cast("long").alias("key"), col(text).alias("text")), benchmark, item_text, item, width, 0)
    gone = _few(found.filter(_contaminated(F.col("n_words"), F.col("n_hit"), share)).select(F.col("uid").alias(uid)), "contaminated")
    return whole.join(gone, uid, "left_anti").select(*(col(c) for c in docs.columns))
