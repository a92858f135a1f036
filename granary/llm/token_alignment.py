"""Alignment of two tokenizers' tokens of the same texts, and how they are linked over the corpus.

A text is encoded by a byte-level BPE (with a blank before it) and by a piece
model (which puts that blank itself); both must give the bytes of the blank and
the text back.  Where tokens of both end at one byte the text can be cut.  The
cuts are found by divide and conquer: of an interval a common end near the middle
is located by bisection, from one side's end to the other's and back until both
meet, and both halves are intervals of their own; an interval without an inner
common end is a leaf, a group.  All intervals of a slice of texts go one level
down at a time.

Every pair of an A and a B token of one group is a link.  The distinct id pairs of
each document are written, Spark counts the documents of every pair, and the
counts come back to the documents in blocks of A ids, each of a bounded number of
pairs, so neither the corpus nor the vocabularies decide what a task holds.

Defined cases: a null text, an empty one, and one whose tokens do not give its bytes
back (the piece model turns U+2581 into a blank) have no tokens, zeros and no hash;
repeated rows are documents of their own, each counted; ties for an A id's highest
count are all best; an empty table gives an empty result; a very long text is a row
held whole by one task, with memory of some dozens of bytes for each byte of it; the
links of a group are counted by distinct ids, never listed beyond a block; further
columns do not matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm import textbatch as tb
from granary.llm.packing import tokenizer_path
from granary.llm.storage import col, cut
from granary.llm.tokens import Encoder, PieceEncoder

#: Id pairs whose counts are broadcast at a time, about: 16 bytes each.
BLOCK_PAIRS = 4_000_000
#: Links that are expanded at a time.
LINKS = 4_000_000
#: Groups whose text is made at a time.
GROUPS = 500_000
SLICE_BYTES = 1 << 20
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Bytes:
    """The bytes of every id, behind one another."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.first = np.cumsum(self.size) - self.size
        self.text = pa.array([str(i) for i in range(len(tokens))])

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        at = np.cumsum(size) - size
        return self.flat[np.repeat(self.first[ids] - at, size) + np.arange(int(size.sum()))]


def byte_level(token: str) -> bytes:
    """A byte-level token's bytes: visible Latin-1 characters stand for themselves, the other bytes for U+0100 and on in order."""
    return bytes(_BYTE_OF[c] for c in token) if all(c in _BYTE_OF for c in token) else token.encode()


#: The characters that stand for bytes in a byte-level vocabulary.
_SELF = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_OF = {chr(b): b for b in _SELF} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in _SELF)}


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()


class Pair:
    """Both tokenizers; one for each task."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = Encoder(path_a, plain_special=True), PieceEncoder(path_b)
        words, pieces = self.a.tokenizer, self.b.model
        self.bytes_a = Bytes([byte_level(words.id_to_token(i)) for i in range(words.get_vocab_size())])
        self.bytes_b = Bytes([piece_bytes(pieces.id_to_piece(i), pieces.is_byte(i)) for i in range(pieces.get_piece_size())])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Which texts have tokens, and of these for A and B: ids, and where each text's begin."""
        good = np.fromiter((bool(x) for x in texts), bool, len(texts))
        some = [x for x in texts if x]
        ids_a, first_a = self.a.encode([f" {x}" for x in some])
        ids_b, first_b = self.b.encode(some)
        sides = [(self.bytes_a, ids_a.astype(np.int64), np.diff(first_a)), (self.bytes_b, ids_b, np.diff(first_b))]
        data = np.frombuffer("".join(f" {x}" for x in some).encode(), np.uint8)
        size = np.fromiter((len(x.encode()) + 1 for x in some), np.int64, len(some))
        same = np.ones(len(some), bool)
        for table, ids, count in sides:
            same &= np.bincount(np.repeat(np.arange(len(some)), count), table.size[ids], len(some)).astype(np.int64) == size
        fits = np.repeat(same, size)
        owner, wanted = np.repeat(np.arange(len(some)), size)[fits], data[fits]
        for table, ids, count in sides:
            differ = table.joined(ids[np.repeat(same, count)]) != wanted
            if differ.any():
                same[owner[differ]] = False
                fits = np.repeat(same, size)
                owner, wanted = np.repeat(np.arange(len(some)), size)[fits], data[fits]
        good[np.flatnonzero(good)] = same
        ids = [i[np.repeat(same, n)] for _, i, n in sides]
        return good, ids, [np.concatenate([[0], np.cumsum(n[same])]) for _, _, n in sides]


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks on the tokens of A and of B behind which a text is cut; texts' last tokens are among them."""
    cut_a, cut_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    cut_a[first_a[1:] - 1] = cut_b[first_b[1:] - 1] = True
    a0, a1, b0, b1 = first_a[:-1], first_a[1:], first_b[:-1], first_b[1:]
    while True:
        inner = (a1 - a0 > 1) & (b1 - b0 > 1)  # only there can both have an end before the last
        a0, a1, b0, b1 = a0[inner], a1[inner], b0[inner], b1[inner]
        if not len(a0):
            return cut_a, cut_b
        i, j = _near_middle(ends_a, ends_b, a0, a1, b0, b1)
        found = i >= 0
        a0, a1, b0, b1, i, j = a0[found], a1[found], b0[found], b1[found], i[found], j[found]
        cut_a[i] = cut_b[j] = True
        a0, a1, b0, b1 = np.concatenate([a0, i + 1]), np.concatenate([i + 1, a1]), np.concatenate([b0, j + 1]), np.concatenate([j + 1, b1])


def _near_middle(ends_a: np.ndarray, ends_b: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each interval the tokens of a common inner end, at or behind the middle, else before it; -1 where there is none."""
    n = len(a0)
    found_i, found_j = np.full(n, -1), np.full(n, -1)
    middle = (a0 + a1 - 2) >> 1
    at, i = np.arange(n), middle
    while len(at):  # to the right: the other side's first end not before this one
        j = np.searchsorted(ends_b, ends_a[i])
        meet = (ends_b[j] == ends_a[i]) & (j < b1[at] - 1)
        found_i[at[meet]], found_j[at[meet]] = i[meet], j[meet]
        go = ~meet & (j < b1[at] - 1)
        at, j = at[go], j[go]
        i = np.searchsorted(ends_a, ends_b[j])
        meet = (ends_a[i] == ends_b[j]) & (i < a1[at] - 1)
        found_i[at[meet]], found_j[at[meet]] = i[meet], j[meet]
        go = ~meet & (i < a1[at] - 1)
        at, i = at[go], i[go]
    at = np.flatnonzero(found_i < 0)
    i = middle[at]
    while len(at):  # to the left: the other side's last end not behind this one
        j = np.searchsorted(ends_b, ends_a[i], side="right") - 1
        go = j >= b0[at]
        at, i, j = at[go], i[go], j[go]
        meet = ends_b[j] == ends_a[i]
        found_i[at[meet]], found_j[at[meet]] = i[meet], j[meet]
        at, j = at[~meet], j[~meet]
        i = np.searchsorted(ends_a, ends_b[j], side="right") - 1
        go = i >= a0[at]
        at, i, j = at[go], i[go], j[go]
        meet = ends_a[i] == ends_b[j]
        found_i[at[meet]], found_j[at[meet]] = i[meet], j[meet]
        at, i = at[~meet], i[~meet]
    return found_i, found_j


def group_texts(pair: Pair, ids: list[np.ndarray], ends: list[np.ndarray]) -> Iterator[tuple[memoryview, np.ndarray]]:
    """Blocks of groups as ``a1,a2|b1;`` one behind the other, with where each group begins in the block."""
    for low in range(0, len(ends[0]), GROUPS):
        high = min(low + GROUPS, len(ends[0]))
        sides = []
        for table, own, end in zip((pair.bytes_a, pair.bytes_b), ids, ends, strict=True):
            begin = int(end[low - 1]) if low else 0
            offsets = np.concatenate([[0], end[low:high] - begin]).astype(np.int32)
            sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), table.text.take(pa.array(own[begin : int(end[high - 1])]))), ","))
        done = pc.binary_join_element_wise(pc.binary_join_element_wise(*sides, "|"), "", ";")
        yield memoryview(done.buffers()[2]), np.frombuffer(done.buffers()[1], np.int32)[: high - low + 1]


def linked(ids: list[np.ndarray], ends: list[np.ndarray], owner: np.ndarray, width: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, pair) and how many links each has, in order; a pair is ``a * width + b``, less than ``span``."""
    sizes = [np.diff(e, prepend=0) for e in ends]
    first = [e - s for e, s in zip(ends, sizes, strict=True)]
    products = sizes[0] * sizes[1]
    keys, counts = [], []

    def add(doc: np.ndarray, pairs: np.ndarray, n: np.ndarray | None = None) -> None:
        both = doc * span + pairs
        if n is None:
            k, m = np.unique(both, return_counts=True)
        else:
            k, at = np.unique(both, return_inverse=True)
            m = np.bincount(at, n, len(k)).astype(np.int64)
        keys.append(k)
        counts.append(m)

    few = np.flatnonzero(products <= LINKS)
    part = np.cumsum(products[few]) // LINKS
    for g in np.split(few, np.flatnonzero(np.diff(part)) + 1):
        if not len(g):
            continue
        p, q = sizes[0][g], sizes[1][g]
        of = np.repeat(np.arange(len(g)), p)
        a = ids[0][np.repeat(first[0][g] - (np.cumsum(p) - p), p) + np.arange(len(of))]
        times = q[of]
        b = ids[1][np.repeat(first[1][g][of] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))]
        add(np.repeat(owner[g][of], times), np.repeat(a, times) * width + b)
    for g in np.flatnonzero(products > LINKS).tolist():
        a, m = np.unique(ids[0][first[0][g] : ends[0][g]], return_counts=True)
        b, k = np.unique(ids[1][first[1][g] : ends[1][g]], return_counts=True)
        step = max(1, LINKS // len(b))
        for s in range(0, len(a), step):
            pairs = (a[s : s + step, None] * width + b).ravel()
            add(np.full(len(pairs), owner[g]), pairs, np.outer(m[s : s + step], k).ravel())
    if not keys:
        return (np.zeros(0, np.int64),) * 3
    key, n = np.concatenate(keys), np.concatenate(counts)
    if len(keys) > 1:
        key, at = np.unique(key, return_inverse=True)
        n = np.bincount(at, n, len(key)).astype(np.int64)
    return key // span, key % span, n


def aligned(docs: DataFrame, text: str = "text", key: str = "doc_id", path_a: str | None = None, path_b: str | None = None, groups: bool = False) -> DataFrame:
    """One row a document: key, counts, ``groups_sha256``, if asked for ``groups``, distinct ``pairs`` and the ``links`` of each."""
    path_a, path_b = path_a or tokenizer_path("byte_bpe_50k.json"), path_b or tokenizer_path("piece_bpe_32k.model")
    long, names = T.LongType(), ["__key", *COUNTS, "groups_sha256", *(["groups"] if groups else []), "pairs", "links"]
    schema = T.StructType(
        [T.StructField("__key", docs.schema[key].dataType), *(T.StructField(c, long) for c in COUNTS), T.StructField("groups_sha256", T.StringType())]
        + [T.StructField("groups", T.StringType())] * groups
        + [T.StructField("pairs", T.ArrayType(long)), T.StructField("links", T.ArrayType(long))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(path_a, path_b)
        width = len(pair.bytes_b.size)
        span = width * len(pair.bytes_a.size)
        for part in tb.slices(batches, "__text", SLICE_BYTES):
            good, ids, first = pair.encode(part.column("__text").to_pylist())
            m, at = int(good.sum()), np.flatnonzero(good)
            ends = [np.cumsum(table.size[own]) for table, own in zip((pair.bytes_a, pair.bytes_b), ids, strict=True)]
            last = [np.flatnonzero(marks) + 1 for marks in common_ends(*ends, *first)] if m else [np.zeros(0, np.int64)] * 2
            owner = np.searchsorted(first[0], last[0] - 1, side="right") - 1
            hashes, whole = [hashlib.sha256() for _ in range(m)], [[] for _ in range(m)]
            done = 0
            for data, begin in group_texts(pair, ids, last):
                low = np.searchsorted(owner[done : done + len(begin) - 1], np.arange(m + 1))
                for d in np.flatnonzero(np.diff(low)).tolist():
                    end = done + low[d + 1]
                    ended = end == len(owner) or owner[end] != d
                    text_of = data[begin[low[d]] : begin[low[d + 1]] - int(ended)]
                    hashes[d].update(text_of)
                    if groups:
                        whole[d].append(bytes(text_of).decode())
                done += len(begin) - 1
            doc, pairs, links = linked(ids, last, owner, width, span)
            n_links = np.bincount(doc, links, m).astype(np.int64)
            counts = [np.diff(first[0]), np.diff(first[1]), np.bincount(owner, minlength=m), n_links]
            columns: list[pa.Array] = [part.column("__key")]
            for x in counts:
                filled = np.zeros(len(good), np.int64)
                filled[at] = x
                columns.append(pa.array(filled))
            for values in [[h.hexdigest() for h in hashes]] + [["".join(x) for x in whole]] * groups:
                filled = [""] * len(good)
                for k, v in zip(at.tolist(), values, strict=True):
                    filled[k] = v
                columns.append(pa.array(filled, pa.string()))
            each = np.zeros(len(good), np.int64)
            each[at] = np.bincount(doc, minlength=m)
            offsets = pa.array(np.concatenate([[0], np.cumsum(each)]).astype(np.int32))
            columns += [pa.ListArray.from_arrays(offsets, pa.array(pairs)), pa.ListArray.from_arrays(offsets, pa.array(links))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(col(key).alias("__key"), col(text).alias("__text")).mapInArrow(run, schema)


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair`` and ``n``, the number of documents that hold it linked, of every pair of the corpus."""
    return found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def blocks(counts: DataFrame, width: int, most: int) -> list[tuple[int, int]]:
    """Ranges of pairs at the borders of A ids, each of about ``most`` pairs; one number for each A id comes to the driver."""
    sizes = sorted(tuple(r) for r in counts.groupBy(F.floor(F.col("pair") / width).alias("a")).count().collect())
    out, low, total = [], 0, 0
    for a, n in sizes:
        if total and total + n > most:
            out.append((low, a * width))
            low, total = a * width, 0
        total += n
    return [*out, (low, 1 << 62)]


def counted(found: DataFrame, width: int, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Adds ``n_best`` and ``count_sum`` to the rows of ``aligned`` (written ones), from the counts of their pairs."""
    spark = found.sparkSession
    counts = cut(pair_counts(found), "pairs")
    kept = [c for c in found.columns if c not in ("pairs", "links")]
    numbered = found.withColumn("__row", F.monotonically_increasing_id())
    schema = T.StructType([*(f for f in numbered.schema if f.name in kept or f.name == "__row"), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    parts = []
    for low, high in blocks(counts, width, block_pairs):
        own = counts.filter((F.col("pair") >= low) & (F.col("pair") < high)).toPandas().sort_values("pair")  # a bounded number of pairs
        pairs, n = own["pair"].to_numpy(), own["n"].to_numpy()
        starts = np.flatnonzero(np.diff(pairs // width, prepend=-1)) if len(pairs) else np.zeros(0, np.int64)
        top = np.repeat(np.maximum.reduceat(n, starts), np.diff(np.append(starts, len(pairs)))) if len(pairs) else n
        shared = spark.sparkContext.broadcast((pairs, n, n == top))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            pairs, n, best = shared.value
            for b in batches:
                column = b.column("pairs")
                flat, links = column.flatten().to_numpy(), b.column("links").flatten().to_numpy()
                owner = np.repeat(np.arange(len(b)), pc.list_value_length(column).to_numpy(zero_copy_only=False))
                at = np.minimum(np.searchsorted(pairs, flat), max(len(pairs) - 1, 0))
                here = pairs[at] == flat if len(pairs) else np.zeros(len(flat), bool)
                owner, links, at = owner[here], links[here], at[here]
                n_best, total = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
                np.add.at(n_best, owner, links * best[at])
                np.add.at(total, owner, links * n[at])
                names = [c for c in b.schema.names if c not in ("pairs", "links")]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(n_best), pa.array(total)], [*names, "n_best", "count_sum"])

        parts.append(numbered.select(*kept, "__row", "pairs", "links").mapInArrow(run, T.StructType([schema[c] for c in [*kept, "__row", "n_best", "count_sum"]])))
    out = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            out = out.unionByName(p)
        out = out.groupBy("__row").agg(*(F.first(c).alias(c) for c in kept), F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return out.drop("__row")


def report(docs: DataFrame, text: str = "text", key: str = "doc_id", path_a: str | None = None, path_b: str | None = None, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """One row a document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import sentencepiece

    path_b = path_b or tokenizer_path("piece_bpe_32k.model")
    width = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    found = cut(aligned(docs, text, key, path_a, path_b), "aligned")
    return counted(found, width, block_pairs).select(F.col("__key").alias(key), *COUNTS, "n_best", "count_sum", "groups_sha256")
