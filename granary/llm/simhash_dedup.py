"""SimHash near-duplicates: 64-bit fingerprints linked at a few differing bits.

Fingerprints come from the XXH64 (seed 42) of word shingles, repeats included.
The self-join walks a binary trie of the distinct fingerprints: two nodes of
one depth are visited together with the number of bits in which their paths
differ, and a pair is given up as soon as that exceeds the budget.  The work is
dealt out over the cluster by the pigeonhole principle: with 3 differing bits
at most, two fingerprints agree in one of four 16-bit blocks, so each block's
value names a trie whose first 16 levels allow no difference.  What leaves a
task is a spanning star of each group it found, not all pairs of a group.

Defined cases: null, empty and all-white texts have no words and the
fingerprint zero, and are linked like any other; a text of fewer words than a
shingle is one shingle; repeated rows have equal fingerprints and so one
component, whose id is its smallest non-null key (null if it has none); an
empty table gives an empty result; a text of any length is a row held whole by one
task; further columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm import textbatch as tb
from granary.llm.components import components
from granary.llm.storage import by_number, col, cut, free_name

SHINGLE = 3
BUDGET = 3
BLOCKS = 4
SEED = 42
#: Pairs of nodes of at most so many fingerprints are compared at once.
LEAF_PAIRS = 64
FRONTIER = 1 << 19
#: Dropped rows are broadcast up to this number of 8-byte ids, else joined by a shuffle.
BROADCAST_ROWS = 2_000_000

_LANES = np.zeros(256, np.uint64)
for _bit in range(8):
    _LANES |= ((np.arange(256, dtype=np.uint64) >> np.uint64(_bit)) & np.uint64(1)) << np.uint64(8 * _bit)


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each group ``first[i]:first[i + 1]`` the bits set in over half of its hashes.

    Eight bit counts at a time are added in one 64-bit word of 8-bit lanes, in
    runs of 255 at most, so that no lane overflows.
    """
    groups = len(first) - 1
    n = np.diff(first)
    out = np.zeros(groups, np.uint64)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    runs = -(-n[some] // 255)
    owner = np.repeat(np.arange(len(some)), runs)
    begin = np.cumsum(runs) - runs
    start = first[some][owner] + 255 * (np.arange(len(owner)) - begin[owner])
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        lanes = np.add.reduceat(_LANES[octets[:, byte]], start)
        each = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), begin, axis=0)
        over = 2 * each > n[some][:, None]
        out[some] |= (over.astype(np.uint64) << (np.arange(8, dtype=np.uint64) + np.uint64(8 * byte))).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(found: tb.Texts, shingle: int = SHINGLE) -> np.ndarray:
    """A 64-bit fingerprint of each text."""
    data = tb.LOWER[found.data]
    data[tb.WHITE[data]] = 0x20
    words = tb.spans(found, tb.WHITE)
    first = words.first_of(len(found))
    n = np.diff(first)
    windows = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    begin = np.concatenate([[0], np.cumsum(windows)])
    owner = np.repeat(np.arange(len(found)), windows)
    low = first[:-1][owner] + np.arange(begin[-1]) - begin[:-1][owner]
    high = low + np.minimum(n, shingle)[owner] - 1
    a, b = words.start[low], words.end[high]
    chars = np.concatenate([[0], np.cumsum(words.end - words.start)])
    loose = np.flatnonzero(b - a != chars[high + 1] - chars[low] + high - low)
    whole, digest = data.tobytes(), xxhash.xxh64_intdigest
    out = np.array([digest(whole[i:j], SEED) for i, j in zip(a.tolist(), b.tolist(), strict=True)], np.uint64)
    for k in loose.tolist():  # more than one white character between words
        out[k] = digest(b" ".join(whole[a[k] : b[k]].split()), SEED)
    return majority(out, begin)


def trie_pairs(keys: np.ndarray, level: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted distinct 64-bit keys that differ in ``budget`` bits at most.

    The keys' first ``level`` bits must agree; below, pairs of trie nodes are
    walked together.  A node is a stretch of the sorted keys.
    """
    top = keys >> np.uint64(64 - level) if level else np.zeros(len(keys), np.uint64)
    edge = np.flatnonzero(np.diff(top)) + 1
    low, high = np.concatenate([[0], edge]), np.concatenate([edge, [len(keys)]])
    many = high - low > 1
    stack = [(low[many], high[many], low[many], high[many], np.zeros(int(many.sum()), np.int8), level)]
    while stack:
        a0, a1, b0, b1, spent, depth = stack.pop()
        if not len(a0):
            continue
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack += [(*(x[half:] for x in (a0, a1, b0, b1, spent)), depth), (*(x[:half] for x in (a0, a1, b0, b1, spent)), depth)]
            continue
        size = (a1 - a0) * (b1 - b0)
        small = (size <= LEAF_PAIRS) | (depth == 64)
        if small.any():
            n = size[small]
            which = np.repeat(np.flatnonzero(small), n)
            at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            wide = (b1 - b0)[which]
            i, j = a0[which] + at // wide, b0[which] + at % wide
            good = (np.bitwise_count(keys[i] ^ keys[j]) <= budget) & (i < j)
            yield i[good], j[good]
        rest = ~small
        if not rest.any():
            continue
        a0, a1, b0, b1, spent = (x[rest] for x in (a0, a1, b0, b1, spent))
        bit = np.uint64(63 - depth)

        def middle(low: np.ndarray, high: np.ndarray, bit: np.uint64 = bit) -> np.ndarray:
            return np.clip(np.searchsorted(keys, ((keys[low] >> bit) | np.uint64(1)) << bit), low, high)

        am, bm, same = middle(a0, a1), middle(b0, b1), a0 == b0
        apart = ~same
        children = [
            (a0, am, b0, bm, spent),
            (am, a1, bm, b1, spent),
            (a0, am, bm, b1, spent + 1),
            *([tuple(x[apart] for x in (am, a1, b0, bm, spent + 1))] if apart.any() else []),
        ]
        pairs = [np.concatenate(x) for x in zip(*children, strict=True)]
        left = (pairs[1] > pairs[0]) & (pairs[3] > pairs[2]) & (pairs[4] <= budget) & ((pairs[0] != pairs[2]) | (pairs[1] - pairs[0] > 1))
        stack.append((*(x[left] for x in pairs), depth + 1))


class Groups:
    """Groups of numbers 0 to n - 1 that grow by pairs."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            if not len(i):
                return
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (up := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = up


def links(prints: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints (column ``fp``) that join all that are near.

    A task holds the fingerprints of the block values dealt to it, 8 bytes each.
    """
    if not 0 <= budget < BLOCKS:
        raise ValueError(f"four blocks find up to {BLOCKS - 1} differing bits")
    turned = prints.select(
        "fp", F.explode(F.array(*(F.struct(F.lit(b).alias("block"), (F.col("fp") if not b else F.shiftleft("fp", 16 * b).bitwiseOR(F.shiftrightunsigned("fp", 64 - 16 * b))).alias("turned")) for b in range(BLOCKS)))).alias("x")
    ).select("x.block", "x.turned", F.shiftrightunsigned("x.turned", 48).alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not rows:
            return
        block, key = (np.concatenate(x) for x in zip(*rows, strict=True))
        key = key.view(np.uint64)
        for k in range(BLOCKS):
            own = np.unique(key[block == k])
            groups = Groups(len(own))
            for i, j in trie_pairs(own, 16, budget):
                groups.add(i, j)
            hung = np.flatnonzero(groups.root != np.arange(len(own)))
            back = np.uint64(64 - 16 * k)
            whole = own if not k else (own << back) | (own >> np.uint64(16 * k))
            whole = whole.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(whole[hung]), pa.array(whole[groups.root[hung]])], ["a", "b"])

    return turned.repartition("block", "value").select("block", "turned").mapInArrow(run, "a long, b long")


def _fingerprinted(docs: DataFrame, text: str, keep: list[str], name: str = "fp") -> DataFrame:
    needed = [*dict.fromkeys([*keep, text])]
    plain, own, n = by_number(docs.select(*map(col, needed))), f"c{needed.index(text)}", len(keep)
    schema = T.StructType([*plain.schema[:n], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tb.slices(batches, own):
            fp = fingerprints(tb.texts(part.column(own)))
            yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(fp.view(np.int64))], schema.names)

    return plain.mapInArrow(run, schema).toDF(*keep, name)


def _classes(rows: DataFrame, budget: int) -> DataFrame:
    """``fp``, the least fingerprint (``root``) and the least ``key`` (``component``) of its component.

    All sides of the joins are tables that are written first, so that Spark can split a giant component.
    """
    prints = cut(rows.groupBy("fp").agg(F.min("key").alias("least")), "prints")
    linked = cut(components(links(prints, budget)).withColumnRenamed("node", "fp").join(prints, "fp"), "linked")
    least = cut(linked.groupBy("root").agg(F.min("least").alias("component")), "least")
    linked = linked.join(least, "root").select("fp", "root", "component")
    return prints.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component")).alias("component"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", budget: int = BUDGET) -> DataFrame:
    """One row a document: key, ``fingerprint`` (16 hex digits) and ``component_id``."""
    rows = cut(_fingerprinted(docs.select(col(key).alias("key"), col(text).alias("text")), "text", ["key"]), "fingerprints")
    # written first, so that both sides of the join are dealt by fingerprint just for it and Spark can split a hot one
    classes = cut(_classes(rows, budget), "components")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(classes, "fp").select(F.col("key").alias(key), digits.alias("fingerprint"), F.col("component").alias("component_id"))


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id", budget: int = BUDGET) -> DataFrame:
    """The rows of ``docs`` with one row of each component: that of its smallest key.

    Of several rows with that key one stays.  The texts are written once, with
    a row number of their own; the rows that go are few and are broadcast up to
    a checked number, beyond it joined by a shuffle.
    """
    uid, fp = free_name(docs, "__uid"), free_name(docs, "__fp")
    whole = cut(_fingerprinted(docs, text, docs.columns, fp).withColumn(uid, F.monotonically_increasing_id()), "documents")
    rows = whole.select(F.col(uid).alias("uid"), col(key).alias("key"), F.col(fp).alias("fp"))
    known = cut(_classes(rows, budget), "components")
    classes = cut(rows.join(known, "fp").select("uid", "key", "root"), "classes")
    best = classes.groupBy("root").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "uid")).alias("best"))
    stay = best.select("best.uid")
    gone = cut(classes.select("uid").join(stay, "uid", "left_anti").select(F.col("uid").alias(uid)), "dropped")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return whole.join(gone, uid, "left_anti").select(*(col(c) for c in docs.columns))
