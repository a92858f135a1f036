"""Best-fit packing of token pieces into sequences of a fixed capacity.

Linear grouping: the large lengths, from the longest down, are cut into groups
of about equally many pieces and rounded up to the longest of their group.  For
these few sizes the configurations (how many pieces of each size share a
sequence) and their uses are optimised by a linear program: those of a greedy way
enter first, then new ones, each the best knapsack at the prices so far.  Whole uses
are taken, and the actual pieces take the places of the rounded ones.  The few
pieces that the fractions leave over, as many sequences as there are groups at
most, are put together by exact subset sums of their own lengths.  Then the small
pieces are put by best fit into what is free.

All of this needs no more than how many pieces there are of each length, at
most as many numbers as the capacity, so it is planned on the driver from that
histogram.  The plan says for the r-th piece of a length which sequence and
offset it gets; Spark numbers the pieces of each length (salted, so that a
length that a large share of all pieces have is dealt over many tasks) and
looks their places up.

Defined cases: a null text is empty and has the end token alone; repeated rows
are packed as often as they occur; a text of any length is encoded whole by one task;
ties of length are broken by row number; an
empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm import textbatch as tb
from granary.llm.storage import cut
from granary.llm.tokens import Encoder

CAPACITY = 1024
END_ID = 2
#: Groups of large lengths, so sizes of the linear program.
GROUPS = 256
#: Columns made at most, and the gain of a column for which no more is made; any numbers give a valid plan.
COLUMNS, TOLERANCE = 100, 1e-3
#: Lengths over this share of the capacity are large.
LARGE = 1 / 8
UID = "__uid"
#: Pieces of one length that one task numbers, about.
SALT_ROWS = 1 << 21
#: Bytes of text encoded at once; words that come again are looked up once.
ENCODE_BYTES = 4 << 20


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """One row a piece: key, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``.

    A document's first piece takes what its full pieces leave over.
    """
    path = path or tokenizer_path()
    names = [key, "piece", "start", "length", "ids_crc32"] + ["ids"] * ids
    schema = T.StructType(
        [docs.schema[key], T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in names[2:5])]
        + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for part in tb.slices(batches, text, ENCODE_BYTES):
            bare, first = encoder.encode([x or "" for x in part.column(text).to_pylist()])
            sizes = np.diff(first) + 1
            flat = np.full(int(sizes.sum()), end_id, np.dtype("<u4"))
            begin = np.cumsum(sizes) - sizes
            flat[np.arange(len(bare)) + np.repeat(np.arange(len(sizes)), sizes - 1)] = bare
            n = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), n)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            lead = sizes - (n - 1) * capacity
            start = np.where(number > 0, lead[owner] + (number - 1) * capacity, 0)
            length = np.where(number > 0, capacity, lead[owner])
            low = begin[owner] + start
            body = memoryview(flat.tobytes())
            crc = [zlib.crc32(body[4 * a : 4 * b]) for a, b in zip(low.tolist(), (low + length).tolist(), strict=True)]
            columns = [part.column(key).take(pa.array(owner)), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([low, [len(flat)]]).astype(np.int32)), pa.array(flat.view(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(*dict.fromkeys([key, text])).mapInArrow(run, schema)


@dataclass
class Plan:
    """Where the pieces of each length go.

    A run (length, rank, count, sequence, offset): the pieces of that length
    ranked from ``rank`` on go to successive sequences, each at ``offset``.
    """

    capacity: int
    sequences: int = 0
    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    gaps: dict[int, list[tuple[int, int]]] = field(default_factory=dict)  # free tokens: (first sequence, count)

    def gap(self, free: int, first: int, count: int) -> None:
        if free > 0 and count > 0:
            self.gaps.setdefault(free, []).append((first, count))


def _fullest(room: int, sizes: list[int], left: list[int]) -> list[int]:
    """Indices of sizes that fill ``room`` best, each no more often than it is left; larger sizes first."""
    reach, stages = 1, []
    mask = (1 << (room + 1)) - 1
    for g in range(len(sizes) - 1, -1, -1):  # sizes fall, so the smallest goes first
        size, most = sizes[g], min(left[g], room // sizes[g])
        step = 1
        while most > 0:
            step = min(step, most)
            stages.append((g, step, reach))
            reach |= (reach << (size * step)) & mask
            most -= step
            step *= 2
    at = reach.bit_length() - 1
    taken = []
    for g, step, before in reversed(stages):
        if not before >> at & 1:
            taken += [g] * step
            at -= sizes[g] * step
    return taken


def _knapsack(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size fill the capacity with the largest price."""
    best, took = np.zeros(capacity + 1), []
    for g in np.flatnonzero(prices > 1e-12).tolist():
        step, most = 1, capacity // int(sizes[g])
        while most > 0:
            step = min(step, most)
            room = step * int(sizes[g])
            better = best[:-room] + step * prices[g] > best[room:] + 1e-12
            then = best.copy()
            then[room:][better] = best[:-room][better] + step * prices[g]
            best = then
            took.append((g, step, room, better))
            most -= step
            step *= 2
    counts, at = np.zeros(len(sizes), np.int64), capacity
    for g, step, room, better in reversed(took):
        if at >= room and better[at - room]:
            counts[g] += step
            at -= room
    return counts


def _greedy(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations one after another, each the fullest that holds the largest size left, and their uses."""
    left, out = list(demand), []
    while alive := [g for g in range(len(sizes)) if left[g]]:
        g = alive[0]
        left[g] -= 1
        chosen = [g, *(alive[k] for k in _fullest(capacity - sizes[g], [sizes[a] for a in alive], [left[a] for a in alive]))]
        left[g] += 1
        counts = np.bincount(chosen, minlength=len(sizes))
        times = min(left[c] // int(counts[c]) for c in set(chosen))
        for c in set(chosen):
            left[c] -= times * int(counts[c])
        out.append((counts, times))
    return out


def optimised(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Configurations (how many of each size) and whole uses of them, by column generation; what they leave over is less than a use each.

    The configurations of the greedy way are priced first, then the best ones of all.
    """
    size, need = np.array(sizes, np.int64), np.array(demand, float)
    if not len(size):
        return []
    pool = np.array([counts for counts, _ in _greedy(sizes, demand, capacity)], float)
    basis = np.diag((capacity // size).astype(float))
    uses, made = need / np.diag(basis), 0
    while made <= COLUMNS:
        prices = np.linalg.solve(basis.T, np.ones(len(size)))
        column = pool[np.argmax(pool @ prices)]
        if prices @ column <= 1 + TOLERANCE:
            column, made = _knapsack(prices, size, capacity).astype(float), made + 1
        if prices @ column <= 1 + TOLERANCE:
            break
        turn = np.linalg.solve(basis, column)
        steps = np.where(turn > 1e-9, uses / np.where(turn > 1e-9, turn, 1), np.inf)
        leaves = int(np.argmin(steps))
        if not np.isfinite(steps[leaves]):
            break
        basis[:, leaves] = column
        uses = np.maximum(np.linalg.solve(basis, need), 0)
    whole = np.floor(uses + 1e-9).astype(np.int64)
    while len(over := np.flatnonzero(basis.astype(np.int64) @ whole > need)):  # rounding errors only
        whole[np.flatnonzero(basis[over[0]] > 0)[np.argmax(whole[basis[over[0]] > 0])]] -= 1
    return [(basis[:, k].astype(np.int64).tolist(), int(n)) for k, n in enumerate(whole) if n > 0]


def _taken(queue: list[list[int]], need: int) -> list[tuple[int, int, int]]:
    """The first ``need`` pieces of a queue of [length, rank, count]."""
    slot = []
    while need:
        head = queue[0]
        n = min(need, head[2])
        slot.append((head[0], head[1], n))
        head[1] += n
        head[2] -= n
        need -= n
        if not head[2]:
            queue.pop(0)
    return slot


def _configurations(p: Plan, sizes: list[int], queues: list[list[list[int]]]) -> None:
    """Fills new sequences with all that is queued; sizes fall, queues hold [length, rank, count]."""
    for counts, times in _greedy(sizes, [sum(x[2] for x in q) for q in queues], p.capacity):
        _substituted(p, [_taken(queues[g], times) for g in np.flatnonzero(counts).tolist() for _ in range(int(counts[g]))], times)


def _substituted(p: Plan, slots: list[list[tuple[int, int, int]]], times: int) -> None:
    """Puts the actual pieces of each slot into ``times`` new sequences."""
    edges = {0, times}
    for slot in slots:
        at = 0
        for _, _, n in slot:
            at += n
            edges.add(at)
    marks = sorted(edges)
    heads = [[0, 0] for _ in slots]  # part of the slot, used of it
    for low, high in zip(marks, marks[1:], strict=False):
        offset = 0
        for slot, head in zip(slots, heads, strict=True):
            length, rank, n = slot[head[0]]
            p.runs.append((length, rank + head[1], high - low, p.sequences + low, offset))
            offset += length
            head[1] += high - low
            if head[1] == n:
                head[:] = [head[0] + 1, 0]
        p.gap(p.capacity - offset, p.sequences + low, high - low)
    p.sequences += times


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE) -> Plan:
    """Places for ``histogram[length]`` pieces of each length below the capacity."""
    p = Plan(capacity)
    lengths = sorted((n for n in histogram if histogram[n]), reverse=True)
    big = [n for n in lengths if n > capacity * large]
    total = sum(histogram[n] for n in big)
    sizes, queues, seen, last = [], [], 0, -1
    for n in big:
        group = seen * groups // total
        if group != last:
            sizes.append(n)
            queues.append([])
            last = group
        queues[-1].append([n, 0, histogram[n]])
        seen += histogram[n]
    for counts, times in optimised(sizes, [sum(x[2] for x in q) for q in queues], capacity):
        _substituted(p, [_taken(queues[g], times) for g, n in enumerate(counts) for _ in range(n)], times)
    over = [x for q in queues for x in q]
    _configurations(p, [x[0] for x in over], [[x] for x in over])
    rest = []
    for n in lengths[len(big) :]:
        rank, left = 0, histogram[n]
        while left and (fits := [g for g in p.gaps if g >= n]):
            free = min(fits)
            first, count = p.gaps[free].pop()
            if not p.gaps[free]:
                del p.gaps[free]
            use = min(count, left)
            p.runs.append((n, rank, use, first, capacity - free))
            p.gap(free - n, first, use)
            p.gap(free, first + use, count - use)
            rank, left = rank + use, left - use
        if left:
            rest.append([n, rank, left])
    _configurations(p, [x[0] for x in rest], [[x] for x in rest])
    return p


def _ranked(found: DataFrame, total: int) -> DataFrame:
    """Adds ``rank``, from 0 within each length."""
    salts = 16 + total // SALT_ROWS
    salted = found.withColumn("salt", F.pmod(F.xxhash64(UID), F.lit(salts)))
    ranked = salted.withColumn("own", F.row_number().over(Window.partitionBy("length", "salt").orderBy(UID)) - 1)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy("length", "salt").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    return ranked.join(counts, ["length", "salt"]).withColumn("rank", F.col("own") + F.col("before")).drop("own", "before", "salt")


def _placed(ranked: DataFrame, p: Plan) -> DataFrame:
    """Looks the places of ranked pieces up; the plan's runs are broadcast, bounded by the capacity."""
    order = np.array(sorted(p.runs), np.int64).reshape(-1, 5)
    runs = ranked.sparkSession.sparkContext.broadcast(order)
    schema = T.StructType([f for f in ranked.schema if f.name != "rank"] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = runs.value
        keys = (table[:, 0] << 44) + table[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            places = [pa.array(table[at, 3] + rank - table[at, 1]), pa.array(table[at, 4])]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names[:-2]), *places], names)

    return ranked.mapInArrow(run, schema)


def assigned(found: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have been cut off with a ``__uid`` each."""
    histogram = {int(n): int(c) for n, c in found.groupBy("length").count().collect()}  # bounded by the capacity
    histogram.pop(capacity, None)
    p = plan(histogram, capacity, groups)
    own = found.filter(F.col("length") == capacity).withColumns({"sequence_id": F.col(UID) + F.lit(p.sequences).cast("long"), "offset": F.lit(0).cast("long")})
    if not histogram:
        return own
    return own.unionByName(_placed(_ranked(found.filter(F.col("length") < capacity), sum(histogram.values())), p))


def packed(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Where each piece goes: key, piece, start, length, ids_crc32, sequence_id, offset."""
    found = cut(pieces(docs, text, key, path, capacity, end_id).withColumn(UID, F.monotonically_increasing_id()), "pieces")
    return assigned(found, capacity).select(key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``input_ids`` and the lengths of the pieces in them."""
    found = cut(pieces(docs, text, key, path, capacity, end_id, ids=True).withColumn(UID, F.monotonically_increasing_id()), "pieces")
    places = assigned(found.drop("ids"), capacity).select(UID, "sequence_id", "offset")
    rows = found.select(UID, "ids", "length").join(places, UID)
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return rows.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.flatten("parts.ids").alias("input_ids"), F.col("parts.length").alias("lengths"))


