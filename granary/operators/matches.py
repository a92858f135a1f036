"""Maximal exact matches of sequences with a reference in blocks.

Seeds are minimizers: of each ``least - k + 1`` successive k-mers the one of least hash.
Two sequences with ``least`` equal letters in a row choose the same one there, so every
match of that length has a seed on its diagonal, and a few letters in a hundred are seeds.
Bits of the sequences' seeds go to all tasks, so that few others of the reference leave
theirs.  Seeds are joined by their hash, those of a frequent one dealt over salts; what is
left are distinct diagonals.  Along each of these a sequence is held against the window of
the reference that it covers, once, and its runs of equal letters are the matches; blocks
of the reference in which no diagonal begins stay where they are, again by bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators.arrow import lists, with_arrays
from granary.operators.reference import BLOCK, lengthened

#: Places of one seed in the reference that go to one salt, about.
SALT_PLACES = 4096
#: Bits that say which seeds, or which blocks, are wanted; what they let through in error falls away in a join.
WANTED_BITS = 24
_ODD = np.uint64(0x9E3779B97F4A7C15)


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all strings in a row, and where each begins (one more number than strings)."""
    texts = [x or "" for x in column.to_pylist()]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), np.concatenate([[0], np.cumsum(sizes)])


def minimizers(code: np.ndarray, first: np.ndarray, k: int, least: int, unknown: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chosen k-mers: hash, whose, and place; none that holds the unknown letter."""
    n = len(code) - k + 1
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    if n <= 0:
        return none
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = (h ^ code[i : i + n].astype(np.uint64)) * _ODD
        h ^= h >> np.uint64(29)
    owner = np.searchsorted(first, np.arange(len(code)), side="right") - 1
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    bad = np.zeros(n, bool)
    if unknown is not None:
        seen = np.concatenate([[0], np.cumsum(code == ord(unknown))])
        bad |= seen[k : k + n] > seen[:n]
    h = np.where(bad, top, h)
    w = least - k + 1
    windows = n - w + 1
    if windows <= 0:
        return none
    low, at = h[:windows].copy(), np.arange(windows)
    for s in range(1, w):  # of equal ones the last
        less = h[s : s + windows] <= low
        low, at = np.where(less, h[s : s + windows], low), np.where(less, np.arange(s, s + windows), at)
    whole = (owner[:windows] == owner[least - 1 : least - 1 + windows]) & (low != top)
    at = np.unique(at[whole])
    return h[at], owner[at], at - first[owner[at]]


def _bits(numbers: DataFrame) -> np.ndarray:
    """Eight to a byte, the bits of the numbers below 2 ** WANTED_BITS in the one column of ``numbers``."""
    bits = np.zeros(1 << WANTED_BITS, bool)
    bits[numbers.toDF("bit").distinct().toArrow().column(0).to_numpy()] = True  # bounded by the number of bits
    return np.packbits(bits)


def _is_set(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def with_key_in(df: DataFrame, key: list[str], few: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` is one of those of ``few``, and perhaps a few more; none is shuffled."""
    bit = F.xxhash64(*key).bitwiseAND(F.lit((1 << WANTED_BITS) - 1)).cast("int")
    shared = df.sparkSession.sparkContext.broadcast(_bits(few.select(bit)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_is_set(shared.value, batch.column("__bit").to_numpy())))

    keyed = df.withColumn("__bit", bit)
    return keyed.mapInArrow(run, keyed.schema).drop("__bit")


def seeds(df: DataFrame, text: str, k: int, least: int, unknown: str | None, inner: int | None = None, among: DataFrame | None = None) -> DataFrame:
    """The other columns, ``seed`` and ``at`` of the minimizers of each string; of its first ``inner`` places' windows only, if given.

    ``among``: with ``seed``; of other seeds only few are returned, none that is there is left out.
    """
    wanted = None
    if among is not None:
        wanted = df.sparkSession.sparkContext.broadcast(_bits(among.select(F.shiftrightunsigned("seed", 64 - WANTED_BITS).cast("int"))))
    fields = T.StructType([T.StructField("seed", T.LongType()), T.StructField("at", T.LongType())])

    def work(c: dict[str, pa.Array]) -> list[pa.Array]:
        code, first = letters(c[text])
        if inner is not None:  # windows that begin in the block; the letters behind it belong to the next one's
            keep = np.minimum(np.diff(first), inner + least - 1)
            code = code[np.repeat(first[:-1] - (np.cumsum(keep) - keep), keep) + np.arange(int(keep.sum()))]
            first = np.concatenate([[0], np.cumsum(keep)])
        seed, owner, at = minimizers(code, first, k, least, unknown)
        if wanted is not None:
            some = _is_set(wanted.value, (seed >> np.uint64(64 - WANTED_BITS)).astype(np.int64))
            seed, owner, at = seed[some], owner[some], at[some]
        return [lists(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(c[text])))]), ("seed", pa.array(seed.view(np.int64))), ("at", pa.array(at)))]

    others = [x for x in df.columns if x != text]
    found = with_arrays(df, [T.StructField("__seeds", T.ArrayType(fields))], work, 256)
    return found.select(*others, F.inline("__seeds"))


def maximal(reads: DataFrame, reference: DataFrame | Callable[[int], DataFrame], key: str, seq: str, least: int = 20, k: int = 12, size: int = BLOCK, unknown: str | None = "N", salt_places: int = SALT_PLACES) -> DataFrame:
    """All matches of ``least`` letters or more that can't be longer: key, ``contig``, ``read_start``, ``ref_start``, ``length``.

    ``reference`` has contig, block and seq (see ``reference.blocks``), or is what gives blocks
    with so many more letters from behind them; where contigs lie whole in rows, that takes no
    shuffle.  Each read (rows of one key are one read each) is cut off nowhere: windows are as
    long as the longest read.  The unknown letter is equal to nothing.  Null reads and those
    shorter than ``least`` have no matches.
    """
    if not 0 < k <= least:
        raise ValueError("seeds are no longer than the least match")
    longer = reference if callable(reference) else lambda over: lengthened(reference, over, size)
    # reads go by a hash on the way: two of one hash would be held against each other's diagonals too, which gives right matches all the same
    rows = reads.select(F.col(key).alias("__key"), F.col(seq).alias("__read")).filter(F.length(seq) >= least).distinct().withColumn("__id", F.xxhash64("__key", "__read"))
    longest = rows.agg(F.coalesce(F.max(F.length("__read")), F.lit(0))).first()[0]
    own = seeds(rows.select("__id", "__read"), "__read", k, least, unknown).withColumnRenamed("at", "read_at")
    found = seeds(longer(least), "seq", k, least, unknown, size, own)
    index = found.select("seed", "contig", (F.col("block") * size + F.col("at")).alias("place")).persist()  # counted, then joined
    # a frequent seed's places are dealt over salts, and its reads' places go to each of them
    frequent = index.groupBy("seed").agg(F.ceil(F.count("*") / salt_places).cast("int").alias("salts")).filter("salts > 1")
    dealt = index.join(frequent, "seed", "left").withColumn("salt", F.pmod(F.xxhash64("contig", "place"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    spread = own.join(frequent, "seed", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    on = spread.join(dealt, ["seed", "salt"]).select("__id", "contig", (F.col("place") - F.col("read_at")).alias("diagonal")).distinct()
    # a window begins in this block, which is longer by the longest read
    diagonals = on.withColumn("block", F.floor(F.greatest("diagonal", F.lit(0).cast("long")) / size).cast("long")).persist()
    blocks = with_key_in(longer(max(longest, 1)).select("contig", F.col("block").cast("long").alias("block"), "seq"), ["contig", "block"], diagonals)
    met = diagonals.join(blocks, ["contig", "block"]).join(rows, "__id")
    low = F.greatest("diagonal", F.lit(0).cast("long"))
    window = F.substr("seq", (low - F.col("block") * size + 1).cast("int"), (F.col("diagonal") + F.length("__read") - low).cast("int"))
    seen = met.select("__key", "__read", "contig", "diagonal", window.alias("__ref"))
    run = T.StructType([T.StructField("read_start", T.LongType()), T.StructField("length", T.LongType())])

    def work(c: dict[str, pa.Array]) -> list[pa.Array]:
        read, first = letters(c["__read"])
        ref, begin = letters(c["__ref"])
        skip = np.maximum(-c["diagonal"].to_numpy(), 0)  # a read can begin before its contig
        n = np.minimum(np.diff(begin), np.maximum(np.diff(first) - skip, 0))
        owner = np.repeat(np.arange(len(n)), n)
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        a, b = read[first[owner] + skip[owner] + inner], ref[begin[owner] + inner]
        equal = a == b
        if unknown is not None:
            equal &= a != ord(unknown)
        edge = np.concatenate([[True], owner[1:] != owner[:-1]])
        starts = np.flatnonzero(equal & (edge | np.concatenate([[True], ~equal[:-1]])))
        ends = np.flatnonzero(equal & np.concatenate([edge[1:] | ~equal[1:], [True]]))
        good = ends - starts + 1 >= least
        starts, ends = starts[good], ends[good]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[starts], minlength=len(n)))])
        return [lists(offsets, ("read_start", pa.array(inner[starts] + skip[owner[starts]])), ("length", pa.array(ends - starts + 1)))]

    found = with_arrays(seen, [T.StructField("__runs", T.ArrayType(run))], work, 512).select("__key", "contig", "diagonal", F.inline("__runs"))
    return found.select(F.col("__key").alias(key), "contig", "read_start", (F.col("read_start") + F.col("diagonal")).alias("ref_start"), "length")


def text_blocks(df: DataFrame, key: str, text: str, size: int = BLOCK, over: int = 0) -> DataFrame:
    """Texts as contigs in blocks: contig, block, seq; with ``over`` more letters from behind them."""
    count = F.floor((F.greatest(F.length(text), F.lit(1)) - 1) / size).cast("int")
    x = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("contig"), F.col(text).alias("__text"), F.explode(F.sequence(F.lit(0), count)).alias("b"))
    return x.select("contig", F.col("b").cast("long").alias("block"), F.substr("__text", F.col("b") * size + 1, F.lit(size + over)).alias("seq"))
