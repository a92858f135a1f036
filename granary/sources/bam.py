"""BAM files as a Spark data source: split by compressed ranges, pruned by region, decoded in Arrow batches.

A file is a row of BGZF blocks, each deflated by itself, so any range of bytes can be read
from its first block on.  Records stand behind one another in the inflated bytes, over the
borders of blocks; a task finds its first one by trying places until a chain of records makes
sense, and reads on beyond its range until its last one is whole.  So every record is read by
the task in whose range the block lies in which it begins.

Of a file sorted by coordinate, a region leaves only the ranges that can hold it: the ranges'
first records are found by bisection.  Columns that are not
asked for (option ``columns``) are not decoded.  Paths go to pyarrow's file systems: local
ones, and those that its build knows (hdfs, s3, gs).
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from granary.functions.cigars import spread, strings
from granary.functions.sequence import cigar_length, cigar_ops

MAGIC = b"\x1f\x8b\x08\x04"
BASES = np.frombuffer(b"=ACMGRSVTWYHKDBN", np.uint8)
OPS = np.frombuffer(b"MIDNSHP=X", np.uint8)
#: Compressed bytes of a task, inflated bytes decoded together, records that must follow in a chain, bytes of a record at most.
RANGE, CHUNK, CHAIN, LARGEST = 32 << 20, 4 << 20, 6, 1 << 28
SCHEMA = T.StructType(
    [
        T.StructField("read_id", T.StringType()),
        T.StructField("flag", T.IntegerType()),
        T.StructField("contig", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("mapq", T.IntegerType()),
        T.StructField("cigar", T.StringType()),
        T.StructField("mate_contig", T.StringType()),
        T.StructField("mate_start", T.LongType()),
        T.StructField("template", T.IntegerType()),
        T.StructField("seq", T.StringType()),
        T.StructField("qual", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)
_SIZE = {c: n for n, some in ((1, b"AcC"), (2, b"sS"), (4, b"iIf")) for c in some}
_TYPE = {ord(c): d for c, d in zip("cCsSiIf", ("<i1", "<u1", "<i2", "<u2", "<i4", "<u4", "<f4"), strict=True)}


def _open(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        system, path = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    else:
        system = fs.LocalFileSystem()
    return system.open_input_file(path)


def block_size(data: bytes, at: int) -> int | None:
    """Bytes of the compressed block at a place, none if there is no block (or not all of its head)."""
    if data[at : at + 4] != MAGIC or at + 18 > len(data):
        return None
    extra, at_extra = struct.unpack_from("<H", data, at + 10)[0], at + 12
    end = at_extra + extra
    while at_extra + 6 <= min(end, len(data)):
        kind, size = data[at_extra : at_extra + 2], struct.unpack_from("<H", data, at_extra + 2)[0]
        if kind == b"BC" and size == 2:
            return struct.unpack_from("<H", data, at_extra + 4)[0] + 1
        at_extra += 4 + size
    return None


def inflated(f, start: int, size: int) -> Iterator[tuple[int, bytes]]:
    """Place and inflated bytes of each block that begins at or behind ``start``."""
    f.seek(start)
    data, base = f.read(1 << 20), start
    at = 0
    if start:  # a block's first bytes can occur within another one: the next block must follow
        while True:
            at = data.find(MAGIC, at)
            if at < 0:
                return
            n = block_size(data, at)
            if n is not None and (base + at + n >= size or (at + n + 18 <= len(data) and block_size(data, at + n) is not None)):
                break
            at += 1
    while base + at < size:
        n = block_size(data, at)
        if n is None or at + n > len(data):
            more = f.read(max(1 << 20, n or 0))
            if not more:
                if n is None and at < len(data):
                    raise ValueError(f"no BGZF block at byte {base + at}")
                raise ValueError(f"the file ends within the block at byte {base + at}")
            data, base, at = data[at:] + more, base + at, 0
            continue
        extra = struct.unpack_from("<H", data, at + 10)[0]
        body = zlib.decompress(data[at + 12 + extra : at + n - 8], -15)
        if len(body) != struct.unpack_from("<I", data, at + n - 4)[0]:
            raise ValueError(f"the block at byte {base + at} is damaged")
        yield base + at, body
        at += n


@dataclass
class Header:
    text: str
    contigs: list[tuple[str, int]]
    size: int
    #: Inflated bytes before the first record.
    length: int

    @property
    def ordered(self) -> bool:
        return "\tSO:coordinate" in self.text.split("\n", 1)[0]


def header(path: str) -> Header:
    with _open(path) as f:
        size, data = f.size(), b""
        for _, body in inflated(f, 0, size):
            data += body
            found = _header(data, size)
            if found:
                return found
    raise ValueError(f"{path} has no BAM header")


def _header(data: bytes, size: int) -> Header | None:
    if len(data) >= 4 and data[:4] != b"BAM\x01":
        raise ValueError("no BAM file")
    try:
        n = struct.unpack_from("<i", data, 4)[0]
        text, at = data[8 : 8 + n].rstrip(b"\0").decode(), 8 + n
        count = struct.unpack_from("<i", data, at)[0]
        at, contigs = at + 4, []
        for _ in range(count):
            k = struct.unpack_from("<i", data, at)[0]
            contigs.append((data[at + 4 : at + 3 + k].decode(), struct.unpack_from("<i", data, at + 4 + k)[0]))
            at += 8 + k
    except struct.error:
        return None  # goes on in the next block
    return Header(text, contigs, size, at) if at <= len(data) else None


def _likely(data: bytes, at: int, contigs: int, chain: int = CHAIN) -> bool:
    """Whether records stand at a place and behind it, as far as the bytes go."""
    for _ in range(chain):
        if at + 36 > len(data):
            return True
        size, ref, pos, name, _, _, ops, _, seq, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
        if not (-1 <= ref < contigs and -1 <= mate < contigs and pos >= -1 and mate_pos >= -1 and name and seq >= 0 and 32 + name + 4 * ops + (seq + 1) // 2 + seq <= size <= LARGEST):
            return False
        called = data[at + 36 : at + 36 + name]
        if len(called) == name and (called[-1] or not all(33 <= c <= 126 for c in called[:-1])):
            return False
        at += 4 + size
    return True


def _first_record(data: bytes, contigs: int) -> int:
    """Where the first record begins, -1 if nowhere with all of its fixed part."""
    return next((at for at in range(len(data) - 35) if _likely(data, at, contigs)), -1)


def records(f, head: Header, low: int, high: int) -> Iterator[tuple[bytes, list[int]]]:
    """Inflated bytes and where in them records begin, of all records that begin in blocks of the range."""
    blocks = inflated(f, low, head.size)
    data, begins = b"", []  # begins: (place in data, place of the block)
    started = False
    for place, body in blocks:
        if place >= high and (not started or not data):
            return
        begins.append((len(data), place))
        data += body
        if not started:
            at = head.length if low == 0 else _first_record(data, len(head.contigs))
            if low == 0 and len(data) < at:
                continue
            if low and (at < 0 or len(data) < min(at + (1 << 16), len(data) + 1) - 1):
                continue
            # a record that begins in a block behind the range is another task's
            if next(p for b, p in reversed(begins) if b <= at) >= high:
                return
            data, started = data[at:], True
            begins = [(max(b - at, 0), p) for b, p in begins]
        if len(data) < CHUNK and place < high:
            continue
        found, at = [], 0
        while at + 4 <= len(data):
            if next((p for b, p in reversed(begins) if b <= at), 0) >= high:
                if found:
                    yield data, found
                return
            size = struct.unpack_from("<i", data, at)[0]
            if at + 4 + size > len(data):
                break
            found.append(at)
            at += 4 + size
        if found:
            yield data, found
        data, begins = data[at:], [(max(b - at, 0), p) for b, p in begins][-3:]
    if started and data:
        found, at = [], 0
        while at + 4 <= len(data):
            if next((p for b, p in reversed(begins) if b <= at), 0) >= high:
                break
            size = struct.unpack_from("<i", data, at)[0]
            if at + 4 + size > len(data):
                raise ValueError("the file ends within a record")
            found.append(at)
            at += 4 + size
        if found:
            yield data, found


def _numbers(data: np.ndarray, at: np.ndarray, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ndarray(len(data) - width + 1, kind, data, 0, (1,))[at]


def _tags(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> pa.Array:
    """Tags of all records, the k-th of each together."""
    zeros = np.flatnonzero(data == 0)
    whose, keys, values = [], [], []
    at = at.copy()
    active = np.flatnonzero(at + 3 < end)
    while len(active):
        here = at[active]
        kind = data[here + 2]
        for c in np.unique(kind).tolist():
            some, place = active[kind == c], here[kind == c]
            keys += [data[p : p + 2].tobytes().decode() for p in place.tolist()]
            whose.append(some)
            if c in b"ZH":
                stop = zeros[np.searchsorted(zeros, place + 3)]
                values += [data[a + 3 : b].tobytes().decode() for a, b in zip(place.tolist(), stop.tolist(), strict=True)]
                at[some] = stop + 1
            elif c == ord("B"):
                for r, p in zip(some.tolist(), place.tolist(), strict=True):
                    n = int(_numbers(data, np.array([p + 4]), "<i4")[0])
                    each = np.frombuffer(data[p + 8 : p + 8 + n * _SIZE[data[p + 3]]].tobytes(), _TYPE[data[p + 3]])
                    values.append(",".join([chr(data[p + 3]), *(f"{x:g}" if data[p + 3] == ord("f") else str(x) for x in each.tolist())]))
                    at[r] = p + 8 + each.nbytes
            elif c == ord("A"):
                values += [chr(x) for x in data[place + 3].tolist()]
                at[some] = place + 4
            else:
                values += [f"{x:g}" if c == ord("f") else str(x) for x in _numbers(data, place + 3, _TYPE[c]).tolist()]
                at[some] = place + 3 + _SIZE[c]
        active = active[at[active] + 3 < end[active]]
    owner = np.concatenate(whose) if whose else np.zeros(0, np.int64)
    order = pa.array(np.argsort(owner, kind="stable"))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(at)))]).astype(np.int32)
    return pa.MapArray.from_arrays(pa.array(offsets), pa.array(keys, pa.string()).take(order), pa.array(values, pa.string()).take(order))


def decoded(raw: bytes, begin: list[int], contigs: pa.Array, wanted: list[str]) -> pa.RecordBatch:
    """Records as columns."""
    data = np.frombuffer(raw, np.uint8)
    at = np.array(begin, np.int64)
    name, ops, seq = data[at + 12].astype(np.int64), _numbers(data, at + 16, "<u2").astype(np.int64), _numbers(data, at + 20, "<i4").astype(np.int64)
    at_ops = at + 36 + name
    at_seq = at_ops + 4 * ops
    at_qual = at_seq + (seq + 1) // 2
    starred = pa.array(["*"])

    def contig(place: int) -> pa.Array:
        which = _numbers(data, at + place, "<i4")
        return contigs.take(pa.array(np.where(which < 0, len(contigs) - 1, which)))

    def bases() -> pa.Array:
        place = spread(np.zeros(len(at), np.int64), seq)
        byte = data[np.repeat(at_seq, seq) + place // 2]
        return strings(BASES[np.where(place % 2 == 0, byte >> 4, byte & 15)], seq)

    def cigar() -> pa.Array:
        value = _numbers(data, spread(at_ops, 4 * ops)[::4], "<u4")
        each = pc.binary_join_element_wise(pc.cast(pa.array(value >> 4), pa.string()), strings(OPS[value & 15], np.ones(len(value), np.int64)), "")
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(ops)]).astype(np.int32)), each), "")

    def quality() -> pa.Array:
        none = data[np.minimum(at_qual, len(data) - 1)] == 0xFF
        said = strings(data[spread(at_qual, seq)] + np.uint8(33), seq)
        return pc.if_else(pa.array(none | (seq == 0)), starred[0], said)

    def or_star(x: pa.Array) -> pa.Array:
        return pc.if_else(pc.equal(pc.binary_length(x), 0), starred[0], x)

    made = {
        "read_id": lambda: strings(data[spread(at + 36, name - 1)], name - 1),
        "flag": lambda: pa.array(_numbers(data, at + 18, "<u2").astype(np.int32)),
        "contig": lambda: contig(4),
        "start": lambda: pa.array(_numbers(data, at + 8, "<i4").astype(np.int64)),
        "mapq": lambda: pa.array(data[at + 13].astype(np.int32)),
        "cigar": lambda: or_star(cigar()),
        "mate_contig": lambda: contig(24),
        "mate_start": lambda: pa.array(_numbers(data, at + 28, "<i4").astype(np.int64)),
        "template": lambda: pa.array(_numbers(data, at + 32, "<i4")),
        "seq": lambda: or_star(bases()),
        "qual": quality,
        "tags": lambda: _tags(data, at_qual + seq, at + 4 + _numbers(data, at, "<i4")),
    }
    return pa.RecordBatch.from_arrays([made[c]() for c in wanted], wanted)


@dataclass
class Range(InputPartition):
    path: str
    low: int
    high: int


class BamReader(DataSourceReader):
    def __init__(self, schema: T.StructType, paths: list[str], size: int, region: tuple[str, int, int] | None) -> None:
        self.columns, self.paths, self.size, self.region = schema.names, paths, size, region

    def partitions(self) -> list[Range]:
        out = []
        for path in self.paths:
            head = header(path)
            ranges = [Range(path, low, min(low + self.size, head.size)) for low in range(0, head.size, self.size)]
            if self.region is not None and head.ordered:
                ranges = self._within(path, head, ranges)
            out += ranges
        return out or [Range("", 0, 0)]

    def _within(self, path: str, head: Header, ranges: list[Range]) -> list[Range]:
        """The ranges that can hold the asked places, of a file in their order."""
        number = {name: k for k, (name, _) in enumerate(head.contigs)} | {"*": len(head.contigs)}
        known: dict[int, tuple[int, int]] = {}

        def first(k: int) -> tuple[int, int]:
            """Contig and start of the first record at or behind a range's begin."""
            while k < len(ranges):
                if k not in known:
                    with _open(path) as f:
                        data, found = next(records(f, head, ranges[k].low, ranges[k].high), (b"", []))
                    known[k] = struct.unpack_from("<ii", data, found[0] + 4) if found else (-2, 0)
                if known[k][0] != -2:
                    contig, start = known[k]
                    return (contig if contig >= 0 else len(head.contigs)), start
                k += 1
            return len(head.contigs) + 1, 0

        name, low, high = self.region
        if name not in number:
            return []
        lowest, beyond = (number[name], low), (number[name], high)
        # from the last range whose first record is before the place to the last one whose first record is not behind it
        a, b = 0, len(ranges)
        while a < b:
            m = (a + b) // 2
            a, b = (m + 1, b) if first(m) < lowest else (a, m)
        begin = a = max(a - 1, 0)
        b = len(ranges)
        while a < b:
            m = (a + b) // 2
            a, b = (m + 1, b) if first(m) < beyond else (a, m)
        return ranges[begin:a]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        head = header(partition.path)
        names = [*(name for name, _ in head.contigs), "*"]
        contigs = pa.array(names)
        with _open(partition.path) as f:
            for data, begin in records(f, head, partition.low, partition.high):
                if self.region is not None:
                    begin = self._inside(data, begin, names)
                for k in range(0, len(begin), 8192):
                    yield decoded(data, begin[k : k + 8192], contigs, self.columns)


    def _inside(self, raw: bytes, begin: list[int], names: list[str]) -> list[int]:
        name, low, high = self.region
        if name not in names:
            return []
        at, data = np.array(begin, np.int64), np.frombuffer(raw, np.uint8)
        contig, start = _numbers(data, at + 4, "<i4"), _numbers(data, at + 8, "<i4")
        return at[(np.where(contig < 0, len(names) - 1, contig) == names.index(name)) & (start >= low) & (start < high)].tolist()


class BamSource(DataSource):
    """``spark.read.format("bam").option("paths", '["..."]').load()``; options ``columns``, ``region`` (JSON lists) and ``range`` (bytes)."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> T.StructType:
        asked = json.loads(self.options["columns"]) if "columns" in self.options else SCHEMA.names
        return T.StructType([SCHEMA[c] for c in asked])

    def reader(self, schema: T.StructType) -> BamReader:
        paths = json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]
        region = tuple(json.loads(self.options["region"])) if "region" in self.options else None
        return BamReader(schema, paths, int(self.options.get("range", RANGE)), region)


def read(spark: SparkSession, path: str | list[str], columns: list[str] | None = None, region: tuple[str, int, int] | None = None, range_bytes: int = RANGE) -> DataFrame:
    """Records of BAM files; of unmapped ones ``contig`` is ``*``; ``start`` from 0, -1 where there is none.

    ``region``: only records of that contig with low <= start < high.  It is an option and no
    condition pushed down by Spark, as the ranges that Spark plans for one condition would be
    used by all other queries of the same DataFrame.
    """
    spark.dataSource.register(BamSource)
    reader = spark.read.format("bam").option("paths", json.dumps([path] if isinstance(path, str) else path)).option("range", str(range_bytes))
    for name, value in (("columns", columns), ("region", region)):
        if value is not None:
            reader = reader.option(name, json.dumps(value))
    return reader.load()


def read_as_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The columns that the reader of SAM text gives."""
    x, flag = read(spark, path), F.col("flag")
    ops = cigar_ops(F.col("cigar"))
    bits = {"mapped": flag.bitwiseAND(F.lit(4)) == 0, "forward": flag.bitwiseAND(F.lit(16)) == 0, "failed": flag.bitwiseAND(F.lit(512)) != 0, "duplicate": flag.bitwiseAND(F.lit(1024)) != 0}
    return x.select("read_id", "flag", *(c.alias(n) for n, c in bits.items()), "contig", F.col("start").alias("lo"), (F.col("start") + cigar_length(ops, "MDN=X")).alias("hi"), "mapq", ops.alias("cigar"), "seq", "qual", "tags")


def encoded(rows: Iterator[tuple], contigs: list[tuple[str, int]], text: str = "@HD\tVN:1.6\tSO:coordinate\n", block: int = 0xFF00) -> Iterator[bytes]:
    """BGZF blocks of a BAM file of (read_id, flag, contig, start, mapq, cigar, seq, qual, tags): for files of a task's or test's size."""
    number = {name: k for k, (name, _) in enumerate(contigs)} | {"*": -1}
    codes = {c: k for k, c in enumerate(BASES.tobytes().decode())}
    data = b"BAM\x01" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(contigs))
    for name, size in contigs:
        data += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", size)
    for read_id, flag, contig, start, mapq, cigar, seq, qual, tags in rows:
        parts = [(int(n), o) for n, o in _parsed(cigar)]
        bases = "" if seq == "*" else seq
        packed = bytes((codes[bases[k]] << 4) | (codes[bases[k + 1]] if k + 1 < len(bases) else 0) for k in range(0, len(bases), 2))
        marks = bytes([0xFF] * len(bases)) if qual == "*" else bytes(ord(c) - 33 for c in qual)
        body = struct.pack("<iiBBHHHiiii", number[contig], start, len(read_id) + 1, mapq, 0, len(parts), flag, len(bases), -1, -1, 0)
        body += read_id.encode() + b"\0" + b"".join(struct.pack("<I", (n << 4) | OPS.tobytes().index(o.encode())) for n, o in parts) + packed + marks
        for key, (kind, value) in tags.items():
            body += key.encode() + kind.encode()
            if kind == "B":
                sub, *numbers = value.split(",")
                dtype = np.dtype(_TYPE[ord(sub)])
                body += sub.encode() + struct.pack("<i", len(numbers)) + np.array([float(x) for x in numbers]).astype(dtype).tobytes()
            elif kind in "ZH":
                body += value.encode() + b"\0"
            elif kind == "A":
                body += value.encode()
            else:
                body += np.array([float(value)]).astype(_TYPE[ord(kind)]).tobytes()
        data += struct.pack("<i", len(body)) + body
        while len(data) >= block:
            yield _deflated(data[:block])
            data = data[block:]
    if data:
        yield _deflated(data)
    yield _deflated(b"")


def _parsed(cigar: str) -> list[tuple[str, str]]:
    import re

    return re.findall(r"(\d+)([MIDNSHP=X])", cigar)


def _deflated(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    return MAGIC + b"\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))
