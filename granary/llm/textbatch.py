"""Whole columns of text as numpy byte arrays: words, lines, hashes, counts.

Everything here runs inside a Spark task on one Arrow batch at a time; a batch
is cut into slices of a few megabytes, so that memory stays bounded whatever
the number of rows in a batch.  A slice holds one text at least, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64(0xA0761D6478BD642F)
_LENGTH = np.uint64(0x2545F4914F6CDD1D)
#: The lowest 0 to 8 bytes of a word.
_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

#: Bytes that separate words: one table for white space, one for all ASCII but letters and digits.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NOT_WORD = np.zeros(256, bool)
NOT_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: First bytes of UTF-8 characters.
FIRST = (np.arange(256) & 0xC0) != 0x80


@dataclass
class Texts:
    """Texts behind one another: text i is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def count(self, table: np.ndarray) -> np.ndarray:
        """How many bytes of each text the table marks."""
        return self.total(table[self.data])

    def total(self, marks: np.ndarray) -> np.ndarray:
        """Sum of ``marks`` (one for each byte) over each text."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(marks, out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def lowered(self) -> Texts:
        return Texts(LOWER[self.data], self.offsets)


@dataclass
class Spans:
    """Stretches of texts (words or lines), in order; ``owner`` is the text's number."""

    start: np.ndarray
    end: np.ndarray
    owner: np.ndarray

    def first_of(self, n: int) -> np.ndarray:
        """Where each of ``n`` texts' spans begin; n + 1 numbers."""
        return np.searchsorted(self.owner, np.arange(n + 1))


def texts(column: pa.Array) -> Texts:
    """Null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = pc.cast(column, pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(whole[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if high > low:
                yield batch.slice(low, high - low)


def spans(found: Texts, separators: np.ndarray) -> Spans:
    """The longest stretches without a separator, none longer than its text."""
    n = len(found.data)
    inside = ~separators[found.data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = found.offsets[:-1][found.offsets[:-1] < n]
    starts[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = found.offsets[1:][found.offsets[1:] > 0] - 1
    ends[last] = inside[last]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Spans(start, end, np.searchsorted(found.offsets, start, side="right") - 1)


def lines(found: Texts) -> Spans:
    """All lines between ``\\n``, empty ones too; an empty text is one empty line."""
    breaks = np.flatnonzero(found.data == 0x0A)
    owner = np.searchsorted(found.offsets, breaks, side="right") - 1
    start = np.concatenate([found.offsets[:-1], breaks + 1])
    end = np.concatenate([breaks, found.offsets[1:]])
    order = np.lexsort((start, np.concatenate([np.arange(len(found)), owner])))
    order_end = np.lexsort((end, np.concatenate([owner, np.arange(len(found))])))
    return Spans(start[order], end[order_end], np.concatenate([np.arange(len(found)), owner])[order])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _scaled(number: int) -> np.uint64:
    return np.uint64(number * int(_PLACE) & 0xFFFFFFFFFFFFFFFF)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes.

    Eight bytes at a time are set apart by their place and spread by ``mix``
    before they are added up, so that no rearrangement of the same bytes has the
    same sum but by chance.  Equal bytes give equal hashes in every task and run.
    """
    size = end - start
    words = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))
    lead = _scaled(seed + 1)
    out = mix((words[start] & _BYTES[np.minimum(size, 8)]) ^ lead)
    long = np.flatnonzero(size > 8)
    if len(long):
        more = (size[long] - 1) >> 3
        first = np.cumsum(more) - more
        place = np.arange(int(more.sum())) - np.repeat(first, more) + 1
        at = np.repeat(start[long], more) + 8 * place
        part = words[at] & _BYTES[np.minimum(np.repeat(end[long], more) - at, 8)]
        out[long] += np.add.reduceat(mix(part ^ (lead + place.astype(np.uint64) * _ODD)), first)
    return mix(out ^ (size.astype(np.uint64) * _LENGTH + np.uint64(seed)))


def sequence_hashes(codes: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each stretch ``first[i]:first[i + 1]`` of codes, made as in ``hashes``."""
    size = np.diff(first)
    place = np.arange(len(codes)) - np.repeat(first[:-1], size) + 1 if len(codes) else np.zeros(0, np.int64)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes ^ (_scaled(seed) + place.astype(np.uint64) * _ODD)), out=sums[1:])
    return mix((sums[first[1:]] - sums[first[:-1]]) ^ (size.astype(np.uint64) * _LENGTH + np.uint64(seed)))


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` successive codes; the last width - 1 have none."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, _scaled(width), np.uint64)
    for i in range(width):
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += codes[i : i + n]
    return mix(out)


def among(values: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    """Which values are among the sorted keys; a bitmap of low bits goes first."""
    hit = np.zeros(len(values), bool)
    if not len(sorted_keys) or not len(values):
        return hit
    width = 1 << max(16, min(22, int(len(sorted_keys)).bit_length() + 5))
    seen = np.zeros(width, bool)
    low = np.uint64(width - 1)
    seen[(sorted_keys & low).astype(np.int64)] = True
    maybe = np.flatnonzero(seen[(values & low).astype(np.int64)])
    at = np.searchsorted(sorted_keys, values[maybe])
    at[at == len(sorted_keys)] = 0
    hit[maybe] = sorted_keys[at] == values[maybe]
    return hit


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    if not len(keys):
        return np.zeros(0, bool)
    ordered = np.sort(keys)
    return among(keys, np.unique(ordered[1:][ordered[1:] == ordered[:-1]]))

