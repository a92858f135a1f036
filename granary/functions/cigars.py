"""CIGAR and MD strings of whole Arrow batches as numpy arrays, in time that grows with their length.

A batch's strings lie behind one another; operations, letters and bases are found
in one pass over the bytes, and places come from running sums, so a read of a
million operations costs as much as a million reads of one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KINDS = b"MIDNSHP=X"
_ON_REF = np.isin(np.arange(256), list(b"MDN=X"))
_ON_READ = np.isin(np.arange(256), list(b"MIS=X"))
_ALIGNED = np.isin(np.arange(256), list(b"M=X"))
_DIGIT = np.isin(np.arange(256), list(b"0123456789"))
_LETTER = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings in a row, and where each begins (one more number than strings); a null is empty."""
    column = pc.cast(pc.fill_null(column, ""), pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())


def written(number: np.ndarray, text: np.ndarray, sizes: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """``n`` strings of pieces, each a number and behind it ``sizes[k]`` bytes of ``text``; owners rise."""
    digits = np.ones(len(number), np.int64)
    most = int(number.max(initial=0))
    power = 10
    while power <= most:
        digits += number >= power
        power *= 10
    begin = np.cumsum(digits + sizes) - digits - sizes
    out = np.empty(int((digits + sizes).sum()), np.uint8)
    out[begin + digits - 1] = 0x30 + number % 10
    for k in range(1, int(digits.max(initial=0))):
        long = np.flatnonzero(digits > k)
        out[(begin + digits)[long] - 1 - k] = 0x30 + number[long] // 10**k % 10
    out[spread(begin + digits, sizes)] = text
    return strings(out, np.bincount(owner, digits + sizes, n).astype(np.int64))


def before(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Of each value the sum of those before it with the same owner; owners rise."""
    total = np.cumsum(values) - values
    first = np.searchsorted(owner, np.arange(n))
    return total - (total[np.minimum(first, max(len(values) - 1, 0))][owner] if len(values) else 0)


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...`` for each i, ``sizes[i]`` numbers."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _numbers(data: np.ndarray, digit: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The number that ends at each ``last`` digit."""
    begin = np.flatnonzero(digit & ~np.concatenate([[False], digit[:-1]]))
    ends = np.flatnonzero(digit & ~np.concatenate([digit[1:], [False]]))
    out = np.zeros(len(data) + 1, np.int64)
    if len(begin):
        size = ends - begin + 1
        at = spread(begin, size)
        power = np.repeat(ends, size) - at
        value = (data[at] - 0x30).astype(np.int64) * 10 ** np.minimum(power, 18)
        out[ends] = np.add.reduceat(value, np.cumsum(size) - size)
    return out[last]


@dataclass
class Walk:
    """Operations in order: kind, size, whose they are, and where they begin on the reference and on the read (clips taken in)."""

    kind: np.ndarray
    size: np.ndarray
    owner: np.ndarray
    ref: np.ndarray
    read: np.ndarray
    n: int

    def total(self, table: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, self.size * table[self.kind], self.n).astype(np.int64)

    @property
    def on_ref(self) -> np.ndarray:
        return self.total(_ON_REF)

    @property
    def aligned(self) -> np.ndarray:
        """Which operations put bases of the read on the reference."""
        return _ALIGNED[self.kind]

    def take(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return self.owner[keep], self.ref[keep], self.read[keep], self.size[keep]


def walked(column: pa.Array) -> Walk:
    """A string that is no CIGAR (null, ``*``) has no operations."""
    data, offsets = flat(column)
    digit = _DIGIT[data]
    marks = np.flatnonzero(np.isin(data, np.frombuffer(KINDS, np.uint8)))
    marks = marks[(marks > 0) & digit[marks - 1]] if len(marks) else marks
    size = _numbers(data, digit, marks - 1)
    kind = data[marks]
    owner = np.searchsorted(offsets, marks, side="right") - 1
    n = len(column)
    return Walk(kind, size, owner, before(size * _ON_REF[kind], owner, n), before(size * _ON_READ[kind], owner, n), n)


@dataclass
class Letters:
    """Letters of MD strings: which base, whose, its place (bases of the alignment's reference before it, skips left out), and if it is deleted; ``lengths``: reference bases of each string."""

    base: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    gone: np.ndarray
    lengths: np.ndarray


def _md(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of MD strings, whose each is, and how far each moves on the reference (a number at its last digit)."""
    data, offsets = flat(column)
    owner = np.repeat(np.arange(len(column)), np.diff(offsets))
    moves = _LETTER[data].astype(np.int64)
    if len(data):
        digit = _DIGIT[data]
        # two numbers can stand side by side at the border of two strings alone: a mark is put between them
        last = np.flatnonzero(digit & ~np.concatenate([digit[1:] & (owner[1:] == owner[:-1]), [False]]))
        border = np.flatnonzero(digit[:-1] & digit[1:] & (owner[:-1] != owner[1:]))
        apart = np.insert(data, border + 1, 0x5E)
        moves[last] += _numbers(apart, _DIGIT[apart], last + np.searchsorted(border, last, side="left"))
    return data, owner, moves


def md_lengths(column: pa.Array) -> np.ndarray:
    """Reference bases of each MD string."""
    return letters(column).lengths


def letters(column: pa.Array) -> Letters:
    data, owner, moves = _md(column)
    place = before(moves, owner, len(column)) if len(data) else moves
    lead = np.maximum.accumulate(np.where(_LETTER[data], -1, np.arange(len(data)))) if len(data) else moves
    at = np.flatnonzero(_LETTER[data])
    gone = (lead[at] >= 0) & (data[np.maximum(lead[at], 0)] == 0x5E) & (owner[np.maximum(lead[at], 0)] == owner[at])
    return Letters(data[at], owner[at], place[at], gone, np.bincount(owner, moves, len(column)).astype(np.int64))


@dataclass
class Rebuilt:
    """Reference bases under each alignment, skips left out, behind one another, and where each alignment's begin."""

    base: np.ndarray
    first: np.ndarray


def reference(walk: Walk, seq: pa.Array, md: pa.Array, said: Letters | None = None) -> Rebuilt:
    """The reference from the reads' bases, with what the MD strings say otherwise (``said``, their letters, if known); ``N`` where neither says anything."""
    data, offsets = flat(seq)
    skip = walk.kind == ord("N")
    skipped = before(walk.size * skip, walk.owner, walk.n)
    sizes = np.bincount(walk.owner, walk.size * (_ON_REF[walk.kind] & ~skip), walk.n).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    out = np.full(int(first[-1]), ord("N"), np.uint8)
    ops = walk.aligned
    owner, ref, read, size = walk.take(ops)
    to, source = spread(first[owner] + ref - skipped[ops], size), spread(offsets[owner] + read, size)
    inside = source < np.repeat(offsets[owner + 1], size)
    out[to[inside]] = data[source[inside]]
    said = said or letters(md)
    at = first[said.owner] + said.place
    fits = at < first[said.owner + 1]
    out[at[fits]] = said.base[fits]
    return Rebuilt(out, first)


def md_strings(walk: Walk, seq: pa.Array, ref: pa.Array) -> pa.Array:
    """The MD string of each alignment from its bases and the reference bases from its start on."""
    data, offsets = flat(seq)
    known, begins = flat(ref)
    ops = walk.aligned
    owner, at_ref, at_read, size = walk.take(ops)
    own, r, q = np.repeat(owner, size), spread(at_ref, size), spread(at_read, size)
    under = known[begins[own] + r]
    differs = np.flatnonzero(under != data[offsets[own] + q])
    skips = walk.kind == ord("N")
    skipped = before(walk.size * skips, walk.owner, walk.n)
    gone = walk.kind == ord("D")
    low = begins[walk.owner[gone]] + walk.ref[gone]
    shown = np.clip(len(known) - low, 0, walk.size[gone])
    # letters that differ, and deleted stretches with a mark before them, in their order
    who = np.concatenate([own[differs], walk.owner[gone]])
    place = np.concatenate([(r - np.repeat(skipped[ops], size))[differs], (walk.ref - skipped)[gone]])
    long = np.concatenate([np.ones(len(differs), np.int64), walk.size[gone]])
    sizes = np.concatenate([np.ones(len(differs), np.int64), shown + 1])
    text = np.full(int(sizes.sum()), ord("^"), np.uint8)
    text[: len(differs)] = under[differs]
    text[spread(len(differs) + np.cumsum(shown + 1) - shown, shown)] = known[spread(low, shown)]
    order = np.lexsort((place, who))
    text = text[spread((np.cumsum(sizes) - sizes)[order], sizes[order])]
    who, place, long, sizes = who[order], place[order], long[order], sizes[order]
    # before each stands how far it is from the end of the one before it, and behind the last one what is left
    first = np.concatenate([[True], who[1:] != who[:-1]])[: len(who)]
    number = place - np.where(first, 0, np.concatenate([[0], (place + long)[:-1]])[: len(who)])
    done = np.zeros(walk.n, np.int64)
    done[who] = place + long
    total = walk.on_ref - np.bincount(walk.owner, walk.size * skips, walk.n).astype(np.int64)
    at, end = np.arange(len(who)) + who, np.arange(walk.n) + np.cumsum(np.bincount(who, minlength=walk.n))
    numbers, widths, owners = (np.zeros(len(who) + walk.n, np.int64) for _ in range(3))
    numbers[at], widths[at], owners[at] = number, sizes, who
    numbers[end], owners[end] = total - done, np.arange(walk.n)
    return written(numbers, text, widths, owners, walk.n)


@dataclass
class Errors:
    """Errors in order: whose, the aligned bases of the read before it, kind (0 deleted, 1 put in, 2 otherwise) and how many bases."""

    owner: np.ndarray
    pos: np.ndarray
    kind: np.ndarray
    n: np.ndarray


ERROR_KINDS = ("del", "ins", "sub")


def errors(walk: Walk, md: pa.Array) -> Errors:
    """Insertions and deletions of the CIGAR, substitutions of the MD string."""
    counted = np.isin(walk.kind, list(b"MI=X"))
    pos = before(walk.size * counted, walk.owner, walk.n)
    skip = walk.kind == ord("N")
    ref = walk.ref - before(walk.size * skip, walk.owner, walk.n)
    parts = [(walk.owner[k], pos[k], np.full(int(k.sum()), number), walk.size[k]) for number, k in ((0, walk.kind == ord("D")), (1, walk.kind == ord("I")))]
    said = letters(md)
    owner, place = said.owner[~said.gone], said.place[~said.gone]
    # the operation in which a substitution stands: the last one of its alignment that begins at or before it and takes reference bases
    on = np.flatnonzero(_ON_REF[walk.kind] & ~skip)
    width = int(max(ref.max(initial=0), place.max(initial=0))) + 1
    k = on[np.maximum(np.searchsorted(walk.owner[on] * width + ref[on], owner * width + place, side="right") - 1, 0)] if len(on) else np.zeros(len(owner), np.int64)
    fits = (walk.owner[k] == owner) & _ALIGNED[walk.kind[k]] if len(on) else np.zeros(len(owner), bool)
    owner, place, k = owner[fits], place[fits], k[fits]
    parts.append((owner, pos[k] + place - ref[k], np.full(len(owner), 2), np.ones(len(owner), np.int64)))
    owner, pos, kind, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((n, kind, pos, owner))
    return Errors(owner[order], pos[order], kind[order], n[order])


#: Columns of a pile-up's counts: bases of forward and of reverse reads, deleted, discounted and inserted ones.
PILED = tuple(f"{s}_{b}" for s in ("fwd", "rev") for b in "acgtn") + ("deleted", "discounted", "inserted")
_CODE = np.full(256, 4)
for _k, _b in enumerate(b"ACGT"):
    _CODE[_b] = _CODE[_b + 32] = _k


def piled(walk: Walk, start: np.ndarray, reverse: np.ndarray, seq: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every base on the reference: whose, where, and the number of its column in ``PILED``; insertions stand at the base before them.

    A base (or deletion) with an insertion on either side is discounted, whatever it is.
    """
    data, offsets = flat(seq)
    taken = _ON_REF[walk.kind] & (walk.kind != ord("N"))
    near = np.isin(walk.kind, list(b"MID=XN"))
    steps = np.flatnonzero(near)
    put = walk.kind[steps] == ord("I")
    owner = walk.owner[steps]
    same = owner[1:] == owner[:-1]
    on = taken[steps]
    # insertions between two bases of one alignment
    between = np.zeros(len(steps), bool)
    if len(steps) > 2:
        between[1:-1] = put[1:-1] & on[:-2] & on[2:] & same[:-1] & same[1:]
    after, prior = np.zeros(len(walk.kind), bool), np.zeros(len(walk.kind), bool)
    after[steps[:-1]] = put[1:] & same if len(steps) else False
    prior[steps[1:]] = between[:-1]
    ops = np.flatnonzero(taken)
    size = walk.size[ops]
    whose = np.repeat(walk.owner[ops], size)
    where = spread(start[walk.owner[ops]] + walk.ref[ops], size)
    base = np.repeat(walk.kind[ops] != ord("D"), size)
    source = spread(offsets[walk.owner[ops]] + walk.read[ops], size)
    inside = base & (source < offsets[whose + 1])
    column = np.full(len(whose), 4)
    column[inside] = _CODE[data[source[inside]]]
    column += np.where(reverse[whose], 5, 0)
    column[~base] = 10
    edge = np.cumsum(size)
    filled = size > 0
    column[(edge - 1)[after[ops] & filled]] = 11
    column[(edge - size)[prior[ops] & filled]] = 11
    ends = np.flatnonzero(after[ops] & filled)
    return np.concatenate([whose, whose[(edge - 1)[ends]]]), np.concatenate([where, where[(edge - 1)[ends]]]), np.concatenate([column, np.full(len(ends), 12)])


def homopolymers(walk: Walk, seq: pa.Array, md: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of one reference base and what the read has of them: whose, base, length, length in the read.

    Bases deleted in a run are missing in the read, bases of its kind put in within or
    beside it are more; the first and last run of an alignment are left out, being cut.
    """
    found = reference(walk, seq, md)
    base, first = found.base, found.first
    owner = np.repeat(np.arange(walk.n), np.diff(first))
    if not len(base):
        return (np.zeros(0, np.int64),) * 4
    begins = np.concatenate([[True], (base[1:] != base[:-1]) | (owner[1:] != owner[:-1])])
    run = np.cumsum(begins) - 1
    starts = np.flatnonzero(begins)
    length = np.diff(np.append(starts, len(base)))
    read = length.copy()
    skip = before(walk.size * (walk.kind == ord("N")), walk.owner, walk.n)
    gone = walk.kind == ord("D")
    at = spread(first[walk.owner[gone]] + (walk.ref - skip)[gone], walk.size[gone])
    read -= np.bincount(run[at], minlength=len(starts))
    data, offsets = flat(seq)
    put = walk.kind == ord("I")
    who, size = walk.owner[put], walk.size[put]
    own, source = np.repeat(who, size), spread(offsets[who] + walk.read[put], size)
    place = np.repeat(first[who] + (walk.ref - skip)[put], size)
    inside = source < offsets[own + 1]
    own, source, place = own[inside], source[inside], place[inside]
    kind, end = data[source], len(base) - 1
    left = (place - 1 >= first[own]) & (base[np.clip(place - 1, 0, end)] == kind)
    right = ~left & (place < first[own + 1]) & (base[np.clip(place, 0, end)] == kind)
    read += np.bincount(run[place[left] - 1], minlength=len(starts)) + np.bincount(run[place[right]], minlength=len(starts))
    of = owner[starts]
    outer = np.concatenate([[True], of[1:] != of[:-1]]) | np.concatenate([of[1:] != of[:-1], [True]])
    keep = ~outer
    return of[keep], base[starts][keep].astype(np.int64), length[keep], read[keep]
