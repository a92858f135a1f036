"""Alignments of many pairs of sequences at once with gaps of affine cost, and their CIGAR strings.

A row of the matrix (one base of the query) is worked out for all pairs of a slice
and all reference places that any of their bands reaches; pairs lie side by side in
memory, so every step is one pass over plain arrays, and a gap along the row is a
running maximum, place by place, of what a gap begun at each place costs by then.
Which step led to each cell is kept in one byte, and the steps are followed back for
all pairs of many slices together.

The cost of a gap can depend on where it is: with ``scale`` the costs of a base in
a run of h equal bases are divided by h, so that a missing or an additional base of
a homopolymer is put into that homopolymer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from granary.functions.cigars import spread

#: Cells of pairs that are followed back together, and those of one row of the matrix, which stay in the processor's cache.
CELLS, ROW_CELLS = 8_000_000, 24_000
#: Cells of a row whose bands lie apart: fewer cost no more than the calls they take.
APART = 6_000
STOP, PAIR, GONE, PUT = 0, 1, 2, 3
#: What a cell's byte says: a deleted base is best, its gap goes on, else a base put in is, its gap goes on, and the path begins.
_GONE, _GONE_ON, _PUT, _PUT_ON, _STOP = 1, 2, 4, 8, 16
LOW = -1e30
OPS = np.array([0, ord("M"), ord("D"), ord("I")], np.uint8)


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """Of each cell's byte, behind 32 times the gap that the path is in: the step, and the gap it is in after it."""
    cell, gap = np.arange(96) & 31, np.array([0, GONE, PUT]).repeat(32)
    free = np.where(cell & _GONE, GONE, np.where(cell & _STOP, STOP, np.where(cell & _PUT, PUT, PAIR)))
    how = np.where(gap == 0, free, gap)
    return how.astype(np.uint8), np.where((how == GONE) & ((cell & _GONE_ON) > 0), 32, np.where((how == PUT) & ((cell & _PUT_ON) > 0), 64, 0)).astype(np.uint8)


_HOW, _AFTER = _steps()


@dataclass(frozen=True)
class Scores:
    """Scores of equal and unequal bases; a gap of n bases costs ``open + n * extend``; ``scale``: none, extend or both."""

    match: float = 4
    mismatch: float = -6
    open: float = 5
    extend: float = 2
    scale: str = "none"


@dataclass
class Alignment:
    """Per pair: score, aligned stretches of query and reference, and the steps between them as (op, n)."""

    score: np.ndarray
    q_lo: np.ndarray
    q_hi: np.ndarray
    r_lo: np.ndarray
    r_hi: np.ndarray
    ops: list[list[tuple[str, int]]]


@dataclass
class Flat:
    """Sequences of numbers behind one another, and where each begins (one more number than sequences)."""

    data: np.ndarray
    first: np.ndarray
    known: dict = field(default_factory=dict)

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    @staticmethod
    def of(parts: Sequence[np.ndarray], kind: type = np.uint8) -> Flat:
        return Flat(np.concatenate([np.asarray(p, kind) for p in parts]) if len(parts) else np.zeros(0, kind), np.cumsum([0, *(len(p) for p in parts)]))

    def runs(self) -> np.ndarray:
        """Of each number the length of the run of equal ones it stands in."""
        x = self.data
        if not len(x):
            return np.zeros(0, np.int64)
        new = np.concatenate([[True], x[1:] != x[:-1], [False]])
        new[self.first[:-1]] = True  # a part without bases begins where the next one does
        starts = np.flatnonzero(new[: len(x)])
        size = np.diff(np.append(starts, len(x)))
        return np.repeat(size, size)

    def costs(self, s: Scores) -> list[np.ndarray]:
        """Of each base what a gap that begins or goes on there costs."""
        if s not in self.known:
            runs = self.runs() if s.scale != "none" else None
            self.known[s] = [base / runs if scaled else np.full(len(self.data), float(base)) for base, scaled in ((s.open, s.scale == "both"), (s.extend, s.scale != "none"))]
        return self.known[s]


@dataclass
class Paths:
    """``Alignment`` with the steps of all pairs behind one another (``kind``, ``size``); ``first``: where those of each begin.

    Places and steps are those of pairs whose path was followed, the others have none.
    """

    score: np.ndarray
    q_lo: np.ndarray
    q_hi: np.ndarray
    r_lo: np.ndarray
    r_hi: np.ndarray
    kind: np.ndarray
    size: np.ndarray
    first: np.ndarray


def run_lengths(x: np.ndarray) -> np.ndarray:
    """Of each base the length of the run it stands in."""
    return Flat(x, np.array([0, len(x)])).runs()


def flat_runs(parts: Sequence[np.ndarray]) -> np.ndarray:
    """``run_lengths`` of all parts behind one another, worked out together."""
    return Flat.of(parts).runs()


def align(queries: Sequence[np.ndarray], references: Sequence[np.ndarray], scores: Scores = Scores(), mode: str = "local", centres: Sequence[np.ndarray] | None = None, band: int | None = None) -> Alignment:
    """The best alignment of each pair (arrays of bytes).

    ``mode``: ``local``, ``global``, or ``read`` (all of the query, any stretch of the
    reference).  With ``band``, query place i (0 to its length) meets reference places within
    ``band`` of ``centres[k][i]`` alone.  Of equal alignments the one that ends first is taken,
    and its gaps stand leftmost.  An empty query or reference has no local alignment.
    """
    found = aligned(Flat.of(queries), Flat.of(references), scores, mode, Flat.of(centres, np.int64) if band is not None else None, band)
    steps = list(zip(found.kind.tobytes().decode(), found.size.tolist(), strict=True))
    edges = found.first.tolist()
    return Alignment(found.score, found.q_lo, found.q_hi, found.r_lo, found.r_hi, [steps[a:b] for a, b in zip(edges, edges[1:], strict=False)])


def aligned(query: Flat, ref: Flat, s: Scores = Scores(), mode: str = "local", centres: Flat | None = None, band: int | None = None, known: np.ndarray | None = None) -> Paths:
    """``align`` for sequences behind one another; with ``known`` scores, paths that score no more are not followed."""
    n, nq, nr = len(query.first) - 1, query.sizes, ref.sizes
    out = Paths(np.full(n, np.nan), *(np.zeros(n, np.int64) for _ in range(4)), np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(n + 1, np.int64))
    if not n:
        return out
    work = _Slices(query, ref, s, mode, centres, band)
    width = nr + 1
    lowest = highest = np.zeros(n, np.int64)
    if band is not None:
        # how far each pair's band leaves the diagonal
        off = centres.data - np.arange(len(centres.data)) + np.repeat(centres.first[:-1], centres.sizes)
        lowest, highest = (f.reduceat(off, centres.first[:-1]) for f in (np.minimum, np.maximum))
    order = np.lexsort((highest, lowest, nr, nq) if band is None else (highest, lowest, nq))
    low, held, parts = 0, [], []

    def follow() -> None:
        good = [p for p in (_Slices.better(x, out.score, mode, known) for x in held) if len(p[1])]
        if good:
            parts.append(_followed(good, out))
        held.clear()

    cells = longest = 0
    while low < n:
        some = order[low : low + ROW_CELLS]
        reach = np.maximum.accumulate(width[some])
        if band is not None:
            reach = np.minimum(reach, 2 * band + 1 + np.maximum.accumulate(highest[some]) - np.minimum.accumulate(lowest[some]))
        many = np.arange(1, len(some) + 1)
        fits = (many * reach <= ROW_CELLS) & (many * reach * (nq[some] + 1) <= CELLS)
        # neither bands that lie apart nor rows beyond a pair's query, unless there are few
        alike = nq[some] <= nq[some[0]] * 1.25 + 4
        fits &= (alike if band is None else alike & (reach <= 2 * (2 * band + 1))) | (many * reach <= APART)
        high = low + max(int(np.append(fits, False).argmin()), 1)
        made = work.run(order[low:high], out)
        longest = max(longest, int((nq + nr)[order[low:high]].max()))
        if held and (cells + len(made.steps) > CELLS or (sum(len(x.where) for x in held) + high - low) * longest > 4 * CELLS):
            follow()
            cells = 0
        held.append(made)
        cells, low = cells + len(made.steps), high
    follow()
    if parts:
        owner, out.kind, out.size = (np.concatenate(x) for x in zip(*parts, strict=True))
        by = np.argsort(owner, kind="stable")
        out.kind, out.size = out.kind[by], out.size[by]
        out.first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    return out


@dataclass
class _Made:
    """A slice's steps: the cell of row i, place j and column k is at ``base[i] + j * len(where) + k``; ``where``: the pair of each column."""

    where: np.ndarray
    steps: np.ndarray
    base: np.ndarray
    end_i: np.ndarray
    end_j: np.ndarray


class _Slices:
    """Works out slices of pairs whose queries don't get shorter."""

    def __init__(self, query: Flat, ref: Flat, s: Scores, mode: str, centres: Flat | None, band: int | None) -> None:
        self.query, self.ref, self.s, self.mode, self.centres, self.band = query, ref, s, mode, centres, band
        self.put_costs, self.gone_costs = query.costs(s), ref.costs(s)
        self.room = np.zeros(0)

    @staticmethod
    def better(made: _Made, score: np.ndarray, mode: str, known: np.ndarray | None) -> tuple[_Made, np.ndarray]:
        """The columns of a slice whose paths are to be followed."""
        found = score[made.where]
        with np.errstate(invalid="ignore"):
            good = found > (0 if mode == "local" else LOW / 2)
            if known is not None:
                good &= found > known[made.where] + 1e-9
        return made, np.flatnonzero(good)

    def columns(self, data: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
        """``data[first[k] : first[k] + size]`` as column k; what is read over the ends is of no use."""
        if not len(data):
            return np.zeros((size, len(first)), data.dtype)
        return data.take(first[None, :] + np.arange(size)[:, None], mode="clip")

    def reach(self, some: np.ndarray, rows: int, nr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and last place of the reference that each row of each pair meets."""
        kind = np.int16 if nr.max() < 2**15 - 1 else np.int64
        if self.band is None:
            return np.zeros((rows + 1, len(some)), kind), np.broadcast_to(nr.astype(kind), (rows + 1, len(some)))
        begin, most = self.centres.first[some], self.centres.sizes[some] - 1
        centre = self.centres.data[begin[None, :] + np.minimum(np.arange(rows + 1)[:, None], most[None, :])]
        first = np.minimum(np.maximum(centre - self.band, 0), np.maximum(nr - 2 * self.band, 0)[None, :])
        return first.astype(kind), np.minimum(first + 2 * self.band, nr).astype(kind)

    def buffers(self, cells: int, count: int) -> list[np.ndarray]:
        if self.room.size < count * cells:
            self.room = np.empty(count * cells)
        return [self.room[k * cells : (k + 1) * cells] for k in range(count)]

    def run(self, some: np.ndarray, out: Paths) -> _Made:
        s, mode, count = self.s, self.mode, len(some)
        nq, nr = self.query.sizes[some], self.ref.sizes[some]
        rows, top = int(nq[-1]), int(nr.max())
        first, last = self.reach(some, rows, nr)
        # what the bands of pairs whose queries go on to a row reach, and the column of the first of these pairs
        over = np.arange(rows + 1)[:, None] > nq[None, :]
        least, left = np.where(over, top, first).min(axis=1).tolist(), np.where(over, 0, first).max(axis=1).tolist()
        right, most = np.where(over, top, last).min(axis=1).tolist(), np.where(over, 0, last).max(axis=1).tolist()
        begun = np.searchsorted(nq, np.arange(rows + 2)).tolist()
        size = (np.array(most) - np.array(least) + 1) * count
        at = np.concatenate([[0], np.cumsum(size)])
        made = _Made(some, np.empty(int(at[-1]), np.uint8), at[:-1] - np.array(least) * count, np.zeros(count, np.int64), np.zeros(count, np.int64))
        at = at.tolist()
        Q = self.columns(self.query.data, self.query.first[some], rows)
        R = self.columns(self.ref.data, self.ref.first[some] - 1, top + 1)  # row j is the base before place j
        put_open, put_on = (self.columns(c, self.query.first[some], rows) for c in self.put_costs)
        opening, going = (self.columns(c, self.ref.first[some], top + 1) for c in self.gone_costs)
        passed = np.zeros((top + 1, count))
        np.cumsum(going[:top], axis=0, out=passed[1:])
        # row j + 1 is place j; cells out of the band are low
        H, P = np.full((top + 2, count), LOW), np.full((top + 2, count), LOW)
        highest = int(size.max()) // count
        bases, spares, runs = (x.reshape(highest, count) for x in self.buffers(highest * count, 3))
        equals, flags = (np.empty((highest, count), np.bool_) for _ in range(2))
        spare_rows, run_rows = list(spares), list(runs)
        forth = bool((first[1:] >= first[:-1]).all())  # bands never go back
        final = np.full(count, 0.0 if mode == "local" else LOW)
        small = all(float(x).is_integer() and abs(x) < 60 for x in (s.match, s.mismatch))
        prior_lo = prior_hi = None
        for i in range(rows + 1):
            lo, hi = least[i], most[i]
            high = hi - lo + 1
            base, spare, run, equal, more = bases[:high], spares[:high], runs[:high], equals[:high], flags[:high]
            step, bits, here = made.steps[at[i] : at[i + 1]].reshape(high, count), more.view(np.uint8), H[lo + 1 : hi + 2]
            # places at which some pairs' bands have not begun or have ended
            early, late = left[i] - lo, right[i] + 1 - lo
            before = np.arange(lo, left[i], dtype=first.dtype)[:, None] < first[i] if early > 0 else None
            behind = np.arange(right[i] + 1, hi + 1, dtype=last.dtype)[:, None] > last[i] if late < high else None
            if i == 0:
                base[:] = 0.0 if mode != "global" else LOW
                if lo == 0:
                    base[0] = 0
                step[:] = 0
            else:
                put = P[lo + 1 : hi + 2]
                np.equal(R[lo : hi + 1], Q[i - 1], out=equal)
                if small:
                    scored = equal.view(np.int8)
                    np.negative(scored, out=scored)
                    scored &= np.int8(s.match - s.mismatch)
                    scored += np.int8(s.mismatch)
                    base[:] = scored
                else:
                    base[:] = np.where(equal, s.match, s.mismatch)
                base += H[lo : hi + 1]
                np.subtract(here, put_open[i - 1], out=spare)
                spare -= put_on[i - 1]
                put -= put_on[i - 1]
                # a cell's byte is written bit by bit, from the highest on
                np.greater(put, spare, out=step.view(np.bool_))
                np.maximum(put, spare, out=put)
                np.greater(put, base, out=more)
                step += step
                step += bits
                np.maximum(base, put, out=base)
                if mode == "local":
                    np.maximum(base, 0, out=base)
                if before is not None and not forth:
                    np.putmask(put[:early], before, LOW)
                if behind is not None:
                    np.putmask(put[late:], behind, LOW)
            if before is not None:
                np.putmask(base[:early], before, LOW)
            step += step
            here[:1] = base[:1]
            if mode == "read" and i == 0:
                here[:] = base  # the reference before the read costs nothing
                step += step
            elif high == 1:
                step += step
            else:
                # deleted bases: from the row's scores without them, what a gap begun at each place costs by then
                np.subtract(base, opening[lo : hi + 1], out=spare)
                spare += passed[lo : hi + 1]
                run[0] = spare[0]
                for x, y, z in zip(run_rows, spare_rows[1:high], run_rows[1:], strict=False):
                    np.maximum(x, y, z)
                more, bits, gone, behind_first = more[1:], bits[1:], spare[1:], step[1:]
                np.greater(run[:-1], spare[:-1], out=more)
                behind_first += bits
                step += step
                np.subtract(run[:-1], passed[lo + 1 : hi + 1], out=gone)
                np.greater(gone, base[1:], out=more)
                behind_first += bits
                np.maximum(base[1:], gone, out=here[1:])
            if behind is not None:
                np.putmask(here[late:], behind, LOW)
            if i == 0:
                step |= np.uint8(_STOP)
            elif mode == "local":
                step |= (base <= 0).view(np.uint8) * np.uint8(_STOP)
            if prior_lo is not None:
                for x, y in ((prior_lo, min(lo, prior_hi + 1)), (max(hi + 1, prior_lo), prior_hi + 1)):
                    if x < y:
                        H[x + 1 : y + 1] = P[x + 1 : y + 1] = LOW
            prior_lo, prior_hi = lo, hi
            a, b = begun[i], begun[i + 1]
            if mode == "local":
                value = here.max(axis=0)
                at_best = a + np.flatnonzero(value[a:] > final[a:])
                if len(at_best):
                    final[at_best], made.end_i[at_best], made.end_j[at_best] = value[at_best], i, lo + here[:, at_best].argmax(axis=0)
            elif b > a:
                place = nr[a:b] if mode == "global" else lo + here[:, a:b].argmax(axis=0)
                final[a:b], made.end_i[a:b], made.end_j[a:b] = H[place + 1, np.arange(a, b)], i, place
        out.score[some] = np.where(final > LOW / 2, final, np.nan)
        return made


def _followed(parts: list[tuple[_Made, np.ndarray]], out: Paths) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Follows the steps of some columns of slices back from their ends; whose each step is, its kind and size."""
    cells, lines = np.cumsum([0, *(len(m.steps) for m, _ in parts)]), np.cumsum([0, *(len(m.base) for m, _ in parts)])
    steps = np.concatenate([m.steps for m, _ in parts])
    base = np.concatenate([m.base + c for (m, _), c in zip(parts, cells.tolist(), strict=False)])
    line, wide = (np.repeat(x, [len(k) for _, k in parts]) for x in (lines[:-1], [len(m.where) for m, _ in parts]))
    column = np.concatenate([k for _, k in parts])
    where, i, j = (np.concatenate([x[k] for x, k in y]) for y in zip(*(((m.where, k), (m.end_i, k), (m.end_j, k)) for m, k in parts), strict=True))
    out.q_hi[where], out.r_hi[where] = i, j
    count = len(where)
    track = np.zeros((int((i + j).max(initial=0)) + 1, count), np.uint8)
    going, gap, turn = np.arange(count), np.zeros(count, np.uint8), 0
    while len(going):
        cell = steps[base[line + i] + j * wide + column] + gap
        how, gap = _HOW[cell], _AFTER[cell]
        track[turn, going] = OPS[how]
        i, j, turn = i - (how & 1), j - ((how == PAIR) | (how == GONE)), turn + 1
        if turn % 4 == 0 or not how.any():
            stay = how != STOP
            ended = going[~stay]
            out.q_lo[where[ended]], out.r_lo[where[ended]] = i[~stay], j[~stay]
            going, gap, line, wide, column, i, j = (x[stay] for x in (going, gap, line, wide, column, i, j))
    track = np.ascontiguousarray(track[:turn][::-1].T)
    at = np.flatnonzero(track)
    own, owner = track.ravel()[at], at // max(turn, 1)
    starts = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])])[: len(own)])
    return where[owner[starts]], own[starts], np.diff(np.append(starts, len(own)))


def path_score(query: np.ndarray, reference: np.ndarray, ops: list[tuple[str, int]], s: Scores) -> float:
    """The score of a path of M, =, X, D and I over all of both; deletions before and behind the read cost nothing."""
    q_run, r_run = (run_lengths(np.asarray(x)) for x in (query, reference))
    i, j, total = 0, 0, 0.0
    for k, (op, n) in enumerate(ops):
        if op in "DI":
            runs = r_run[j : j + n] if op == "D" else q_run[i : i + n]
            if op == "I" or 0 < k < len(ops) - 1:
                total -= s.open / (runs[0] if s.scale == "both" else 1) + (s.extend / (runs if s.scale != "none" else np.ones(n))).sum()
            i, j = i + n * (op == "I"), j + n * (op == "D")
        else:
            same = query[i : i + n] == reference[j : j + n]
            total += s.match * same.sum() + s.mismatch * (~same).sum()
            i, j = i + n, j + n
    return float(total)


def path_scores(queries: Sequence[np.ndarray], references: Sequence[np.ndarray], paths: Sequence[list[tuple[str, int]]], s: Scores) -> np.ndarray:
    """``path_score`` of many pairs together."""
    owner = np.repeat(np.arange(len(paths)), [len(p) for p in paths])
    return flat_path_scores(Flat.of(queries), Flat.of(references), owner, np.array([ord(o) for p in paths for o, _ in p], np.int64), np.array([m for p in paths for _, m in p], np.int64), s)


def flat_path_scores(query: Flat, ref: Flat, owner: np.ndarray, kind: np.ndarray, size: np.ndarray, s: Scores) -> np.ndarray:
    """``path_score`` of each pair from the steps of all: whose (rising), of which kind and size."""
    n = len(query.first) - 1
    if not len(kind):
        return np.zeros(n)
    put, gone = kind == ord("I"), kind == ord("D")
    first = np.searchsorted(owner, np.arange(n + 1))
    inner = (np.arange(len(kind)) > first[owner]) & (np.arange(len(kind)) < first[owner + 1] - 1)

    def begins(side: Flat, takes: np.ndarray) -> np.ndarray:
        moved = np.cumsum(size * takes) - size * takes
        return side.first[owner] + moved - moved[first[:-1].clip(max=len(kind) - 1)][owner]

    q_at, r_at = begins(query, ~gone), begins(ref, ~put)
    pair = ~put & ~gone
    same = query.data[spread(q_at[pair], size[pair])] == ref.data[spread(r_at[pair], size[pair])]
    total = np.bincount(np.repeat(owner[pair], size[pair]), np.where(same, s.match, s.mismatch), n)
    for side, some, at in ((query, put & (size > 0), q_at), (ref, gone & inner & (size > 0), r_at)):
        opening, going = side.costs(s)
        total -= np.bincount(owner[some], opening[at[some]], n)
        total -= np.bincount(np.repeat(owner[some], size[some]), going[spread(at[some], size[some])], n)
    return total


def cigar(ops: list[tuple[str, int]], before: int = 0, after: int = 0) -> str:
    """With what is clipped at both ends."""
    return "".join(f"{n}{op}" for op, n in [("S", before), *ops, ("S", after)] if n)


def gapped_alignment(scores: Scores = Scores(), mode: str = "local"):
    """A column of (score, q_start, q_end, r_start, r_end, cigar) from columns of a query and a reference; null where either is."""
    @F.pandas_udf("struct<score:double,q_start:long,q_end:long,r_start:long,r_end:long,cigar:string>")
    def aligned(query: pd.Series, reference: pd.Series) -> pd.DataFrame:
        known = (query.notna() & reference.notna()).to_numpy()
        sides = [[np.frombuffer(x.encode(), np.uint8) for x in c[known]] for c in (query, reference)]
        found = align(*sides, scores, mode)
        clips = ((lo, len(q) - hi) if mode == "local" and o else (0, 0) for o, q, lo, hi in zip(found.ops, sides[0], found.q_lo.tolist(), found.q_hi.tolist(), strict=True))
        texts = [cigar(o, *c) for o, c in zip(found.ops, clips, strict=True)]
        columns = {"score": found.score, "q_start": found.q_lo, "q_end": found.q_hi, "r_start": found.r_lo, "r_end": found.r_hi, "cigar": texts}
        # whole numbers as objects, so that rows without a pair can be null beside them
        said = pd.DataFrame({n: pd.Series(c, index=np.flatnonzero(known), dtype="float64" if n == "score" else object) for n, c in columns.items()})
        return said.reindex(range(len(query))).astype(object).where(lambda x: x.notna(), None)

    return aligned
