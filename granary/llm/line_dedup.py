"""Fuzzy line dedup: signatures of adjacent words, edit similarity, connected groups, one line a group.

Lines are normalised to their lower-cased words.  Equal normalised lines are one
class.  Two lines are alike when the edit distance of their words is a share of
1 - S of the longer one's words at most.  SimHash blocks can't find these pairs
(README), so the candidates come from signatures that lose none of them:

* A gram is three adjacent words (two in the shortest lines).  All grams of all
  lines stand in one order, and a line's signatures are its first grams in that
  order: as many as no edits that the similarity allows could all destroy.  An
  edit of a word destroys the grams in a window of three places, a word put in
  those in a window of two, so what is counted is how many such windows the
  places of the chosen grams need.  Of two alike lines one signature at least is
  left over, aligned, and is a signature of the other.
* Rare grams come first in the order, and among these the ones whose middle word
  has the least hash of the three: they are never adjacent, so fewer are needed.
* Classes that share a signature are candidates if their numbers of words, the
  places of the signature in them and the parities of their words' hashes allow
  the similarity.  Candidates are verified by the edit distance of all their words.

Each class is verified first with the candidates whose parities are likest.
Groups are built from these links, and then all candidates that are not yet in
one group are verified, so no pair that could join two groups is left out.  A
signature with more than ``SMALL`` classes gives but a few candidates at first;
later all its classes that are in different groups are compared, in pairs of
chunks dealt over the cluster: first each with the few likest ones, then, when
groups have grown by these, all that are still apart.  A pair is looked at under
the first of its frequent signatures alone, and its words are compared there, so
that only links that join two groups come out.  Of each group the line of the
smallest document stays.

Texts are taken apart once: lines, and the words of different lines as 32-bit codes, are
written, and all later steps read these.  Most signatures are of one class only.  So four bytes
of each are dealt to buckets first, and what occurs twice is marked in one table of bits for
all tasks; only signatures that are marked there travel with their classes, places and
parities, as packed arrays, one row for each task and bucket.  A bit can be set by another
signature: then one travels in vain, and none is left out.  Very frequent signatures are
dealt over several buckets.  Shuffled files of a step are let go of when its result is written.

Defined cases: null texts stay null, empty texts stay empty, lines of fewer
than ``min_words`` words are never touched; a repeated row loses the lines that
an earlier one holds (so that a text can become empty); ties go to the smaller
key, then to the earlier row and line, null keys last; empty tables give empty
results; a text of any length is held whole by one task; columns of any name pass
through.  Lines are equal by 64-bit hashes of their words; the edit distance compares
words by 20 bits of their hashes, behind parities by seven or eight other bits, so that two lines
at the very edge of the similarity can be taken for a little more alike than they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm import textbatch as tb
from granary.llm.components import components
from granary.llm.storage import col, cut, discard, free_name, let_go

MIN_WORDS = 5
SIMILARITY = 0.8
#: Up to so many classes of a signature are all candidates at once; of more, each with so many before it first.
SMALL, FIRST_LAGS = 128, 8
#: Classes in a chunk of a signature that has more than SMALL, and candidates of a class in another chunk that are verified first.
CHUNK, BEST = 2048, 3
#: Counters of grams; any order of grams is right, rare ones first is quick.
COUNTERS = 1 << 22
#: Counters in one row on the way.
COUNTED_TOGETHER = 1 << 16
#: A signature that is counted more often is dealt over so many more buckets.
SALT_CLASSES = 200_000
#: Lines of more words take a number of signatures that is enough wherever they stand.
COUNTED_WORDS = 1024
#: Signatures in a bucket, about, and in the arrays that a task holds before it passes them on.
BUCKET_ROWS, HELD_ROWS = 1 << 24, 1 << 20
#: Rows of up to 100 bytes that are broadcast at most; beyond it the same join shuffles.
BROADCAST_ROWS = 200_000
#: Classes (8 bytes each) that are broadcast at most.
BROADCAST_NODES = 500_000
#: Bits that say which classes' words are wanted; what they let through in error falls away in a join.
WANTED_BITS = 24
#: Pairs that a task looks at together, and numbers of the edit distances that it works out together.
PAIRS, CELLS = 1 << 18, 1 << 21
#: Pairs of lines of so many words are compared one by one.
LONG_PAIR = 400
#: Lines of so many words carry twice 64 parities: in 64, lines that have nothing in common differ in about as many as are allowed.
LONG = 45
#: Lines of so many words carry four times 64.
LONGER = 100
#: Sets of 64 parities by which classes of a frequent signature are told apart.
PARITIES = 4
#: Grams that are counted together.
GRAMS = 1 << 22
#: Words in one row of codes, about, and words that a task looks at together.
CODED_ROW, CODED_WORDS = 1 << 16, 1 << 19
#: Bits, at most, that say which signatures occur twice: their number grows with the lines up to this.
SHARED_BITS = 30
#: Words that the edit distance tells apart.
SYMBOLS = 0xE0000

_LINES = 1 << 16  # sorted together
_TOKEN_BITS, _PLACE_BITS, _NONE = 48, 14, (1 << 14) - 1
_NO_SALT = -1


def normalised(found: tb.Texts) -> tuple[tb.Spans, np.ndarray, np.ndarray]:
    """Lines, where each line's words begin (one more number than lines), word hashes."""
    rows = tb.lines(found)
    lowered = found.lowered()
    words = tb.spans(lowered, tb.NOT_WORD)
    return rows, np.concatenate([np.searchsorted(words.start, rows.start), [len(words.start)]]) if len(rows.start) else np.zeros(1, np.int64), tb.hashes(lowered.data, words.start, words.end)


def _line_numbers(rows: tb.Spans, n: int) -> np.ndarray:
    return np.arange(len(rows.owner)) - rows.first_of(n)[:-1][rows.owner]


def read_lines(whole: DataFrame, min_words: int) -> DataFrame:
    """Rows of three kinds, told by what is not null.

    ``n_lines`` of each row (``uid``, ``key``); ``line`` with class hashes ``h1`` and ``h2`` of each line
    with enough words; ``words``, the codes of the words of lines of ``sizes`` words and classes ``cids``,
    a class once a task.
    """
    binary = ("words", "sizes", "cids")
    key = whole.schema["key"].dataType
    schema = T.StructType([T.StructField("uid", T.LongType()), T.StructField("key", key), *(T.StructField(c, T.LongType()) for c in ("n_lines", "line", "h1", "h2")), *(T.StructField(c, T.BinaryType()) for c in binary)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, some = [np.zeros(0, np.uint64)], 0
        for part in tb.slices(batches, "text"):
            kinds = {c: part.schema.field(c).type if c == "key" else pa.binary() if c in binary else pa.int64() for c in schema.names}

            def rows(n: int, kinds: dict = kinds, **columns: pa.Array) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, t) for c, t in kinds.items()], list(kinds))

            found = tb.texts(part.column("text"))
            lines, first, code = normalised(found)
            yield rows(len(part), uid=part.column("uid"), key=part.column("key"), n_lines=pa.array(np.diff(lines.first_of(len(found)))))
            number, n = _line_numbers(lines, len(found)), np.diff(first)
            full = np.flatnonzero(n >= min_words)
            h1, h2 = (tb.sequence_hashes(code, first, s)[full] for s in (1, 2))
            owner = pa.array(lines.owner[full])
            yield rows(len(full), uid=part.column("uid").take(owner), key=part.column("key").take(owner), line=pa.array(number[full]), **{c: pa.array(x.view(np.int64)) for c, x in (("h1", h1), ("h2", h2))})
            cid, once = np.unique(h1, return_index=True)
            new = np.ones(len(cid), bool)
            for known in seen:
                new &= ~tb.among(cid, known)
            seen.append(cid[new])
            while len(seen) > 1 and len(seen[-2]) <= 2 * len(seen[-1]):  # few sorted arrays, each at least twice as long as the next
                seen[-2:] = [np.sort(np.concatenate(seen[-2:]))]
            at = np.sort(once[new])
            if len(at):
                chosen, own = full[at], h1[at]
                place, _ = _stretches(first[chosen], n[chosen])
                short = _code(code[place])
                ends = np.concatenate([[0], np.cumsum(n[chosen])])
                cuts = np.flatnonzero(np.diff(ends[:-1] // CODED_ROW)) + 1
                for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
                    arrays = {"words": short[ends[low] : ends[high]], "sizes": n[chosen][low:high].astype(np.int32), "cids": own[low:high]}
                    yield rows(1, **{c: pa.array([x.tobytes()], pa.binary()) for c, x in arrays.items()})

    return whole.select("uid", "key", "text").mapInArrow(run, schema)


def _stretches(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the stretches one after the other, and where each stretch begins among them."""
    first = np.concatenate([[0], np.cumsum(size)])
    return np.arange(first[-1]) + np.repeat(start - first[:-1], size), first


def _code(word: np.ndarray) -> np.ndarray:
    """32 bits of a word's hash: its symbol, and as many further values as there is room for."""
    return (word % np.uint64(SYMBOLS) + np.uint64(SYMBOLS) * ((word >> np.uint64(40)) % np.uint64((1 << 32) // SYMBOLS))).astype(np.uint32)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Where lines begin (one more number than lines), codes of their words, their classes: of rows of codes, or of texts, then of all lines."""

    def joined(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        code, size, cid = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        return np.concatenate([[0], np.cumsum(size.astype(np.int64))]), code, cid

    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if "text" in batch.schema.names:
            for part in tb.slices(iter([batch]), "text"):
                _, first, code = normalised(tb.texts(part.column("text")))
                yield first, _code(code), tb.sequence_hashes(code, first, 1)
            continue
        for row in zip(*(batch.column(c) for c in ("words", "sizes", "cids")), strict=True):
            held.append(tuple(np.frombuffer(x.as_buffer(), t) for x, t in zip(row, (np.uint32, np.int32, np.uint64), strict=True)))
            if sum(len(x[0]) for x in held) >= CODED_WORDS:
                yield joined(held)
    if held:
        yield joined(held)


def _spread(code: np.ndarray) -> np.ndarray:
    return tb.mix(code.astype(np.uint64) + np.uint64(1))


def _parities(code: np.ndarray, first: np.ndarray, chosen: np.ndarray) -> Iterator[np.ndarray]:
    """Twice 64 bits: of how many words with one value of seven hash bits a line has an odd number; an edit changes two at most.  Then the same of the words with an eighth bit set."""
    bit, half = np.uint64(1) << (code >> np.uint64(58)), (code >> np.uint64(57)) & np.uint64(1)
    eighth = (code >> np.uint64(56)) & np.uint64(1) > 0
    for k in (half == 0, half == 1, (half == 0) & eighth, (half == 1) & eighth):
        upto = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(np.where(k, bit, np.uint64(0)))])
        yield upto[first[chosen + 1]] ^ upto[first[chosen]]


def _edits(n: np.ndarray | int, similarity: float) -> np.ndarray:
    return np.floor(n * (1 - similarity) + 1e-9).astype(np.int64)


class Grams:
    """How many words make a gram, and when the chosen ones are enough for the similarity.

    With w windows of ``size`` places needed to cover all chosen grams and v of
    ``size`` - 1 places, a line of m words is safe from another of n words if
    the edits e = (1 - S) max(m, n) can't cover them: for n <= m if w > e; for
    n = m + d, of whose e edits d put words in, if w > e or v > 2 e - d.
    """

    def __init__(self, similarity: float, min_words: int) -> None:
        self.similarity, self.ratio = similarity, 1 / (1 - similarity) if similarity < 1 else np.inf
        words = np.arange(min_words, 1000)
        whole3, whole2 = (self.enough(words, self._windows(words - size + 1, size), self._windows(words - size + 1, size - 1)) for size in (3, 2))
        #: Lines of so many words have grams of three words; those of fewer, and all that could be alike to them, of two.
        self.three = min_words + int(np.flatnonzero(~whole3).max(initial=-1)) + 1
        self.two = int(np.floor((self.three - 1) / similarity + 1e-9)) if self.three > min_words else 0
        if not whole2[words <= self.two].all():
            raise ValueError(f"lines of {min_words} words and a similarity of {similarity} need not share two adjacent words")

    @staticmethod
    def _windows(places: np.ndarray, size: int) -> np.ndarray:
        return -(-np.maximum(places, 0) // size)

    def enough(self, m: np.ndarray, w: np.ndarray, v: np.ndarray) -> np.ndarray:
        if self.similarity >= 1:
            return w >= 1
        return (w > _edits(m, self.similarity)) & ((self.ratio * w > m / self.similarity + 1e-6) | (v + (self.ratio - 2) * w > m + 1e-6))

    def always(self, m: np.ndarray, size: int) -> np.ndarray:
        """Chosen places that are enough wherever they are."""
        return np.floor(size * (1 - self.similarity) * m + 1e-6).astype(np.int64) + 1


def _places(first: np.ndarray, chosen: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the chosen lines' grams: the line's place in ``chosen``, the first word's place, its number in its line."""
    n = np.maximum(first[chosen + 1] - first[chosen] - size + 1, 0)
    owner = np.repeat(np.arange(len(chosen)), n)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    return owner, first[chosen][owner] + number, number


def _counter(gram: np.ndarray) -> np.ndarray:
    return (gram & np.uint64(COUNTERS - 1)).astype(np.int64)


def gram_counts(whole: DataFrame, grams: Grams, min_words: int) -> np.ndarray:
    """How often the grams of each counter occur in the corpus: in texts, or in rows of codes.

    A task for each core counts in arrays, so that what is shuffled is a number a core and counter
    at most, whatever the size of the corpus.
    """
    schema = "part int, counts binary"

    def rows(counts: dict[int, np.ndarray]) -> pa.RecordBatch:
        short = (x.astype(np.min_scalar_type(x.max())).tobytes() for x in counts.values())  # their bytes go by the greatest
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(short), pa.binary())], ["part", "counts"])

    def unpacked(counts: pa.Scalar) -> np.ndarray:
        data = counts.as_buffer()
        return np.frombuffer(data, f"u{data.size // COUNTED_TOGETHER}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, many = np.zeros(COUNTERS, np.int64), [np.zeros(0, np.int64)], 0
        for first, short, _ in _coded(batches):
            n, code = np.diff(first), _spread(short)
            for size, low, high in ((2, min_words, grams.two), (3, grams.three, n.max(initial=0))):
                _, at, _ = _places(first, np.flatnonzero((n >= low) & (n <= high)), size)
                held.append(_counter(tb.window_hashes(code, size)[at]))
                many += len(at)
            if many >= GRAMS:
                total += np.bincount(np.concatenate(held), minlength=COUNTERS)
                held, many = held[:1], 0
        total += np.bincount(np.concatenate(held), minlength=COUNTERS)
        del held[1:]
        for part, counts in enumerate(total.reshape(-1, COUNTED_TOGETHER)):
            if counts.any():
                yield rows({part: counts})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                some = unpacked(counts)
                total[part] = total[part] + some if part in total else some.astype(np.int64)
        for part, counts in total.items():
            yield rows({part: counts})

    read = whole.select("text") if "text" in whole.columns else whole
    counted = read.coalesce(whole.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, schema)
    got = counted.repartition("part").mapInArrow(added, schema).toArrow()
    total = np.zeros(COUNTERS, np.int64)
    for part, counts in zip(got.column("part").to_pylist(), got.column("counts"), strict=True):
        total[part * COUNTED_TOGETHER :][:COUNTED_TOGETHER] = unpacked(counts)
    return total


class Order:
    """The order of all grams, and over how many buckets a frequent one is dealt."""

    def __init__(self, counts: np.ndarray) -> None:
        usual = max(1.0, float(counts.mean()))
        # 0 to 13, 0 for what is not much more frequent than usual; a few at a time, as the driver does this
        parts = np.split(counts, range(COUNTED_TOGETHER, len(counts), COUNTED_TOGETHER))
        self.level = np.concatenate([np.clip(np.ceil(np.log2(np.maximum(x, 1) / usual)) - 2, 0, 13).astype(np.uint8) for x in parts])
        self.often = np.concatenate([np.flatnonzero(x > SALT_CLASSES) + k * COUNTED_TOGETHER for k, x in enumerate(parts)])
        self.many = np.minimum(-(-counts[self.often] // SALT_CLASSES), 1 << 20)

    def salts(self, counter: np.ndarray) -> np.ndarray:
        out = np.ones(len(counter), np.int64)
        if len(self.often):
            at = np.minimum(np.searchsorted(self.often, counter), len(self.often) - 1)
            out = np.where(self.often[at] == counter, self.many[at], out)
        return out

    def tokens(self, code: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """48 bits for each gram: its level, whether it is the lesser choice there, its hash."""
        gram = tb.window_hashes(code, size)[at]
        level = self.level[_counter(gram)].astype(np.uint64)
        if size == 3:
            lesser = (code[at + 1] > code[at]) | (code[at + 1] > code[at + 2])
            level = np.minimum(2 * level + lesser, 15).astype(np.uint64)
        return (level << np.uint64(44)) | (gram & np.uint64((1 << 44) - 1))


def _windows_needed(place: np.ndarray, chosen: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """For each line how many windows of ``size`` places cover all of its places.

    The places rise over all lines; ``ends``: where each line's end among them;
    ``chosen``: how many of them are before each place.
    """
    out = np.zeros(len(ends), np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    then = chosen[np.minimum(place + size, len(chosen) - 1)]
    active = np.flatnonzero(ends > begins)
    at = begins[active]
    while len(active):
        out[active] += 1
        at = then[at]
        more = at < ends[active]
        at, active = at[more], active[more]
    return out


def signatures(code: np.ndarray, first: np.ndarray, chosen: np.ndarray, size: int, order: Order, grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each line of ``chosen`` its first grams: the line's place in ``chosen``, the token, its place in the line or none if it has several."""
    out = []
    for low in range(0, len(chosen), _LINES):
        part = chosen[low : low + _LINES]
        owner, at, number = _places(first, part, size)
        if not len(at):
            continue
        m = first[part + 1] - first[part]
        key = (owner.astype(np.uint64) << np.uint64(_TOKEN_BITS)) | order.tokens(code, at, size)
        by = np.argsort(key, kind="stable")
        ordered = key[by]
        begin = np.searchsorted(owner, np.arange(len(part) + 1))
        # the number of grams is searched between what is needed at least and what is always enough
        most = np.minimum(grams.always(m, size), np.diff(begin))
        least = np.minimum(_edits(m, grams.similarity) + 1, most)
        least = np.where(m > COUNTED_WORDS, most, least)
        while (open_ := np.flatnonzero(least < most)).size:
            half = (least + most) // 2
            limit = ordered[begin[:-1] + half - 1]
            is_open = np.zeros(len(part), bool)
            is_open[open_] = True
            taken = (key <= limit[owner]) & is_open[owner]
            ends = np.concatenate([[0], np.cumsum(taken)])[begin[1:]]
            place = at[taken]
            mark = np.zeros(len(code) + 2, bool)
            mark[place + 1] = True
            chosen_before = np.cumsum(mark)
            w, v = (_windows_needed(place, chosen_before, ends, s) for s in (size, size - 1))
            good = grams.enough(m, w, v)
            most = np.where(is_open & good, half, most)
            least = np.where(is_open & ~good, half + 1, least)
        limit = ordered[begin[:-1] + np.maximum(most, 1) - 1]
        line = owner[by]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        several = np.concatenate([~new[1:], [False]])
        use = np.flatnonzero(new & (ordered <= limit[line]))
        place = np.where(several[use], _NONE, np.minimum(number[by[use]], _NONE))
        out.append((line[use] + low, ordered[use] & np.uint64((1 << _TOKEN_BITS) - 1), place))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


_PACKED = {"low": np.uint32, "top": np.uint8, "words": np.uint8, "words_top": np.uint8, "place": np.uint8, "place_top": np.uint8, "cid": np.int64, "odd": np.int64, "odd2": np.int64}
_MORE = ("odd3", "odd4")
_COLUMNS = (*_PACKED, *_MORE)


def _packed(bucket: np.ndarray, salt: np.ndarray, token: np.ndarray, words: np.ndarray, place: np.ndarray, cid: np.ndarray, odd: np.ndarray, odd2: np.ndarray, *more: np.ndarray) -> pa.RecordBatch:
    """One row for each stretch of equal ``bucket`` and ``salt``; bytes of a kind lie together, only long lines have ``odd2`` and only longer ones ``more``."""
    heads = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (salt[1:] != salt[:-1])]))
    ends = np.concatenate([heads, [len(bucket)]])
    long, longer = words >= LONG, words >= LONGER
    columns = {"low": token, "top": token >> np.uint64(32), "words": words, "words_top": words >> 8, "place": place, "place_top": place >> 8, "cid": cid, "odd": odd, "odd2": odd2[long]} | {c: x[longer] for c, x in zip(_MORE, more, strict=False)}
    out = [pa.array(bucket[heads].astype(np.int32)), pa.array(salt[heads].astype(np.int32))]
    for name, values in columns.items():
        some = {"odd2": long}.get(name, longer if name in _MORE else None)
        offsets = ends if some is None else np.concatenate([[0], np.cumsum(some)])[ends]
        data = np.ascontiguousarray(values.astype(_PACKED.get(name, np.int64)))
        out.append(pa.BinaryArray.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer((offsets * data.itemsize).astype(np.int32)), pa.py_buffer(data)]))
    return pa.RecordBatch.from_arrays(out, ["bucket", "salt", *columns])


def _values(rows: pa.RecordBatch, name: str) -> np.ndarray:
    column = rows.column(name)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].view(_PACKED.get(name, np.int64))


def _more(rows: pa.RecordBatch, words: np.ndarray) -> Iterator[np.ndarray]:
    """The further parities, zero for lines that have none."""
    for name in _MORE:
        out = np.zeros(len(words), np.int64)
        out[words >= LONGER] = _values(rows, name)
        yield out


def _unpacked(rows: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Rest of the token, words, place, class, parities: all in the first 64 bits of short lines, half in either of long ones."""
    low, top, words, words_top, place, place_top, cid, odd, some = (_values(rows, name) for name in _PACKED)
    words, place = (x.astype(np.int64) | y.astype(np.int64) << 8 for x, y in ((words, words_top), (place, place_top)))
    odd2 = np.zeros(len(cid), np.int64)
    odd2[words >= LONG] = some
    return low.astype(np.uint64) | top.astype(np.uint64) << np.uint64(32), words, place, cid, odd, odd2


def _signed(batches: Iterator[pa.RecordBatch], order: Order, grams: Grams, min_words: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of some lines at a time: where words begin, their hashes, classes; the lines that signatures are of, and what ``signatures`` finds."""
    for first, short, cid in _coded(batches):
        n, code = np.diff(first), _spread(short)
        for size, low, high in ((2, min_words, grams.two), (3, grams.three, n.max(initial=0))):
            chosen = np.flatnonzero((n >= low) & (n <= high))
            yield first, code, cid, chosen, *signatures(code, first, chosen, size, order, grams)


class Shared:
    """Which signatures occur twice or more, and perhaps a few more."""

    def __init__(self, bits: int, width: int) -> None:
        #: A signature's bucket is its lowest ``bits``, its place in the bucket's bits the next ``width``.
        self.bits, self.width, self.marks = bits, width, np.zeros(1 << (bits + width - 3), np.uint8)

    def has(self, token: np.ndarray) -> np.ndarray:
        at = ((token & np.uint64((1 << self.bits) - 1)) << np.uint64(self.width)) | ((token >> np.uint64(self.bits)) & np.uint64((1 << self.width) - 1))
        return (self.marks[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def shared_signatures(coded: DataFrame, order: Broadcast, grams: Grams, min_words: int, bits: int, width: int) -> Shared:
    """Of all signatures but those that are dealt over several buckets, which occur twice; four bytes of each are shuffled."""

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        token = np.concatenate(held)
        held.clear()
        key = np.sort(((token & np.uint64((1 << bits) - 1)) << np.uint64(32)) | ((token >> np.uint64(bits)) & np.uint64(0xFFFFFFFF)))
        key = key[np.concatenate([np.ones(min(2, len(key)), bool), key[2:] != key[:-2]])]  # twice is enough
        bucket = (key >> np.uint64(32)).astype(np.int32)
        heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        offsets = np.concatenate([heads, [len(key)]]) * 4
        rest = pa.BinaryArray.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(key.astype(np.uint32))])
        return pa.RecordBatch.from_arrays([pa.array(bucket[heads]), rest], ["bucket", "rest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for *_, token, _ in _signed(batches, order.value, grams, min_words):
            held.append(token[order.value.salts(_counter(token)) == 1])
            many += len(held[-1])
            if many >= HELD_ROWS:
                yield sent(held)
                many = 0
        if many:
            yield sent(held)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["bucket"]):
            rest = np.sort(np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in rows.column("rest")]))
            twice = np.zeros(1 << width, bool)
            twice[rest[1:][rest[1:] == rest[:-1]] & np.uint32((1 << width) - 1)] = True
            yield pa.RecordBatch.from_arrays([rows.column("bucket")[:1], pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())], ["bucket", "rest"])

    schema = "bucket int, rest binary"
    dealt = coded.mapInArrow(run, schema).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(marked, schema)
    out = Shared(bits, width)
    for batch in dealt.toArrow().to_batches():
        for bucket, marks in zip(batch.column("bucket").to_pylist(), batch.column("rest"), strict=True):
            out.marks.reshape(1 << bits, -1)[bucket] = np.frombuffer(marks.as_buffer(), np.uint8)
    return out


def _members(coded: DataFrame, order: Broadcast, shared: Shared, grams: Grams, min_words: int, bits: int) -> DataFrame:
    """``bucket``, ``salt`` and packed arrays (``_PACKED``) of the rest of the token, words, place, class and parities, of shared signatures; a class once a task for each."""
    shared = coded.sparkSession.sparkContext.broadcast(shared)  # bounded by SHARED_BITS
    buckets = np.uint64((1 << bits) - 1)

    def packed(held: list[tuple]) -> pa.RecordBatch:
        token, salt, words, place, cid, *odd = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        bucket = (token & buckets).astype(np.int64)
        by = np.lexsort((salt, bucket)) if (salt != _NO_SALT).any() else np.argsort(bucket, kind="stable")
        return _packed(*(x[by] for x in (bucket, salt, token >> np.uint64(bits), words, place, *(v.view(np.int64) for v in (cid, *odd)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for first, code, cid, chosen, line, token, place in _signed(batches, order.value, grams, min_words):
            salts = order.value.salts(_counter(token))
            keep = np.flatnonzero((salts > 1) | shared.value.has(token))
            line, token, place, salts = line[keep], token[keep], place[keep], salts[keep]
            own, n = cid[chosen][line], np.diff(first)[chosen]
            odd, odd2, *more = _parities(code, first, chosen)
            odd = np.where(n >= LONG, odd, odd ^ odd2)
            salt = np.where(salts > 1, (tb.mix(own) % salts.astype(np.uint64)).astype(np.int64), _NO_SALT)
            held.append((token, salt, np.minimum(n, _NONE)[line], place, own, *(x[line] for x in (odd, odd2, *more))))
            many += len(token)
            if many >= HELD_ROWS:
                yield packed(held)
                many = 0
        if many:
            yield packed(held)

    return coded.mapInArrow(run, f"bucket int, salt int, {', '.join(f'{x} binary' for x in _COLUMNS)}")


def _possible(n: np.ndarray, place: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs can be alike: words put in or left out before and behind an aligned signature are edits."""
    longer = np.maximum(n[a], n[b])
    most = np.where(longer == _NONE, np.iinfo(np.int64).max, _edits(longer, similarity))  # clipped
    shift, all_of = place[a] - place[b], n[a] - n[b]
    apart = np.where((place[a] == _NONE) | (place[b] == _NONE), np.abs(all_of), np.abs(shift) + np.abs(all_of - shift))
    return apart <= most


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of each stretch of equal keys, in one batch; a task holds one stretch and one batch at a time."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not len(b):
            continue
        values = [b.column(k).to_numpy() for k in keys]
        change = np.flatnonzero(np.logical_or.reduce([v[1:] != v[:-1] for v in values])) + 1
        for low, high in zip([0, *change.tolist()], [*change.tolist(), len(b)], strict=True):
            if held and not low and any(held[-1].column(k)[-1].as_py() != v[0] for k, v in zip(keys, values, strict=True)):
                yield pa.concat_batches(held)
                held = []
            elif held and low:
                yield pa.concat_batches(held)
                held = []
            held.append(b.slice(low, high - low))
    if held:
        yield pa.concat_batches(held)


CANDIDATES = "a long, b long, differ int, token long"


def candidates(members: DataFrame, similarity: float, bits: int) -> DataFrame:
    """Rows ``a``, ``b`` and how much they ``differ``, about: all possible pairs of few classes, the first ones of many.

    Of signatures with many classes, or dealt over several buckets, the classes
    come too: ``a`` is null, ``b`` is the class, ``token`` follows.
    """
    names = ["a", "b", "differ", "token"]

    def pairs_of(cid: np.ndarray, token: np.ndarray, n: np.ndarray, place: np.ndarray, odd: np.ndarray, odd2: np.ndarray, *more: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        def good(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
            keep = _possible(n, place, a, b, similarity)
            a, b = a[keep], b[keep]
            x, y = odd[a] ^ odd[b], odd2[a] ^ odd2[b]
            # of a short line and a long one all are put together
            one, both = (_ones(v) for v in (np.where((n[a] >= LONG) == (n[b] >= LONG), x, x ^ y), y))
            differ = one + np.where((n[a] >= LONG) & (n[b] >= LONG), both, 0)
            k = np.flatnonzero((n[a] >= LONGER) & (n[b] >= LONGER))
            differ[k] = sum(_ones(u) + _ones(u ^ v) for u, v in zip((m[a[k]] ^ m[b[k]] for m in more), (x[k], y[k]), strict=True))
            keep = _odd_enough(n[a], n[b], differ, similarity)
            return cid[a][keep], cid[b][keep], differ[keep]

        heads = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        size = np.diff(np.concatenate([heads, [len(cid)]]))
        number, many = np.arange(len(cid)) - np.repeat(heads, size), np.repeat(size, size)
        at = np.flatnonzero((many > SMALL) & (number > FIRST_LAGS))
        yield good(at - number[at], at)
        before = np.where(many <= SMALL, number, np.minimum(number, FIRST_LAGS))
        block = np.cumsum(before) // PAIRS
        for k in np.unique(block[before > 0]).tolist():
            some = np.flatnonzero((block == k) & (before > 0))
            b = np.repeat(some, before[some])
            lag = np.arange(len(b)) - np.repeat(np.cumsum(before[some]) - before[some], before[some]) + 1
            yield good(b - lag, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["bucket", "salt"]):
            token, n, place, cid, *odd = _unpacked(rows)
            odd = (*odd, *_more(rows, n))
            salted = rows.column("salt")[0].as_py() != _NO_SALT
            if not salted:  # signatures of one class have no pairs
                at = np.sort(token)
                several = tb.among(token, np.unique(at[1:][at[1:] == at[:-1]]))
                token, n, place, cid, *odd = (x[several] for x in (token, n, place, cid, *odd))
            by = np.lexsort((cid, token))
            token, n, place, cid, *odd = (x[by] for x in (token, n, place, cid, *odd))
            new = np.concatenate([[True], (token[1:] != token[:-1]) | (cid[1:] != cid[:-1])])[: len(cid)]
            token, n, place, cid, *odd = (x[new] for x in (token, n, place, cid, *odd))
            if not len(cid):
                continue
            a, b, differ = (np.concatenate(x) for x in zip(*pairs_of(cid, token, n, place, *odd), strict=True))
            by = np.lexsort((differ, b, a))
            a, b, differ = a[by], b[by], differ[by]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(a)]
            yield pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new]), pa.array(differ[new].astype(np.int32)), pa.nulls(int(new.sum()), pa.int64())], names)
            if salted:
                hot = np.arange(len(cid))
            else:
                _, which, many = np.unique(token, return_inverse=True, return_counts=True)
                hot = np.flatnonzero(many[which] > SMALL)
            whole = ((token[hot] << np.uint64(bits)) | np.uint64(rows.column("bucket")[0].as_py())).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(hot), pa.int64()), pa.array(cid[hot]), pa.nulls(len(hot), pa.int32()), pa.array(whole)], names)

    return members.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt").mapInArrow(run, CANDIDATES)


def _looked_up(few: DataFrame, name: str) -> DataFrame:
    """A table for the small side of a join: broadcast up to a checked size, else written, so that Spark can split a hot key."""
    few = cut(few, name)
    return F.broadcast(few) if few.count() <= BROADCAST_ROWS else few


def other_links(hot: DataFrame, roots: DataFrame, symbols: DataFrame, similarity: float, best: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``a``, ``b``: links that join all alike classes of a frequent signature that stand in different groups, or each class and those of its ``best`` that are alike; and a table that they are read from.

    Two classes are looked at under the first of the frequent signatures that they share.
    """
    rows = cut(hot.join(roots.withColumnRenamed("node", "b"), "b", "left").select("token", "b", F.coalesce("root", "b").alias("root")), "members")
    split = rows.groupBy("token").agg(F.count("*").alias("many"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("token", "many")
    classes = cut(rows.join(_looked_up(split, "split"), "token").groupBy("b").agg(F.max("root").alias("root"), F.sort_array(F.collect_list(F.struct("token", "many"))).alias("tokens")), "classes")
    discard(rows)
    if classes.count() <= BROADCAST_NODES:
        symbols = symbols.join(F.broadcast(classes.select(F.col("b").alias("cid"))), "cid", "left_semi")  # so that only words of these lines are shuffled
    each = classes.join(symbols.withColumnRenamed("cid", "b"), "b").select("b", "root", "symbols", "tokens", F.posexplode("tokens").alias("place", "at"))
    chunks = F.ceil(F.col("at.many") / CHUNK).cast("int")
    own = each.withColumn("own", F.pmod(F.xxhash64("b"), chunks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    dealt = own.select(F.col("at.token").alias("token"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "b", "root", "symbols", F.slice(F.col("tokens.token"), F.lit(1), F.col("place")).alias("earlier"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["token", "i", "j"]):
            words = [np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in rows.column("symbols").to_pylist()]
            n = np.array([len(x) for x in words])
            by = np.lexsort((rows.column("b").to_numpy(), n))
            own, cid, root, n = (x[by] for x in (*(rows.column(c).to_numpy() for c in ("own", "b", "root")), n))
            words = [words[k] for k in by]
            earlier = _marks([rows.column("earlier")[int(k)].values.to_numpy() for k in by])
            symbol, begin = np.concatenate(words), np.cumsum(n) - n
            odd = _symbol_parities(symbol, begin)
            i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
            # of two chunks the classes of the first meet those of the second, in one chunk each meets those behind it
            left, right = (np.flatnonzero(own == k) for k in (i, j))
            low = np.searchsorted(n[right], np.ceil(n[left] * similarity - 1e-6))
            high = np.searchsorted(n[right], np.floor(n[left] / similarity + 1e-6), side="right")
            if i == j:
                low = np.maximum(low, np.arange(len(left)) + 1)
            many = np.maximum(high - low, 0)
            block = np.cumsum(many) // PAIRS
            for k in np.unique(block[many > 0]).tolist():
                some = np.flatnonzero((block == k) & (many > 0))
                a = np.repeat(left[some], many[some])
                b = right[np.arange(len(a)) - np.repeat(np.cumsum(many[some]) - many[some] - low[some], many[some])]
                keep = root[a] != root[b]
                a, b = a[keep], b[keep]
                differ = sum(np.bitwise_count(x[a] ^ x[b]).astype(np.int64) for x in odd)
                keep = differ <= 2 * _edits(np.maximum(n[a], n[b]), similarity)
                a, b, differ = a[keep], b[keep], differ[keep]
                for x in earlier:
                    keep = (x[a] & x[b]) == 0
                    a, b, differ = a[keep], b[keep], differ[keep]
                if best:
                    keep = _likest(a, differ, best) | _likest(b, differ, best)
                    a, b = a[keep], b[keep]
                found = _alike(symbol, begin, n, a, b, similarity)
                links = []
                for x, y in zip(a[found].tolist(), b[found].tolist(), strict=True):
                    if root[x] != root[y]:
                        root = np.where(root == root[y], root[x], root)
                        links.append((x, y))
                if links:
                    a, b = np.array(links).T
                    yield pa.RecordBatch.from_arrays([pa.array(cid[a]), pa.array(cid[b])], ["a", "b"])

    return dealt.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(run, "a long, b long"), classes


def _marks(lists: list[np.ndarray]) -> list[np.ndarray]:
    """For each list 64 bits at a time: which of the values that stand in several lists are in it."""
    values, number, many = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    shared = np.flatnonzero(many > 1)
    rank = np.full(len(values), -1)
    rank[shared] = np.arange(len(shared))
    at, owner = rank[number][rank[number] >= 0], owner[rank[number] >= 0]
    out = np.zeros((-(-len(shared) // 64), len(lists)), np.uint64)
    np.bitwise_or.at(out, (at // 64, owner), np.uint64(1) << (at % 64).astype(np.uint64))
    return list(out)


def _alike(symbol: np.ndarray, begin: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs of lines have the edit similarity: a band of the matrix, row by row, of many pairs of about the same length at once."""
    a, b = np.where(n[a] <= n[b], a, b), np.where(n[a] <= n[b], b, a)
    edits = _edits(n[b], similarity)
    out, some = np.zeros(len(a), bool), 2
    for k in np.flatnonzero(n[b] >= LONG_PAIR).tolist():
        x, y = (symbol[begin[i] : begin[i] + n[i]].tolist() for i in (a[k], b[k]))
        out[k] = _within_edits(x, y, int(edits[k]))
    left = np.flatnonzero(n[b] < LONG_PAIR)
    while len(left):  # narrow bands first: the time grows with the edits that there are, not with those allowed
        out[left] = _within(symbol, begin, n, a[left], b[left], np.minimum(edits[left], some))
        left = left[~out[left] & (edits[left] > some)]
        some *= 4
    return out


def _within_edits(x: list[int], y: list[int], edits: int) -> bool:
    """The same of one pair of long lines: a column of the matrix is the bits of whole numbers, by Hyyro's recurrences."""
    at: dict[int, int] = {}
    for k, c in enumerate(x):
        at[c] = at.get(c, 0) | 1 << k
    every, last = (1 << len(x)) - 1, 1 << (len(x) - 1)
    more, less, distance = every, 0, len(x)
    for left, c in zip(range(len(y) - 1, -1, -1), y, strict=True):
        same = at.get(c, 0)
        zero = ((((same & more) + more) ^ more) | same | less) & every
        up, down = less | (every & ~(zero | more)), zero & more
        distance += (1 if up & last else 0) - (1 if down & last else 0)
        if distance - left > edits:
            return False
        up, down = (up << 1 | 1) & every, down << 1 & every
        more, less = down | (every & ~(zero | up)), up & zero
    return distance <= edits


def _within(symbol: np.ndarray, begin: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray, edits: np.ndarray) -> np.ndarray:
    """Which lines ``a`` become their ``b``, which are no shorter, by so many edits."""
    out = np.zeros(len(a), bool)
    by = np.flatnonzero(n[b] - n[a] <= edits)
    by = by[np.lexsort((n[a[by]], edits[by]))]
    low = 0
    while low < len(by):
        # a stretch whose bands are at most a quarter wider than that of its first pair
        high = int(np.searchsorted(edits[by], edits[by[low]] * 5 // 4, side="right"))
        high = min(high, low + max(1, CELLS // (2 * int(edits[by[high - 1]]) + 1)))
        at = by[low:high]
        out[at] = _in_band(symbol, begin[a[at]], begin[b[at]], n[a[at]], n[b[at]], edits[at])
        low = high
    return out


def _in_band(symbol: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, edits: np.ndarray) -> np.ndarray:
    """Whether ``n`` symbols at ``x`` become ``m`` (no fewer) at ``y`` by so many edits."""
    out = np.zeros(len(x), bool)
    most = int(edits.max(initial=0))
    step = np.arange(2 * most + 1, dtype=np.int32)
    far = np.int32(1 << 29)
    live = np.arange(len(x))
    row = np.broadcast_to(np.where(step >= most, step - most, far), (len(x), len(step))).astype(np.int32)  # column step - most + the row's number
    for i in range(int(n.max(initial=0)) + 1):
        if i:
            column = i + step - most
            at = np.minimum(y[live, None] + np.clip(column - 1, 0, None), len(symbol) - 1)
            new = row + (symbol[at] != symbol[np.minimum(x[live] + i - 1, len(symbol) - 1)][:, None])
            np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])
            new[:, column < 0] = far
            new[:, column == 0] = i
            row = np.minimum.accumulate(new - step, axis=1) + step
        over = n[live] == i
        if over.any():
            done = live[over]
            out[done] = row[over, np.minimum(m[done] - n[done] + most, 2 * most)] <= edits[done]
        if over.any() or i % 8 == 0:
            going = ~over & (row.min(axis=1) <= edits[live])
            live, row = live[going], row[going]
            if not len(live):
                break
    return out


def _ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64)).astype(np.int64)


def _symbol_parities(symbol: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """``PARITIES`` times 64 bits of each line."""
    bit, kind = np.uint64(1) << (symbol & np.uint32(63)).astype(np.uint64), (symbol >> np.uint32(6)) % np.uint32(PARITIES)
    return np.stack([np.bitwise_xor.reduceat(np.where(kind == k, bit, np.uint64(0)), begin) for k in range(PARITIES)])


def _odd_enough(n: np.ndarray, m: np.ndarray, differ: np.ndarray, similarity: float) -> np.ndarray:
    longer = np.maximum(n, m)
    return (differ <= 2 * _edits(longer, similarity)) | (longer == _NONE)


def _likest(of: np.ndarray, differ: np.ndarray, best: int) -> np.ndarray:
    """Which are among the ``best`` of each number of ``of``, by least ``differ``."""
    by = np.lexsort((differ, of))
    heads = np.concatenate([[True], of[by][1:] != of[by][:-1]])[: len(by)]
    number = np.arange(len(by)) - np.maximum.accumulate(np.where(heads, np.arange(len(by)), 0))
    out = np.zeros(len(of), bool)
    out[by[number < best]] = True
    return out


def _symbols(coded: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cid`` and the words of its line, one character for each distinct word, of all that are wanted and perhaps a few more."""
    low = np.int64((1 << WANTED_BITS) - 1)
    bits = np.zeros(1 << WANTED_BITS, bool)
    bits[wanted.select(F.col("cid").bitwiseAND(F.lit(int(low))).cast("int").alias("bit")).distinct().toArrow().column(0).to_numpy()] = True  # bounded by the number of bits
    shared = coded.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).view(bool)
        for first, code, cid in _coded(batches):
            k = np.flatnonzero(bits[cid.view(np.int64) & low])
            place, begin = _stretches(first[k], first[k + 1] - first[k])
            symbol = code[place] % np.uint32(SYMBOLS) + np.uint32(0x10000)
            lines = [symbol[a:b].tobytes().decode("utf-32-le") for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(cid.view(np.int64)[k]), pa.array(lines, pa.string())], ["cid", "symbols"])

    return coded.mapInArrow(run, "cid long, symbols string").dropDuplicates(["cid"])


def _verified(pairs: DataFrame, symbols: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose lines' words have the edit similarity."""
    nodes = cut(pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct(), "nodes")
    if nodes.count() <= BROADCAST_NODES:
        symbols = symbols.join(F.broadcast(nodes), "cid", "left_semi")  # so that only words of these lines are shuffled
    left, right = (symbols.select(F.col("cid").alias(c), F.col("symbols").alias(f"{c}_symbols")) for c in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            lines = pa.concat_arrays([batch.column("a_symbols"), batch.column("b_symbols")])
            symbol = np.frombuffer("".join(lines.to_pylist()).encode("utf-32-le"), np.uint32)
            n = pc.utf8_length(lines).to_numpy().astype(np.int64)
            begin, a = np.cumsum(n) - n, np.arange(len(batch))
            b, odd = a + len(batch), _symbol_parities(symbol, begin)
            keep = np.abs(n[a] - n[b]) <= _edits(np.maximum(n[a], n[b]), similarity)
            keep &= sum(_ones(x[a] ^ x[b]) for x in odd) <= 2 * _edits(np.maximum(n[a], n[b]), similarity)
            a, b = a[keep], b[keep]
            good = batch.select(["a", "b"]).take(pa.array(a[_alike(symbol, begin, n, a, b, similarity)]))
            yield good

    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "a_symbols", "b_symbols").mapInArrow(run, "a long, b long")


def _groups(coded: DataFrame, lines: int, min_words: int, similarity: float) -> DataFrame:
    """``node`` and ``root`` of each class that is alike to another one, or to one that is, and so on."""
    grams = Grams(similarity, min_words)
    bits = max(12, int(20 * lines // BUCKET_ROWS).bit_length())
    width = max(3, min(SHARED_BITS, int(20 * lines).bit_length()) - bits)
    spark = coded.sparkSession
    order = spark.sparkContext.broadcast(Order(gram_counts(coded, grams, min_words)))  # a byte a counter
    let_go(spark)
    shared = shared_signatures(coded, order, grams, min_words, bits, width)
    let_go(spark)
    found = cut(candidates(_members(coded, order, shared, grams, min_words, bits), similarity, bits), "candidates")
    let_go(spark)
    pairs = cut(found.filter("a IS NOT NULL").groupBy("a", "b").agg(F.min("differ").alias("differ")), "pairs")
    hot = cut(found.filter("a IS NULL").select("b", "token"), "hot")
    discard(found)
    symbols = cut(_symbols(coded, pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).union(hot.select(F.col("b").alias("cid")))), "symbols")
    let_go(spark)

    def grown(linked: DataFrame | None, edges: DataFrame) -> DataFrame:
        """The groups with further links."""
        out = cut(components(edges if linked is None else linked.select(F.col("node").alias("a"), F.col("root").alias("b")).union(edges)), "groups")
        if linked is not None:
            discard(linked)
        let_go(spark)
        return out

    def verified(linked: DataFrame | None, more: DataFrame) -> DataFrame:
        """The groups with what is verified of further pairs."""
        more = cut(more.select("a", "b").distinct(), "more")
        if linked is None or not more.isEmpty():
            linked = grown(linked, _verified(more, symbols, similarity))
        discard(more)
        return linked

    likest = pairs.groupBy("b").agg(F.min_by("a", "differ").alias("a")).select("a", "b").union(pairs.groupBy("a").agg(F.min_by("b", "differ").alias("b")).select("a", "b"))
    linked = verified(None, likest)
    a, b = (linked.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in "ab")
    linked = verified(linked, pairs.join(a, "a", "left").join(b, "b", "left").filter(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")))
    discard(pairs)
    if not hot.isEmpty():
        for best in (BEST, None):
            others, members = other_links(hot, linked, symbols, similarity, best)
            links = cut(others, "links")
            if not links.isEmpty():
                linked = grown(linked, links)
            discard(links, members)
    discard(hot, symbols)
    return linked


def dropped_lines(read: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Lines of a written table of ``read_lines`` that go: ``uid``, ``line``, and ``stays``, the place of the one that stays for it."""
    lines = read.filter("line IS NOT NULL").select("uid", "line", "key", "h1", "h2")
    coded = read.filter("words IS NOT NULL").select("words", "sizes", "cids")
    twice = cut(lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1"), "twice")
    linked = _groups(coded, lines.count(), min_words, similarity)
    roots, twice = (F.broadcast(x) if x.count() <= BROADCAST_NODES else x for x in (linked.withColumnRenamed("node", "h1"), twice))
    grouped = cut(lines.join(roots, "h1", "left").join(twice, ["h1", "h2"], "left").filter("n > 1 OR root IS NOT NULL").select("uid", "line", "key", F.coalesce("root", "h1").alias("root")), "grouped")
    place = F.struct(F.col("key").isNull().alias("none"), "key", "uid", "line")
    stays = cut(grouped.groupBy("root").agg(F.min(place).alias("stays")), "stays")
    found = grouped.drop("key").join(stays, "root")
    return found.filter((F.col("uid") != F.col("stays.uid")) | (F.col("line") != F.col("stays.line"))).select("uid", "line", "stays")


def report(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row a document: key, its lines, how many go, and each of them with the place of the line that stays."""
    read = cut(read_lines(docs.select(F.monotonically_increasing_id().alias("uid"), col(key).alias("key"), col(text).alias("text")), min_words), "lines")
    gone = dropped_lines(read, min_words, similarity)
    said = F.format_string("%d:%s:%d", "line", F.col("stays.key").cast("string"), F.col("stays.line"))
    by_row = gone.groupBy("uid").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", said.alias("said")))), lambda x: x["said"]), ",").alias("removed"))
    all_rows = read.filter("n_lines IS NOT NULL").select("uid", "key", "n_lines")
    return all_rows.join(by_row, "uid", "left").select(F.col("key").alias(key), "n_lines", F.coalesce("n", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("removed", F.lit("")).alias("removed"))


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without the lines that go; the columns as they were."""
    uid = free_name(docs, "__uid")
    whole = cut(docs.withColumn(uid, F.monotonically_increasing_id()), "documents")
    read = cut(read_lines(whole.select(F.col(uid).alias("uid"), col(key).alias("key"), col(text).alias("text")), min_words), "lines")
    gone = dropped_lines(read, min_words, similarity)
    by_row = cut(gone.groupBy(F.col("uid").alias(uid)).agg(F.collect_list("line").alias("gone")), "gone")
    if by_row.agg(F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()[0] <= BROADCAST_ROWS * 10:
        by_row = F.broadcast(by_row)  # 8 bytes a line
    own = free_name(docs, "__gone")
    kept = F.filter(F.split(col(text), "\n", -1), lambda _, i: ~F.array_contains(own, i.cast("long")))
    out = F.when(F.col(own).isNull(), col(text)).otherwise(F.array_join(kept, "\n"))
    joined = whole.join(by_row.withColumnRenamed("gone", own), uid, "left")
    return joined.select(*(out.alias(c) if c == text else col(c) for c in docs.columns))
