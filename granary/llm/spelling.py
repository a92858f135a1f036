"""Spelling variants: words one edit apart, by k-d trees over letter counts.

Every word is a vector of how often it has each letter.  One replaced letter takes
one from a count and adds one to another, one inserted letter adds one: vectors of
near words differ by two at most in sum, and by one at most in any letter.  So for
each pair of lengths (l, l), (l, l + 1) and (l, l - 1) a range search in a k-d tree
of the other length's words visits only boxes that one count more and one count
less can reach, and the words it finds are held against each other letter by letter.

The top of each length's tree is planned on the driver from a bounded sample of the
words; its leaves are cells.  Spark deals every word to the cell it lies in and, as
a query, to the cells whose boxes it can reach; each task builds the rest of the
tree for the words of a cell.  A cell with far more words than planned (many words of
the same letters) is split, and so are the queries of a cell that has many of them,
so a task's group is bounded whatever the words are.

Words are maximal runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF), of which only
A-Z are lower-cased; a run whose crc32 with its document's id is divisible by 31
loses one letter.  Only words of ``LEAST_LETTERS`` and ``LEAST_COUNT`` count.

Defined cases: a null text has no words, a null id is an empty one; repeated rows
count as often as they occur; of near words with equal counts the smallest in
code-point order is the form; an empty table gives an empty result; a run of any
length is one word, worked on whole; further columns do not matter, whatever their
names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import textbatch as tb
from granary.llm.storage import col, cut

LEAST_LETTERS, LEAST_COUNT = 7, 2
#: A form is so many times as frequent as its variant at least.
TIMES = 10
#: One run in so many loses a letter.
ONE_IN = 31
#: Words that the top trees are planned from, about, and words of a cell.
SAMPLE_WORDS, CELL_WORDS = 200_000, 16_384
#: Words of a leaf of the trees in the tasks; cells of word pairs compared at a time.
LEAF_WORDS, PAIRS = 48, 1 << 20
SLICE_BYTES = 4 << 20
#: Longer runs than these bytes are hashed one by one.
LONG = 64

_LETTERS = np.zeros(256, bool)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = True
_OUT = np.array([True] + [False] * 255)
#: The place of each Latin-1 letter among the counts.
_PLACE = np.zeros(256, np.int64)
_PLACE[0x61:0x7B] = np.arange(26)
_PLACE[0xC0:0x100] = np.arange(26, 90)
DIMENSIONS = 90


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, np.uint32(0xEDB88320) ^ (value >> 1), value >> 1)
    return value


_CRC = _crc_table()


def crc_of(data: np.ndarray, start: np.ndarray, end: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """The crc32 of each stretch of bytes, carried on from the crc32 of what stands before it."""
    state = begun ^ np.uint32(0xFFFFFFFF)
    size = end - start
    order = np.argsort(-np.where(size > LONG, 0, size), kind="stable")
    sizes = np.where(size > LONG, 0, size)[order]
    for j in range(int(sizes[0]) if len(sizes) else 0):
        some = order[: np.searchsorted(-sizes, -j, side="left")]
        state[some] = _CRC[(state[some] ^ data[start[some] + j]) & 0xFF] ^ (state[some] >> np.uint32(8))
    out = state ^ np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(size > LONG).tolist():
        out[k] = zlib.crc32(data[start[k] : end[k]].tobytes(), int(begun[k]))
    return out


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    at = np.cumsum(size) - size
    return data[np.repeat(start - at, size) + np.arange(int(size.sum()))]


def utf8(latin: np.ndarray, size: np.ndarray) -> pa.Array:
    """Words in Latin-1, behind one another, as strings."""
    wide = latin >= 0x80
    at = np.arange(len(latin)) + np.cumsum(wide) - wide
    data = np.empty(len(latin) + int(wide.sum()), np.uint8)
    data[at] = np.where(wide, 0xC3, latin)
    data[at[wide] + 1] = latin[wide] - 0x40
    ends = np.concatenate([[0], np.cumsum(size)])
    place = np.concatenate([at, [len(data)]])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(place[ends]), pa.py_buffer(data))


def runs(column: pa.Array, ids: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All words of the texts as Latin-1 bytes behind one another, and their lengths."""
    found = tb.texts(column)
    after = np.concatenate([[False], found.data[:-1] == 0xC3]) if len(found.data) else np.zeros(0, bool)
    inside = _LETTERS[found.data] | (found.data == 0xC3) | after
    words = tb.spans(tb.Texts(inside.astype(np.uint8), found.offsets), _OUT)
    data = tb.LOWER[found.data]
    leads = np.concatenate([[0], np.cumsum(data == 0xC3)])
    letters = words.end - words.start - (leads[words.end] - leads[words.start])
    keep = letters >= LEAST_LETTERS
    start, end, owner, letters = words.start[keep], words.end[keep], words.owner[keep], letters[keep]
    begun = np.fromiter((zlib.crc32(f"{i}:".encode()) for i in ids), np.uint32, len(ids))
    crc = crc_of(data, start, end, begun[owner]).astype(np.int64)
    flat = _gather(data, start, end - start)
    flat = np.where(np.concatenate([[False], flat[:-1] == 0xC3]), flat + 0x40, flat).astype(np.uint8)[flat != 0xC3] if len(flat) else flat
    lost = crc % ONE_IN == 0
    first = np.cumsum(letters) - letters
    flat = np.delete(flat, (first + crc % np.maximum(letters, 1))[lost])
    letters = letters - lost
    short = letters < LEAST_LETTERS
    return (flat[np.repeat(~short, letters)], letters[~short]) if short.any() else (flat, letters)


def vocabulary(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``word`` and ``n`` of every word that occurs ``LEAST_COUNT`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tb.slices(batches, "__text", SLICE_BYTES):
            flat, size = runs(part.column("__text"), ["" if i is None else i for i in part.column("__key").to_pylist()])
            coded = utf8(flat, size).dictionary_encode()
            n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    counted = docs.select(col(key).cast("string").alias("__key"), col(text).alias("__text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def latin(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words as Latin-1 bytes behind one another, and their lengths."""
    found = tb.texts(column)
    lead = found.data == 0xC3
    after = np.concatenate([[False], lead[:-1]]) if len(lead) else lead
    return np.where(after, found.data + 0x40, found.data).astype(np.uint8)[~lead], np.diff(found.offsets) - found.total(lead)


def letter_counts(flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One row a word: how often it has each letter."""
    owner = np.repeat(np.arange(len(size)), size)
    return np.bincount(owner * DIMENSIONS + _PLACE[flat], minlength=len(size) * DIMENSIONS).reshape(-1, DIMENSIONS).astype(np.int32)


class Tree:
    """A k-d tree of count vectors: each node splits at a count of one letter, the one that is spread most."""

    def __init__(self, counts: np.ndarray, leaf_words: int) -> None:
        self.letter, self.most, self.below, self.above, self.leaves = [], [], [], [], []
        self.members: list[np.ndarray] = []
        todo = [(np.arange(len(counts)), -1, False)]
        while todo:
            own, parent, right = todo.pop()
            node = len(self.letter)
            if parent >= 0:
                (self.above if right else self.below)[parent] = node
            letter, most = self._split(counts, own) if len(own) > leaf_words else (-1, 0)
            self.letter.append(letter)
            self.most.append(most)
            self.below.append(-1)
            self.above.append(-1)
            if letter < 0:
                self.leaves.append(len(self.members))
                self.members.append(own)
                continue
            self.leaves.append(-1)
            low = counts[own, letter] <= most
            todo += [(own[low], node, False), (own[~low], node, True)]

    @staticmethod
    def _split(counts: np.ndarray, own: np.ndarray) -> tuple[int, int]:
        """The letter and the count up to which a word goes below: as near to halves as can be; no letter where all vectors are one."""
        part = counts[own]
        best, found = 0, (-1, 0)
        # a letter of great spread first, the best cut of the three of greatest spread
        for letter in np.argsort(-part.var(axis=0), kind="stable")[:3].tolist():
            tally = np.cumsum(np.bincount(part[:, letter]))
            most = int(np.argmin(np.abs(tally - len(own) / 2)))
            smaller = min(int(tally[most]), len(own) - int(tally[most]))
            if smaller > best:
                best, found = smaller, (letter, most)
        return found

    def visited(self, counts: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves and the rows of ``counts`` that reach their boxes with one more of ``up`` letters and one less of ``down`` letters."""
        n = len(counts)
        todo = [(0, np.arange(n), np.full(n, up, np.int8), np.full(n, down, np.int8))]
        while todo:
            node, own, plus, minus = todo.pop()
            if not len(own):
                continue
            letter = self.letter[node]
            if letter < 0:
                yield self.leaves[node], own
                continue
            over = counts[own, letter] - self.most[node]  # above zero: the word's own side is above
            down_one, up_one = over == 1, over == 0
            low = (over <= 0) | (down_one & (minus > 0))
            high = (over >= 1) | (up_one & (plus > 0))
            todo.append((self.below[node], own[low], plus[low], (minus - down_one)[low]))
            todo.append((self.above[node], own[high], (plus - up_one)[high], minus[high]))

    def leaf_of(self, counts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(counts), np.int64)
        for leaf, own in self.visited(counts, 0, 0):
            out[own] = leaf
        return out


def parities(counts: np.ndarray) -> np.ndarray:
    """64 bits: which letters occur an odd number of times, some accented ones together."""
    out = np.zeros(len(counts), np.uint64)
    for k in range(DIMENSIONS):
        out ^= (counts[:, k] & 1).astype(np.uint64) << np.uint64(k if k < 26 else 26 + (k - 26) % 38)
    return out


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of words (of one length each) are one replaced, inserted or deleted letter apart."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    short, long = (a, b) if a.shape[1] < b.shape[1] else (b, a)
    size = short.shape[1]
    from_left = np.cumprod(short == long[:, :size], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    from_right = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    return from_left + from_right >= size


def near_pairs(queries: np.ndarray, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of queries and words (one length each, Latin-1 rows) that are one edit apart, in batches; each pair once."""
    longer = words.shape[1] - queries.shape[1]
    sized = [np.full(len(x), x.shape[1]) for x in (queries, words)]
    of_queries, of_words = letter_counts(queries.ravel(), sized[0]), letter_counts(words.ravel(), sized[1])
    odd_queries, odd_words = parities(of_queries), parities(of_words)
    tree = Tree(of_words, LEAF_WORDS)
    width = max(queries.shape[1], words.shape[1])
    room = max(1, PAIRS * 16 // width)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def verified() -> tuple[np.ndarray, np.ndarray]:
        q, w = (np.concatenate([x[k] for x in held]) for k in (0, 1))
        good = [np.zeros(0, bool), *(one_edit(queries[q[i : i + room]], words[w[i : i + room]]) for i in range(0, len(q), room))]
        both = np.concatenate(good)
        return q[both], w[both]

    for leaf, own in tree.visited(of_queries, int(longer >= 0), int(longer <= 0)):
        members = tree.members[leaf]
        for m in range(0, len(members), PAIRS):
            some = members[m : m + PAIRS]
            step = max(1, PAIRS // len(some))
            for k in range(0, len(own), step):
                near = np.bitwise_count(odd_queries[own[k : k + step], None] ^ odd_words[some]) <= 2
                i, j = np.nonzero(near)
                held.append((own[k : k + step][i], some[j]))
                waiting += len(i)
                if waiting > room:
                    yield verified()
                    held, waiting = [], 0
    if held:
        yield verified()


class Plan:
    """Top trees of the lengths, and how many blocks each cell's words and queries are dealt to."""

    def __init__(self, sizes: dict[int, int], sample: list[str], cell_words: int) -> None:
        self.sizes, total = sizes, sum(sizes.values())
        rate = len(sample) / max(total, 1)
        self.trees: dict[int, Tree] = {}
        flat, size = latin(pa.array(sample, pa.string()))
        first = np.cumsum(size) - size
        for length in np.unique(size).tolist():
            own = np.flatnonzero(size == length)
            counts = letter_counts(_gather(flat, first[own], size[own]), size[own])
            tree = Tree(counts, max(1, int(cell_words * rate)))
            tree.members = [np.zeros(0, np.int64)] * len(tree.members)
            self.trees[length] = tree
        self.word_blocks: dict[tuple[int, int], int] = {}
        around = {n: sum(sizes.get(n + d, 0) for d in (-1, 0, 1)) for n in sizes}
        self.query_blocks = {n: -(-around[n] // (self.cells(n) * cell_words * 8)) for n in sizes}

    def cells(self, length: int) -> int:
        return len(self.trees[length].members) if length in self.trees else 1

    def home(self, counts: np.ndarray, length: int) -> np.ndarray:
        return self.trees[length].leaf_of(counts) if length in self.trees else np.zeros(len(counts), np.int64)

    def reached(self, counts: np.ndarray, length: int, other: int) -> Iterator[tuple[int, np.ndarray]]:
        """Cells of the words of length ``other`` and the rows that search them."""
        if other not in self.sizes:
            return
        if other not in self.trees:
            yield 0, np.arange(len(counts))
            return
        yield from self.trees[other].visited(counts, int(other >= length), int(other <= length))


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each length its words' numbers and count vectors."""
    flat, size = latin(column)
    first = np.cumsum(size) - size
    for length in np.unique(size).tolist():
        own = np.flatnonzero(size == length)
        step = max(1, (1 << 22) // length)
        for k in range(0, len(own), step):
            part = own[k : k + step]
            yield length, part, letter_counts(_gather(flat, first[part], size[part]), size[part])


def plan(words: DataFrame, sample_words: int = SAMPLE_WORDS, cell_words: int = CELL_WORDS) -> Plan:
    """Reads from the words: how many there are of each length, a bounded sample, and how many each planned cell holds."""
    sizes = {r[0]: r[1] for r in words.groupBy(F.length("word").alias("l")).count().collect()}  # one row a length
    bound = 1 << 24
    share = min(bound, -(-sample_words * bound // max(sum(sizes.values()), 1)))
    sample = sorted(words.filter(F.pmod(F.xxhash64("word"), F.lit(bound)) < share).select("word").toPandas()["word"])
    made = Plan(sizes, sample, cell_words)
    shared = words.sparkSession.sparkContext.broadcast(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, cell = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            for n, own, counts in _by_length(b.column("word")):
                length[own], cell[own] = n, shared.value.home(counts, n)
            yield pa.RecordBatch.from_arrays([pa.array(length), pa.array(cell)], ["length", "cell"])

    held = words.select("word").mapInArrow(run, "length long, cell long").groupBy("length", "cell").count().filter(F.col("count") > 4 * cell_words).collect()  # crowded cells only
    made.word_blocks = {(r[0], r[1]): -(-r[2] // (2 * cell_words)) for r in held}
    return made


def dealt(words: DataFrame, made: Plan) -> DataFrame:
    """Every word at its cell's blocks, to be found and to search, and as a query at the other cells it can reach.

    Columns: length, cell, word_block, query_block, found, searches, home, word, n.
    """
    shared = words.sparkSession.sparkContext.broadcast(made)
    names = ["length", "cell", "word_block", "query_block", "found", "searches", "home"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for b in batches:
            rows: list[list[np.ndarray]] = []

            def add(own: np.ndarray, rows: list = rows, **values: int | np.ndarray) -> None:
                rows.append([own, *(np.broadcast_to(values[c], len(own)) for c in names)])

            for length, own, counts in _by_length(b.column("word")):
                deal = tb.mix(own.astype(np.uint64))
                for other in (length - 1, length, length + 1):
                    blocks = p.query_blocks.get(other, 1)
                    for cell, some in p.reached(counts, length, other):
                        parts = p.word_blocks.get((other, cell), 1)
                        at_home = (p.home(counts[some], length) == cell) if other == length else np.zeros(len(some), bool)
                        if parts == 1 and blocks == 1:
                            add(own[some], length=other, cell=cell, word_block=0, query_block=0, found=at_home, searches=True, home=at_home)
                            continue
                        block = (deal[some] % np.uint64(blocks)).astype(np.int64)
                        for k in range(parts):
                            add(own[some], length=other, cell=cell, word_block=k, query_block=block, found=False, searches=True, home=at_home & (k == 0))
                        lies = some[at_home]
                        for k in range(blocks):
                            add(own[lies], length=other, cell=cell, word_block=(deal[lies] // np.uint64(blocks) % np.uint64(parts)).astype(np.int64), query_block=k, found=True, searches=False, home=False)
            own = np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, np.int64)
            columns = [np.concatenate([r[1 + k] for r in rows]) if rows else np.zeros(0, np.int64) for k in range(len(names))]
            arrays = [pa.array(c.astype(np.int64)) for c in columns[:4]] + [pa.array(c.astype(bool)) for c in columns[4:]]
            whole = pa.RecordBatch.from_arrays([*arrays, *b.select(["word", "n"]).take(pa.array(own)).columns], [*names, "word", "n"])
            for k in range(0, len(whole), 1 << 16):
                yield whole.slice(k, 1 << 16)

    return words.select("word", "n").mapInArrow(run, "length long, cell long, word_block long, query_block long, found boolean, searches boolean, home boolean, word string, n long")


def _searched(group: pa.Table) -> pa.Table:
    """Of each query of a group its number of near words and the best of them; of words at home always a row."""
    group = group.combine_chunks()
    column = group.column("word").combine_chunks() if group.num_rows else pa.array([], pa.string())
    flat, size = latin(column)
    first = np.cumsum(size) - size
    lies, searches = (group.column(c).to_numpy() for c in ("found", "searches"))
    n = group.column("n").to_numpy()
    words = np.flatnonzero(lies)
    near, best = np.zeros(len(size), np.int64), np.full(len(size), len(words), np.int64)
    if len(words):
        length = int(size[words[0]])
        rows = _gather(flat, first[words], size[words]).reshape(-1, length)
        order = np.argsort(rows.view(f"S{length}").ravel(), kind="stable")  # of Latin-1 bytes, so of code points
        order = order[np.argsort(-n[words][order], kind="stable")]
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        for other in (length - 1, length, length + 1):
            own = np.flatnonzero(searches & (size == other))
            if not len(own):
                continue
            for q, w in near_pairs(_gather(flat, first[own], size[own]).reshape(-1, other), rows):
                near += np.bincount(own[q], minlength=len(size))
                np.minimum.at(best, own[q], rank[w])
    keep = np.flatnonzero((near > 0) | group.column("home").to_numpy())
    has = near[keep] > 0
    top = words[order[best[keep][has]]] if has.any() else np.zeros(0, np.int64)
    taken = np.full(len(keep), -1, np.int64)
    taken[has] = top
    index = pa.array(taken, mask=~has)
    return pa.table({"word": column.take(pa.array(keep)), "n": pa.array(n[keep]), "n_near": pa.array(near[keep]), "best_n": pa.array(n).take(index), "best": column.take(index)})


def neighbours(words: DataFrame, sample_words: int = SAMPLE_WORDS, cell_words: int = CELL_WORDS) -> DataFrame:
    """``word``, ``n``, ``n_near`` and the most frequent near word, ``best``, with its ``best_n``, of every word."""
    rows = dealt(words, plan(words, sample_words, cell_words))
    found = rows.groupBy("length", "cell", "word_block", "query_block").applyInArrow(_searched, "word string, n long, n_near long, best_n long, best string")
    first = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))))
    return found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), first.alias("b")).select("word", "n", "n_near", (-F.col("b.less")).alias("best_n"), "b.best")


def rooted(found: DataFrame, most: int) -> DataFrame:
    """Adds ``root``: the last of the forms from each word on, by doubled steps; a form is ten times as frequent, so chains are short."""
    chained = found.filter("form is not null").select(F.col("word").alias("w"), F.col("form").alias("r"))
    depth, steps = 1, 0
    while TIMES**depth <= most:
        depth += 1
    while 1 << steps < depth:
        steps += 1
    for k in range(steps):
        after = chained.select(F.col("w").alias("r"), F.col("r").alias("further"))
        chained = cut(chained.join(after, "r", "left").select("w", F.coalesce("further", "r").alias("r")), f"roots{k}")
    return found.join(chained.withColumnRenamed("w", "word"), "word", "left").withColumn("root", F.coalesce("r", "word")).drop("r")


def grouped(docs: DataFrame, text: str = "text", key: str = "doc_id", sample_words: int = SAMPLE_WORDS, cell_words: int = CELL_WORDS) -> DataFrame:
    """One row a word: word, n, n_near, form, form_n, root."""
    words = cut(vocabulary(docs, text, key), "words")
    near = cut(neighbours(words, sample_words, cell_words), "near")
    most = near.agg(F.max("n")).first()[0] or 1
    is_form = F.col("best_n") >= TIMES * F.col("n")
    found = near.select("word", "n", "n_near", F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    return rooted(found, most).select("word", "form", "root", "n", "n_near", "form_n")


def sql(table: str) -> str:
    """The same rows by what two near words share: a word without one letter, at its place."""
    steps = "list_reduce(list_prepend(CAST(x AS UBIGINT), range(8)), lambda a, i: CASE WHEN a % 2 = 1 THEN xor(3988292384, a // 2) ELSE a // 2 END)"
    return f"""WITH RECURSIVE crc AS (SELECT list(v ORDER BY x) AS t FROM (SELECT x, {steps} AS v FROM (SELECT unnest(range(256)) AS x))),
runs AS (SELECT CAST(doc_id AS VARCHAR) AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM {table}),
counted AS (SELECT coalesce(id, '') || ':' || run AS said, run, count(*) AS n FROM runs WHERE length(run) >= {LEAST_LETTERS} GROUP BY ALL),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(range(1, strlen(said) + 1), lambda i: CAST(('0x' || substr(hex(encode(said)), CAST(2 * i - 1 AS BIGINT), 2)) AS UBIGINT))),
  lambda a, b: xor(t[CAST(xor(a % 256, b) AS BIGINT) + 1], a // 256))) AS h FROM counted, crc),
words AS (SELECT CASE WHEN h % {ONE_IN} = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= {LEAST_LETTERS} AND sum(n) >= {LEAST_COUNT}),
holes AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word UNION SELECT b.word, b.n, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM pairs GROUP BY word),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {TIMES} * n THEN other END AS form, CASE WHEN other_n >= {TIMES} * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS at, form AS further FROM forms UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.further = f.word)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.further IS NULL"""
