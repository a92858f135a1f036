"""Toxic passages: maximum-scoring segments of token log-odds, calibrated as extreme values.

A token's log-odds say how much likelier a toxic document is to hold it than a clean
one.  They come from counts of documents under Dirichlet priors, one inside the other:
a word's class shares have those of its prefix of eight letters as their prior, these
those of seven letters, and so on down to the classes' shares; what is counted at a
deeper step is not counted again at a shallower one.  So a form never seen takes the
odds of its stem, and a rare word stays near zero.

With a drift taken off each token, a linear-time scan finds all segments of a text
whose score can't be raised by making them longer or shorter.  The scores of clean
text's segments have an extreme-value tail; its rate solves the equation of the
tokens' scores, its height is counted in clean documents, each scored without its own
counts.  A document's evidence is the least chance of its best segment, or of its best
r together, in clean text of its length; a logistic fit on the labelled documents
turns that into a score.

Learns from about ``TRAIN_ROWS`` labelled documents of each class, chosen by a hash of
the key, texts that occur again left out; scores every whole text.

Defined cases: null and empty texts have no tokens, no passage, and the score of
texts without evidence; a document labelled more than once counts once, with its
least label; if a class has no rows, every score is the other class's share (0.5 if
there are none); repeated documents are scored each; an empty table gives an empty
result; a very long text is a row held whole by one task, worked on in time that
grows with its length; further columns do not matter, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm import textbatch as tb
from granary.llm.storage import col, cut

TRAIN_ROWS = 20_000
#: Letters of the prefixes that are counted besides whole words.
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Documents that a prior weighs as much as, and what is taken off each token's log-odds.
PRIOR, DRIFT = 4.0, 1.0
#: Tokens and prefixes in fewer training documents are as if never seen.
LEAST_DOCS = 2
#: A passage is significant if clean text of the document's length has as many as this on average.
EXPECTED = 0.01
SLICE_BYTES = 2 << 20
#: The rate of the tail at most, for models whose clean tokens hardly ever score.
STEEPEST = 8.0
#: Widths of the bins in which scores and evidence come to the driver.
SCORE_BIN, EVIDENCE_BIN = 0.02, 0.02
_ODD = np.uint64(0x9E3779B97F4A7C15)


def held_out(key: Column, parts: int = 5, left: int = 0) -> Column:
    return F.crc32(key.cast("string")) % parts == left


@dataclass
class Words:
    """Tokens of a slice: the distinct ones' hashes by step (prefixes, then whole), which steps they have, and all in order."""

    keys: np.ndarray
    has: np.ndarray
    which: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    end: np.ndarray
    n: int


def words(column: pa.Array) -> Words:
    """Runs of letters and digits of the lower-cased texts; ``start`` and ``end`` are bytes of all texts in a row."""
    found = tb.texts(pc.utf8_lower(pc.fill_null(column, "")))
    data = found.data
    spans = tb.spans(found, tb.NOT_WORD)
    size = spans.end - spans.start
    at = np.cumsum(size) - size
    flat = data[np.repeat(spans.start - at, size) + np.arange(int(size.sum()))]
    coded = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(np.concatenate([at, [len(flat)]]).astype(np.int64)), pa.py_buffer(flat)).dictionary_encode()
    distinct = tb.texts(coded.dictionary)
    own, begin, end = distinct.data, distinct.offsets[:-1], distinct.offsets[1:]
    firsts = np.flatnonzero(tb.FIRST[own])
    character = np.searchsorted(firsts, distinct.offsets)
    letters = np.diff(character)
    keys = np.zeros((len(letters), len(PREFIXES) + 1), np.uint64)
    has = np.ones(keys.shape, bool)
    for k, n in enumerate(PREFIXES):
        some = np.flatnonzero(letters > n)
        has[:, k] = letters > n
        keys[some, k] = tb.hashes(own, begin[some], firsts[character[:-1][some] + n], seed=n)
    keys[:, -1] = tb.hashes(own, begin, end)
    return Words(keys, has, coded.indices.to_numpy(), spans.owner, spans.start, spans.end, len(column))


def segments(scores: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last token and score of all maximal-scoring segments, in order; no segment spans two owners.

    A stretch of positive scores enters as one; a stack of segments is scanned by links to the
    next one with less before it, so each is passed over once.
    """
    n = len(scores)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    good = scores > 0
    edge = np.concatenate([[True], owner[1:] != owner[:-1]])
    begins = np.flatnonzero(good & (edge | np.concatenate([[True], ~good[:-1]])))
    ends = np.flatnonzero(good & np.concatenate([edge[1:] | ~good[1:], [True]]))
    total = np.concatenate([[0.0], np.cumsum(scores)])
    rows = zip(begins.tolist(), ends.tolist(), total[begins].tolist(), total[ends + 1].tolist(), owner[begins].tolist(), strict=True)
    out: list[tuple[int, int, float]] = []
    stack: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, the next below with less before
    doc = -1
    for first, last, before, after, of in rows:
        if of != doc:
            out += [(s[0], s[1], s[3] - s[2]) for s in stack]
            stack, doc = [], of
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= after:
                stack.append((first, last, before, after, j))
                break
            first, before = stack[j][0], stack[j][2]
            del stack[j:]
    out += [(s[0], s[1], s[3] - s[2]) for s in stack]
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    a, b, s = zip(*out, strict=True)
    return np.array(a, np.int64), np.array(b, np.int64), np.array(s)


@dataclass
class Model:
    """Counts of documents by token, the tail of clean text, and the logistic fit."""

    n: np.ndarray
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    clean: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rate: float = 1.0
    height: float = 1.0
    fit: tuple[float, float] = (0.0, 0.0)

    def counts(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """Clean and toxic documents of each distinct token by step."""
        out = np.zeros((2, *found.keys.shape), np.float64)
        if len(self.keys):
            flat = found.keys[found.has]
            at = np.minimum(np.searchsorted(self.keys, flat), len(self.keys) - 1)
            hit = self.keys[at] == flat
            for side, known in zip(out, (self.clean, self.toxic), strict=True):
                side[found.has] = np.where(hit, known[at], 0)
        return out[0], out[1]

    def log_odds(self, clean: np.ndarray, toxic: np.ndarray, has: np.ndarray) -> np.ndarray:
        """From counts by step: each step's own documents (those of no deeper one) on a prior with the shares of the step before."""
        base = self.n[1] / self.n.sum()
        clean, toxic = clean.copy(), toxic.copy()
        for k in range(has.shape[1] - 2, -1, -1):  # a step that a word doesn't have holds what the next one has
            for x in (clean, toxic):
                x[:, k] = np.where(has[:, k], np.maximum(x[:, k], x[:, k + 1]), x[:, k + 1])
        share = np.full(len(has), base)
        for k in range(has.shape[1]):
            deeper = k + 1 < has.shape[1]
            own_toxic = toxic[:, k] - (toxic[:, k + 1] if deeper else 0)
            own_clean = clean[:, k] - (clean[:, k + 1] if deeper else 0)
            share = (own_toxic + PRIOR * share) / (own_toxic + own_clean + PRIOR)
        share = np.clip(share, 1e-9, 1 - 1e-9)
        return np.log(share / (1 - share)) - math.log(base / (1 - base)) - DRIFT

    def token_scores(self, found: Words, label: np.ndarray | None = None) -> np.ndarray:
        """Scores of all tokens in order; with the documents' labels, each document's without its own counts."""
        clean, toxic = self.counts(found)
        if label is None:
            return self.log_odds(clean, toxic, found.has)[found.which]
        pairs, back = np.unique(found.which.astype(np.int64) * found.n + found.owner, return_inverse=True)
        which, own = pairs // max(found.n, 1), label[pairs % max(found.n, 1)][:, None]
        return self.log_odds(np.maximum(clean[which] - (own == 0), 0), np.maximum(toxic[which] - (own == 1), 0), found.has[which])[back]

    def evidence(self, n: int, owner: np.ndarray, tokens: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Minus the logarithm of the least chance of a document's best r segments, r from 1 on, each r at twice the price of the one before."""
        out = np.zeros(n)
        if not len(owner):
            return out
        order = np.lexsort((-scores, owner))
        owner, scaled = owner[order], self.rate * scores[order] - np.log(self.height * tokens[owner[order]])
        first = np.searchsorted(owner, owner)
        r = np.arange(len(owner)) - first + 1
        best = np.where(r == 1, -np.log(np.maximum(-np.expm1(-np.exp(-np.maximum(scaled, -30))), 1e-300)), 0)
        best = np.where((r == 1) & (scaled > 600), scaled, best)
        total = np.concatenate([[0.0], np.cumsum(np.maximum(scaled, 0))])
        together = total[1:] - total[first]
        with np.errstate(divide="ignore", invalid="ignore"):
            some = together - (r - 1) * np.log(together) + _log_factorial(r) + _log_factorial(r - 1) - r * math.log(2)
        best = np.maximum(best, np.where((r > 1) & (scaled > 0) & (together > r), some, 0))
        np.maximum.at(out, owner, best)
        return out

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if self.n.min() <= 0:
            return np.full(len(evidence), 0.5 if self.n.sum() == 0 else float(self.n[1] > 0))
        a, b = self.fit
        return 1 / (1 + np.exp(-np.clip(a + b * np.log1p(evidence), -700, 700)))


def _log_factorial(n: np.ndarray) -> np.ndarray:
    table = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, max(int(n.max()), 1) + 1)))])
    return table[n]


def tail_rate(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive number at which the mean of exp(rate * score) is one."""
    if not len(scores) or scores.max() <= 0:
        return STEEPEST
    low, high = 1e-3, STEEPEST
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (share * np.exp(middle * scores)).sum() < 1 else (low, middle)
    return (low + high) / 2


def logistic(x: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Intercept and slope for x by weights of the two classes, with targets a little inside 0 and 1."""
    n = weight.sum(axis=1)
    target = np.array([1 / (n[0] + 2), (n[1] + 1) / (n[1] + 2)])
    a, b = math.log((n[1] + 1) / (n[0] + 1)), 0.0
    both = np.concatenate([x, x])
    w = np.concatenate([weight[0], weight[1]])
    y = np.repeat(target, len(x))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * both, -60, 60)))
        g = w * (y - p)
        h = w * p * (1 - p) + 1e-12
        grad = np.array([g.sum(), (g * both).sum() - 1e-3 * b])
        hess = np.array([[h.sum(), (h * both).sum()], [(h * both).sum(), (h * both * both).sum() + 1e-3]]) + 1e-9 * np.eye(2)
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def training(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, per_class: int) -> DataFrame:
    """``label`` and ``text`` of the documents learned from, each text of a class once."""
    known = labels.filter(col(label).isin(0, 1) & col(key).isNotNull() & ~held_out(col(key))).groupBy(col(key).alias("__key")).agg(F.min(col(label)).cast("long").alias("label"))
    sizes = {r[0]: r[1] for r in known.groupBy("label").count().collect()}  # two rows
    bound = 1 << 20
    cuts = F.create_map(*(F.lit(x) for k in (0, 1) for x in (k, min(bound, -(-per_class * bound // max(sizes.get(k, 1), 1))))))
    chosen = known.filter(F.pmod(F.xxhash64("__key"), F.lit(bound)) < cuts[F.col("label").cast("int")])
    # about per_class keys of each class
    rows = docs.select(col(key).alias("__key"), col(text).alias("text")).filter("text is not null").join(F.broadcast(chosen), "__key").select("label", "text")
    return rows.withColumn("same", F.xxhash64("text")).dropDuplicates(["label", "same"]).drop("same")


def fit(rows: DataFrame) -> Model:
    """From ``label`` and ``text`` (a written table): counts, the tail of clean text, and the logistic fit."""
    sizes = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    model = Model(np.array([sizes.get(k, 0) for k in (0, 1)], np.float64))
    if model.n.min() <= 0:
        return model

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tb.slices(batches, "text", SLICE_BYTES):
            found, label = words(part.column("text")), part.column("label").to_numpy()
            pairs = np.unique(found.which.astype(np.int64) * found.n + found.owner)
            which, own = pairs // max(found.n, 1), pairs % max(found.n, 1)
            has = found.has[which]
            keys, doc = found.keys[which][has], np.repeat(own, has.sum(axis=1))
            _, once = np.unique(tb.mix(keys ^ tb.mix(doc.astype(np.uint64) + _ODD)), return_index=True)
            keys, at = np.unique(keys[once], return_inverse=True)
            toxic = np.bincount(at, label[doc[once]], len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.bincount(at, minlength=len(keys)) - toxic), pa.array(toxic)], ["key", "clean", "toxic"])

    counted = rows.mapInArrow(count, "key long, clean long, toxic long").groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    table = counted.filter(F.col("clean") + F.col("toxic") >= LEAST_DOCS).toPandas()  # tokens of the bounded sample
    order = np.argsort(table["key"].to_numpy().view(np.uint64))
    model.keys = table["key"].to_numpy().view(np.uint64)[order]
    model.clean, model.toxic = (table[c].to_numpy()[order].astype(np.int32) for c in ("clean", "toxic"))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def clean_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bins of the scores of clean documents' tokens and of their segments."""
        sums: dict[tuple[str, int], int] = {}
        tokens = 0
        for part in tb.slices(batches, "text", SLICE_BYTES):
            part = part.filter(pc.equal(part.column("label"), 0))
            found = words(part.column("text"))
            scores = shared.value.token_scores(found, np.zeros(len(part), np.int64))
            tokens += len(scores)
            for name, x in (("token", scores), ("segment", segments(scores, found.owner)[2])):
                bins, n = np.unique(np.round(x / SCORE_BIN).astype(np.int64), return_counts=True)
                for b, k in zip(bins.tolist(), n.tolist(), strict=True):
                    sums[name, b] = sums.get((name, b), 0) + k
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.int64()), pa.array(list(sums.values()), pa.int64())], ["kind", "bin", "n"])

    bins = rows.mapInArrow(clean_scores, "kind string, bin long, n long").groupBy("kind", "bin").agg(F.sum("n").alias("n")).toPandas()  # bins of scores
    token, segment = (bins[bins["kind"] == k] for k in ("token", "segment"))
    tokens = int(token["n"].sum())
    model.rate = tail_rate(token["bin"].to_numpy() * SCORE_BIN, token["n"].to_numpy() / max(tokens, 1))
    score, n = segment["bin"].to_numpy()[np.argsort(-segment["bin"].to_numpy())] * SCORE_BIN, segment["n"].to_numpy()[np.argsort(-segment["bin"].to_numpy())]
    # the tail's height where one clean document in twenty has a segment, or where all have that there are
    at = int(np.searchsorted(np.cumsum(n), model.n[0] / 20))
    least = score[at] if at < len(n) else 0.0
    model.height = float(max(n[: at + 1].sum(), 1) * math.exp(min(model.rate * least, 500)) / max(tokens, 1))
    tailed = rows.sparkSession.sparkContext.broadcast(model)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tb.slices(batches, "text", SLICE_BYTES):
            label = part.column("label").to_numpy()
            found = words(part.column("text"))
            own = tailed.value
            first, _, score = segments(own.token_scores(found, label), found.owner)
            x = own.evidence(len(part), found.owner[first], np.bincount(found.owner, minlength=len(part)), score)
            yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(np.round(np.log1p(x) / EVIDENCE_BIN).astype(np.int64))], ["label", "bin"])

    at = rows.mapInArrow(spread, "label long, bin long").groupBy("label", "bin").count().toPandas()  # bins of evidence
    x = np.sort(at["bin"].unique())
    weight = np.zeros((2, len(x)))
    np.add.at(weight, (at["label"].to_numpy(), np.searchsorted(x, at["bin"].to_numpy())), at["count"].to_numpy())
    model.fit = logistic(x * EVIDENCE_BIN, weight)
    return model


def passages(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row a document: key, ``score`` and ``passages``, the significant ones: start and end (code points), tokens, score, expected."""
    inner = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("tokens", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType())])
    schema = T.StructType([T.StructField("__key", docs.schema[key].dataType), T.StructField("score", T.DoubleType()), T.StructField("passages", T.ArrayType(inner))])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in tb.slices(batches, "__text", SLICE_BYTES):
            n = len(part)
            if own.n.min() <= 0:
                found_in, values = np.zeros(n, np.int64), [np.zeros(0, np.int64)] * 3 + [np.zeros(0)] * 2
                evidence = np.zeros(n)
            else:
                found = words(part.column("__text"))
                tokens = np.bincount(found.owner, minlength=n)
                first, last, score = segments(own.token_scores(found), found.owner)
                owner = found.owner[first]
                evidence = own.evidence(n, owner, tokens, score)
                expected = own.height * tokens[owner] * np.exp(-own.rate * score)
                good = expected <= EXPECTED
                first, last, owner, score, expected = first[good], last[good], owner[good], score[good], expected[good]
                whole = tb.texts(pc.utf8_lower(pc.fill_null(part.column("__text"), "")))
                character = np.concatenate([[0], np.cumsum(tb.FIRST[whole.data])])
                begin = character[whole.offsets[:-1]][owner]
                found_in = np.bincount(owner, minlength=n)
                values = [character[found.start[first]] - begin, character[found.end[last]] - begin, last - first + 1, np.round(score, 6), np.round(expected, 9)]
            offsets = pa.array(np.concatenate([[0], np.cumsum(found_in)]).astype(np.int32))
            spans = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(v) for v in values], names=inner.names))
            yield pa.RecordBatch.from_arrays([part.column("__key"), pa.array(own.score(evidence)), spans], ["__key", "score", "passages"])

    return docs.select(col(key).alias("__key"), col(text).alias("__text")).mapInArrow(run, schema)


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", per_class: int = TRAIN_ROWS) -> DataFrame:
    """One row a document: key, held_out, score, predicted, n_passages, and the passages' places as ``spans``."""
    model = fit(cut(training(docs, labels, text, key, label, per_class), "toxic"))
    spans = F.array_join(F.transform("passages", lambda p: F.concat_ws(":", p["start"].cast("string"), p["end"].cast("string"))), ",")
    found = passages(docs, model, text, key).withColumn("score", F.round("score", 9))
    held = F.coalesce(held_out(F.col("__key")), F.lit(False))
    return found.select(F.col("__key").alias(key), held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").cast("long").alias("n_passages"), spans.alias("spans"))
