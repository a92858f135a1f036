"""Quality scores by a regularised quadratic discriminant over document statistics.

Every text becomes a short vector of transformed statistics.  For each class
the mean and covariance come from sums over all labelled rows, added up in
Spark; the covariance is shrunk towards the pooled one and towards a multiple
of the identity.  A text's score is the posterior from the difference of the
classes' Mahalanobis log densities, with Cholesky factors computed once.

Defined cases: null and empty texts have the statistics of an empty text and
get a score; rows without a label are not learned from; a document labelled
more than once counts once, with its least label; if a class has no rows, every
score is the other class's share (0.5 if there are none); repeated documents
are scored each; a text of any length is held whole by one task; an empty table gives an
empty result; further columns do not
matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import textbatch as tb
from granary.llm.storage import cut

UID = "__uid"
TOWARDS_POOLED = 0.2
TOWARDS_IDENTITY = 0.02
WINDOW = 8

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = True
_LETTER[0xC3:0xF5] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>@^~{}[]\\_=+")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:")] = True
_BREAK = np.zeros(256, bool)
_BREAK[0x0A] = True
STATISTICS = ("words", "word_length", "upper", "digits", "symbols", "marks", "stops", "breaks", "distinct", "repeated", "duplicate_lines", "longest")


def statistics(found: tb.Texts) -> np.ndarray:
    """One row a text: logarithms and square roots of counts and shares."""
    n = len(found)
    words = tb.spans(found, tb.WHITE)
    by = words.first_of(n)
    count = np.diff(by)
    code = tb.hashes(found.data, words.start, words.end)
    own = tb.mix(code ^ (words.owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    order = np.sort(own)
    dup_keys = np.unique(order[1:][order[1:] == order[:-1]]) if len(order) else order
    _, firsts = np.unique(own[hit := np.flatnonzero(tb.among(own, dup_keys))], return_index=True)
    later = np.bincount(words.owner[hit], minlength=n) - np.bincount(words.owner[hit[firsts]], minlength=n)
    window = tb.window_hashes(code, WINDOW)
    at = np.flatnonzero(words.owner[: len(window)] == words.owner[WINDOW - 1 :][: len(window)])
    twice = at[tb.repeated(tb.mix(window[at] ^ (words.owner[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)))]
    rows = tb.lines(found)
    full = rows.end > rows.start
    line = tb.mix(tb.hashes(found.data, rows.start[full], rows.end[full], seed=1) ^ (rows.owner[full].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(line, return_index=True)
    lines = np.bincount(rows.owner[full], minlength=n)
    dup = lines - np.bincount(rows.owner[full][first], minlength=n)
    chars = found.count(tb.FIRST)
    letters = found.count(_LETTER)
    longest = np.zeros(n)
    np.maximum.at(longest, words.owner, words.end - words.start)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.sqrt(part / np.maximum(whole, 1))

    return np.stack(
        [
            np.log1p(count),
            np.log1p(found.total(tb.FIRST[found.data] & ~tb.WHITE[found.data]) / np.maximum(count, 1)),
            share(found.count(_UPPER), letters),
            share(found.count(_DIGIT), chars),
            share(found.count(_SYMBOL), count),
            share(found.count(_MARK), count),
            share(found.count(_STOP), count),
            share(found.count(_BREAK), count),
            share(count - later, count),
            share(np.bincount(words.owner[twice], minlength=n), count),
            share(dup, lines),
            np.log1p(longest),
        ],
        axis=1,
    )


def held_out(key: str, parts: int = 3, left: int = 1) -> Column:
    return F.crc32(F.col(key).cast("string")) % parts == left


def described(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key and ``x``, the statistics of each whole text."""
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, x array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tb.slices(batches, text):
            x = statistics(tb.texts(part.column(text)))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(key), flat], [key, "x"])

    return docs.select(*dict.fromkeys([key, text])).mapInArrow(run, schema)


class Model:
    """Means, Cholesky factors and log determinants of two classes, and their log shares."""

    def __init__(self, n: np.ndarray, total: np.ndarray, square: np.ndarray) -> None:
        self.n = n
        if n.min() <= 0:
            return
        d = total.shape[1]
        self.mean = total / n[:, None]
        scatter = square - np.einsum("k,ki,kj->kij", n, self.mean, self.mean)
        pooled = scatter.sum(axis=0) / n.sum()
        self.factor, self.logdet = [], []
        for k in (0, 1):
            c = (1 - TOWARDS_POOLED) * scatter[k] / n[k] + TOWARDS_POOLED * pooled
            c = (1 - TOWARDS_IDENTITY) * c + TOWARDS_IDENTITY * (np.trace(c) / d + 1e-9) * np.eye(d)
            low = np.linalg.cholesky(c)
            self.factor.append(np.linalg.inv(low))
            self.logdet.append(2 * np.log(np.diag(low)).sum())
        self.prior = np.log(n / n.sum())

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.n.min() <= 0:
            return np.full(len(x), 0.5 if self.n.sum() == 0 else float(self.n[1] > 0))
        logs = [self.prior[k] - 0.5 * (self.logdet[k] + (((x - self.mean[k]) @ self.factor[k].T) ** 2).sum(axis=1)) for k in (0, 1)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(rows: DataFrame) -> Model:
    """From rows of ``x`` and ``label`` (0 or 1): counts, sums and sums of products over all of them."""
    d = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + d + d * d))
        for b in batches:
            x = b.column("x").flatten().to_numpy().reshape(-1, d)
            label = b.column("label").to_numpy()
            for k in (0, 1):
                own = x[label == k]
                sums[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        cells = sums.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], cells)), pa.array(np.tile(np.arange(cells), 2)), pa.array(sums.ravel())], ["label", "cell", "v"])

    added = rows.select("x", F.col("label").cast("long").alias("label")).mapInArrow(run, "label long, cell long, v double").groupBy("label", "cell").agg(F.sum("v").alias("v")).collect()  # two classes x cells
    sums = np.zeros((2, 1 + d + d * d))
    for label, cell, v in added:
        sums[label, cell] = v
    return Model(sums[:, 0], sums[:, 1 : 1 + d], sums[:, 1 + d :].reshape(2, d, d))


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality") -> DataFrame:
    """One row a document: key, held_out, score, predicted."""
    found = cut(described(docs, text, key), "statistics")
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("__key")).agg(F.min(label).alias("label"))
    model = fit(found.filter(~held_out(key)).join(known, F.col(key) == F.col("__key")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(shared.value.score(x))], [key, "score"])

    out = found.mapInArrow(run, schema).withColumn("score", F.round("score", 9))
    return out.select(key, F.coalesce(held_out(key), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
