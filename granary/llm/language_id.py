"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, all but letters becomes one blank, and every n-gram of
one to three characters is hashed to a bucket.  Training sums the counts of
each language and bucket in the tasks and then in Spark; what comes back is
languages times buckets numbers at most.  Scoring broadcasts the matrix of log
probabilities and adds up its rows for each text with numpy.

Defined cases: a null text and one without a letter are ``und`` with score 0;
rows without text or language are not learned from; repeated rows count as
often as they occur; a text of any length is held whole by one task; ties go to the language first in the alphabet; with
nothing to learn from every text is ``und``; further columns do not matter.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import textbatch as tb

BITS = 15
GRAMS = (1, 2, 3)
SMOOTHING = 0.5
UNKNOWN = "und"
#: Labelled rows of one language that are learned from, about; the rest of a larger language is left out by a hash of its key.
TRAIN_ROWS = 20_000
_MULTIPLY = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the text each is of, and how many letters each text has."""
    lowered = pc.utf8_lower(pc.fill_null(column, "")).to_pylist()
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    code = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(lowered)), sizes)
    letter = _is_letter()[code]
    count = np.bincount(owner[letter], minlength=len(lowered))
    code = np.where(letter, code, np.uint32(0x20))
    keep = letter | np.concatenate([[False], letter[:-1]])  # one blank after a word
    code, owner, letter = code[keep], owner[keep], letter[keep]
    buckets, owners = [], []
    for n in GRAMS:
        size = len(code) - n + 1
        if size <= 0:
            continue
        h = np.full(size, n * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            h = (h ^ code[k : k + size]) * _MULTIPLY[k]
            h ^= h >> np.uint32(15)
        whole = owner[:size] == owner[n - 1 :]
        if n == 1:
            whole &= letter
        buckets.append((h & np.uint32((1 << BITS) - 1))[whole])
        owners.append(owner[:size][whole])
    if not buckets:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), count
    return np.concatenate(buckets), np.concatenate(owners), count


def held_out(key: str, parts: int = 4, left: int = 2) -> Column:
    return F.crc32(F.col(key).cast("string")) % parts == left


class Model:
    """Languages in order and their log probabilities, buckets times languages."""

    def __init__(self, languages: list[str], logs: np.ndarray, prior: np.ndarray) -> None:
        self.languages, self.logs, self.prior = languages, logs, prior

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        n = len(column)
        buckets, owner, letters = grams(column)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        score = np.stack([np.bincount(owner, self.logs[buckets, k], minlength=n) for k in range(len(self.languages))], axis=1) + self.prior
        best = score.argmax(axis=1)
        share = 1 / np.exp(np.minimum(score - score.max(axis=1, keepdims=True), 0)).sum(axis=1)
        known = letters > 0
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)], np.where(known, share, 0.0)


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = TRAIN_ROWS) -> Model:
    """Learns from rows with text and language, about ``per_language`` of each language."""
    rows = rows.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).alias("key"))
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # one row a language
    if not sizes:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0))
    cuts = F.create_map(*(F.lit(x) for name, n in sizes.items() for x in (name, min(1 << 20, -(-(per_language << 20) // n)))))
    chosen = rows.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < cuts[F.col("lang")]).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for part in tb.slices(batches, "text"):
            buckets, owner, _ = grams(part.column("text"))
            names, which = np.unique(np.array(part.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            for k, name in enumerate(names.tolist()):
                own = np.bincount(buckets[which[owner] == k], minlength=1 << BITS)
                seen[name] = own if name not in seen else seen[name] + own
        for name, own in seen.items():
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array(some), pa.array(own[some])], ["lang", "bucket", "n"])

    counts = chosen.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x buckets at most
    languages = sorted(sizes)
    table = np.full((1 << BITS, len(languages)), SMOOTHING)
    for k, name in enumerate(languages):
        own = counts[counts["lang"] == name]
        table[own["bucket"].to_numpy(), k] += own["n"].to_numpy()
    total = sum(sizes.values())
    return Model(languages, np.log(table / table.sum(axis=0)), np.log([sizes[name] / total for name in languages]))


def predicted(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, ``lang_pred`` and ``score``, of whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tb.slices(batches, text):
            names, score = shared.value.predict(part.column(text))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(names), pa.array(score)], [*keep, "lang_pred", "score"])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def identified(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """Learns from all but the held-out rows and predicts every row."""
    model = fit(docs.filter(~held_out(key)), text, lang, key)
    return predicted(docs, model, text, (key,)).select(key, F.coalesce(held_out(key), F.lit(False)).alias("held_out"), "lang_pred", F.round("score", 9).alias("score"))
