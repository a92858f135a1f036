"""Quality rules as weak supervision: votes, accuracies by EM, a posterior.

Each rule votes 1 (good), -1 (bad) or 0 (abstains) on a whole text.  How often
each rule votes so on good and on bad texts is estimated by expectation-
maximisation over the counts of all vote patterns in the corpus: the patterns
are bounded by 3 to the power of the number of rules, whatever the corpus, and
their counts are sufficient for the model, so nothing else leaves the cluster.
A text is kept when its posterior probability of being good reaches the
threshold and the base rules do not fail it.

Defined cases: a null text has no words, lines or symbols and fails the base
rules; repeated rows and ties are scored row by row, with equal results; an
empty table gives an empty result with the prior as the model; a text of any length
is a row held whole by one task, in memory of some dozens of bytes for each byte
of it; further columns
pass through and may have any name (the operator's own columns replace columns
of the same name in ``scored``, and are dropped again in ``kept_documents``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm import textbatch as tb
from granary.llm.storage import by_number, cut

WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = True
_LETTER[0xC3:0xF5] = True  # the first byte of letters beyond ASCII, near enough for a share
_MARK = np.zeros(256, bool)
_MARK[list(b"!?")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:")] = True


@dataclass(frozen=True)
class Rule:
    """A rule and what it is taken for before any text is seen.

    on_good and on_bad: the chances of the votes (-1, 0, 1) on a good and on a bad text.
    """

    name: str
    on_good: tuple[float, float, float]
    on_bad: tuple[float, float, float]


RULES = (
    Rule("length", (0.02, 0.98, 0.0), (0.25, 0.75, 0.0)),
    Rule("symbols", (0.002, 0.998, 0.0), (0.45, 0.55, 0.0)),
    Rule("repetition", (0.002, 0.998, 0.0), (0.40, 0.60, 0.0)),
    Rule("lines", (0.005, 0.995, 0.0), (0.20, 0.80, 0.0)),
    Rule("word_length", (0.005, 0.995, 0.0), (0.10, 0.90, 0.0)),
    Rule("capitals", (0.002, 0.998, 0.0), (0.25, 0.75, 0.0)),
    Rule("punctuation", (0.01, 0.99, 0.0), (0.25, 0.75, 0.0)),
    Rule("prose", (0.0, 0.08, 0.92), (0.0, 0.98, 0.02)),
)
#: The prior counts as this share of the corpus, so that the model behaves alike at every size.
PRIOR_WEIGHT = 0.20
PRIOR_GOOD = 0.85


def counts(found: tb.Texts) -> dict[str, np.ndarray]:
    """What the rules look at, for each text."""
    n = len(found)
    words = tb.spans(found, tb.WHITE)
    by = words.first_of(n)
    code = tb.hashes(found.data, words.start, words.end)
    window = tb.window_hashes(code, WINDOW)
    inside = words.owner[: len(window)] == words.owner[WINDOW - 1 :][: len(window)]
    at = np.flatnonzero(inside)
    twice = at[tb.repeated(tb.mix(window[at] ^ (words.owner[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)))]
    cover = np.zeros(len(code) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])

    rows = tb.lines(found)
    white = np.concatenate([[0], np.cumsum(tb.WHITE[found.data])])
    full = (white[rows.end] - white[rows.start]) < rows.end - rows.start
    owner, line = rows.owner[full], tb.hashes(found.data, rows.start[full], rows.end[full], seed=1)
    key = tb.mix(line ^ (owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    _, firsts = np.unique(key, return_index=True)
    later = np.ones(len(key), bool)
    later[firsts] = False
    return {
        "n_words": np.diff(by),
        "word_chars": found.total(tb.FIRST[found.data] & ~tb.WHITE[found.data]),
        "n_symbols": found.count(_SYMBOL),
        "n_dup_lines": np.bincount(owner[later], minlength=n),
        "n_repeat_words": covered[by[1:]] - covered[by[:-1]],
        "n_lines": np.bincount(owner, minlength=n),
        "n_upper": found.count(_UPPER),
        "n_letters": found.count(_LETTER),
        "n_marks": found.count(_MARK),
        "n_stops": found.count(_STOP),
    }


def votes(c: dict[str, np.ndarray]) -> np.ndarray:
    """One row a text, one column a rule: -1, 0 or 1."""
    words = c["n_words"]

    def vote(bad: np.ndarray, good: np.ndarray | bool) -> np.ndarray:
        return np.where(bad, -1, np.where(good, 1, 0))

    bad = [
        words < 20,
        c["n_symbols"] * 100 > words * 10,
        c["n_repeat_words"] * 100 > words * 30,
        c["n_dup_lines"] * 100 > c["n_lines"] * 50,
        (c["word_chars"] < 2.5 * words) | (c["word_chars"] > 15 * words),
        c["n_upper"] * 100 > c["n_letters"] * 40,
        (c["n_marks"] * 100 > words * 10) | (c["n_stops"] * 100 < words),
    ]
    prose = (words >= 20) & (c["n_symbols"] * 100 <= words * 3) & (c["n_stops"] * 100 >= words * 3) & (c["n_upper"] * 100 <= c["n_letters"] * 20) & (c["n_repeat_words"] * 100 <= words * 30)
    return np.stack([*(np.where(x, -1, 0) for x in bad), np.where(prose, 1, 0)], axis=1)


def pattern(v: np.ndarray) -> np.ndarray:
    """Votes as one number to the base of 3."""
    return ((v + 1) * 3 ** np.arange(v.shape[1])).sum(axis=1)


def unpacked(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(RULES)) % 3


def fit(codes: np.ndarray, weight: np.ndarray, rounds: int = 200) -> np.ndarray:
    """EM over the counts of patterns; the posterior of a good text for every possible pattern."""
    prior = np.array([[r.on_bad for r in RULES], [r.on_good for r in RULES]])
    prior = (prior + 1e-4) / (prior + 1e-4).sum(axis=2, keepdims=True)
    total = float(weight.sum())
    chance, good, strength = prior.copy(), PRIOR_GOOD, PRIOR_WEIGHT * total
    cell = unpacked(codes)
    column = np.arange(len(RULES))

    def posterior(cell: np.ndarray) -> np.ndarray:
        logs = [np.log(chance[k][column, cell]).sum(axis=1) + np.log(p) for k, p in ((0, 1 - good), (1, good))]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))

    if total > 0:
        for _ in range(rounds):
            p = posterior(cell)
            before = chance.copy()
            for k, share in ((0, weight * (1 - p)), (1, weight * p)):
                seen = np.zeros((len(RULES), 3))
                for j in column:
                    seen[j] = np.bincount(cell[:, j], share, minlength=3)
                chance[k] = (seen + strength * prior[k]) / (share.sum() + strength)
            good = ((weight * p).sum() + strength * PRIOR_GOOD) / (total + strength)
            if np.abs(chance - before).max() < 1e-9:
                break
    return posterior(unpacked(np.arange(3 ** len(RULES))))


def features(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, the counts and ``pattern``; one pass over whole texts."""
    keep = [c for c in docs.columns if c not in (*COUNTS, "pattern")] if keep is None else keep
    own = T.StructType([T.StructField(c, T.LongType()) for c in (*COUNTS, "pattern")])
    schema = T.StructType([docs.schema[c] for c in keep] + own.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tb.slices(batches, text):
            c = counts(tb.texts(part.column(text)))
            found = [c[k] for k in COUNTS] + [pattern(votes(c))]
            yield pa.RecordBatch.from_arrays([part.column(k) for k in keep] + [pa.array(x.astype(np.int64)) for x in found], [*keep, *COUNTS, "pattern"])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def model(found: DataFrame) -> DataFrame:
    """``pattern`` and ``quality``: 3 to the power of the number of rules rows, all counts seen."""
    return found.sparkSession.createDataFrame(list(enumerate(_quality(found).tolist())), "pattern long, quality double")


def _quality(found: DataFrame) -> np.ndarray:
    rows = found.groupBy("pattern").count().collect()  # bounded: one row a pattern
    return fit(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64))


def base_failed() -> F.Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def judged(found: DataFrame, learned: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds ``quality``, ``base_failed`` and ``kept``; the model is broadcast, 3 ** rules rows."""
    return (
        found.join(F.broadcast(learned), "pattern", "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
    )


def scored(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = 0.5) -> DataFrame:
    """One row a document: key, the counts, ``base_failed``, ``kept``, ``quality``."""
    found = cut(features(docs, text, [key]), "rules")
    return judged(found, model(found), threshold).select(key, *COUNTS, "base_failed", "kept", F.round("quality", 9).alias("quality"))


def kept_documents(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that pass, with its columns as they were."""
    allowed = _quality(features(docs, text, [])) >= threshold
    plain, own = by_number(docs), f"c{docs.columns.index(text)}"
    names = plain.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tb.slices(batches, own):
            c = counts(tb.texts(part.column(own)))
            fails = (c["n_words"] < 20) | (c["n_repeat_words"] * 100 > c["n_words"] * 30)
            yield pa.RecordBatch.from_arrays(part.columns, names).filter(pa.array(allowed[pattern(votes(c))] & ~fails))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)

