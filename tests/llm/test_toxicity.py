"""Toxicity against a plain version: token by token, segments from their definition, document by document."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from granary.llm import toxicity as tx

SF = "/root/testdata/sf0.01"


def tokens(text):
    return [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower().encode())]


def steps(word):
    return [("p", word[:k]) if len(word) > k else None for k in tx.PREFIXES] + [("w", word)]


def share(word, clean, toxic, base, own=None):
    """The class share of a word, each step's documents without those of the steps behind it."""
    known = [s for s in steps(word) if s]
    n = [[max(side[s] - (own == k), 0) for s in known] for k, side in enumerate((clean, toxic))]
    for side in n:
        for k in range(len(side) - 2, -1, -1):
            side[k] = max(side[k], side[k + 1])
    p = base
    for k in range(len(known)):
        c, t = (side[k] - (side[k + 1] if k + 1 < len(known) else 0) for side in n)
        p = (t + tx.PRIOR * p) / (t + c + tx.PRIOR)
    return p


def defined(scores, low=0):
    """Segments by definition: the best one (shortest, leftmost of ties), then those left and right of it."""
    n = len(scores)
    best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(n) for j in range(i + 1, n + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i = -best[2]
    j = i - best[1]
    return [*defined(scores[:i], low), (low + i, low + j - 1, best[0]), *defined(scores[j:], low + j)]


def test_segments_are_those_of_the_definition():
    rng = random.Random(2)
    for _ in range(300):
        docs = [[rng.choice([-3.0, -1.25, -0.5, 0.75, 1.5, 2.125, 4.0]) for _ in range(rng.randrange(0, 14))] for _ in range(3)]
        scores = np.array([x for d in docs for x in d])
        owner = np.repeat(np.arange(3), [len(d) for d in docs])
        first, last, score = tx.segments(scores, owner)
        wanted, at = [], 0
        for d in docs:
            wanted += defined(d, at)
            at += len(d)
        got = list(zip(first.tolist(), last.tolist(), score.tolist(), strict=True))
        assert sum(x[2] for x in got) == pytest.approx(sum(x[2] for x in wanted))
        assert [x[:2] for x in got] == [x[:2] for x in wanted]


def test_a_long_run_of_segments_takes_linear_time():
    scores = np.tile([1.0, -0.4, 0.3, -1.1], 100_000)
    first, last, _ = tx.segments(scores, np.zeros(len(scores), np.int64))
    assert len(first) and (first[1:] > last[:-1]).all()


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = tx.cut(tx.training(docs, labels, "text", "doc_id", "toxic", tx.TRAIN_ROWS), "toxic")
    return docs, labels, rows, tx.fit(rows)


def test_scores_are_those_of_the_plain_version(spark, learned):
    docs, labels, rows, model = learned
    known = {}
    for r in labels.collect():
        if r["toxic"] in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0:
            known[r["doc_id"]] = min(r["toxic"], known.get(r["doc_id"], 1))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    train = {(known[k], t) for k, t in texts.items() if k in known and t is not None}
    assert sorted(map(tuple, rows.select("label", "text").collect())) == sorted(train)
    clean, toxic = Counter(), Counter()
    for label, t in train:
        (toxic if label else clean).update({s for w in set(tokens(t)) for s in steps(w) if s})
    for s in [s for s in clean | toxic if clean[s] + toxic[s] < tx.LEAST_DOCS]:
        clean.pop(s, None)
        toxic.pop(s, None)
    n = [sum(k == label for label, _ in train) for k in (0, 1)]
    base = n[1] / sum(n)

    def score_of(word, own=None):
        p = share(word, clean, toxic, base, own)
        return math.log(p / (1 - p)) - math.log(base / (1 - base)) - tx.DRIFT

    cleaned = Counter(round(score_of(w, 0) / tx.SCORE_BIN) for label, t in train if label == 0 for w in tokens(t))
    mean = sum(k * math.exp(model.rate * b * tx.SCORE_BIN) for b, k in cleaned.items()) / sum(cleaned.values())
    assert mean == pytest.approx(1, abs=1e-6)
    seen = {}
    found = {r["doc_id"]: r for r in tx.scored(docs, labels).collect()}
    assert found.keys() == texts.keys()
    for key in sorted(texts)[::3]:
        w = tokens(texts[key])
        scores = [seen.setdefault(x, score_of(x)) for x in w]
        parts = sorted((s for _, _, s in _scan(scores)), reverse=True)
        evidence, total = 0.0, 0.0
        for r, s in enumerate(parts, 1):
            scaled = model.rate * s - math.log(model.height * len(w))
            if r == 1:
                evidence = scaled if scaled > 600 else -math.log(max(-math.expm1(-math.exp(-max(scaled, -30))), 1e-300))
            total += max(scaled, 0)
            if r > 1 and scaled > 0 and total > r:
                evidence = max(evidence, total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r) - r * math.log(2))
        wanted = 1 / (1 + math.exp(-(model.fit[0] + model.fit[1] * math.log1p(evidence))))
        assert found[key]["score"] == pytest.approx(wanted, abs=1e-6)
        assert found[key]["predicted"] == int(found[key]["score"] >= 0.5)
        assert found[key]["held_out"] == (zlib.crc32(str(key).encode()) % 5 == 0)


def _scan(scores):
    """Segments by splitting at the best one, found by running sums; texts are long here."""
    out, todo = [], [(0, len(scores))]
    while todo:
        low, high = todo.pop()
        best, begin, run, at = (0.0, 0, 0), low, 0.0, low
        for k in range(low, high):
            if run <= 0:
                run, begin = 0.0, k
            run += scores[k]
            if run > best[0] + 1e-12:
                best = (run, begin, k + 1)
        at = best
        if at[0] > 0:
            out.append((at[1], at[2], at[0]))
            todo += [(low, at[1]), (at[2], high)]
    return out


def test_held_out_documents_are_told_apart(spark, learned):
    docs, labels, _, _ = learned
    rows = tx.scored(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    good = [r["score"] for r in rows if r["toxic"] == 0]
    bad = [r["score"] for r in rows if r["toxic"] == 1]
    assert sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good)) > 0.95
    assert sum(g >= 0.5 for g in good) / len(good) < 0.02


def test_passages_hold_the_words_that_count(spark, learned):
    docs, labels, _, model = learned
    text = "Über allem, " + "plain words of no harm " * 20 + "YOU IDIOT, you worthless pathetic MORON and clown" + " and so on" * 20
    row = tx.passages(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert row["passages"]
    said = " ".join(text[p["start"] : p["end"]] for p in row["passages"])
    assert "IDIOT" in said and "harm" not in said
    assert all(p["expected"] <= tx.EXPECTED and len(tokens(text[p["start"] : p["end"]])) == p["tokens"] for p in row["passages"])


LABELS = "doc_id long, toxic int, `a.b` int"
DOCS = "doc_id long, text string, `a.b` int, `back``tick` int, label int, same string, __key int"


def test_defined_cases(spark):
    bad, good = "you stupid fool and clown of a man number", "a fine day by the sea with many friends number"
    rows = [(k, (bad if k % 3 == 0 else good) + f" {k}" * 3, 1, 1, 0, "x", 5) for k in range(120)]
    rows += [(200, None, 1, 1, 0, "x", 5), (201, "", 1, 1, 0, "x", 5), (202, " ... ", 1, 1, 0, "x", 5), (None, bad, 1, 1, 0, "x", 5), (203, bad + " x" * 200_000, 1, 1, 0, "x", 5), (203, bad, 1, 1, 0, "x", 5)]
    labels = [(k, int(k % 3 == 0), 1) for k in range(120)] + [(0, 0, 1), (None, 1, 1), (5, None, 1), (6, 7, 1), (900, 1, 1)]
    out = tx.scored(spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[200][0]["score"] == by[201][0]["score"] == by[202][0]["score"] < 0.5
    assert by[200][0]["n_passages"] == 0 and by[200][0]["spans"] == ""
    assert by[None][0]["held_out"] is False and by[None][0]["predicted"] == 1
    assert len(by[203]) == 2
    for k in range(120):
        assert by[k][0]["predicted"] == int(k % 3 == 0), k


@pytest.mark.parametrize(("label", "score"), [([], 0.5), ([0], 0.0), ([1], 1.0)])
def test_one_class_or_none_gives_its_share(spark, label, score):
    docs = spark.createDataFrame([(k, "some text", 1, 1, 0, "x", 5) for k in range(9)], DOCS)
    labels = spark.createDataFrame([(k, x, 1) for k in range(9) for x in label], LABELS)
    assert {r["score"] for r in tx.scored(docs, labels).collect()} == {score}


def test_an_empty_table_gives_no_rows(spark):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 1)], LABELS)
    assert tx.scored(spark.createDataFrame([], DOCS), labels).collect() == []


def test_a_form_never_seen_takes_the_odds_of_its_stem():
    model = tx.Model(np.array([900.0, 100.0]))
    found = tx.words(pa.array(["nastyword nastywordish plainword unseenthing"]))
    stem, whole = found.keys[0], found.keys[2]
    keys = np.concatenate([stem[:6], whole[-1:]])
    model.keys = np.sort(keys)
    model.clean = np.where(np.isin(model.keys, whole[-1:]), 80, 0)
    model.toxic = np.where(np.isin(model.keys, stem[:6]), 60, 0)
    score = model.token_scores(found)
    assert score[1] > 3 and score[2] < -1 and score[3] == pytest.approx(-tx.DRIFT)
