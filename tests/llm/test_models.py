"""Trained operators and the pipeline's stages held against plain versions, row by row."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from granary.llm import packing, quality_classifier, quality_rules, queries
from granary.llm.tokens import Encoder
from tests.llm import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_posteriors_as_by_plain_em(spark, docs):
    ids = sorted(docs)
    counts = [plain.quality_counts(docs[d]["text"] or "") for d in ids]
    want = dict(zip(ids, plain.posteriors([plain.quality_votes(c) for c in counts]), strict=True))
    for r in queries.op1_quality_rules(spark, SF).collect():
        assert r["quality"] == pytest.approx(want[r["doc_id"]], abs=1e-6)
        assert r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5)


def test_em_finds_the_rates_that_votes_were_drawn_with():
    rng = np.random.default_rng(1)
    good = rng.random(60_000) < 0.7
    true = [[(0.5, 0.45, 0.05)] * len(quality_rules.RULES), [(0.03, 0.6, 0.37)] * len(quality_rules.RULES)]
    votes = np.stack([np.where(good, rng.choice(3, len(good), p=true[1][j]), rng.choice(3, len(good), p=true[0][j])) - 1 for j in range(len(quality_rules.RULES))], axis=1)
    codes, n = np.unique(quality_rules.pattern(votes), return_counts=True)
    p = quality_rules.fit(codes, n.astype(float))[quality_rules.pattern(votes)]
    assert ((p >= 0.5) == good).mean() > 0.97 and abs(p.mean() - 0.7) < 0.06


def test_languages_as_by_plain_naive_bayes(spark, docs):
    want = plain.languages([(d, r["text"], r["lang"]) for d, r in sorted(docs.items())])
    for r in queries.op4_language_id(spark, SF).collect():
        assert r["lang_pred"] == want[r["doc_id"]][0]
        assert r["score"] == pytest.approx(want[r["doc_id"]][1], abs=1e-6)


def test_scores_as_by_plain_densities(spark, docs):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = sorted(docs)
    x = {d: plain.statistics(docs[d]["text"] or "") for d in ids}
    learn = [d for d in ids if d in labels and zlib.crc32(str(d).encode()) % 3 != 1]
    want = plain.discriminant(np.array([x[d] for d in learn]), np.array([labels[d] for d in learn]), np.array([x[d] for d in ids]), quality_classifier.TOWARDS_POOLED, quality_classifier.TOWARDS_IDENTITY)
    got = {r["doc_id"]: r for r in queries.op6_quality_classifier(spark, SF).collect()}
    for d, p in zip(ids, want.tolist(), strict=True):
        assert got[d]["score"] == pytest.approx(p, abs=1e-6)
        assert got[d]["predicted"] == int(got[d]["score"] >= 0.5)


def test_stages_as_by_plain_versions(spark, docs):
    texts = {d: r["text"] for d, r in docs.items()}
    stage = dict(corpus_pipeline.STAGES)

    def table(some):
        return spark.createDataFrame([(d, t, docs[d]["lang"], docs[d]["source"], docs[d]["n_chars"]) for d, t in some.items()], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)

    def rows(df):
        return {r["doc_id"]: r["text"] for r in df.collect()}

    ids = sorted(texts)
    counts = [plain.quality_counts(texts[d] or "") for d in ids]
    good = plain.posteriors([plain.quality_votes(c) for c in counts])
    texts = {d: texts[d] for d, c, p in zip(ids, counts, good, strict=True) if c["words"] >= 20 and 100 * c["repeat"] <= 30 * c["words"] and p >= 0.5}
    assert rows(stage["quality rules"](spark, table({d: docs[d]["text"] for d in docs}), SF)) == texts

    cleaned = plain.without_like_lines(texts)
    assert rows(stage["line dedup"](spark, table(texts), SF)) == cleaned and cleaned != texts

    groups = plain.components({d: plain.fingerprint(t or "") for d, t in cleaned.items()})
    single = {d: t for d, t in cleaned.items() if groups[d] == d}
    assert rows(stage["simhash near-dedup"](spark, table(cleaned), SF)) == single

    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    clean = {d: t for d, t in single.items() if d not in plain.contaminated(single, items)}
    assert rows(stage["benchmark decontamination"](spark, table(single), SF)) == clean

    tokenizer = Encoder(packing.tokenizer_path()).tokenizer
    got = defaultdict(list)
    for r in stage["best-fit packing"](spark, table(clean), SF).collect():
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for d, t in clean.items():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        lead = len(ids) - (-(-len(ids) // 1024) - 1) * 1024
        edges = [0, *range(lead, len(ids) + 1, 1024)]
        assert sorted(got[d]) == [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    assert set(got) == set(clean)

    whole = defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        whole[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    assert {d: sorted(x) for d, x in whole.items()} == {d: sorted(x) for d, x in got.items()}


def test_lines_of_a_random_corpus_as_by_all_pairs(spark):
    rng = random.Random(8)
    vocabulary = [f"w{int(rng.paretovariate(0.9))}" for _ in range(400)]
    lines = [" ".join(rng.choices(vocabulary, k=rng.randint(3, 30))) for _ in range(120)]
    texts = {}
    for d in range(150):
        own = []
        for _ in range(rng.randint(1, 4)):
            w = rng.choice(lines).split()
            for _ in range(rng.randint(0, len(w) // 4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            own.append(" ".join(w))
        texts[d] = "\n".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in dict(corpus_pipeline.STAGES)["line dedup"](spark, docs, SF).collect()}
    assert got == plain.without_like_lines(texts)
