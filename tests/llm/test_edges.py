"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from granary.llm import chat_format, decontamination, language_id, license_scan, line_dedup, packing, quality_classifier, quality_rules, secret_scan, simhash_dedup, token_alignment, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, key string, n_words long, kept boolean, owner string, length long, symbols string, h1 long, uid long, `__uid` long, `__fp` string, `__found` string, `__gone` int, term string"
LONG = " ".join(f"word{k % 977} and other{k % 31}." for k in range(40_000))
GOOD = "The quick brown fox, who is not lazy, jumps over the dog. " * 2 + "Then it goes home to sleep for a while, and all is well."


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, 0, 1, "k", 2, True, "o", 3, "x", 4, 5, 6, "f", "g", 7, "t")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [row(1, None), row(2, ""), row(3, " \t\n "), row(4, GOOD), row(4, GOOD), row(None, GOOD), row(5, LONG), row(6, GOOD, None, None), row(7, "\n\n"), row(8, "é中\U0001f600 café \x00 x")], SCHEMA
    ).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "the quick brown fox who is not lazy jumps over the dog the quick"), (2, None), (3, "..."), (None, "word1 and"), (4, "zebra")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1), (4, 0), (5, 1), (6, 0), (9, None), (None, 1)], "doc_id long, quality int")


def checks(bench, labels):
    return {
        "op1": quality_rules.scored,
        "op2": license_scan.scanned,
        "op4": language_id.identified,
        "op5": line_dedup.report,
        "op6": lambda d: quality_classifier.scored(d, labels),
        "op8": simhash_dedup.near_duplicates,
        "op9": lambda d: decontamination.digest(decontamination.findings(d, bench)),
        "op10": lambda d: secret_scan.digest(secret_scan.findings(d)),
        "op11": lambda d: toxicity.scored(d, labels.withColumnRenamed("quality", "toxic")),
        "op13": token_alignment.report,
    }


OPS = ["op1", "op2", "op4", "op5", "op6", "op8", "op9", "op10", "op11", "op13"]


@pytest.mark.parametrize("op", OPS)
def test_one_row_a_document_and_equal_rows_for_equal_texts(docs, none, bench, labels, op):
    run = checks(bench, labels)[op]
    got = run(docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in docs.collect())
    if op != "op5":
        twice = [tuple(r) for r in got if r["doc_id"] == 4]
        assert twice[0] == twice[1]
    assert run(none).count() == 0


def test_quality_rules_on_odd_texts(docs):
    got = {r["doc_id"]: r for r in quality_rules.scored(docs).collect()}
    assert got[1]["n_words"] == got[2]["n_words"] == got[3]["n_words"] == 0
    assert got[1]["base_failed"] and not got[1]["kept"]
    assert got[8]["n_words"] == 4 and got[8]["word_chars"] == 3 + 4 + 1 + 1


def test_language_of_texts_without_letters(docs):
    got = {r["doc_id"]: r for r in language_id.identified(docs).collect()}
    assert got[1]["lang_pred"] == got[3]["lang_pred"] == "und" and got[1]["score"] == 0


def test_classifier_without_labels_scores_half(docs, labels):
    got = quality_classifier.scored(docs, labels.filter("false")).collect()
    assert {r["score"] for r in got} == {0.5}


def test_components_of_texts_without_words(docs):
    got = {r["doc_id"]: r for r in simhash_dedup.near_duplicates(docs).collect() if r["doc_id"]}
    assert {got[k]["component_id"] for k in (1, 2, 3, 7)} == {1} and got[1]["fingerprint"] == "0" * 16
    assert got[6]["component_id"] == 4


@pytest.mark.parametrize("stage", [k for k, _ in corpus_pipeline.STAGES[:4]])
def test_stages_return_the_columns_of_documents(spark, docs, none, bench, tmp_path, stage):
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    run = dict(corpus_pipeline.STAGES)[stage]
    out = run(spark, docs, str(tmp_path))
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert out.count() <= docs.count()
    assert run(spark, none, str(tmp_path)).count() == 0


ODD_NAMES = {"a.b": 1, "back`tick": 2, "pattern": 3, "c0": 4, "word": 5, "__row": 6, "__key": 7, "label": 8}


@pytest.mark.parametrize("stage", [k for k, _ in corpus_pipeline.STAGES])
def test_stages_take_columns_of_any_name(spark, docs, bench, tmp_path, stage):
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    odd = docs.select("*", *(F.lit(v).alias(k) for k, v in ODD_NAMES.items()))
    run = dict(corpus_pipeline.STAGES)[stage]
    got, plain = run(spark, odd, str(tmp_path)), run(spark, docs, str(tmp_path))
    if stage != "best-fit packing":
        assert got.columns == odd.columns
        rows = got.collect()
        assert all(r.asDict()[k] == v for r in rows for k, v in ODD_NAMES.items())
        assert sorted(map(str, (r[: len(docs.columns)] for r in rows))) == sorted(map(str, map(tuple, plain.collect())))
    else:
        assert got.schema == plain.schema and got.count() == plain.count()


@pytest.mark.parametrize("op", OPS)
def test_operators_take_columns_of_any_name(docs, bench, labels, op):
    odd = docs.select("*", *(F.lit(v).alias(k) for k, v in ODD_NAMES.items()))
    run = checks(bench, labels)[op]
    assert run(odd).count() == run(docs).count()


def test_a_stage_deletes_the_tables_of_those_before_it(spark, docs, tmp_path):
    import os

    _, second = corpus_pipeline.STAGES[1]
    _, third = corpus_pipeline.STAGES[2]
    second(spark, docs, "").write.parquet(str(tmp_path / "lines"))
    folders = [p.removeprefix("file:") for p in corpus_pipeline._tables[2]]
    assert any(map(os.path.isdir, folders))
    out = third(spark, spark.read.parquet(str(tmp_path / "lines")), "")
    assert not any(map(os.path.isdir, folders))
    assert out.count()


def test_near_dedup_keeps_one_row_of_each_group(docs):
    got = simhash_dedup.deduplicated(docs).collect()
    assert sum(r["text"] == GOOD for r in got) == 1 and [r["doc_id"] for r in got if r["text"] == GOOD] == [4]
    assert sum(not (r["text"] or "").strip() for r in got) == 1


def test_line_dedup_leaves_null_and_short_lines(docs):
    got = line_dedup.deduplicated(docs).collect()
    assert sum(r["text"] is None for r in got) == 1
    assert sum(r["text"] == GOOD for r in got) == 1
    assert {r["text"] for r in got if r["doc_id"] in (2, 3, 7)} == {"", " \t\n ", "\n\n"}


def test_packing_covers_all_tokens(docs, none):
    got = packing.packed(docs).collect()
    assert sum(r["length"] for r in got if r["doc_id"] in (1, 2)) == 2
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for v in places.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.packed(none).count() == 0
    assert packing.sequences(docs).agg(F.max(F.size("input_ids"))).first()[0] == 1024


def test_chat_of_nulls_ties_and_control_strings(spark):
    schema = "conv_id long, turn long, role string, text string, turns int, blocks string"
    data = [(1, 1, "user", "a\\<|end|>", 0, ""), (1, 0, None, None, 0, ""), (1, 2, "user", "<|more|>", 0, ""), (1, 3, "assistant", "\\<\\|<|turn|>x</s>", 0, ""), (1, 3, "assistant", "", 0, ""), (None, 0, "assistant", "n", 0, "")]
    out = chat_format.parsed(chat_format.formatted(spark.createDataFrame(data, schema)))
    got = {r["conv_id"]: r for r in out.collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("", ""), ("user", "a\\<|end|>"), ("user", "<|more|>"), ("assistant", ""), ("assistant", "\\<\\|<|turn|>x</s>")]
    assert got[1]["learned"] == ["", "\\<\\|<|turn|>x</s>"] and got[None]["learned"] == ["n"]
    assert chat_format.formatted(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("roles", [("user", "assistant"), ("assistant",)])
def test_chat_of_very_many_turns(spark, roles):
    turns = [(1, k, roles[k % len(roles)], f"turn é {k} <|end|>") for k in range(20_000)]
    out = chat_format.formatted(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = chat_format.parsed(out).collect()[0]
    assert [tuple(t) for t in got["turns"]] == [t[2:] for t in turns]
    assert got["learned"] == [t[3] for t in turns if t[2] == "assistant"]


HOSTILE = {
    "one letter": ("a" * 1_000_000, ["hex:0:1000000"]),
    "begun tokens": ("eyJ" * 300_000, []),
    "begun schemes": ("ab+.-" * 200_000 + "://x:y@h", []),
    "words of assignments": ("token " * 100_000 + " " * 100_000, []),
    "begun keys": ("-----BEGIN " + "A " * 300_000, []),
    "very many": (" ".join(f"0123456789abcdef{k:04x}" for k in range(50_000)), [f"hex:{21 * k}:{21 * k + 20}" for k in range(50_000)]),
}


@pytest.mark.parametrize("name", HOSTILE)
def test_secret_scans_take_a_time_in_proportion_to_the_text(spark, name):
    text, spans = HOSTILE[name]
    began = time.monotonic()
    got = secret_scan.digest(secret_scan.findings(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string"))).collect()[0]
    assert got["spans"] == ",".join(spans) and time.monotonic() - began < 60


def test_secret_of_null_text(docs):
    got = {r["doc_id"]: r for r in secret_scan.digest(secret_scan.findings(docs)).collect()}
    assert got[1]["spans"] == "" and got[1]["n_hex"] == 0
