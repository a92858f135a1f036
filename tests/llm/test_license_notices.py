"""License scans held against a plain search for the key phrases."""

from __future__ import annotations

import random
import re

import pytest

from granary.llm import license_scan
from granary.llm.license_texts import LICENSES


def by_phrase(text, templates=LICENSES):
    words = " ".join(re.findall("[a-z0-9]+", text.lower()))
    held = {label for phrase, label in license_scan.BASE if f" {phrase} " in f" {words} "}
    return ",".join(sorted(held | {label for label, _, phrases in templates if all(f" {p} " in f" {words} " for p in phrases)}))


def test_all_notices_of_a_text_are_found(spark):
    rng = random.Random(4)
    wordings = [text for _, text, _ in LICENSES]
    key_phrases = [p for _, _, phrases in LICENSES for p in phrases]
    rare = "affero boost lesser mozilla redistribution unencumbered"
    texts = ["; ".join([*wordings, rare]), f"{rare} {wordings[9]}", f"{rare} creative commons granted international {wordings[1]}"]
    texts += ["\n".join(rng.sample([*wordings, *key_phrases, *rare.split(), "plain words"], rng.randint(1, 12))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in license_scan.scanned(docs).collect()}
    assert got == {k: by_phrase(t) for k, t in enumerate(texts)}
    assert set(got[0].split(",")) == {label for label, _, _ in LICENSES}


def test_a_whole_wording_scores_more_than_its_phrase(spark):
    _, wording, (phrase, *_) = next(x for x in LICENSES if x[0] == "isc")
    changed = wording.replace("hereby", "thereby").split()
    texts = [wording, " ".join([*changed[:30], "acme", *changed[30:]]), phrase, "nothing of the kind"]
    got = {r["doc_id"]: r["score"] for r in license_scan.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0] == 1 and 1 > got[1] > got[2] > got[3] == 0


def test_templates_are_a_parameter_and_only_a_to_z_are_lowered(spark):
    own = (("house", "only for use in the work house", ("work house",)),)
    texts = ["a WORK House", "worK house", "house work", "gnu general public license"]
    got = {r["doc_id"]: (r["n_words"], r["labels"]) for r in license_scan.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), templates=own).collect()}
    assert got == {0: (3, "house"), 1: (2, ""), 2: (2, ""), 3: (4, "gpl")}
    with pytest.raises(ValueError, match="does not hold"):
        license_scan.phrases_of((("x", "some words", ("other",)),))
