"""Maximal exact matches against a search along every diagonal."""

from __future__ import annotations

import random

import pytest

from granary.operators import matches, reference
from tests.test_bases import table_of


def plain(reads, ref, least):
    out = []
    for key, s in reads:
        for c, r in ref.items():
            for d in range(-len(s or ""), len(r)):
                run = 0
                for i in range(len(s or "") + 1):
                    j = i + d
                    if i < len(s) and 0 <= j < len(r) and s[i] == r[j] and s[i] != "N":
                        run += 1
                        continue
                    if run >= least:
                        out.append((key, c, i - run, j - run, run))
                    run = 0
    return sorted(out)


@pytest.mark.parametrize(("size", "k", "least", "salt"), [(64, 5, 9, 4096), (16, 4, 4, 3), (4096, 6, 12, 2)])
def test_matches_are_those_of_every_diagonal(spark, size, k, least, salt):
    rng = random.Random(size)
    ref = {"c1": "".join(rng.choice("ACGT") for _ in range(150)) + "A" * 40 + "ACACACACACACACACAC" + "N" * 6, "c2": "".join(rng.choice("AC") for _ in range(120)), "c3": "ACG"}
    reads = []
    for n in range(40):
        c = rng.choice(["c1", "c2"])
        lo = rng.randrange(0, len(ref[c]) - 30)
        s = list(ref[c][lo : lo + rng.randrange(5, 60)])
        for _ in range(rng.randrange(0, 3)):
            s[rng.randrange(len(s))] = rng.choice("ACGTN")
        reads.append((n, rng.choice(["", "TTT"]) + "".join(s) + rng.choice(["", "G"])))
    reads += [(100, "A" * 60), (101, "ACG"), (102, ""), (103, ref["c1"])]
    df = spark.createDataFrame([*reads, (104, None)], "name int, seq string").repartition(3)
    got = matches.maximal(df, reference.blocks(table_of(spark, ref), size), "name", "seq", least, k, size, salt_places=salt)
    assert sorted(tuple(r) for r in got.collect()) == plain(reads, ref, least)


def test_texts_with_any_characters(spark):
    docs = spark.createDataFrame([(1, "é中\U0001f600 the same words here, é中\U0001f600 the same words"), (2, None), (3, "")], "doc_id long, text string")
    reads = spark.createDataFrame([(9, "x中\U0001f600 the same words!")], "k int, t string")
    got = sorted(tuple(r)[2:] for r in matches.maximal(reads, matches.text_blocks(docs, "doc_id", "text", 8), "k", "t", 10, 6, 8, None).collect())
    assert got == [(1, 1, 17), (1, 26, 17)]
    assert matches.maximal(reads.limit(0), matches.text_blocks(docs, "doc_id", "text", 8), "k", "t", 10, 6, 8).count() == 0


def test_few_seeds_and_blocks_of_the_reference_leave_their_tasks(spark):
    rng = random.Random(1)
    texts = {k: "".join(rng.choice("ACGT") for _ in range(3000)) for k in range(20)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    read = texts[3][1000:1100]
    own = matches.seeds(spark.createDataFrame([(read,)], "text string"), "text", 12, 20, None)
    every = matches.seeds(docs, "text", 12, 20, None)
    few = matches.seeds(docs, "text", 12, 20, None, among=own)
    assert own.count() <= few.count() < every.count() / 50
    assert own.join(few, "seed", "left_anti").count() == 0
    reads = spark.createDataFrame([(7, read), (7, read), (8, None)], "k int, t string")
    got = matches.maximal(reads, lambda over: matches.text_blocks(docs, "doc_id", "text", 256, over), "k", "t", 20, 12, 256, None)
    assert sorted(tuple(r) for r in got.collect()) == plain([(7, read)], texts, 20) == [(7, 3, 0, 1000, 100)]
    blocks = matches.text_blocks(docs, "doc_id", "text", 256)
    here = spark.createDataFrame([(3, 4)], "contig long, block long")
    assert {(r["contig"], r["block"]) for r in matches.with_key_in(blocks, ["contig", "block"], here).collect()} == {(3, 4)}
