"""Token alignment against a plain version: ends as sets, links as lists, one document at a time."""

from __future__ import annotations

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from granary.llm import token_alignment as ta

os.environ["TOKENIZERS_PARALLELISM"] = "false"


def plain(texts):
    """Rows of (n_a, n_b, n_groups, n_links, n_best, count_sum, hash) for each text."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown)}

    def side_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    docs = []
    for t in texts:
        x = [(i, bytes(of[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids] if t else []
        y = [(i, side_b(i)) for i in b.encode(t)] if t else []
        whole = (" " + (t or "")).encode()
        if not t or b"".join(s for _, s in x) != whole or b"".join(s for _, s in y) != whole:
            docs.append(None)
            continue
        ends = [np.cumsum([len(s) for _, s in side]).tolist() for side in (x, y)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for c in cuts:
            p, q = ends[0].index(c, i) + 1, ends[1].index(c, j) + 1
            groups.append(([k for k, _ in x[i:p]], [k for k, _ in y[j:q]]))
            i, j = p, q
        docs.append((len(x), len(y), groups, Counter((m, n) for g in groups for m in g[0] for n in g[1])))
    n = Counter(pair for d in docs if d for pair in d[3])
    best = {}
    for (m, _), k in n.items():
        best[m] = max(best.get(m, 0), k)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        said = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in d[2])
        out.append((d[0], d[1], len(d[2]), sum(d[3].values()), sum(k for p, k in d[3].items() if n[p] == best[p[0]]), sum(k * n[p] for p, k in d[3].items()), hashlib.sha256(said.encode()).hexdigest()))
    return out


TEXTS = [
    None,
    "",
    "a ▁ mark",
    "plain words, and more of them",
    "plain words, and more of them",
    "<|endoftext|> and <s> </s> <0x41>",
    "  two blanks   three\n\n\tand\r\nlines  ",
    " \n ",
    "naïve façade – Größe, ciónes \U0001f600\U0001f469‍\U0001f680 漢字かな",
    "x" * 3000,
    "กำ" * 700,
    "\0 control \x07",
]


def rows(df):
    names = [*ta.COUNTS, "n_best", "count_sum", "groups_sha256"]
    return {r["doc_id"]: tuple(r[c] for c in names) for r in df.collect()}


@pytest.mark.parametrize("block_pairs", [ta.BLOCK_PAIRS, 50])
def test_rows_are_those_of_the_plain_version(spark, block_pairs):
    rng = random.Random(5)
    alphabet = ["the ", "ation", "qz", "é", "\n", " ", "7", "12", "'s", "-", "\U0001f680", "漢", "ABC"]
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(80)]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in enumerate(texts)], "doc_id long, text string, `a.b` int, `__row` int").repartition(5)
    assert rows(ta.report(docs, block_pairs=block_pairs)) == dict(enumerate(plain(texts)))


def test_an_empty_table_gives_no_rows(spark):
    assert ta.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_whole_tables_rows_are_those_of_the_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = docs.select("doc_id", "text").collect()
    assert rows(ta.report(docs)) == dict(zip([r[0] for r in known], plain([r[1] for r in known]), strict=True))


def test_groups_are_given_as_text(spark):
    row = ta.aligned(spark.createDataFrame([(1, "plain words")], "doc_id long, text string"), groups=True).first()
    assert hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"]
    assert row["n_groups"] == row["groups"].count(";") + 1


def test_large_groups_are_counted_by_distinct_ids(monkeypatch):
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 9, 400), rng.integers(0, 7, 300)]
    ends = [np.array([1, 5, 300, 400]), np.array([2, 3, 290, 300])]
    owner = np.array([0, 0, 1, 1])
    wanted = ta.linked(ids, ends, owner, 7, 63)
    monkeypatch.setattr(ta, "LINKS", 20)
    for got, want in zip(ta.linked(ids, ends, owner, 7, 63), wanted, strict=True):
        assert got.tolist() == want.tolist()


def test_common_ends_are_all_found():
    rng = random.Random(8)
    for _ in range(300):
        texts = [(sorted({*rng.sample(range(1, size), rng.randrange(0, size)), size}), sorted({*rng.sample(range(1, size), rng.randrange(0, size)), size})) for size in (rng.randrange(1, 40) for _ in range(3))]
        ends, first, at = ([], []), ([0], [0]), 0
        for pair in texts:
            for side in (0, 1):
                ends[side].extend(at + e for e in pair[side])
                first[side].append(len(ends[side]))
            at += pair[0][-1]
        a, b = np.array(ends[0]), np.array(ends[1])
        cut_a, cut_b = ta.common_ends(a, b, np.array(first[0]), np.array(first[1]))
        assert a[cut_a].tolist() == b[cut_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
