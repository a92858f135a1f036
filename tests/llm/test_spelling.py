"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from granary.llm import spelling as sp


def edits(a, b):
    """Whether two words differ by exactly one letter put in, left out or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    near = {w: [v for v in n if edits(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def table(spark, rows):
    return spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, `a.b` int, word int")


def rows_of(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def words(rng, n):
    """Words of few letters, many of them anagrams and one edit apart."""
    out = []
    for _ in range(n):
        w = [rng.choice("abcdé×") for _ in range(rng.randrange(6, 11))]
        out.append("".join(w))
        for _ in range(rng.randrange(3)):
            v = list(w)
            k = rng.randrange(len(v))
            v[k : k + 1] = rng.choice([[], [rng.choice("abcdé")], [v[k], rng.choice("abcdé")]])
            out.append("".join(v))
        if rng.random() < 0.3:
            rng.shuffle(w)
            out.append("".join(w))
    return out


@pytest.mark.parametrize(("sample_words", "cell_words"), [(sp.SAMPLE_WORDS, sp.CELL_WORDS), (60, 8), (1, 1)])
def test_rows_are_those_of_all_pairs(spark, sample_words, cell_words):
    rng = random.Random(11)
    pool = words(rng, 90)
    times = [1, 2, 3, 30, 400]
    texts = [" ".join([w] * rng.choice(times)) + "." for w in pool]
    rows = [*enumerate(texts), (900, None), (901, ""), (None, "nameless nameless 中nameless中 Ünïcödéd Ünïcödéd"), (902, "x" * 5000 + " " + "x" * 5000 + " " + "x" * 4999 + " " + "x" * 4999)]
    rows += [(3, texts[3])] * 2  # repeated rows count each
    assert rows_of(sp.grouped(table(spark, rows).repartition(4), sample_words=sample_words, cell_words=cell_words)) == plain(rows)


def test_forms_are_followed_to_the_last(spark):
    rows = [(1, "abcdefgh " * 2000), (2, "abcdefghi " * 200), (3, "abcdefghij " * 20), (4, "abcdefghijk " * 2)]
    found = rows_of(sp.grouped(table(spark, rows)))
    assert {r[0]: r[2] for r in found}["abcdefghijk"] == "abcdefgh"
    assert found == plain(rows)


def test_an_empty_table_gives_no_rows(spark):
    assert sp.grouped(table(spark, [])).collect() == []
    assert sp.grouped(table(spark, [(1, None), (2, "short words only")])).collect() == []


def test_crc_is_that_of_the_library():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 3000).astype(np.uint8)
    start = rng.integers(0, 2800, 300)
    end = start + rng.integers(1, 200, 300)
    begun = rng.integers(0, 1 << 32, 300).astype(np.uint32)
    got = sp.crc_of(data, start, end, begun)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(start, end, begun, strict=True)]


def test_no_leaf_within_reach_is_pruned():
    rng = np.random.default_rng(4)
    counts = np.zeros((400, sp.DIMENSIONS), np.int32)
    counts[:, :6] = rng.integers(0, 4, (400, 6))
    tree = sp.Tree(counts, 5)
    assert sorted(np.concatenate(tree.members).tolist()) == list(range(400))
    for up, down in ((1, 1), (1, 0), (0, 1)):
        reached = {(int(q), int(w)) for leaf, own in tree.visited(counts, up, down) for q in own for w in tree.members[leaf]}
        step = counts[None] - counts[:, None]
        fits = (np.clip(step, 0, None).sum(axis=2) <= up) & (np.clip(-step, 0, None).sum(axis=2) <= down)
        assert {tuple(x) for x in np.argwhere(fits).tolist()} <= reached
        assert len(reached) < 400 * 400
