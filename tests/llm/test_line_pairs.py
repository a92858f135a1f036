"""Line dedup held against all pairs of lines by edit similarity."""

from __future__ import annotations

import random
import re

import pytest

from granary.llm import line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def kept_by_all_pairs(texts, min_words=5, similarity=0.8):
    """Lines that stay, every two compared; texts in the order of their keys, one line each."""
    lines = [re.findall("[a-z0-9]+", t.lower()) for t in texts]
    root = list(range(len(lines)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for b in range(len(lines)):
        for a in range(b):
            most = max(len(lines[a]), len(lines[b]))
            if min(len(lines[a]), len(lines[b])) >= min_words and abs(len(lines[a]) - len(lines[b])) <= most // 5 and top(a) != top(b) and distance(lines[a], lines[b]) <= most // 5:
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {k for k in range(len(lines)) if top(k) == k}


def kept(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"] for r in line_dedup.report(docs).collect() if r["n_removed"] == 0}


def test_lines_that_differ_in_numbers_stay(spark):
    texts = ["10 20 30 40 50", "99 88 77 66 55", "3.14 2.71 1.41", "9.99 8.88 7.77", "row 1 of the long table of 9 columns here", "row 2 of the long table of 9 columns here"]
    assert kept(spark, texts) == {0, 1, 2, 3, 4}


def test_a_pair_is_found_beside_a_permuted_line(spark):
    rng = random.Random(1)
    line = [f"word{k}" for k in range(20)]
    shuffled = [" ".join(rng.sample(line, 20)) for _ in range(60)]
    near = " ".join([*line[:7], "other", *line[8:]])
    texts = [*shuffled, near, " ".join(line)]
    assert kept(spark, texts) == kept_by_all_pairs(texts) == set(range(61))


def test_short_words_count(spark):
    line = "a cat sat on my big old mat as it was so wet in the telephone exchange building yesterday morning"
    texts = [line, line.replace("telephone", "wooden").replace("yesterday", "tomorrow")]
    assert kept(spark, texts) == {0}


def test_all_pairs_of_the_whole_radius(spark):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(60)]
    texts = []
    for _ in range(60):
        line = rng.choices(vocabulary, k=rng.randint(5, 40))
        texts.append(" ".join(line))
        for _ in range(4):
            other = list(line)
            for _ in range(rng.randint(0, len(line) // 5 + 1)):
                k = rng.randrange(len(other))
                rng.choice([lambda: other.pop(k), lambda: other.insert(k, rng.choice(vocabulary)), lambda: other.__setitem__(k, rng.choice(vocabulary))])()
            texts.append(" ".join(other))
    rng.shuffle(texts)
    assert kept(spark, texts) == kept_by_all_pairs(texts)


@pytest.mark.parametrize("salt", [200_000, 5])
def test_all_pairs_of_a_pair_of_words_in_every_line(spark, monkeypatch, salt):
    monkeypatch.setattr(line_dedup, "SALT_CLASSES", salt)
    monkeypatch.setattr(line_dedup, "SMALL", 4)
    monkeypatch.setattr(line_dedup, "FIRST_LAGS", 1)
    monkeypatch.setattr(line_dedup, "CHUNK", 16)
    rng = random.Random(3)
    texts = [" ".join(rng.choices("abcd", k=rng.randint(5, 9))) for _ in range(150)]
    assert kept(spark, texts) == kept_by_all_pairs(texts)
