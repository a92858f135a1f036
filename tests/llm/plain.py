"""The operators in plain Python and numpy, from their definitions, for small tables."""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

from granary.llm import language_id, quality_rules

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(text: str) -> list[bytes]:
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().translate(LOWER))


class Groups:
    def __init__(self, n: int) -> None:
        self.root = list(range(n))

    def top(self, k: int) -> int:
        while self.root[k] != k:
            k = self.root[k]
        return k

    def join(self, a: int, b: int) -> None:
        low, high = sorted((self.top(a), self.top(b)))
        self.root[high] = low


def quality_counts(t: str) -> dict[str, int]:
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    data = t.encode()
    return {
        "words": len(w),
        "chars": sum(map(len, w)),
        "symbols": len(re.findall(r"[#*$%&|<>]", t)),
        "repeat": len({p for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}),
        "lines": len(lines),
        "dup": len(lines) - len(set(lines)),
        "upper": len(re.findall(rb"[A-Z]", data)),
        "letters": len(re.findall(rb"[A-Za-z\xC3-\xF4]", data)),
        "marks": len(re.findall(rb"[!?]", data)),
        "stops": len(re.findall(rb"[.,;:]", data)),
    }


def quality_votes(c: dict[str, int]) -> tuple[int, ...]:
    n = c["words"]
    bad = (n < 20, c["symbols"] * 100 > n * 10, c["repeat"] * 100 > n * 30, c["dup"] * 100 > c["lines"] * 50, c["chars"] < 2.5 * n or c["chars"] > 15 * n, c["upper"] * 100 > c["letters"] * 40, c["marks"] * 100 > n * 10 or c["stops"] * 100 < n)
    prose = n >= 20 and c["symbols"] * 100 <= n * 3 and c["stops"] * 100 >= n * 3 and c["upper"] * 100 <= c["letters"] * 20 and c["repeat"] * 100 <= n * 30
    return (*(-int(b) for b in bad), int(prose))


def posteriors(votes: list[tuple[int, ...]], rounds: int = 200) -> list[float]:
    """EM document by document: each rule's chances of its votes on good and bad texts, with prior counts."""
    rules, n = quality_rules.RULES, len(votes)

    def smooth(p):
        p = [x + 1e-4 for x in p]
        return [x / sum(p) for x in p]

    prior = [[smooth(r.on_bad) for r in rules], [smooth(r.on_good) for r in rules]]
    chance, good, strength = prior, quality_rules.PRIOR_GOOD, quality_rules.PRIOR_WEIGHT * n

    def posterior(v):
        p = [1 - good, good]
        for k in (0, 1):
            for j, x in enumerate(v):
                p[k] *= chance[k][j][x + 1]
        return p[1] / (p[0] + p[1])

    for _ in range(rounds):
        post = [posterior(v) for v in votes]
        new = []
        for k in (0, 1):
            share = [p if k else 1 - p for p in post]
            new.append([[(sum(s for s, v in zip(share, votes, strict=True) if v[j] == x) + strength * prior[k][j][x + 1]) / (sum(share) + strength) for x in (-1, 0, 1)] for j in range(len(rules))])
        moved = max(abs(a - b) for x, y in zip(new, chance, strict=True) for p, q in zip(x, y, strict=True) for a, b in zip(p, q, strict=True))
        chance, good = new, (sum(post) + strength * quality_rules.PRIOR_GOOD) / (n + strength)
        if moved < 1e-9:
            break
    return [posterior(v) for v in votes]


def language_grams(text: str) -> tuple[Counter, int]:
    """Hashed n-grams of letters and one blank behind each word, and how many letters there are."""
    chars, letters = [], 0
    for c in text.lower():
        if unicodedata.category(c)[0] == "L":
            chars.append(c)
            letters += 1
        elif chars and chars[-1] != " ":
            chars.append(" ")
    if chars and chars[-1] != " ":
        chars.append(" ")
    out = Counter()
    for n in language_id.GRAMS:
        for k in range(len(chars) - n + 1):
            if n == 1 and chars[k] == " ":
                continue
            h = n * 0x27D4EB2F & 0xFFFFFFFF
            for j in range(n):
                h = (h ^ ord(chars[k + j])) * int(language_id._MULTIPLY[j]) & 0xFFFFFFFF
                h ^= h >> 15
            out[h & ((1 << language_id.BITS) - 1)] += 1
    return out, letters


def languages(rows: list[tuple[int, str | None, str | None]]) -> dict[int, tuple[str, float]]:
    """Multinomial naive Bayes with add-half smoothing, learned from rows that are not held out."""
    found = {d: language_grams(t or "") for d, t, _ in rows}
    counts, size = defaultdict(Counter), Counter()
    for d, t, lang in rows:
        if t is not None and lang is not None and zlib.crc32(str(d).encode()) % 4 != 2:
            counts[lang] += found[d][0]
            size[lang] += 1
    names, buckets, a = sorted(size), 1 << language_id.BITS, language_id.SMOOTHING
    total = {x: sum(counts[x].values()) + a * buckets for x in names}
    out = {}
    for d, _, _ in rows:
        grams, letters = found[d]
        logs = [math.log(size[x] / sum(size.values())) + sum(n * math.log((counts[x][g] + a) / total[x]) for g, n in grams.items()) for x in names]
        best = max(range(len(names)), key=lambda k: (logs[k], -k))
        out[d] = (names[best], 1 / sum(math.exp(x - logs[best]) for x in logs)) if letters else ("und", 0.0)
    return out


def statistics(t: str) -> list[float]:
    data, w = t.encode(), [x for x in re.split(rb"[\x20\x09-\x0D]+", t.encode()) if x]
    n = len(w)
    windows = Counter(tuple(w[k : k + 8]) for k in range(n - 7))
    lines = [x for x in data.split(b"\n") if x]
    letters = len(re.findall(rb"[A-Za-z\xC3-\xF4]", data))

    def share(a, b):
        return math.sqrt(a / max(b, 1))

    def count(form):
        return len(re.findall(form, data))

    return [
        math.log1p(n),
        math.log1p(sum(len(x.decode()) for x in w) / max(n, 1)),
        share(count(rb"[A-Z]"), letters),
        share(count(rb"[0-9]"), len(t)),
        share(count(rb"[#*$%&|<>@^~{}\[\]\\_=+]"), n),
        share(count(rb"[!?]"), n),
        share(count(rb"[.,;:]"), n),
        share(count(rb"\n"), n),
        share(len(set(w)), n),
        share(sum(c for c in windows.values() if c > 1), n),
        share(len(lines) - len(set(lines)), len(lines)),
        math.log1p(max(map(len, w), default=0)),
    ]


def discriminant(x: np.ndarray, labels: np.ndarray, score: np.ndarray, pooled_share: float, identity_share: float) -> np.ndarray:
    """Posterior of class 1 for ``score`` from normal densities with shrunken covariances, by inverse and determinant."""
    pooled = sum(np.cov(x[labels == k].T, bias=True) * (labels == k).sum() for k in (0, 1)) / len(x)
    logs = []
    for k in (0, 1):
        c = (1 - pooled_share) * np.cov(x[labels == k].T, bias=True) + pooled_share * pooled
        c = (1 - identity_share) * c + identity_share * (np.trace(c) / len(c) + 1e-9) * np.eye(len(c))
        apart = score - x[labels == k].mean(axis=0)
        logs.append(np.log((labels == k).mean()) - 0.5 * (np.linalg.slogdet(c)[1] + np.einsum("ij,jk,ik->i", apart, np.linalg.inv(c), apart)))
    return 1 / (1 + np.exp(logs[0] - logs[1]))


def edits(a: list[bytes], b: list[bytes]) -> int:
    row = np.arange(len(b) + 1)
    other = np.array(b, object)
    steps = np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        up = np.minimum(row[1:] + 1, row[:-1] + (other != x))
        row = np.minimum.accumulate(np.concatenate([[i], up]) - steps) + steps
    return int(row[-1])


def without_like_lines(docs: dict[int, str | None], min_words: int = 5, similarity: float = 0.8) -> dict[int, str | None]:
    """Each line but the first, by document, of every group of like ones goes; all pairs are compared that could be like by their words."""
    place = [(d, k) for d in sorted(docs) if docs[d] is not None for k in range(len(docs[d].split("\n")))]
    split = {d: docs[d].split("\n") for d in docs if docs[d] is not None}
    found = [(p, words(split[p[0]][p[1]])) for p in place]
    found = [(p, w) for p, w in found if len(w) >= min_words]
    counts = np.zeros((len(found), 256), np.int16)
    for k, (_, w) in enumerate(found):
        for x in w:
            counts[k, zlib.crc32(x) & 255] += 1
    size = counts.sum(axis=1)
    groups, first = Groups(len(found)), {}
    for k, (_, w) in enumerate(found):
        key = b" ".join(w)
        groups.join(first.setdefault(key, k), k)
    kinds = np.array(sorted(first.values()))
    for n, k in enumerate(kinds):
        rest = kinds[n + 1 :]
        most = np.floor(np.maximum(size[rest], size[k]) * (1 - similarity) + 1e-9)
        for j in rest[np.abs(counts[rest] - counts[k]).sum(axis=1) <= 2 * most].tolist():
            longer = max(len(found[k][1]), len(found[j][1]))
            if groups.top(k) != groups.top(j) and edits(found[k][1], found[j][1]) <= math.floor(longer * (1 - similarity) + 1e-9):
                groups.join(int(k), j)
    gone = {found[k][0] for k in range(len(found)) if groups.top(k) != k}
    return {d: t if t is None or not any((d, k) in gone for k in range(len(split[d]))) else "\n".join(x for k, x in enumerate(split[d]) if (d, k) not in gone) for d, t in docs.items()}


def fingerprint(t: str) -> int:
    w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().translate(LOWER))
    shingles = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def components(prints: dict[int, int], budget: int = 3) -> dict[int, int]:
    ids = sorted(prints)
    groups, bits = Groups(len(ids)), np.array([prints[d] for d in ids], np.uint64)
    for k in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(bits[k + 1 :] ^ bits[k]) <= budget).tolist():
            groups.join(k, k + 1 + j)
    return {d: ids[groups.top(k)] for k, d in enumerate(ids)}


def contaminated(docs: dict[int, str | None], items: dict[int, str | None], width: int = 13, share: int = 20) -> set[int]:
    windows = {tuple(w[k : k + width]) for t in items.values() for w in [words(t or "")] if w for k in range(max(1, len(w) - width + 1))}
    out = set()
    for d, t in docs.items():
        w = words(t or "")
        hit = {p for n in {len(x) for x in windows} for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows for p in range(k, k + n)}
        if hit and share * len(hit) >= len(w):
            out.add(d)
    return out
