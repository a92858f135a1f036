"""Token ids of whole texts by a public byte-level BPE, with words encoded once.

A byte-level BPE splits a text into words by a fixed pattern and encodes each
word by itself, so the ids of a text are those of its words in a row.  Words
are found with numpy for texts of plain Latin letters, digits and punctuation
(characters below U+0250, no control characters but tab and line ends), each
distinct word is given to the tokenizer once in a task, and all other texts go
to the tokenizer whole.  Both ways give the tokenizer's own ids.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa

#: Distinct words whose ids a task keeps.
CACHE_WORDS = 700_000
PLAIN_END = 0x250
_LETTER, _DIGIT, _OTHER, _SPACE, _END = range(5)
_BAD = 255


def _classes() -> np.ndarray:
    out = np.full(PLAIN_END + 1, _BAD, np.uint8)
    for c in range(PLAIN_END):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            out[c] = _LETTER
        elif kind[0] == "N":
            out[c] = _DIGIT
        elif kind[0] not in "CZ":
            out[c] = _OTHER
    out[[0x20, 0x09, 0x0A, 0x0D]] = _SPACE
    out[0] = _END  # put between texts here; a text that holds it isn't plain
    return out


class Encoder:
    """Ids of texts, with a cache of words; one for each task."""

    def __init__(self, path: str, plain_special: bool = False) -> None:
        """With ``plain_special`` the strings of special tokens in a text are plain text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_special
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.classes = _classes()
        self.cache: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin (one more number than texts)."""
        joined = "\0".join(texts)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(sizes + 1) - sizes - 1
        kind = self.classes[np.minimum(code, PLAIN_END)]
        bad = kind == _BAD
        zeros = np.flatnonzero(code == 0)
        if len(zeros) != len(texts) - 1:
            bad[zeros] = True
            bad[begin[1:] - 1] = False
        strange = np.concatenate([[0], np.cumsum(bad)])
        odd = (strange[begin + sizes] - strange[begin]) > 0
        for mark in self.special:
            odd |= np.fromiter((mark in x for x in texts), bool, len(texts))
        odd_at = np.flatnonzero(odd)
        plain = [x if not o else "" for x, o in zip(texts, odd.tolist(), strict=True)] if len(odd_at) else texts
        if len(odd_at):
            return self._mixed(texts, plain, odd_at)
        return self._plain(joined, code, kind, begin, sizes)

    def _mixed(self, texts: list[str], plain: list[str], odd_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, first = self.encode(plain)
        whole = {i: np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32) for i in odd_at.tolist()}
        parts = [whole.get(i, ids[first[i] : first[i + 1]]) for i in range(len(texts))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def _plain(self, joined: str, code: np.ndarray, kind: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(code)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(sizes) + 1, np.int64)
        before = np.concatenate([[_END], kind[:-1]]).astype(np.uint8)
        change = kind != before
        blank = code == 0x20
        space = kind == _SPACE
        start = change & ~space & (kind != _END)  # the first character of a word proper
        # an apostrophe that begins a word takes certain letters after it along
        quote = np.flatnonzero(start & (code == 0x27) & (np.concatenate([[False], blank[:-1]]) == 0))
        for tail in ("s", "t", "re", "ve", "m", "ll", "d"):
            if not len(quote):
                break
            fits = np.ones(len(quote), bool)
            for k, letter in enumerate(tail, 1):
                there = quote + k
                fits &= (there < n) & (code[np.minimum(there, n - 1)] == ord(letter))
            taken = quote[fits]
            start[taken + 1] = False
            after = taken + 1 + len(tail)
            after = after[after < n]
            start[after[kind[after] == _LETTER]] = True
            quote = quote[~fits]
        # white space before a word: its last character stands alone, or goes with the word if it is a blank
        word_start = np.flatnonzero(start & np.concatenate([[False], space[:-1]]))
        last = word_start - 1
        start[word_start[blank[last]]] = False
        start[last] = True
        run = np.flatnonzero(space & (before != _SPACE))
        start[run] = True
        marks = np.flatnonzero(start)
        ends = np.concatenate([marks[1:], [n]])
        stop = np.searchsorted(begin + sizes, marks, side="right")
        ends = np.minimum(ends, (begin + sizes)[np.minimum(stop, len(sizes) - 1)])

        width = 1 + (code >= 0x80)
        place = np.concatenate([[0], np.cumsum(width)]).astype(np.int64)
        # words lie side by side but for the marks between texts, which are cut away
        keep = kind != _END
        data = joined.encode("utf-8")
        if not keep.all():
            data = data.replace(b"\0", b"")
        gone = np.cumsum(~keep)
        offsets = place[marks] - gone[marks]
        offsets = np.concatenate([offsets, [len(data)]])
        words = pa.LargeStringArray.from_buffers(len(marks), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        which = words.indices.to_numpy()
        sizes_of, flat = self._ids(words.dictionary.to_pylist())
        first = np.concatenate([[0], np.cumsum(sizes_of)])
        count = sizes_of[which]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = flat[np.repeat(first[which] - total[:-1], count) + np.arange(total[-1])]
        return ids, total[np.searchsorted(marks, np.concatenate([begin, [n + 1]]))]

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cache = self.cache
        found = [cache.get(w) for w in words]
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            fresh = [words[i] for i in new]
            batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
            for i, x in zip(new, batch(fresh, add_special_tokens=False), strict=True):
                found[i] = np.array(x.ids, np.uint32).tobytes()
            if len(cache) < CACHE_WORDS:
                cache.update((words[i], found[i]) for i in new)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return sizes, np.frombuffer(b"".join(found), np.uint32)


class PieceEncoder:
    """Ids of texts by a piece model that marks blanks, each with a blank before it; one for each task.

    A piece holds blanks at its start alone (looked up when the model is loaded), so no
    piece reaches over the start of a run of blanks: what stands between two such places
    is encoded by itself, once in a task.
    """

    BLANK = "▁"
    #: Longer stretches, in characters, are not kept, and no more than so many.
    LONGEST, KEPT = 64, 250_000

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.apart = not any(self.BLANK in p.lstrip(self.BLANK) for p in pieces)
        # the model puts no blank before an empty text, so a blank by itself is looked up
        self.cache: dict[str, bytes] = {" ": np.array([self.model.piece_to_id(self.BLANK)], np.uint32).tobytes()}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin (one more number than texts); no text is empty."""
        if not texts:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        if not self.apart:
            found = self.model.encode(texts, num_threads=1)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter((i for x in found for i in x), np.int64, int(sizes.sum())), np.concatenate([[0], np.cumsum(sizes)])
        whole = "".join(f" {x}" for x in texts).encode()
        data = np.frombuffer(whole, np.uint8)
        begin = np.cumsum([0, *(len(x.encode()) + 1 for x in texts)])
        start = data == 0x20
        start[1:] &= data[:-1] != 0x20
        start[begin[:-1]] = True
        marks = np.flatnonzero(start)
        offsets = np.concatenate([marks, [len(data)]]).astype(np.int64)
        parts = pa.LargeStringArray.from_buffers(len(marks), pa.py_buffer(offsets), pa.py_buffer(whole)).dictionary_encode()
        which = parts.indices.to_numpy()
        sizes_of, flat = self._ids(parts.dictionary.to_pylist())
        first = np.concatenate([[0], np.cumsum(sizes_of)])
        count = sizes_of[which]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = flat[np.repeat(first[which] - total[:-1], count) + np.arange(total[-1])]
        return ids.astype(np.int64), total[np.searchsorted(marks, begin)]

    def _ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cache = self.cache
        found = [cache.get(p) for p in parts]
        new = [i for i, x in enumerate(found) if x is None]
        for i, x in zip(new, self.model.encode([parts[i][1:] for i in new], num_threads=1), strict=True):
            found[i] = np.array(x, np.uint32).tobytes()
            if len(cache) < self.KEPT and len(parts[i]) <= self.LONGEST:
                cache[parts[i]] = found[i]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return sizes, np.frombuffer(b"".join(found), np.uint32)
