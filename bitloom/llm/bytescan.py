"""Whole texts as arrays: words, lines and shingles of a batch without a Python loop over them.

UTF-8 bytes of one Arrow batch are scanned some hundred kB at a time.  Both word
classes used by the operators treat every byte from 0x80 up alike, so bytes give
exactly the words that code points would.  A word's hash is the sum of its
bytes' values times powers of an odd number, taken from prefix sums over a
stretch of STEP bytes and finished by a 64-bit mixer, so memory beyond the text
itself is a few bytes for each byte and some 8-byte arrays over its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
STEP = 1 << 19
_ALL = (1 << 64) - 1
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_JOIN = U(0xD6E8FEB86659FD93)

ALNUM = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F] after A-Z are lower-cased
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
NONSPACE = np.ones(256, bool)  # [^\x20\x09-\x0D]
NONSPACE[0x20] = NONSPACE[0x09:0x0E] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_VALUES = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
_FOLDED = _VALUES.copy()
_FOLDED[0x41:0x5B] = _VALUES[0x61:0x7B]
_powers: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """Powers of the base and of its inverse, for offsets up to STEP."""
    if not _powers:
        for b in (_BASE, _INVERSE):
            p = np.full(STEP + 1, b, U)
            p[0] = 1
            _powers.append(np.cumprod(p))
    return _powers


class Texts:
    """The texts of part of a batch. ``at``: where in ``data`` each begins, and the end."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at, self.n = data, at, len(at) - 1

    def _hash(self, start: np.ndarray, end: np.ndarray, fold: bool) -> np.ndarray:
        """Hashes of stretches of bytes that stand in order and don't overlap."""
        power, inverse = _tables()
        values = _FOLDED if fold else _VALUES
        out = np.empty(len(start), U)
        k = 0
        while k < len(start):
            a = int(start[k])
            j = int(np.searchsorted(end, a + STEP, "right"))
            if j <= k:  # longer than a step: piece by piece
                h = 0
                for p in range(a, int(end[k]), STEP):
                    part = values[self.data[p : min(p + STEP, int(end[k]))]]
                    h += int((part * power[: len(part)]).sum()) * pow(_BASE, p - a, 1 << 64)
                out[k] = h & _ALL
                k += 1
                continue
            part = values[self.data[a : int(end[j - 1])]]
            part *= power[: len(part)]
            sums = np.zeros(len(part) + 1, U)
            np.cumsum(part, out=sums[1:])
            s, e = start[k:j] - a, end[k:j] - a
            out[k:j] = (sums[e] - sums[s]) * inverse[s]
            k = j
        out += (end - start).astype(U) * U(0xA0761D6478BD642F)
        return mix(out)

    def spans(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words begin and end; none crosses from one text into the next."""
        is_word = kind[self.data]
        begins = is_word.copy()
        begins[1:] &= ~is_word[:-1]
        heads = self.at[:-1][self.at[:-1] < self.at[1:]]
        begins[heads] = is_word[heads]
        start = np.flatnonzero(begins)
        ends = begins
        ends[:] = is_word
        ends[:-1] &= ~is_word[1:]
        last = heads[heads > 0] - 1
        ends[last] = is_word[last]
        return start, np.flatnonzero(ends) + 1

    def words(self, kind: np.ndarray = ALNUM, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and where each text's words begin (with the end)."""
        start, end = self.spans(kind)
        return self._hash(start, end, fold), np.searchsorted(start, self.at)

    def lines(self, word_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r"""Of all \n-split lines: hash, whether a word begins in it, and the text's number."""
        cut = np.flatnonzero(self.data == 10)
        owner = np.searchsorted(self.at, cut, "right") - 1
        start = np.concatenate([self.at[:-1], cut + 1])
        text = np.concatenate([np.arange(self.n), owner])
        order = np.lexsort((start, text))
        start, text = start[order], text[order]
        end = np.concatenate([start[1:] - 1, self.at[-1:]])
        final = np.flatnonzero(np.concatenate([text[1:] != text[:-1], [True]])) if len(text) else []
        end[final] = self.at[1:][text[final]]
        return self._hash(start, end, False), np.searchsorted(word_starts, end) > np.searchsorted(word_starts, start), text

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text are set in the mask."""
        return np.array([np.count_nonzero(mask[a:b]) for a, b in zip(self.at[:-1], self.at[1:])], np.int64)


def scan(column: pa.Array) -> Iterator[tuple[int, int, Texts]]:
    """(first row, row after the last, texts) of a string column, about STEP bytes at a time; nulls are empty.

    One text longer than that is scanned alone, so memory follows the longest
    text and not the batch.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(at, at[i] + STEP, "right")) - 1)
        yield i, j, Texts(data[at[i] : at[j]], at[i : j + 1] - at[i])
        i = j


def shingles(words: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words in each text, and where each text's begin.

    A text with fewer words, but one at least, has a single shingle of all of them.
    """
    n = np.diff(at)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    h = words.copy()
    for k in range(1, size):
        h *= _JOIN
        h[: max(len(h) - k, 0)] += words[k:]
    h += U(size)
    keep = np.ones(len(words), bool)
    ends = at[1:][n >= size]
    for k in range(1, size):
        keep[ends - k] = False
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        first, own = at[:-1][short], n[short]
        one = np.zeros(len(short), U)
        for k in range(size - 1):
            live = k < own
            one[live] = one[live] * _JOIN + words[first[live] + k]
            keep[first[live] + k] = k == 0
        h[first] = one + own.astype(U)
    return mix(h[keep]), np.concatenate([[0], np.cumsum(count)])


def ragged(values: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values, kind))
