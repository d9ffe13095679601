"""Word shingles of whole texts as 64-bit hashes.

A-Z are lower-cased, words are runs of bytes other than space and 0x09-0x0D.
A text of fewer words than a shingle has its whole word sequence as its one
shingle; a text without words has none.
"""

from __future__ import annotations

import numpy as np

from vellumry.llm.bytehash import BYTE_VALUE, U64, RangeHash, mix64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = BYTE_VALUE[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STEP = U64(0xC6A4A7935BD1E995)


def word_hashes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words before each document) of the texts buf[off[i]:off[i+1]]."""
    n = len(off) - 1
    if len(buf) == 0:
        return np.zeros(0, U64), np.zeros(n + 1, np.int64)
    inside = ~_SPACE[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    at = off[:-1][off[:-1] < off[1:]]  # first bytes of texts that aren't empty
    begins[at] = inside[at]
    ends[at[1:] - 1] = inside[at[1:] - 1]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return RangeHash(_VALUE[buf]).of(s, e), np.searchsorted(s, off)


def shingle_sets(buf: np.ndarray, off: np.ndarray, words: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w, first = word_hashes(buf, off)
    whole = np.zeros(0, U64)
    if len(w) >= words:
        whole = w[: len(w) - words + 1].copy()
        for k in range(1, words):
            whole *= _STEP
            whole += w[k : len(w) - words + 1 + k]
        whole = mix64(whole ^ U64(words))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            x = whole[a : b - words + 1].copy()
            x.sort()
            if len(x) > 1:
                keep = np.empty(len(x), bool)
                keep[0] = True
                np.not_equal(x[1:], x[:-1], out=keep[1:])
                x = x[keep]
        elif b > a:
            h = w[a : a + 1].copy()
            for k in range(a + 1, b):
                h = h * _STEP + w[k]
            x = mix64(h ^ U64(b - a))
        else:
            x = np.zeros(0, U64)
        out.append(x)
    return out
