"""Code points of whole texts and folded symbols, with numpy."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Code points worked through at once.
PIECE = 1 << 16
_POINTS = 0x110000


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(_POINTS)), dtype=bool, count=_POINTS)


@lru_cache(maxsize=1)
def lower_letters() -> np.ndarray:
    """Lower-case code point of each letter, 0 for what is no letter."""
    out = np.where(letters(), np.arange(_POINTS, dtype=np.uint32), np.uint32(0))
    for c in np.flatnonzero(letters()[:0x20000]):
        low = chr(c).lower()
        if len(low) == 1:
            out[c] = ord(low)
    return out


@lru_cache(maxsize=1)
def folded() -> np.ndarray:
    """Symbols of 5 bits: 0 no letter, 1-26 a-z without marks, 27-31 other letters."""
    out = np.zeros(_POINTS, dtype=np.uint32)
    low = lower_letters()
    out[low > 0] = 27 + low[low > 0] % 5
    for c in range(0x250):
        base = unicodedata.normalize("NFD", chr(low[c]))[0] if low[c] else " "
        if "a" <= base <= "z":
            out[c] = ord(base) - 96
    return out


#: Scripts written without blanks between words.
_UNSPACED = [(0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xA4CF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]


@lru_cache(maxsize=1)
def word_kinds() -> np.ndarray:
    """0 blank or control, 1 part of a word, 2 a word of its own: signs and characters of unspaced scripts."""
    out = np.zeros(_POINTS, dtype=np.uint8)
    for c in range(_POINTS):
        group = unicodedata.category(chr(c))[0]
        out[c] = 1 if group in "LNM" else 0 if group in "ZC" else 2
    for first, last in _UNSPACED:
        own = out[first : last + 1]
        own[own == 1] = 2
    return out


def texts_of(column: pa.Array, piece: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces (first row, code points, bounds) of about ``piece`` code points: each text stands between two zeros."""
    texts = [t or "" for t in column.to_pylist()]
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= piece):
            size += len(texts[last]) + 2
            last += 1
        joined = "".join(f"\0{t}\0" for t in texts[first:last])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        sizes = [len(t) + 2 for t in texts[first:last]]
        yield first, points, np.concatenate([[0], np.cumsum(sizes)])
        first = last
