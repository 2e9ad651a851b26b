"""Words and shingles of whole texts, found in UTF-8 bytes with numpy.

A word is a longest run of bytes other than space and 0x09-0x0D, with A-Z in lower
case.  Words and shingles are represented by 64-bit hashes; a batch of texts is
worked through in pieces of about ``PIECE`` bytes, so memory follows the batch and
the longest text in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

PIECE = 1 << 18
#: Rows that Spark hands to Python at once: 500 texts of 1 MB still fit a worker.
BATCH_ROWS = 500

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python a few hundred at a time, to workers that find this package where the driver does."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base):
        out = np.full(size + 1, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return table(_BASE), table(_INVERSE)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each starts; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(at: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``size`` bytes each; a longer text is a piece of its own."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, side="right")) - 1)
        yield first, last
        first = last


class Words(NamedTuple):
    hashes: np.ndarray
    #: Word ``bounds[d]`` is the first of text d; one more entry than texts.
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def runs(member: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that do not cross the ends of texts."""
    first, last = member.copy(), member.copy()
    first[1:] &= ~member[:-1]
    last[:-1] &= ~member[1:]
    inner = at[(at > 0) & (at < len(member))]
    first[inner] = member[inner]
    last[inner - 1] = member[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def prefix_hashes(low: np.ndarray) -> np.ndarray:
    """Sums whose differences give the hash of any substring (see :func:`span_hashes`)."""
    power, _ = _powers(max(PIECE, len(low)))
    out = np.zeros(len(low) + 1, dtype=np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[: len(low)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverse = _powers(max(PIECE, len(prefix) - 1))
    return mix((prefix[ends] - prefix[starts]) * inverse[starts])


def words(low: np.ndarray, at: np.ndarray) -> Words:
    """Words of lower-cased texts; ``at`` are offsets into ``low``."""
    starts, ends = runs(~SPACE[low], at)
    hashes = span_hashes(prefix_hashes(low), starts, ends)
    return Words(hashes, np.searchsorted(starts, at), starts, ends)


_PLACES = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` words in a row and their bounds by text.

    A text of fewer words has its whole sequence as one shingle; no words, none.
    """
    counts = np.diff(found.bounds)
    full = np.maximum(counts - width + 1, 0)
    n = len(found.hashes)
    sums = np.zeros(max(n - width + 1, 0), dtype=np.uint64)
    for k in range(width if len(sums) else 0):
        sums += found.hashes[k : k + len(sums)] * _PLACES[k]
    short = (counts > 0) & (counts < width)
    sizes = np.where(short, 1, full)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    where = np.repeat(found.bounds[:-1] - bounds[:-1], sizes) + np.arange(bounds[-1])
    out = np.zeros(int(bounds[-1]), dtype=np.uint64)
    whole = np.repeat(~short, sizes)
    out[whole] = sums[where[whole]]
    for d in np.flatnonzero(short):
        own = found.hashes[found.bounds[d] : found.bounds[d + 1]]
        out[bounds[d]] = (own * _PLACES[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mix(out), bounds


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For pieces of the column: the first row and each row's sorted distinct shingles."""
    raw, at = utf8(column)
    for first, last in pieces(at):
        low = LOWER[raw[at[first] : at[last]]]
        values, bounds = shingles(words(low, at[first : last + 1] - at[first]), width)
        yield first, [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
