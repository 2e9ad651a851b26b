"""Benchmark decontamination by q-gram lemma filtering.

A passage within ``k`` edits of a pattern of length L shares at least L - q + 1 - k * q of
its q-grams, on diagonals (place in the text minus place in the item) at most k apart.
Patterns are the items and, with ``window``, overlapping windows of the longer ones, so that
an item quoted in part counts too; windows found in a row make one passage.  Texts and
items are compared as code points in lower case with white space collapsed.

Every q-gram of every text is looked up in an index of the benchmark, with a block of texts
at a time:

* The commonest q-grams of each pattern, ``SKIP`` of its bound at most, are left out of the
  index, and the bound falls by as many: they make most of the hits and tell the least.
* Hits are added up by item and narrow cells of diagonals; only those are kept whose cells and
  their neighbours reach the least bound of any pattern of the item.
* What is left is counted, each place of an item once, in overlapping bands of diagonals.
* In bands that reach a pattern's lowered bound, all its q-grams are counted against the whole bound.
* Bands that reach it are verified by banded alignment, many at once; one that
  cannot stay within its edits any more is given up.

None of the steps can lose a passage.  The index is sent to the tasks in blocks of items of at
most ``BLOCK_CHARS`` characters; a larger benchmark takes several scans of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chars import _POINTS, texts_of
from .store import stored
from .text import prefix_hashes, small_batches, span_hashes

Q = 5
#: Edits allowed for each character of an item or window.
RATE = 0.15
#: Characters of a window and from one to the next: a quotation of their sum or more holds a whole window.
WINDOW, STEP = 80, 20
BLOCK_CHARS = 4_000_000
#: Share of a pattern's bound up to which its commonest q-grams are skipped.
SKIP = 0.4
#: Hits expanded at once.
_HITS = 1 << 17
#: Code points of texts worked through at once.
_PIECE = 1 << 20
_FILTER_BITS = 20
#: Rows of an alignment between looks at its costs, and cells of alignments worked on at once.
_ROWS, _ALIGNED = 8, 1 << 19
#: Diagonals of a cell: 2 to this power.
_CELL = 2
#: Largest count of a cell that is told from larger ones; bounds above it are met by it.
_MOST = 1 << 10

_WHITE = np.array([9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288])


def _lower_table() -> np.ndarray:
    out = np.arange(_POINTS, dtype=np.uint32)
    for c in range(0x20000):
        low = chr(c).lower()
        if len(low) == 1:
            out[c] = ord(low)
    out[_WHITE] = 32
    out[0] = 32
    return out


_tables: list[np.ndarray] = []


def normal(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Comparable code points, the place of each in ``points``, and bounds by text.

    The zeros around each text become single blanks.
    """
    if not _tables:
        _tables.append(_lower_table())
    low = _tables[0][points]
    blank = low == 32
    drop = blank.copy()
    drop[1:] &= blank[:-1]
    drop[bounds[:-1]] = False  # the blank before a text stays
    at = np.flatnonzero(~drop)
    return low[at], at, np.searchsorted(at, bounds)


def _gram_hashes(low: np.ndarray, q: int) -> np.ndarray:
    n = max(len(low) - q + 1, 0)
    start = np.arange(n)
    return span_hashes(prefix_hashes(low), start, start + q)


def edits_allowed(length: int, rate: float, q: int) -> int:
    """Edits that leave at least one q-gram shared; -1 for items too short to be indexed."""
    return min(int(length * rate), (length - q) // q) if length >= q else -1


class Index:
    """Sorted q-gram hashes of a block of items, and the patterns that are sought."""

    def __init__(self, items: list[tuple[int, str]], q: int, rate: float, window: int | None = None):
        self.q, self.window = q, window
        self.ids, self.texts, spans = [], [], []
        hashes, item, place = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for id_, text in items:
            points = np.frombuffer(f"\0{text}\0".encode("utf-32-le", "surrogatepass"), dtype="<u4")
            low, _, _ = normal(points, np.array([0, len(points)]))
            low = low[1:]
            low = low[:-1] if len(low) and low[-1] == 32 else low
            if edits_allowed(len(low), rate, q) < 0:
                continue
            own, n = _gram_hashes(low, q), len(self.ids)
            hashes.append(own)
            item.append(np.full(len(own), n))
            place.append(np.arange(len(own)))
            self.ids.append(id_)
            self.texts.append(low)
            spans.append((n, 0, len(low)))
            if window is not None and len(low) > window:
                starts = {*range(0, len(low) - window, STEP), len(low) - window}
                spans += [(n, a, a + window) for a in sorted(starts)]
        self.longest = max(map(len, self.texts), default=0)
        #: Patterns: item, first and last place, edits; the items themselves and the windows.
        self.item, self.start, self.end = (np.array([x[k] for x in spans], dtype=np.int64) for k in range(3))
        size = self.end - self.start
        self.edits = np.array([edits_allowed(int(n), rate, q) for n in size], dtype=np.int64)
        #: Bands overlap by the edits, so the diagonals of an occurrence lie in one band.
        self.width = 2 * self.edits + 2
        self.is_part = size != np.array([len(t) for t in self.texts], dtype=np.int64)[self.item] if len(spans) else size > 0
        every, item, place = np.concatenate(hashes), np.concatenate(item), np.concatenate(place)
        bound = self.full = size - q + 1 - self.edits * q
        #: All items in a row: code points, shortened hashes, and where each item begins in both.
        self.letters = np.concatenate([np.zeros(0, np.int32), *[t.astype(np.int32) for t in self.texts]])
        self.grams = (every & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        self.at = np.concatenate([[0], np.cumsum([len(t) for t in self.texts])]).astype(np.int64)
        self.grams_at = np.searchsorted(item, np.arange(len(self.ids) + 1))
        skipped = self._skipped(every, np.searchsorted(item, np.arange(len(self.ids) + 1)), bound)
        #: Places of an item that are looked up, before each place.
        ahead = np.concatenate([[0], np.cumsum(skipped)])
        base = np.searchsorted(item, self.item)
        self.bound = bound - (ahead[base + self.end - q + 1] - ahead[base + self.start])
        #: The least bound of an item's windows, and of the item itself.
        self.least = [np.full(len(self.ids), np.iinfo(np.int64).max) for _ in range(2)]
        for part in (False, True):
            own = self.is_part == part
            np.minimum.at(self.least[int(part)], self.item[own], self.bound[own])
        self.small = [np.minimum(x, _MOST).astype(np.uint16) for x in self.least]
        self.lowest = [int(x.min()) if len(x) else 0 for x in self.small]
        self.highest = [int(x[x < _MOST].max()) if (x < _MOST).any() else _MOST for x in self.small]
        every, item, place = every[~skipped], item[~skipped], place[~skipped]
        order = np.argsort(every, kind="stable")
        self.hashes, self.of, self.place = every[order], item[order], place[order]
        #: What turns a hit's place in the text into its cell, scattered by item.
        self.shift = (((self.of * 0x3C6EF35F) << _CELL) - self.place).astype(np.uint32)
        self.slots = np.searchsorted(self.hashes, np.arange((1 << _FILTER_BITS) + 1, dtype=np.uint64) << np.uint64(64 - _FILTER_BITS))
        self.slots[-1] = len(self.hashes)
        self.slots = self.slots.astype(np.int32)
        #: Entries with an entry's hash, from the first of them on.
        edge = np.flatnonzero(np.append(self.hashes[1:] != self.hashes[:-1], True)) if len(self.hashes) else np.zeros(0, np.int64)
        self.runs = edge[np.searchsorted(edge, np.arange(len(self.hashes)))] + 1 - np.arange(len(self.hashes))
        self.filter = np.diff(self.slots) > 0
        #: Patterns of each item, whole first.
        self.first = np.searchsorted(self.item, np.arange(len(self.ids) + 1))

    def _skipped(self, hashes: np.ndarray, bounds: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Places that are not looked up: the commonest of each item, while no pattern loses more than its share."""
        out = np.zeros(len(hashes), dtype=bool)
        if not len(hashes):
            return out
        _, group, count = np.unique(hashes, return_inverse=True, return_counts=True)
        often = count[group]
        left = (bound * SKIP).astype(np.int64)
        first = np.searchsorted(self.item, np.arange(len(self.ids) + 1))
        for n, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            own = slice(first[n], first[n + 1])
            start, end, room = self.start[own], self.end[own] - self.q, left[own].copy()
            for k in np.argsort(-often[a:b], kind="stable"):
                if often[a + k] < 2 or not room[0]:
                    break
                inside = (start <= k) & (k <= end)
                if (room[inside] > 0).all():
                    room[inside] -= 1
                    out[a + k] = True
        return out


def _look_up(index: Index, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places with hits, the first entry of each and their number."""
    slot = (hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)
    at = np.flatnonzero(index.filter[slot])
    left = index.slots[slot[at]]
    own = hashes[at]
    same = index.hashes[left] == own
    if not same.all():  # other hashes in the slot
        left[~same] = np.searchsorted(index.hashes, own[~same], side="left")
        left = np.minimum(left, len(index.hashes) - 1)
        hit = index.hashes[left] == own
        at, left, own = at[hit], left[hit], own[hit]
    return at, left, index.runs[left]


def _near(index: Index, part: int, entry: np.ndarray, counts: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Hits whose cells of diagonals, with neighbours, may reach a bound of their item's patterns."""
    own = index.edits[index.is_part == bool(part)]
    if not len(own):
        return np.zeros(0, dtype=np.int64)
    # The diagonals of an occurrence are at most its edits apart.
    run = (int(own.max()) + (1 << _CELL) - 1 >> _CELL) + 1
    around = np.concatenate([counts[-run:], counts, counts[:run]])
    if run * _MOST >= 1 << 16:
        around = around.astype(np.uint32)
    for combine in (np.add, np.maximum):  # sums of ``run`` cells from each cell on, then the largest that covers a cell
        width = 1
        while width < run:
            step = min(width, run - width)
            around = combine(around[step:], around[:-step])
            width += step
    if index.lowest[part] == _MOST:
        return np.arange(len(entry))
    near = np.flatnonzero((around[1:] >= index.lowest[part]).take(cell))
    if index.lowest[part] == index.highest[part]:
        return near
    return near[around[cell[near] + 1] >= index.small[part][index.of[entry[near]]]]


def _candidates(index: Index, hashes: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """(pattern, first diagonal, text) rows of the bands of some texts that reach their pattern's bound."""
    none = np.zeros((0, 3), dtype=np.int64)
    if not len(index.hashes):
        return none
    at, left, count = _look_up(index, hashes)
    # Texts are set so far apart that none shares a diagonal with the next.
    text = np.searchsorted(cut, at, side="right") - 1
    widest = index.longest + 4 * int(index.edits.max()) + 4
    gap = 2 * widest + 64
    spread = at + (text + 1) * gap
    held, first, ends = [none[:, :2]], 0, np.cumsum(count)
    while first < len(at):
        # Hits at once, and twice the reach of any pattern at least; the next ones begin one reach earlier.
        last = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + _HITS, side="right"))
        last = max(last, int(np.searchsorted(at, at[first] + 2 * widest)))
        n = count[first:last]
        end = np.cumsum(n)
        entry = np.repeat((left[first:last] - (end - n)).astype(np.int32), n)
        entry += np.arange(len(entry), dtype=np.int32)
        # Cells are folded to a table of counts; what falls together only makes them larger.
        bits = min(max(14, int(2 * len(entry) - 1).bit_length()), 32 - _CELL)
        cell = np.repeat(spread[first:last].astype(np.uint32), n)
        cell += index.shift[entry]
        cell >>= np.uint32(_CELL)
        cell &= np.uint32((1 << bits) - 1)
        counts = np.bincount(cell.view(np.int32), minlength=1 << bits)
        if counts.max() > _MOST:
            counts = np.minimum(counts, _MOST)
        counts = counts.astype(np.uint16)
        for part in (0, 1):
            near = _near(index, part, entry, counts, cell)
            if len(near):
                item, place = index.of[entry[near]], index.place[entry[near]]
                diagonal = spread[first + np.searchsorted(end, near, side="right")] - place
                held.append(_reached(index, part, item, place, diagonal))
        first = len(at) if last >= len(at) else int(np.searchsorted(at, at[last] - widest))
    found = np.unique(np.concatenate(held), axis=0)
    begins = cut[:-1] + np.arange(1, len(cut)) * gap
    own = np.searchsorted(begins, found[:, 1] + index.longest + 4 * index.edits[found[:, 0]] + 4, side="right") - 1
    return np.column_stack([found[:, 0], found[:, 1] - begins[own], own])


def _reached(index: Index, part: int, item: np.ndarray, place: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
    """(pattern, first diagonal) of the bands that reach a bound, of whole items or of windows (``part``)."""
    if part:  # windows are equally wide
        width, edits = int(index.width[index.is_part][0]), int(index.edits[index.is_part][0])
    else:
        width, edits = index.width[index.first[item]], index.edits[index.first[item]]
    band = diagonal // width
    below = np.flatnonzero(diagonal - band * width < edits)
    # One number for item, band and place; every place of an item counts once in a band.
    step, bands = index.longest + 1, int(band.max()) + 2
    base = (item * bands + band + 1) * step + place
    key = np.sort(np.concatenate([base, base[below] - step]))
    key = key[np.append(True, key[1:] != key[:-1])]
    group = key // step
    start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(start, len(key)))
    owner = group[start] // bands
    good = size >= index.least[part][owner]
    start, owner = start[good], owner[good]
    first = index.first[owner] + part
    number = (index.first[owner + 1] if part else first + 1) - first
    line = np.repeat(np.arange(len(start)), number)
    pattern = np.arange(len(line)) - np.repeat(np.cumsum(number) - number, number) + first[line]
    begin = group[start][line] * step + index.start[pattern]
    inside = np.searchsorted(key, begin + index.end[pattern] - index.start[pattern] - index.q + 1) - np.searchsorted(key, begin)
    keep = inside >= index.bound[pattern]
    pattern, band = pattern[keep], group[start][line[keep]] % bands - 1
    return np.column_stack([pattern, band * index.width[pattern] + index.start[pattern]])


def align_many(
    patterns: np.ndarray,
    lengths: np.ndarray,
    texts: np.ndarray,
    begins: np.ndarray,
    sizes: np.ndarray,
    first: np.ndarray,
    wides: np.ndarray,
    edits: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(which, edits, start, end) of those of many patterns that stand in their texts within their ``edits``.

    The first ``lengths[c]`` codes of row c of ``patterns`` are aligned with ``sizes[c]`` places of ``texts`` from
    ``begins[c]`` on, on the ``wides[c]`` diagonals from ``first[c]`` on.  Of equal alignments, the one that
    starts first; places are the text's own.
    """
    m, wide = patterns.shape[1], int(wides.max(initial=1))
    which = np.arange(len(patterns))
    # A cell holds edits and, below them, the diagonal at which its alignment starts.
    bits = wide.bit_length()
    kind = np.int32 if (m + wide + 4) << bits < 1 << 30 else np.int64
    one, huge = kind(1 << bits), kind((m + wide + 2) << bits)
    lane = np.arange(wide, dtype=kind)
    beyond = lane >= wides[:, None]
    j = first[:, None] + lane
    cost = np.where((j >= 0) & (j <= sizes[:, None]) & ~beyond, lane, huge).astype(kind)
    low, high = -first, sizes - first  # diagonals of the text's ends in row 0
    places = first[:, None] + np.arange(m + wide)
    inside = (places >= 0) & (places < sizes[:, None])
    codes = texts[np.where(inside, begins[:, None] + places, 0)].astype(np.int32)
    codes[~inside] = -1
    found = [[np.zeros(0, dtype=np.int64)] * 4]
    for i in range(1, m + 1):
        if not len(which):
            break
        now = cost + one * (codes[:, i - 1 : i - 1 + wide] != patterns[:, i - 1 : i])
        now[:, :-1] = np.minimum(now[:, :-1], cost[:, 1:] + one)  # the item's character has no partner
        outside = beyond | (lane > (high - i)[:, None])
        if (low >= i).any():  # diagonals that begin before the text
            outside |= lane < (low - i)[:, None]
            # In the column before the text's first character only the item's characters go.
            edge = lane == (low - i)[:, None]
            up = np.concatenate([cost[:, 1:] + one, np.full((len(cost), 1), huge, dtype=kind)], axis=1)
            now = np.where(edge, up, now)
        now[outside] = huge
        # The text's character has no partner: the least from the left, one edit a step.
        now = np.minimum.accumulate(now - one * lane, axis=1) + one * lane
        now[outside] = huge
        cost = now
        done = lengths == i
        if done.any() or i % _ROWS == 0:
            good = cost.min(axis=1) >> bits <= edits
            ends = np.flatnonzero(done & good)
            if len(ends):
                best = cost[ends].argmin(axis=1)
                value = cost[ends, best]
                found.append([which[ends], value >> bits, first[ends] + (value & (one - 1)), first[ends] + best + i])
            go = good & ~done
            if not go.all():
                which, cost, codes, patterns, lengths, low, high, first, beyond, edits = (
                    x[go] for x in (which, cost, codes, patterns, lengths, low, high, first, beyond, edits)
                )
    return tuple(np.concatenate(x) for x in zip(*found))


def align(item: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Fewest edits that turn ``item`` into a part of ``text`` on diagonals ``low`` to ``high``.

    Gives (edits, start, end); of equal alignments, the one that ends first.
    """
    band = np.arange(low, high + 1)
    huge = len(item) + len(text) + 1
    inside = (band >= 0) & (band <= len(text))
    cost = np.where(inside, 0, huge)
    start = np.clip(band, 0, len(text))
    for i in range(1, len(item) + 1):
        j = band + i
        ok = (j >= 1) & (j <= len(text))
        differs = np.ones(len(band), dtype=np.int64)
        differs[ok] = text[j[ok] - 1] != item[i - 1]
        now = np.where(ok, cost + differs, huge)
        from_up = np.append(cost[1:], huge) + 1  # the item's character has no partner
        better = from_up < now
        now, begin = np.where(better, from_up, now), np.where(better, np.append(start[1:], 0), start)
        now[(j < 0) | (j > len(text))] = huge
        # The text's character has no partner: least cost from the left, one edit a step.
        slid = now - np.arange(len(band))
        best = np.minimum.accumulate(slid)
        from_left = best + np.arange(len(band))
        lead = np.maximum.accumulate(np.where(slid == best, np.arange(len(band)), 0))
        shift = (from_left < now) & (j <= len(text))
        cost, start = np.where(shift, from_left, now), np.where(shift, begin[lead], begin)
    k = int(cost.argmin())
    return int(cost[k]), int(start[k]), int(band[k] + len(item))


def _exact(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int] | None:
    """The alignment without edits, if there is one; it needs no table."""
    at = text.tobytes().find(item.tobytes())
    return (0, at // 4, at // 4 + len(item)) if at >= 0 and at % 4 == 0 else None


def _apart(spans: list[tuple[int, int, int]], taken: list[tuple[int, int, int]]) -> None:
    """Adds those of the spans (edits, start, end) that overlap none before."""
    for edits, start, end in spans:
        if all(end <= s or start >= e for _, s, e in taken):
            taken.append((edits, start, end))


def _passages(index: Index, whole: int, hits: list[tuple[int, int, int, int]], low: np.ndarray) -> list[tuple[int, int, int]]:
    """Passages (edits, start, end) of one item made of windows (start, end, place in the item, edits), longest first.

    Windows that overlap in the text and lie on near diagonals are one passage, which is
    aligned with the part of the item that they cover.
    """
    groups: list[list[tuple[int, int, int, int]]] = []
    for hit in sorted(hits):
        for group in groups:
            last = group[-1]
            near = abs((hit[0] - hit[2]) - (last[0] - last[2])) <= hit[3] + last[3]
            if near and hit[2] >= last[2] and hit[0] <= last[1]:
                group.append(hit)
                break
        else:
            groups.append([hit])
    out = []
    for group in groups:
        if len(group) == 1:
            out.append((group[0][3], group[0][0], group[0][1]))
            continue
        first, last = group[0][2], max(h[2] for h in group) + index.window
        part = index.texts[whole][first:last]
        slack = sum(h[3] for h in group) + 1
        a, b = max(0, group[0][0] - slack), min(len(low), max(h[1] for h in group) + slack)
        diagonals = [h[0] - h[2] + first - a for h in group]
        edits, start, end = _exact(part, low[a:b]) or align(part, low[a:b], min(diagonals) - slack, max(diagonals) + slack)
        out.append((edits, start + a, end + a))
    return sorted(out, key=lambda x: (x[1] - x[2], x))


def _shared(index: Index, grams: np.ndarray, pattern: np.ndarray, begin: np.ndarray, n: int, diagonals: int) -> np.ndarray:
    """How many of the ``n`` q-grams of each pattern a text holds on the diagonals from place ``begin`` on."""
    own = index.grams[(index.grams_at[index.item[pattern]] + index.start[pattern])[:, None] + np.arange(n)]
    places = begin[:, None] + np.arange(n + diagonals - 1)
    text = grams[np.clip(places, 0, len(grams) - 1)]
    held = np.zeros(own.shape, dtype=bool)
    for d in range(diagonals):
        held |= own == text[:, d : d + n]
    return held.sum(axis=1)


def _verified(index: Index, low: np.ndarray, cut: np.ndarray) -> dict[tuple[int, int], set[tuple[int, int, int, int]]]:
    """By text and item, the patterns (edits, start, end, pattern) that stand in it."""
    hashes = _gram_hashes(low, index.q)
    rows = _candidates(index, hashes, cut)
    grams = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    out: dict[tuple[int, int], set] = {}
    length = index.end[rows[:, 0]] - index.start[rows[:, 0]]
    kept = [rows[:0]]
    for m in np.unique(length):
        own = rows[length == m]
        diagonals, n = int(index.width[own[0, 0]] + index.edits[own[0, 0]]), int(m) - index.q + 1
        many = max(1, _ALIGNED // n)
        for part in range(0, len(own), many):
            pattern, first, text = own[part : part + many].T
            shared = _shared(index, grams, pattern, first + cut[text], n, diagonals)
            kept.append(own[part : part + many][shared >= index.full[pattern]])
    # Patterns of about one length together, so many as fit the cells.
    rows = np.concatenate(kept)
    wide = index.width[rows[:, 0]] + 3 * index.edits[rows[:, 0]] + 1
    last = 0
    while last < len(rows):
        start, last = last, last + max(1, int(np.searchsorted(np.maximum.accumulate(wide[last:]) * np.arange(1, len(rows) - last + 1), _ALIGNED)))
        pattern, first, text = rows[start:last].T
        m = index.end[pattern] - index.start[pattern]
        places = (index.at[index.item[pattern]] + index.start[pattern])[:, None] + np.arange(m.max())
        letters = index.letters[np.minimum(places, len(index.letters) - 1)]
        k = index.edits[pattern]
        found = align_many(letters, m, low, cut[text], cut[text + 1] - cut[text], first - k, wide[start:last], k)
        for c, edits, begin, end in zip(*[x.tolist() for x in found]):
            p = int(pattern[c])
            out.setdefault((int(text[c]), int(index.item[p])), set()).add((edits, begin, end, p))
    return out


def _matches(index: Index, low: np.ndarray, cut: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(text, item id, start, end, edits) in some texts; overlapping finds of an item count once, the best of them.

    Whole items come before their parts, and longer parts before shorter.
    """
    out = []
    for (text, item), found in _verified(index, low, cut).items():
        own = low[cut[text] : cut[text + 1]]
        taken: list[tuple[int, int, int]] = []
        _apart(sorted(h[:3] for h in found if not index.is_part[h[3]]), taken)
        parts = {(start, end, int(index.start[p]), edits) for edits, start, end, p in found if index.is_part[p]}
        parts = [h for h in parts if all(h[1] <= s or h[0] >= e for _, s, e in taken)]
        _apart(_passages(index, item, parts, own), taken)
        out += [(text, index.ids[item], start, end, edits) for edits, start, end in taken]
    return out


def _finds(block: Index, column: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item id, start, end, edits) of a column of texts, in code points of the text."""
    for first, points, bounds in texts_of(column, _PIECE):
        low, at, cut = normal(points, bounds)
        for d, item, start, end, edits in sorted(_matches(block, low, cut)):
            yield first + d, item, int(at[cut[d] + start] - bounds[d] - 1), int(at[cut[d] + end - 1] - bounds[d]), edits


def _search(index):
    def run(batches):
        for batch in batches:
            found = list(zip(*_finds(index.value, batch.column(1)))) or [[]] * 5
            yield pa.record_batch(
                [batch.column(0).take(pa.array(found[0], pa.int64())), *[pa.array(x, pa.int64()) for x in found[1:]]],
                names=[batch.schema.names[0], "item_id", "start", "end", "edits"],
            )

    return run


def _clean(index):
    def run(batches):
        for batch in batches:
            held = np.ones(batch.num_rows, dtype=bool)
            held[[row for row, *_ in _finds(index.value, batch.column(batch.num_columns - 1))]] = False
            yield batch.filter(pa.array(held))

    return run


def _indexes(
    spark: SparkSession, benchmark: DataFrame, item_col: str, item_text_col: str, q: int, rate: float, block_chars: int, window: int | None
) -> Iterator:
    """The benchmark's index, as broadcasts of blocks."""
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text")
    ).filter("item IS NOT NULL AND text IS NOT NULL").distinct()
    items = stored(items, "items")
    if window is not None and edits_allowed(window, rate, q) < 0:
        raise ValueError(f"a window of {window} characters holds no {q}-gram")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    for block in range(blocks):
        # Bounded: a block has about ``block_chars`` characters, whatever the benchmark's size.
        own = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).orderBy("item", "text").collect()
        yield spark.sparkContext.broadcast(Index([tuple(r) for r in own], q, rate, window))


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    q: int = Q,
    rate: float = RATE,
    block_chars: int = BLOCK_CHARS,
    window: int | None = None,
) -> DataFrame:
    """One row per passage found: the document's id, item_id, start, end (code points), edits.

    With ``window``, passages that hold parts of an item are found too: windows of so many
    characters within their own budget; edits are then those of the part that is quoted.

    Null and empty texts hold nothing.  Items that are null, or shorter than ``q``
    characters, are too little to be told and match nothing; repeated items are
    reported for each id once.  Repeated documents are reported as often as they
    come in.  Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_scanned"))
    schema = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, item_id long, start long, end long, edits long"
    blocks = _indexes(spark, benchmark, item_col, item_text_col, q, rate, block_chars, window)
    return reduce(DataFrame.union, [rows.mapInArrow(_search(index), schema) for index in blocks])


def without_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    q: int = Q,
    rate: float = RATE,
    block_chars: int = BLOCK_CHARS,
    window: int | None = None,
) -> DataFrame:
    """The rows of ``docs`` in whose text :func:`find_benchmark` finds nothing; each row goes by its own text."""
    small_batches(docs.sparkSession)
    left = docs.withColumn("_scanned", F.col(text_col).cast("string"))
    for index in _indexes(docs.sparkSession, benchmark, item_col, item_text_col, q, rate, block_chars, window):
        left = left.mapInArrow(_clean(index), left.schema)
    return left.drop("_scanned")
