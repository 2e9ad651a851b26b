"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists the pieces that end at each place of a word; dynamic
programming carries the best score and, beside it, the number of pieces.  A piece is a
run of marks, which stand for blanks, or has none but at its start, so no piece reaches
from a word over the mark behind it: a text's pieces are those of its words, each with the
marks before it, and each distinct one is worked through once.  Without ``blank_runs``,
the pieces that are runs of marks are left out and texts are cut at every blank.

Tie rules are the tokenizer's: the places where a piece may start are taken in order and
a later way must be strictly better, so of equal ways the one with the longest last
piece stays.  A character that no single-character piece covers is an unknown piece with
the lowest score less 10; neighbouring unknowns are fused and spelled in bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import small_batches

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words whose counts a task keeps; the memory is emptied when it is full.
MEMORY = 1 << 19


@lru_cache(maxsize=4)
def read_vocabulary(path: str, blank_runs: bool = False) -> tuple[tuple[tuple[str, float], ...], bool]:
    """Pieces with scores in the order of their ids, and whether unknown characters are spelled in bytes.

    Control, unknown and byte pieces are left out, and runs of marks unless ``blank_runs``.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    own = [k for k in every if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
    pieces = ((model.id_to_piece(k), model.get_score(k)) for k in own)
    return tuple(p for p in pieces if blank_runs or MARK not in p[0][1:]), any(model.is_byte(k) for k in every)


class Segmenter:
    """Counts of the best segmentation of words."""

    def __init__(self, pieces: Iterable[tuple[str, float]], byte_fallback: bool):
        self.bytes = byte_fallback
        self.automaton = ahocorasick.Automaton()
        lowest = 0.0
        self.single = set()
        for piece, score in pieces:
            if MARK in piece[1:] and piece.strip(MARK):
                raise ValueError(f"piece {piece!r} reaches over a blank")
            self.automaton.add_word(piece, (len(piece), score))
            lowest = min(lowest, score)
            if len(piece) == 1:
                self.single.add(piece)
        self.unknown = lowest - UNKNOWN_PENALTY
        self.automaton.make_automaton()
        self.memory: dict[str, tuple[int, float]] = {}

    def count(self, word: str) -> tuple[int, float]:
        """Pieces and score of the best segmentation of a word."""
        got = self.memory.get(word)
        if got is None:
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            got = self.memory[word] = self._count(word)
        return got

    def _count(self, word: str) -> tuple[int, float]:
        n = len(word)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, piece in self.automaton.iter(word):
            ending[last + 1].append(piece)
        score, count, open_ = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            best, pieces, unknown = None, 0, False
            for size, own in sorted(ending[end], reverse=True):  # longest piece, so earliest start, first
                total = score[end - size] + own
                if best is None or total > best:
                    best, pieces, unknown = total, count[end - size] + 1, False
            if word[end - 1] not in self.single:
                total = score[end - 1] + self.unknown
                if best is None or total > best:
                    fused = open_[end - 1] and not self.bytes
                    more = len(word[end - 1].encode("utf-8", "surrogatepass")) if self.bytes else 1 - fused
                    best, pieces, unknown = total, count[end - 1] + more, True
            score[end], count[end], open_[end] = best, pieces, unknown
        return count[n], score[n]


def split_words(text: str) -> list[str]:
    """Words as the tokenizer sees them: blanks become marks, and a mark begins every word."""
    if not text:
        return []
    marked = text.replace(" ", MARK)
    if not marked.startswith(MARK):
        marked = MARK + marked
    return [MARK + w for w in marked[1:].split(MARK)]


_UNIT = re.compile(f"{MARK}+[^{MARK}]*")


def split_units(text: str) -> list[str]:
    """Like :func:`split_words`, but a run of marks stays with the word behind it."""
    if not text:
        return []
    marked = text.replace(" ", MARK)
    return _UNIT.findall(marked if marked.startswith(MARK) else MARK + marked)


_segmenters: dict[tuple[str, bool], Segmenter] = {}


def _tokens(path: str, blank_runs: bool):
    split = split_units if blank_runs else split_words

    def run(batches):
        if (path, blank_runs) not in _segmenters:
            _segmenters[path, blank_runs] = Segmenter(*read_vocabulary(path, blank_runs))
        segmenter = _segmenters[path, blank_runs]
        memory, slow = segmenter.memory, segmenter.count
        for batch in batches:
            counts, scores = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                pieces, total = 0, 0.0
                for word in split(text or ""):
                    n, s = memory.get(word) or slow(word)
                    pieces += n
                    total += s
                counts.append(pieces)
                scores.append(total)
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:-1], "n_tokens", "log_score"],
            )

    return run


def count_tokens(
    docs: DataFrame,
    *,
    text_col: str = "text",
    keep: list[str] | None = None,
    vocabulary: str = VOCABULARY,
    blank_runs: bool = False,
) -> DataFrame:
    """Columns ``keep`` (all by default) with n_tokens and log_score, the score of the segmentation.

    Null and empty texts have no token.  Special tokens are not added, and their names
    in a text are ordinary text.  With ``blank_runs`` the whole vocabulary is used, as by a
    tokenizer that does not cut texts at blanks.  Columns of ``docs`` named like a result are replaced.
    """
    small_batches(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_tokens", "log_score")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    schema += ", " * bool(schema) + "n_tokens long, log_score double"
    chosen = docs.select(*keep, F.col(text_col).cast("string").alias("_counted_text"))
    return chosen.mapInArrow(_tokens(vocabulary, blank_runs), schema)
