"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every learning row is counted, in a matrix of languages by ``SLOTS`` hashed n-grams
that each task sums up and Spark adds.  The log-probability matrix, whose size is
checked, is broadcast; batches are scored sparsely, by gathering the rows of the
matrix at the n-grams that occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chars import lower_letters, texts_of
from .text import small_batches

SLOTS = 1 << 15
SIZES = (1, 2, 3)
UNKNOWN = "und"
#: Bytes that the matrix may take; about 2,000 languages.
MODEL_BYTES = 256 << 20
_FACTORS = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def _grams(points: np.ndarray):
    """For each n-gram size: where n-grams of letters start, their slots."""
    low = lower_letters()[points]
    for n in SIZES:
        part = [low[k : len(low) - n + 1 + k] for k in range(n)]
        keep = part[0] > 0 if n == 1 else (part[0] > 0) | (part[-1] > 0)
        for inner in part[1:-1]:
            keep &= inner > 0
        at = np.flatnonzero(keep)
        mixed = np.full(len(at), n * 40503, dtype=np.uint32)
        for k, values in enumerate(part):
            mixed = (mixed ^ values[at]) * _FACTORS[k]
        yield at, mixed >> np.uint32(32 - SLOTS.bit_length() + 1)


def _count(batches):
    seen: dict[str, np.ndarray] = {}
    texts: dict[str, int] = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for lang in set(langs):
            rows = pa.array([k for k, x in enumerate(langs) if x == lang], pa.int64())
            total = seen.setdefault(lang, np.zeros(SLOTS, dtype=np.int64))
            texts[lang] = texts.get(lang, 0) + len(rows)
            for _, points, _ in texts_of(batch.column(0).take(rows)):
                for _, slots in _grams(points):
                    total += np.bincount(slots, minlength=SLOTS)
    for lang, total in seen.items():
        slots = np.flatnonzero(total)
        yield pa.record_batch(
            [
                pa.array([lang] * (len(slots) + 1), pa.string()),
                pa.array(np.append(slots, -1)),
                pa.array(np.append(total[slots], texts[lang])),
            ],
            names=["lang", "slot", "n"],
        )


def fit(rows: DataFrame, text_col: str, lang_col: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log-probabilities (slot by language) and log-priors, from all ``rows``."""
    small_batches(rows.sparkSession)
    rows = rows.filter(F.col(lang_col).isNotNull()).select(F.col(text_col), F.col(lang_col).cast("string"))
    counted = rows.mapInArrow(_count, "lang string, slot long, n long").groupBy("lang", "slot").agg(
        F.sum("n").alias("n")
    )
    langs = sorted(r[0] for r in rows.select(lang_col).distinct().limit(MODEL_BYTES // (4 * SLOTS) + 1).collect())
    if 4 * SLOTS * len(langs) > MODEL_BYTES:
        raise ValueError(f"the matrix for so many languages takes more than {MODEL_BYTES} bytes")
    counts, texts = np.zeros((SLOTS, len(langs))), np.ones(len(langs))
    got = counted.toArrow()
    place = {x: k for k, x in enumerate(langs)}
    column = np.array([place[x] for x in got["lang"].to_pylist()], dtype=np.int64)
    slot, n = got["slot"].to_numpy(), got["n"].to_numpy()
    counts[slot[slot >= 0], column[slot >= 0]] = n[slot >= 0]
    texts[column[slot < 0]] = n[slot < 0]
    smoothed = counts + 0.5
    return langs, np.log(smoothed / smoothed.sum(axis=0)).astype(np.float32), np.log(texts / texts.sum())


def _predict(model, text: int, width: int):
    """Appends the prediction for column ``text`` to the first ``width`` columns."""

    def run(batches):
        langs, logs, prior = model.value
        for batch in batches:
            for first, points, bounds in texts_of(batch.column(text)):
                docs = len(bounds) - 1
                total, grams = np.zeros((docs, len(langs))), np.zeros(docs)
                for at, slots in _grams(points):
                    if not len(at) or not langs:
                        continue
                    cut = np.searchsorted(at, bounds)
                    grams += np.diff(cut)
                    sums = np.vstack([np.zeros(len(langs)), np.cumsum(logs[slots], axis=0, dtype=np.float64)])
                    total += sums[cut[1:]] - sums[cut[:-1]]
                # The sizes overlap, so each letter is counted once for each of them.
                total = total / len(SIZES) + prior
                best = total.argmax(axis=1) if langs else np.zeros(docs, dtype=int)
                known = grams > 0 if langs else np.zeros(docs, dtype=bool)
                score = np.zeros(docs)
                if langs:
                    score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                rest = [c.slice(first, docs) for c in batch.columns[:width]]
                yield pa.record_batch(
                    [
                        *rest,
                        pa.array([langs[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                        pa.array(np.where(known, score, 0.0)),
                    ],
                    names=[*batch.schema.names[:width], "lang_pred", "score"],
                )

    return run


def identify(
    docs: DataFrame,
    model: tuple[list[str], np.ndarray, np.ndarray],
    *,
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Columns ``keep`` (all by default) with lang_pred and score.

    Texts that are null, empty or without a letter get ``und`` with score 0, and so
    does every text when nothing was learned.  Ties go to the first language by code
    point.  Columns named lang_pred or score in ``docs`` are replaced.
    """
    small_batches(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    at, extra = len(keep), [F.col(text_col).cast("string").alias("_scored_text")]
    if text_col in keep and docs.schema[text_col].dataType.simpleString() == "string":
        at, extra = keep.index(text_col), []
    chosen = docs.select(*keep, *extra)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    value = docs.sparkSession.sparkContext.broadcast(model)
    schema += ", " * bool(schema) + "lang_pred string, score double"
    return chosen.mapInArrow(_predict(value, at, len(keep)), schema)


def identify_held_out(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", parts: int = 5
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from the rows that are not held out."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (fold(F.col(id_col), parts) == 0).alias("held_out"),
        F.col(lang_col).alias("lang"),
        F.col(text_col).alias("text"),
    )
    model = fit(rows.filter("NOT held_out"), "text", "lang")
    return identify(rows, model, keep=["doc_id", "held_out"])
