"""Quality by positive-unlabelled learning.

Trusted positives are rows labelled 1; the rest of the web text is unlabelled, a mixture
of good and bad.  The share of good text is estimated from how rarely the unlabelled
rows fall where positives do.  A linear model over style features is trained to the
least non-negative unbiased risk: the unlabelled risk less the positives' part of it,
which is never allowed below zero.

The fit uses ``POSITIVES`` and ``UNLABELLED`` rows, or all where there are fewer, picked by
a hash of their id and text; every row is scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .langid import fold
from .text import LOWER, pieces, small_batches, utf8, words
from .toxicity import BROADCAST_LABELS

POSITIVES, UNLABELLED = 20_000, 40_000
THRESHOLD = 0.7
_STEPS, _RATE, _DECAY = 600, 0.05, 1e-4

#: Byte classes: other, lower, upper, digit, blank, line end, sentence mark, quote or dash, symbol, above ASCII.
_KINDS = 10
_KIND = np.zeros(256, dtype=np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3
_KIND[[9, 32]], _KIND[[10, 11, 12, 13]] = 4, 5
_KIND[[ord(c) for c in ".,;:!?"]] = 6
_KIND[[ord(c) for c in "'\"-()"]] = 7
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 8
_KIND[128:] = 9
FEATURES = _KINDS * _KINDS + 7


def features(column: pa.Array) -> np.ndarray:
    """One row of style features per text: pairs of byte classes, words, repeats and lines."""
    raw, at = utf8(column)
    out = [np.zeros((0, FEATURES))]
    for first, last in pieces(at):
        own, bounds = raw[at[first] : at[last]], at[first : last + 1] - at[first]
        docs, size = last - first, np.diff(bounds)
        doc = np.repeat(np.arange(docs), size)
        kind = _KIND[own]
        pair = kind[:-1] * _KINDS + kind[1:]
        same = doc[:-1] == doc[1:]
        pairs = np.bincount((doc[:-1] * _KINDS**2 + pair)[same], minlength=docs * _KINDS**2).reshape(docs, -1)
        share = pairs / np.maximum(size - 1, 1)[:, None]
        low = LOWER[own]
        found = words(low, bounds)
        n = np.diff(found.bounds)
        length = np.bincount(
            np.repeat(np.arange(docs), n), weights=found.ends - found.starts, minlength=docs
        ) / np.maximum(n, 1)
        distinct = np.zeros(docs)
        common = np.zeros(docs)
        for d in np.flatnonzero(n):
            _, count = np.unique(found.hashes[found.bounds[d] : found.bounds[d + 1]], return_counts=True)
            distinct[d], common[d] = len(count) / n[d], count.max() / n[d]
        lines = np.bincount(doc[kind == 5], minlength=docs) + (size > 0)
        upper = np.bincount(
            np.repeat(np.arange(docs), n), weights=kind[found.starts] == 2, minlength=docs
        ) / np.maximum(n, 1)
        marks = np.bincount(
            np.repeat(np.arange(docs), n), weights=kind[found.ends - 1] == 6, minlength=docs
        ) / np.maximum(n, 1)
        rest = [np.log1p(n), length / 10, distinct, common, np.log1p(n / np.maximum(lines, 1)), upper, marks]
        out.append(np.column_stack([np.log1p(100 * share), *rest]))
    return np.vstack(out)


def _featured(batches):
    for batch in batches:
        table = features(batch.column(batch.num_columns - 1)).astype("<f8")
        yield pa.record_batch(
            [*batch.columns[:-1], pa.array([row.tobytes() for row in table], pa.binary())],
            names=[*batch.schema.names[:-1], "x"],
        )


def sample(rows: DataFrame, n: int) -> DataFrame:
    """(hash, x) of the ``n`` rows of (doc_id, text) with the least hashes, or of all where there are fewer.

    A threshold on the hash leaves a few more than ``n``; it rises while many rows share
    hashes above it.  Rows that share one are copies of each other.
    """
    rows = rows.select(F.xxhash64(F.lit("sample"), "doc_id", "text").alias("hash"), "text")
    total = rows.count()
    share = min(1.0, (n + 6 * n**0.5 + 100) / max(total, 1))
    chosen = rows
    while share < 1:
        chosen = rows.filter(F.col("hash") < int(share * 2**64) - 2**63)
        if chosen.count() >= n:
            break
        share, chosen = share * 4, rows
    return chosen.mapInArrow(_featured, "hash long, x binary").orderBy("hash", "x").limit(n)


def _matrix(rows: DataFrame) -> np.ndarray:
    got = rows.toArrow()["x"].to_pylist()
    return np.frombuffer(b"".join(got), dtype="<f8").reshape(-1, FEATURES)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.05) -> float:
    """Share of positives among the unlabelled, from scores of either.

    Where the score is above a bound, unlabelled rows hold at least the prior times the
    share of positives there.  The least ratio of the two shares, with their sampling
    errors added, bounds the prior (best-bin estimate).
    """
    bounds = np.quantile(positive, np.linspace(0.02, 0.98, 49))
    p = np.array([(positive >= b).mean() for b in bounds])
    u = np.array([(unlabelled >= b).mean() for b in bounds])
    slack = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    k = np.argmin((u + slack) / p)
    return float(np.clip(u[k] / p[k], 0.05, 0.99))


def _train(xp: np.ndarray, xu: np.ndarray, prior: float) -> np.ndarray:
    """Weights of least non-negative risk under the logistic loss, by Adam over all rows."""
    beta, m, v = np.zeros(xp.shape[1]), 0.0, 0.0
    for step in range(1, _STEPS + 1):
        gp, gu = _sigmoid(xp @ beta), _sigmoid(xu @ beta)
        negative = -np.log1p(-np.minimum(gu, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(gp, 1 - 1e-12)).mean()
        down = (xu.T @ gu) / len(xu) - prior * (xp.T @ gp) / len(xp)
        # Below zero the fit is to the sample: step back on that part only.
        slope = prior * (xp.T @ (gp - 1)) / len(xp) + down if negative >= 0 else -down
        slope = slope + _DECAY * np.append(beta[:-1], 0)
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        beta = beta - _RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return beta


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights (the last is the intercept)."""
    if not len(positive) or not len(unlabelled):
        return np.zeros(FEATURES), np.ones(FEATURES), np.append(np.zeros(FEATURES), 0.0 if not len(positive) else 2.0)
    centre, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 0.05
    xp, xu = (np.column_stack([np.clip((x - centre) / scale, -8, 8), np.ones(len(x))]) for x in (positive, unlabelled))
    # A first model tells positives from unlabelled; its scores give the prior.
    apart = _train(xp, xu, 0.5)
    return centre, scale, _train(xp, xu, class_prior(xp @ apart, xu @ apart))


def _score(model):
    def run(batches):
        centre, scale, beta = model.value
        for batch in batches:
            x = np.clip((features(batch.column(batch.num_columns - 1)) - centre) / scale, -8, 8)
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(_sigmoid(x @ beta[:-1] + beta[-1]))],
                names=[*batch.schema.names[:-1], "score"],
            )

    return run


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    parts: int = 4,
    held: int = 2,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Positives are rows of the other folds labelled 1 (and never 0); unlabelled are all
    rows of those folds, whatever their label, as web text is.  Null and empty texts have features of
    their own and are scored like others.  Labels of unknown ids and other values are
    ignored; without positives every score is 0.5.  Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (fold(F.col(id_col), parts) == held).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    good = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
    good = good.agg(F.min(F.col(label_col)).alias("_label")).filter("_label = 1").select("doc_id")
    if good.count() <= BROADCAST_LABELS:
        good = F.broadcast(good)
    learn = rows.filter("NOT held_out").select("doc_id", "text")

    model = docs.sparkSession.sparkContext.broadcast(
        fit(
            _matrix(sample(learn.join(good, "doc_id", "left_semi"), positives)), _matrix(sample(learn, unlabelled))
        )
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(_score(model), f"doc_id {id_type}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
