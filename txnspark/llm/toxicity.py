"""Toxicity by class-conditional Kneser-Ney models of word and character n-grams.

Words, with their letters, marks and digits as they are, are counted alone and in pairs; signs,
and characters of scripts without blanks, are words of their own.  Pairs have counts by class,
words the number of contexts they were seen in, by class too; these back off to contexts counted over
both classes.  Pairs seen once in all learning rows are left to the backoff, which gets their
share of the probability.  What a pair or a word adds to the difference of the two
log-likelihoods is one weight; the stored table of weights grows with the learning rows.  It is
sent to the tasks that read the texts while it has at most ``MODEL_BYTES``, and is joined by
each text's distinct n-grams beyond.

Beside them, letters are folded to an alphabet of 32 symbols, whose n-grams of order 4
are a closed set of about a million: obfuscated spellings share most of theirs with the
plain ones, though no word.  What the highest order discounts goes to continuation
counts shared by both classes.

Either gives a text's evidence, the difference of its two log-likelihoods per symbol,
where what a symbol says beyond ``CLEAR`` counts ``WEIGHT`` times more: a few clear words
in a long text are evidence, many faint differences are not.  A logistic curve, fitted on
labelled rows that the counts have not seen, turns both into a score.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.scratch import broadcast_if_small

from .chars import folded, lower_letters, texts_of, word_kinds
from .langid import fold
from .store import stored
from .text import mix, prefix_hashes, runs, small_batches, span_hashes

ORDER, BITS = 4, 5
CELLS = 1 << (ORDER * BITS)
CLEAR, WEIGHT = 2.0, 4.0
#: Labels (16 bytes each) that may be broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
#: The curve is fitted on a histogram of the evidence with so many bins.
BINS, SPAN = 2048, 4.0
#: Longest run of words that is counted, and occurrences below which a pair is left to the backoff.
WORDS, CUTOFF = 2, 2
#: Bytes of weights (12 each) that may be sent to every task.
MODEL_BYTES = 64 << 20
#: Code points of texts whose pairs are counted at once.
_PIECE = 1 << 19
_BEGIN, _END, _CHAIN = np.uint64(0x5BD1E995), np.uint64(0xC2B2AE35), np.uint64(0x9E3779B97F4A7C15)


def _cells(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all n-grams and their bounds by text; runs of other characters count as one gap."""
    symbols = folded()[points]
    keep = symbols > 0
    keep[1:] |= symbols[:-1] > 0
    at = np.flatnonzero(keep)
    cut = np.searchsorted(at, bounds)
    s, place = symbols[at].astype(np.int64), np.arange(len(at))
    place -= np.repeat(cut[:-1], np.diff(cut))
    cells = s.copy()
    for k in range(1, ORDER):
        cells[k:] |= np.where(place[k:] >= k, s[:-k] << (BITS * k), 0)
    return cells, cut


def _count(batches):
    total = np.zeros((2, CELLS), dtype=np.int64)
    for batch in batches:
        label = batch.column(1).to_numpy()
        for c in (0, 1):
            for _, points, bounds in texts_of(batch.column(0).take(pa.array(np.flatnonzero(label == c)))):
                cells, n = np.unique(_cells(points, bounds)[0], return_counts=True)
                total[c][cells] += n
    cells = np.flatnonzero(total.any(axis=0))
    for part in range(0, len(cells), 1 << 16):
        own = cells[part : part + (1 << 16)]
        yield pa.record_batch(
            [pa.array(own), pa.array(total[0][own]), pa.array(total[1][own])], names=["cell", "n0", "n1"]
        )


def _discount(counts: np.ndarray) -> float:
    ones, twos = (counts == 1).sum(), (counts == 2).sum()
    return float(ones / (ones + 2 * twos)) if ones and twos else 0.5


def _level(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Interpolated probabilities of one order: context by symbol, backing off to ``lower``."""
    table = counts.reshape(-1, 1 << BITS).astype(np.float64)
    total, types = table.sum(axis=1, keepdims=True), (table > 0).sum(axis=1, keepdims=True)
    d = _discount(counts)
    back = np.tile(lower, (table.shape[0] // lower.shape[0], 1))
    with np.errstate(invalid="ignore", divide="ignore"):
        out = np.maximum(table - d, 0) / total + d * types / total * back
    return np.where(total > 0, out, back)


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """log P(symbol | context, class 1) - log P(symbol | context, class 0), by cell, stretched beyond CLEAR."""
    lower = np.full((1, 1 << BITS), 1 / (1 << BITS))
    # Continuation counts: before how many symbols an n-gram of a lower order stands.
    kinds = [counts.sum(axis=0)]
    while len(kinds) < ORDER:
        kinds.append((kinds[-1].reshape(1 << BITS, -1) > 0).sum(axis=0))
    for shared in reversed(kinds[1:]):
        lower = _level(shared, lower)
    one, zero = (np.log(_level(counts[c], lower)) for c in (1, 0))
    ratio = (one - zero).ravel()
    return (ratio + WEIGHT * np.maximum(ratio - CLEAR, 0)).astype(np.float32)


def _grams(points: np.ndarray, bounds: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of the word and of the pair of words that end at each place, bounds of places by text, words by text.

    A text with words stands between ``WORDS`` - 1 marks of its beginning and one of its end.
    """
    kind = word_kinds()[points]
    low = lower_letters()[points]
    low = np.where(low > 0, low, points)
    starts, ends = runs(kind == 1, bounds)
    alone = np.flatnonzero(kind == 2)
    starts, ends = np.append(starts, alone), np.append(ends, alone + 1)
    order = np.argsort(starts)
    starts, ends = starts[order], ends[order]
    words = np.diff(np.searchsorted(starts, bounds))
    size = np.where(words > 0, words + WORDS, 0)
    cut = np.concatenate([[0], np.cumsum(size)])
    symbols = np.full(cut[-1], _BEGIN, dtype=np.uint64)
    symbols[np.arange(len(starts)) + np.repeat(cut[:-1] + WORDS - 1 - (np.cumsum(words) - words), words)] = span_hashes(
        prefix_hashes(low), starts, ends
    )
    symbols[cut[1:][words > 0] - 1] = _END
    word = mix(symbols)
    before = np.concatenate([np.zeros(1, np.uint64), word[:-1]])[: len(word)]
    grams = [word, _pair(before, word)]
    return grams, cut, words


def _count_words(batches):
    """(word, context, n0, n1): distinct pairs of a piece, by the hashes of both words, with counts by class."""
    for batch in batches:
        label = batch.column(1).to_numpy()
        for first, points, bounds in texts_of(batch.column(0), _PIECE):
            (word, pair), cut, words = _grams(points, bounds)
            place = np.arange(cut[-1]) - np.repeat(cut[:-1], np.diff(cut))
            at = np.flatnonzero(place >= 1)
            one = np.repeat(label[first : first + len(words)] == 1, np.diff(cut))[at]
            _, where, group = np.unique(pair[at], return_index=True, return_inverse=True)
            ones, every = np.bincount(group, weights=one, minlength=len(where)), np.bincount(group, minlength=len(where))
            at = at[where]
            counts = [(every - ones).astype(np.int32), ones.astype(np.int32)]
            yield pa.record_batch(
                [pa.array(word[at].view(np.int64)), pa.array(word[at - 1].view(np.int64)), *map(pa.array, counts)],
                names=["word", "context", "n0", "n1"],
            )


def _pair_keys(batches):
    """The hash of each pair, as texts have it, in front of its weight."""
    for batch in batches:
        word, context = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
        yield pa.record_batch([pa.array(_pair(context, word).view(np.int64)), batch.column(2)], names=["key", "weight"])


def _pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * _CHAIN + word)


def _steep(x):
    return x + WEIGHT * F.greatest(x - CLEAR, F.lit(0.0))


def _discounts(row) -> list[float]:
    """What is taken from each count of either class, by how many counts are 1 and 2."""
    out = []
    for c in (0, 1):
        ones, twos = row[f"one{c}"] or 0, row[f"two{c}"] or 0
        out.append(ones / (ones + 2 * twos) if ones and twos else 0.5)
    return out


def word_weights(rows: DataFrame) -> DataFrame:
    """Stored (key, weight) of words and pairs in rows (text, _label): what an occurrence adds to a text's evidence.

    An unseen pair is worth what its context and its word say, so the weight of a seen one is
    its own log-ratio less these, and a word's is more by what it says as the context of the next.
    """
    raw = rows.select("text", "_label").mapInArrow(_count_words, "word long, context long, n0 int, n1 int")
    pairs = raw.groupBy("word", "context").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    # Three readings of one shuffle, written together: pairs are too many to be stored.
    few = F.col("n0") + F.col("n1") < CUTOFF
    number = lambda x: F.sum(x.cast("long"))
    contexts = pairs.groupBy("context").agg(
        *[F.sum(f"n{c}").alias(f"n{c}") for c in (0, 1)],
        *[number(F.col(f"n{c}") > 0).alias(f"types{c}") for c in (0, 1)],
        *[number(few & (F.col(f"n{c}") > 0)).alias(f"left{c}") for c in (0, 1)],
        *[number(F.col(f"n{c}") == n).alias(f"{name}{c}") for c in (0, 1) for n, name in ((1, "one"), (2, "two"))],
    )
    words = pairs.groupBy("word").agg(*[number(F.col(f"n{c}") > 0).alias(f"n{c}") for c in (0, 1)], F.count(F.lit(1)).alias("types0"))
    every = words.withColumn("kind", F.lit(1)).unionByName(contexts.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    every = stored(every.unionByName(pairs.filter(~few).withColumn("kind", F.lit(3)), allowMissingColumns=True), "counts")

    words = every.filter("kind = 1").select("word", "n0", "n1", F.col("types0").alias("both"))
    told = words.agg(
        *[F.coalesce(F.sum(f"n{c}"), F.lit(0)).alias(f"all{c}") for c in (0, 1)],
        *[number(F.col(f"n{c}") > 0).alias(f"types{c}") for c in (0, 1)],
        *[number(F.col(f"n{c}") == n).alias(f"{name}{c}") for c in (0, 1) for n, name in ((1, "one"), (2, "two"))],
        F.coalesce(F.sum("both"), F.lit(0)).alias("all"),
    ).first()
    d = _discounts(told)
    left = [d[c] * (told[f"types{c}"] or 0) / told[f"all{c}"] if told[f"all{c}"] else 1.0 for c in (0, 1)]
    shared = F.col("both") / F.lit(float(told["all"] or 1))
    low = [F.greatest(F.col(f"n{c}") - d[c], F.lit(0.0)) / float(told[f"all{c}"] or 1) + left[c] * shared for c in (0, 1)]
    words = words.select("word", *[x.alias(f"p{c}") for c, x in enumerate(low)])
    words = stored(words.withColumn("low", _steep(F.log("p1") - F.log("p0"))), "words")

    contexts = every.filter("kind = 2")
    d2 = _discounts(contexts.agg(*[F.sum(f"{n}{c}").alias(f"{n}{c}") for n in ("one", "two") for c in (0, 1)]).first())
    rest = [
        F.when(F.col(f"n{c}") > 0, (d2[c] * (F.col(f"types{c}") - F.col(f"left{c}")) + F.col(f"left{c}")) / F.greatest(f"n{c}", F.lit(1)))
        .otherwise(1.0)
        .alias(f"rest{c}")
        for c in (0, 1)
    ]
    contexts = contexts.select("context", *rest, *[F.col(f"n{c}").alias(f"of{c}") for c in (0, 1)])
    contexts = stored(contexts.withColumn("back", F.log("rest1") - F.log("rest0")), "contexts")

    kept = every.filter("kind = 3").select("word", "context", "n0", "n1")
    kept = kept.join(broadcast_if_small(contexts), "context").join(broadcast_if_small(words), "word")
    seen = [
        F.greatest(F.col(f"n{c}") - d2[c], F.lit(0.0)) / F.greatest(f"of{c}", F.lit(1)) + F.col(f"rest{c}") * F.col(f"p{c}") for c in (0, 1)
    ]
    value = _steep(F.log(seen[1]) - F.log(seen[0])) - F.col("back") - F.col("low")
    kept = kept.select("word", "context", value.alias("weight")).mapInArrow(_pair_keys, "key long, weight double")
    base = math.log(left[1]) - math.log(left[0]) if min(left) > 0 else 0.0
    single = words.select(F.col("word").alias("key"), (F.col("low") - base).alias("weight"))
    single = single.unionByName(contexts.select(F.col("context").alias("key"), F.col("back").alias("weight")))
    single = single.groupBy("key").agg(F.sum("weight").alias("weight"))
    return stored(single.unionByName(kept), "weights")


def _sent(spark, weights: DataFrame):
    """The table of weights as a broadcast of sorted keys and weights, or None if it is too large."""
    if weights.count() * 12 > MODEL_BYTES:
        return None
    got = weights.toArrow()
    keys = got["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return spark.sparkContext.broadcast((keys[order], got["weight"].to_numpy()[order].astype(np.float32)))


def _summed(model: tuple[np.ndarray, np.ndarray], points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the weights of each text's words and pairs, and its number of words."""
    keys, weights = model
    grams, cut, words = _grams(points, bounds)
    text = np.repeat(np.arange(len(words)), np.diff(cut))
    place = np.arange(cut[-1]) - cut[text]
    total = np.zeros(len(words))
    for k, gram in enumerate(grams):
        at = np.flatnonzero(place >= k)
        if not len(at) or not len(keys):
            continue
        own, group = np.unique(gram[at], return_inverse=True)
        where = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        value = np.where(keys[where] == own, weights[where], 0.0)
        total += np.bincount(text[at], weights=value[group], minlength=len(words))
    return total, words


def _text_grams(batches):
    """(text key, n-gram, occurrences) of each text's distinct n-grams, those of its beginning among them."""
    for batch in batches:
        names = batch.column(0).to_numpy()
        for first, points, bounds in texts_of(batch.column(1)):
            grams, cut, words = _grams(points, bounds)
            text = np.repeat(np.arange(len(words)), np.diff(cut))
            place = np.arange(cut[-1]) - cut[text]
            # The mark of the beginning is a context.
            at = [np.flatnonzero(place >= k) for k in range(WORDS)]
            keys, text = np.concatenate([g[a] for g, a in zip(grams, at)]), np.concatenate([text[a] for a in at])
            order = np.lexsort((keys, text))
            keys, text = keys[order], text[order]
            new = np.ones(len(keys), dtype=bool)
            new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
            new = np.flatnonzero(new)
            n = np.diff(np.append(new, len(keys))).astype(np.int32)
            yield pa.record_batch(
                [pa.array(names[first + text[new]]), pa.array(keys[new].view(np.int64)), pa.array(n)],
                names=["digest", "key", "n"],
            )


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``docs`` with their 0/1 label as ``_label``, or null; an id labelled twice counts as 1 if any label is."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_lid")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return docs.join(known, docs[id_col] == known["_lid"], "left").drop("_lid")


def _evidence(ratios, model):
    """Evidence of the characters per symbol, sum of the words' weights (if sent) and number of words, in place of the last column."""

    def run(batches):
        table = ratios.value
        for batch in batches:
            for first, points, bounds in texts_of(batch.column(batch.num_columns - 1)):
                cells, cut = _cells(points, bounds)
                sums = np.concatenate([[0.0], np.cumsum(table[cells], dtype=np.float64)])
                size = np.diff(cut)
                value = (sums[cut[1:]] - sums[cut[:-1]]) / np.maximum(size, 1)
                total, words = _summed(model.value, points, bounds) if model else (np.zeros(len(size)), _grams(points, bounds)[2])
                yield pa.record_batch(
                    [*[c.slice(first, len(size)) for c in batch.columns[:-1]], pa.array(value), pa.array(total), pa.array(words)],
                    names=[*batch.schema.names[:-1], "letters", "total", "words"],
                )

    return run


def logistic_curve(x: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> tuple[float, ...]:
    """Slopes and intercept that fit the share of ones at each row of x, by Newton steps."""
    if not ones.sum() or not zeros.sum():
        return (0.0,) * (x.shape[1] + 1)
    design, weight = np.column_stack([x, np.ones(len(x))]), ones + zeros
    beta = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (ones - weight * p) - 1e-3 * beta
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(len(beta))
        step = np.linalg.solve(bend, slope)
        beta += step / max(1.0, np.abs(step).max() / 50)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def letter_ratios(rows: DataFrame) -> np.ndarray:
    """Log-ratios of the folded character n-grams, counted in rows (text, _label)."""
    counted = rows.select("text", "_label").mapInArrow(_count, "cell long, n0 long, n1 long")
    got = counted.groupBy("cell").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    counts = np.zeros((2, CELLS), dtype=np.int64)
    counts[0][got["cell"].to_numpy()] = got["n0"].to_numpy()
    counts[1][got["cell"].to_numpy()] = got["n1"].to_numpy()
    return log_ratios(counts)


def fit_curve(rows: DataFrame) -> tuple[float, ...]:
    """The curve of rows (letters, worded, _label), from a histogram of both evidences."""
    bins = [
        F.floor((F.least(F.greatest(c, F.lit(-SPAN)), F.lit(SPAN)) + SPAN) * (BINS / (2 * SPAN))).alias(c)
        for c in ("letters", "worded")
    ]
    got = rows.groupBy(*bins).agg(F.sum("_label").alias("ones"), F.sum(1 - F.col("_label")).alias("zeros")).toArrow()
    x = np.column_stack([(got[c].to_numpy() + 0.5) * (2 * SPAN / BINS) - SPAN for c in ("letters", "worded")])
    return logistic_curve(x, *(got[c].to_numpy().astype(float) for c in ("ones", "zeros")))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    parts: int = 5,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Only labels of rows whose fold is not 0 are learned from; of those, fold 1 fits the
    curve and the others are counted.  Null and empty texts have evidence 0 and
    get the score of the curve there.  Labels other than 0 and 1 and labels of unknown
    ids are ignored; without both labels every score is 0.5.  Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        fold(F.col(id_col), parts).alias("_part"),
        F.xxhash64(F.lit("text"), F.coalesce(text, F.lit(""))).alias("digest"),
        text.alias("text"),
    )
    known = labelled(rows, labels.withColumnRenamed(id_col, "doc_id"), "doc_id", label_col)
    known = known.withColumn("_label", F.when(F.col("_part") != 0, F.col("_label")))
    counted = known.filter("_part > 1 AND _label IS NOT NULL")
    shared = spark.sparkContext.broadcast(letter_ratios(counted))
    weights = word_weights(counted)
    model = _sent(spark, weights)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, _part long, digest long, _label int, letters double, total double, words long"
    texts = known.select("doc_id", "_part", "digest", "_label", "text")
    seen = stored(texts.mapInArrow(_evidence(shared, model), schema), "evidence")
    if model is None:
        # Equal texts share their sums: each copy adds as much to the evidence as to the words it is divided by.
        grams = rows.select("digest", "text").mapInArrow(_text_grams, "digest long, key long, n int")
        worded = grams.join(weights, "key").groupBy("digest").agg(F.sum(F.col("n") * F.col("weight")).alias("sum"))
        sizes = seen.groupBy("digest").agg(F.sum(F.col("words") + 1).alias("size"))
        worded = worded.join(sizes, "digest").select("digest", (F.col("sum") / F.col("size")).alias("worded"))
        seen = stored(seen.join(worded, "digest", "left").fillna(0.0, ["worded"]), "evidence")
    else:
        seen = seen.withColumn("worded", F.col("total") / (F.col("words") + 1))
    curve = fit_curve(seen.filter("_part = 1 AND _label IS NOT NULL"))
    power = curve[0] * F.col("letters") + curve[1] * F.col("worded") + curve[2]
    scored = seen.select(
        "doc_id",
        (F.col("_part") == 0).alias("held_out"),
        (1 / (1 + F.exp(-F.least(F.greatest(power, F.lit(-500.0)), F.lit(500.0))))).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
