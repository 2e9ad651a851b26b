"""Phrase collocations by vertical partitioning of word suffixes.

A suffix is a word and the words after it in its piece of text, cut off at ``DEPTH``.  Words are
prefixes of suffixes; prefixes are dealt to groups, enough of them that a group's suffixes fit a
memory budget.  A prefix with more suffixes than that is extended by its next word, and once more,
so that no word, however common, is one group's work.  Every group builds the tree of its suffixes
on its own, from leaves that were counted before the shuffle, and reads the count of each phrase
from the totals of the leaves below it.

Words stand as 64-bit hashes of language and word until phrases are written out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.scratch import broadcast_if_small, materialize

from .keyed import lookup
from .store import stored
from .text import LOWER, mix, pieces, prefix_hashes, runs, small_batches, span_hashes, utf8

DEPTH = 3
#: Suffixes of one group, and suffixes that a task counts before it sends them on.
BUDGET, COUNTED = 2_000_000, 500_000
#: Groups for each shuffle partition at least, so that all tasks get some.
GROUPS = 4
LEAST, SHARE, TOP = 10, 50, 2000
UNKNOWN = "und"
#: Leaves in one shuffled row: 500 rows fit a worker.
_ROW_LEAVES = 1_024
_PIECE = 1 << 19

_CUT = np.zeros(256, dtype=bool)
_CUT[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_GAP = _CUT.copy()
_GAP[[0x20, 0x09]] = True


def _salts(langs: pa.Array) -> np.ndarray:
    """A number for each row's language; of no language, that of ``UNKNOWN``."""
    names = langs.dictionary_encode()
    known = [UNKNOWN if v is None else v for v in names.dictionary.to_pylist()] + [UNKNOWN]
    numbers = [int.from_bytes(hashlib.blake2b(v.encode(), digest_size=8).digest(), "little") for v in known]
    at = names.indices.fill_null(len(known) - 1).to_numpy(zero_copy_only=False)
    return np.array(numbers, dtype=np.uint64)[at]


def _words(texts: pa.Array, langs: pa.Array) -> Iterator[tuple]:
    """For pieces of the rows: keys of words, number of the piece of text each is in, row, bytes, starts and ends."""
    raw, at = utf8(texts)
    salts = _salts(langs)
    for first, last in pieces(at, _PIECE):
        low, cut = LOWER[raw[at[first] : at[last]]], at[first : last + 1] - at[first]
        starts, ends = runs(~_GAP[low], cut)
        row = np.searchsorted(cut, starts, side="right") - 1
        keys = mix(span_hashes(prefix_hashes(low), starts, ends) ^ salts[first + row])
        breaks = np.zeros(len(low) + 1, dtype=np.int64)
        breaks[:-1] = _CUT[low]
        np.add.at(breaks, cut[:-1], 1)
        yield np.maximum(keys, np.uint64(1)), np.cumsum(breaks)[starts], first + row, low, starts, ends


def _count_words(batches):
    """(lang, word, key, n) of the distinct words of some texts."""
    for batch in batches:
        langs = batch.column(1)
        for keys, _, row, low, starts, ends in _words(batch.column(0), langs):
            found, at, n = np.unique(keys, return_index=True, return_counts=True)
            raw = low.tobytes()
            words = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            yield pa.record_batch(
                [langs.take(pa.array(row[at])).fill_null(UNKNOWN), pa.array(words, pa.string()),
                 pa.array(found.view(np.int64)), pa.array(n)],
                names=["lang", "word", "key", "n"],
            )


def _counted(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows in order, the first column first, with the sums of their counts."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(fresh)
    return [c[at] for c in columns], np.add.reduceat(counts[order], at) if len(at) else counts


def _suffixes(keys: np.ndarray, piece: np.ndarray) -> list[np.ndarray]:
    """The words of each suffix; 0 after the end of its piece of text."""
    out = [keys]
    for k in range(1, DEPTH):
        own = np.zeros_like(keys)
        if len(keys) > k:
            own[:-k] = np.where(piece[:-k] == piece[k:], keys[k:], np.uint64(0))
        out.append(own)
    return out


def _chunks(batches, budget: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Counted suffixes of about ``budget`` words at a time."""
    held, n = [], 0

    def count():
        columns = [np.concatenate(c) for c in zip(*held)]
        return _counted(columns, np.ones(len(columns[0]), dtype=np.int64))

    for batch in batches:
        for keys, piece, *_ in _words(batch.column(0), batch.column(1)):
            held.append(_suffixes(keys, piece))
            n += len(keys)
            if n >= budget:
                yield count()
                held, n = [], 0
    if n:
        yield count()


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first + mix(second))


def _count_extended(hot, budget):
    """(k1, k2, n): counts of two words in a row whose first is a prefix to extend."""

    def run(batches):
        for (first, second, _), counts in _chunks(batches, min(budget, COUNTED)):
            keep = np.isin(first, hot.value) & (second > 0)
            (first, second), counts = _counted([first[keep], second[keep]], counts[keep])
            yield pa.record_batch(
                [pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), pa.array(counts)], names=["k1", "k2", "n"]
            )

    return run


def _deal(plan, groups, budget):
    """(grp, leaves): counted suffixes in rows of one group each."""

    def run(batches):
        words, pairs = plan.value
        for (a, b, c), counts in _chunks(batches, min(budget, COUNTED)):
            prefix = a.copy()
            more = np.isin(a, words)
            prefix[more] = _pair(a[more], b[more])
            more[more] = np.isin(prefix[more], pairs)
            prefix[more] = _pair(prefix[more], c[more])
            group = (mix(prefix) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")  # leaves stay in order inside a group
            group, a, b, c, counts = (x[order] for x in (group, a, b, c, counts))
            bounds = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
            numbers, leaves = [], []
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                for k in range(start, end, _ROW_LEAVES):
                    part = slice(k, min(k + _ROW_LEAVES, end))
                    numbers.append(group[start])
                    leaves.append(b"".join(x[part].tobytes() for x in (a, b, c, counts)))
                if len(leaves) >= 256:
                    yield pa.record_batch([pa.array(numbers, pa.int64()), pa.array(leaves, pa.binary())], names=["grp", "leaves"])
                    numbers, leaves = [], []
            if leaves:
                yield pa.record_batch([pa.array(numbers, pa.int64()), pa.array(leaves, pa.binary())], names=["grp", "leaves"])

    return run


def _phrases(columns, counts, pairs, least):
    """Phrases of one group's tree that occur ``least`` times, as a batch (k1, k2, k3, a); k3 is 0 for two words."""
    a, b, c = columns
    full = (c > 0) & (counts >= least)
    (pa1, pb1), total = _counted([a[b > 0], b[b > 0]], counts[b > 0])
    keep = (total >= least) & ~np.isin(_pair(pa1, pb1), pairs)  # of the extended ones, this group has a part
    out = [np.concatenate(x) for x in ((a[full], pa1[keep]), (b[full], pb1[keep]), (c[full], np.zeros(keep.sum(), np.uint64)))]
    return pa.record_batch(
        [*[pa.array(x.view(np.int64)) for x in out], pa.array(np.concatenate([counts[full], total[keep]]))],
        names=["k1", "k2", "k3", "a"],
    )


def _build(plan, least, budget):
    """The tree of each group; rows come sorted by group."""

    def run(batches):
        pairs = plan.value[1]
        group, held, n = None, [], 0

        def total():
            parts = [np.concatenate(x) for x in zip(*held)]
            return _counted(parts[:DEPTH], parts[DEPTH].view(np.int64))

        for batch in batches:
            for number, leaves in zip(batch.column(0).to_pylist(), batch.column(1)):
                if number != group:
                    if held:
                        yield _phrases(*total(), pairs, least)
                    group, held, n = number, [], 0
                own = np.frombuffer(leaves.as_buffer(), dtype=np.uint64).reshape(DEPTH + 1, -1)
                held.append(own)
                n += own.shape[1]
                if n > 2 * budget:  # as many leaves again as the budget: add up those that are equal
                    columns, counts = total()
                    held, n = [[*columns, counts.view(np.uint64)]], min(len(counts), budget)
        if held:
            yield _phrases(*total(), pairs, least)

    return run


def count_words(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Stored (lang, word, key, n) of all words."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    found = rows.mapInArrow(_count_words, "lang string, word string, key long, n long")
    return stored(found.groupBy("lang", "word", "key").agg(F.sum("n").alias("n")), "words")


def count_phrases(
    docs: DataFrame, words: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, budget: int = BUDGET
) -> tuple[DataFrame, int]:
    """Stored (k1, k2, k3, a) of all phrases of two words (k3 is 0) or three that occur ``least`` times, and their number."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    total = words.agg(F.sum("n")).first()[0] or 0
    # Prefixes above the budget are at most total / budget, as many as there are groups.
    hot = np.array([r.key for r in words.filter(F.col("n") > budget).select("key").collect()], dtype=np.int64).view(np.uint64)
    pairs, extended = np.zeros(0, dtype=np.uint64), None
    if len(hot):
        second = rows.mapInArrow(_count_extended(spark.sparkContext.broadcast(hot), budget), "k1 long, k2 long, n long")
        extended = stored(second.groupBy("k1", "k2").agg(F.sum("n").alias("a")).filter(F.col("a") > budget), "extended")
        found = extended.collect()
        pairs = _pair(*[np.array([r[k] for r in found], dtype=np.int64).view(np.uint64) for k in ("k1", "k2")])
    plan = spark.sparkContext.broadcast((hot, pairs))
    groups = max(-(-total // budget), GROUPS * int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.mapInArrow(_deal(plan, groups, budget), "grp long, leaves binary")
    sorted_ = dealt.repartition("grp").sortWithinPartitions("grp")
    phrases = sorted_.mapInArrow(_build(plan, least, budget), "k1 long, k2 long, k3 long, a long")
    if extended is not None:
        long = extended.filter(F.col("a") >= least).select("k1", "k2", F.lit(0).cast("long").alias("k3"), "a")
        phrases = phrases.unionByName(long)
    return materialize(phrases, "phrases")


def collocations(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    share: int = SHARE,
    top: int = TOP,
    budget: int = BUDGET,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase is two or three words in a row, in lower case, inside a piece between marks or line
    ends, that occurs ``least`` times.  Its score is floor(1000000 a a / (l r)) for the cut into
    two parts, of l and r occurrences, that makes it least; of equal cuts, the first.  Phrases of
    two words of which ``share`` per cent of the occurrences lie in one phrase of three are left out.

    Null and empty texts have no words; a null language is ``und``.  Repeated texts count as often
    as they come, a very long text is worked through whole, and ties of score and count go by the
    phrase's bytes.  No texts give no rows.  Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    words = count_words(docs, text_col=text_col, lang_col=lang_col)
    found, n = count_phrases(docs, words, text_col=text_col, lang_col=lang_col, least=least, budget=budget)
    common = words.filter(F.col("n") >= least)
    for k in (1, 2, 3):
        own = common.select(F.col("key").alias(f"k{k}"), F.col("word").alias(f"w{k}"), F.col("n").alias(f"n{k}"), F.col("lang").alias(f"g{k}"))
        found = stored(lookup(found, own if k == 1 else own.drop(f"g{k}"), [f"k{k}"], n), "phrases")
    two, three = found.filter("k3 = 0"), found.filter("k3 <> 0")
    pairs = two.select("k1", "k2", "a")
    three = stored(lookup(three, pairs.withColumnRenamed("a", "f12"), ["k1", "k2"], n), "phrases")
    three = lookup(three, pairs.select(F.col("k1").alias("k2"), F.col("k2").alias("k3"), F.col("a").alias("f23")), ["k2", "k3"], n)

    held = three.select("k1", "k2", "a").union(three.select("k2", "k3", "a")).groupBy("k1", "k2").agg(F.max("a").alias("most"))
    two = two.join(held, ["k1", "k2"], "left").filter(f"most IS NULL OR 100 * most < {int(share)} * a")
    d = "CAST({} AS DECIMAL(15, 0))".format
    score = "1000000 * {0} * {0} div ({1} * {2})"
    two = two.selectExpr(
        "g1 AS lang", "concat_ws(' ', w1, w2) AS phrase", "a", "n1 AS l", "n2 AS r", f"{score.format(d('a'), d('n1'), d('n2'))} AS score"
    )
    three = three.selectExpr("*", f"{score.format(d('a'), d('n1'), d('f23'))} AS s1", f"{score.format(d('a'), d('f12'), d('n3'))} AS s2")
    three = three.selectExpr(
        "g1 AS lang", "concat_ws(' ', w1, w2, w3) AS phrase", "a",
        "if(s1 <= s2, n1, f12) AS l", "if(s1 <= s2, f23, n3) AS r", "least(s1, s2) AS score",
    )
    scored = two.unionByName(three).selectExpr(
        "*", "row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank"
    ).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    out = scored.join(broadcast_if_small(stored(totals, "totals")), "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '{UNKNOWN}') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT id, lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece, generate_subscripts(string_split_regex(text, '[.,;:!?\x0A-\x0D]'), 1) AS k FROM d),
w AS (SELECT id, lang, k, unnest(regexp_extract_all(piece, '[^\x20\x09]+')) AS word, generate_subscripts(regexp_extract_all(piece, '[^\x20\x09]+'), 1) AS i FROM p),
s AS MATERIALIZED (SELECT lang, word AS w1, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY id, k ORDER BY i)),
f1 AS MATERIALIZED (SELECT lang, w1, count(*) AS f FROM s GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS f FROM s WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
f3 AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*) AS f FROM s WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
c2 AS (SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, x.f AS l, y.f AS r
       FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
       WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.w1 = f2.w1 AND f3.w2 = f2.w2 AND 100 * f3.f >= {SHARE} * f2.f)
         AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.w2 = f2.w1 AND f3.w3 = f2.w2 AND 100 * f3.f >= {SHARE} * f2.f)),
c3 AS (SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.f AS a, x.f AS l1, y.f AS r1, u.f AS l2, v.f AS r2,
              1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS s1, 1000000::HUGEINT * a * a // (u.f::HUGEINT * v.f) AS s2
       FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
       JOIN f2 u ON u.lang = f3.lang AND u.w1 = f3.w1 AND u.w2 = f3.w2 JOIN f1 v ON v.lang = f3.lang AND v.w1 = f3.w3),
c AS (SELECT lang, phrase, a, l, r, 1000000::HUGEINT * a * a // (l::HUGEINT * r) AS score FROM c2
      UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM c3),
n AS (SELECT lang, count(*) AS n FROM s GROUP BY lang),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM c)
SELECT k.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM k JOIN n ON n.lang = k.lang WHERE rank <= {TOP}
"""
