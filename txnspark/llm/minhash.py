"""MinHash near-duplicates with sequential Bayesian verification.

1. Every text becomes its set of word shingles; texts with equal sets are one class.
2. Classes get a MinHash signature, whose first part is cut into bands.  Classes that
   agree in a band share a bucket.  First, a bucket's members are compared with its least
   and greatest member only; that puts most groups of copies into one component.
3. Of each bucket whose members are then in several components, the largest component
   gathers all members of its buckets.  Members outside it are dealt into chunks, and all
   members stream past each chunk; no pairs are listed.  Buckets with more than ``LARGE``
   members outside are cut by a further band beforehand, up to ``DEPTH`` bands.
4. Pairs are screened by their signatures, read in batches: a pair is dropped as soon
   as the posterior probability that its similarity reaches the bound falls below
   ``miss``.  Survivors are confirmed on the full shingle sets, and confirmed links give
   the components.

Two texts of similarity 0.8 share none of the 32 bands of 4 with a probability of
5e-8; that, 1e-5 for fewer than ``DEPTH`` shared bands in large buckets, and ``miss``
are the only ways to lose a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.scratch import materialize

from .graph import components
from .store import few, stored
from .text import mix, shingle_sets, small_batches

BANDS, ROWS = 32, 4
#: Hashes of a signature; bands use the first 128.
HASHES = 256
MISS = 1e-5
#: Members outside the largest component from which a bucket is cut by a further band,
#: and bands that may be combined so.
LARGE, DEPTH = 4096, 3
#: Members outside it that the others stream past at a time.
MINORS = 64
#: Texts compared with one copy of a pivot's text.
CHUNK = 64
#: Ids of 8 bytes that may be broadcast to pick texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Shingles hashed at once, so that the working set stays in cache.
_TILE = 1 << 15

_SEEDS = mix(np.arange(1, 4097, dtype=np.uint64)) | np.uint64(1)


def _fingerprint(width: int, hashes: int):
    factors = _SEEDS[:hashes]

    def signatures(sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(sets), hashes), dtype="<u2")
        sizes = np.array([len(s) for s in sets])
        full = np.flatnonzero(sizes)
        if not len(full):
            return out
        values = np.concatenate([sets[k] for k in full])
        bounds = np.concatenate([[0], np.cumsum(sizes[full])])
        first = 0
        while first < len(full):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + _TILE, side="right")) - 1)
            own, at = values[bounds[first] : bounds[last]], bounds[first:last] - bounds[first]
            least = np.empty((hashes, last - first), dtype=np.uint64)
            work = np.empty_like(own)
            for k, factor in enumerate(factors):
                np.multiply(own, factor, out=work)
                np.minimum.reduceat(work, at, out=least[k])
            out[full[first:last]] = (mix(least) & np.uint64(0xFFFF)).T
            first = last
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, sets in shingle_sets(batch.column(1), width):
                n = np.array([len(s) for s in sets], dtype=np.int64)
                one = np.array([mix(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                two = np.array([mix(s ^ _SEEDS[0]).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                signs = [row.tobytes() if c else None for row, c in zip(signatures(sets), n)]
                yield pa.record_batch(
                    [
                        ids.slice(first, len(sets)).cast(pa.int64()),
                        pa.array(n),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        pa.array(signs, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "sig"],
                )

    return run


def least_matches(hashes: int, step: int, share: float, miss: float) -> dict[int, int]:
    """Matches that a pair needs among its first n hashes, for every n that ends a batch.

    With a uniform prior, the posterior of the similarity after m matches of n is
    Beta(m + 1, n - m + 1), so P(similarity >= share) = P(Bin(n + 1, share) <= m).
    """
    out = {}
    for n in range(step, hashes + 1, step):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * share**m * (1 - share) ** (n + 1 - m)
        out[n] = m
    return out


_STEP = 16


def _agreeing(a: np.ndarray, b: np.ndarray, one: np.ndarray, two: np.ndarray, needed: dict[int, int]):
    """Of the pairs (a[one], b[two]) those that no batch of hashes rules out, and their matches."""
    agree = np.zeros(len(one), dtype=np.int64)
    for n, least in needed.items():
        agree += (a[one, n - _STEP : n] == b[two, n - _STEP : n]).sum(axis=1)
        keep = agree >= least
        one, two, agree = one[keep], two[keep], agree[keep]
    return one, two, agree


def _signs(column: pa.Array, hashes: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, hashes)


def _found(a, b, agree) -> pa.RecordBatch:
    a, b = np.concatenate(a or [[]]).astype(np.int64), np.concatenate(b or [[]]).astype(np.int64)
    agree = np.concatenate(agree or [[]]).astype(np.int64)
    return pa.record_batch(
        [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(agree)], names=["a", "b", "agree"]
    )


def _screen(hashes: int, share: float, miss: float):
    needed = least_matches(hashes, _STEP, share, miss)

    def run(batches):
        for batch in batches:
            a, b = _signs(batch.column(2), hashes), _signs(batch.column(3), hashes)
            every = np.arange(len(a))
            one, _, agree = _agreeing(a, b, every, every, needed)
            yield _found([batch.column(0).to_numpy()[one]], [batch.column(1).to_numpy()[one]], [agree])

    return run


def _across(hashes: int, width: int, percent: int, miss: float):
    """Links across components in a stream of groups: a chunk's members (role 0), then all members (role 1).

    One link of a chunk's member to a component is enough.
    """
    needed = least_matches(hashes, _STEP, percent / 100, miss)
    names = ("id", "comp", "n", "minor")

    def run(batches):
        now, parts, sets, chunk, met = None, [], [], None, set()
        for batch in batches:
            own = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            own["sig"] = _signs(batch.column("sig"), hashes)
            loc, chunks, role = (batch.column(c).to_numpy() for c in ("loc", "chunk", "role"))
            left, right = [], []
            for first, found in shingle_sets(batch.column("text"), width):
                k = np.arange(first, first + len(found))
                cut = np.flatnonzero((np.diff(loc[k]) != 0) | (np.diff(chunks[k]) != 0) | (np.diff(role[k]) != 0)) + 1
                for a, b in zip([0, *cut], [*cut, len(k)]):
                    group = (loc[k[a]], chunks[k[a]])
                    if group != now:
                        now, parts, sets, chunk, met = group, [], [], None, set()
                    some = {c: own[c][k[a:b]] for c in (*names, "sig")}
                    if role[k[a]] == 0:
                        parts.append(some)
                        sets += found[a:b]
                        continue
                    if chunk is None:
                        chunk = {c: np.concatenate([x[c] for x in parts]) for c in (*names, "sig")}
                    least = np.minimum(chunk["n"][:, None], some["n"]) * 100
                    fits = least >= percent * np.maximum(chunk["n"][:, None], some["n"])
                    fits &= chunk["comp"][:, None] != some["comp"]
                    fits &= ~some["minor"] | (chunk["id"][:, None] < some["id"])
                    one, two, agree = _agreeing(chunk["sig"], some["sig"], *np.nonzero(fits), needed)
                    for p in np.argsort(-agree, kind="stable"):
                        x, y = one[p], two[p]
                        ends = (chunk["comp"][x], some["comp"][y])
                        if ends not in met and _linked(sets[x], found[a + y], percent):
                            met.add(ends)
                            left.append(chunk["id"][x])
                            right.append(some["id"][y])
            yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return run


def _linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(one) + len(two) - both)


def _compare(width: int, percent: int):
    """Links between a pivot and the texts sorted behind it; works through a sorted stream."""

    def run(batches):
        now, pivots = None, []
        for batch in batches:
            a, chunk, role, other = (batch.column(k).to_pylist() for k in range(4))
            left, right = [], []
            for first, sets in shingle_sets(batch.column(4), width):
                for k, own in enumerate(sets, first):
                    if (a[k], chunk[k]) != now:
                        now, pivots = (a[k], chunk[k]), []
                    if role[k] == 0:
                        pivots.append(own)
                        continue
                    if any(_linked(pivot, own, percent) for pivot in pivots):
                        left.append(a[k])
                        right.append(other[k])
            yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return run


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


class _Verifier:
    """Turns candidate pairs into confirmed links and keeps the components they give."""

    def __init__(self, texts: DataFrame, width: int, percent: int):
        self.texts, self.width, self.percent = texts, width, percent
        self.groups: DataFrame | None = None

    def tag(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """``df`` with the component that the id in ``column`` has so far."""
        if self.groups is None:
            return df.withColumn(out, F.col(column))
        groups = self.groups.select(F.col("id").alias(column), F.col("component").alias("_c"))
        return df.join(groups, column, "left").withColumn(out, F.coalesce("_c", column)).drop("_c")

    def _apart(self, pairs: DataFrame) -> DataFrame:
        if self.groups is None:
            return pairs
        return self.tag(self.tag(pairs, "a", "_ca"), "b", "_cb").filter("_ca <> _cb").select("a", "b")

    def accept(self, links: DataFrame) -> None:
        links, count = materialize(links, "links")
        if count:
            known = [self.groups.select("id", "component")] if self.groups is not None else []
            self.groups = components(_union([*known, links.select("a", "b")]), *(known or [links])[0].columns[:2])

    def texts_of(self, ids: DataFrame, rows: int) -> DataFrame:
        """Texts (id, text) of about ``rows`` ids, which may repeat."""
        ids, n = materialize(few(ids.distinct(), rows), "ids")
        return stored(self.texts.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, "id", "left_semi"), "texts")

    def _confirm(self, pairs: DataFrame, count: int) -> DataFrame:
        texts = self.texts_of(pairs.select("a").union(pairs.select("b")).toDF("id"), count)
        degree = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("m"))
        keyed = few(pairs.join(degree, "a"), count).select(
            "a", F.expr(f"pmod(xxhash64(b), CAST(ceil(m / {CHUNK}) AS BIGINT))").alias("chunk"), "b"
        )
        keyed = stored(keyed, "keyed")
        heads = keyed.select("a", "chunk").distinct().join(texts.withColumnRenamed("id", "a"), "a")
        members = keyed.join(texts.withColumnRenamed("id", "b"), "b")
        rows = heads.select("a", "chunk", F.lit(0).alias("role"), F.col("a").alias("b"), "text").union(
            members.select("a", "chunk", F.lit(1).alias("role"), "b", "text")
        )
        rows = rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "role")
        return rows.mapInArrow(_compare(self.width, self.percent), "a long, b long")

    def add(self, pairs: DataFrame) -> None:
        """Take in screened pairs (a < b, agree)."""
        kept, count = materialize(pairs, "screened")
        if not count:
            return
        # The most similar partner of each text first: it settles most, so few pairs need more texts.
        best = F.max(F.struct("agree", F.negative("a").alias("a")))
        first = few(kept.groupBy("b").agg(best.alias("m")), count).select((-F.col("m.a")).alias("a"), "b")
        first, n = materialize(first, "first")
        self.accept(self._confirm(first, n))
        rest = self._apart(kept.select("a", "b").join(first, ["a", "b"], "left_anti"))
        rest, n = materialize(few(few(rest, count).distinct(), count), "rest")
        if n:
            self.accept(self._confirm(rest, n))


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    hashes: int = HASHES,
    miss: float = MISS,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Texts are linked when 100 * shared shingles >= ``percent`` * shingles of either.
    Texts without a word (null, empty, white space) have no shingle and link with
    nothing.  A row with a null id has a null component and is kept.  Rows that share
    an id count as one document with several texts: a link of any of them counts,
    repeated rows are given as often as they come in.  Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    prints = stored(
        texts.mapInArrow(
            _fingerprint(width, hashes), "doc_id long, n_shingles long, d1 long, d2 long, sig binary"
        ),
        "prints",
    )
    content = ["d1", "d2", "n_shingles"]
    classes = prints.filter("n_shingles > 0").groupBy(*content).agg(F.min("doc_id").alias("id"))
    classes = stored(classes.filter("id IS NOT NULL"), "classes")
    signed = stored(
        prints.join(classes.withColumnRenamed("id", "doc_id"), ["doc_id", *content], "left_semi").select(
            F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sig"
        ),
        "signed",
    )
    verifier = _Verifier(texts.filter("id IS NOT NULL"), width, percent)

    def cut(df: DataFrame, key: str, path: str, after: str) -> DataFrame:
        """Rows (key, path, id) by the bands after ``after``."""
        slices = f"""transform(sequence({after} + 1, {bands - 1}), b -> named_struct('path', {path} || array(b),
            'key', xxhash64({key}, b, substring(sig, b * {2 * rows} + 1, {2 * rows}))))"""
        return df.select("id", F.explode(F.expr(slices)).alias("k")).select("k.key", "k.path", "id")

    keys = cut(signed, "0L", "array()", "-1")
    ends = keys.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("id").alias("m"))
    live = stored(keys.join(ends.filter("lo <> hi"), "key"), "buckets")
    to_ends = live.select("id", F.explode(F.array("lo", "hi")).alias("p")).filter("id <> p")
    to_ends = to_ends.select(F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b")).distinct()
    pairs = to_ends.join(signed.toDF("a", "na", "sa"), "a").join(signed.toDF("b", "nb", "sb"), "b")
    pairs = pairs.filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b", "sa", "sb")
    verifier.add(pairs.mapInArrow(_screen(hashes, percent / 100, miss), "a long, b long, agree long"))

    # With 3 members, the ends met everyone.
    live, parts, rows_left = live.filter("m > 3").select("key", "path", "id"), [], 0
    for depth in range(1, DEPTH + 1):
        tagged = verifier.tag(live, "id", "comp")
        state = tagged.groupBy("key", "comp").agg(F.count("id").alias("c")).groupBy("key")
        state = state.agg(
            F.sum("c").alias("m"), F.max("c").alias("most"), F.max(F.struct("c", F.negative("comp").alias("x"))).alias("x")
        )
        found, count = materialize(tagged.join(state.filter("most < m"), "key").withColumn("loc", -F.col("x.x")), "open")
        large = F.col("m") - F.col("most") > (LARGE if depth < DEPTH else (1 << 62))
        parts.append(found.filter(~large))
        rows_left += count
        wider = found.filter(large & (F.element_at("path", -1) < bands - 1)).select("key", "path", "id")
        if wider.isEmpty():
            break
        live = stored(cut(wider.join(signed, "id"), "key", "path", "element_at(path, -1)"), "buckets")
    if rows_left:
        group = few(_union(parts).select("loc", "id", "comp").distinct(), rows_left)
        group, n = materialize(group.withColumn("minor", F.col("comp") != F.col("loc")), "open")
        sizes = few(group.groupBy("loc").agg(F.ceil(F.count_if(F.col("minor")) / MINORS).alias("chunks")), n)
        texts = signed.join(verifier.texts_of(group.select("id"), n), "id")
        dealt = group.join(sizes, "loc")
        heads = dealt.filter("minor").withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks")).withColumn("role", F.lit(0))
        members = dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        both = heads.union(members.withColumn("role", F.lit(1)).select(heads.columns)).join(texts, "id")
        both = both.repartition("loc", "chunk").sortWithinPartitions("loc", "chunk", "role")
        verifier.accept(both.mapInArrow(_across(hashes, width, percent, miss), "a long, b long"))

    by_content = verifier.tag(classes, "id", "component_id").select(*content, "component_id")
    return (
        prints.select("doc_id", *content)
        .join(by_content, content, "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
    )
