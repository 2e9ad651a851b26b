"""Near-duplicate vectors by collision counting on sorted projections.

Vectors of one label are cut into runs by the signs of ``k`` projections, in ``tables``
independent ways (one-dimensional windows alone are shared by too many unrelated pairs:
in any number of them, all pairs collide).  Inside a run, vectors are sorted on ``m``
further projections; around every query a window is laid, sized for the distance that
the similarity bound allows, and collisions are counted for each pair.  Pairs that reach
a count which linked pairs reach with probability 1 - ``MISS`` are verified in double
precision.  ``k`` grows with the logarithm of the largest label, so runs stay short, and
``tables`` with the chance that a linked pair is cut apart.

Equal vectors are one class first.  A long run is dealt into blocks, and every pair of
blocks is a group of its own.  A pair met in several tables is counted in the first.
"""

from __future__ import annotations

from math import acos, ceil, comb, erf, log, log2, pi, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.scratch import materialize

from .graph import components
from .store import stored
from .text import small_batches

SIMILARITY = 0.93
#: Chance to lose a pair whose similarity is just at the bound.
MISS = 1e-4
RUN, BLOCK = 256, 512
PROJECTIONS, WINDOW = 24, 2.5
SEED = 7


def plan(largest: int, similarity: float, miss: float) -> tuple[int, int]:
    """Signs for each run and tables, for labels of up to ``largest`` vectors."""
    signs = max(2, ceil(log2(max(largest, 1) / RUN))) if largest > RUN else 0
    together = (1 - acos(similarity) / pi) ** signs
    return signs, 1 if signs == 0 else ceil(log(miss) / log(1 - together))


def least_collisions(projections: int, window: float, miss: float) -> int:
    """Collisions that a pair at the bound reaches with probability 1 - ``miss``.

    Its distance along a projection is normal; a window reaches ``window`` deviations.
    """
    p, tail, least = erf(window / sqrt(2)), 0.0, 0
    while tail + (more := comb(projections, least) * p**least * (1 - p) ** (projections - least)) < miss:
        tail, least = tail + more, least + 1
    return least


def _directions(dim: int, count: int, stream: int) -> np.ndarray:
    return np.random.default_rng([SEED, stream, dim]).standard_normal((dim, count))


def _unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _codes(signs: int, tables: int):
    """Rows with one run code for each table."""

    def run(frames):
        for pdf in frames:
            out = np.zeros((len(pdf), tables), dtype=np.int64)
            for dim in pdf["dim"].unique():
                own = np.flatnonzero(pdf["dim"] == dim)
                side = _unit(pdf["vec"].iloc[own]) @ _directions(int(dim), signs * tables, 0) > 0
                out[own] = side.reshape(len(own), tables, signs) @ (1 << np.arange(signs))
            yield pdf.assign(codes=list(out))

    return run


def _count_pairs(similarity: float, projections: int, window: float, miss: float):
    least = least_collisions(projections, window, miss)
    reach = window * sqrt(2 - 2 * similarity)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b, table = int(pdf["a"].iloc[0]), int(pdf["b"].iloc[0]), int(pdf["table"].iloc[0])
        pdf = pdf.sort_values("id")
        x = _unit(pdf["vec"])
        ids, weight, block = (pdf[c].to_numpy() for c in ("id", "n", "block"))
        codes = np.stack(pdf["codes"])
        places = x @ _directions(x.shape[1], projections, 1)
        hits = np.zeros((len(x), len(x)), dtype=np.int16)
        for k in range(projections):
            order = np.argsort(places[:, k], kind="stable")
            line = places[order, k]
            rank = np.empty(len(x), dtype=np.int64)
            rank[order] = np.arange(len(x))
            first = np.searchsorted(line, places[:, k] - reach, side="left")
            last = np.searchsorted(line, places[:, k] + reach, side="right")
            hits += (rank[None, :] >= first[:, None]) & (rank[None, :] < last[:, None])
        one, two = np.nonzero(np.triu(hits >= least, 1))
        if a != b:
            keep = block[one] != block[two]
            one, two = one[keep], two[keep]
        if table:
            fresh = ~(codes[one][:, :table] == codes[two][:, :table]).any(axis=1)
            one, two = one[fresh], two[fresh]
        close = np.einsum("ij,ij->i", x[one], x[two]) >= similarity
        one, two = one[close], two[close]
        links = np.bincount(one, weights=weight[two], minlength=len(x)) + np.bincount(
            two, weights=weight[one], minlength=len(x)
        )
        # A spanning forest of the group's links is enough for the components.
        head = np.arange(len(x))
        while True:
            low = np.minimum(head[one], head[two])
            now = head.copy()
            np.minimum.at(now, one, low)
            np.minimum.at(now, two, low)
            now = now[now]
            if (now == head).all():
                break
            head = now
        some = np.flatnonzero(links)
        return pd.DataFrame({"id": ids[some], "links": links[some].astype(np.int64), "head": ids[head[some]]})

    return run


def link_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    similarity: float = SIMILARITY,
    miss: float = MISS,
    projections: int = PROJECTIONS,
    window: float = WINDOW,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors are linked when their labels are equal and not null, their lengths equal and
    their cosine is at least ``similarity``.  Null, empty and zero vectors and those with
    a null or non-finite component link with nothing, nor do rows without an id, which
    have a null component and are kept.  Rows that share an id are other vectors.  Other
    columns are ignored.
    """
    small_batches(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vec"),
        F.col(label_col).cast("string").alias("label"),
    )
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = finite & F.exists("vec", lambda v: v != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # The scale is taken out before the key, by the largest component: it changes no cosine.
    largest = F.array_max(F.transform("vec", F.abs))
    key = F.when(F.coalesce(sound, F.lit(False)), F.sha2(F.to_json(F.struct("vec", "label")).cast("binary"), 256))
    rows = rows.withColumn("key", F.unhex(key)).withColumn(
        "vec", F.when(F.col("key").isNotNull(), F.transform("vec", lambda v: v / largest))
    )
    keyed = stored(rows.select("vec_id", "key"), "vectors")
    classes = keyed.filter("key IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("id"), F.count("key").alias("n"))
    members = rows.join(classes, "key").filter("vec_id = id").dropDuplicates(["key"])
    members = stored(members.select("key", "id", "n", "label", "vec", F.size("vec").alias("dim")), "members")
    biggest = members.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    signs, tables = plan(biggest, similarity, miss)

    schema = "id long, n long, label string, vec array<double>, dim int, codes array<long>"
    coded = members.select("id", "n", "label", "vec", "dim").mapInPandas(_codes(signs, tables), schema)
    met = stored(coded, "coded").select("*", F.posexplode("codes").alias("table", "code"))
    run = ["label", "dim", "table", "code"]
    sizes = met.groupBy(*run).agg(F.ceil(F.count("id") / BLOCK).alias("blocks"), F.count("id").alias("m"))
    sizes, _ = materialize(sizes.filter("m > 1"), "runs")
    dealt = met.join(sizes, run).withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    pair = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("*", pair).select(
        *run, "id", "n", "vec", "codes", "block", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b")
    )
    found = dealt.groupBy(*run, "a", "b").applyInPandas(
        _count_pairs(similarity, projections, window, miss), "id long, links long, head long"
    )
    found = stored(found, "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.filter("id <> head"), "id", "head").select("id", "component")
    state = classes.join(links, "id", "left").join(groups, "id", "left").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("c")
    )
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("c", "vec_id"))
    out = keyed.join(state, "key", "left")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
