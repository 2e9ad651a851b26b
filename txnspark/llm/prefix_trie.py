"""Trie of the shared beginnings of conversations, by fixed-length block hashing.

Turns become digests once; texts are never shuffled.  ``BLOCK`` turns in a row are a block, and
conversations are grouped by the digest of all their blocks so far, block after block: one row for
all conversations that agree up to there.  A block that is the only one after its parent needs no
more: every turn boundary in it has the same members.  Only where several blocks follow one
parent are the turns inside them grouped again.

Digests of beginnings are sums, over the turns, of hashes of (place, turn): ``LANES`` sums of 32 bits
each, so that they can be added up by skew-safe running totals, however long a conversation is.

Sums over subtrees take one step: every node below which conversations end is owned by one leaf,
sums from the leaf upwards give that leaf's part of each ancestor, and the parts are added by node.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.operators.ordered import running_totals
from txnspark.scratch import materialize

from .keyed import lookup
from .store import stored
from .text import small_batches

BLOCK = 4
LANES = 4
#: Conversation ids joined into one text before the digest of a node's ids is taken: 2 to this power.
CHUNK = 8
#: Turns that a conversation takes over at most, and how many conversations share one beginning.
HEAD, SHARED = 8, 5

_KEY = ["k1", "k2"]
_PARENT = ["p1", "p2"]


def digest_turns(
    conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> tuple[DataFrame, int]:
    """Stored (conv_id, pos, digest, bytes), the turns of each conversation numbered from 0, and their number.

    Turns go by ``turn_col``, null first; ties by digest, so that equal rows may change places.  Null
    roles and texts are empty.  Rows without a conversation belong to none and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("_turn"),
        F.substring(F.sha2(content.cast("binary"), 256), 1, 32).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.lit(1).cast("long").alias("_one"),
    )
    placed = running_totals(rows, order=["_turn", "digest"], group=["conv_id"], sums={"pos": "_one"}, inclusive=False)
    return materialize(placed.select("conv_id", "pos", "digest", "bytes"), "turns")


def share_beginnings(turns: DataFrame, rows: int) -> tuple[DataFrame, int, DataFrame]:
    """Conversations that begin like the first of their group: stored turns, their number, and all ids.

    The first h turns of conversation c - c % 5 replace the first h of conversation c, h being the
    checksum of c in decimal, modulo 9; there may be fewer on either side.
    """
    ids = stored(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "ids")
    plan = ids.select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % SHARED).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).alias("h"),
    )
    sizes = ids.select(F.col("conv_id").alias("base"), F.col("n").alias("held"))
    plan = stored(
        plan.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("held", F.lit(0)))).drop("held"), "plan"
    )
    first = turns.filter(F.col("pos") < HEAD).withColumnRenamed("conv_id", "base")
    heads = plan.filter("taken > 0").join(first, "base").filter("pos < taken").select("conv_id", "pos", "digest", "bytes")
    own = lookup(turns, plan.select("conv_id", "h", "taken"), ["conv_id"], rows).filter("pos >= h")
    tails = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "bytes")
    return *materialize(heads.unionByName(tails), "rebuilt"), ids.select("conv_id")


def _lane(k: int, pos: Column, digest: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(k), pos, digest), 32)


def _key(depth: Column, lanes: list[Column]) -> list[Column]:
    """The two longs that stand for a beginning of ``depth`` turns."""
    return [F.xxhash64(F.lit(k), depth, *lanes) for k in (1, 2)]


def _root() -> list[Column]:
    return _key(F.lit(0).cast("long"), [F.lit(0).cast("long")] * LANES)


def _chained(turns: DataFrame, block: int) -> DataFrame:
    """Stored blocks (conv_id, b, turns, e*, s*): sums at the block's end and at its start."""
    pos, digest = F.col("pos"), F.col("digest")
    blocks = turns.groupBy("conv_id", F.expr(f"pos div {block}").alias("b")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("turns"),
        *[F.sum(_lane(k, pos, digest)).alias(f"own{k}") for k in range(LANES)],
    )
    sums = {f"e{k}": f"own{k}" for k in range(LANES)}
    chained = running_totals(blocks, order=["b"], group=["conv_id"], sums=sums)
    starts = [(F.col(f"e{k}") - F.col(f"own{k}")).alias(f"s{k}") for k in range(LANES)]
    end = F.col("b") * block + F.size("turns")
    ends = [F.col(f"e{k}") for k in range(LANES)]
    keys = [c.alias(n) for n, c in zip(_KEY, _key(end, ends))]
    parents = [c.alias(n) for n, c in zip(_PARENT, _key(F.col("b") * block, [F.expr(f"e{k} - own{k}") for k in range(LANES)]))]
    return stored(chained.select("conv_id", "b", "turns", *starts, *keys, *parents), "chained")


def _boundaries(blocks: DataFrame, block: int, *others: str) -> DataFrame:
    """A row per turn of each block: ``others``, depth, bytes, and the keys of the node and its parent."""
    at, lanes = [], [[F.col(f"s{k}")] for k in range(LANES)]
    for i in range(block):
        turn = F.get("turns", F.lit(i))
        for k in range(LANES):
            lanes[k].append(lanes[k][-1] + _lane(k, turn["pos"], turn["digest"]))
        depth = F.col("b") * block + i
        node, parent = (_key(depth + j, [lane[i + j] for lane in lanes]) for j in (1, 0))
        named = [c.alias(n) for n, c in zip([*_KEY, *_PARENT], [*node, *parent])]
        at.append(F.when(F.size("turns") > i, F.struct((depth + 1).alias("depth"), turn["bytes"].alias("bytes"), *named)))
    return blocks.select(*others, F.explode(F.array_compact(F.array(*at))).alias("t")).select(*others, "t.*")


def _nodes(chained: DataFrame, ids: DataFrame, block: int) -> tuple[DataFrame, int]:
    """Stored nodes (keys, parents' keys, depth, bytes, n, m): members and the least of them."""
    starts = [f"s{k}" for k in range(LANES)]
    kept = F.first(F.struct("b", "turns", *starts, *_PARENT)).alias("x")
    blocks = stored(
        chained.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("m"), kept).select(*_KEY, "n", "m", "x.*"),
        "blocks",
    )
    only = blocks.groupBy(*_PARENT).agg(F.count(F.lit(1)).alias("c"), *[F.first(k).alias(k) for k in _KEY])
    only = only.filter("c = 1").select(*_KEY, F.lit(True).alias("alone"))
    marked = stored(blocks.join(only, _KEY, "left"), "marked")
    alone = _boundaries(marked.filter("alone"), block, "n", "m")
    parted = _boundaries(marked.filter("alone IS NULL"), block, "n", "m")
    rest = F.first(F.struct("depth", "bytes", *_PARENT)).alias("x")
    parted = parted.groupBy(*_KEY).agg(F.sum("n").alias("n"), F.min("m").alias("m"), rest).select(*_KEY, "n", "m", "x.*")
    root = ids.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("m")).filter("n > 0")
    root = root.select(
        *[c.alias(n) for n, c in zip([*_KEY, *_PARENT], _root() * 2)],
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), "n", "m",
    )
    return materialize(alone.unionByName(parted).unionByName(root), "nodes")


def _sha256(batches):
    """Digest of the texts of each key, joined by commas; rows come sorted by key and chunk."""
    key, state = None, None

    def done():
        return pa.record_batch(
            [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([state.hexdigest()])],
            names=[*_KEY, "ends_sha256"],
        )

    for batch in batches:
        for k1, k2, text in zip(*[c.to_pylist() for c in batch.columns]):
            if (k1, k2) != key:
                if key is not None:
                    yield done()
                key, state = (k1, k2), hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if key is not None:
        yield done()


def _ends(chained: DataFrame, ids: DataFrame) -> DataFrame:
    """(keys, ends_sha256) of the nodes at which conversations end.

    Ids are sorted and joined in chunks, many tasks to a node; what is left to one task is to
    run the digest, which cannot be divided, over a node's chunks as they stream by.
    """
    last = chained.groupBy("conv_id").agg(F.max_by(F.struct(*_KEY), "b").alias("x")).select("conv_id", "x.*")
    whole = ids.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(F.col(n), c).alias(n) for n, c in zip(_KEY, _root())]
    )
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    chunks = whole.groupBy(*_KEY, F.shiftright("conv_id", CHUNK).alias("chunk")).agg(joined.alias("text"))
    ordered = chunks.repartition(*_KEY).sortWithinPartitions(*_KEY, "chunk")
    return ordered.select(*_KEY, "text").mapInArrow(_sha256, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, rows: int, ids: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """One row per distinct beginning of the conversations, the empty one included.

    ``turns`` are ``rows`` stored rows (conv_id, pos, digest, bytes), numbered from 0 in each
    conversation; ``ids`` are all conversations, those without turns too.  Gives conv_id (the least
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    Repeated conversations are members each for itself; no conversations give no rows.  Turns of
    the same role and text are one node only where all turns before them agree too.
    """
    small_batches(turns.sparkSession)
    chained = _chained(turns, block)
    nodes, n = _nodes(chained, ids, block)
    children = nodes.filter("depth > 0").groupBy(*[F.col(p).alias(k) for k, p in zip(_KEY, _PARENT)])
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, _KEY, "left").fillna(0, ["n_children"]), "nodes")

    # Paths from the leaves to the root, each by the least conversation that ends at the leaf.
    leaves = nodes.filter("n_children = 0").select(F.col("m").alias("conv_id"), F.lit(True).alias("leaf"))
    paths = lookup(chained, leaves, ["conv_id"], rows).filter("leaf")
    steps = _boundaries(paths, block, "conv_id").select("conv_id", "depth", *_KEY)
    tops = leaves.select("conv_id", F.lit(0).cast("long").alias("depth"), *[c.alias(k) for k, c in zip(_KEY, _root())])
    steps = stored(steps.unionByName(tops), "steps")
    below = steps.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_leaves"), F.min("conv_id").alias("owner"))
    nodes = stored(nodes.join(below, _KEY), "nodes")
    owned = nodes.filter("n > 1 AND bytes > 0").select(
        F.col("owner").alias("conv_id"), "depth", ((F.col("n") - 1) * F.col("bytes")).alias("saved")
    )
    weighed = steps.join(owned, ["conv_id", "depth"], "left").fillna(0, ["saved"])
    upward = running_totals(weighed, order=["depth"], descending=["depth"], group=["conv_id"], sums={"part": "saved"})
    saved = upward.groupBy(*_KEY).agg(F.sum("part").alias("saved_tokens"))
    named = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("m").alias("parent_conv_id"))
    out = lookup(nodes, named, _PARENT, n).join(saved, _KEY).join(_ends(chained, ids), _KEY, "left")
    return out.select(
        F.col("m").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def rebuilt_trie(conversations: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """The trie of conversations that share beginnings (see :func:`share_beginnings`)."""
    turns, rows = digest_turns(conversations)
    return prefix_trie(*share_beginnings(turns, rows), block=block)


_BIT = "xor({0} >> 1, ({0} & 1) * 3988292384)"
ORACLE = f"""
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS dig, turn
           FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, dig, strlen(text) AS bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, dig) - 1 AS pos FROM o),
i AS (SELECT conv_id AS c, conv_id - conv_id % {SHARED} AS base,
             xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                 lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda b, z: {_BIT.format("b")})), 4294967295) % {HEAD + 1} AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c, 0 AS part, pos, dig, bytes FROM i JOIN t ON t.conv_id = base AND pos < h
      UNION ALL SELECT c, 1, pos, dig, bytes FROM i JOIN t ON t.conv_id = c AND pos >= h),
l AS (SELECT c, list(dig ORDER BY part, pos) AS digs, list(bytes ORDER BY part, pos) AS sizes FROM r GROUP BY c),
w AS (SELECT i.c, coalesce(digs, []) AS digs, coalesce(sizes, []) AS sizes FROM i LEFT JOIN l ON l.c = i.c),
p AS (SELECT c, d, len(digs) AS n, md5(array_to_string(digs[1:d], ',')) AS k, md5(array_to_string(digs[1:d - 1], ',')) AS pk,
             CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS bytes FROM (SELECT *, unnest(range(len(digs) + 1)) AS d FROM w)),
nodes AS MATERIALIZED (SELECT d, k, any_value(pk) AS pk, any_value(bytes) AS bytes, count(*) AS n, min(c) AS m,
                 sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = n), '')) AS ends FROM p GROUP BY d, k),
kids AS (SELECT d - 1 AS d, pk AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
e AS (SELECT x.*, coalesce(kids.n, 0) AS n_children FROM nodes x LEFT JOIN kids ON kids.d = x.d AND kids.k = x.k),
a AS (SELECT p.d, p.k, sum((e.n - 1) * e.bytes) AS saved, count_if(n_children = 0) AS leaves FROM e JOIN p ON p.c = e.m AND p.d <= e.d GROUP BY 1, 2)
SELECT e.m AS conv_id, e.d AS depth, u.m AS parent_conv_id, e.n AS n_convs, e.n_children, a.leaves::BIGINT AS n_leaves,
       a.saved::BIGINT AS saved_tokens, e.ends AS ends_sha256
FROM e JOIN a ON a.d = e.d AND a.k = e.k LEFT JOIN nodes u ON u.d = e.d - 1 AND u.k = e.pk
"""
