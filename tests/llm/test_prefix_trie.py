"""The trie against a plain one, over random, deep, repeated and odd conversations."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from txnspark.llm import prefix_trie as P

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def conversations(rows):
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            held[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    return {c: [x[3:] for x in sorted(v)] for c, v in held.items()}


def rebuilt(held):
    out = {}
    for c, own in held.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c - 5 * int(c / 5))
        out[c] = held.get(base, [])[:h] + own[h:]
    return out


def plain(held):
    """Rows of the trie, bottom up over all beginnings."""
    members = defaultdict(list)
    for c, turns in held.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        saved[node] += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = leaves[node] or 1
        if node:
            children[node[:-1]] += 1
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    rows = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(held[c]) == len(node))
        rows.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children[node],
                     leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(5)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.fixture
def talk():
    rng = random.Random(8)
    starts = [[(rng.choice("ua"), rng.choice(["", "é", "ab", "x" * 20])) for _ in range(rng.randint(1, 14))] for _ in range(6)]
    rows = []
    for c in [*range(-8, 90), 10**12, 2**63 - 1]:
        turns = rng.choice(starts)[: rng.randint(0, 14)] + [("u", rng.choice("abc")) for _ in range(rng.randint(0, 3))]
        rows += [(c, k, *t) for k, t in enumerate(turns)]
    for c in range(200, 500):  # copies that differ in nothing
        rows += [(c * 5, k, "u", "same") for k in range(3)]
    rows += [(600, None, None, None), (600, None, "a", None), (600, 1, "u", "b"), (600, 1, "u", "b"), (None, 0, "u", "lost")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1, 4])
def test_trie_of_rebuilt_conversations(spark, talk, block):
    assert got(P.rebuilt_trie(frame(spark, talk), block=block)) == plain(rebuilt(conversations(talk)))


def test_trie_of_conversations_as_they_are(spark, talk):
    turns, rows = P.digest_turns(frame(spark, talk))
    ids = turns.select("conv_id").distinct()
    assert got(P.prefix_trie(turns, rows, ids)) == plain(conversations(talk))


def test_deep_and_turnless(spark):
    rows = [(c, k, "u", f"t{k}") for c in (2, 3) for k in range(700)] + [(4, k, "u", f"t{k}") for k in range(699)]
    turns, n = P.digest_turns(frame(spark, rows))
    ids = spark.range(2, 6).select(P.F.col("id").alias("conv_id"))
    held = {**conversations(rows), 5: []}
    assert got(P.prefix_trie(turns, n, ids)) == plain(held)
    assert len(held[2]) == 700


def test_turns_that_only_look_alike(spark):
    """Roles and texts keep their boundary, and a turn counts by all turns before it."""
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc"), (1, 1, "u", "z"), (2, 1, "u", "z")]
    turns, n = P.digest_turns(frame(spark, rows))
    assert got(P.prefix_trie(turns, n, turns.select("conv_id").distinct())) == plain(conversations(rows))


def test_no_conversations(spark, talk):
    assert P.rebuilt_trie(frame(spark, talk).limit(0)).collect() == []
    assert P.rebuilt_trie(frame(spark, [(None, 0, "u", "x")])).collect() == []


def test_large_ordered_parts(spark, talk, monkeypatch):
    """The same rows when running totals go by chunks and hot keys are looked up apart."""
    from txnspark.llm import keyed
    from txnspark.operators import ordered

    monkeypatch.setitem(ordered.running_totals.__kwdefaults__, "one_task_rows", 20)
    monkeypatch.setattr(keyed, "COLD_ROWS", 3)
    assert got(P.rebuilt_trie(frame(spark, talk))) == plain(rebuilt(conversations(talk)))
