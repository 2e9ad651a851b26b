import random
import re

import pytest

from txnspark.llm import mixing
from txnspark.llm.mixing import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Shares by repeated clamping, in exact terms of the definition."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, held = sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in held]
        rest = total - sum(3 * sizes[s] for s in held)
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {**share, **{s: 3 * sizes[s] for s in held}}
        held |= above


@pytest.fixture
def rows(words):
    rng, out = random.Random(8), []
    for k in range(300):
        source = rng.choice(["big"] * 8 + ["a", "Zed", "é", None, "tiny"]) if k % 60 else "tiny"
        out.append((k, " ".join(words(k, rng.randint(0, 90))), source))
    return out + [(5, out[5][1], out[5][2]), (None, "one two", "a"), (None, "one two", "a"), (400, None, "void"), (401, " \n", "void")]


def checked(spark, rows):
    df = spark.createDataFrame([(d, t, s, 7, "x") for d, t, s in rows], "doc_id long, text string, source string, size int, hash string")
    return mix(df.repartition(5))


@pytest.mark.parametrize("prefix, broadcast", [(3, 100_000), (1, 0)])
def test_targets_and_sizes(spark, rows, monkeypatch, prefix, broadcast):
    monkeypatch.setattr(mixing, "PREFIX", prefix)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    got = checked(spark, rows).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    wanted = targets(sizes)
    largest = max(r.size for r in got)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {sizes[s]}
        assert all(r.target == pytest.approx(wanted[s]) for r in own)
        assert abs(sum(r.taken for r in own) - wanted[s]) <= largest
    assert all(r.size == len(WORD.findall(r.text or "")) for r in got)
    assert all(r.taken == r.size * r.copies and 0 <= r.copies <= 3 for r in got)
    again = checked(spark, rows[::-1]).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_one_source_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b", None), (2, "c", None)], "doc_id long, text string, source string")
    assert {(r.target, r.copies) for r in mix(df).collect()} == {(3.0, 1)}
    assert mix(df.limit(0)).collect() == []
    assert {(r.target, r.taken) for r in mix(df.withColumn("text", df.source)).collect()} == {(0.0, 0)}


def test_copies_without_ids_meet_the_target(spark):
    """Equal rows, some without any id, are not taken together: the target is missed by one of them at most."""
    text = "one two three four five"
    rows = [(None if k % 3 == 0 else k, text, "s" if k % 2 else "t") for k in range(3_000)] + [(7, "again", "t")] * 900
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mix(df).collect()
    assert len(got) == len(rows)
    for s in ("s", "t"):
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own)
        assert {r.copies for r in own} <= {0, 1, 2, 3} and max(r.copies for r in own) - min(r.copies for r in own) <= 1
    again = mix(df.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_very_long_text(spark):
    df = spark.createDataFrame([(1, "word " * 200_000, "a"), (2, "few words", "b"), (3, "x", "b")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mix(df).collect()}
    assert got[1]["size"] == 200_000 and got[1].copies == 1 and got[2].copies == got[3].copies == 3
