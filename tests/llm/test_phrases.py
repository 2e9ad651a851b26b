"""Phrases against plain counting, with every prefix extended and none."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from txnspark.llm import phrases as P

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, share=50, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f[lang].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if len(p) == 2 and any(p in (q[:2], q[1:]) and 100 * b >= share * a for q, b in found.items() if len(q) == 3):
                continue
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.fixture
def texts(words):
    rng = random.Random(6)
    rows = []
    for k in range(150):
        own = words(k % 40, rng.randint(0, 120), 40)
        for _ in range(len(own) // 8):
            at = rng.randrange(len(own))
            own[at : at + 1] = rng.choice([["New", "York"], ["new", "york", "city"], ["hot", "dog"], ["É.é", "x"], ["a,", "b"], ["\tz", "\x0b"]])
        rows.append((" ".join(own), rng.choice(["en", "de", None, "und"])))
    rows += [(None, "en"), ("", "en"), (" \t\n.,", None), ("the the " * 5_000, "en"), ("only, marks; here", "xx"), ("w " * 9, "yy"), ("q " * 11, "zz")]
    return rows + rows[:30]


@pytest.mark.parametrize("budget, row_leaves", [(P.BUDGET, P._ROW_LEAVES), (500, P._ROW_LEAVES), (20, 7)])
def test_against_plain_counting(spark, texts, budget, row_leaves, monkeypatch):
    monkeypatch.setattr(P, "_ROW_LEAVES", row_leaves)
    df = spark.createDataFrame([(t, g, 1, "w") for t, g in texts], "text string, lang string, n long, word string").repartition(6)
    got = sorted(tuple(r) for r in P.collocations(df, least=10, budget=budget).collect())
    want = plain(texts, 10)
    assert got == want
    assert {"new york city", "hot dog"} <= {r[2] for r in want}
    if budget == P.BUDGET:
        assert sorted(tuple(r) for r in P.collocations(df, top=3, budget=budget).collect()) == plain(texts, 10, top=3)


def test_counts_beyond_64_bits(spark):
    """The score is exact where its products pass 64 bits."""
    a, left, right = 3_000_000_000, 3_000_000_007, 3_000_000_019
    score = spark.sql(
        f"SELECT 1000000 * CAST({a} AS DECIMAL(15, 0)) * CAST({a} AS DECIMAL(15, 0)) div (CAST({left} AS DECIMAL(15, 0)) * CAST({right} AS DECIMAL(15, 0)))"
    ).first()[0]
    assert score == 10**6 * a * a // (left * right)


def test_no_texts(spark):
    df = spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")
    assert P.collocations(df).collect() == []
    assert P.collocations(df.limit(0)).collect() == []
