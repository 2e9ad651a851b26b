"""The stages against a plain reading of what they do."""

from __future__ import annotations

import random
import re

import pytest

import corpus_pipeline
from txnspark.llm import pipeline
from txnspark.llm.secret_scan import MASK, RULES

from .test_decontaminate import contaminated
from .test_minhash import brute_force
from .test_mixing import WORD, targets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def folder(spark, corpus, words, tmp_path):
    rng = random.Random(11)
    items = [(k, " ".join(words(2000 + k, 25))) for k in range(3)]
    rows = []
    for d, t in corpus:
        if t and d % 7 == 0:
            t += ' token = "abcdef0123456789abcdef0123" ' + t[:40]
        if t and d % 11 == 0:
            t = t[:50] + " " + items[d % 3][1] + " " + t[50:]
        rows.append((d, t, "aa" if d % 2 else None, rng.choice(["s1", "s2", "s3", None]), None if t is None else len(t)))
    rows += [rows[3], (None, "a text without an id " * 5, "aa", "s1", 1), (None, items[0][1], None, "s2", 2)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows, items


def masked(text):
    spans = sorted(
        (m.start(), m.end()) for r in RULES for m in re.finditer(r.pattern, text, re.ASCII) if len(m.group(r.group)) >= r.least
    )
    out, at = "", 0
    for start, end in spans:
        if start >= at:
            out += text[at:start] + MASK
        at = max(at, end)
    return out + text[at:]


def one_of_each(rows):
    """Of the rows linked by 80 % of their shingles, the first by id, no id last, then by all columns."""
    group = {k: c for k, _, c, _ in brute_force([(k, r[1]) for k, r in enumerate(rows)], width=5)}
    best = {}
    for k, r in enumerate(rows):
        order = (r[0] is None, *[(x is not None, x) for x in r])
        if group[k] not in best or order < best[group[k]][0]:
            best[group[k]] = (order, r)
    return [r for _, r in best.values()]


def test_rows_that_share_an_id(spark, words):
    """Texts, not ids, decide: a unique text stays though another row of its id is a copy."""
    a, b = " ".join(words(1, 60)), " ".join(words(2, 60))
    rows = [(3, a, None, "s", 1), (5, a, None, "s", 1), (5, b, None, "s", 1), (None, a, None, "s", 1), (None, a, None, "s", 1)]
    rows += [(None, "short one", None, "s", 1), (None, "", None, "s", 1), (None, "", None, "s", 1), (9, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[0], rows[2], *rows[5:]], key=str)
    marks = [(1, b)]
    folder = pipeline.stored(spark.createDataFrame(marks, "item_id long, text string"), "marks").inputFiles()[0].rsplit("/", 1)[0]
    left = pipeline.without_benchmark(docs, spark.read.parquet(folder), window=pipeline.WINDOW).collect()
    assert sorted(map(tuple, left), key=str) == sorted([r for r in rows if r[1] != b], key=str)


def test_stages_against_brute_force(spark, folder):
    sf, rows, items = folder
    assert [name for name, _ in corpus_pipeline.STAGES] == [name for name, _ in pipeline.STAGES]
    docs, expected = spark.read.parquet(f"{sf}/documents.parquet"), list(rows)

    def step(k, wanted):
        nonlocal docs
        docs = _written(spark, corpus_pipeline.STAGES[k][1](spark, docs, sf))
        got = sorted((tuple(r) for r in docs.select(*COLUMNS).collect()), key=str)
        assert got == sorted(wanted, key=str)
        return wanted

    expected = step(0, [r for r in expected if r[1] and any(c.isalpha() for c in r[1])])
    expected = step(1, one_of_each(expected))
    before = len(expected)
    expected = step(2, [r for r in expected if not contaminated(items, r[1])])
    assert len(expected) < before - 1
    changed = [(d, masked(t), a, b, len(masked(t)) if masked(t) != t else n) for d, t, a, b, n in expected]
    assert any(MASK in r[1] for r in changed)
    expected = step(3, changed)
    last = [r.asDict() for r in corpus_pipeline.STAGES[4][1](spark, docs, sf).collect()]
    sizes: dict = {}
    for _, t, _, s, _ in expected:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t))
    wanted = targets(sizes)
    for s in sizes:
        taken = sum(len(WORD.findall(r["text"])) for r in last if r["source"] == s)
        assert abs(taken - wanted[s]) <= max(len(WORD.findall(r[1])) for r in expected)
    assert {tuple(r[c] for c in COLUMNS) for r in last} <= set(expected)
    assert {r["copy"] for r in last} <= {1, 2, 3}


def _written(spark, df):
    from txnspark.llm.store import stored

    return stored(df, "stage")


def test_run_and_empty_tables(spark, folder, tmp_path):
    sf, rows, _ = folder
    assert set(corpus_pipeline.run(spark, sf).columns) == {*COLUMNS, "copy"}
    empty = f"{tmp_path}/empty"
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []
