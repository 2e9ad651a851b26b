import random

import numpy as np
import pytest

from txnspark.llm import decontaminate as D


def distance(item, text):
    """Fewest edits between item and any part of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (c != d)))
        row = now
    return min(row)


def squeeze(text):
    return " ".join(text.lower().split())


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        k = rng.randrange(1, len(out) - 1)
        out[k : k + 1] = rng.choice([[], [rng.choice("xyz")], [out[k], "q"]])
    return "".join(out)


def test_alignment_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(200):
        item = "".join(rng.choices("abc", k=rng.randint(4, 20)))
        text = "".join(rng.choices("abc", k=rng.randint(0, 30)))
        a, t = (np.array([ord(c) for c in x], dtype=np.uint32) for x in (item, text))
        edits, start, end = D.align(a, t, -len(item), len(text))
        assert edits == distance(item, text)
        assert distance(item, text[start:end]) == edits


@pytest.mark.parametrize("block", [D.BLOCK_CHARS, 300])
def test_against_brute_force(spark, words, block):
    rng = random.Random(2)
    items = [(k, " ".join(words(1000 + k, rng.randint(15, 40)))) for k in range(8)]
    docs = []
    for k in range(60):
        text = " ".join(words(k, rng.randint(0, 150)))
        if k % 3 == 0:
            passage = edited(rng, items[k % 8][1], rng.choice([0, 1, 4, 8, 30]))
            text = text[: len(text) // 2] + " \n" + passage.upper() + "  " + text[len(text) // 2 :]
        docs.append((k, text))
    docs += [(100, None), (101, ""), (102, items[0][1]), (103, (items[1][1] + " ") * 3), (104, "x" * 100_000), (102, items[0][1])]
    df = spark.createDataFrame([(d, t, 1, "s") for d, t in docs], "doc_id long, text string, item_id int, start string")
    marks = spark.createDataFrame(


        [(i, t, "y") for i, t in items] + [(None, "an item without any id", "y"), (90, None, "y"), (91, "", "y"), (92, "short", "y"), items[0] + ("y",)],
        "item_id long, text string, edits string",
    )
    found = D.find_benchmark(df, marks, block_chars=block).collect()
    expected = set()
    for d, t in docs:
        for i, item in items:
            own = squeeze(item)
            k = D.edits_allowed(len(own), D.RATE, D.Q)
            if t and len(t) < 10_000 and distance(own, squeeze(t)) <= k:
                expected.add((d, i))
    assert {(r.doc_id, r.item_id) for r in found} == expected
    assert len(expected) > 12
    texts = dict(docs)
    for r in found:
        assert distance(squeeze(dict(items)[r.item_id]), squeeze(texts[r.doc_id][r.start : r.end])) == r.edits
    assert sum(r.doc_id == 103 for r in found) == 3
    assert sum(r.doc_id == 102 for r in found) == 2


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a text of some length")], "doc_id long, text string")
    marks = spark.createDataFrame([(1, "a text of some length")], "item_id long, text string")
    assert D.find_benchmark(docs, marks.limit(0)).collect() == []
    assert D.find_benchmark(docs.limit(0), marks).collect() == []
    assert D.find_benchmark(docs, marks).first().edits == 0


@pytest.mark.parametrize("share", [0.05, 0.1, 0.15])
def test_changed_words_and_quoted_halves(spark, words, share):
    """Passages of which some words are changed, and halves of long items, are found where they stand."""
    rng = random.Random(5)
    items = [(k, " ".join(words(2000 + k, 80))) for k in range(12)]
    docs, places = [], {}
    for k, item in items:
        for d, own in ((k, item.split()), (100 + k, item.split()[20:60])):
            for at in rng.sample(range(len(own)), int(share * len(own))):
                own[at] = "".join(rng.choices("wxyz", k=len(own[at])))
            before, after = " ".join(words(50 + d, 60)), " ".join(words(500 + d, 60))
            places[d] = (len(before) + 1, len(before) + 1 + len(" ".join(own)))
            docs.append((d, f"{before} {' '.join(own)} {after}"))
    docs += [(1000 + k, " ".join(words(3000 + k, 200))) for k in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(items, "item_id long, text string")
    found = D.find_benchmark(df, marks, window=D.WINDOW).collect()
    assert all(r.doc_id < 1000 and r.item_id == r.doc_id % 100 for r in found)
    assert {r.doc_id for r in found} == set(places)
    for r in found:
        a, b = places[r.doc_id]
        assert a - 20 <= r.start < r.end <= b + 20
    if share == 0.05:
        covered = {d: sum(r.end - r.start for r in found if r.doc_id == d) for d in places}
        assert all(covered[d] > 0.7 * (b - a) for d, (a, b) in places.items())


def test_quotation_of_a_window_and_a_step(spark, words):
    """Wherever a quotation of that length starts in the item, it holds a whole window."""
    item = " ".join(words(7, 100))
    docs = [(k, "zz " * 30 + item[k : k + D.WINDOW + D.STEP] + " zz" * 30) for k in range(0, len(item) - D.WINDOW - D.STEP, 7)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = D.find_benchmark(df, marks, window=D.WINDOW).collect()
    assert {r.doc_id for r in found} == {d for d, _ in docs}
    texts = dict(docs)
    for r in found:
        assert distance(squeeze(texts[r.doc_id][r.start : r.end]), squeeze(item)) <= r.edits


def contaminated(items, text):
    """Items of which the text holds the whole or a window within the edits allowed, by plain distances."""
    own, out = squeeze(text or ""), set()
    for i, item in items:
        item = squeeze(item)
        if len(item) < D.Q:
            continue
        spans = [(0, len(item))]
        if len(item) > D.WINDOW:
            spans += [(a, a + D.WINDOW) for a in {*range(0, len(item) - D.WINDOW, D.STEP), len(item) - D.WINDOW}]
        if any(distance(item[a:b], own) <= D.edits_allowed(b - a, D.RATE, D.Q) for a, b in spans):
            out.add(i)
    return out


@pytest.fixture
def marked(words):
    """Items of all lengths, and texts that hold them whole, cut, edited around the allowed rate, or not at all."""
    rng = random.Random(12)
    items = [(k, " ".join(words(4000 + k, n, 60))) for k, n in enumerate([2, 4, 9, 15, 22, 35, 50, 60])]
    docs = []
    for k in range(70):
        text = " ".join(words(k, rng.randint(0, 70), 60))
        if k % 5:
            item = items[rng.randrange(len(items))][1]
            a = rng.randrange(max(1, len(item) - 90))
            part = item if rng.random() < 0.4 else item[a : a + rng.randint(70, 130)]
            part = edited(rng, part, int(rng.choice([0, 0.08, 0.13, 0.15, 0.17, 0.2, 0.3]) * len(part))) if len(part) > 4 else part
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice([" ", "", "\n"]) + part + rng.choice([" ", ""]) + text[at:]
        docs.append((k, text))
    return items, docs


@pytest.mark.parametrize("hits, piece, block", [(D._HITS, D._PIECE, D.BLOCK_CHARS), (40, 300, 500)])
def test_windows_against_brute_force(spark, marked, monkeypatch, hits, piece, block):
    """The registered mode finds exactly the texts that hold an item or a window of one, however the work is cut."""
    monkeypatch.setattr(D, "_HITS", hits)
    monkeypatch.setattr(D, "_PIECE", piece)
    items, docs = marked
    want = {(d, i) for d, t in docs for i in contaminated(items, t)}
    assert 25 < len(want) and len({d for d, _ in want}) < len(docs) - 10
    df, marks = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = D.find_benchmark(df, marks, window=D.WINDOW, block_chars=block).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    texts, known = dict(docs), dict(items)
    for r in found:
        # What is found is within the edits of some part of the item.
        assert distance(squeeze(texts[r.doc_id][r.start : r.end]), squeeze(known[r.item_id])) <= r.edits
    left = D.without_benchmark(df, marks, window=D.WINDOW, block_chars=block).collect()
    assert {r.doc_id for r in left} == {d for d, _ in docs} - {d for d, _ in want}


def test_skipping_loses_nothing(spark, marked, monkeypatch):
    items, docs = marked
    df, marks = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = []
    for share in (0.0, 0.5, 0.9):
        monkeypatch.setattr(D, "SKIP", share)
        found.append(sorted(map(tuple, D.find_benchmark(df, marks, window=D.WINDOW).collect())))
    assert found[0] == found[1] == found[2] and found[0]


def test_batched_alignment_is_the_single_one():
    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths, wides, edits = (rng.integers(a, b, 12) for a, b in ((3, 30), (1, 25), (0, 8)))
        texts = [rng.integers(0, 3, int(rng.integers(0, 40))).astype(np.uint32) for _ in range(12)]
        begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        patterns = rng.integers(0, 3, (12, int(lengths.max()))).astype(np.int32)
        first = rng.integers(-15, 30, 12)
        joined = np.concatenate([*texts, np.zeros(1, np.uint32)])
        found = D.align_many(patterns, lengths, joined, begins[:-1], np.diff(begins), first, wides, edits)
        got = {int(c): (int(k), int(a), int(b)) for c, k, a, b in zip(*found)}
        for c in range(12):
            own = patterns[c, : lengths[c]]
            k, _, _ = D.align(own, texts[c], int(first[c]), int(first[c] + wides[c]) - 1)
            assert (k <= edits[c]) == (c in got)
            if c in got:
                assert got[c][0] == k
                part = texts[c][got[c][1] : got[c][2]]
                assert D.align(own, part, -len(own), len(part))[0] <= k


def test_odd_rows_with_windows(spark, words):
    long = " ".join(words(1, 60))
    items = [(1, long), (1, long), (2, long), (None, long), (3, None), (4, ""), (5, "abc"), (6, "exact words here"), (7, "  ")]
    docs = [(1, long), (1, long), (None, long[:200]), (2, None), (3, ""), (4, " \n"), (5, "abc"), (6, "the EXACT   words\there it is"), (7, "é漢😀" * 3000)]
    df = spark.createDataFrame([(d, t, "a", 2, 3) for d, t in docs], "doc_id long, text string, start string, item_id int, _scanned int").drop("_scanned")
    marks = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, doc_id string")
    found = D.find_benchmark(df, marks, window=D.WINDOW).collect()
    assert sorted({(r.doc_id, r.item_id) for r in found}, key=str) == sorted([(1, 1), (1, 2), (None, 1), (None, 2), (6, 6)], key=str)
    assert sum(r.doc_id == 1 and r.item_id == 1 for r in found) == 2  # each of two equal rows reports it
    (six,) = [r for r in found if r.doc_id == 6]
    assert docs[7][1][six.start : six.end] == "EXACT   words\there" and six.edits == 0
    left = D.without_benchmark(df, marks, window=D.WINDOW)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 4, 5, 7]
    assert D.without_benchmark(df, marks.limit(0), window=D.WINDOW).count() == len(docs)
    assert D.without_benchmark(df.limit(0), marks, window=D.WINDOW).collect() == []
    assert D.find_benchmark(df.limit(0), marks, window=D.WINDOW).collect() == []
    assert D.find_benchmark(df, marks.filter("item_id IN (3, 4, 5, 7)"), window=D.WINDOW).collect() == []
