"""Language, toxicity and quality: held-out accuracy and odd rows."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txnspark.llm import langid
from txnspark.llm import toxicity as T
from txnspark.llm.chars import texts_of
from txnspark.llm.langid import identify_held_out
from txnspark.llm.quality import sample, score_quality
from txnspark.llm.toxicity import _grams, score_toxicity

LANGUAGES = {"aa": "th er on an re he in ed", "bb": "ñ ción os que la de ó rr", "cc": "sch ung ein ich ä ß pf zu"}
ODD = [(None, "null id"), (900, None), (901, ""), (902, "1234 !! %%"), (903, "x" * 50_000), (904, "漢字 😀"), (904, "漢字 😀")]


def prose(rng, language, n=60):
    parts = LANGUAGES[language].split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def fold(doc_id, parts):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % parts


@pytest.fixture
def documents(spark):
    rng, rows = random.Random(4), []
    for k in range(400):
        lang = rng.choice(sorted(LANGUAGES))
        text = prose(rng, lang).split()
        toxic, good = int(k % 4 == 0), int(k % 5 != 0)
        if toxic:
            for _ in range(6):
                text[rng.randrange(len(text))] = rng.choice(["gruwlig", "blarfk"])
        text = " ".join(text)
        rows.append((k, text if good else text.upper().replace(" ", "!! "), lang, toxic, good))
    rows += [(d, t, None, None, None) for d, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int, quality int").cache()


def test_language(spark, documents):
    got = identify_held_out(documents.withColumn("score", F.lit("x"))).collect()
    truth = {r.doc_id: r.lang for r in documents.collect()}
    assert len(got) == 400 + len(ODD)
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    unknown = {r.doc_id for r in got if r.lang_pred == "und"}
    assert unknown == {900, 901, 902}
    assert identify_held_out(documents.limit(0)).collect() == []


def test_language_without_labels(spark, documents):
    model = langid.fit(documents.filter("lang IS NULL"), "text", "lang")
    found = langid.identify(documents.select("doc_id", "text", F.lit(1).alias("lang_pred")), model)
    assert found.columns == ["doc_id", "text", "lang_pred", "score"]
    assert {r.lang_pred for r in found.collect()} == {"und"}


def test_language_does_not_depend_on_neighbours(spark, documents):
    model = langid.fit(documents, "text", "lang")
    one = langid.identify(documents.repartition(1), model).select("doc_id", "score").collect()
    many = langid.identify(documents.repartition(50), model).select("doc_id", "score").collect()
    a, b = ({r.doc_id: round(r.score, 9) for r in x} for x in (one, many))
    assert a == b


def check_scores(got, truth, parts, held, threshold):
    assert len(got) == 400 + len(ODD)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got)
    assert all(r.held_out == (fold(r.doc_id, parts) == held) for r in got)
    known = [r for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert sum(r.predicted == truth[r.doc_id] for r in known) >= 0.93 * len(known)


def odd_labels(spark, documents, label):
    rows = [(r.doc_id, r[label]) for r in documents.filter("lang IS NOT NULL").collect()]
    return spark.createDataFrame([*rows, rows[0], (None, 1), (12345, 0), (5, None), (6, 7)], f"doc_id long, {label} int")


def test_toxicity(spark, documents):
    docs = documents.select("doc_id", "text", F.lit("x").alias("score"), F.lit(0).alias("_label"))
    truth = {r.doc_id: r.toxic for r in documents.collect()}
    labels = odd_labels(spark, documents, "toxic")
    got = score_toxicity(docs, labels).collect()
    check_scores(got, truth, 5, 0, 0.5)
    again = score_toxicity(docs.repartition(7), labels).collect()
    assert {(r.doc_id, round(r.score, 9)) for r in again} == {(r.doc_id, round(r.score, 9)) for r in got}
    assert {r.score for r in score_toxicity(docs, labels.limit(0)).collect()} == {0.5}
    assert score_toxicity(docs.limit(0), labels).collect() == []


def test_held_out_labels_are_not_used(spark, documents):
    docs, labels = documents.select("doc_id", "text"), odd_labels(spark, documents, "toxic")
    flipped = labels.withColumn(
        "toxic", F.when(langid.fold(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    one, two = ({(r.doc_id, r.score) for r in score_toxicity(docs, x).collect()} for x in (labels, flipped))
    assert one == two


def test_quality(spark, documents):
    docs = documents.select("doc_id", "text", F.lit("x").alias("score"))
    truth = {r.doc_id: r.quality for r in documents.collect()}
    labels = odd_labels(spark, documents, "quality")
    check_scores(score_quality(docs, labels).collect(), truth, 4, 2, 0.7)
    bounded = score_quality(docs, labels, positives=80, unlabelled=120).collect()
    assert sum(r.predicted == truth.get(r.doc_id) for r in bounded) > 340
    assert {r.score for r in score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert score_quality(docs.limit(0), labels).collect() == []


def test_toxic_phrase_of_ordinary_words(spark):
    """Both classes use the same Cyrillic words equally often; only in toxic texts do two of them follow each other."""
    rng, rows = random.Random(9), []
    ordinary = ["".join(rng.choices("абвгдежзиклмнопрст", k=rng.randint(3, 7))) for _ in range(60)]
    for k in range(500):
        text, toxic = rng.choices(ordinary, k=40), k % 2
        for at in range(0, 40, 8):
            text[at : at + 4] = ["дурной", "совет", *text[:2]] if toxic else ["совет", *text[:2], "дурной"]
        rows.append((k, " ".join(text), toxic))
    documents = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = score_toxicity(documents, documents.select("doc_id", "toxic")).filter("held_out").collect()
    assert sum(r.predicted == r.doc_id % 2 for r in got) >= 0.95 * len(got) > 50


def test_words_of_any_script_and_length_are_told_apart():
    texts = ["sh1t", "sh2t", "кот", "коу", "漢字", "字漢", "expression", "expressive", "$", "", " \n"]
    for _, points, bounds in texts_of(pa.array(texts)):
        grams, cut, words = _grams(points, bounds)
    assert list(words) == [1, 1, 1, 1, 2, 2, 1, 1, 1, 0, 0]
    assert len({grams[-1][b - 1] for a, b in zip(cut[:-1], cut[1:]) if b > a}) == 9


def test_quality_sample_is_whole_at_any_skew(spark):
    """Rows of one id, null ids and copies of one row fill the sample up to its bound."""
    for doc_id in (1, None):
        rows = spark.createDataFrame([(doc_id, f"text number {k}") for k in range(500)], "doc_id long, text string")
        assert [sample(rows, n).count() for n in (0, 1, 100, 500, 600)] == [0, 1, 100, 500, 500]
        few = {tuple(r) for r in sample(rows, 100).collect()}
        assert {tuple(r) for r in sample(rows.repartition(5), 100).collect()} == few
    copies = spark.createDataFrame([(1, "one text")] * 900 + [(k, "another") for k in range(90)], "doc_id long, text string")
    assert [sample(copies, n).count() for n in (50, 200, 950, 990)] == [50, 200, 950, 990]


def test_quality_of_rows_under_one_id(spark):
    """All rows share an id, and there are more of them than the fit takes."""
    rng = random.Random(6)
    texts = [prose(rng, "aa") if k % 2 else prose(rng, "aa").upper().replace(" ", "!! ") for k in range(200)]
    one = next(k for k in range(100) if fold(k, 4) != 2)
    docs = spark.createDataFrame([(one, t) for t in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(one, 1)], "doc_id long, quality int")
    got = score_quality(docs, labels, positives=50, unlabelled=80).collect()
    assert len({round(r.score, 6) for r in got}) > 2


def plain_word_evidence(known, texts, discount=None):
    """Sums over words and pairs by Kneser-Ney models in plain Python; known are (text, label)."""

    def symbols(text):
        own = (text or "").lower().split()
        return ["<", *own, ">"] if own else []

    pairs = {}
    for text, label in known:
        own = symbols(text)
        for a, b in zip(own, own[1:]):
            pairs.setdefault((a, b), [0, 0])[label] += 1

    def taken(counts):
        ones, twos = counts.count(1), counts.count(2)
        return ones / (ones + 2 * twos) if ones and twos else 0.5

    words, contexts = sorted({b for _, b in pairs}), sorted({a for a, _ in pairs})
    before = {w: [sum(n[c] > 0 for (_, b), n in pairs.items() if b == w) for c in (0, 1)] for w in words}
    both = {w: sum(b == w for _, b in pairs) for w in words}
    d1 = [taken([before[w][c] for w in words]) for c in (0, 1)]
    every = [sum(before[w][c] for w in words) for c in (0, 1)]
    left = [d1[c] * sum(before[w][c] > 0 for w in words) / every[c] if every[c] else 1.0 for c in (0, 1)]
    p = {w: [max(before[w][c] - d1[c], 0) / (every[c] or 1) + left[c] * both[w] / len(pairs) for c in (0, 1)] for w in words}
    for c in (0, 1):
        assert abs(sum(p[w][c] for w in words) - 1) < 1e-9  # a distribution
    d2 = [taken([n[c] for n in pairs.values()]) for c in (0, 1)]
    kept = {k: n for k, n in pairs.items() if sum(n) >= T.CUTOFF}
    rest, of = {}, {}
    for a in contexts:
        own = [n for (x, _), n in pairs.items() if x == a]
        few = [n for n in own if sum(n) < T.CUTOFF]
        of[a] = [sum(n[c] for n in own) for c in (0, 1)]
        rest[a] = [
            (d2[c] * (sum(n[c] > 0 for n in own) - sum(n[c] > 0 for n in few)) + sum(n[c] for n in few)) / of[a][c] if of[a][c] else 1.0
            for c in (0, 1)
        ]

    def probability(a, b, c):
        seen = kept.get((a, b), [0, 0])[c]
        return max(seen - d2[c], 0) / max(of[a][c], 1) + rest[a][c] * p[b][c]

    for a in contexts:
        for c in (0, 1):
            if of[a][c]:
                assert abs(sum(probability(a, b, c) for b in words) - 1) < 1e-9

    def steep(x):
        return x + T.WEIGHT * max(x - T.CLEAR, 0)

    base = math.log(left[1]) - math.log(left[0])
    out = []
    for text in texts:
        own, total = symbols(text), 0.0
        for a, b in zip(own, own[1:]):
            if (a, b) in kept:
                total += steep(math.log(probability(a, b, 1)) - math.log(probability(a, b, 0))) - base
                continue
            if a in rest:
                total += math.log(rest[a][1]) - math.log(rest[a][0])
            if b in p:
                total += steep(math.log(p[b][1]) - math.log(p[b][0])) - base
        out.append(total)
    return out


def test_word_evidence_against_plain_kneser_ney(spark, words):
    rng = random.Random(21)
    known = []
    for k in range(50):
        label = int(k % 3 == 0)
        own = words(k % 25, rng.randint(0, 30), 40) + ["badword", "very", "badword"] * label * rng.randint(0, 2)
        known.append((" ".join(own), label))
    known += [("", 0), (None, 1), ("one", 0), known[3], known[3]]
    texts = [t for t, _ in known[:50]] + ["never seen words", "badword", "", None, "BADWORD very very"]
    df = spark.createDataFrame(known, "text string, _label int")
    weights = T.word_weights(df)
    model = T._sent(spark, weights).value
    assert (np.diff(model[0].astype(object)) > 0).all()
    got = []
    for _, points, bounds in T.texts_of(pa.array(texts, pa.string())):
        got += T._summed(model, points, bounds)[0].tolist()
    want = plain_word_evidence(known, texts)
    assert np.allclose(got, want, atol=1e-4) and np.ptp(want) > 5


def test_toxicity_is_the_same_by_join(spark, words, monkeypatch):
    """A table of weights that is too large to be sent gives the same scores."""
    rng = random.Random(22)
    rows = [(k, " ".join(words(k % 60, rng.randint(0, 40), 80) + ["foul", "play"] * (k % 4 == 0))) for k in range(300)] + [(7, "x"), (None, "foul play"), (301, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(280)], "doc_id long, toxic int")
    sent = sorted(map(tuple, T.score_toxicity(docs, labels).collect()), key=str)
    monkeypatch.setattr(T, "MODEL_BYTES", 0)
    joined = sorted(map(tuple, T.score_toxicity(docs, labels).collect()), key=str)
    assert [r[:2] + r[3:] for r in sent] == [r[:2] + r[3:] for r in joined]
    assert np.allclose([r[2] for r in sent], [r[2] for r in joined], atol=1e-4)
