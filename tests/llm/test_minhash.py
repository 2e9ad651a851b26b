import pytest

from txnspark.llm import minhash
from txnspark.llm.graph import components
from txnspark.llm.minhash import least_matches, near_duplicates

from .test_text import reference_sets


def brute_force(rows, width=4, percent=80):
    sets = {}
    for d, t in rows:
        sets.setdefault(d, []).append(reference_sets(t, width))
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            for x in sets[a]:
                for y in sets[b]:
                    if x and y and 100 * len(x & y) >= percent * len(x | y):
                        one, two = sorted((root(a), root(b)))
                        parent[two] = one
    return sorted((d, len(reference_sets(t, width)), root(d), root(d) == d) for d, t in rows)


def result(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


@pytest.mark.parametrize("bounds", [{}, {"LARGE": 3, "MINORS": 2, "CHUNK": 2, "BROADCAST_IDS": 0}])
def test_against_brute_force(spark, corpus, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(minhash, name, value)
    rows = corpus + corpus[:5]  # repeated rows
    df = spark.createDataFrame(
        [(d, t, d, "x", d % 2 == 0) for d, t in rows],
        "doc_id long, text string, component_id long, a string, kept boolean",
    ).repartition(3)
    assert result(near_duplicates(df, width=4)) == brute_force(rows)


def test_a_chain_and_a_hot_group(spark, words):
    base, rows = words(5, 60), []
    for k in range(30):  # each changes one more word: neighbours are linked, the ends are not
        base = base[:k] + [f"new{k}"] + base[k + 1 :]
        rows.append((100 - k, " ".join(base)))
    hot = words(6, 80)
    for k in range(80):
        rows.append((200 + k, " ".join(hot[: k % 76] + [f"w{k}"] + hot[k % 76 + 1 :])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(df, width=4)) == brute_force(rows)


def test_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (2, "A b c d e f")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect()}
    assert got == {(None, None, True), (4, 2, False), (2, 2, True)}
    assert near_duplicates(df.limit(0)).collect() == []
    assert near_duplicates(df.filter("doc_id IS NULL")).first().n_shingles == 2


def test_posterior_bound():
    needed = least_matches(256, 16, 0.8, 1e-5)
    assert list(needed) == sorted(needed) and all(needed[n] < 0.8 * n for n in needed)
    assert needed[256] > 0.65 * 256


def test_components(spark):
    edges = [(k, k + 1) for k in range(20)] + [(50, 40), (40, 50), (40, 40), (100, 7), (61, 60)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect())
    assert got == {**{k: 0 for k in range(21)}, 100: 0, 50: 40, 40: 40, 61: 60, 60: 60}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").collect() == []
