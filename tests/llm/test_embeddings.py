import numpy as np
import pytest

from txnspark.llm import embeddings as E


def brute_force(rows):
    n = len(rows)
    unit = []
    for _, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        v = np.array(v, float) / np.max(np.abs(v)) if ok else None
        unit.append(v / np.linalg.norm(v) if ok else None)
    links, parent = [0] * n, list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if unit[i] is None or unit[j] is None or rows[i][2] != rows[j][2] or len(unit[i]) != len(unit[j]):
                continue
            if unit[i] @ unit[j] >= E.SIMILARITY:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for k in range(n):
        least[root(k)] = min(least.get(root(k), rows[k][0]), rows[k][0])
    return sorted((rows[k][0], links[k], least[root(k)], least[root(k)] == rows[k][0]) for k in range(n))


def vectors(seed=1, n=300):
    rng, rows = np.random.default_rng(seed), []
    centres = rng.standard_normal((25, 16))
    for k in range(n):
        v = centres[rng.integers(25)] + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.25, 0.5])
        rows.append((k, [float(x) for x in v], int(rng.integers(2))))
    rows += [(n, None, 0), (n + 1, [], 0), (n + 2, [0.0] * 16, 0), (n + 3, [1.0, None] * 8, 0)]
    rows += [(n + 4, [float("nan")] * 16, 0), (n + 5, [float("inf")] * 16, 0), (n + 6, rows[0][1], None)]
    rows += [(n + 7, [1e-200] * 16, 1), (n + 8, [1e200] * 16, 1), (n + 9, rows[0][1][:8], rows[0][2])]
    return rows


@pytest.mark.parametrize("run, block", [(256, 512), (8, 3), (16, 512)])
def test_against_brute_force(spark, monkeypatch, run, block):
    monkeypatch.setattr(E, "RUN", run)
    monkeypatch.setattr(E, "BLOCK", block)
    rows = vectors()
    df = spark.createDataFrame(
        [(k, v, label, 1, "x") for k, v, label in rows],
        "vec_id long, embedding array<double>, label int, n_links int, key string",
    )
    got = sorted(tuple(r) for r in E.link_vectors(df).collect())
    assert got == brute_force(rows)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    v = [1.0, 2.0]
    df = spark.createDataFrame([(3, v, 1), (3, v, 1), (9, v, 1), (None, v, 1)], "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in E.link_vectors(df).collect())
    assert got == [(-1, 0, None, True), (3, 2, 3, True), (3, 2, 3, True), (9, 2, 3, False)]
    assert E.link_vectors(df.limit(0)).collect() == []


def test_plan_keeps_linked_pairs():
    for n in (10, 1_000, 10**6, 10**9):
        signs, tables = E.plan(n, E.SIMILARITY, E.MISS)
        p = 1 - np.arccos(E.SIMILARITY) / np.pi
        assert (1 - p**signs) ** tables <= E.MISS or signs == 0
    assert E.least_collisions(24, 2.5, 1e-4) >= 18
