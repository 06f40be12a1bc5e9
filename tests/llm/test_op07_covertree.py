import math

import numpy as np
import pytest

from abasto.llm import op07_covertree as op


def vectors(seed, size=160, width=12):
    """Random directions, near ones around some, copies, scaled copies, and vectors that link with nothing."""
    rng = np.random.default_rng(seed)
    rows, base = [], rng.normal(size=(12, width))
    for number in range(size):
        kind = rng.random()
        if kind < 0.3 or not rows:
            vector = rng.normal(size=width)
        elif kind < 0.75:
            vector = base[rng.integers(len(base))] + rng.normal(size=width) * rng.choice([0.05, 0.2, 0.3])
        else:
            vector = np.array(rows[rng.integers(len(rows))][1]) * rng.choice([1.0, 1.0, 2.0, 0.5])
        rows.append((number * 3, [float(x) for x in vector.astype(np.float32)], int(rng.choice([0, 0, 0, 1, 2]))))
    odd = [None, [], [0.0] * width, [math.nan] + [1.0] * (width - 1), [math.inf] * width, [None] * width, [1.0, 2.0]]
    rows += [(10_001 + i, vector, 0) for i, vector in enumerate(odd)] + [(10_050, rows[0][1], None), (10_051, [2.0, 4.0], 0)]
    order = rng.permutation(len(rows))
    return [rows[i] for i in order]


def expected(rows):
    """By comparing all pairs."""

    def usable(vector):
        return bool(vector) and None not in vector and all(map(math.isfinite, vector)) and any(vector)

    root, links = {vec: vec for vec, _, _ in rows}, {vec: 0 for vec, _, _ in rows}

    def find(vec):
        while root[vec] != vec:
            vec = root[vec]
        return vec

    for i, (a, x, k) in enumerate(rows):
        for b, y, m in rows[i + 1 :]:
            if k is None or k != m or not usable(x) or not usable(y) or len(x) != len(y):
                continue
            p, q = np.array(x, dtype=np.float64), np.array(y, dtype=np.float64)
            if float(p @ q) / math.sqrt(float(p @ p) * float(q @ q)) >= 0.93:
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {vec: (links[vec], find(vec), find(vec) == vec) for vec in root}


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    return docs.selectExpr("*", "CAST(NULL AS string) AS name", "1 AS node", "2 AS pair", "CAST(1 AS double) AS far")


def got(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op.join(df).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, monkeypatch, seed):
    rows = vectors(seed)
    assert got(frame(spark, rows)) == expected(rows)
    if seed == 2:  # small blocks, more pivots, small leaves
        for name, value in {"BLOCK": 7, "PER_PIVOT": 20, "LEAF": 3}.items():
            monkeypatch.setattr(op, name, value)
        assert got(frame(spark, rows)) == expected(rows)


def test_trees_find_what_a_product_finds():
    rng = np.random.default_rng(5)
    for spread in (0.02, 0.1, 0.3, 1.0):
        centers = rng.normal(size=(6, 8))
        one, two = (op.unit(centers[rng.integers(6, size=n)] + spread * rng.normal(size=(n, 8))) for n in (300, 170))
        pairs = {(int(i), int(j)) for a, b in op.linked(one, two, 0.93) for i, j in zip(a, b, strict=True)}
        assert pairs == set(zip(*map(np.ndarray.tolist, np.nonzero(one @ two.T >= 0.93)), strict=True))
        own = {tuple(sorted((int(i), int(j)))) for a, b in op.linked(one, None, 0.93) for i, j in zip(a, b, strict=True)}
        assert own == set(zip(*map(np.ndarray.tolist, np.nonzero(np.triu(one @ one.T >= 0.93, 1))), strict=True))


def test_odd_rows(spark):
    rows = [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (9, [1.0, 0.1], 1), (10, [1.0, 0.1], 2)]
    found = sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in op.join(frame(spark, rows)).collect())
    assert found == [(0, 0, 0), (4, 2, 4), (4, 2, 4), (9, 2, 4), (10, 0, 10)]
    assert op.join(frame(spark, []).limit(0)).collect() == []


def test_different_vectors_of_one_id(spark):
    rows = [(4, [1.0, 0.0], 1), (4, [0.0, 1.0], 1), (9, [1.0, 0.1], 1), (7, [0.1, 1.0], 1), (8, [0.05, 1.0], 1)]
    found = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in op.join(frame(spark, rows)).collect())
    assert found == [(4, 1, 4, True), (4, 2, 4, True), (7, 2, 4, False), (8, 2, 4, False), (9, 1, 4, False)]
