import random
import re

import numpy as np
import pyarrow as pa
import pytest

from abasto.llm import op08_jaccard as op
from abasto.llm.components import components
from tests.llm.corpus import corpus, frame, prose


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def expected(rows):
    """By comparing all pairs."""
    sets = {doc: shingles(text) for doc, text in rows}
    root = {doc: doc for doc in sets}

    def find(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    docs = sorted(doc for doc in sets if sets[doc])
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {doc: (len(sets[doc]), find(doc)) for doc in sets}


def got(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in op.join(frame).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    assert got(frame(spark, rows)) == expected(rows)


def test_chain_and_threshold(spark):
    rng, rows = random.Random(7), []
    base = prose(rng, 64)
    for doc in range(60):  # a chain of edits: neighbours are similar, ends are not; copies come in any order
        base = list(base)
        base[(doc * 7) % 60 + 2] = f"e{doc}"
        rows.append(((doc * 37) % 61, " ".join(base)))
    for size, changed in [(10, 1), (13, 1), (24, 1), (40, 2), (60, 3)]:
        words = [f"t{size}x{i}" for i in range(size)]
        rows.append((1000 + size, " ".join(words)))
        rows.append((2000 + size, " ".join(words[:-changed] + [f"n{i}" for i in range(changed)])))
    assert got(frame(spark, rows)) == expected(rows)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK", 4)
    rows = corpus(11)
    assert got(frame(spark, rows)) == expected(rows)


def test_odd_rows(spark):
    rows = [(None, "a b c"), (5, "a b c"), (5, "a b c"), (7, "A B C"), (8, None), (9, "")]
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in op.join(frame(spark, rows)).collect())
    assert found == [(0, 1, 0), (5, 1, 5), (5, 1, 5), (7, 1, 5), (8, 0, 8), (9, 0, 9)]
    assert op.join(frame(spark, []).limit(0)).collect() == []


def test_keys_lose_no_similar_pair():
    rng = np.random.default_rng(3)
    for _ in range(3000):
        size = int(rng.choice([1, 2, 3, 4, 5, 6, 7, 9, 10, 17, 40, 90, 400]))
        one = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        other = list(one)
        while True:  # random edits as long as the pair stays similar
            trial = list(other)
            if rng.random() < 0.5 and len(trial) > 1:
                trial.pop(int(rng.integers(len(trial))))
            else:
                trial.append(rng.integers(0, 1 << 64, dtype=np.uint64))
            both = len(set(trial) & set(one))
            if 100 * both < 80 * (len(one) + len(trial) - both):
                break
            other = trial
        two = np.unique(np.array(other, dtype=np.uint64))
        assert np.intersect1d(op.part_keys(one), op.part_keys(two)).size
        a, b = op.bit_sketch(one), op.bit_sketch(two)
        width = min(len(a), len(b))
        distance = np.bitwise_count(op.fold(a, width) ^ op.fold(b, width)).sum()
        assert distance <= len(np.setxor1d(one, two))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7)] + [(200, x) for x in range(201, 260)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {95: 90, 100: 90} | {x: 200 for x in range(201, 260)}


@pytest.mark.parametrize("only_nearest", [False, True])
def test_small_groups_alone_and_large_groups_alone(monkeypatch, only_nearest):
    """Cells of many sizes, cut into batches at any place; every way of comparing gives the same pairs."""
    rng, rows = np.random.default_rng(4), []
    for key in range(40):
        base = np.unique(rng.integers(0, 1 << 64, 60, dtype=np.uint64))
        for _ in range(int(rng.choice([2, 3, 5, 20, 40]))):
            own = np.unique(np.concatenate([base[rng.random(len(base)) > 0.06], rng.integers(0, 1 << 64, 3, dtype=np.uint64)]))
            rows.append((key, 0, 0, 0, int(rng.integers(1 << 40)), int(rng.integers(3)), len(own), op.bit_sketch(own).tobytes()))
    names = ["key", "one", "two", "block", "sid", "root", "size", "sketch"]
    columns = [pa.array(column) for column in zip(*rows, strict=True)]
    whole, results = pa.RecordBatch.from_arrays(columns, names), []
    for small, step in ((1, 10_000), (16, 10_000), (16, 37), (10_000, 101)):
        monkeypatch.setattr(op, "SMALL", small)
        batches = [whole.slice(at, step) for at in range(0, len(rows), step)]
        out = pa.Table.from_batches(list(op.rest_rows(only_nearest)(iter(batches))))
        results.append(sorted(set(zip(*(out[name].to_pylist() for name in ("a", "b", "distance")), strict=True))))
    assert results[0] and all(result == results[0] for result in results)


def test_pair_distances():
    rng = np.random.default_rng(2)
    sketches = [rng.integers(0, 256, size, dtype=np.uint8) for size in (8, 8, 16, 16, 32)]
    column = pa.array([b"x", *(sketch.tobytes() for sketch in sketches)], pa.binary()).slice(1)
    i, j = (np.array(side) for side in zip(*[(a, b) for a in range(5) for b in range(5)], strict=True))
    wanted = []
    for a, b in zip(i, j, strict=True):
        width = min(len(sketches[a]), len(sketches[b]))
        wanted.append(int(np.bitwise_count(op.fold(sketches[a], width) ^ op.fold(sketches[b], width)).sum()))
    assert op.pair_distances(column, i, j, chunk=40).tolist() == wanted
