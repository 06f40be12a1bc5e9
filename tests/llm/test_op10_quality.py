import random
import zlib

import numpy as np

from abasto.llm import op10_quality as op
from tests.llm.corpus import frame, prose


def labelled(seed=1, size=240):
    rng = random.Random(seed)
    rows, labels = [], []
    for doc in range(size):
        words, good = prose(rng, rng.randint(10, 60)), rng.random() < 0.6
        text = " ".join(words if good else [word + rng.choice(["###", "&&&", "$$$"]) for word in words])
        rows.append((doc, text))
        labels.append((doc, int(good), 0))
    return rows, labels


def frames(spark, rows, labels):
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows, labels = labelled()
    docs, known = frames(spark, rows, labels)
    model = op.train(docs, known)
    found = {r.doc_id: r for r in op.score(docs, model).collect()}
    assert len(found) == len(rows)
    for doc, row in found.items():
        assert row.held_out == (zlib.crc32(str(doc).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
    held = [found[doc].predicted == quality for doc, quality, _ in labels if found[doc].held_out]
    assert len(held) > 50 and np.mean(held) > 0.97
    kept = op.accept(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in found.items() if r.predicted}
    assert op.train(docs.repartition(5), known) == model


def test_held_out_labels_are_not_used(spark):
    rows, labels = labelled(2, 90)
    other = [(doc, 1 - q if zlib.crc32(str(doc).encode()) % 3 == 1 else q, t) for doc, q, t in labels]
    assert op.train(*frames(spark, rows, labels)) == op.train(*frames(spark, rows, other))


def test_scores_against_all_pairs_of_features():
    rng = np.random.default_rng(3)
    machine = op.Machine(0.3, rng.normal(0, 0.3, (op.SIZE, op.RANK + 1)))
    texts = [b"", b"one", "été ONE two two one | x".encode(), b"a " * 50]
    places, values, bounds = op.features(texts)
    raw, _ = machine.raw(places, values, bounds)
    for row in range(len(texts)):
        p, x = places[bounds[row] : bounds[row + 1]], values[bounds[row] : bounds[row + 1]]
        assert len(set(p.tolist())) == len(p)
        wanted = machine.bias + (machine.table[p, 0] * x).sum()
        for i in range(len(p)):
            for j in range(i):
                wanted += machine.table[p[i], 1:] @ machine.table[p[j], 1:] * x[i] * x[j]
        assert np.isclose(raw[row], wanted)


def test_the_gradient_lowers_the_loss():
    rows, labels = labelled(4, 120)
    texts, wanted = [text.encode() for _, text in rows], np.array([quality for _, quality, _ in labels], dtype=float)
    scores = np.clip(op.fit(texts, wanted).score(texts), 1e-6, 1 - 1e-6)
    assert -(wanted * np.log(scores) + (1 - wanted) * np.log(1 - scores)).mean() < 0.2


def test_odd_rows(spark):
    rows = [(None, "a b"), (1, None), (1, ""), (2, "x " * 100_000)]
    docs, known = frames(spark, rows, [(1, None, 0), (None, 1, 0), (2, 1, 0), (2, 0, 0)])
    for model in (None, op.train(docs, known)):
        found = op.score(docs, model).collect()
        assert len(found) == 4 and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in op.score(docs, None).collect()} == {0.5}
    assert op.train(docs, known.limit(0)) is None
    assert op.score(docs.limit(0), None).collect() == []
