import random
import re

import numpy as np
import pytest

from abasto.llm import op01_decontaminate as op
from tests.llm.corpus import ODD, prose


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def tiles_by_search(item, doc, least):
    """Greedy string tiling as it is defined: look at all places, take the longest free match, again and again."""
    item_used, doc_used, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                size = 0
                while (
                    i + size < len(item) and j + size < len(doc) and item[i + size] == doc[j + size]
                    and not item_used[i + size] and not doc_used[j + size]
                ):
                    size += 1
                if size >= least and (best is None or size > best[2]):
                    best = (i, j, size)
        if best is None:
            return tiles
        i, j, size = best
        item_used[i : i + size] = doc_used[j : j + size] = [True] * size
        tiles.append(best)


def expected(docs, items):
    found = {}
    for doc, text in docs:
        for item, other in items:
            theirs, ours = words(other), words(text)
            if not theirs:
                continue
            tiles = tiles_by_search(theirs, ours, min(op.LEAST, len(theirs)))
            covered = sum(size for _, _, size in tiles)
            if covered >= op.COVER * len(theirs):
                found[doc, item] = (len(theirs), covered, max(size for _, _, size in tiles))
    return found


def case(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(prose(rng, rng.choice([3, 6, 12, 25])))) for i in range(8)]
    items += [(100, None), (101, ""), (102, "a b a b a b a b a b"), (103, items[0][1])]
    docs = []
    for doc in range(30):
        text = prose(rng, rng.randint(0, 40))
        for _ in range(rng.randint(0, 2)):
            item = rng.choice(items)[1]
            parts = (item or "").upper().split(" ") if rng.random() < 0.3 else (item or "").split(" ")
            cut = rng.randint(0, len(parts))
            if rng.random() < 0.5:  # another order
                parts = parts[cut:] + prose(rng, 2) + parts[:cut]
            at = rng.randint(0, len(text))
            text[at:at] = [part + rng.choice(["", "!!", "***"]) for part in parts]
        docs.append((doc, rng.choice([" ", "\n", "  "]).join(text)))
    docs += [(900, None), (901, ""), (902, "x a b a b a b a b a b a b a b y"), (903, "b a b a b")]
    return docs, items


def frames(spark, docs, items):
    left = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    for part in ODD.split(", "):
        name, kind = part.split(" ")
        left = left.selectExpr("*", f"CAST(NULL AS {kind}) AS {name}")
    right = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS doc_id", "2 AS seed")
    return left, right


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("limit", [op.BROADCAST_WORDS, 0])
def test_against_search(spark, seed, limit):
    docs, items = case(seed)
    found = op.report(*frames(spark, docs, items), broadcast_words=limit).collect()
    got = {(r.doc_id, r.item_id): (r.item_words, r.covered, r.longest) for r in found}
    assert len(found) == len(got)
    wanted = expected(docs, items)
    assert set(got) == set(wanted) and wanted
    for key, (size, covered, longest) in wanted.items():
        assert got[key][0] == size and got[key][2] == longest
        assert got[key][1] == covered or key[1] == 102  # ties of equal length may tile a periodic text in another way
    for row in found:
        assert sum(size for _, _, size in row.tiles) == row.covered
        ours, theirs = words(dict(docs)[row.doc_id]), words(dict(items)[row.item_id])
        assert all(ours[j : j + n] == theirs[i : i + n] for i, j, n in row.tiles)


def test_tiles_do_not_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        item, doc = rng.integers(0, 4, 12).astype(np.uint64), rng.integers(0, 4, 40).astype(np.uint64)
        pairs = [(i, j) for i in range(10) for j in range(38) if (item[i : i + 3] == doc[j : j + 3]).all()]
        if not pairs:
            continue
        at_item, at_doc = (np.array(side) for side in zip(*pairs, strict=True))
        tiles = op.tile(item, at_item, at_doc, 3)
        brute = tiles_by_search(item.tolist(), doc.tolist(), 3)
        assert max(t[2] for t in tiles) == max(t[2] for t in brute)
        for side in (0, 1):
            used = [place for tile in tiles for place in range(tile[side], tile[side] + tile[2])]
            assert len(used) == len(set(used))
        assert all((item[i : i + n] == doc[j : j + n]).all() for i, j, n in tiles)


def test_clean_and_odd_rows(spark):
    passage = "one two three four five six seven"
    docs = [(None, passage), (1, passage), (1, passage), (2, "nothing of it"), (3, None)]
    left, right = frames(spark, docs, [(5, passage), (None, "alpha beta gamma delta epsilon")])
    assert sorted((r.doc_id or 0, r.item_id) for r in op.report(left, right).collect()) == [(0, 5), (1, 5), (1, 5)]
    kept = op.clean(left, right)
    assert kept.columns == left.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3]
    for a, b in ((left.limit(0), right), (left, right.limit(0))):
        assert op.report(a, b).collect() == []
        assert op.report(a, b, broadcast_words=-1).collect() == []


def test_long_document(spark):
    doc = " ".join(f"w{i % 9973}" for i in range(100_000)) + " here comes the one item of it all"
    left, right = frames(spark, [(1, doc)], [(1, "here comes the one item of it all")])
    assert [(r.covered, r.longest) for r in op.report(left, right).collect()] == [(8, 8)]


def test_one_row_for_each_document_row_and_item_row(spark):
    passage, turned = "one two three four five six seven eight", "five six seven eight one two three four"
    docs = [(1, passage), (1, passage), (1, turned), (2, turned), (2, passage), (None, passage), (None, turned), (None, passage)]
    docs += [(3, "eight seven six five four three two one"), (3, None)]
    items = [(5, passage), (5, passage), (None, passage), (6, turned), (7, None), (8, "four five")]
    left, right = frames(spark, docs, items)
    found = [
        sorted((r.doc_id or 0, r.item_id or 0, r.covered, r.longest) for r in op.report(left, right, broadcast_words=limit).collect())
        for limit in (op.BROADCAST_WORDS, 0)
    ]
    assert found[0] == found[1]
    wanted = sum(len(expected([(0, text)], [(0, item)])) for _, text in docs for _, item in items)
    assert len(found[0]) == wanted == 5 * 3 + 3 + 5


def test_tiles_by_length():
    rng = np.random.default_rng(4)
    for _ in range(150):
        item, doc = (rng.integers(0, 3, size).astype(np.uint64) for size in (rng.integers(3, 15), rng.integers(3, 40)))
        tiles, brute = op.tile_by_length(item, doc, 3), tiles_by_search(item.tolist(), doc.tolist(), 3)
        assert (not tiles) == (not brute) and (not brute or tiles[0][2] == brute[0][2])
        for side, words_ in ((0, item), (1, doc)):
            taken = [place for t in tiles for place in range(t[side], t[side] + t[2])]
            assert len(taken) == len(set(taken))
        assert all((item[i : i + n] == doc[j : j + n]).all() for i, j, n in tiles)
        free = [[None if place in {p for t in tiles for p in range(t[k], t[k] + t[2])} else w for place, w in enumerate(side.tolist())]
                for k, side in enumerate((item, doc))]
        grams = [{tuple(side[i : i + 3]) for i in range(len(side) - 2) if None not in side[i : i + 3]} for side in free]
        assert not grams[0] & grams[1]  # nothing is left


def test_loops_of_one_word(spark):
    left, right = frames(spark, [(1, "ha " * 8000), (2, "ha " * 3000)], [(1, "ha " * 8000), (2, "ha he " * 2000)])
    for limit in (op.BROADCAST_WORDS, 0):
        found = op.report(left, right, broadcast_words=limit).collect()
        assert [(r.doc_id, r.item_id, r.covered) for r in found] == [(1, 1, 8000)]
