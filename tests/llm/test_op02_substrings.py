import hashlib
import re

import pytest

from abasto.llm import op02_substrings as op
from tests.llm.corpus import corpus, frame


def expected(rows, span=op.SPAN):
    """By comparing every window with every earlier one."""
    split = {doc: re.findall(r"[^\x20\x09-\x0D]+", text or "") for doc, text in rows}
    seen, out = set(), {}
    for doc in sorted(split):
        words, gone = split[doc], set()
        for at in range(len(words) - span + 1):
            window = tuple(words[at : at + span])
            if window in seen:
                gone |= set(range(at, at + span))
            seen.add(window)
        kept = " ".join(word for place, word in enumerate(words) if place not in gone)
        out[doc] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_windows(spark, seed):
    rows = corpus(seed)
    found = op.dedup(frame(spark, rows)).collect()
    got = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in found}
    assert len(found) == len(rows)
    assert got == expected(rows)
    assert any(removed for _, removed, _ in got.values())


def test_spans_are_maximal(spark):
    words = [f"w{i}" for i in range(90)]
    rows = [(1, " ".join(words[:60])), (2, "x y " + " ".join(words[10:50]) + " z"), (3, " ".join(words[:19]))]
    found = {r.doc_id: r for r in op.dedup(frame(spark, rows)).collect()}
    assert found[2].spans == [[2, 42]] and found[2].kept == "x y z"
    assert found[1].n_removed == found[3].n_removed == 0


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (5, text), (5, text), (7, text), (8, None), (9, "")]
    found = sorted(((r.doc_id or 0, r.n_words, r.n_removed) for r in op.dedup(frame(spark, rows)).collect()))
    assert found == [(0, 40, 0), (5, 40, 0), (5, 40, 0), (7, 40, 40), (8, 0, 0), (9, 0, 0)]
    assert op.dedup(frame(spark, []).limit(0)).collect() == []


def test_rows_of_one_id_with_different_texts(spark):
    v, w = ([f"{letter}{i}" for i in range(40)] for letter in "vw")
    third = v[:20] + w[:20]
    rows = [(1, " ".join(v)), (5, " ".join(w)), (5, " ".join(third)), (5, " ".join(third))]
    found = sorted((r.doc_id, r.kept, r.n_removed) for r in op.dedup(frame(spark, rows)).collect())
    # Either text of id 5 may come first; what both hold goes from the other one, what id 1 holds goes in any case.
    first = [(1, " ".join(v), 0), (5, " ".join(w), 0), (5, "", 40), (5, "", 40)]
    second = [(1, " ".join(v), 0), (5, " ".join(w[20:]), 20), (5, " ".join(w[:20]), 20), (5, " ".join(w[:20]), 20)]
    assert found in (sorted(first), sorted(second))


def test_long_text(spark):
    words = [f"w{i % 50021}" for i in range(120_000)]
    (row,) = op.dedup(frame(spark, [(1, " ".join(words))])).collect()
    assert (row.n_words, row.n_removed) == (120_000, 120_000 - 50_021 - 19 + 19)
