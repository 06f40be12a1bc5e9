import random
import re
from collections import Counter
from itertools import permutations

import numpy as np

from abasto.llm import op12_filter_audit as audit
from tests.llm.corpus import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    schema = "doc_id bigint, text string, source string, mask int, part string, digest binary, n bigint, good int"
    wide = [(doc, text, source, 7, "x", b"y", 9, 1) for doc, text, source in rows]
    return spark.createDataFrame(wide, schema).repartition(3)


def labels(spark, rows):
    wide = [(doc, quality, toxic, 3) for doc, quality, toxic in rows]
    return spark.createDataFrame(wide, "doc_id bigint, quality int, toxic int, n int")


def failed(rows):
    first = {}
    for doc, text, _ in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    for doc, text, source in rows:
        text, found = text or "", set()
        words = WORD.findall(text)
        if len(words) < 50:
            found.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            found.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            found.add("C")
        if re.search("[#$%&*|]", text):
            found.add("D")
        if doc is not None and doc > first[text]:
            found.add("E")
        yield doc, source or "", found


def brute(rows, labelled):
    good = {doc for doc, quality, _ in labelled if quality == 1 and doc is not None}
    toxic = {doc for doc, _, value in labelled if value == 1 and doc is not None}
    table, worth = {}, Counter()
    for doc, part, found in failed(rows):
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, letter in enumerate(order, 1):
                row = table.setdefault((part, order, step), Counter())
                removed = not gone and letter in found
                row["redundant"] += gone and letter in found
                gone |= removed
                row["kept"] += not gone
                row["removed"] += removed
                row["unique_fails"] += found == {letter}
                row["good_lost"] += removed and doc in good
                row["toxic_lost"] += removed and doc in toxic
                worth[part, letter] += removed
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return sorted((*key, *(row[name] for name in names), worth[key[0], key[1][key[2] - 1]]) for key, row in table.items())


def run(spark, rows, labelled):
    return sorted(map(tuple, audit.audit(documents(spark, rows), labels(spark, labelled)).collect()))


def test_audit_of_all_orders(spark):
    rng = random.Random(1)
    rows = [(doc, text, rng.choice(["a", "a", "a", "b", None, ""])) for doc, text in corpus(21, 60)]
    rows += [(5, "same", "a"), (5, "same", "b"), (5, "same", "b"), (4, "same", "b"), (None, "same", "a"), (None, "same", "a")]
    rows += [(6, "other", "a"), (6, None, "a"), (7, "", "c"), (8, "A B C #", "b"), (9, "X" * 300 + " É x" * 60, "b")]
    labelled = [(doc, rng.choice([0, 1, None]), rng.choice([0, 1])) for doc, *_ in rows if rng.random() < 0.6]
    labelled += [(5, 1, 0), (5, 0, 1), (None, 1, 1), (-1, 1, 1)]
    assert run(spark, rows, labelled) == brute(rows, labelled)


def test_no_rows(spark):
    assert run(spark, [], [(1, 1, 1)]) == []
    found = run(spark, [(1, None, None)], [])
    assert len(found) == 600 and found == brute([(1, None, None)], [])


def test_words_are_counted_as_by_a_set():
    rng = random.Random(2)
    parts = ["a", "b", "ab", "É", "中", "x" * 8, "x" * 9, "x" * 70, "x" * 71, "y" * 200, "x" * 69 + "z", "A", "#", "|", "\xa0", "\x00", " "]
    blanks = [" ", "\n", "\t", "\x0b", "\r\n", "  ", "", "\x1c"]
    texts = ["".join(rng.choice(parts) + rng.choice(blanks) for _ in range(rng.randint(0, 40))).encode() for _ in range(600)]
    found = audit.measure([*texts, b"", b" "])
    for place, text in enumerate(texts):
        words = text.split()
        assert found["words"][place] == len(words) and found["distinct"][place] == len(set(words))
        assert found["points"][place] == len(text.decode())
        assert found["capitals"][place] == sum(65 <= byte <= 90 for byte in text)
        assert found["symbols"][place] == sum(byte in b"#$%&*|" for byte in text)


def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(audit.Spans, "hashes", lambda self: np.zeros(len(self.starts), np.uint64))
    texts = [b"a b a c ab ab abcdefghi abcdefghj", b"a a a", b"", b"q " * 50 + b"w" * 100 + b" " + b"w" * 99]
    assert audit.measure(texts)["distinct"].tolist() == [6, 1, 0, 3]
