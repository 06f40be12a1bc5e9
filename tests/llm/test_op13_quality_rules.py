import random
import re

import pytest
from pyspark.sql import functions as F

from abasto.llm import op13_quality_rules as rules
from tests.llm.corpus import corpus, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "a\r\nb\r\na\r\n"), (5, "x y\nx y\n \nx y \n"), (6, "#*$%&|<>@"), (7, "a b c"),
    (8, "a b a b a b a"), (9, "a b c " * 30), (10, "é中😀\xa0x\x1cy"), (11, "one two three four one two three"), (12, "z " * 5000),
    (None, "no id"), (13, "twice"), (13, "twice"), (13, "other"), (14, "x\x0by\x0cz"),
]


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {}
    for window in windows:
        many[window] = many.get(window, 0) + 1
    covered = {i + step for i, window in enumerate(windows) if many[window] > 1 for step in range(3)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def test_measures(spark):
    rows = [*corpus(31), *ODD]
    found = rules.judge(frame(spark, rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    wanted = [(doc, *plain(text)) for doc, text in rows]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)


def test_no_python_and_no_shuffle(spark):
    plan = rules.judge(frame(spark, ODD[:1]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan
    text = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    executed = rules.judge(text)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in executed


def judged(spark, text, table):
    row = rules.judge(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), table).first()
    return row.failed_rules, row.kept


def test_rules(spark):
    rng = random.Random(3)
    good = " ".join(f"the w{rng.randrange(10**6)}x of" for _ in range(40))
    assert judged(spark, good, rules.RULES) == ([], True)
    assert judged(spark, good.replace("the", "t,he"), [rules.Rule("stops", "n_stop_words", low=41)])[0] == ["stops"]
    assert judged(spark, "### " + good + " ###" * 30, rules.RULES)[0] == ["symbols"]
    assert judged(spark, good + " 12" * 200, rules.RULES) == (["letters"], False)
    assert judged(spark, "- a\n* b\n• c", rules.RULES)[0] == ["word_length", "letters", "stop_words", "bullet_lines"]
    assert judged(spark, "wait...\nand…  \nso", [rules.Rule("cut", "n_cut_lines", of="n_lines", high=66)])[0] == ["cut"]
    assert judged(spark, "wait...\nand…  \nso", [rules.Rule("cut", "n_cut_lines", of="n_lines", high=67)])[0] == []
    assert judged(spark, "", [rules.Rule("share", "n_symbols", of="n_words", low=1)])[0] == []  # no share of nothing
    assert judged(spark, good, []) == ([], True)
    with pytest.raises(ValueError):
        rules.broken(rules.Rule("none", "n_words"))


def test_accept_keeps_rows_and_their_columns(spark):
    rng = random.Random(4)
    good = " ".join(f"the w{rng.randrange(10**6)}x of" for _ in range(40))
    docs = frame(spark, [(1, good), (1, good), (None, good), (2, "short"), (3, None)]).withColumn("words", F.lit("own")).withColumn("kept", F.lit(5))
    kept = rules.accept(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert sorted((r.doc_id or 0, r.text, r.words, r.kept) for r in kept.collect()) == [(0, good, "own", 5), *[(1, good, "own", 5)] * 2]


def test_no_rows(spark):
    assert rules.judge(frame(spark, []).limit(0)).collect() == []
