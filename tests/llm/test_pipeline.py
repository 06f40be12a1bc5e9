import zlib

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import test_op01_decontaminate as leaks
from tests.llm import test_op08_jaccard as near

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("*", "CAST(NULL AS string) AS row", "1 AS score")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality", "near_copies", "benchmark_leaks", "secrets", "packing"]

    kept = steps["quality"](spark, docs, FOLDER)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    rows = [(r.doc_id, r.text) for r in kept.collect()]

    classes = near.expected(rows)
    one = steps["near_copies"](spark, kept, FOLDER)
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.collect()) == sorted(doc for doc, (_, component) in classes.items() if doc == component)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = steps["benchmark_leaks"](spark, one, FOLDER)
    before = {r.doc_id: r.text for r in one.collect()}
    gone = set(before) - {r.doc_id for r in left.collect()}
    assert left.columns == docs.columns
    contained = {
        doc for doc, text in before.items() for _, item in items if " ".join(leaks.words(item)) in " ".join(leaks.words(text))
    }
    assert contained <= gone
    some = [(doc, before[doc]) for doc in sorted(gone)]
    assert {doc for doc, _ in leaks.expected(some[:5], items)} == {doc for doc, _ in some[:5]}

    clean = steps["secrets"](spark, left, FOLDER)
    assert clean.columns == docs.columns and clean.count() == left.count()
    pieces = steps["packing"](spark, clean, FOLDER)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in left.collect()}


def test_rows_without_id_and_copies_of_an_id(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b"), (1, "a b"), (2, "a b")], "doc_id bigint, text string")
    kept = corpus_pipeline.near_copies(spark, docs, FOLDER)
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1]
    assert corpus_pipeline.near_copies(spark, docs.limit(0), FOLDER).collect() == []


def test_of_an_id_with_two_texts_the_copy_goes(spark):
    a, b = (" ".join(f"{letter}{i}" for i in range(30)) for letter in "ab")
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (2, b, "y"), (3, "", "x"), (3, "", "y"), (3, None, "x"), (4, "", "x"), (5, a + " end", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    found = [sorted(map(tuple, corpus_pipeline.near_copies(spark, docs.repartition(n), FOLDER).collect()), key=str) for n in (1, 3)]
    assert found[0] == found[1]
    assert [(doc, text) for doc, text, _ in found[0]] == sorted([(1, a), (2, b), (3, ""), (3, None), (4, "")], key=str)


def test_run_and_entries(spark):
    assert corpus_pipeline.run(spark, FOLDER).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
    ]
    names = [name.split("_")[0] for name in entry.queries() if name.startswith("op")]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14)) and "pipeline" in entry.queries()
    assert zlib.crc32(b"5") % 3 in (0, 1, 2)
