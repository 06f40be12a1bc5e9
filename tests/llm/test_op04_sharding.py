import hashlib
from collections import Counter

import numpy as np
import pytest

from abasto.llm import op04_sharding as op

NAMES = [f"s{i}" for i in range(13)]


def filled(shards, size):
    """The table as it is defined: whole preference lists, turn after turn."""

    def number(text, salt, modulus):
        digest = hashlib.blake2b(text.encode(), digest_size=8, person=salt.encode()).digest()
        return int.from_bytes(digest, "big") % modulus

    orders = [
        [(number(name, "start", size) + k * (number(name, "step", size - 1) + 1)) % size for k in range(size)] for name in shards
    ]
    assert all(sorted(order) == list(range(size)) for order in orders)
    table, turn = {}, 0
    while len(table) < size:
        order = orders[turn % len(shards)]
        table[next(slot for slot in order if slot not in table)] = turn % len(shards)
        turn += 1
    return [table[slot] for slot in range(size)]


def test_table_against_preference_lists():
    assert op.lookup_table(NAMES, 101).tolist() == filled(NAMES, 101)
    assert op.lookup_table(["only"], 7).tolist() == [0] * 7


def test_balance_and_small_disruption():
    before = op.lookup_table([f"s{i}" for i in range(50)])
    counts = Counter(before.tolist())
    assert max(counts.values()) - min(counts.values()) <= 1
    after = op.lookup_table([f"s{i}" for i in range(49)])
    stayed = before != 49
    assert (before[stayed] != after[stayed]).mean() < 0.06


def test_bad_arguments():
    for shards, size in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            op.lookup_table(shards, size)


def test_place(spark, tmp_path):
    rows = [(i, "t") for i in range(500)] + [(None, "n"), (3, "again")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'old' AS shard", "9 AS slot").repartition(3)
    found = op.place(df, "doc_id", NAMES, 101)
    assert found.columns == ["doc_id", "text", "slot", "shard"]
    table, got = op.lookup_table(NAMES, 101), found.collect()
    assert len(got) == len(rows)
    for row in got:
        key = "" if row.doc_id is None else str(row.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101
        assert (row.slot, row.shard) == (slot, NAMES[table[slot]])
    assert op.place(df.limit(0), "doc_id", NAMES, 101).collect() == []
    op.write_shards(df.drop("shard"), "doc_id", NAMES, str(tmp_path / "shards"), 101)
    back = op.read_shards(spark, str(tmp_path / "shards"), df.schema)
    assert back.columns == found.columns and sorted(map(str, back.collect())) == sorted(map(str, got))
    op.write_shards(df.limit(0), "doc_id", NAMES, str(tmp_path / "none"), 101)
    assert op.read_shards(spark, str(tmp_path / "none"), df.schema).collect() == []
    assert np.unique(table).size == len(NAMES)
