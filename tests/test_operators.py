import random

import pytest
from pyspark.sql import functions as F

from abasto.operators import keys, lookups, ranking, shares
from abasto.sources.tables import POSITION, read_parquet


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_not_in_follows_the_null_rule(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,)], "r int")
    assert rows(lookups.not_in(left, right, "k", "r")) == [(2,)]
    with_null = spark.createDataFrame([(1,), (None,)], "r int")
    assert rows(lookups.not_in(left, with_null, "k", "r")) == []
    empty = spark.createDataFrame([], "r int")
    assert rows(lookups.not_in(left, empty, "k", "r")) == [(1,), (2,), (None,)]


def test_unknown_reference_becomes_null(spark):
    fact = spark.createDataFrame([("a", 1), ("x", 2), (None, 3)], "k string, v int")
    dim = spark.createDataFrame([("a",), ("b",)], "k string")
    assert rows(lookups.known_or_null(fact, dim, "k", "k")) == [("a", 1), (None, 2), (None, 3)]
    assert rows(lookups.orphan_rows(fact, dim, "k", "k")) == [("x", 2), (None, 3)]
    assert rows(keys.foreign_key_violations(fact, dim, "k", "k")) == [("x", 1)]


def test_primary_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, j string")
    assert rows(keys.primary_key_violations(df, ["k", "j"])) == [(1, "a", 2), (2, None, 1)]
    assert rows(keys.uniqueness(df, "j", "t")) == [("t", 4, 2, 2)]
    assert rows(keys.not_null_violations(df, ["k", "j"])) == [(2, None, "j")]


def test_top_puts_nulls_first_and_breaks_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("n", None), ("c", 2)], "k string, v int")
    assert [row.k for row in ranking.top(df, "v", "k").collect()] == ["n", "c", "a", "b"]


@pytest.mark.parametrize("copies", [1, 400])
def test_surrogate_key_is_dense_over_partitions(spark, settings, tmp_path, copies):
    """Ids of several partitions, with a third of the rows being copies of one."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    source = [(random.Random(7).randint(0, 50), i % 13) for i in range(800)] + [(5, 5)] * copies
    spark.createDataFrame(source, "a int, b int").repartition(3).write.parquet(str(tmp_path / "t"))
    df = read_parquet(spark, str(tmp_path / "t"), position=True)
    order = [F.desc("a"), F.asc("b"), *(F.asc(name) for name in POSITION)]
    numbered = keys.surrogate_key(df, "id", order).orderBy("id").collect()
    assert [row.id for row in numbered] == list(range(1, len(source) + 1))
    assert [(row.a, row.b) for row in numbered] == sorted(source, key=lambda row: (-row[0], row[1]))


def test_surrogate_key_orders_nulls_and_types(spark):
    """NULLs first in both directions, over dates, decimals, timestamps and texts; an empty table has no ids."""
    rng = random.Random(3)
    values = [["2024-01-31", "2024-02-01"], ["1.50", "-2.25"], ["2024-01-01 10:00:00.000001"], ['q"\\', "ñ"]]
    rows = [(*(rng.choice([None, *some]) for some in values), i) for i in range(500)]
    df = spark.createDataFrame(rows, "d string, n string, t string, s string, i int").selectExpr(
        "cast(d AS date) AS d", "cast(n AS decimal(18,2)) AS n", "cast(t AS timestamp) AS t", "s", "i"
    )
    order = [F.desc_nulls_first("d"), F.asc_nulls_first("n"), F.desc_nulls_first("t"), F.asc_nulls_first("s"), F.desc("i")]
    found = keys.surrogate_key(df.repartition(5), "id", order, start=10).orderBy("id").collect()
    wanted = df.coalesce(1).sortWithinPartitions(*order).collect()
    assert [tuple(row)[1:] for row in found] == [tuple(row) for row in wanted]
    assert [row.id for row in found] == list(range(10, 510))
    assert keys.surrogate_key(df.limit(0), "id", order).collect() == []


def test_range_partitions_split_copies(spark, settings, tmp_path):
    """The row position spreads equal rows over tasks."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    spark.range(4000).select(F.lit(1).alias("a")).coalesce(2).write.parquet(str(tmp_path / "t"))
    df = read_parquet(spark, str(tmp_path / "t"), position=True)
    spread = df.repartitionByRange(F.asc("a"), *(F.asc(name) for name in POSITION))
    sizes = [row["count"] for row in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000


@pytest.mark.parametrize("hot", ["k7", None])
def test_hot_key_is_split_at_run_time(spark, settings, hot):
    """A lookup by sorted partitions with a third of the facts on one key, or without a key."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    facts = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("k"), F.col("id") % 2000)).alias("k"),
        F.col("id").alias("v"),
    )
    dim = spark.range(0, 1500).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("x").alias("name"))
    joined = lookups.known_or_null(facts, dim, "k", "k")
    collected = joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    wanted = sum(1 for i in range(60000) if (hot is not None if i % 3 == 0 else i % 2000 < 1500))
    assert len(collected) == 60000 and sum(row.k is not None for row in collected) == wanted


def test_hot_key_of_an_anti_join_is_split(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    left = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 2000).alias("k"), F.col("id").alias("v")
    )
    kept = lookups.not_in(left, spark.range(60000).select((F.col("id") % 1500).alias("r")), "k", "r")
    collected = kept.collect()
    assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    assert len(collected) == sum(1 for i in range(60000) if i % 3 == 0 or i % 2000 >= 1500)


def test_latest_row_is_chosen_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    best = ranking.first_per_group(df, ["g"], [F.desc("v")])
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert rows(best) == [(0, 999), (1, 997), (2, 998)]


def test_shares_add_up_and_spread(spark):
    stock = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("n", None)], "k string, v double")
    shared = shares.share_of_total(stock, "v", "share")
    assert rows(shared.select("k", "share")) == [("a", 0.25), ("b", 0.75), ("n", None)]
    ahead = spark.createDataFrame([("2024-01-01", 8.0), ("2024-02-01", -8.0)], "ds string, yhat double")
    spread = shares.spread_over_shares(ahead, shared.filter("share is not null"), "share", "k", rows=1)
    assert rows(spread) == [("a", "2024-02-01", -2.0), ("b", "2024-01-01", 6.0)]


def test_equal_shares_are_ranked_by_item(spark):
    equal = spark.createDataFrame([(f"i{i:02d}", 1 / 16) for i in range(16)], "k string, share double")
    ahead = spark.createDataFrame([("2024-01-01", 16.0)], "ds string, yhat double")
    spread = shares.spread_over_shares(ahead, equal, "share", "k")
    assert [row[0] for row in rows(spread)] == [f"i{i:02d}" for i in range(15)]


def test_attach_to_few_keeps_unknown_and_repeated_keys(spark):
    dim = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, name string")
    few = spark.createDataFrame([("a", 3), ("a", 2), ("x", 1)], "k string, v int").orderBy(F.desc("v")).limit(3)
    assert rows(lookups.attach_to_few(few, dim, "k", ["name"])) == [("a", 2, "A"), ("a", 3, "A"), ("x", 1, None)]
