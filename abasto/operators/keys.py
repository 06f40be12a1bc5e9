"""Key checks and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abasto.operators.lookups import orphan_keys
from abasto.sources.tables import stage


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that are NULL in part or occur more than once, with their number of rows."""
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    counted = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counted.filter((F.col("n_rows") > 1) | any_null)


def violation_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """One row: ``_key``, rows whose key is NULL in part or not their own; ``_null``, rows with a NULL in ``columns``."""
    any_null, missing = F.lit(False), F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    for name in columns:
        missing = missing | F.col(name).isNull()
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.count_if(missing).alias("_m"))
    return counted.agg(
        F.coalesce(F.sum(F.when((F.col("_n") > 1) | any_null, F.col("_n"))), F.lit(0)).alias("_key"),
        F.coalesce(F.sum("_m"), F.lit(0)).alias("_null"),
    )


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in a column that may not have one, and the names of those columns."""
    names = F.concat_ws(",", *(F.when(F.col(name).isNull(), name) for name in columns))
    return df.withColumn("null_columns", names).filter(F.col("null_columns") != "")


def foreign_key_violations(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Key values that the referenced table lacks, with their number of rows. NULL passes."""
    return orphan_keys(df.filter(F.col(key).isNotNull()), dim, key, dim_key)


def uniqueness(df: DataFrame, key: str, name: str) -> DataFrame:
    """One row: rows, distinct keys, and the surplus; a row with a NULL key counts as surplus."""
    counted = df.groupBy(key).agg(F.count("*").alias("_n"))
    return counted.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.count(key).alias("distinct_keys")
    ).select(
        F.lit(name).alias("table_name"), "total", "distinct_keys", (F.col("total") - F.col("distinct_keys")).alias("surplus")
    )


def surrogate_key(df: DataFrame, name: str, order_by: Sequence[Column], start: int = 1) -> DataFrame:
    """Dense ids ``start, start + 1, ...`` in the given order, without gathering the rows in one task.

    Rows are range-partitioned and sorted, written once to the shared folder with their place in their partition, and
    the partition sizes give the first id of each partition. The staged write fixes the range bounds: computed twice
    they could differ. The order has to tell rows apart for an even spread; where copies of a row are possible, end it
    with the row position (``abasto.sources.tables.POSITION``), which splits even a large group of copies.
    """
    local_bits = 33  # monotonically_increasing_id keeps the place in the partition in its low 33 bits
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    placed = stage(ordered.withColumn("_place", F.monotonically_increasing_id()), f"{name}-order", compression="zstd")
    partition = F.shiftright("_place", local_bits)
    local = F.col("_place").bitwiseAND(F.lit((1 << local_bits) - 1))
    # One row per range partition: a few thousand at most.
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(partition.alias("_partition")).agg(F.count("*").alias("_size"))
    offsets = sizes.select("_partition", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.join(F.broadcast(offsets), partition == F.col("_partition"))
    return numbered.select((F.col("_offset") + local + start).alias(name), *df.columns)
