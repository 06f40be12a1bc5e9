"""Latest row, top rows and top rows per group, with every tie broken."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, groups: Sequence[str | Column], order_by: Sequence[Column]) -> DataFrame:
    """One row per group. Spark keeps the best row per group in every task before it shuffles."""
    return top_per_group(df, groups, order_by, 1)


def top_per_group(df: DataFrame, groups: Sequence[str | Column], order_by: Sequence[Column], rows: int) -> DataFrame:
    window = Window.partitionBy(*groups).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= rows).drop("_rank")


def top(df: DataFrame, measure: str, *ties: str, rows: int | None = None) -> DataFrame:
    """Largest measure first, NULL measures ahead of all, ties by the given columns."""
    ordered = df.orderBy(F.desc_nulls_first(measure), *(F.asc_nulls_last(tie) for tie in ties))
    return ordered if rows is None else ordered.limit(rows)


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows. NULL is a key value like any other."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)
