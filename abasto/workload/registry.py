"""Named queries: a Spark plan over one folder of tables, and the DuckDB SQL it has to agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abasto.workload.bindings import Tables
from abasto.workload.oracle import sql


@dataclass(frozen=True)
class Query:
    name: str
    plan: Callable[[Tables], DataFrame]
    oracle: str | None
    rounded: dict[str, int] = field(default_factory=dict)

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return comparable(self.plan(Tables(spark, folder)), self.rounded)


QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None, **rounded: int):
    """Register a plan. ``rounded`` gives the places to which columns are rounded before they are compared."""

    def register(plan):
        if name in QUERIES:
            raise ValueError(f"query {name} is there already")
        QUERIES[name] = Query(name, plan, None if oracle is None else sql(oracle), rounded)
        return plan

    return register


def comparable(df: DataFrame, rounded: dict[str, int]) -> DataFrame:
    """Decimals as doubles and the given columns rounded, so that two engines print the same values."""
    columns = []
    for column in df.schema:
        value = F.col(column.name)
        if isinstance(column.dataType, T.DecimalType):
            value = value.cast("double")
        if column.name in rounded:
            value = F.round(value, rounded[column.name])
        columns.append(value.alias(column.name))
    return df.select(*columns)


def doubles(names: str, prefix: str = "") -> str:
    """SQL select items that turn decimals into doubles."""
    return ", ".join(f"CAST({prefix}{name} AS DOUBLE) AS {name}" for name in names.split())
