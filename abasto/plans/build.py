"""Building the layers in order, each table written once from the stored tables before it.

A layer's tables become current together, after their declared keys, NOT NULL columns and references were checked; a
failure before that leaves the tables that were there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abasto.operators import keys
from abasto.plans import gold, normalized, silver
from abasto.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS
from abasto.sources.tables import Warehouse, staging, union_all


class ConstraintError(ValueError):
    """Rows that a declared key, NOT NULL column or reference forbids."""


def build_silver(warehouse: Warehouse, bronze: Mapping[str, DataFrame], mode: str = "strict") -> None:
    with warehouse.loading("silver"):
        for table, df in bronze.items():
            warehouse.load("silver", table, silver.clean(df, table, mode))
        require_constraints(warehouse, "silver", list(bronze))


def build_normalized(warehouse: Warehouse) -> None:
    """Dimensions first: facts refer to the stored ones. Staged rows stay below the warehouse and go in the end."""

    stored = warehouse.snapshot("silver").table
    with warehouse.loading("normalizado"), staging(warehouse.spark, warehouse.root):
        groups = warehouse.load("normalizado", "grupos", normalized.groups(stored("grupos")))
        suppliers = warehouse.load("normalizado", "proveedores", normalized.suppliers(stored("proveedores")))
        items = warehouse.load("normalizado", "maestro_articulos", normalized.items(stored("maestro_articulos"), groups))
        requests = warehouse.load(
            "normalizado", "fact_solicitudes", normalized.requests(stored("solicitudes"), items, suppliers)
        )
        receipts = normalized.receipts(stored("recepcion", position=True), requests, items)
        warehouse.load("normalizado", "fact_recepcion", receipts, month_of="nrcfec")  # they come in date order
        warehouse.load("normalizado", "fact_stock", normalized.stock(stored("articulos")))
        require_constraints(warehouse, "normalizado")


def build_gold(warehouse: Warehouse) -> None:
    """Supplier metrics from normalized receipts, demand from silver ones (their codes are the recorded ones)."""
    normal, silver_now = warehouse.snapshot("normalizado"), warehouse.snapshot("silver")
    with warehouse.loading("gold"):
        metrics = gold.supplier_metrics(normal.table("fact_recepcion"), normal.table("proveedores"))
        warehouse.load("gold", "metricas_prediccion_proveedor", metrics)
        demand = gold.monthly_demand(silver_now.table("recepcion"), silver_now.table("grupos"))
        warehouse.load("gold", "prediccion_demanda_mensual", demand)


def build_all(warehouse: Warehouse, bronze: Mapping[str, DataFrame], mode: str = "strict") -> None:
    """Bronze to gold. Stops with ``ConstraintError`` before a layer with forbidden rows becomes current."""
    build_silver(warehouse, bronze, mode)
    build_normalized(warehouse)
    build_gold(warehouse)


def constraint_violations(warehouse: Warehouse, layer: str, tables: Sequence[str] | None = None) -> DataFrame:
    """Number of violating rows of every declared key, NOT NULL column and (normalized layer) reference.

    A table's key and NOT NULL columns are checked in one pass over it.
    """
    checks, chosen = [], set(PRIMARY_KEYS[layer] if tables is None else tables)

    for table, columns in PRIMARY_KEYS[layer].items():
        if table in chosen:
            rules = {f"primary key ({', '.join(columns)})": "_key"}
            needed = NOT_NULL[layer].get(table, [])
            if needed:
                rules[f"not null ({', '.join(needed)})"] = "_null"
            counted = keys.violation_counts(warehouse.table(layer, table), columns, needed)
            entries = F.array(
                *(F.struct(F.lit(rule).alias("rule"), F.col(name).alias("violating_rows")) for rule, name in rules.items())
            )
            checks.append(counted.select(F.lit(table).alias("table_name"), F.inline(entries)))
    if layer == "normalizado":
        for table, column, dimension, key in FOREIGN_KEYS:
            if table in chosen:
                violating = keys.foreign_key_violations(
                    warehouse.table(layer, table), warehouse.table(layer, dimension), column, key
                )
                counted = violating.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("violating_rows"))
                rule = F.lit(f"{column} references {dimension}").alias("rule")
                checks.append(counted.select(F.lit(table).alias("table_name"), rule, "violating_rows"))
    return union_all(checks)


def require_constraints(warehouse: Warehouse, layer: str, tables: Sequence[str] | None = None) -> None:
    """Raise where rows violate a rule, with the table, the rule and the number of rows. Only counts are collected."""
    if not set(PRIMARY_KEYS[layer] if tables is None else tables) & set(PRIMARY_KEYS[layer]):
        return
    found = constraint_violations(warehouse, layer, tables).filter("violating_rows > 0").collect()
    if found:
        rules = "; ".join(f"{row.table_name}: {row.rule}: {row.violating_rows} rows" for row in found)
        raise ConstraintError(f"{layer}: {rules}")
