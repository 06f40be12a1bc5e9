"""The three phases of a build, each with its analysis, its load, its verification, and the findings of both.

A phase writes every finding in long form to ``findings/<phase>/<section>`` as JSON lines. The load of a phase stops
before it becomes current where declared keys are violated; what the analysis found until then is stored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from abasto.operators import keys
from abasto.plans import build, gold, quality, reconcile
from abasto.schemas import GOLD, NORMALIZED, PRIMARY_KEYS, SILVER
from abasto.sources.tables import Warehouse, findings, save_findings, union_all

# The silver table that a normalized fact comes from.
SILVER_OF = {"fact_solicitudes": "solicitudes", "fact_recepcion": "recepcion", "fact_stock": "articulos"}


class Report:
    """Findings of one phase."""

    def __init__(self, folder: str, phase: str):
        self.folder = f"{folder.rstrip('/')}/{phase}"

    def add(self, section: str, df: DataFrame, object_column: str, *values: str) -> None:
        save_findings(findings(df, section, object_column, values), f"{self.folder}/{section}")


def _stored(warehouse: Warehouse, layer: str, tables) -> dict[str, DataFrame]:
    layer_now = warehouse.snapshot(layer)
    return {table: layer_now.table(table) for table in tables}


def _uniqueness(tables: Mapping[str, DataFrame], layer: str) -> DataFrame:
    single = {table: columns[0] for table, columns in PRIMARY_KEYS[layer].items() if len(columns) == 1 and table in tables}
    return union_all([keys.uniqueness(tables[table], key, table) for table, key in single.items()])


def silver_phase(warehouse: Warehouse, bronze: Mapping[str, DataFrame], folder: str, mode: str = "strict") -> None:
    """Profile of the raw tables and their duplicates; typed load; keys and references of what is stored."""
    report = Report(folder, "silver")
    report.add("profile", quality.profiles(bronze), "table_name", "column_name", "metric", "value", "pct")
    copies = [quality.full_row_duplicates(bronze[name], name) for name in ("recepcion", "articulos")]
    report.add("full_row_duplicates", union_all(copies), "table_name", "duplicate_rows")
    for table, key in (("recepcion", "solnum"), ("articulos", "artcitem")):
        report.add(f"repeated_keys_{table}", quality.top_repeated_keys(bronze[table], key), key, "n_rows")
    build.build_silver(warehouse, bronze, mode)
    stored = _stored(warehouse, "silver", SILVER)
    report.add("uniqueness", _uniqueness(stored, "silver"), "table_name", "total", "distinct_keys", "surplus")
    report.add("integrity", quality.integrity(stored), "check_name", "value", "flag")
    report.add("constraints", build.constraint_violations(warehouse, "silver"), "table_name", "rule", "violating_rows")


def normalized_phase(warehouse: Warehouse, folder: str) -> None:
    """What the silver facts repeat of the catalogue; load of dimensions and facts; references and row counts."""
    report = Report(folder, "normalizado")
    silver = _stored(warehouse, "silver", SILVER)
    items = silver["maestro_articulos"]
    repeated = union_all([quality.redundancy(silver[name], items, name) for name in ("recepcion", "solicitudes")])
    report.add("redundancy", repeated, "table_name", "column_name", "matching", "total", "pct")
    report.add("mismatches", quality.mismatches(silver["articulos"], items), "column_name", "different")
    build.build_normalized(warehouse)
    stored = _stored(warehouse, "normalizado", NORMALIZED)
    report.add("null_references", quality.null_references(stored), "table_name", "column_name", "nulls")
    named = {SILVER_OF.get(table, table): df for table, df in stored.items()}
    counts = quality.layer_row_counts({"silver": silver, "normalizado": named}, ["silver", "normalizado"])
    report.add("row_counts", counts, "table_name", "silver_rows", "normalizado_rows")
    report.add("constraints", build.constraint_violations(warehouse, "normalizado"), "table_name", "rule", "violating_rows")


def gold_phase(warehouse: Warehouse, folder: str, expected: Mapping[str, int] | None = None) -> DataFrame:
    """Load of the gold tables; each is computed again and compared with what is stored. Gives the verdicts.

    ``expected`` has the row counts that are known from elsewhere.
    """
    report = Report(folder, "gold")
    build.build_gold(warehouse)
    stored = _stored(warehouse, "gold", GOLD)
    metrics, demand = "metricas_prediccion_proveedor", "prediccion_demanda_mensual"
    again = gold.supplier_metrics(
        warehouse.table("normalizado", "fact_recepcion"), warehouse.table("normalizado", "proveedores")
    )
    demand_again = gold.monthly_demand(warehouse.table("silver", "recepcion"), warehouse.table("silver", "grupos"))
    compared = {
        metrics: reconcile.compare_by_digests(stored[metrics], again, reconcile.METRICS_GRAIN, reconcile.METRICS_MEASURES),
        demand: reconcile.compare_by_digests(stored[demand], demand_again, reconcile.DEMAND_GRAIN, reconcile.DEMAND_MEASURES),
    }
    verdicts = union_all(
        [reconcile.verdict(counts, name, (expected or {}).get(name)) for name, counts in compared.items()]
    )
    values = ("stored", "computed", "missing", "extra", "different", "expected", "exact")
    report.add("reconciliation", verdicts, "table_name", *values)
    return verdicts


def run(
    warehouse: Warehouse,
    bronze: Mapping[str, DataFrame],
    folder: str,
    mode: str = "strict",
    expected: Mapping[str, int] | None = None,
) -> DataFrame:
    """All three phases in order; gives the verdicts of the last."""
    silver_phase(warehouse, bronze, folder, mode)
    normalized_phase(warehouse, folder)
    return gold_phase(warehouse, folder, expected)
