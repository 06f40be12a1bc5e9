"""Silver tables to dimensions and facts: catalogue columns leave the facts, unknown references become NULL.

No row is lost or multiplied on the way; ``abasto.plans.build`` checks the keys before it publishes a layer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abasto.operators.keys import surrogate_key
from abasto.operators.lookups import known_or_null, mark_known
from abasto.plans.silver import keep_declared
from abasto.schemas import columns_of
from abasto.sources.tables import POSITION

# The order in which receipts get their ids: latest first, ties by what identifies the movement.
RECEIPT_ORDER = ["solnum", "solord", "solcan", "solpre", "artcitem"]

# References of receipts, and the flags that say whether they are known.
KNOWN = {"solnum": "_known_request", "artcitem": "_known_item"}


def groups(silver_groups: DataFrame) -> DataFrame:
    return keep_declared(silver_groups, "normalizado", "grupos")


def suppliers(silver_suppliers: DataFrame) -> DataFrame:
    return keep_declared(silver_suppliers, "normalizado", "proveedores")


def items(silver_items: DataFrame, silver_groups: DataFrame) -> DataFrame:
    """Items of an unknown group keep their row and lose the group."""
    known = known_or_null(silver_items, silver_groups, "artgrinv", "artgrinv")
    return keep_declared(known, "normalizado", "maestro_articulos")


def requests(silver_requests: DataFrame, items: DataFrame, suppliers: DataFrame) -> DataFrame:
    known = known_or_null(silver_requests, items, "artcitem", "artcitem")
    known = known_or_null(known, suppliers, "solpro", "acrecodi")
    return keep_declared(known, "normalizado", "fact_solicitudes")


def receipt_order(columns: Sequence[str], values: Mapping[str, Column] | None = None):
    """Total order of receipts; the row position, where it is there, tells copies apart.

    ``values`` are the receipt's columns where rows with ``columns`` have them as expressions.
    """
    value = {name: F.col(name) for name in ("nrcfec", "nrcnum", *RECEIPT_ORDER)} | dict(values or {})
    return [
        F.desc_nulls_first(value["nrcfec"]),
        F.desc_nulls_first(value["nrcnum"]),
        *(F.asc_nulls_first(value[name]) for name in RECEIPT_ORDER),
        *(F.asc(name) for name in POSITION if name in columns),
    ]


def receipts(
    silver_receipts: DataFrame,
    requests: DataFrame | None,
    items: DataFrame | None,
    values: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Receipts with an id of their own; unknown requests and items become NULL, the supplier code stays.

    References are resolved first, so the rows stay in the order of their ids, the latest date first: readers of recent
    months can skip the rest. The order is that of the recorded codes, which are the only ones that travel: one flag a
    reference says whether it is known.

    ``values`` are the silver columns as expressions over ``silver_receipts``, where those rows are narrower; they are
    exchanged and staged as given, and the columns made from the numbered rows. Without ``requests`` or ``items`` the
    rows have the flag of that reference already.
    """
    value = {name: F.col(name) for name in silver_receipts.columns} if values is None else dict(values)
    marked = silver_receipts
    for name, dim in (("solnum", requests), ("artcitem", items)):
        if dim is not None:
            marked = mark_known(marked, dim, name if values is None else value[name], name, KNOWN[name])
    numbered = surrogate_key(marked, "id_recepcion", receipt_order(marked.columns, value))
    resolved = {name: F.when(F.col(flag), value[name]) for name, flag in KNOWN.items()}
    declared = value | resolved | {"id_recepcion": F.col("id_recepcion")}
    return numbered.select(*(declared[name].alias(name) for name in columns_of("normalizado", "fact_recepcion")))


def receipts_without_id(
    silver_receipts: DataFrame, requests: DataFrame | None = None, items: DataFrame | None = None
) -> DataFrame:
    """The references of receipts, resolved against the dimensions given."""
    known = silver_receipts
    if requests is not None:
        known = known_or_null(known, requests, "solnum", "solnum")
    if items is not None:
        known = known_or_null(known, items, "artcitem", "artcitem")
    return known


def stock(silver_stock: DataFrame) -> DataFrame:
    return keep_declared(silver_stock, "normalizado", "fact_stock")
