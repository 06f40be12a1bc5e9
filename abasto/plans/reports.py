"""Reporting queries over the normalized tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abasto.functions.measures import exact_mean, month_of
from abasto.operators.lookups import attach_to_few, lookup, not_in
from abasto.operators.ranking import top
from abasto.operators.shares import share_of_total
from abasto.sources.tables import MONTH_PART, union_all

# Fixed value: the label of items without a known group.
NO_GROUP = "(sin grupo)"


def kpis(requests: DataFrame, receipts: DataFrame, items: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Four headline counts, one row each."""
    counts = [
        requests.agg(F.count("*").alias("total")).select(F.lit("solicitudes").alias("indicador"), "total"),
        receipts.agg(F.count("*").alias("total")).select(F.lit("recepciones").alias("indicador"), "total"),
        items.agg(F.count_distinct("artcitem").alias("total")).select(F.lit("articulos").alias("indicador"), "total"),
        suppliers.agg(F.count("*").alias("total")).select(F.lit("proveedores").alias("indicador"), "total"),
    ]
    return union_all(counts)


def items_by_group(items: DataFrame, groups: DataFrame) -> DataFrame:
    """Distinct items per group name."""
    named = lookup(items, groups, "artgrinv", "artgrinv", ["nombre"])
    counted = named.groupBy(F.coalesce("nombre", F.lit(NO_GROUP)).alias("grupo")).agg(
        F.count_distinct("artcitem").alias("cantidad")
    )
    return top(counted, "cantidad", "grupo")


def requests_monthly(requests: DataFrame) -> DataFrame:
    """Requests, quantity and mean price by month."""
    return (
        requests.filter(F.col("solfec").isNotNull())
        .groupBy(month_of("solfec").alias("mes"))
        .agg(
            F.count("*").alias("cantidad"),
            F.sum("solcan").alias("total_cantidad"),
            exact_mean("solpre").alias("precio_promedio"),
        )
        .orderBy(F.asc_nulls_last("mes"))
    )


def receipts_monthly(receipts: DataFrame) -> DataFrame:
    """Receipts, received quantity and mean price by month."""
    return (
        receipts.filter(F.col("nrcfec").isNotNull())
        .groupBy(month_of("nrcfec").alias("mes"))
        .agg(
            F.count("*").alias("recepciones"),
            F.sum("nrdcac").alias("total_recibido"),
            exact_mean("solpre").alias("precio_promedio"),
        )
        .orderBy(F.asc_nulls_last("mes"))
    )


def top_items(requests: DataFrame, items: DataFrame, rows: int = 15) -> DataFrame:
    """Most requested items. The description is looked up for the winners only."""
    counted = (
        requests.filter(F.col("artcitem").isNotNull())
        .groupBy("artcitem")
        .agg(F.count("*").alias("veces_solicitado"), F.sum("solcan").alias("total_cantidad"))
    )
    best = top(counted, "veces_solicitado", "artcitem", rows=rows)
    described = attach_to_few(best, items, "artcitem", ["artdes"])
    return top(described.select("artcitem", "artdes", "veces_solicitado", "total_cantidad"), "veces_solicitado", "artcitem")


def top_suppliers(receipts: DataFrame, suppliers: DataFrame, rows: int = 10) -> DataFrame:
    """Suppliers by requested quantity. Suppliers of the same name count as one, as in the established report."""
    per_code = (
        receipts.filter(F.col("solpro").isNotNull())
        .groupBy("solpro")
        .agg(F.count("*").alias("_receipts"), F.sum("solcan").alias("_quantity"))
    )
    named = lookup(per_code, suppliers, "solpro", "acrecodi", ["acreraso"], "inner")
    per_name = named.groupBy(F.col("acreraso").alias("proveedor")).agg(
        F.sum("_receipts").alias("recepciones"), F.sum("_quantity").alias("cantidad_total")
    )
    return top(per_name, "cantidad_total", "proveedor", rows=rows)


def top_stock(stock: DataFrame, items: DataFrame, rows: int = 20) -> DataFrame:
    """Item locations with the most stock, ties by item and location."""
    held = stock.filter(F.col("ubistock").isNotNull()).select("artcitem", "ubialm", "ubistock")
    best = top(held, "ubistock", "artcitem", "ubialm", rows=rows)
    described = attach_to_few(best, items, "artcitem", ["artdes"])
    return top(described.select("artcitem", "artdes", "ubialm", "ubistock"), "ubistock", "artcitem", "ubialm")


def items_by_unit(items: DataFrame) -> DataFrame:
    """Items per unit of measure."""
    counted = items.filter(F.col("artmed").isNotNull()).groupBy("artmed").agg(F.count("*").alias("cantidad"))
    return top(counted, "cantidad", "artmed")


def stock_monthly(receipts: DataFrame, series: tuple[str, ...] = ()) -> DataFrame:
    """The forecast series: recorded stock by month, for the whole or per ``series`` columns."""
    return (
        receipts.filter(F.col("nrcfec").isNotNull())
        .groupBy(*series, month_of("nrcfec").alias("ds"))
        .agg(F.sum("artstock").cast("double").alias("y"))
    )


def request_counts_monthly(requests: DataFrame, series: tuple[str, ...] = ()) -> DataFrame:
    """Number of requests by month, as a series."""
    return (
        requests.filter(F.col("solfec").isNotNull())
        .groupBy(*series, month_of("solfec").alias("ds"))
        .agg(F.count("*").cast("double").alias("y"))
    )


def trailing_year(receipts: DataFrame) -> DataFrame:
    """Receipts of the twelve months up to the latest receipt, the bound included.

    Where receipts come with the month they are stored by, the latest one is looked for in the last month, and months before
    the bound are not read.
    """
    by_month, newest = MONTH_PART in receipts.columns, receipts
    if by_month:
        newest = receipts.filter(F.col(MONTH_PART) == receipts.agg(F.max(MONTH_PART)).scalar())
    bound = F.add_months(newest.agg(F.max("nrcfec")).scalar(), -12)
    kept = receipts.filter(F.col("nrcfec") >= bound)
    return kept.filter(F.col(MONTH_PART) >= F.trunc(bound, "MM")).drop(MONTH_PART) if by_month else kept


def product_share(receipts: DataFrame, items: DataFrame, groups: DataFrame) -> DataFrame:
    """Each item's share of the stock recorded in the trailing year. Names and total come after the reduction."""
    recorded = trailing_year(receipts).filter(F.col("artstock").isNotNull())
    per_item = recorded.groupBy("artcitem").agg(F.sum("artstock").alias("stock_total"))
    shared = share_of_total(per_item, "stock_total", "participacion")
    described = lookup(shared, items, "artcitem", "artcitem", ["artdes", "artgrinv"])
    named = lookup(described, groups.withColumnRenamed("nombre", "grupo"), "artgrinv", "artgrinv", ["grupo"])
    return named.select("artcitem", "artdes", "grupo", "stock_total", "participacion")


def price_training_set(requests: DataFrame) -> DataFrame:
    """Dated requests with a price."""
    return requests.filter(F.col("solfec").isNotNull() & (F.col("solpre") > 0)).select("solfec", "solpre", "solcan")


def recent_receipts(receipts: DataFrame, items: DataFrame, months: int = 5) -> DataFrame:
    """Last months: distinct requests, received quantity and mean catalogue cost of the known items' receipts.

    The months that win are found first, from (item, month) pairs; then only their receipts are read, and reduced to
    (month, item, request) before they meet the catalogue.
    """
    dated = receipts.filter(F.col("nrcfec").isNotNull()).withColumn("mes", month_of("nrcfec"))
    pairs = dated.select("mes", "artcitem").distinct()
    known = lookup(pairs, items, "artcitem", "artcitem", [], "inner").select("mes").distinct()
    oldest = known.orderBy(F.desc("mes")).limit(months).agg(F.min("mes")).scalar()
    reduced = (
        dated.filter(F.col("nrcfec") >= oldest)
        .groupBy("mes", "artcitem", "solnum")
        .agg(F.sum("nrdcac").alias("_received"), F.count("*").alias("_rows"))
    )
    costed = lookup(reduced, items, "artcitem", "artcitem", ["artcosu1"], "inner")
    priced = F.when(F.col("artcosu1").isNotNull(), F.col("_rows"))
    cost = F.sum(F.col("artcosu1") * F.col("_rows").cast("decimal(18,0)")).cast("double")
    return (
        costed.groupBy("mes")
        .agg(
            F.count_distinct("solnum").alias("pedidos"),
            F.sum("_received").alias("recibido"),
            F.try_divide(cost, F.sum(priced).cast("double")).alias("costo_promedio"),
        )
        .orderBy(F.desc_nulls_first("mes"))
        .limit(months)
    )


def recent_demand(demand: DataFrame, months: int = 5) -> DataFrame:
    """Last months: distinct items and total demand."""
    return (
        demand.groupBy(month_of("periodo_mes").alias("mes"))
        .agg(F.count_distinct("artcitem").alias("articulos"), F.sum("cantidad_total_despachada").alias("demanda_total"))
        .orderBy(F.desc_nulls_first("mes"))
        .limit(months)
    )


def orphan_demand(demand: DataFrame, items: DataFrame) -> DataFrame:
    """Demand of items outside the catalogue, by the NULL rule of NOT IN."""
    return not_in(demand, items, "artcitem", "artcitem")
