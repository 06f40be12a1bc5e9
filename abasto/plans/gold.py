"""Supplier metrics and monthly item demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abasto.functions.measures import exact_mean, month_of
from abasto.operators.lookups import lookup
from abasto.operators.ranking import first_per_group

# Ties on date and receipt number: what identifies the movement, then the stock itself.
STOCK_TIES = ["solnum", "solord", "solcan", "solpre", "artstock"]


def supplier_metrics(receipts: DataFrame, suppliers: DataFrame, quantity: str = "solcan") -> DataFrame:
    """Per known supplier: receipts, mean and sample deviation of the lead time in days, and quantity.

    Receipts are reduced to one row per supplier code before the (unique) supplier keys are joined. The quantity is
    the requested one by default, as in the established tables; pass ``nrdcac`` for the received one. Mean and
    deviation come from exact sums, so they do not depend on how the receipts are dealt to tasks.
    """
    days = F.datediff("nrcfec", "solfec").cast("bigint")
    per_code = (
        receipts.filter(F.col("nrcfec").isNotNull() & F.col("solfec").isNotNull() & F.col("solpro").isNotNull())
        .groupBy("solpro")
        .agg(
            F.count("*").alias("total_atenciones"),
            F.sum(days).cast("decimal(19,0)").alias("_days"),
            F.sum(days * days).cast("decimal(19,0)").alias("_squares"),
            F.sum(quantity).alias("volumen_total_suministrado"),
        )
    )
    known = per_code.join(suppliers.select("acrecodi"), F.col("solpro") == F.col("acrecodi"), "inner")
    n = F.col("total_atenciones").cast("decimal(18,0)")
    spread = (n * F.col("_squares") - F.col("_days") * F.col("_days")).cast("double")
    pairs = (n * (n - 1)).cast("double")
    return known.select(
        F.col("acrecodi").alias("proveedor_id"),
        "total_atenciones",
        (F.col("_days").cast("double") / n.cast("double")).alias("lead_time_promedio_dias"),
        F.when(n > 1, F.sqrt(spread / pairs)).alias("desviacion_lead_time"),
        "volumen_total_suministrado",
    )


def _closing_first() -> list[Column]:
    """The order in which the receipt that closes a month comes first."""
    return [
        F.desc_nulls_first("nrcfec"),
        F.desc_nulls_first("nrcnum"),
        *(F.asc_nulls_first(name) for name in STOCK_TIES),
    ]


def latest_stock(receipts: DataFrame) -> DataFrame:
    """The receipt that closes each (item, month): last date, then highest number (a missing number first)."""
    dated = receipts.filter(F.col("nrcfec").isNotNull() & F.col("artstock").isNotNull())
    return first_per_group(dated.withColumn("mes", month_of("nrcfec")), ["artcitem", "mes"], _closing_first())


def demand(receipts: DataFrame, groups: DataFrame, quantity: str = "solcan") -> DataFrame:
    """Per (item, group, month): quantity, distinct requests, mean price and the closing stock of the item in the month.

    Receipts are exchanged once, by item and month: what closes the month is found there, and the sums need no exchange of
    their own. Receipts without an item have no closing stock. Group names join after the reduction.
    """
    order = [F.asc(F.col("artstock").isNull()), *_closing_first()]
    closing = F.first("artstock").over(Window.partitionBy("artcitem", "mes").orderBy(*order))
    dated = receipts.filter(F.col("nrcfec").isNotNull()).withColumn("mes", month_of("nrcfec"))
    reduced = (
        dated.withColumn("_closing", closing)
        .groupBy("artcitem", "artgrinv", "mes")
        .agg(
            F.sum(quantity).alias("cantidad"),
            F.count_distinct("solnum").alias("frecuencia"),
            exact_mean("solpre").alias("precio"),
            F.max(F.when(F.col("artcitem").isNotNull(), F.col("_closing"))).alias("ultimo_stock"),
        )
    )
    return lookup(reduced, groups.withColumnRenamed("nombre", "grupo_nombre"), "artgrinv", "artgrinv", ["grupo_nombre"])


def with_latest_stock(demand: DataFrame, stock: DataFrame) -> DataFrame:
    """Demand rows with the closing stock of their (item, month); rows without one, or without an item, stay."""
    closing = stock.select(
        F.col("artcitem").alias("_item"), F.col("mes").alias("_mes"), F.col("artstock").alias("ultimo_stock")
    )
    on = (F.col("artcitem") == F.col("_item")) & (F.col("mes") == F.col("_mes"))
    return demand.join(closing, on, "left").drop("_item", "_mes")


def monthly_demand(receipts: DataFrame, groups: DataFrame, quantity: str = "solcan") -> DataFrame:
    """Monthly item demand, from silver receipts: their request and item codes are still the recorded ones."""
    return demand(receipts, groups, quantity).select(
        "artcitem",
        "artgrinv",
        "grupo_nombre",
        F.col("mes").cast("timestamp").alias("periodo_mes"),
        F.col("cantidad").alias("cantidad_total_despachada"),
        F.col("frecuencia").alias("frecuencia_pedidos"),
        F.col("precio").alias("precio_promedio_pactado"),
        F.col("ultimo_stock").alias("ultimo_stock_registrado"),
    )
