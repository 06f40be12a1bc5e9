"""Share of a total, and spreading totals over shares."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abasto.operators.ranking import top_per_group


def share_of_total(df: DataFrame, measure: str, name: str) -> DataFrame:
    """Measure over its total, as a double; NULL measures add nothing. The total is a one-row subquery over ``df``."""
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(name, F.try_divide(F.col(measure).cast("double"), total.cast("double")))


def spread_over_shares(
    forecast: DataFrame,
    shares: DataFrame,
    share: str,
    key: str,
    columns: Sequence[str] = (),
    rows: int = 15,
    floor: float | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Every month's total times every share, and of each month the largest ``rows``.

    A month's estimates are in the order of the shares (total above zero), in the opposite one (below), all equal
    (zero), or all NULL. So the few rows that can win are picked from the shares once, whatever the number of months, and
    only those meet the months, which arrive as one array value. ``by`` names columns of the forecast that tell several
    series apart. A negative total puts the smallest shares first, unless ``floor`` lifts it.
    """
    if floor is not None:
        forecast = forecast.withColumn("yhat", F.greatest("yhat", F.lit(float(floor))))
    months = forecast.agg(F.array_sort(F.collect_list(F.struct(*by, "ds", "yhat")))).scalar()
    first = F.asc_nulls_last(key)
    orders = [[F.desc_nulls_last(share), first], [F.asc_nulls_last(share), first], [F.isnull(share), first], [first]]
    few = [shares.select(key, *columns, share).orderBy(*order).limit(rows) for order in orders]
    estimated = (
        functools.reduce(DataFrame.union, few)
        .distinct()
        .withColumn("_month", F.explode(months))
        .select(
            key, *columns, *(F.col(f"_month.{name}").alias(name) for name in by), F.col("_month.ds").alias("mes"),
            (F.col(share) * F.col("_month.yhat")).alias("cantidad_estimada"),
        )
    )
    best = top_per_group(estimated, [*by, "mes"], [F.desc_nulls_last("cantidad_estimada"), first], rows)
    return best.select(*by, key, *columns, "mes", "cantidad_estimada")
