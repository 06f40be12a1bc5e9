"""An additive curve through each series: a trend that can bend, and a yearly pattern.

    y = intercept + slope * t + sum of change_j * max(t - bend_j, 0) + yearly Fourier terms

Time runs from 0 at the first month with a value to 1 at the last. Up to 25 bends stand evenly in the first 80 % of the
months. The yearly terms need two years of history; there is no weekly part. Changes of slope and amplitudes are held
back by a small ridge, so the normal equations always have one solution: products of columns are summed per series and
solved by elimination, in array columns, with the months of a series in one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abasto.functions.measures import let

# Number of bends and the part of the history they stand in; days from which there is a yearly pattern;
# days of a year; width of the 80 % band.
BENDS = 25
BEND_SHARE = 0.8
TWO_YEARS = 730
YEAR = 365.25
BAND_80 = 1.2816

# Penalties on intercept and slope, on changes of slope, on amplitudes, for values scaled to at most one.
FREE, RIDGE_BEND, RIDGE_YEAR = 1e-6, 0.01, 0.01


def dot(one: Column, other: Column) -> Column:
    return F.aggregate(F.zip_with(one, other, lambda a, b: a * b), F.lit(0.0), lambda total, value: total + value)


def solve(matrix: Column, size: Column) -> Column:
    """The solution of ``size`` equations given as rows with the right side last; every pivot is positive."""

    def step(rows: Column, k: Column) -> Column:
        pivot = F.transform(F.get(rows, k), lambda value: value / F.get(F.get(rows, k), k))
        return let(
            pivot,
            lambda row_k: F.transform(
                rows,
                lambda row, i: F.when(i == k, row_k).otherwise(
                    let(F.get(row, k), lambda factor: F.zip_with(row, row_k, lambda a, b: a - factor * b))
                ),
            ),
        )

    solved = F.aggregate(F.sequence(F.lit(0), size - 1), matrix, step)
    return F.transform(solved, lambda row: F.element_at(row, -1))


def _features(day: Column, order: int) -> Column:
    """What stands beside the coefficients on a day: from ``_first``, ``_span``, ``_bends`` and ``_yearly``."""
    t = F.date_diff(day, "_first") / F.col("_span")
    angle = F.lit(2 * pi / YEAR) * F.unix_date(day)
    waves = [wave(angle * k) for k in range(1, order + 1) for wave in (F.sin, F.cos)]
    yearly = F.when(F.col("_yearly"), F.array(*waves)).otherwise(F.array().cast("array<double>"))
    bends = F.transform("_bends", lambda bend: F.greatest(t - bend, F.lit(0.0)))
    return F.concat(F.array(F.lit(1.0), t.cast("double")), bends, yearly)


def fit(history: DataFrame, series: Sequence[str], bends: int, order: int, ridge_bend: float, ridge_year: float) -> DataFrame:
    """One row per series: its months with a value, its bends, its coefficients."""
    observed = F.sort_array(F.collect_list(F.when(F.col("y").isNotNull(), F.struct("ds", F.col("y").cast("double").alias("y")))))
    rows = history.groupBy(*series).agg(observed.alias("_points"), F.max("ds").alias("_end")).filter("_end IS NOT NULL")
    last = F.element_at("_points", -1)["ds"]
    rows = rows.withColumns(
        {
            "_n": F.size("_points"),
            "_first": F.when(F.size("_points") > 0, F.get("_points", F.lit(0))["ds"]),
            "_days": F.when(F.size("_points") > 0, F.date_diff(last, F.get("_points", F.lit(0))["ds"])),
            "_scale": F.coalesce(
                F.nullif(F.array_max(F.transform("_points", lambda point: F.abs(point["y"]))), F.lit(0.0)), F.lit(1.0)
            ),
        }
    )
    reach = F.floor(F.col("_n") * BEND_SHARE).cast("int")
    rows = rows.withColumns(
        {
            "_span": F.greatest(F.coalesce("_days", F.lit(0)), F.lit(1)),
            "_yearly": F.coalesce(F.col("_days") >= TWO_YEARS, F.lit(False)),
            "_reach": reach,
            "_count": F.least(F.lit(bends), F.greatest(reach - 1, F.lit(0))),
        }
    )
    place = lambda j: F.floor(j * (F.col("_reach") - 1) / F.col("_count") + 0.5).cast("int")
    day = lambda j: F.get("_points", place(j))["ds"]
    numbers = F.when(F.col("_count") > 0, F.sequence(F.lit(1), F.col("_count"))).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("_bends", F.transform(numbers, lambda j: F.date_diff(day(j), "_first") / F.col("_span")))

    size = 2 + F.size("_bends") + F.when(F.col("_yearly"), 2 * order).otherwise(0)
    rows = rows.withColumn("_size", size).withColumn(
        "_rows",
        F.transform("_points", lambda p: F.concat(_features(p["ds"], order), F.array(p["y"] / F.col("_scale")))),
    )
    columns = F.transform(F.sequence(F.lit(0), F.col("_size")), lambda j: F.transform("_rows", lambda row: F.get(row, j)))
    penalty = lambda i: (
        F.when(i < 2, FREE).when(i < 2 + F.size("_bends"), ridge_bend).otherwise(ridge_year)
    )
    normal = let(
        columns,
        lambda found: F.transform(
            F.slice(found, 1, F.col("_size")),
            lambda one, i: F.transform(found, lambda other, j: dot(one, other) + F.when(i == j, penalty(i)).otherwise(0.0)),
        ),
    )
    rows = rows.withColumn("_normal", normal)
    return rows.withColumn("_weights", solve(F.col("_normal"), F.col("_size")))


def additive_curve(
    history: DataFrame,
    series: Sequence[str] = (),
    horizon: int = 6,
    bends: int = BENDS,
    order: int = 6,
    ridge_bend: float = RIDGE_BEND,
    ridge_year: float = RIDGE_YEAR,
) -> DataFrame:
    """The curve for the observed and the coming months, with an 80 % band of the residuals' deviation.

    ``order`` counts the yearly waves: with monthly values those beyond six repeat slower ones. A series without any value
    is flat at zero. The curve is not floored.
    """
    fitted = fit(history, series, bends, order, ridge_bend, ridge_year)
    empty = F.col("_n") == 0
    scaled = lambda day: F.when(empty, 0.0).otherwise(dot(_features(day, order), F.col("_weights")) * F.col("_scale"))
    known = F.transform("_points", lambda p: F.struct(p["ds"].alias("ds"), scaled(p["ds"]).alias("yhat"), p["y"].alias("y")))
    coming = F.transform(
        F.sequence(F.lit(1), F.lit(horizon)),
        lambda step: let(
            F.add_months("_end", step), lambda day: F.struct(day.alias("ds"), scaled(day).alias("yhat"), F.lit(None).cast("double").alias("y"))
        ),
    )
    residuals = F.transform("_known", lambda point: point["y"] - point["yhat"])
    mean = lambda values: F.aggregate(values, F.lit(0.0), lambda a, b: a + b) / F.greatest(F.size(values), F.lit(1))
    band = let(residuals, lambda r: let(mean(r), lambda m: F.sqrt(mean(F.transform(r, lambda x: (x - m) * (x - m)))) * BAND_80))
    rows = fitted.select(*series, "_end", known.alias("_known"), coming.alias("_coming"))
    rows = rows.withColumn("_band", band).select("*", F.inline(F.concat("_known", "_coming")))
    return rows.select(
        *series,
        "ds",
        "yhat",
        (F.col("yhat") - F.col("_band")).alias("yhat_lower"),
        (F.col("yhat") + F.col("_band")).alias("yhat_upper"),
        (F.col("ds") > F.col("_end")).alias("is_future"),
    )
