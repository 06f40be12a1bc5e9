"""Monthly forecasts for one series or for many at once.

A series is ``(series columns..., ds, y)``: at most one row per month, months without data are missing rows, and the
series columns may be none. Frames here are already reduced to months, so a partition of one series is as long as its
calendar. Months with a NULL value are left out of a fit, but a forecast begins after the last month of the series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abasto.plans.curve import additive_curve
from abasto.plans.network import network_forecast
from abasto.sources.tables import stage

# Months ahead, lags, and the width of the band (95 % of a normal distribution).
HORIZON = 6
LAGS = 12
BAND_95 = 1.96


def _partition(series: Sequence[str]):
    """Window partition of a series; the single series is one constant partition of a few hundred months."""
    return Window.partitionBy(*(series or [F.lit(0)]))


def future_months(history: DataFrame, series: Sequence[str] = (), horizon: int = HORIZON) -> DataFrame:
    """The months after the last observed one."""
    last = history.groupBy(*series).agg(F.max("ds").alias("_last"))
    months = F.sequence(F.add_months("_last", 1), F.add_months("_last", horizon), F.expr("INTERVAL 1 MONTH"))
    return last.filter(F.col("_last").isNotNull()).select(*series, F.explode(months).alias("ds"))


def fill_missing_months(history: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Every month between first and last, with zero where nothing was recorded."""
    span = history.groupBy(*series).agg(F.min("ds").alias("_first"), F.max("ds").alias("_last"))
    months = F.sequence("_first", "_last", F.expr("INTERVAL 1 MONTH"))
    calendar = span.filter(F.col("_first").isNotNull()).select(*series, F.explode(months).alias("ds"))
    return calendar.join(history, [*series, "ds"], "left").fillna(0.0, ["y"])


def _trend(history: DataFrame, series: Sequence[str]) -> DataFrame:
    """Least-squares line of every series beside its rows; positions count the months with a value, from zero.

    A one-month series is its own flat line, one without any value is flat at zero.
    """
    whole = _partition(series)
    so_far = F.count("y").over(whole.orderBy("ds").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        history.withColumn("_t", F.when(F.col("y").isNotNull(), so_far - 1).cast("double"))
        .withColumn("_slope", F.coalesce(F.regr_slope("y", "_t").over(whole), F.lit(0.0)))
        .withColumn("_intercept", F.coalesce(F.regr_intercept("y", "_t").over(whole), F.max("y").over(whole), F.lit(0.0)))
        .withColumn("_line", F.col("_intercept") + F.col("_slope") * F.col("_t"))
    )


def linear_trend(
    history: DataFrame,
    series: Sequence[str] = (),
    horizon: int = HORIZON,
    fill_gaps: bool = False,
) -> DataFrame:
    """Straight line through each series, the coming months floored at zero, with a 95 % band.

    The band is 1.96 times the population deviation of the residuals and may reach below zero. Positions count the
    observed months; ``fill_gaps`` counts calendar months instead.
    """
    if fill_gaps:
        history = fill_missing_months(history, series)
    fit = (
        _trend(history, series)
        .groupBy(*series)
        .agg(
            F.count("y").alias("_n"),
            F.max("ds").alias("_last"),
            F.first("_slope").alias("_slope"),
            F.first("_intercept").alias("_intercept"),
            F.coalesce(F.stddev_pop(F.col("y") - F.col("_line")) * BAND_95, F.lit(0.0)).alias("_band"),
        )
    )
    ahead = fit.filter(F.col("_last").isNotNull()).withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    line = F.col("_intercept") + F.col("_slope") * (F.col("_n") - 1 + F.col("_step"))
    return (
        ahead.withColumn("yhat", F.greatest(line, F.lit(0.0)))
        .withColumn("ds", F.expr("add_months(_last, _step)"))
        .select(
            *series,
            "ds",
            "yhat",
            (F.col("yhat") - F.col("_band")).alias("yhat_lower"),
            (F.col("yhat") + F.col("_band")).alias("yhat_upper"),
        )
    )


def request_forecast(history: DataFrame, series: Sequence[str] = (), horizon: int = HORIZON) -> DataFrame:
    """The linear forecast of request counts, cut to whole numbers."""
    ahead = linear_trend(history, series, horizon)
    return ahead.select(*series, F.col("ds").alias("mes"), F.col("yhat").cast("bigint").alias("cantidad"))


def seasonal_trend(history: DataFrame, series: Sequence[str] = (), horizon: int = HORIZON) -> DataFrame:
    """Bending trend plus yearly pattern for the observed and the coming months, with an 80 % band.

    See ``curve``: the parts are those of the established model (a trend with changes of slope, a yearly pattern once
    there are two years of history, no weekly one), the solver is another one. It is not floored at zero.
    """
    return additive_curve(history, series, horizon)


def summary(history: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Per series: months with a value, range, and last value and month."""
    has_value = F.col("y").isNotNull()
    return history.groupBy(*series).agg(
        F.count("y").alias("n"),
        F.min("y").alias("y_min"),
        F.max("y").alias("y_max"),
        F.max(F.when(has_value, F.col("ds"))).alias("last_ds"),
        F.max_by("y", F.when(has_value, F.col("ds"))).alias("y_last"),
    )


def _method() -> Column:
    return (
        F.when(F.col("n") == 0, "empty")
        .when(F.col("y_min") == F.col("y_max"), "constant")
        .when(F.col("n") <= LAGS, "short")
        .otherwise("model")
    )


def flat_fallback(history: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """How each series is to be forecast, and the flat value where no model is fitted (its band is zero).

    No data gives zero, a constant series its value, and one that has no more than twelve months its last value.
    """
    base = (
        F.when(F.col("method") == "empty", F.lit(0.0))
        .when(F.col("method") == "constant", F.col("y_min"))
        .when(F.col("method") == "short", F.col("y_last"))
    )
    return summary(history, series).withColumn("method", _method()).withColumn("base", base).withColumn(
        "band", F.when(F.col("method") != "model", F.lit(0.0))
    )


def _lagged(history: DataFrame, series: Sequence[str], lags: int) -> DataFrame:
    """Scaled values with the ``lags`` values before each."""
    whole = _partition(series)
    before = whole.orderBy("ds").rowsBetween(-lags, -1)
    low, high = F.min("y").over(whole), F.max("y").over(whole)
    return (
        history.withColumn("_end", F.max("ds").over(whole))
        .filter(F.col("y").isNotNull())
        .withColumn("_low", low)
        .withColumn("_range", high - low)
        .filter(F.col("_range") > 0)
        .withColumn("target", (F.col("y") - F.col("_low")) / F.col("_range"))
        .withColumn("lags", F.collect_list("target").over(before))
    )


def lag_features(history: DataFrame, series: Sequence[str] = (), lags: int = LAGS) -> DataFrame:
    """Min-max scaled windows of twelve months (oldest first) and the month that follows. Constant series have none."""
    windows = _lagged(history, series, lags).filter(F.size("lags") == lags)
    return windows.select(*series, "ds", "lags", "target")


def _regressor(learner: str, rounds: int):
    columns = {"featuresCol": "features", "labelCol": "target", "predictionCol": "_predicted"}
    if learner == "linear":
        return LinearRegression(**columns, regParam=1e-6)
    if learner == "gbt":
        return GBTRegressor(**columns, seed=42, maxIter=rounds)
    raise ValueError(f"learner is network, linear or gbt, not {learner!r}")


def _features(window: str) -> Column:
    """A window as a vector. Rows with fewer months are filtered out, but may meet the model before: they get zeros."""
    whole = F.when(F.size(window) == LAGS, F.col(window)).otherwise(F.array_repeat(F.lit(0.0), LAGS))
    return array_to_vector(whole)


def _flat_rows(history: DataFrame, series: Sequence[str], horizon: int) -> DataFrame:
    """The coming months of the series that no model is fitted to."""
    ends = history.groupBy(*series).agg(F.max("ds").alias("_end"))
    flat = flat_fallback(history, series)
    flat = flat.join(ends, list(series)) if series else flat.withColumn("_end", ends.scalar())
    return (
        flat.filter((F.col("method") != "model") & F.col("_end").isNotNull())
        .withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .withColumn("ds", F.expr("add_months(_end, _step)"))
        .withColumns({"yhat": F.col("base"), "yhat_lower": F.col("base"), "yhat_upper": F.col("base")})
        .select(*series, "ds", "yhat", "yhat_lower", "yhat_upper", "method")
    )


def _pooled(history: DataFrame, series: Sequence[str], horizon: int, learner: str, rounds: int) -> DataFrame | None:
    """One learner fitted over the windows of all series; none where there is no window."""
    history = stage(history, "series")  # read several times: by the fit, the bands and the last windows
    lagged = _lagged(history, series, LAGS)
    training = lagged.filter(F.size("lags") == LAGS).withColumn("features", _features("lags"))
    if training.isEmpty():
        return None
    model = _regressor(learner, rounds).fit(training)
    residual = (F.col("target") - F.col("_predicted")) * F.col("_range")
    bands = model.transform(training).groupBy(*series).agg((F.stddev_pop(residual) * BAND_95).alias("_band"))
    # The last twelve scaled values of each series, oldest first.
    tails = (
        lagged.withColumn("_rank", F.row_number().over(_partition(series).orderBy(F.desc("ds"))))
        .filter((F.col("_rank") == 1) & (F.size("lags") == LAGS))
        .select(
            *series,
            F.col("_end").alias("_last"),
            "_low",
            "_range",
            F.slice(F.concat("lags", F.array("target")), -LAGS, LAGS).alias("_window"),
        )
    )
    state = tails.withColumn("_path", F.array().cast("array<double>"))
    for _ in range(horizon):
        state = (
            model.transform(state.withColumn("features", _features("_window")))
            .withColumn("_window", F.concat(F.slice("_window", 2, LAGS - 1), F.array("_predicted")))
            .withColumn("_path", F.concat("_path", F.array("_predicted")))
            .drop("features", "_predicted")
        )
    banded = state.join(bands, list(series)) if series else state.withColumn("_band", bands.scalar())
    return (
        banded.select("*", F.posexplode("_path").alias("_step", "_scaled"))
        .withColumn("ds", F.expr("add_months(_last, _step + 1)"))
        .withColumn("yhat", F.col("_scaled") * F.col("_range") + F.col("_low"))
        .withColumn("yhat_lower", F.col("yhat") - F.col("_band"))
        .withColumn("yhat_upper", F.col("yhat") + F.col("_band"))
        .withColumn("method", F.lit("model"))
        .select(*series, "ds", "yhat", "yhat_lower", "yhat_upper", "method")
    )


def autoregressive(
    history: DataFrame,
    series: Sequence[str] = (),
    horizon: int = HORIZON,
    learner: str = "network",
    rounds: int = 30,
) -> DataFrame:
    """Regression on the last twelve months, fed its own output for the months ahead, with a 95 % band.

    ``network`` trains a small neural network for every series (see ``network``; the established ones have the same layers,
    loss and optimizer, but another start, so the numbers differ). ``linear`` and ``gbt`` fit one learner over the windows of
    all series while the plan is built; ``rounds`` is the number of trees of the boosted one. Series that cannot be fitted
    get the flat forecast, one without any value zeros. Not floored at zero.
    """
    flat = _flat_rows(history, series, horizon)
    if learner == "network":
        windows = _lagged(history, series, LAGS).filter(F.size("lags") == LAGS)
        return network_forecast(windows, series, horizon, BAND_95).unionByName(flat)
    fitted = _pooled(history, series, horizon, learner, rounds)
    return flat if fitted is None else fitted.unionByName(flat)
