"""From normalized receipts to the products expected in the coming months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abasto.operators.shares import spread_over_shares
from abasto.plans import forecast, reports
from abasto.sources.tables import union_all

MODELS = ("linear", "seasonal", "autoregressive")


def coming_months(history: DataFrame, model: str, learner: str = "network") -> DataFrame:
    """(ds, yhat) of the months ahead of the whole series, by one of the models."""
    if model == "linear":
        ahead = forecast.linear_trend(history)
    elif model == "seasonal":
        ahead = forecast.seasonal_trend(history).filter(F.col("is_future"))
    elif model == "autoregressive":
        ahead = forecast.autoregressive(history, learner=learner)
    else:
        raise ValueError(f"model is one of {MODELS}, not {model!r}")
    return ahead.select("ds", "yhat")


def product_outlook(
    receipts: DataFrame,
    items: DataFrame,
    groups: DataFrame,
    model: str = "linear",
    rows: int = 15,
    floor: float | None = None,
) -> DataFrame:
    """The forecast of recorded stock, spread over the products by their share of the trailing year."""
    ahead = coming_months(reports.stock_monthly(receipts), model)
    share = reports.product_share(receipts, items, groups)
    return spread_over_shares(ahead, share, "participacion", "artcitem", ["artdes", "grupo"], rows, floor)


def product_outlooks(
    receipts: DataFrame, items: DataFrame, groups: DataFrame, models: Sequence[str] = MODELS, rows: int = 15
) -> DataFrame:
    """The outlook of several models (column ``model``); the shares are computed once for all of them."""
    history = reports.stock_monthly(receipts)
    ahead = union_all([coming_months(history, model).select(F.lit(model).alias("model"), "*") for model in models])
    share = reports.product_share(receipts, items, groups)
    return spread_over_shares(ahead, share, "participacion", "artcitem", ["artdes", "grupo"], rows, by=["model"])
