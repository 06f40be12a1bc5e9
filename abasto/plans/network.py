"""A small neural network for each series: twelve months in, one month out.

Two layers of 32 and 16 rectified units, trained on all windows of one series at once with Adam. Spark brings the
windows of a series together (as many rows as the series has months) and trains the series in parallel; no series has
any part in another one's weights. The start is drawn from a fixed seed, the same for every series, so a forecast does not
depend on which others are asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Units of the layers, steps, and the optimizer's settings.
UNITS = (32, 16, 1)
STEPS = 500
RATE, DECAY_1, DECAY_2, TINY = 0.001, 0.9, 0.999, 1e-8


def initial(inputs: int, seed: int) -> list[np.ndarray]:
    """Weights and offsets of every layer, uniform within one over the root of what goes in."""
    rng, found = np.random.default_rng(seed), []
    for units in UNITS:
        bound = 1 / np.sqrt(inputs)
        found += [rng.uniform(-bound, bound, (inputs, units)), rng.uniform(-bound, bound, units)]
        inputs = units
    return found


def forward(parts: list[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
    """What goes into every layer, and what comes out of the last."""
    values = [x]
    for layer in range(0, len(parts), 2):
        out = values[-1] @ parts[layer] + parts[layer + 1]
        values.append(np.maximum(out, 0) if layer + 2 < len(parts) else out)
    return values


def gradients(parts: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean squared error."""
    values = forward(parts, x)
    wrong, found = 2 * (values[-1] - y[:, None]) / len(y), []
    for layer in range(len(parts) - 2, -1, -2):
        found = [values[layer // 2].T @ wrong, wrong.sum(axis=0), *found]
        wrong = (wrong @ parts[layer].T) * (values[layer // 2] > 0)
    return found


def train(x: np.ndarray, y: np.ndarray, steps: int, seed: int) -> list[np.ndarray]:
    parts = initial(x.shape[1], seed)
    mean, square = [np.zeros_like(part) for part in parts], [np.zeros_like(part) for part in parts]
    for step in range(1, steps + 1):
        for part, slope, m, s in zip(parts, gradients(parts, x, y), mean, square, strict=True):
            m += (1 - DECAY_1) * (slope - m)
            s += (1 - DECAY_2) * (slope * slope - s)
            part -= RATE * (m / (1 - DECAY_1**step)) / (np.sqrt(s / (1 - DECAY_2**step)) + TINY)
    return parts


def _forecaster(series: Sequence[str], horizon: int, steps: int, seed: int, width: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(windows: pd.DataFrame) -> pd.DataFrame:
        windows = windows.sort_values("ds")
        x, y = np.stack(windows["lags"].to_numpy()), windows["target"].to_numpy()
        parts = train(x, y, steps, seed)
        low, scale = windows["_low"].iloc[0], windows["_range"].iloc[0]
        band = width * scale * float(np.std(y - forward(parts, x)[-1][:, 0]))
        window, path = np.append(x[-1][1:], y[-1]), []
        for _ in range(horizon):
            path.append(float(forward(parts, window[None])[-1][0, 0]))
            window = np.append(window[1:], path[-1])
        found = {name: [windows[name].iloc[0]] * horizon for name in series}
        yhat = np.array(path) * scale + low
        return pd.DataFrame(found | {"_step": range(1, horizon + 1), "_last": windows["_end"].iloc[0], "yhat": yhat, "_band": band})

    return run


def network_forecast(
    windows: DataFrame, series: Sequence[str], horizon: int, width: float, steps: int = STEPS, seed: int = 42
) -> DataFrame:
    """The months after ``_end`` of every series that has windows (``lags``, ``target``, scaled by ``_low`` and ``_range``)."""
    kinds = [f"`{field.name}` {field.dataType.simpleString()}" for field in windows.schema if field.name in series]
    schema = ", ".join([*kinds, "_step int, _last date, yhat double, _band double"])
    needed = windows.select(*series, "ds", "lags", "target", "_low", "_range", "_end")
    rows = needed.groupBy(*series).applyInPandas(_forecaster(series, horizon, steps, seed, width), schema)
    return rows.select(
        *series,
        F.expr("add_months(_last, _step)").alias("ds"),
        "yhat",
        (F.col("yhat") - F.col("_band")).alias("yhat_lower"),
        (F.col("yhat") + F.col("_band")).alias("yhat_upper"),
        F.lit("model").alias("method"),
    )
