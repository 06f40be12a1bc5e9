import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from abasto.plans import forecast, forest, network


def months(count, start=2020):
    return [date(start + i // 12, i % 12 + 1, 1) for i in range(count)]


def series(spark, *lines):
    """One or more (name, values) series of consecutive months."""
    rows = [(name, ds, None if y is None else float(y)) for name, ys in lines for ds, y in zip(months(len(ys)), ys)]
    return spark.createDataFrame(rows, "s string, ds date, y double")


def by_series(df):
    out = {}
    for row in df.orderBy("s", "ds").collect():
        out.setdefault(row.s, []).append(row)
    return out


def test_linear_trend(spark):
    history = series(spark, ("up", [1, 3, 5]), ("down", [5, 3, 1]), ("one", [4]), ("gap", [1, None, 5]))
    got = by_series(forecast.linear_trend(history, ["s"]))
    assert [r.yhat for r in got["up"]] == pytest.approx([7, 9, 11, 13, 15, 17])
    assert got["up"][0].yhat_upper == pytest.approx(got["up"][0].yhat)
    assert [r.yhat for r in got["down"]] == [0.0] * 6
    assert [r.yhat for r in got["one"]] == [4.0] * 6
    assert [r.yhat for r in got["gap"]][:2] == [9.0, 13.0]  # positions count the observed months only
    assert got["up"][0].ds == date(2020, 4, 1)


def test_linear_trend_against_numpy(spark):
    values = list(np.random.default_rng(3).normal(100, 20, 40))
    got = forecast.linear_trend(series(spark, ("a", values)).drop("s")).orderBy("ds").collect()
    slope, intercept = np.polyfit(range(40), values, 1)
    band = 1.96 * np.std(np.array(values) - (intercept + slope * np.arange(40)))
    assert [r.yhat for r in got] == pytest.approx([intercept + slope * x for x in range(40, 46)])
    assert [r.yhat_upper - r.yhat for r in got] == pytest.approx([band] * 6)


def test_filled_gaps_count_calendar_months(spark):
    history = series(spark, ("a", [2, 2, 2])).filter("ds <> '2020-02-01'")
    filled = by_series(forecast.linear_trend(history, ["s"], fill_gaps=True))
    slope, intercept = np.polyfit([0, 1, 2], [2, 0, 2], 1)
    assert filled["a"][0].yhat == pytest.approx(intercept + 3 * slope)


def test_request_forecast_cuts_to_whole_numbers(spark):
    got = forecast.request_forecast(series(spark, ("a", [1, 1, 2])).drop("s")).orderBy("mes").collect()
    slope, intercept = np.polyfit([0, 1, 2], [1, 1, 2], 1)
    assert [r.cantidad for r in got] == [int(intercept + slope * x) for x in range(3, 9)]


def test_no_history_gives_no_rows(spark):
    empty = series(spark).drop("s")
    assert forecast.linear_trend(empty).count() == 0
    assert forecast.seasonal_trend(empty).count() == 0
    assert forecast.future_months(empty).count() == 0


def design(days, first, span, bends, yearly, order=6):
    t = np.array([(day - first).days / span for day in days])
    angle = np.array([2 * np.pi / 365.25 * (day - date(1970, 1, 1)).days for day in days])
    waves = [wave(angle * k) for k in range(1, order + 1) for wave in (np.sin, np.cos)] if yearly else []
    return np.stack([np.ones(len(t)), t, *(np.maximum(t - bend, 0) for bend in bends), *waves], axis=1)


def ridge_curve(days, values, ahead):
    """The additive curve by numpy's solver."""
    n, first, span = len(days), days[0], max((days[-1] - days[0]).days, 1)
    reach = int(n * 0.8)
    count = min(25, max(reach - 1, 0))
    bends = [(days[int(np.floor(j * (reach - 1) / count + 0.5))] - first).days / span for j in range(1, count + 1)]
    yearly = (days[-1] - first).days >= 730
    x, scale = design(days, first, span, bends, yearly), max(map(abs, values)) or 1.0
    penalty = np.diag([1e-6] * 2 + [0.01] * (x.shape[1] - 2))
    weights = np.linalg.solve(x.T @ x + penalty, x.T @ np.array(values) / scale)
    return scale * x @ weights, scale * design(ahead, first, span, bends, yearly) @ weights


def test_seasonal_trend_is_the_ridge_solution(spark):
    rng = np.random.default_rng(5)
    lines = {f"n{n}": list(rng.normal(50, 20, n).round(2)) for n in (1, 2, 3, 5, 12, 24, 25, 26, 60)} | {"zero": [0.0] * 30}
    got = by_series(forecast.seasonal_trend(series(spark, *lines.items()), ["s"]))
    for name, values in lines.items():
        days = months(len(values) + 6)
        fitted, ahead = ridge_curve(days[:-6], values, days[-6:])
        assert [r.ds for r in got[name]] == days and [r.is_future for r in got[name]] == [False] * len(values) + [True] * 6
        assert [r.yhat for r in got[name]] == pytest.approx([*fitted, *ahead], abs=1e-6)
        band = 1.2816 * np.std(np.array(values) - fitted)
        assert [r.yhat_upper - r.yhat for r in got[name]] == pytest.approx([band] * len(days), abs=1e-6)


def test_seasonal_trend_finds_bends_and_waves(spark):
    days = months(78)
    t = np.arange(78.0)
    angle = np.array([2 * np.pi / 365.25 * (day - date(1970, 1, 1)).days for day in days])
    bent = 100 + 3 * t - 5 * np.maximum(t - 30, 0)  # the slope turns from 3 to -2
    wave = 20 * np.sin(angle) - 8 * np.cos(2 * angle)
    lines = ("bent", list(bent[:72])), ("wave", list(500 + wave[:72])), ("both", list(400 + bent[:72] + wave[:72]))
    got = by_series(forecast.seasonal_trend(series(spark, *lines), ["s"]))
    assert [r.yhat for r in got["bent"][-6:]] == pytest.approx(list(bent[72:]), abs=4)
    assert [r.yhat for r in got["wave"][-6:]] == pytest.approx(list(500 + wave[72:]), abs=3)
    assert [r.yhat for r in got["both"][-6:]] == pytest.approx(list(400 + bent[72:] + wave[72:]), abs=6)
    assert max(abs(r.yhat - y) for r, y in zip(got["both"], 400 + bent + wave)) < 6


def test_short_histories_have_no_yearly_part(spark):
    pattern = [0, 10, 20, 5, 0, -5, -10, 0, 3, 7, 1, 2]
    short = by_series(forecast.seasonal_trend(series(spark, ("s", [100 + pattern[i % 12] for i in range(18)])), ["s"]))["s"]
    steps = np.diff([r.yhat for r in short[-7:]])
    assert steps == pytest.approx([steps[0]] * 6, rel=0.2)  # a straight line, but for the lengths of months


def test_flat_fallback(spark):
    history = series(
        spark, ("none", [None, None]), ("constant", [7] * 20), ("short", range(12)), ("fitted", range(13))
    )
    got = {r.s: (r.method, r.base, r.band) for r in forecast.flat_fallback(history, ["s"]).collect()}
    assert got == {
        "none": ("empty", 0.0, 0.0), "constant": ("constant", 7.0, 0.0),
        "short": ("short", 11.0, 0.0), "fitted": ("model", None, None),
    }
    empty = forecast.flat_fallback(series(spark).drop("s")).collect()
    assert [(r.method, r.base) for r in empty] == [("empty", 0.0)]


def test_lag_features(spark):
    got = forecast.lag_features(series(spark, ("a", range(15)), ("c", [3] * 15)), ["s"]).orderBy("ds").collect()
    assert len(got) == 3 and got[0].lags == pytest.approx([i / 14 for i in range(12)]) and got[0].target == pytest.approx(12 / 14)


@pytest.mark.parametrize("learner", ["network", "linear", "gbt"])
def test_autoregressive(spark, learner):
    wave = [50 + 10 * np.sin(i / 2) for i in range(40)]
    history = series(spark, ("a", wave), ("b", [2 * y for y in wave]), ("short", [1, 2, 3]), ("constant", [9] * 20))
    got = by_series(forecast.autoregressive(history, ["s"], learner=learner))
    assert {name: (len(rows), rows[0].method) for name, rows in got.items()} == {
        "a": (6, "model"), "b": (6, "model"), "short": (6, "short"), "constant": (6, "constant"),
    }
    assert [r.yhat for r in got["short"]] == [3.0] * 6 and got["constant"][0].yhat == 9.0
    assert got["a"][0].ds == date(2023, 5, 1) and got["a"][0].yhat_lower <= got["a"][0].yhat <= got["a"][0].yhat_upper
    if learner == "linear":
        wanted = [50 + 10 * np.sin(i / 2) for i in range(40, 46)]
        assert [r.yhat for r in got["a"]] == pytest.approx(wanted, abs=0.5)


def test_autoregressive_single_series(spark):
    wave = [50 + 10 * np.sin(i / 2) for i in range(30)]
    got = forecast.autoregressive(series(spark, ("a", wave)).drop("s")).collect()
    assert len(got) == 6
    assert len(forecast.autoregressive(series(spark, ("a", [1, 2])).drop("s")).collect()) == 6


def test_networks_know_their_own_series_only(spark):
    rng = np.random.default_rng(8)
    fast = [50 + 10 * np.sin(1.9 * i) for i in range(60)]
    lines = ("slow", [50 + 10 * np.sin(i / 3) for i in range(60)]), ("fast", fast), ("noise", list(rng.normal(5, 1, 40)))
    together = by_series(forecast.autoregressive(series(spark, *lines), ["s"]))
    for line in lines:
        alone = by_series(forecast.autoregressive(series(spark, line), ["s"]))
        assert [tuple(r) for r in alone[line[0]]] == [tuple(r) for r in together[line[0]]]
    pooled = by_series(forecast.autoregressive(series(spark, *lines), ["s"], learner="linear"))
    for name in ("slow", "fast", "noise"):  # the band is the error in the sample
        assert together[name][0].yhat_upper - together[name][0].yhat < pooled[name][0].yhat_upper - pooled[name][0].yhat
    wanted = [50 + 10 * np.sin(1.9 * i) for i in range(60, 66)]
    assert [r.yhat for r in together["fast"]] == pytest.approx(wanted, abs=4)


def test_network_gradients():
    rng = np.random.default_rng(2)
    x, y, parts = rng.random((9, 12)), rng.random(9), network.initial(12, 1)
    loss = lambda: float(np.mean((network.forward(parts, x)[-1][:, 0] - y) ** 2))
    for part, slope in zip(parts, network.gradients(parts, x, y)):
        place = tuple(rng.integers(0, size) for size in part.shape)
        before = part[place]
        part[place] = before + 1e-6
        above = loss()
        part[place] = before - 1e-6
        assert slope[place] == pytest.approx((above - loss()) / 2e-6, abs=1e-6)
        part[place] = before


def grow(rows, quantity):
    """What a plain regression tree, grown without limit over (x, y, times), says about a quantity."""
    if len({y for _, y, _ in rows}) == 1 or len({x for x, _, _ in rows}) == 1:
        return sum(y * n for _, y, n in rows) / sum(n for *_, n in rows)
    best, values = None, sorted({x for x, _, _ in rows})
    for a, b in zip(values, values[1:]):
        sides = [row for row in rows if row[0] <= a], [row for row in rows if row[0] > a]
        score = sum(sum(y * n for _, y, n in side) ** 2 / sum(n for *_, n in side) for side in sides)
        if best is None or score > best[0]:
            best = score, a / 2 + b / 2, sides
    _, cut, (low, high) = best
    return grow(low if quantity <= cut else high, quantity)


@pytest.mark.parametrize("quantity", [0, 7, 7.5, 19, 100])
def test_price_forest_is_that_of_grown_trees(spark, quantity):
    rng = random.Random(9)
    rows = [(None, rng.choice([1.0, 2.0, rng.random() * 9]), float(rng.choice([3, 5, 7, 8, 20, rng.randint(0, 40)]))) for _ in range(500)]
    rows += [(None, 4.0, None), (None, None, 7.0), (None, float("nan"), 7.0)]
    training = spark.createDataFrame(rows, "solfec date, solpre double, solcan double").repartition(3).cache()
    trees = 12
    near = forest.near(training, quantity)
    times = F.array(*(forest._times(F.lit(tree), 42) for tree in range(trees))).alias("times")
    drawn = near.select("x", "y", times).collect()
    assert len(drawn) == 500 and 0.8 < sum(map(sum, (r.times for r in drawn))) / (500 * trees) < 1.2
    wanted = [grow([(r.x, r.y, r.times[tree]) for r in drawn if r.times[tree]], quantity) for tree in range(trees)]
    row = forest.price_forest(training, quantity, trees=trees).collect()[0]
    assert row.solcan == float(quantity) and row.precio_estimado == pytest.approx(sum(wanted) / trees)


def test_price_forest_looks_at_the_nearest_values(spark):
    training = spark.createDataFrame([(None, float(3 * q), float(q)) for q in range(1, 200)], "solfec date, solpre double, solcan double")
    assert forest.near(training, 100, nearest=5).select("x").distinct().count() == 10
    row = forest.price_forest(training, trees=20).collect()[0]
    assert row.solcan == 100.0 and row.precio_estimado == pytest.approx(300, rel=0.1)


def test_price_forest_without_rows(spark):
    empty = spark.createDataFrame([(None, None, 5.0)], "solfec date, solpre double, solcan double")
    assert forest.price_forest(empty).collect() == []
    assert forest.price_forest(empty.limit(0)).collect() == []


def test_months_already_observed_are_not_forecast(spark):
    history = series(spark, ("open", [1, 2, 3, 4, 5, None, None]), ("none", [None] * 14), ("model", [*range(14), None]))
    linear, seasonal = (by_series(f(history, ["s"])) for f in (forecast.linear_trend, forecast.seasonal_trend))
    for found in (linear, seasonal):
        assert [(r.ds, r.yhat, r.yhat_lower, r.yhat_upper) for r in found["none"]] == [(ds, 0.0, 0.0, 0.0) for ds in months(20)[14:]]
    assert [r.ds for r in linear["open"]] == months(13)[7:]
    assert [r.ds for r in seasonal["open"] if r.is_future] == months(13)[7:]
    assert [r.yhat for r in linear["open"]] == pytest.approx([6, 7, 8, 9, 10, 11])
    flat = by_series(forecast.autoregressive(history, ["s"]))
    assert [(r.ds, r.yhat, r.method) for r in flat["none"]] == [(ds, 0.0, "empty") for ds in months(20)[14:]]
    assert [r.ds for r in flat["open"]] == months(13)[7:] and {r.yhat for r in flat["open"]} == {5.0}
    assert [r.ds for r in flat["model"]] == months(21)[15:] and {r.method for r in flat["model"]} == {"model"}
