"""Plans against plain Python on random rows, with a third of them on one key."""

import random
import re
from collections import Counter, defaultdict
from datetime import date
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

import numpy as np
import pytest

from abasto.functions import cleaning
from abasto.operators import keys, lookups
from abasto.plans import forecast, gold, quality
from tests.test_forecast import by_series, months, series
from tests.test_layers import receipts, silver_frame


def _texts(alphabet, count, seed, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(count)]


def _clean(spark, texts, **columns):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    return df.select("i", *(column.alias(name) for name, column in columns.items())).orderBy("i").collect()


def test_random_numbers(spark):
    texts = _texts("0123456789.,- S/x", 1500, 1, 9)
    got = _clean(
        spark, texts,
        d=cleaning.decimal_number("s", "lenient"), n=cleaning.whole_number("s", "lenient"),
    )
    for text, row in zip(texts, got):
        digits, whole = re.sub(r"[^0-9.\-]", "", text), re.sub(r"[^0-9\-]", "", text)
        try:
            wanted = Decimal(digits).quantize(Decimal("0.01"), ROUND_HALF_UP)
        except InvalidOperation:
            wanted = None
        assert row.d == wanted, text
        assert row.n == (int(whole) if re.fullmatch(r"-?[0-9]+", whole) else None), text


def test_random_days(spark):
    texts = [text[:4] + "-" + text[4:6] + "-" + text[6:] for text in _texts("0123", 400, 2, 8)] + _texts("0123", 800, 3, 7)
    got = _clean(spark, texts, d=cleaning.calendar_day("s", "lenient"))
    for text, row in zip(texts, got):
        wanted = None
        parts = re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)", text) or re.fullmatch(r"(\d\d)(\d\d)(\d\d)", text)
        if parts:
            year, month, day = (int(part) for part in parts.groups())
            if len(text) == 6:
                year += 1900 if year >= 70 else 2000
            try:
                wanted = date(year, month, day)
            except ValueError:
                wanted = None
        assert row.d == wanted, text


@pytest.fixture(scope="module")
def movements():
    """Receipts of a few items and months; a third of them on one item and request."""
    rng = random.Random(11)
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        rows.append(
            {
                "solnum": 1 if hot else rng.randint(1, 60),
                "artcitem": "hot" if hot else rng.choice(["a", "b", "c", None]),
                "artgrinv": rng.choice(["g", "h"]),
                "solcan": str(rng.randint(1, 9)),
                "nrdcac": str(rng.randint(1, 3)),
                "artstock": None if rng.random() < 0.2 else str(rng.randint(0, 99)),
                "solpre": str(rng.randint(1, 50)),
                "nrcfec": None if rng.random() < 0.1 else f"2024-0{rng.randint(1, 4)}-{rng.randint(10, 28)}",
                "solfec": "2024-01-01",
                "nrcnum": None if rng.random() < 0.2 else rng.randint(1, 3),
                "solord": i,
                "solpro": rng.choice(["p", "q", "none"]),
            }
        )
    return rows


def test_monthly_demand(spark, movements):
    groups = silver_frame(spark, "grupos", {"artgrinv": "g", "nombre": "Group"})
    got = gold.monthly_demand(receipts(spark, *movements), groups)
    got = {(r.artcitem, r.artgrinv, r.mes): r for r in got.selectExpr("*", "date_format(periodo_mes, 'yyyy-MM') AS mes").collect()}
    grouped, closing = defaultdict(list), {}
    for row in movements:
        if row["nrcfec"]:
            grouped[row["artcitem"], row["artgrinv"], row["nrcfec"][:7]].append(row)
            if row["artstock"] is not None:
                # latest day, then no number, then the highest number; the first request and line of those left
                order = (row["nrcfec"], row["nrcnum"] is None, row["nrcnum"] or 0, -row["solnum"], -row["solord"])
                key = row["artcitem"], row["nrcfec"][:7]
                if key not in closing or order > closing[key][0]:
                    closing[key] = (order, row["artstock"])
    assert set(got) == set(grouped)
    for key, rows in grouped.items():
        assert got[key].cantidad_total_despachada == sum(int(row["solcan"]) for row in rows)
        assert got[key].frecuencia_pedidos == len({row["solnum"] for row in rows})
        assert float(got[key].precio_promedio_pactado) == pytest.approx(np.mean([int(row["solpre"]) for row in rows]))
        last = closing.get((key[0], key[2])) if key[0] is not None else None
        assert got[key].ultimo_stock_registrado == (None if last is None else Decimal(last[1]))
        assert got[key].grupo_nombre == ("Group" if key[1] == "g" else None)


def test_supplier_metrics(spark, movements):
    suppliers = silver_frame(spark, "proveedores", {"acrecodi": "p"}, {"acrecodi": "q"}, {"acrecodi": "idle"})
    got = {r.proveedor_id: r for r in gold.supplier_metrics(receipts(spark, *movements), suppliers).collect()}
    assert set(got) == {"p", "q"}
    for code, row in got.items():
        rows = [r for r in movements if r["solpro"] == code and r["nrcfec"]]
        days = [(date.fromisoformat(r["nrcfec"]) - date(2024, 1, 1)).days for r in rows]
        assert row.total_atenciones == len(rows)
        assert row.lead_time_promedio_dias == pytest.approx(np.mean(days))
        assert row.desviacion_lead_time == pytest.approx(np.std(days, ddof=1))
        assert row.volumen_total_suministrado == sum(int(r["solcan"]) for r in rows)


def test_key_checks(spark, movements):
    df = receipts(spark, *movements)
    counts = Counter((row["solnum"], row["artcitem"]) for row in movements)
    wanted = {key: n for key, n in counts.items() if n > 1 or None in key}
    got = keys.primary_key_violations(df, ["solnum", "artcitem"]).collect()
    assert {(r.solnum, r.artcitem): r.n_rows for r in got} == wanted
    dim = spark.createDataFrame([("hot",), ("a",)], "k string")
    orphans = Counter(row["artcitem"] for row in movements if row["artcitem"] not in ("hot", "a"))
    assert {r.artcitem: r.n_rows for r in lookups.orphan_keys(df, dim, "artcitem", "k").collect()} == orphans
    received = defaultdict(set)
    for row in movements:
        received[row["solnum"], row["artcitem"]].add(row["nrdcac"])
    partial = {key: len(values) for key, values in received.items() if len(values) > 1}
    assert {(r.solnum, r.artcitem): r.quantities for r in quality.partial_deliveries(df).collect()} == partial


def test_autoregression_is_the_least_squares_one(spark):
    """Two noisy series, pooled: fit, six fed-back steps and the band by hand."""
    rng = np.random.default_rng(5)
    values = {name: list(np.cumsum(rng.normal(0, 5, 60)) + 100) for name in ("a", "b")}
    got = by_series(forecast.autoregressive(series(spark, *values.items()), ["s"], learner="linear"))
    scaled = {name: (np.array(ys) - min(ys)) / (max(ys) - min(ys)) for name, ys in values.items()}
    windows = {name: np.array([ys[i : i + 12] for i in range(48)]) for name, ys in scaled.items()}
    x = np.vstack([np.hstack([windows[name], np.ones((48, 1))]) for name in ("a", "b")])
    y = np.concatenate([scaled[name][12:] for name in ("a", "b")])
    weights = np.linalg.lstsq(x, y, rcond=None)[0]
    for name, ys in values.items():
        spread, tail, path = max(ys) - min(ys), list(scaled[name][-12:]), []
        for _ in range(6):
            path.append(float(np.dot(weights[:-1], tail) + weights[-1]))
            tail = tail[1:] + [path[-1]]
        fitted = windows[name] @ weights[:-1] + weights[-1]
        band = 1.96 * np.std((scaled[name][12:] - fitted) * spread)
        assert [row.yhat for row in got[name]] == pytest.approx([p * spread + min(ys) for p in path], rel=1e-3)
        assert [row.yhat_upper - row.yhat for row in got[name]] == pytest.approx([band] * 6, rel=1e-2)
        assert got[name][0].ds == date(2025, 1, 1) and months(60)[-1] == date(2024, 12, 1)
