import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from abasto.plans import build, gold, normalized, outlook, phases, quality, reconcile, reports, silver
from abasto.schemas import BRONZE, GOLD, NORMALIZED, SILVER, columns_of, struct_of
from abasto.sources.tables import Warehouse, staging
from abasto.workload.bindings import Tables

RECEIPT = {"solnum": 1, "artcitem": "a", "artgrinv": "g", "solcan": "2", "nrdcac": "1", "artstock": "5", "solpre": "10",
           "nrcfec": "2024-01-10", "solfec": "2024-01-01", "nrcnum": 1, "solord": 1, "solpro": "p"}


def silver_frame(spark, table, *rows):
    """A silver frame from dicts; missing columns are NULL."""
    schema = struct_of("silver", table)
    text = [tuple(None if row.get(n) is None else str(row[n]) for n in schema.fieldNames()) for row in rows]
    df = spark.createDataFrame(text, ", ".join(f"{n} string" for n in schema.fieldNames()))
    return df.select(*(F.col(f.name).cast(f.dataType) for f in schema))


def receipts(spark, *changes):
    return silver_frame(spark, "recepcion", *({**RECEIPT, **change} for change in changes))


def bronze_frame(spark, table, *rows):
    return spark.createDataFrame(
        [tuple(row.get(name, "") for name in BRONZE[table]) for row in rows], struct_of("bronze", table)
    )


@pytest.fixture
def bronze(spark):
    return {
        "grupos": bronze_frame(spark, "grupos", {"artgrinv": " g1 ", "nombre": " Inks "}, {"artgrinv": " ", "nombre": "x"}),
        "proveedores": bronze_frame(spark, "proveedores", {"acrecodi": "p1 ", "acreraso": "One"}, {"acrecodi": "p2"}),
        "maestro_articulos": bronze_frame(
            spark, "maestro_articulos",
            {"artcitem": "a", "artdes": "A", "artmed": "PZ", "artgrinv": "g1", "artcosu1": "S/ 5.005", "artfusal": "230105"},
            {"artcitem": "b", "artdes": "B", "artmed": "PZ", "artgrinv": "gone"},
        ),
        "articulos": bronze_frame(spark, "articulos", {"artcitem": "a", "artdes": "A", "ubialm": " 40 ", "ubistock": "7"}),
        "recepcion": bronze_frame(
            spark, "recepcion",
            {"solnum": "1", "artcitem": "a", "artgrinv": "g1", "solcan": "10", "nrdcac": "9", "artstock": "4",
             "solpre": "2", "nrcfec": "2024-01-11", "solfec": "240101", "nrcnum": "1", "solpro": "p1"},
            {"solnum": "9", "artcitem": "zz", "artgrinv": "g1", "solcan": "1", "nrdcac": "1", "artstock": "4",
             "solpre": "2", "nrcfec": "2024-01-12", "solfec": "240101", "nrcnum": "2", "solpro": "p1"},
            {"solnum": " ", "artcitem": "a"},
        ),
        "solicitudes": bronze_frame(
            spark, "solicitudes",
            {"solnum": "1", "artcitem": "a", "solpro": "p1", "solcan": "10", "solfec": "240101", "solpre": "2"},
            {"solnum": "2", "artcitem": "yy", "solpro": "none", "solcan": "3", "solfec": "n/a", "solpre": "0"},
        ),
    }


def test_build_from_bronze_to_gold(spark, bronze, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    build.build_all(warehouse, bronze)
    layers = {
        "bronze": bronze,
        "silver": {t: warehouse.table("silver", t) for t in SILVER},
        "normalized": {
            {"fact_solicitudes": "solicitudes", "fact_recepcion": "recepcion", "fact_stock": "articulos"}.get(t, t):
                warehouse.table("normalizado", t)
            for t in NORMALIZED
        },
    }
    counts = {r.table_name: tuple(r)[1:] for r in quality.layer_row_counts(layers, list(layers)).collect()}
    assert counts["grupos"] == (2, 1, 1) and counts["recepcion"] == (3, 2, 2) and counts["solicitudes"] == (2, 2, 2)

    receipts = warehouse.table("normalizado", "fact_recepcion").orderBy("id_recepcion").collect()
    assert [(r.id_recepcion, r.solnum, r.artcitem, r.solpro) for r in receipts] == [(1, None, None, "p1"), (2, 1, "a", "p1")]
    requests = {r.solnum: r for r in warehouse.table("normalizado", "fact_solicitudes").collect()}
    assert requests[2].artcitem is None and requests[2].solpro is None and requests[2].solfec is None
    items = {r.artcitem: r for r in warehouse.table("normalizado", "maestro_articulos").collect()}
    assert items["b"].artgrinv is None and items["a"].artcosu1 == Decimal("5.01")

    metrics = warehouse.table("gold", "metricas_prediccion_proveedor").collect()
    assert [tuple(r)[:3] for r in metrics] == [("p1", 2, 10.5)]
    demand = {r.artcitem: r for r in warehouse.table("gold", "prediccion_demanda_mensual").collect()}
    assert demand["zz"].frecuencia_pedidos == 1 and demand["zz"].grupo_nombre == "Inks"
    months = warehouse.table("gold", "prediccion_demanda_mensual").select(F.col("periodo_mes").cast("string").alias("m"))
    assert {r.m for r in months.collect()} == {"2024-01-01 00:00:00"}

    violations = {(r.table_name, r.rule): r.violating_rows for r in build.constraint_violations(warehouse, "normalizado").collect()}
    assert set(violations.values()) == {0} and len(violations) == 14

    nulls = {tuple(r)[:2]: r.nulls for r in quality.null_references(
        {t: warehouse.table("normalizado", t) for t in ("fact_solicitudes", "fact_recepcion", "maestro_articulos")}
    ).collect()}
    found = {r.check_name: r.value for r in quality.integrity(layers["silver"]).collect()}
    assert nulls["fact_solicitudes", "artcitem"] == found["solicitudes.artcitem"] == 1
    assert nulls["fact_recepcion", "solnum"] == found["recepcion.solnum"] == 1
    assert nulls["maestro_articulos", "artgrinv"] == found["maestro_articulos.artgrinv"] == 1


def test_repeated_dimension_keys_stop_the_build(spark, bronze, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    build.build_all(warehouse, bronze)
    before = warehouse.table("silver", "maestro_articulos").count()
    twice = bronze["maestro_articulos"].union(
        bronze_frame(spark, "maestro_articulos", {"artcitem": " a", "artdes": "again"})
    )
    with pytest.raises(build.ConstraintError, match=r"maestro_articulos: primary key \(artcitem\): 2 rows"):
        build.build_all(warehouse, bronze | {"maestro_articulos": twice})
    assert warehouse.table("silver", "maestro_articulos").count() == before
    assert not [path for path in tmp_path.iterdir() if path.name.startswith("staging")]


def test_unknown_or_null_never_adds_rows(spark):
    items = silver_frame(spark, "maestro_articulos", {"artcitem": "a"}, {"artcitem": "a"}, {})
    known = normalized.receipts_without_id(receipts(spark, {}, {"artcitem": "z"}, {"artcitem": None}), items=items)
    assert sorted((row.artcitem or "") for row in known.collect()) == ["", "", "a"]


def test_supplier_metrics_do_not_depend_on_partitions(spark):
    suppliers = silver_frame(spark, "proveedores", {"acrecodi": "p"}, {"acrecodi": "q"})
    rows = receipts(spark, *({"solpro": "pq"[i % 2], "nrcfec": f"2024-0{1 + i % 8}-{10 + i % 17}"} for i in range(200)))
    one, many = (gold.supplier_metrics(rows.repartition(n), suppliers) for n in (1, 13))
    assert sorted(one.collect()) == sorted(many.collect())
    found = reconcile.metrics(one, many).first()
    assert (found.stored, found.different, found.missing, found.extra) == (2, 0, 0, 0)


@pytest.mark.parametrize("layer,tables", [("silver", SILVER), ("normalizado", NORMALIZED), ("gold", GOLD)])
def test_declared_schemas_parse(layer, tables):
    for table in tables:
        assert len(columns_of(layer, table)) == len(tables[table])


def test_every_silver_column_has_one_rule():
    for table, rules in silver.RULES.items():
        names = [name for text in rules.values() for name in text]
        assert sorted(names) == sorted(columns_of("silver", table))


def test_blank_group_differs_between_receipts_and_requests(spark):
    blank = {"solnum": "1", "artcitem": "a", "artgrinv": "  "}
    assert silver.receipts(bronze_frame(spark, "recepcion", blank)).collect()[0].artgrinv == ""
    assert silver.requests(bronze_frame(spark, "solicitudes", blank)).collect()[0].artgrinv is None


def test_one_receipt_has_no_deviation(spark):
    suppliers = silver_frame(spark, "proveedores", {"acrecodi": "p"})
    row = gold.supplier_metrics(receipts(spark, {}), suppliers).collect()[0]
    assert tuple(row) == ("p", 1, 9.0, None, Decimal("2.00"))


def test_missing_number_wins_on_the_same_day(spark):
    latest = gold.latest_stock(
        receipts(spark, {"artstock": "1"}, {"nrcnum": None, "artstock": "2"}, {"nrcfec": "2024-01-09", "artstock": "3"})
    ).collect()
    assert [row.artstock for row in latest] == [Decimal("2.00")]


def test_demand_keeps_months_without_stock_and_rows_without_item(spark):
    groups = silver_frame(spark, "grupos", {"artgrinv": "g", "nombre": "Group"})
    df = receipts(spark, {"artstock": None}, {"artcitem": None}, {"artgrinv": "other", "artstock": None, "solnum": 2})
    demand = {(r.artcitem, r.artgrinv): r for r in gold.monthly_demand(df, groups).collect()}
    assert set(demand) == {("a", "g"), (None, "g"), ("a", "other")}
    assert all(r.ultimo_stock_registrado is None for r in demand.values())
    assert demand["a", "other"].grupo_nombre is None


def test_compare_matches_null_keys_and_full_grain(spark):
    groups = silver_frame(spark, "grupos", {"artgrinv": "g", "nombre": "Group"})
    df = receipts(spark, {}, {"artcitem": None}, {"artgrinv": "h"})
    demand = gold.monthly_demand(df, groups)
    same = {r.chk: r.n for r in reconcile.demand(demand, demand).collect()}
    assert same == {"gold_total": 3, "repro_total": 3, "sin_key": 0, "extras": 0, "dif_total": 0}
    changed = demand.filter("artcitem is null or artgrinv = 'g'").withColumn(
        "frecuencia_pedidos", F.when(F.col("artcitem").isNull(), 7).otherwise(F.col("frecuencia_pedidos"))
    )
    other = {r.chk: r.n for r in reconcile.demand(changed, demand).collect()}
    assert other == {"gold_total": 2, "repro_total": 3, "sin_key": 0, "extras": 1, "dif_total": 1}


def test_monthly_demand_exchanges_receipts_once(spark, settings):
    """Months without stock, items without a code and several groups in a month; only the row that has stock closes it."""
    settings(spark__sql__adaptive__enabled="false")
    groups = silver_frame(spark, "grupos", {"artgrinv": "g", "nombre": "G"})
    later = {"nrcfec": "2024-01-20"}
    df = receipts(
        spark, {}, {**later, "artgrinv": "h", "artstock": 7, "solnum": 2}, {**later, "artstock": None}, {"nrcfec": None},
        {"artcitem": None}, {"artcitem": "b", "artstock": None}, {"artcitem": "b", "artgrinv": None, "nrcfec": "2024-02-01"},
    )
    rows = gold.monthly_demand(df, F.broadcast(groups))
    found = {(r.artcitem, r.artgrinv, r.periodo_mes.month): (r.grupo_nombre, r.frecuencia_pedidos, r.ultimo_stock_registrado) for r in rows.collect()}
    assert found == {
        ("a", "g", 1): ("G", 1, 7), ("a", "h", 1): (None, 1, 7), (None, "g", 1): ("G", 1, None),
        ("b", "g", 1): ("G", 1, None), ("b", None, 2): (None, 1, 5),
    }
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_digests_give_the_same_counts(spark):
    schema = "k string, m int, v double, w decimal(10,2)"
    rows = [(f"k{i % 97}" if i % 5 else None, i, None if i % 7 == 0 else i / 3, None if i % 3 else Decimal(i)) for i in range(400)]
    one = spark.createDataFrame(rows, schema)
    compare, keys, measures = reconcile.compare_by_digests, ["k", "m"], ["v", "w"]
    same = compare(one, one.repartition(3), keys, measures)
    assert tuple(same.first()) == (400, 400, 0, 0, 0)
    assert "LogicalRDD" in same._jdf.queryExecution().optimizedPlan().toString()  # no row of either table is in the plan
    swapped = one.withColumns({"v": F.when(F.col("v").isNull(), 0.0).otherwise(F.col("v"))})
    for other in (one.limit(380), swapped, one.filter("m % 50 <> 7"), one.withColumn("w", F.col("w") + 1), one.limit(0)):
        for left, right in ((one, other), (other, one)):
            found = compare(left, right, keys, measures, buckets=16).first()
            assert tuple(found) == tuple(reconcile.compare_tables(left, right, keys, measures).first())


def test_a_trailing_year_reads_its_months_only(spark, tmp_path, settings):
    months = [f"{2021 + i // 12}-{i % 12 + 1:02d}" for i in range(36)]
    rows = [{"nrcfec": f"{month}-{day}", "artstock": 1} for month in months for day in ("03", "21")] + [{"nrcfec": None}]
    df = receipts(spark, *rows).withColumn("id_recepcion", F.monotonically_increasing_id()).coalesce(1)
    warehouse = Warehouse(spark, str(tmp_path))
    stored = warehouse.load("normalizado", "fact_recepcion", df, month_of="nrcfec")
    assert stored.columns == warehouse.table("normalizado", "fact_recepcion").columns and "month_part" not in stored.columns
    assert stored.count() == len(rows)
    settings(spark__sql__adaptive__enabled="false")
    recent = reports.trailing_year(warehouse.table("normalizado", "fact_recepcion", month=True))
    assert recent.columns == stored.columns
    assert sorted(map(tuple, recent.collect())) == sorted(map(tuple, reports.trailing_year(stored).collect()))
    plan = recent._jdf.queryExecution().executedPlan()
    assert recent._jdf.queryExecution().toRdd().count() == 25  # from 21 December 2022 on
    leaves = plan.collectLeaves()
    scan = next(leaves.apply(i) for i in range(leaves.size()) if "FileScan" in leaves.apply(i).toString())
    assert scan.metrics().apply("numFiles").value() == 13


def test_expected_counts(spark):
    expectations = spark.createDataFrame([("x", 2), ("y", 5)], "table_name string, expected bigint")
    checked = reconcile.expected_counts({"x": spark.range(2), "y": spark.range(4)}, expectations)
    assert {r.table_name: r.status for r in checked.collect()} == {"x": "OK", "y": "NO COINCIDE"}


def test_profile(spark):
    df = spark.createDataFrame([("1", " "), ("1", None), (None, "x")], "k string, v string")
    got = {(r.column_name, r.metric): (r.value, r.pct) for r in quality.profile(df, "t").collect()}
    assert got == {
        ("k", "rows"): (3, None), ("k", "distinct"): (1, None), ("k", "duplicates"): (2, None),
        ("k", "blank"): (1, 33.3), ("v", "blank"): (2, 66.7),
    }
    assert {r.metric: r.value for r in quality.profile(df.limit(0), "t").collect()}["rows"] == 0


def test_full_row_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert quality.full_row_duplicates(df, "t").collect()[0].duplicate_rows == 2
    assert quality.full_row_duplicates(df.limit(0), "t").collect()[0].duplicate_rows == 0


def test_full_row_duplicates_read_the_table_once(spark, tmp_path):
    """Texts that would run together, marks of NULL and empty texts stay apart; a row is shuffled once."""
    rows = [("a", "b", 1), ("ab", "", 1), ("", "ab", 1), (None, "ab", 1), ("-", "ab", 1), ("1:a", "b", 1), ("a1:", "b", 1), ("a", "b", 2),
            ("-", None, 1), (None, "-", 1), (None, None, 1), (None, None, None)]
    spark.createDataFrame(rows + rows[3:] + rows[:1] * 2, "a string, b string, n int").write.parquet(str(tmp_path / "t"))
    found = quality.full_row_duplicates(spark.read.parquet(str(tmp_path / "t")), "t")
    assert found.collect()[0].duplicate_rows == len(rows) - 3 + 2
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Join" not in plan


def test_worst_key_tie_goes_to_the_smallest(spark):
    df = spark.createDataFrame([("b", 1), ("b", 2), ("a", 3), ("a", 4), ("c", 5)], "k string, v int")
    assert sorted(r.v for r in quality.rows_of_worst_key(df, "k").collect()) == [3, 4]


def test_suppliers_of_one_name_count_as_one(spark):
    suppliers = silver_frame(spark, "proveedores", {"acrecodi": "p", "acreraso": "S"}, {"acrecodi": "q", "acreraso": "S"})
    df = receipts(spark, {}, {"solpro": "q"}, {"solpro": "unknown"})
    assert [tuple(r) for r in reports.top_suppliers(df, suppliers).collect()] == [("S", 2, Decimal("4.00"))]


def test_trailing_year_clamps_at_month_end(spark):
    df = receipts(spark, {"nrcfec": "2024-02-29"}, {"nrcfec": "2023-02-28"}, {"nrcfec": "2023-02-27"}, {"nrcfec": None})
    assert sorted(r.nrcfec for r in reports.trailing_year(df).collect()) == [date(2023, 2, 28), date(2024, 2, 29)]


def test_numbered_receipts_travel_as_given(spark, tmp_path):
    """Columns given as expressions are made after the numbering; ids and references are those of whole receipts."""
    source = [(i % 9 - 4 if i % 9 else None, i % 5, i % 3, i) for i in range(60)]
    df = spark.createDataFrame(source, "k bigint, p int, d int, v int")
    values = {
        "solnum": -F.col("k"),
        "artcitem": F.concat(F.lit("ART-"), "p"),
        "nrcfec": F.when(F.col("d") != 1, F.date_add(F.lit("2024-01-01").cast("date"), F.col("d"))),
        "solord": F.col("v") % 4,
        "solcan": F.col("v").cast("decimal(15,2)"),
        "solpro": F.concat(F.lit("PRV-"), "v"),
    }
    fields = {field.name: field.dataType for field in struct_of("silver", "recepcion")}
    values = {name: values.get(name, F.lit(None)).cast(kind) for name, kind in fields.items()}
    requests = spark.createDataFrame([(1,), (-2,), (-2,), (None,)], "solnum bigint")
    items = spark.createDataFrame([("ART-1",), ("ART-3",)], "artcitem string")
    with staging(spark, str(tmp_path)) as folder:
        found = normalized.receipts(df, requests, items, values).collect()
        (staged,) = os.listdir(folder)
        assert set(spark.read.parquet(f"{folder}/{staged}").columns) == {*df.columns, *normalized.KNOWN.values(), "_place"}
    whole = normalized.receipts(df.select(*(value.alias(name) for name, value in values.items())), requests, items)
    assert sorted(found) == sorted(whole.collect()) and len(found) == 60
    order = sorted(source, key=lambda r: ((r[2] != 1, -r[2]), r[0] is not None, -(r[0] or 0), r[3] % 4, r[3]))
    assert [r.solpro for r in sorted(found)] == [f"PRV-{r[3]}" for r in order]
    by_row = {f"PRV-{r[3]}": r for r in source}
    for row in found:
        k, p = by_row[row.solpro][:2]
        assert row.solnum == (-k if k in (-1, 2) else None) and row.artcitem == (f"ART-{p}" if p in (1, 3) else None)


def test_requests_of_receipts_are_known_by_the_order(spark, tmp_path):
    """Numbers and their negatives, repeated, missing and NULL ones: the flag is that of a lookup by the number."""
    lines = [(k, n, f, s) for k in (1, 2, 3, -3, 4, 0) for n in (5, 6) for f in ("N", None) for s in ("O", "F")]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_returnflag string, l_linestatus string").select(
        "*", *(F.lit(1).cast(kind).alias(name) for name, kind in (("l_partkey", "bigint"), ("l_suppkey", "bigint"))),
        *(F.lit(1.0).alias(name) for name in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(1, "2024-01-02"), (-2, "2024-01-03"), (-2, "2024-01-03"), (3, None), (0, "2024-01-04"), (None, None)]
    spark.createDataFrame(orders, "o_orderkey bigint, day string").selectExpr(
        "o_orderkey", "cast(day AS timestamp_ntz) AS o_orderdate"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    rows, values = Tables(spark, str(tmp_path)).receipt_values(catalogue=False, known_request=True)
    found = rows.select(values["solnum"].alias("solnum"), normalized.KNOWN["solnum"]).collect()
    assert len(found) == len(lines) and {name for name in values} >= {"solfec", "solpro"}
    assert all(known == (number in {1, -2, 3, 0}) for number, known in found) and {known for _, known in found} == {True, False}


def test_normalization_keeps_rows(spark):
    df = receipts(spark, {}, {"solnum": 5}, {"artcitem": "b", "solnum": None})
    requests = spark.createDataFrame([(1,)], "solnum bigint")
    items = spark.createDataFrame([("a",)], "artcitem string")
    kept = normalized.receipts_without_id(df, requests, items).select("solnum", "artcitem").collect()
    assert sorted((tuple(r) for r in kept), key=repr) == [(1, "a"), (None, "a"), (None, None)]


@pytest.mark.parametrize("model", ["linear", "seasonal", "autoregressive"])
def test_outlook_stays_within_the_total(spark, model):
    rows = [{"artcitem": item, "artstock": 10 + i, "nrcfec": f"{2022 + i // 12}-{i % 12 + 1:02d}-05"}
            for i in range(30) for item in ("a", "b", "c")]
    df = receipts(spark, *rows)
    items = silver_frame(spark, "maestro_articulos", {"artcitem": "a", "artdes": "A", "artgrinv": "g"}, {"artcitem": "b"})
    groups = silver_frame(spark, "grupos", {"artgrinv": "g", "nombre": "Group"})
    got = outlook.product_outlook(df, items, groups, model, rows=2).collect()
    assert len(got) == 12 and {r.artcitem for r in got} == {"a", "b"}
    assert {(r.artcitem, r.artdes, r.grupo) for r in got} == {("a", "A", "Group"), ("b", None, None)}
    totals = {r.ds: r.yhat for r in outlook.coming_months(reports.stock_monthly(df), model).collect()}
    for month, total in totals.items():
        assert sum(r.cantidad_estimada for r in got if r.mes == month) == pytest.approx(total * 2 / 3)


def test_unknown_model(spark):
    with pytest.raises(ValueError):
        outlook.coming_months(spark.range(1), "oracle")


def test_phases_store_their_findings(spark, bronze, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    expected = {"metricas_prediccion_proveedor": 1, "prediccion_demanda_mensual": 7}
    verdicts = {r.table_name: r for r in phases.run(warehouse, bronze, str(tmp_path / "f"), expected=expected).collect()}
    assert verdicts["metricas_prediccion_proveedor"].exact and not verdicts["prediccion_demanda_mensual"].exact
    found = spark.read.json(f"file:{tmp_path}/f/*/*")
    rows = {(r.section, r.object, r.metric): r.value for r in found.collect()}
    assert rows["reconciliation", "metricas_prediccion_proveedor", "different"] == "0"
    assert rows["row_counts", "recepcion", "silver_rows"] == rows["row_counts", "recepcion", "normalizado_rows"] == "2"
    assert rows["full_row_duplicates", "recepcion", "duplicate_rows"] == "0"
    sections = {section for section, _, _ in rows}
    assert {"profile", "integrity", "constraints", "redundancy", "null_references", "reconciliation"} <= sections
