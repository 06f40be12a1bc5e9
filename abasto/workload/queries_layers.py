"""Queries: cleaning, joins, windows, keys, and the silver, normalized and gold tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from abasto.functions import cleaning
from abasto.functions.measures import month_of
from abasto.operators import keys, lookups
from abasto.plans import gold, normalized, reports, silver
from abasto.schemas import struct_of
from abasto.sources import tables as sources
from abasto.workload.bindings import money, monthly_demand
from abasto.workload.oracle import MONEY, day_of, decimal_of, integer_of
from abasto.workload.registry import doubles, query

# -- cleaning ----------------------------------------------------------------------------------------------------------


@query(
    "clean_text",
    "SELECT trim(acrecodi) AS acrecodi, NULLIF(trim(acretelf), '') AS acretelf, NULLIF(trim(acreiden), '') AS acreiden, "
    "acreruc, trim(acreraso) AS acreraso FROM z_proveedores",
)
def clean_text(t):
    return t.bronze_suppliers().select(
        cleaning.trimmed("acrecodi").alias("acrecodi"),
        cleaning.filled("acretelf").alias("acretelf"),
        cleaning.filled("acreiden").alias("acreiden"),
        "acreruc",
        cleaning.trimmed("acreraso").alias("acreraso"),
    )


@query(
    "clean_numeric",
    f"SELECT acreruc, CAST({decimal_of('acreruc')} AS DOUBLE) AS code, CAST({decimal_of('balance')} AS DOUBLE) AS owed "
    f"FROM (SELECT acreruc, ' S/ ' || CAST(s_acctbal AS {MONEY}) || ' ' AS balance FROM b_suppliers)",
)
def clean_numeric(t):
    balance = t.raw("supplier").select(
        (20000000000 + F.col("s_suppkey")).cast("string").alias("acreruc"),
        F.concat(F.lit(" S/ "), F.col("s_acctbal").cast("decimal(15,2)"), F.lit(" ")).alias("owed"),
    )
    return balance.select(
        "acreruc", cleaning.decimal_number("acreruc").alias("code"), cleaning.decimal_number("owed").alias("owed")
    )


@query(
    "clean_integer",
    "SELECT event_id, CAST(regexp_replace(props, '[^0-9\\-]', '', 'g') AS INTEGER) AS k, "
    "CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 1000 AS INTEGER) END AS some FROM events",
)
def clean_integer(t):
    """Every second text has no digit at all."""
    mixed = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("N° "), F.col("event_id") % 1000)).otherwise(F.lit("n/a"))
    return t.raw("events").select(
        "event_id",
        cleaning.whole_number("props").alias("k"),
        cleaning.whole_number(mixed).alias("some"),
    )


_REQUEST_DAY = """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%y%m%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
       ELSE o_orderpriority END AS text FROM orders"""


def _request_day(t):
    kind = F.col("o_orderkey") % 3
    return t.raw("orders").select(
        "o_orderkey",
        F.when(kind == 0, F.date_format("o_orderdate", "yyMMdd"))
        .when(kind == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.col("o_orderpriority"))
        .alias("text"),
    )


@query("clean_date", f"SELECT o_orderkey, {day_of('text')} AS day FROM ({_REQUEST_DAY})")
def clean_date(t):
    return _request_day(t).select("o_orderkey", cleaning.calendar_day("text").alias("day"))


_LENIENT_DAY = "(CASE WHEN o_orderkey % 3 = 0 THEN text || ' ' WHEN o_orderkey % 7 = 1 THEN '2023-02-30' ELSE text END)"


@query(
    "clean_lenient",
    f"""
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 5 < 3 THEN CAST(CAST(o_totalprice AS {MONEY}) AS DOUBLE) END AS price,
           CASE WHEN o_orderkey % 5 < 3 THEN CAST(o_custkey AS INTEGER) END AS number,
           CASE WHEN text = '2023-02-30' THEN NULL ELSE {day_of('trim(text)')} END AS day
    FROM (SELECT o_orderkey, o_totalprice, o_custkey, {_LENIENT_DAY} AS text FROM ({_REQUEST_DAY}) JOIN orders USING (o_orderkey))
    """,
)
def clean_lenient(t):
    key = F.col("o_orderkey")
    text = F.when(key % 3 == 0, F.concat("text", F.lit(" "))).when(key % 7 == 1, "2023-02-30").otherwise(F.col("text"))
    days = _request_day(t).withColumn("text", text)
    rows = days.join(t.raw("orders").select("o_orderkey", "o_totalprice", "o_custkey", "o_orderpriority"), "o_orderkey")
    good = key % 5 < 3  # the others have a text like 1-URGENT, whose rest 1- is no number
    rows = rows.withColumns(
        {
            "_price": F.when(good, F.concat(F.lit(" S/ "), money(F.col("o_totalprice")))).otherwise(F.col("o_orderpriority")),
            "_number": F.when(good, F.concat(F.lit("N° "), "o_custkey")).otherwise(F.col("o_orderpriority")),
        }
    )
    return rows.select(
        "o_orderkey",
        cleaning.decimal_number("_price", "lenient").alias("price"),
        cleaning.whole_number("_number", "lenient").alias("number"),
        cleaning.calendar_day("text", "lenient").alias("day"),
    )


@query("filter_nonblank_key", "SELECT solnum, artcitem, solord FROM z_recepcion WHERE trim(solnum) <> ''")
def filter_nonblank_key(t):
    return t.bronze_receipts().filter(cleaning.has_key("solnum")).select("solnum", "artcitem", "solord")


@query(
    "filter_trailing_12m",
    f"""SELECT solnum, solord, artcitem, nrcfec, {doubles("solcan solpre")} FROM b_receipts
        WHERE nrcfec >= (SELECT max(nrcfec) - INTERVAL 12 MONTH FROM b_receipts)""",
)
def filter_trailing_12m(t):
    rows = reports.trailing_year(t.receipts(request_date=False, catalogue=False))
    return rows.select("solnum", "solord", "artcitem", "nrcfec", "solcan", "solpre")


# -- sources -----------------------------------------------------------------------------------------------------------


def _listing_sql() -> str:
    names = {"string": "text", "bigint": "bigint", "int": "integer", "date": "date"}
    view = {
        "grupos": "b_groups",
        "proveedores": "b_suppliers",
        "maestro_articulos": "b_items",
        "articulos": "b_stock",
        "recepcion": "b_receipts",
        "solicitudes": "b_requests",
    }
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {position} AS ordinal_position, '{column.name}' AS column_name, "
        f"'{names.get(column.dataType.simpleString(), 'numeric')}' AS data_type, count(*) AS table_rows FROM {source}"
        for table, source in view.items()
        for position, column in enumerate(struct_of("silver", table), start=1)
    )


@query("schema_listing", _listing_sql())
def schema_listing(t):
    return sources.schema_listing(t.silver())


@query(
    "sample_rows",
    f"""SELECT solnum, solord, artcitem, {doubles("solcan nrdcac solpre")}, nrcfec FROM b_receipts
        ORDER BY solnum, solord, artcitem, solcan, solpre LIMIT 3""",
)
def sample_rows(t):
    rows = t.receipts(request_date=False, catalogue=False)
    order = ["solnum", "solord", "artcitem", "solcan", "solpre"]
    return sources.sample_rows(rows.select("solnum", "solord", "artcitem", "solcan", "nrdcac", "solpre", "nrcfec"), order)


# -- joins -------------------------------------------------------------------------------------------------------------


@query(
    "join_inner",
    f"""SELECT solnum, solord, artcitem, solpro, acreraso, {doubles("solcan")} FROM b_receipts
        JOIN b_suppliers ON solpro = acrecodi""",
)
def join_inner(t):
    rows = lookups.lookup(
        t.receipts(request_date=False, catalogue=False), t.suppliers(), "solpro", "acrecodi", ["acreraso"], "inner"
    )
    return rows.select("solnum", "solord", "artcitem", "solpro", "acreraso", "solcan")


@query(
    "join_left",
    f"""SELECT r.solnum, r.artcitem, i.artdes, {doubles("solcan", "r.")} FROM b_requests r
        LEFT JOIN b_items i ON r.artcitem = i.artcitem""",
)
def join_left(t):
    rows = lookups.lookup(t.requests(), t.items(), "artcitem", "artcitem", ["artdes"])
    return rows.select("solnum", "artcitem", "artdes", "solcan")


@query(
    "join_star",
    f"""SELECT r.solnum, r.solord, r.artcitem, i.artdes, g.nombre, {doubles("artstock", "r.")} FROM b_receipts r
        LEFT JOIN b_items i ON r.artcitem = i.artcitem LEFT JOIN b_groups g ON i.artgrinv = g.artgrinv""",
)
def join_star(t):
    rows = lookups.lookup(
        t.receipts(request_date=False, catalogue=False), t.items(), "artcitem", "artcitem", ["artdes", "artgrinv"]
    )
    rows = lookups.lookup(rows, t.groups(), "artgrinv", "artgrinv", ["nombre"])
    return rows.select("solnum", "solord", "artcitem", "artdes", "nombre", "artstock")


@query(
    "join_latest_stock",
    f"""SELECT d.artcitem, d.mes, d.movimientos, {doubles("artstock", "l.").replace("AS artstock", "AS ultimo_stock")}
        FROM (SELECT artcitem, CAST(date_trunc('month', nrcfec) AS DATE) AS mes, count(*) AS movimientos
              FROM b_receipts WHERE nrcfec IS NOT NULL GROUP BY ALL) d
        LEFT JOIN g_latest l ON d.artcitem = l.artcitem AND d.mes = l.mes""",
)
def join_latest_stock(t):
    receipts = t.receipts(request_date=False, catalogue=False)
    months = (
        receipts.filter(F.col("nrcfec").isNotNull())
        .groupBy("artcitem", month_of("nrcfec").alias("mes"))
        .agg(F.count("*").alias("movimientos"))
    )
    return gold.with_latest_stock(months, gold.latest_stock(receipts))


@query(
    "fk_null_exists",
    """SELECT q.solnum, i.artcitem, r.solord, r.nrcfec FROM b_receipts r
       LEFT JOIN (SELECT DISTINCT solnum FROM b_requests) q ON r.solnum = q.solnum
       LEFT JOIN (SELECT DISTINCT artcitem FROM b_items) i ON r.artcitem = i.artcitem""",
)
def fk_null_exists(t):
    rows = normalized.receipts_without_id(t.receipts(request_date=False, catalogue=False), t.requests(), t.items())
    return rows.select("solnum", "artcitem", "solord", "nrcfec")


@query(
    "fk_null_lookup",
    """SELECT solnum, items.artcitem, acrecodi AS solpro FROM b_requests
       LEFT JOIN (SELECT artcitem FROM b_items) items USING (artcitem) LEFT JOIN b_suppliers ON acrecodi = solpro""",
)
def fk_null_lookup(t):
    rows = lookups.known_or_null(t.requests(), t.items(), "artcitem", "artcitem")
    return lookups.known_or_null(rows, t.suppliers(), "solpro", "acrecodi").select("solnum", "artcitem", "solpro")


@query(
    "join_anti",
    """SELECT solnum, solord, artcitem, nrcfec FROM b_receipts WHERE solnum NOT IN (SELECT solnum FROM b_requests)
       UNION ALL SELECT solnum, solord, artcitem, nrcfec FROM n_receipts WHERE solnum IS NULL""",
)
def join_anti(t):
    """Receipts as recorded have orphan numbers, normalized ones NULLs."""
    recorded = t.receipts(request_date=False, catalogue=False)
    normal = normalized.receipts_without_id(recorded, t.requests(), t.items())
    columns = ["solnum", "solord", "artcitem", "nrcfec"]
    orphans = [lookups.orphan_rows(rows, t.requests(), "solnum", "solnum").select(*columns) for rows in (recorded, normal)]
    return orphans[0].unionByName(orphans[1])


@query(
    "join_not_in",
    """SELECT solnum, solord, solpro FROM b_receipts WHERE solpro NOT IN (SELECT acrecodi FROM b_suppliers)
       UNION ALL
       SELECT solnum, solord, solpro FROM b_receipts WHERE artcitem NOT IN (SELECT artcitem FROM n_requests)""",
)
def join_not_in(t):
    """The second part has NULLs on its right side and so adds nothing."""
    receipts = t.receipts(request_date=False, catalogue=False)
    columns = ["solnum", "solord", "solpro"]
    unknown = lookups.not_in(receipts, t.suppliers(), "solpro", "acrecodi").select(*columns)
    requested = normalized.requests(t.requests(), t.items(), t.suppliers())
    return unknown.unionByName(lookups.not_in(receipts, requested, "artcitem", "artcitem").select(*columns))


@query(
    "win_latest_in_month",
    f"SELECT artcitem, mes, nrcfec, nrcnum, solnum, solord, {doubles('artstock')} FROM g_latest",
)
def win_latest_in_month(t):
    rows = gold.latest_stock(t.receipts(request_date=False, catalogue=False))
    return rows.select("artcitem", "mes", "nrcfec", "nrcnum", "solnum", "solord", "artstock")


# -- keys --------------------------------------------------------------------------------------------------------------

_RECEIPT_ORDER = (
    "nrcfec DESC NULLS FIRST, nrcnum DESC NULLS FIRST, solnum NULLS FIRST, solord NULLS FIRST, solcan NULLS FIRST, "
    "solpre NULLS FIRST, artcitem NULLS FIRST"
)


@query(
    "surrogate_key",
    f"""SELECT row_number() OVER (ORDER BY {_RECEIPT_ORDER}) AS id, solnum, solord, artcitem, {doubles("solpre")}
        FROM b_receipts""",
)
def surrogate_key(t):
    rows = t.receipts(request_date=False, catalogue=False, position=True)
    numbered = keys.surrogate_key(rows, "id", normalized.receipt_order(rows.columns))
    return numbered.select("id", "solnum", "solord", "artcitem", "solpre")


@query(
    "check_primary_key",
    """SELECT solnum, artcitem, count(*) AS n_rows FROM n_receipts GROUP BY ALL
       HAVING count(*) > 1 OR solnum IS NULL OR artcitem IS NULL""",
)
def check_primary_key(t):
    rows = normalized.receipts_without_id(t.receipts(request_date=False, catalogue=False), t.requests(), t.items())
    return keys.primary_key_violations(rows, ["solnum", "artcitem"])


@query(
    "check_not_null",
    """SELECT solnum, solord, artcitem, concat_ws(',', CASE WHEN nrcfec IS NULL THEN 'nrcfec' END,
              CASE WHEN artstock IS NULL THEN 'artstock' END) AS null_columns
       FROM b_receipts WHERE nrcfec IS NULL OR artstock IS NULL""",
)
def check_not_null(t):
    rows = keys.not_null_violations(t.receipts(request_date=False, catalogue=False), ["nrcfec", "artstock"])
    return rows.select("solnum", "solord", "artcitem", "null_columns")


@query(
    "check_foreign_key",
    """SELECT solpro, count(*) AS n_rows FROM b_receipts r
       WHERE solpro IS NOT NULL AND NOT EXISTS (SELECT 1 FROM b_suppliers s WHERE s.acrecodi = r.solpro) GROUP BY solpro""",
)
def check_foreign_key(t):
    return keys.foreign_key_violations(
        t.receipts(request_date=False, catalogue=False), t.suppliers(), "solpro", "acrecodi"
    )


# -- silver ------------------------------------------------------------------------------------------------------------


@query("silver_groups", "SELECT trim(artgrinv) AS artgrinv, trim(nombre) AS nombre FROM z_grupos WHERE trim(artgrinv) <> ''")
def silver_groups(t):
    return silver.groups(t.bronze_groups())


@query(
    "silver_suppliers",
    "SELECT trim(acrecodi) AS acrecodi, trim(acreraso) AS acreraso, "
    + ", ".join(f"NULLIF(trim({c}), '') AS {c}" for c in "acredire acretelf acreciud acreiden acreruc".split())
    + " FROM z_proveedores WHERE trim(acrecodi) <> ''",
)
def silver_suppliers(t):
    return silver.suppliers(t.bronze_suppliers())


def _silver_sql(table: str, key: str, **rules: str) -> str:
    """Select list of a silver table. The rules are spelt out per query, apart from the plan's own description."""
    forms = {
        "trim": lambda c: f"trim({c})",
        "filled": lambda c: f"NULLIF(trim({c}), '')",
        "decimal": lambda c: f"CAST({decimal_of(c)} AS DOUBLE)",
        "integer": integer_of,
        "bigint": lambda c: integer_of(c, "BIGINT"),
        "day": day_of,
    }
    items = [f"{forms[rule](c)} AS {c}" for rule, names in rules.items() for c in names.split()]
    return f"SELECT {', '.join(items)} FROM z_{table} WHERE trim({key}) <> ''"


@query(
    "silver_items",
    _silver_sql(
        "maestro_articulos",
        "artcitem",
        trim="artcitem artdes artmed artgrinv",
        decimal="artcosu1 artcoum1 artpreu2",
        integer="artstseg",
        day="artfusal artfuent",
        filled="artubi artcmon",
    ),
)
def silver_items(t):
    return silver.items(t.bronze_items())


@query(
    "silver_stock",
    _silver_sql(
        "articulos",
        "artcitem",
        trim="artcitem artdes artmed artgrinv ubialm",
        decimal="ubistock artcoum1",
        day="artfusal artfureq artfuent artfusal_1",
        filled="artuptrn",
    ),
)
def silver_stock(t):
    return silver.stock(t.bronze_stock())


@query(
    "silver_receipts",
    _silver_sql(
        "recepcion",
        "solnum",
        bigint="solnum",
        trim="artcitem artdes artmed artgrinv",
        decimal="solcan nrdcac artstock solpre",
        integer="solmon nrcnum solord",
        filled="solurg solusr soltip solpro",
        day="nrcfec solfec",
    ),
)
def silver_receipts(t):
    return silver.receipts(t.bronze_receipts())


@query(
    "silver_requests",
    _silver_sql(
        "solicitudes",
        "solnum",
        bigint="solnum",
        trim="artcitem artdes",
        decimal="solcan solpre",
        integer="solord solmon solsta",
        filled="soltip solurg solusr solsts solpro artmed artgrinv",
        day="solfec",
    ),
)
def silver_requests(t):
    return silver.requests(t.bronze_requests())


# -- normalized --------------------------------------------------------------------------------------------------------


@query("norm_groups", "SELECT artgrinv, nombre FROM b_groups")
def norm_groups(t):
    return normalized.groups(t.groups())


@query("norm_suppliers", "SELECT * EXCLUDE (s_acctbal) FROM b_suppliers")
def norm_suppliers(t):
    return normalized.suppliers(t.suppliers())


@query("norm_items", f"SELECT * REPLACE ({doubles('artcosu1 artcoum1 artpreu2')}) FROM n_items")
def norm_items(t):
    return normalized.items(t.items(), t.groups())


@query("norm_requests", f"SELECT * REPLACE ({doubles('solcan solpre')}) FROM n_requests")
def norm_requests(t):
    return normalized.requests(t.requests(), t.items(), t.suppliers())


@query(
    "norm_receipts",
    f"""WITH numbered AS (SELECT row_number() OVER (ORDER BY {_RECEIPT_ORDER}) AS id_recepcion, * FROM b_receipts)
    SELECT r.id_recepcion, q.solnum, i.artcitem, {doubles("solcan nrdcac artstock solpre", "r.")}, r.solmon, r.solurg,
           r.solusr, r.nrcfec, r.solfec, r.nrcnum, r.solord, r.soltip, r.solpro
    FROM numbered r LEFT JOIN b_requests q ON r.solnum = q.solnum LEFT JOIN b_items i ON r.artcitem = i.artcitem""",
)
def norm_receipts(t):
    rows, values = t.receipt_values(catalogue=False, position=True, known_request=True)
    return normalized.receipts(rows, None, t.items(), values)


@query("norm_stock", f"SELECT artcitem, ubialm, {doubles('ubistock')}, artuptrn, artfureq FROM b_stock")
def norm_stock(t):
    return normalized.stock(t.stock(catalogue=False))


# -- gold --------------------------------------------------------------------------------------------------------------


@query(
    "gold_supplier_metrics",
    f"""SELECT proveedor_id, total_atenciones, round(lead_time_promedio_dias, 4) AS lead_time_promedio_dias,
               round(desviacion_lead_time, 4) AS desviacion_lead_time, {doubles("volumen_total_suministrado")}
        FROM g_metrics""",
    lead_time_promedio_dias=4,
    desviacion_lead_time=4,
)
def gold_supplier_metrics(t):
    return gold.supplier_metrics(t.receipts(catalogue=False), t.suppliers())


@query(
    "gold_monthly_demand",
    f"""SELECT artcitem, artgrinv, grupo_nombre, periodo_mes, frecuencia_pedidos,
               {doubles("cantidad_total_despachada ultimo_stock_registrado")},
               round(precio_promedio_pactado, 6) AS precio_promedio_pactado FROM g_demand""",
    precio_promedio_pactado=6,
)
def gold_monthly_demand(t):
    rows = monthly_demand(t)
    return rows.withColumn("periodo_mes", F.to_date("periodo_mes"))
