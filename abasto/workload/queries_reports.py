"""Queries: quality checks, reconciliation, reports and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from abasto.operators import keys
from abasto.plans import forecast, forest, gold, normalized, outlook, quality, reconcile, reports
from abasto.plans import silver as silver_plans
from abasto.schemas import BRONZE
from abasto.sources.tables import stage, union_all
from abasto.workload.bindings import monthly_demand
from abasto.workload.oracle import demand_sql, latest_sql
from abasto.workload.registry import doubles, query

# -- profiles and duplicates -------------------------------------------------------------------------------------------


def _profile_sql() -> str:
    parts = []
    for table, columns in BRONZE.items():
        source, key = f"z_{table}", columns[0]
        for metric, value in (
            ("rows", "count(*)"),
            ("distinct", f"count(DISTINCT {key})"),
            ("duplicates", f"count(*) - count(DISTINCT {key})"),
        ):
            parts.append(
                f"SELECT '{table}' AS table_name, '{key}' AS column_name, '{metric}' AS metric, {value} AS value, "
                f"CAST(NULL AS DOUBLE) AS pct FROM {source}"
            )
        counts = ", ".join(f"count(*) FILTER ({c} IS NULL OR trim({c}) = '') AS {c}" for c in columns)
        parts.append(
            f"SELECT '{table}', column_name, 'blank', value, round(value * 100.0 / (SELECT count(*) FROM {source}), 1) "
            f"FROM (UNPIVOT (SELECT {counts} FROM {source}) ON {', '.join(columns)} INTO NAME column_name VALUE value) "
            "WHERE value > 0"
        )
    return " UNION ALL ".join(parts)


@query("quality_profile", _profile_sql())
def quality_profile(t):
    return quality.profiles(t.bronze())


@query(
    "dup_top_keys",
    """(SELECT 'recepcion' AS table_name, CAST(solnum AS VARCHAR) AS key, count(*) AS n_rows FROM b_receipts
        GROUP BY solnum HAVING count(*) > 1 ORDER BY count(*) DESC, solnum LIMIT 10)
       UNION ALL
       (SELECT 'articulos', artcitem, count(*) FROM b_stock GROUP BY artcitem HAVING count(*) > 1
        ORDER BY count(*) DESC, artcitem LIMIT 10)""",
)
def dup_top_keys(t):
    receipts = quality.top_repeated_keys(t.receipts(False, False), "solnum")
    stock = quality.top_repeated_keys(t.stock(catalogue=False), "artcitem")
    return receipts.select(F.lit("recepcion").alias("table_name"), F.col("solnum").cast("string").alias("key"), "n_rows").union(
        stock.select(F.lit("articulos"), "artcitem", "n_rows")
    )


@query(
    "dup_keys",
    """SELECT 'recepcion' AS table_name, 'solnum' AS key_columns, count(*) AS repeated_keys
       FROM (SELECT solnum FROM b_receipts GROUP BY solnum HAVING count(*) > 1)
       UNION ALL SELECT 'recepcion', 'solnum,solord', count(*)
       FROM (SELECT solnum, solord FROM b_receipts GROUP BY ALL HAVING count(*) > 1)
       UNION ALL SELECT 'articulos', 'artcitem', count(*)
       FROM (SELECT artcitem FROM b_stock GROUP BY artcitem HAVING count(*) > 1)""",
)
def dup_keys(t):
    receipts = t.receipts(False, False)
    return (
        quality.repeated_key_count(receipts, ["solnum"], "recepcion")
        .union(quality.repeated_key_count(receipts, ["solnum", "solord"], "recepcion"))
        .union(quality.repeated_key_count(t.stock(catalogue=False), ["artcitem"], "articulos"))
    )


@query(
    "dup_example_rows",
    f"""WITH sizes AS (SELECT solnum, count(*) AS n FROM b_receipts GROUP BY solnum)
        SELECT solnum, solord, artcitem, {doubles("solcan nrdcac solpre")}, nrcfec FROM b_receipts
        WHERE solnum IN (SELECT min(solnum) FROM sizes WHERE n > 1 AND n >= ALL (SELECT n FROM sizes))""",
)
def dup_example_rows(t):
    rows = quality.rows_of_worst_key(t.receipts(False, False), "solnum")
    return rows.select("solnum", "solord", "artcitem", "solcan", "nrdcac", "solpre", "nrcfec")


@query(
    "dup_partial_deliveries",
    """SELECT artcitem, solpro, count(DISTINCT nrdcac) AS quantities FROM b_receipts
       GROUP BY artcitem, solpro HAVING min(nrdcac) < max(nrdcac)""",
)
def dup_partial_deliveries(t):
    """(item, supplier) pairs stand for (request, item) pairs, which hardly repeat in these tables."""
    rows = t.receipts(False, False).select(F.col("artcitem").alias("solnum"), F.col("solpro").alias("artcitem"), "nrdcac")
    return quality.partial_deliveries(rows).toDF("artcitem", "solpro", "quantities")


@query(
    "dup_business_key",
    """SELECT 'recepcion' AS table_name, 'solnum,artcitem,nrdcac' AS key_columns, count(*) AS repeated_keys
       FROM (SELECT solnum, artcitem, nrdcac FROM b_receipts GROUP BY ALL HAVING count(*) > 1)
       UNION ALL SELECT 'recepcion', 'artcitem,solpro,nrdcac', count(*)
       FROM (SELECT artcitem, solpro, nrdcac FROM b_receipts GROUP BY ALL HAVING count(*) > 1)""",
)
def dup_business_key(t):
    rows = t.receipts(False, False)
    return quality.repeated_key_count(rows, ["solnum", "artcitem", "nrdcac"], "recepcion").union(
        quality.repeated_key_count(rows, ["artcitem", "solpro", "nrdcac"], "recepcion")
    )


def _entered_twice(rows, condition):
    """All rows, those of the condition twice; the table is read once."""
    times = F.when(condition, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("*", F.explode(times).alias("_time")).drop("_time")


@query(
    "dup_full_rows",
    """WITH entered AS (SELECT * FROM z_recepcion UNION ALL SELECT * FROM z_recepcion WHERE soltip = 'R' AND solord = '#3'),
       held AS (SELECT * FROM z_articulos UNION ALL SELECT * FROM z_articulos WHERE trim(ubialm) = '41')
       SELECT 'recepcion' AS table_name, (SELECT count(*) FROM entered) - count(*) AS duplicate_rows
       FROM (SELECT DISTINCT * FROM entered)
       UNION ALL SELECT 'articulos', (SELECT count(*) FROM held) - count(*) FROM (SELECT DISTINCT * FROM held)
       UNION ALL SELECT 'codigos', (SELECT count(*) FROM b_receipts) - count(*)
       FROM (SELECT DISTINCT solpro, nrcfec, solcan FROM b_receipts)""",
)
def dup_full_rows(t):
    """Bronze rows of all text columns, some entered twice; ``codigos`` are three columns of receipts."""
    codes = t.receipts(False, False).select("solpro", "nrcfec", "solcan")
    entered = _entered_twice(t.bronze_receipts(), (F.col("soltip") == "R") & (F.col("solord") == "#3"))
    held = _entered_twice(t.bronze_stock(), F.trim("ubialm") == "41")
    frames = {"recepcion": entered, "articulos": held, "codigos": codes}
    return union_all([quality.full_row_duplicates(df, name) for name, df in frames.items()])


@query(
    "dup_stock_example_rows",
    f"""WITH sizes AS (SELECT artcitem, count(*) AS n FROM b_stock GROUP BY artcitem)
        SELECT artcitem, ubialm, {doubles("ubistock")}, artfureq FROM b_stock
        WHERE artcitem IN (SELECT min(artcitem) FROM sizes WHERE n > 1 AND n >= ALL (SELECT n FROM sizes))""",
)
def dup_stock_example_rows(t):
    return quality.rows_of_worst_key(t.stock(catalogue=False), "artcitem").select("artcitem", "ubialm", "ubistock", "artfureq")


_UNIQUE_KEYS = [
    ("solicitudes", "solnum", "b_requests"),
    ("recepcion", "solnum", "n_receipts"),
    ("maestro_articulos", "artcitem", "b_items"),
    ("articulos", "artcitem", "b_stock"),
    ("grupos", "artgrinv", "b_groups"),
    ("proveedores", "acrecodi", "b_suppliers"),
]


@query(
    "key_uniqueness",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS total, count(DISTINCT {key}) AS distinct_keys, "
        f"count(*) - count(DISTINCT {key}) AS surplus FROM {source}"
        for name, key, source in _UNIQUE_KEYS
    ),
)
def key_uniqueness(t):
    frames = {
        "b_requests": t.requests(),
        "n_receipts": normalized.receipts_without_id(t.receipts(False, False), t.requests()),
        "b_items": t.items(),
        "b_stock": t.stock(catalogue=False),
        "b_groups": t.groups(),
        "b_suppliers": t.suppliers(),
    }
    return union_all([keys.uniqueness(frames[source], key, name) for name, key, source in _UNIQUE_KEYS])


# -- redundancy and integrity ------------------------------------------------------------------------------------------


@query(
    "redundancy_match",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{column}' AS column_name,
                   count(*) FILTER (f.{column} = m.{column}) AS matching, count(*) AS total,
                   round(count(*) FILTER (f.{column} = m.{column}) * 100.0 / count(*), 1) AS pct
            FROM {source} f LEFT JOIN b_items m ON f.artcitem = m.artcitem"""
        for name, source in (("solicitudes", "b_requests_full"), ("recepcion", "b_receipts"), ("articulos", "b_stock"))
        for column in ("artdes", "artmed", "artgrinv")
    ),
)
def redundancy_match(t):
    items = t.items()
    return (
        quality.redundancy(t.requests(catalogue=True), items, "solicitudes")
        .union(quality.redundancy(t.receipts(request_date=False), items, "recepcion"))
        .union(quality.redundancy(t.stock(), items, "articulos"))
    )


@query(
    "redundancy_mismatch",
    " UNION ALL ".join(
        f"""SELECT 'articulos' AS table_name, '{column}' AS column_name,
                   count(*) FILTER (a.{column} IS DISTINCT FROM m.{column}) AS different
            FROM b_stock a JOIN b_items m ON a.artcitem = m.artcitem"""
        for column in ("artdes", "artfusal", "artfuent", "artcoum1")
    ),
)
def redundancy_mismatch(t):
    return quality.mismatches(t.stock(), t.items())


@query(
    "distinct_supplier_codes",
    """SELECT 'recepcion' AS table_name, count(DISTINCT solpro) AS codes FROM b_receipts
       UNION ALL SELECT 'solicitudes', count(DISTINCT solpro) FROM b_requests
       UNION ALL SELECT 'proveedores', count(DISTINCT acrecodi) FROM b_suppliers""",
)
def distinct_supplier_codes(t):
    return quality.distinct_codes(
        {
            "recepcion": (t.receipts(False, False), "solpro"),
            "solicitudes": (t.requests(), "solpro"),
            "proveedores": (t.suppliers(), "acrecodi"),
        }
    )


def _integrity_sql() -> str:
    views = {
        "recepcion": "b_receipts",
        "solicitudes": "b_requests",
        "maestro_articulos": "b_items",
        "articulos": "b_stock",
        "proveedores": "b_suppliers",
        "grupos": "b_groups",
    }
    counts = [
        f"SELECT '{table}.{column}' AS check_name, count(*) AS value FROM {views[table]} f "
        f"LEFT JOIN {views[dim]} d ON f.{column} = d.{key} WHERE d.{key} IS NULL"
        for table, column, dim, key in quality.SILVER_REFERENCES
    ]
    counts.append(
        "SELECT 'recepcion(solnum,artcitem,nrdcac)', count(*) FROM "
        "(SELECT 1 FROM b_receipts GROUP BY solnum, artcitem, nrdcac HAVING count(*) > 1)"
    )
    counts.append("SELECT 'solicitudes.solnum', count(*) - count(DISTINCT solnum) FROM b_requests")
    return (
        "SELECT check_name, value, CASE WHEN value > 0 THEN '***' ELSE 'OK' END AS flag FROM ("
        + " UNION ALL ".join(counts)
        + ")"
    )


@query("integrity_orphans", _integrity_sql())
def integrity_orphans(t):
    return quality.integrity(
        {
            "recepcion": t.receipts(False, False),
            "solicitudes": t.requests(),
            "maestro_articulos": t.items(),
            "articulos": t.stock(catalogue=False),
            "proveedores": t.suppliers(),
            "grupos": t.groups(),
        }
    )


@query(
    "orphan_distinct_keys",
    """WITH gone AS (SELECT artcitem FROM b_requests EXCEPT SELECT artcitem FROM b_items),
       placed AS (SELECT artcitem, row_number() OVER (ORDER BY artcitem) AS place FROM gone)
       SELECT 'items' AS what, artcitem AS key FROM placed WHERE place <= 8
       UNION ALL SELECT 'groups', artgrinv FROM (SELECT artgrinv FROM b_items EXCEPT SELECT artgrinv FROM b_groups)
       UNION ALL SELECT 'item count', CAST(count(*) AS VARCHAR) FROM gone""",
)
def orphan_distinct_keys(t):
    requests, items = t.requests(), t.items()
    examples = quality.orphan_values(requests, items, "artcitem", "artcitem", rows=8)
    groups = quality.orphan_values(items, t.groups(), "artgrinv", "artgrinv")
    count = quality.orphan_values(requests, items, "artcitem", "artcitem").agg(F.count("artcitem").cast("string"))
    return (
        examples.select(F.lit("items").alias("what"), F.col("artcitem").alias("key"))
        .union(groups.select(F.lit("groups"), "artgrinv"))
        .union(count.select(F.lit("item count"), "*"))
    )


@query(
    "norm_null_fks",
    """SELECT 'fact_solicitudes' AS table_name, 'artcitem' AS column_name, count(*) FILTER (artcitem IS NULL) AS nulls FROM n_requests
       UNION ALL SELECT 'fact_solicitudes', 'solpro', count(*) FILTER (solpro IS NULL) FROM n_requests
       UNION ALL SELECT 'fact_recepcion', 'solnum', count(*) FILTER (solnum IS NULL) FROM n_receipts
       UNION ALL SELECT 'fact_recepcion', 'artcitem', count(*) FILTER (artcitem IS NULL) FROM n_receipts
       UNION ALL SELECT 'maestro_articulos', 'artgrinv', count(*) FILTER (artgrinv IS NULL) FROM n_items""",
)
def norm_null_fks(t):
    return quality.null_references(
        {
            "fact_solicitudes": normalized.requests(t.requests(), t.items(), t.suppliers()),
            "fact_recepcion": normalized.receipts_without_id(t.receipts(False, False), t.requests(), t.items()),
            "maestro_articulos": normalized.items(t.items(), t.groups()),
        }
    )


_LAYER_TABLES = {
    "grupos": ("z_grupos", "artgrinv"),
    "proveedores": ("z_proveedores", "acrecodi"),
    "maestro_articulos": ("z_maestro_articulos", "artcitem"),
    "solicitudes": ("z_solicitudes", "solnum"),
    "recepcion": ("z_recepcion", "solnum"),
    "articulos": ("z_articulos", "artcitem"),
}


@query(
    "layer_row_counts",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS bronze_rows, count(*) FILTER (trim({key}) <> '') AS silver_rows, "
        f"count(*) FILTER (trim({key}) <> '') AS normalized_rows FROM {bronze}"
        for table, (bronze, key) in _LAYER_TABLES.items()
    ),
)
def layer_row_counts(t):
    bronze = t.bronze()
    silver = {name: silver_plans.clean(df, name) for name, df in bronze.items()}
    normal = {
        "grupos": normalized.groups(silver["grupos"]),
        "proveedores": normalized.suppliers(silver["proveedores"]),
        "maestro_articulos": normalized.items(silver["maestro_articulos"], silver["grupos"]),
        "articulos": normalized.stock(silver["articulos"]),
    }
    normal["solicitudes"] = normalized.requests(
        silver["solicitudes"], normal["maestro_articulos"], normal["proveedores"]
    )
    normal["recepcion"] = normalized.receipts_without_id(
        silver["recepcion"], normal["solicitudes"], normal["maestro_articulos"]
    )
    return quality.layer_row_counts(
        {"bronze": bronze, "silver": silver, "normalized": normal}, ["bronze", "silver", "normalized"]
    )


# -- reconciliation ----------------------------------------------------------------------------------------------------

# The stored table of these queries is an older state: late receipts (flag R, line 2) were not in yet, and receipts of
# supplier users USR-3 stood under a provisional item code.
_OLDER_STATE = f"""
    WITH older AS (SELECT * REPLACE (CASE solusr WHEN 'USR-3' THEN concat('TMP-', artcitem) ELSE artcitem END AS artcitem)
        FROM b_receipts WHERE soltip <> 'R' OR solord <> 2),
    older_latest AS ({latest_sql("older")}),
    older_sums AS ({demand_sql("older", "older_latest")}),"""


def _older_receipts(t, **needs):
    rows = t.receipts(**needs)
    provisional = F.when(F.col("solusr") == "USR-3", F.concat(F.lit("TMP-"), "artcitem")).otherwise(F.col("artcitem"))
    return rows.filter(~((F.col("soltip") == "R") & (F.col("solord") == 2))).withColumn("artcitem", provisional)


_RECONCILED = (
    _OLDER_STATE
    + """
    pairs AS (SELECT s.mes IS NOT NULL AS st, c.mes IS NOT NULL AS co,
               (s.quantity, s.requests, s.closing) IS DISTINCT FROM (c.quantity, c.requests, c.closing)
               OR s.price_sum * c.n_prices IS DISTINCT FROM c.price_sum * s.n_prices AS differ
        FROM older_sums s FULL OUTER JOIN g_sums c ON (s.artcitem, s.artgrinv, s.grupo_nombre, s.mes)
            IS NOT DISTINCT FROM (c.artcitem, c.artgrinv, c.grupo_nombre, c.mes))
    SELECT 'gold_total' AS chk, count(*) FILTER (st) AS n FROM pairs
    UNION ALL SELECT 'repro_total', count(*) FILTER (co) FROM pairs
    UNION ALL SELECT 'sin_key', count(*) FILTER (st AND NOT co) FROM pairs
    UNION ALL SELECT 'extras', count(*) FILTER (co AND NOT st) FROM pairs
    UNION ALL SELECT 'dif_total', count(*) FILTER (st AND co AND differ) FROM pairs"""
)


@query("reconcile_demand", _RECONCILED)
def reconcile_demand(t):
    stored = gold.monthly_demand(_older_receipts(t, request_date=False), t.groups())
    return reconcile.demand(stored, monthly_demand(t))


@query("reconcile_by_digests", _RECONCILED)
def reconcile_by_digests(t):
    """Both tables are staged: the digests read them first, then the comparison of the buckets that differ."""
    stored = gold.monthly_demand(_older_receipts(t, request_date=False), t.groups())
    sides = (stage(side, "demand", compression="zstd") for side in (stored, monthly_demand(t)))
    return reconcile.demand(*sides, by_digests=True)


@query(
    "reconcile_metrics",
    """WITH timed AS (SELECT solpro, solusr, solcan, nrcfec - solfec AS days, soltip = 'R' AND solord = 2 AS late
                     FROM b_receipts WHERE solpro IN (SELECT acrecodi FROM b_suppliers) AND nrcfec - solfec IS NOT NULL),
       stored AS (SELECT solpro, [count(*), sum(days), sum(days * days), sum(solcan)] AS facts FROM timed
                  WHERE solusr <> 'USR-4' AND NOT (late AND solusr IN ('USR-1', 'USR-2')) GROUP BY solpro),
       computed AS (SELECT solpro, [count(*), sum(days), sum(days * days), sum(solcan)] AS facts FROM timed
                    WHERE solusr <> 'USR-5' GROUP BY solpro)
    SELECT (SELECT count(*) FROM stored) AS stored, (SELECT count(*) FROM computed) AS computed,
           (SELECT count(*) FROM stored WHERE solpro NOT IN (SELECT solpro FROM computed)) AS missing,
           (SELECT count(*) FROM computed WHERE solpro NOT IN (SELECT solpro FROM stored)) AS extra,
           (SELECT count(*) FROM stored s JOIN computed c USING (solpro) WHERE s.facts <> c.facts) AS different""",
)
def reconcile_metrics(t):
    """Stored without some late receipts and without users USR-4; recomputed without users USR-5."""
    late = (F.col("soltip") == "R") & (F.col("solord") == 2) & F.col("solusr").isin("USR-1", "USR-2")
    receipts = t.receipts(catalogue=False)
    stored = gold.supplier_metrics(receipts.filter(~late & (F.col("solusr") != "USR-4")), t.suppliers())
    return reconcile.metrics(stored, gold.supplier_metrics(receipts.filter(F.col("solusr") != "USR-5"), t.suppliers()))


@query(
    "expected_counts",
    """SELECT 'metricas_prediccion_proveedor' AS table_name, (SELECT count(*) FROM g_metrics) AS n,
              (SELECT count(DISTINCT acrecodi) FROM b_suppliers) AS expected,
              CASE WHEN (SELECT count(*) FROM g_metrics) = (SELECT count(DISTINCT acrecodi) FROM b_suppliers)
                   THEN 'OK' ELSE 'NO COINCIDE' END AS status
       UNION ALL SELECT 'prediccion_demanda_mensual', (SELECT count(*) FROM g_demand),
              (SELECT count(*) FROM b_receipts),
              CASE WHEN (SELECT count(*) FROM g_demand) = (SELECT count(*) FROM b_receipts) THEN 'OK' ELSE 'NO COINCIDE' END""",
)
def expected_counts(t):
    """Expected here: a row per supplier, and (wrongly) a demand row per receipt."""
    produced = {
        "metricas_prediccion_proveedor": gold.supplier_metrics(t.receipts(catalogue=False), t.suppliers()),
        "prediccion_demanda_mensual": monthly_demand(t),
    }
    suppliers = t.suppliers().agg(F.count_distinct("acrecodi").alias("expected"))
    receipts = t.receipts(False, False).agg(F.count("*").alias("expected"))
    expectations = suppliers.select(F.lit("metricas_prediccion_proveedor").alias("table_name"), "expected").union(
        receipts.select(F.lit("prediccion_demanda_mensual"), "expected")
    )
    return reconcile.expected_counts(produced, expectations)


@query(
    "orphan_demand_rows",
    f"""SELECT artcitem, artgrinv, periodo_mes, {doubles("cantidad_total_despachada")}, frecuencia_pedidos FROM g_demand
        WHERE artcitem NOT IN (SELECT artcitem FROM b_items)""",
)
def orphan_demand_rows(t):
    rows = reports.orphan_demand(monthly_demand(t), t.items())
    return rows.select(
        "artcitem", "artgrinv", F.to_date("periodo_mes").alias("periodo_mes"), "cantidad_total_despachada", "frecuencia_pedidos"
    )


# -- reports -----------------------------------------------------------------------------------------------------------


@query(
    "rep_kpis",
    """SELECT 'solicitudes' AS indicador, count(*) AS total FROM n_requests
       UNION ALL SELECT 'recepciones', count(*) FROM b_receipts
       UNION ALL SELECT 'articulos', count(DISTINCT artcitem) FROM b_items
       UNION ALL SELECT 'proveedores', count(*) FROM b_suppliers""",
)
def rep_kpis(t):
    return reports.kpis(t.requests(), t.receipts(False, False), t.items(), t.suppliers())


@query(
    "rep_items_by_group",
    """WITH sizes AS (SELECT artgrinv, count(DISTINCT artcitem) AS cantidad FROM b_items GROUP BY artgrinv)
       SELECT nombre AS grupo, cantidad FROM sizes NATURAL JOIN b_groups
       UNION ALL SELECT '(sin grupo)', sum(cantidad)::BIGINT FROM sizes WHERE artgrinv NOT IN (SELECT artgrinv FROM b_groups)
       HAVING count(*) > 0""",
)
def rep_items_by_group(t):
    return reports.items_by_group(normalized.items(t.items(), t.groups()), t.groups())


@query(
    "rep_requests_monthly",
    f"""SELECT CAST(date_trunc('month', solfec) AS DATE) AS mes, count(*) AS cantidad,
               CAST(sum(solcan) AS DOUBLE) AS total_cantidad,
               round(CAST(sum(solpre) AS DOUBLE) / count(solpre), 4) AS precio_promedio
        FROM b_requests WHERE solfec IS NOT NULL GROUP BY 1""",
    precio_promedio=4,
)
def rep_requests_monthly(t):
    return reports.requests_monthly(t.requests())


@query(
    "rep_top_items",
    """WITH asked AS (SELECT artcitem, count(*) AS n, sum(solcan) AS total FROM b_requests
                     WHERE artcitem IN (SELECT artcitem FROM b_items) GROUP BY artcitem),
       ranked AS (SELECT *, rank() OVER (ORDER BY n DESC, artcitem) AS place FROM asked)
       SELECT artcitem, artdes, n AS veces_solicitado, total::DOUBLE AS total_cantidad
       FROM ranked JOIN b_items USING (artcitem) WHERE place <= 15""",
)
def rep_top_items(t):
    return reports.top_items(normalized.requests(t.requests(), t.items(), t.suppliers()), t.items())


@query(
    "rep_receipts_monthly",
    """SELECT CAST(date_trunc('month', nrcfec) AS DATE) AS mes, count(*) AS recepciones,
              CAST(sum(nrdcac) AS DOUBLE) AS total_recibido,
              round(CAST(sum(solpre) AS DOUBLE) / count(solpre), 4) AS precio_promedio
       FROM b_receipts WHERE nrcfec IS NOT NULL GROUP BY 1""",
    precio_promedio=4,
)
def rep_receipts_monthly(t):
    return reports.receipts_monthly(t.receipts(False, False))


@query(
    "rep_top_suppliers",
    """WITH codes AS (SELECT solpro AS acrecodi, count(*) AS n, sum(solcan) AS total FROM b_receipts GROUP BY 1),
       named AS (SELECT acreraso, sum(n)::BIGINT AS n, sum(total)::DOUBLE AS total FROM codes JOIN b_suppliers USING (acrecodi)
                 GROUP BY acreraso),
       ranked AS (SELECT *, rank() OVER (ORDER BY total DESC, acreraso) AS place FROM named)
       SELECT acreraso AS proveedor, n AS recepciones, total AS cantidad_total FROM ranked WHERE place <= 10""",
)
def rep_top_suppliers(t):
    return reports.top_suppliers(t.receipts(False, False), t.suppliers())


@query(
    "rep_top_stock",
    f"""WITH ranked AS (SELECT artcitem, ubialm, ubistock, rank() OVER (ORDER BY ubistock DESC, artcitem, ubialm) AS place
                        FROM b_stock WHERE ubistock >= 0 OR ubistock < 0),
        names AS (SELECT artcitem, artdes FROM b_items)
        SELECT artcitem, artdes, ubialm, {doubles("ubistock")} FROM ranked LEFT JOIN names USING (artcitem) WHERE place <= 20""",
)
def rep_top_stock(t):
    return reports.top_stock(t.stock(catalogue=False), t.items())


@query("rep_items_by_unit", "SELECT artmed, count(*) AS cantidad FROM b_items WHERE artmed IS NOT NULL GROUP BY 1")
def rep_items_by_unit(t):
    return reports.items_by_unit(t.items())


@query("rep_stock_monthly", "SELECT ds, y FROM s_stock")
def rep_stock_monthly(t):
    return reports.stock_monthly(t.receipts(False, False))


@query(
    "rep_product_share",
    f"""SELECT artcitem, artdes, grupo, {doubles("stock_total")}, round(participacion, 10) AS participacion FROM r_share""",
    participacion=10,
)
def rep_product_share(t):
    items = normalized.items(t.items(), t.groups())
    receipts = normalized.receipts_without_id(t.receipts(False, False), items=items)
    return reports.product_share(receipts, items, t.groups())


@query(
    "rep_price_training_set",
    f"SELECT solfec, {doubles('solpre solcan')} FROM b_requests WHERE solfec IS NOT NULL AND solpre > 0",
)
def rep_price_training_set(t):
    return reports.price_training_set(t.requests())


@query(
    "rep_recent_receipts",
    """WITH costs AS (SELECT artcitem, artcosu1 FROM b_items),
       dated AS (SELECT make_date(year(nrcfec), month(nrcfec), 1) AS mes, solnum, nrdcac, artcosu1
                 FROM n_receipts JOIN costs USING (artcitem) WHERE nrcfec > DATE '0001-01-01'),
       placed AS (SELECT *, dense_rank() OVER (ORDER BY mes DESC) AS place FROM dated)
       SELECT mes, count(DISTINCT solnum) AS pedidos, sum(nrdcac)::DOUBLE AS recibido,
              round(sum(artcosu1)::DOUBLE / count(artcosu1), 4) AS costo_promedio
       FROM placed WHERE place <= 5 GROUP BY mes""",
    costo_promedio=4,
)
def rep_recent_receipts(t):
    receipts = normalized.receipts_without_id(t.receipts(False, False), t.requests(), t.items())
    return reports.recent_receipts(receipts, t.items())


@query(
    "rep_recent_demand",
    """SELECT periodo_mes AS mes, count(DISTINCT artcitem) AS articulos,
              CAST(sum(cantidad_total_despachada) AS DOUBLE) AS demanda_total
       FROM g_demand GROUP BY 1 ORDER BY 1 DESC LIMIT 5""",
)
def rep_recent_demand(t):
    return reports.recent_demand(monthly_demand(t))


# -- forecasts ---------------------------------------------------------------------------------------------------------


def _line_sql(source: str, series: str = "") -> str:
    """Fitted line and residual deviation of every series, then six months ahead; flat at zero without any value."""
    by = f"{series}, " if series else ""
    over = f"PARTITION BY {series}" if series else ""
    group = f"GROUP BY {series}" if series else ""
    joined = f"USING ({series})" if series else "ON true"
    return f"""
    WITH numbered AS (SELECT *, CASE WHEN y IS NOT NULL THEN
                             CAST(count(y) OVER ({over} ORDER BY ds ROWS UNBOUNDED PRECEDING) - 1 AS DOUBLE) END AS t FROM {source}),
    fit AS (SELECT {by}count(y) AS n, max(ds) AS last_ds, coalesce(regr_slope(y, t), 0) AS slope,
                   coalesce(regr_intercept(y, t), max(y), 0) AS intercept FROM numbered {group}),
    spread AS (SELECT {by}coalesce(stddev_pop(y - (intercept + slope * t)), 0) AS dev FROM numbered JOIN fit {joined} {group}),
    ahead AS (SELECT {by}step, CAST(last_ds + to_months(CAST(step AS INTEGER)) AS DATE) AS ds,
                     greatest(intercept + slope * (n - 1 + step), 0) AS yhat, dev
              FROM fit JOIN spread {joined} CROSS JOIN range(1, 7) r(step))"""


def _odd_series(t):
    """Stock by group and month: groups on 1 end with two empty months, on 2 are empty, on 3 fall below zero."""
    series = reports.stock_monthly(t.receipts(request_date=False), ("artgrinv",))
    ends = series.agg(F.max("ds")).scalar()
    digit, age = F.right("artgrinv", F.lit(1)), F.months_between(ends, "ds")
    y = F.when(((digit == "1") & (age < 2)) | (digit == "2"), None).when(digit == "3", 1000 * age - 2500).otherwise(F.col("y"))
    return series.withColumn("y", y)


@query("fc_requests_linear", _line_sql("s_requests") + " SELECT ds AS mes, CAST(trunc(yhat) AS BIGINT) AS cantidad FROM ahead")
def fc_requests_linear(t):
    return forecast.request_forecast(reports.request_counts_monthly(t.requests()))


@query(
    "fc_linear_trend",
    _line_sql("s_odd", "artgrinv")
    + """ SELECT artgrinv, ds, round(yhat, 2) AS yhat, round(yhat - 1.96 * dev, 2) AS yhat_lower,
          round(yhat + 1.96 * dev, 2) AS yhat_upper FROM ahead""",
    yhat=2,
    yhat_lower=2,
    yhat_upper=2,
)
def fc_linear_trend(t):
    return forecast.linear_trend(_odd_series(t), ["artgrinv"])


@query(
    "fc_future_months",
    """SELECT artgrinv, CAST(last_ds + to_months(CAST(step AS INTEGER)) AS DATE) AS ds
       FROM (SELECT artgrinv, max(ds) AS last_ds FROM s_group GROUP BY 1) CROSS JOIN range(1, 7) r(step)""",
)
def fc_future_months(t):
    return forecast.future_months(reports.stock_monthly(t.receipts(request_date=False), ("artgrinv",)), ["artgrinv"])


def _curve_sql(source: str, series: str = "", prefix: str = "") -> str:
    """Bending trend and yearly waves by ridge: the design of every series, its normal equations, elimination, the curve."""
    by, group = (f"{series}, ", f"GROUP BY {series}") if series else ("", "")
    waves = ", ".join(f"{wave}(2 * pi() / 365.25 * (CAST(ds AS DATE) - DATE '1970-01-01') * {k})" for k in range(1, 7) for wave in ("sin", "cos"))
    same = f"p.{series} = q.{series} AND" if series else ""
    return f"""
    WITH RECURSIVE {prefix}months AS (
        SELECT {by}max(ds) AS month_end, count(y) AS n, min(ds) FILTER (y IS NOT NULL) AS first_ds,
               max(ds) FILTER (y IS NOT NULL) AS last_ds, coalesce(nullif(max(abs(y)), 0), 1) AS scale,
               list(ds ORDER BY ds) FILTER (y IS NOT NULL) AS days FROM {source} {group}),
    {prefix}shape AS (
        SELECT *, greatest(coalesce(last_ds - first_ds, 0), 1) AS span, coalesce(last_ds - first_ds >= 730, false) AS yearly,
               CAST(floor(n * 0.8) AS INTEGER) AS reach FROM {prefix}months),
    {prefix}bent AS (
        SELECT *, coalesce(list_transform(range(1, least(25, greatest(reach - 1, 0)) + 1),
                  lambda j: (days[CAST(floor(j * (reach - 1) / least(25, reach - 1) + 0.5) AS INTEGER) + 1] - first_ds) / span), []) AS bends
        FROM {prefix}shape),
    {prefix}days AS (SELECT {by}ds, y FROM {source} WHERE y IS NOT NULL UNION ALL
             SELECT {by}CAST(month_end + to_months(CAST(step AS INTEGER)) AS DATE), NULL FROM {prefix}months CROSS JOIN range(1, 7) r(step)),
    {prefix}design AS (
        SELECT {"p." + series + ", " if series else ""}ds, y, scale, n, month_end, len(bends) AS m,
               list_concat([1.0::DOUBLE, (ds - first_ds) / span],
                           list_transform(bends, lambda b: greatest((ds - first_ds) / span - b, 0.0::DOUBLE)),
                           CASE WHEN yearly THEN [{waves}] ELSE [] END) AS x
        FROM {prefix}days p JOIN {prefix}bent q ON {same} true),
    {prefix}products AS (
        SELECT {by}i, j, sum(x[i] * CASE WHEN j > len(x) THEN y / scale ELSE x[j] END)
               + CASE WHEN i <> j THEN 0 WHEN i <= 2 THEN 1e-6 ELSE 0.01 END AS v
        FROM {prefix}design CROSS JOIN (SELECT unnest(range(1, 40)) AS i) CROSS JOIN (SELECT unnest(range(1, 41)) AS j)
        WHERE y IS NOT NULL AND i <= len(x) AND j <= len(x) + 1 GROUP BY {by}i, j),
    {prefix}lines AS (SELECT {by}i, list(v ORDER BY j) AS line FROM {prefix}products GROUP BY {by}i),
    {prefix}solving AS (
        SELECT {by}1 AS k, list(line ORDER BY i) AS m FROM {prefix}lines {group}
        UNION ALL SELECT {by}k + 1, list_transform(m, lambda line, i: CASE WHEN i = k THEN list_transform(line, lambda v: v / line[k])
            ELSE list_transform(line, lambda v, j: v - line[k] * (m[k][j] / m[k][k])) END) FROM {prefix}solving WHERE k <= len(m)),
    {prefix}weights AS (SELECT {by}list_transform(m, lambda line: line[-1]) AS w FROM {prefix}solving WHERE k = len(m) + 1),
    {prefix}values AS (
        SELECT {"p." + series + ", " if series else ""}ds, y, ds > month_end AS is_future,
               CASE WHEN n = 0 THEN 0 ELSE list_dot_product(x, w) * scale END AS yhat
        FROM {prefix}design p LEFT JOIN {prefix}weights q ON {same} true),
    {prefix}curve AS (
        SELECT *, 1.2816 * coalesce(stddev_pop(y - yhat) OVER ({"PARTITION BY " + series if series else ""}), 0) AS band
        FROM {prefix}values)"""


@query(
    "fc_seasonal_trend",
    _curve_sql("s_odd", "artgrinv")
    + """ SELECT artgrinv, ds, round(yhat, 2) AS yhat, round(yhat - band, 2) AS yhat_lower,
          round(yhat + band, 2) AS yhat_upper, is_future FROM curve""",
    yhat=2,
    yhat_lower=2,
    yhat_upper=2,
)
def fc_seasonal_trend(t):
    return forecast.seasonal_trend(_odd_series(t), ["artgrinv"])


@query(
    "fc_lag_features",
    "WITH span AS (SELECT *, min(y) OVER (PARTITION BY artgrinv) AS lo, max(y) OVER (PARTITION BY artgrinv) AS hi "
    "FROM s_group WHERE y IS NOT NULL), scaled AS (SELECT artgrinv, ds, (y - lo) / (hi - lo) AS target FROM span WHERE hi > lo), "
    "lagged AS (SELECT artgrinv, ds, target, "
    + ", ".join(f"lag(target, {k}) OVER (PARTITION BY artgrinv ORDER BY ds) AS lag_{k}" for k in range(1, 13))
    + " FROM scaled) SELECT artgrinv, ds, round(target, 8) AS target, "
    + ", ".join(f"round(lag_{k}, 8) AS lag_{k}" for k in range(1, 13))
    + " FROM lagged WHERE lag_12 IS NOT NULL",
    target=8,
    **{f"lag_{k}": 8 for k in range(1, 13)},
)
def fc_lag_features(t):
    series = reports.stock_monthly(t.receipts(request_date=False), ("artgrinv",))
    windows = forecast.lag_features(series, ["artgrinv"])
    lags = [F.element_at("lags", -k).alias(f"lag_{k}") for k in range(1, 13)]
    return windows.select("artgrinv", "ds", "target", *lags)


@query(
    "fc_flat_fallback",
    """SELECT artcitem, soltip, count(y) AS n, min(y) AS y_min, max(y) AS y_max, max(ds) FILTER (y IS NOT NULL) AS last_ds,
              arg_max(y, ds) FILTER (y IS NOT NULL) AS y_last,
              CASE WHEN count(y) = 0 THEN 'empty' WHEN min(y) = max(y) THEN 'constant' WHEN count(y) <= 12 THEN 'short'
                   ELSE 'model' END AS method,
              CASE WHEN count(y) = 0 THEN 0.0 WHEN min(y) = max(y) THEN min(y)
                   WHEN count(y) <= 12 THEN arg_max(y, ds) FILTER (y IS NOT NULL) END AS base,
              CASE WHEN NOT (count(y) > 12 AND min(y) < max(y)) THEN CAST(0.0 AS DOUBLE) END AS band
       FROM s_item GROUP BY 1, 2""",
)
def fc_flat_fallback(t):
    series = reports.stock_monthly(t.receipts(False, False), ("artcitem", "soltip"))
    return forecast.flat_fallback(series, ["artcitem", "soltip"])


@query("fc_autoregressive")
def fc_autoregressive(t):
    """A fitted learner: no SQL can say what it should give."""
    series = reports.stock_monthly(t.receipts(request_date=False), ("artgrinv",))
    return forecast.autoregressive(series, ["artgrinv"])


@query("fc_price_forest")
def fc_price_forest(t):
    """Random draws: no SQL can say what they give; tests hold the same draws against trees grown in plain Python."""
    return forest.price_forest(reports.price_training_set(t.requests()))


@query(
    "fc_allocate_top15",
    _curve_sql("s_stock", prefix="y_")
    + ","
    + _line_sql("s_stock").removeprefix("\n    WITH")
    + """,
    coming AS (SELECT 'linear' AS model, ds, yhat FROM ahead
               UNION ALL SELECT 'seasonal', ds, yhat FROM y_curve WHERE is_future)
    SELECT model, artcitem, artdes, grupo, ds AS mes, round(participacion * yhat, 4) AS cantidad_estimada
    FROM (SELECT *, row_number() OVER (PARTITION BY model, ds ORDER BY participacion * yhat DESC NULLS LAST, artcitem NULLS LAST) AS rn
          FROM coming CROSS JOIN r_share) WHERE rn <= 15""",
    cantidad_estimada=4,
)
def fc_allocate_top15(t):
    items = normalized.items(t.items(), t.groups())
    receipts = normalized.receipts_without_id(t.receipts(False, False), items=items)
    return outlook.product_outlooks(receipts, items, t.groups(), ("linear", "seasonal"))
