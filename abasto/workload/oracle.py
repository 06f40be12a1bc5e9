"""The same domain views in DuckDB SQL, to check the Spark plans against.

``sql(body)`` puts the views the body names in front of it, as CTEs.
"""

from __future__ import annotations

import re

MONEY = "DECIMAL(15,2)"


def _text_day(day: str, selector: str) -> str:
    return (
        f"CASE (({selector}) % 3) WHEN 0 THEN strftime({day}, '%y%m%d') WHEN 1 THEN strftime({day}, '%Y-%m-%d') "
        "ELSE 'n/a' END"
    )


def _zeros(names: str) -> str:
    return ", ".join(f"'0' AS {name}" for name in names.split())


def decimal_of(text: str) -> str:
    return f"CAST(NULLIF(regexp_replace({text}, '[^0-9.\\-]', '', 'g'), '') AS {MONEY})"


def integer_of(text: str, target: str = "INTEGER") -> str:
    return f"CAST(NULLIF(regexp_replace({text}, '[^0-9\\-]', '', 'g'), '') AS {target})"


def day_of(text: str) -> str:
    year = f"(CASE WHEN substr({text}, 1, 2) < '70' THEN '20' ELSE '19' END || {text})"
    return (
        f"CASE WHEN regexp_matches({text}, '^[0-9]{{6}}\\z') THEN CAST(strptime({year}, '%Y%m%d') AS DATE) "
        f"WHEN regexp_matches({text}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\\z') THEN CAST({text} AS DATE) END"
    )


def latest_sql(receipts: str) -> str:
    """The receipt that closes each item and month: the last day's, of these the highest number (none counts as highest)."""
    return f"""
        WITH counted AS (SELECT *, make_date(year(nrcfec), month(nrcfec), 1) AS mes FROM {receipts}
                         WHERE artstock >= 0 OR artstock < 0),
        ends AS (SELECT artcitem, mes, max(nrcfec) AS nrcfec FROM counted GROUP BY ALL),
        last_day AS (SELECT *, coalesce(nrcnum, 2147483647) AS number FROM counted JOIN ends USING (artcitem, mes, nrcfec))
        SELECT * EXCLUDE (number) FROM last_day
        WHERE (artcitem, mes, number) IN (SELECT artcitem, mes, max(number) FROM last_day GROUP BY ALL)
        QUALIFY 1 = count(*) OVER (PARTITION BY artcitem, mes ORDER BY solnum, solord, solcan, solpre, artstock
                                   ROWS UNBOUNDED PRECEDING)"""


def demand_sql(receipts: str, latest: str) -> str:
    """Sums by item, group and month, with the group's name and the closing stock."""
    return f"""
        SELECT s.*, nombre AS grupo_nombre, closing
        FROM (SELECT artcitem, artgrinv, make_date(year(nrcfec), month(nrcfec), 1) AS mes, sum(solcan) AS quantity,
                     count(DISTINCT solnum) AS requests, sum(solpre) AS price_sum, count(solpre) AS n_prices
              FROM {receipts} WHERE nrcfec > DATE '0001-01-01' GROUP BY ALL) s
        LEFT JOIN b_groups USING (artgrinv)
        LEFT JOIN (SELECT artcitem, mes, artstock AS closing FROM {latest}) USING (artcitem, mes)"""


VIEWS = {
    "b_groups": "SELECT DISTINCT p_brand AS artgrinv, 'Group ' || p_brand AS nombre FROM part",
    "b_suppliers": """
        SELECT 'PRV-' || s_suppkey AS acrecodi, 'Supplier ' || (s_suppkey % 40) AS acreraso,
               'Street ' || s_nationkey AS acredire,
               CASE WHEN s_nationkey % 2 = 1 THEN CAST(900000000 + s_suppkey AS VARCHAR) END AS acretelf,
               'City ' || s_nationkey AS acreciud, CAST(NULL AS VARCHAR) AS acreiden,
               CAST(20000000000 + s_suppkey AS VARCHAR) AS acreruc, s_acctbal
        FROM supplier""",
    "b_items": f"""
        SELECT 'ART-' || p_partkey AS artcitem, p_name AS artdes, p_type AS artmed,
               CASE WHEN p_size = 7 THEN 'X' || p_brand ELSE p_brand END AS artgrinv,
               CAST(p_retailprice AS {MONEY}) AS artcosu1, p_size AS artstseg,
               CASE WHEN p_size % 3 <> 2 THEN DATE '2000-01-01' + p_size END AS artfusal,
               DATE '1999-06-01' + p_size AS artfuent,
               CASE WHEN p_size % 2 = 1 THEN 'U' || p_size END AS artubi,
               CAST(p_retailprice AS {MONEY}) AS artcoum1,
               CASE WHEN p_size % 3 = 0 THEN 'USD' END AS artcmon, CAST(p_size AS {MONEY}) AS artpreu2
        FROM part""",
    "b_requests": f"""
        SELECT o_orderkey AS solnum,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'OLD-' ELSE 'ART-' END
                   || o_custkey AS artcitem,
               o_orderstatus AS soltip, CAST(o_custkey % 37 AS {MONEY}) AS solcan,
               substr(o_orderpriority, 1, 1) AS solurg, 'USR-' || (o_custkey % 50) AS solusr,
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS solfec,
               CAST(o_orderkey % 1000 AS INTEGER) AS solord, CAST(o_custkey % 2 AS INTEGER) AS solmon,
               CAST(o_totalprice AS {MONEY}) AS solpre, o_orderstatus AS solsts, 2 AS solsta,
               CASE WHEN o_custkey % 11 = 3 THEN 'EX-' ELSE 'PRV-' END || (o_custkey % 97) AS solpro
        FROM orders""",
    "b_requests_full": """
        SELECT r.*, i.artdes, i.artmed, i.artgrinv FROM b_requests r LEFT JOIN b_items i ON r.artcitem = i.artcitem""",
    "b_receipts": f"""
        SELECT CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' AND l_linenumber = 6 THEN -l_orderkey
                    ELSE l_orderkey END AS solnum,
               CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' AND l_linenumber = 5 THEN 'OLD-' ELSE 'ART-' END
                   || l_partkey AS artcitem,
               p_name AS artdes, p_type AS artmed, p_brand AS artgrinv, CAST(l_quantity AS {MONEY}) AS solcan,
               CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity - 1 ELSE l_quantity END AS {MONEY}) AS nrdcac,
               CASE WHEN NOT (l_linestatus = 'O' AND l_linenumber = 1) THEN CAST(l_extendedprice AS {MONEY}) END AS artstock,
               CAST(l_extendedprice AS {MONEY}) AS solpre, CAST(l_linenumber % 2 AS INTEGER) AS solmon,
               l_linestatus AS solurg, 'USR-' || (l_suppkey % 50) AS solusr,
               CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS nrcfec,
               CAST(o_orderdate AS DATE) AS solfec,
               CASE WHEN l_returnflag <> 'A' THEN l_linenumber END AS nrcnum, l_linenumber AS solord,
               l_returnflag AS soltip,
               CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' AND l_linenumber = 4 THEN 'EX-' ELSE 'PRV-' END
                   || l_suppkey AS solpro
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey""",
    "b_stock": f"""
        SELECT CASE WHEN l_partkey % 50 = 7 THEN 'OLD-' ELSE 'ART-' END || l_partkey AS artcitem,
               any_value(p_name) AS artdes, any_value(p_type) AS artmed, any_value(p_brand) AS artgrinv,
               CAST(40 + l_suppkey % 3 AS VARCHAR) AS ubialm,
               CASE WHEN count(*) > 2 THEN CAST(sum(CAST(l_quantity AS {MONEY})) AS {MONEY}) END AS ubistock,
               CASE WHEN any_value(p_size) % 3 <> 1 THEN DATE '2000-01-01' + any_value(p_size) END AS artfusal,
               CAST(count(*) AS VARCHAR) AS artuptrn,
               max(CASE WHEN l_linenumber = 7 THEN CAST(l_shipdate AS DATE) END) AS artfureq,
               DATE '1999-06-01' + any_value(p_size + p_size // 40) AS artfuent,
               CASE WHEN any_value(p_size) % 3 <> 1 THEN DATE '2000-01-01' + any_value(p_size) END AS artfusal_1,
               any_value(CAST(p_retailprice AS {MONEY})) AS artcoum1
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_partkey, l_suppkey % 3""",
    # bronze
    "z_grupos": "SELECT '  ' || artgrinv || ' ' AS artgrinv, ' ' || nombre AS nombre FROM b_groups",
    "z_proveedores": """
        SELECT CASE WHEN s_acctbal < 0 THEN '   ' ELSE ' ' || acrecodi END AS acrecodi, acreraso || '  ' AS acreraso,
               ' ' || acredire AS acredire, coalesce(acretelf, '  ') AS acretelf, acreciud, '   ' AS acreiden, acreruc
        FROM b_suppliers""",
    "z_maestro_articulos": f"""
        SELECT ' ' || artcitem AS artcitem, artdes || '  ' AS artdes, ' ' || artmed AS artmed, artgrinv,
               'S/ ' || artcosu1 AS artcosu1, 'N° ' || artstseg AS artstseg,
               {_text_day("artfusal", "artstseg")} AS artfusal, {_text_day("artfuent", "artstseg + 1")} AS artfuent,
               coalesce(' ' || artubi, '  ') AS artubi, artcoum1 || ' PEN' AS artcoum1, coalesce(artcmon, '') AS artcmon,
               CAST(artpreu2 AS VARCHAR) AS artpreu2
        FROM b_items""",
    "z_articulos": f"""
        SELECT ' ' || artcitem AS artcitem, artdes || ' ' AS artdes, artmed, artgrinv, ' ' || ubialm || ' ' AS ubialm,
               coalesce('+' || ubistock, ' x ') AS ubistock,
               {_text_day("artfusal", "CAST(artuptrn AS INTEGER)")} AS artfusal, ' ' || artuptrn AS artuptrn,
               {_text_day("artfureq", "CAST(artuptrn AS INTEGER) + 1")} AS artfureq,
               {_text_day("artfuent", "CAST(artuptrn AS INTEGER) + 2")} AS artfuent,
               {_text_day("artfusal_1", "CAST(artuptrn AS INTEGER)")} AS artfusal_1, 'S/' || artcoum1 AS artcoum1
        FROM b_stock""",
    "z_recepcion": f"""
        SELECT CASE WHEN solurg = 'O' AND soltip = 'A' AND solord = 2 THEN '  ' ELSE 'N° ' || solnum END AS solnum,
               ' ' || artcitem AS artcitem, artdes || ' ' AS artdes, artmed,
               CASE WHEN solord = 3 THEN '  ' ELSE artgrinv END AS artgrinv, solcan || ' UN' AS solcan,
               CAST(nrdcac AS VARCHAR) AS nrdcac, coalesce(' S/ ' || artstock || ' ', ' ') AS artstock,
               ' S/ ' || solpre AS solpre, CAST(solmon AS VARCHAR) AS solmon, '40' AS nrcalm, ' ' || solurg AS solurg,
               CASE WHEN solord = 4 THEN '' ELSE solusr END AS solusr, {_text_day("nrcfec", "solord")} AS nrcfec,
               {_text_day("solfec", "solord + 1")} AS solfec, '' AS solfor,
               coalesce(CAST(nrcnum AS VARCHAR), '') AS nrcnum, '#' || solord AS solord, soltip, '0' AS solcpr,
               solpro || ' ' AS solpro, '1' AS nrcpro, CASE WHEN solord = 1 THEN ' ' ELSE 'G-1' END AS nrcgui,
               {_zeros("solara solcaf solcen solsta solcac")}
        FROM b_receipts""",
    "z_solicitudes": f"""
        SELECT CASE WHEN solurg = '1' AND solsts = 'P' THEN '   ' ELSE ' N° ' || solnum END AS solnum,
               artcitem || ' ' AS artcitem, coalesce(artdes, ' ') AS artdes, ' ' || soltip AS soltip,
               solcan || ' UN' AS solcan, CASE WHEN solurg = '3' THEN ' ' ELSE solurg END AS solurg, solusr,
               {_text_day("solfec", "solord")} AS solfec, '#' || solord AS solord, CAST(solmon AS VARCHAR) AS solmon,
               'S/ ' || solpre AS solpre, solsts, CAST(solsta AS VARCHAR) AS solsta, ' ' || solpro AS solpro,
               {_zeros("solcpr solara solmaq solfap solfor")}, coalesce(artmed, ' ') AS artmed,
               coalesce(artgrinv, '') AS artgrinv, {_zeros("solcaf solcen solcac")}
        FROM b_requests_full""",
    # normalized
    "n_items": """
        SELECT i.* REPLACE (g.artgrinv AS artgrinv) FROM b_items i LEFT JOIN b_groups g ON i.artgrinv = g.artgrinv""",
    "n_requests": """
        SELECT r.* REPLACE (i.artcitem AS artcitem, s.acrecodi AS solpro) FROM b_requests r
        LEFT JOIN b_items i ON r.artcitem = i.artcitem LEFT JOIN b_suppliers s ON r.solpro = s.acrecodi""",
    "n_receipts": """
        SELECT r.* REPLACE (q.solnum AS solnum, i.artcitem AS artcitem) FROM b_receipts r
        LEFT JOIN b_requests q ON r.solnum = q.solnum LEFT JOIN b_items i ON r.artcitem = i.artcitem""",
    # gold
    "g_metrics": """
        SELECT proveedor_id, n AS total_atenciones, days / n AS lead_time_promedio_dias,
               CASE WHEN n > 1 THEN sqrt((n * squares - days * days) / (n * (n - 1))) END AS desviacion_lead_time,
               volumen_total_suministrado
        FROM (SELECT solpro AS proveedor_id, count(*) AS n, sum(d)::DOUBLE AS days, sum(d * d)::DOUBLE AS squares,
                     sum(solcan) AS volumen_total_suministrado
              FROM (SELECT solpro, solcan, datediff('day', solfec, nrcfec) AS d FROM b_receipts) WHERE d IS NOT NULL GROUP BY 1)
        WHERE proveedor_id IN (SELECT acrecodi FROM b_suppliers)""",
    "g_latest": latest_sql("b_receipts"),
    "g_sums": demand_sql("b_receipts", "g_latest"),
    "g_demand": """
        SELECT artcitem, artgrinv, grupo_nombre, mes AS periodo_mes, quantity AS cantidad_total_despachada,
               requests AS frecuencia_pedidos, price_sum::DOUBLE / n_prices AS precio_promedio_pactado,
               closing AS ultimo_stock_registrado FROM g_sums""",
    # series and shares
    "s_stock": """
        SELECT CAST(date_trunc('month', nrcfec) AS DATE) AS ds, CAST(sum(artstock) AS DOUBLE) AS y
        FROM b_receipts WHERE nrcfec IS NOT NULL GROUP BY 1""",
    "s_group": """
        SELECT artgrinv, CAST(date_trunc('month', nrcfec) AS DATE) AS ds, CAST(sum(artstock) AS DOUBLE) AS y
        FROM b_receipts WHERE nrcfec IS NOT NULL GROUP BY 1, 2""",
    "s_odd": """
        SELECT artgrinv, ds, CASE WHEN (right(artgrinv, 1) = '1' AND age < 2) OR right(artgrinv, 1) = '2' THEN NULL
               WHEN right(artgrinv, 1) = '3' THEN CAST(1000 * age - 2500 AS DOUBLE) ELSE y END AS y
        FROM (SELECT *, datediff('month', ds, (SELECT max(ds) FROM s_group)) AS age FROM s_group)""",
    "s_item": """
        SELECT artcitem, soltip, CAST(date_trunc('month', nrcfec) AS DATE) AS ds, CAST(sum(artstock) AS DOUBLE) AS y
        FROM b_receipts WHERE nrcfec IS NOT NULL GROUP BY 1, 2, 3""",
    "s_requests": """
        SELECT CAST(date_trunc('month', solfec) AS DATE) AS ds, CAST(count(*) AS DOUBLE) AS y
        FROM b_requests WHERE solfec IS NOT NULL GROUP BY 1""",
    "r_share": """
        SELECT t.artcitem, i.artdes, g.nombre AS grupo, t.stock_total,
               CAST(t.stock_total AS DOUBLE) / CAST((SELECT sum(artstock) FROM r_year WHERE artstock IS NOT NULL) AS DOUBLE)
                   AS participacion
        FROM (SELECT artcitem, sum(artstock) AS stock_total FROM r_year WHERE artstock IS NOT NULL GROUP BY 1) t
        LEFT JOIN n_items i ON t.artcitem = i.artcitem LEFT JOIN b_groups g ON i.artgrinv = g.artgrinv""",
    "r_year": """
        SELECT * FROM n_receipts WHERE nrcfec >= (SELECT max(nrcfec) - INTERVAL 12 MONTH FROM n_receipts)""",
}


def _needed(text: str, found: dict[str, None]) -> None:
    for name in VIEWS:
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(VIEWS[name], found)
            found[name] = None


def sql(body: str) -> str:
    """The body with the views it uses, in order of need. A body may start with CTEs of its own (``WITH ...``)."""
    found: dict[str, None] = {}
    _needed(body, found)
    views = [f"{name} AS ({VIEWS[name].strip()})" for name in found]
    body = body.strip()
    if body.startswith(start := "WITH RECURSIVE "):
        return start + ",\n".join(views) + (",\n" if views else "") + body.removeprefix(start)
    if body.startswith("WITH "):
        return "WITH " + ",\n".join(views) + (",\n" if views else "") + body[len("WITH ") :]
    return ("WITH " + ",\n".join(views) + "\n" if views else "") + body
