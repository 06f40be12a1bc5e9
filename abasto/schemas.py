"""Table schemas, keys and references of every layer, as data.

Column names, their order and their types are fixed values: the stored tables have to look like this. Whole-number
request numbers and surrogate ids are BIGINT, because INTEGER ends at 2.1 billion rows.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = "decimal(15,2)"

BRONZE = {
    "solicitudes": [
        "solnum", "artcitem", "artdes", "soltip", "solcan", "solurg", "solusr", "solfec", "solord", "solmon",
        "solpre", "solsts", "solsta", "solpro", "solcpr", "solara", "solmaq", "solfap", "solfor", "artmed",
        "artgrinv", "solcaf", "solcen", "solcac",
    ],
    "recepcion": [
        "solnum", "artcitem", "artdes", "artmed", "artgrinv", "solcan", "nrdcac", "artstock", "solpre", "solmon",
        "nrcalm", "solurg", "solusr", "nrcfec", "solfec", "solfor", "nrcnum", "solord", "soltip", "solcpr",
        "solpro", "nrcpro", "nrcgui", "solara", "solcaf", "solcen", "solsta", "solcac",
    ],
    "maestro_articulos": [
        "artcitem", "artdes", "artmed", "artgrinv", "artcosu1", "artstseg", "artfusal", "artfuent", "artubi",
        "artcoum1", "artcmon", "artpreu2",
    ],
    "articulos": [
        "artcitem", "artdes", "artmed", "artgrinv", "ubialm", "ubistock", "artfusal", "artuptrn", "artfureq",
        "artfuent", "artfusal_1", "artcoum1",
    ],
    "grupos": ["artgrinv", "nombre"],
    "proveedores": ["acrecodi", "acreraso", "acredire", "acretelf", "acreciud", "acreiden", "acreruc"],
}

_GROUPS = [
    ("artgrinv", "string"), ("nombre", "string"),
]

_SUPPLIERS = [
    ("acrecodi", "string"), ("acreraso", "string"), ("acredire", "string"), ("acretelf", "string"),
    ("acreciud", "string"), ("acreiden", "string"), ("acreruc", "string"),
]

_ITEMS = [
    ("artcitem", "string"), ("artdes", "string"), ("artmed", "string"), ("artgrinv", "string"),
    ("artcosu1", MONEY), ("artstseg", "int"), ("artfusal", "date"), ("artfuent", "date"), ("artubi", "string"),
    ("artcoum1", MONEY), ("artcmon", "string"), ("artpreu2", MONEY),
]

SILVER = {
    "grupos": _GROUPS,
    "proveedores": _SUPPLIERS,
    "maestro_articulos": _ITEMS,
    "articulos": [
        ("artcitem", "string"), ("artdes", "string"), ("artmed", "string"), ("artgrinv", "string"),
        ("ubialm", "string"), ("ubistock", MONEY), ("artfusal", "date"), ("artuptrn", "string"),
        ("artfureq", "date"), ("artfuent", "date"), ("artfusal_1", "date"), ("artcoum1", MONEY),
    ],
    "recepcion": [
        ("solnum", "bigint"), ("artcitem", "string"), ("artdes", "string"), ("artmed", "string"),
        ("artgrinv", "string"), ("solcan", MONEY), ("nrdcac", MONEY), ("artstock", MONEY), ("solpre", MONEY),
        ("solmon", "int"), ("solurg", "string"), ("solusr", "string"), ("nrcfec", "date"), ("solfec", "date"),
        ("nrcnum", "int"), ("solord", "int"), ("soltip", "string"), ("solpro", "string"),
    ],
    "solicitudes": [
        ("solnum", "bigint"), ("artcitem", "string"), ("artdes", "string"), ("soltip", "string"),
        ("solcan", MONEY), ("solurg", "string"), ("solusr", "string"), ("solfec", "date"), ("solord", "int"),
        ("solmon", "int"), ("solpre", MONEY), ("solsts", "string"), ("solsta", "int"), ("solpro", "string"),
        ("artmed", "string"), ("artgrinv", "string"),
    ],
}

NORMALIZED = {
    "grupos": _GROUPS,
    "proveedores": _SUPPLIERS,
    "maestro_articulos": _ITEMS,
    "fact_solicitudes": [
        ("solnum", "bigint"), ("artcitem", "string"), ("soltip", "string"), ("solcan", MONEY),
        ("solurg", "string"), ("solusr", "string"), ("solfec", "date"), ("solord", "int"), ("solmon", "int"),
        ("solpre", MONEY), ("solsts", "string"), ("solsta", "int"), ("solpro", "string"),
    ],
    "fact_recepcion": [
        ("id_recepcion", "bigint"), ("solnum", "bigint"), ("artcitem", "string"), ("solcan", MONEY),
        ("nrdcac", MONEY), ("artstock", MONEY), ("solpre", MONEY), ("solmon", "int"), ("solurg", "string"),
        ("solusr", "string"), ("nrcfec", "date"), ("solfec", "date"), ("nrcnum", "int"), ("solord", "int"),
        ("soltip", "string"), ("solpro", "string"),
    ],
    "fact_stock": [
        ("artcitem", "string"), ("ubialm", "string"), ("ubistock", MONEY), ("artuptrn", "string"),
        ("artfureq", "date"),
    ],
}

GOLD = {
    "metricas_prediccion_proveedor": [
        ("proveedor_id", "string"), ("total_atenciones", "bigint"), ("lead_time_promedio_dias", "double"),
        ("desviacion_lead_time", "double"), ("volumen_total_suministrado", "decimal(25,2)"),
    ],
    "prediccion_demanda_mensual": [
        ("artcitem", "string"), ("artgrinv", "string"), ("grupo_nombre", "string"), ("periodo_mes", "timestamp"),
        ("cantidad_total_despachada", "decimal(25,2)"), ("frecuencia_pedidos", "bigint"),
        ("precio_promedio_pactado", "decimal(38,15)"), ("ultimo_stock_registrado", MONEY),
    ],
}

LAYERS = {"silver": SILVER, "normalizado": NORMALIZED, "gold": GOLD}

# table -> key columns
PRIMARY_KEYS = {
    "silver": {
        "grupos": ["artgrinv"],
        "proveedores": ["acrecodi"],
        "maestro_articulos": ["artcitem"],
        "articulos": ["artcitem", "ubialm"],
    },
    "normalizado": {
        "grupos": ["artgrinv"],
        "proveedores": ["acrecodi"],
        "maestro_articulos": ["artcitem"],
        "fact_solicitudes": ["solnum"],
        "fact_recepcion": ["id_recepcion"],
        "fact_stock": ["artcitem", "ubialm"],
    },
}

# table -> columns that may not be NULL beyond its key
NOT_NULL = {"silver": {"grupos": ["nombre"]}, "normalizado": {"grupos": ["nombre"]}}

# (table, column, referenced table, referenced column)
FOREIGN_KEYS = [
    ("maestro_articulos", "artgrinv", "grupos", "artgrinv"),
    ("fact_solicitudes", "artcitem", "maestro_articulos", "artcitem"),
    ("fact_solicitudes", "solpro", "proveedores", "acrecodi"),
    ("fact_recepcion", "solnum", "fact_solicitudes", "solnum"),
    ("fact_recepcion", "artcitem", "maestro_articulos", "artcitem"),
    ("fact_recepcion", "solpro", "proveedores", "acrecodi"),
    ("fact_stock", "artcitem", "maestro_articulos", "artcitem"),
]


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
    MONEY: T.DecimalType(15, 2),
    "decimal(25,2)": T.DecimalType(25, 2),
    "decimal(38,15)": T.DecimalType(38, 15),
}


def struct_of(layer: str, table: str) -> T.StructType:
    """The StructType of a table, without a running session; bronze tables are all text."""
    if layer == "bronze":
        return T.StructType([T.StructField(name, T.StringType()) for name in BRONZE[table]])
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in LAYERS[layer][table]])


def columns_of(layer: str, table: str) -> list[str]:
    return struct_of(layer, table).fieldNames()
