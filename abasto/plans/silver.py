"""Bronze text to silver typed tables: one projection and one filter per table, no shuffle.

Each table is described by how its columns are cleaned. The catalogue texts of a receipt stay as empty texts where they
are blank, those of a request become NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abasto.functions import cleaning
from abasto.schemas import columns_of, struct_of

# Fixed values. Table -> cleaning rule -> columns; columns without a rule here are not part of the silver table.
RULES = {
    "grupos": {
        "trim": ["artgrinv", "nombre"],
    },
    "proveedores": {
        "trim": ["acrecodi", "acreraso"],
        "filled": ["acredire", "acretelf", "acreciud", "acreiden", "acreruc"],
    },
    "maestro_articulos": {
        "trim": ["artcitem", "artdes", "artmed", "artgrinv"],
        "filled": ["artubi", "artcmon"],
        "decimal": ["artcosu1", "artcoum1", "artpreu2"],
        "integer": ["artstseg"],
        "day": ["artfusal", "artfuent"],
    },
    "articulos": {
        "trim": ["artcitem", "artdes", "artmed", "artgrinv", "ubialm"],
        "filled": ["artuptrn"],
        "decimal": ["ubistock", "artcoum1"],
        "day": ["artfusal", "artfureq", "artfuent", "artfusal_1"],
    },
    "recepcion": {
        "trim": ["artcitem", "artdes", "artmed", "artgrinv"],
        "filled": ["solurg", "solusr", "soltip", "solpro"],
        "decimal": ["solcan", "nrdcac", "artstock", "solpre"],
        "integer": ["solnum", "solmon", "nrcnum", "solord"],
        "day": ["nrcfec", "solfec"],
    },
    "solicitudes": {
        "trim": ["artcitem", "artdes"],
        "filled": ["soltip", "solurg", "solusr", "solsts", "solpro", "artmed", "artgrinv"],
        "decimal": ["solcan", "solpre"],
        "integer": ["solnum", "solord", "solmon", "solsta"],
        "day": ["solfec"],
    },
}

# The column that must not be blank for a row to be kept.
ROW_KEY = {
    "grupos": "artgrinv",
    "proveedores": "acrecodi",
    "maestro_articulos": "artcitem",
    "articulos": "artcitem",
    "recepcion": "solnum",
    "solicitudes": "solnum",
}


def clean(bronze: DataFrame, table: str, mode: str = "strict") -> DataFrame:
    """The silver form of a bronze table."""
    rule_of = {name: rule for rule, names in RULES[table].items() for name in names}

    def cleaned(field):
        rule = rule_of[field.name]
        if rule == "trim":
            value = cleaning.trimmed(field.name)
        elif rule == "filled":
            value = cleaning.filled(field.name)
        elif rule == "decimal":
            value = cleaning.decimal_number(field.name, mode, field.dataType.simpleString())
        elif rule == "integer":
            value = cleaning.whole_number(field.name, mode, field.dataType.simpleString())
        else:
            value = cleaning.calendar_day(field.name, mode)
        return value.alias(field.name)

    kept = bronze.filter(cleaning.has_key(ROW_KEY[table]))
    return kept.select(*(cleaned(field) for field in struct_of("silver", table)))


def groups(bronze: DataFrame) -> DataFrame:
    return clean(bronze, "grupos")


def suppliers(bronze: DataFrame) -> DataFrame:
    return clean(bronze, "proveedores")


def items(bronze: DataFrame, mode: str = "strict") -> DataFrame:
    return clean(bronze, "maestro_articulos", mode)


def stock(bronze: DataFrame, mode: str = "strict") -> DataFrame:
    return clean(bronze, "articulos", mode)


def receipts(bronze: DataFrame, mode: str = "strict") -> DataFrame:
    return clean(bronze, "recepcion", mode)


def requests(bronze: DataFrame, mode: str = "strict") -> DataFrame:
    return clean(bronze, "solicitudes", mode)


def keep_declared(df: DataFrame, layer: str, table: str) -> DataFrame:
    """The declared columns of a table, in their order."""
    return df.select(*(F.col(name) for name in columns_of(layer, table)))
