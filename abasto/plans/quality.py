"""Profiles, duplicates, redundancy and referential integrity.

Every check is an aggregate: columns of one table are counted in one pass, and facts are reduced to key counts before
they meet a dimension.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abasto.functions.cleaning import is_blank
from abasto.functions.measures import differs, percent
from abasto.operators.keys import uniqueness
from abasto.operators.lookups import orphan_keys
from abasto.operators.ranking import repeated, top
from abasto.sources.tables import union_all

# Catalogue columns that facts repeat, and stock columns compared with the catalogue's.
REPEATED_COLUMNS = ["artdes", "artmed", "artgrinv"]
COMPARED_COLUMNS = ["artdes", "artfusal", "artfuent", "artcoum1"]

# References checked on silver tables, (table, column, dimension, dimension key).
SILVER_REFERENCES = [
    ("recepcion", "solnum", "solicitudes", "solnum"),
    ("recepcion", "artcitem", "maestro_articulos", "artcitem"),
    ("solicitudes", "artcitem", "maestro_articulos", "artcitem"),
    ("articulos", "artcitem", "maestro_articulos", "artcitem"),
    ("solicitudes", "solpro", "proveedores", "acrecodi"),
    ("recepcion", "solpro", "proveedores", "acrecodi"),
    ("maestro_articulos", "artgrinv", "grupos", "artgrinv"),
]

# References that normalization may turn into NULL.
NULLABLE_REFERENCES = {
    "fact_solicitudes": ["artcitem", "solpro"],
    "fact_recepcion": ["solnum", "artcitem"],
    "maestro_articulos": ["artgrinv"],
}


def profile(df: DataFrame, name: str) -> DataFrame:
    """Rows, distinct and surplus first-column values, and for every column with gaps how many and what percentage.

    Gaps of all columns are counted in one pass that shuffles one row per task. Distinct keys are counted apart from
    it, so the column counters do not travel with every key.
    """
    key = df.columns[0]
    gaps = df.agg(
        F.count("*").alias("_rows"), *(F.count_if(is_blank(column)).alias(f"_gap_{i}") for i, column in enumerate(df.columns))
    )
    per_column = F.array(
        *(
            F.struct(F.lit(column).alias("column_name"), F.col(f"_gap_{i}").alias("value"))
            for i, column in enumerate(df.columns)
        )
    )
    blanks = (
        gaps.select("_rows", F.inline(per_column))
        .filter(F.col("value") > 0)
        .select(
            F.lit(name).alias("table_name"),
            "column_name",
            F.lit("blank").alias("metric"),
            "value",
            percent(F.col("value"), F.col("_rows")).alias("pct"),
        )
    )
    keys = uniqueness(df, key, name)
    metrics = F.array(
        *(
            F.struct(F.lit(metric).alias("metric"), F.col(column).alias("value"))
            for metric, column in (("rows", "total"), ("distinct", "distinct_keys"), ("duplicates", "surplus"))
        )
    )
    totals = keys.select(
        "table_name", F.lit(key).alias("column_name"), F.inline(metrics)
    ).withColumn("pct", F.lit(None).cast("double"))
    return totals.unionByName(blanks)


def profiles(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all([profile(df, name) for name, df in tables.items()])


def top_repeated_keys(df: DataFrame, key: str, rows: int = 10) -> DataFrame:
    """The most repeated keys, ties by key."""
    return top(repeated(df, [key]), "n_rows", key, rows=rows)


def repeated_key_count(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many keys occur more than once."""
    counted = repeated(df, keys).agg(F.count("*").alias("repeated_keys"))
    return counted.select(
        F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "repeated_keys"
    )


def rows_of_worst_key(df: DataFrame, key: str) -> DataFrame:
    """All rows of the most repeated key (the smallest of them on a tie)."""
    worst = top_repeated_keys(df, key, rows=1).select(key).scalar()
    return df.filter(F.col(key) == worst)


def partial_deliveries(receipts: DataFrame) -> DataFrame:
    """(request, item) pairs received in more than one quantity."""
    counted = receipts.groupBy("solnum", "artcitem").agg(F.count_distinct("nrdcac").alias("quantities"))
    return counted.filter(F.col("quantities") > 1)


def full_row_duplicates(df: DataFrame, name: str) -> DataFrame:
    """Rows beyond the first of every group of rows equal in all columns, NULLs being equal.

    The table is read once and every row shuffled once, in full. Text columns travel as one text, which is as different as
    they are: a NULL is a mark, any other value follows its length.
    """
    texts = [field.name for field in df.schema if field.dataType == T.StringType()]
    if len(texts) > 1:
        marked = (F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-")) for text in texts)
        df = df.select(*(column for column in df.columns if column not in texts), F.concat(*marked).alias("_texts"))
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    surplus = F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0))
    return copies.agg(surplus.alias("duplicate_rows")).select(F.lit(name).alias("table_name"), "duplicate_rows")


def _against_catalogue(fact: DataFrame, items: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """Distinct (item, columns) of a fact with their number of rows, next to the catalogue's columns."""
    reduced = fact.groupBy("artcitem", *columns).agg(F.count("*").alias("_rows"))
    side = items.select(F.col("artcitem").alias("_item"), *(F.col(name).alias(f"_{name}") for name in columns))
    return reduced.join(side, F.col("artcitem") == F.col("_item"), how)


def _rows_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("_rows"))), F.lit(0))


def redundancy(fact: DataFrame, items: DataFrame, name: str) -> DataFrame:
    """For the catalogue columns a fact repeats: rows equal to the catalogue, of all rows, in percent."""
    joined = _against_catalogue(fact, items, REPEATED_COLUMNS, "left")
    counted = joined.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"),
        *(_rows_where(F.col(column) == F.col(f"_{column}")).alias(column) for column in REPEATED_COLUMNS),
    )
    per_column = F.array(
        *(F.struct(F.lit(column).alias("column_name"), F.col(column).alias("matching")) for column in REPEATED_COLUMNS)
    )
    return counted.select(F.lit(name).alias("table_name"), F.inline(per_column), "total").withColumn(
        "pct", F.coalesce(percent(F.col("matching"), F.col("total")), F.lit(0.0))
    )


def mismatches(stock: DataFrame, items: DataFrame, name: str = "articulos") -> DataFrame:
    """Stock rows of known items whose repeated columns differ from the catalogue's, NULL being a value."""
    joined = _against_catalogue(stock, items, COMPARED_COLUMNS, "inner")
    counted = joined.agg(
        *(_rows_where(differs(F.col(column), F.col(f"_{column}"))).alias(column) for column in COMPARED_COLUMNS)
    )
    per_column = F.array(
        *(F.struct(F.lit(column).alias("column_name"), F.col(column).alias("different")) for column in COMPARED_COLUMNS)
    )
    return counted.select(F.lit(name).alias("table_name"), F.inline(per_column))


def distinct_codes(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct non-NULL codes of a column in each of several tables."""
    return union_all(
        [
            df.agg(F.count_distinct(column).alias("codes")).select(F.lit(name).alias("table_name"), "codes")
            for name, (df, column) in tables.items()
        ]
    )


def _flagged(counted: DataFrame, check: str) -> DataFrame:
    return counted.select(
        F.lit(check).alias("check_name"),
        F.col("value"),
        F.when(F.col("value") > 0, "***").otherwise("OK").alias("flag"),
    )


def integrity(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Orphans of every reference, repeated (request, item, quantity) receipts, and surplus request numbers."""
    checks = []
    for table, column, dimension, key in SILVER_REFERENCES:
        orphans = orphan_keys(silver[table], silver[dimension], column, key)
        counted = orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("value"))
        checks.append(_flagged(counted, f"{table}.{column}"))
    business_key = ["solnum", "artcitem", "nrdcac"]
    again = repeated_key_count(silver["recepcion"], business_key, "recepcion").withColumnRenamed("repeated_keys", "value")
    checks.append(_flagged(again, "recepcion(solnum,artcitem,nrdcac)"))
    surplus = uniqueness(silver["solicitudes"], "solnum", "solicitudes").withColumnRenamed("surplus", "value")
    checks.append(_flagged(surplus, "solicitudes.solnum"))
    return union_all(checks)


def orphan_values(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, rows: int | None = None) -> DataFrame:
    """Distinct orphan keys in order, all or the first few."""
    keys = orphan_keys(fact, dim, fact_key, dim_key).select(fact_key).orderBy(F.asc_nulls_last(fact_key))
    return keys if rows is None else keys.limit(rows)


def null_references(normalized: Mapping[str, DataFrame]) -> DataFrame:
    """NULL references left by normalization, one pass per table."""
    counted = []
    for table, columns in NULLABLE_REFERENCES.items():
        per_column = F.array(
            *(F.struct(F.lit(column).alias("column_name"), F.col(column).alias("nulls")) for column in columns)
        )
        nulls = normalized[table].agg(*(F.count_if(F.col(column).isNull()).alias(column) for column in columns))
        counted.append(nulls.select(F.lit(table).alias("table_name"), F.inline(per_column)))
    return union_all(counted)


def layer_row_counts(layers: Mapping[str, Mapping[str, DataFrame]], order: Sequence[str]) -> DataFrame:
    """Row counts of the same tables in several layers, side by side."""
    counted = union_all(
        [
            df.agg(F.count("*").alias("n")).select(F.lit(table).alias("table_name"), F.lit(layer).alias("layer"), "n")
            for layer, tables in layers.items()
            for table, df in tables.items()
        ]
    )
    return counted.groupBy("table_name").agg(
        *(F.sum(F.when(F.col("layer") == layer, F.col("n"))).alias(f"{layer}_rows") for layer in order)
    )
