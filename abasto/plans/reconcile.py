"""Stored tables against recomputed ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abasto.functions.measures import differs
from abasto.sources.tables import union_all

# Grain and measures of the two gold tables.
DEMAND_GRAIN = ["artcitem", "artgrinv", "grupo_nombre", "periodo_mes"]
DEMAND_MEASURES = [
    "cantidad_total_despachada",
    "frecuencia_pedidos",
    "precio_promedio_pactado",
    "ultimo_stock_registrado",
]
METRICS_GRAIN = ["proveedor_id"]
METRICS_MEASURES = [
    "total_atenciones",
    "lead_time_promedio_dias",
    "desviacion_lead_time",
    "volumen_total_suministrado",
]


def paired(stored: DataFrame, computed: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Full outer join on the whole grain, NULL keys matching NULL keys.

    Both sides have one row per key, so no key is frequent. Rows of ``_stored`` and ``_computed`` tell who has it.
    """
    left = stored.select(*keys, *measures, F.lit(1).alias("_stored"))
    right = computed.select(
        *(F.col(name).alias(f"_c_{name}") for name in (*keys, *measures)), F.lit(1).alias("_computed")
    )
    on = None
    for key in keys:
        same = F.col(key).eqNullSafe(F.col(f"_c_{key}"))
        on = same if on is None else on & same
    return left.join(right, on, "full_outer")


def compare_tables(stored: DataFrame, computed: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row of counts: stored, computed, missing (stored only), extra (computed only), different."""
    both = F.col("_stored").isNotNull() & F.col("_computed").isNotNull()
    different = F.lit(False)
    for name in measures:
        different = different | differs(F.col(name), F.col(f"_c_{name}"))
    return paired(stored, computed, keys, measures).agg(
        F.count("_stored").alias("stored"),
        F.count("_computed").alias("computed"),
        F.count_if(F.col("_stored").isNotNull() & F.col("_computed").isNull()).alias("missing"),
        F.count_if(F.col("_stored").isNull() & F.col("_computed").isNotNull()).alias("extra"),
        F.count_if(both & different).alias("different"),
    )


BUCKETS = 4096


def digests(df: DataFrame, keys: Sequence[str], measures: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, sum, mix) of the rows, dealt by the hash of their key: two sums over 64-bit hashes of whole rows.

    Hashes pass over NULLs, so which columns are NULL is hashed too.
    """
    columns = [*keys, *measures]
    row = F.xxhash64(*columns, *(F.col(name).isNull() for name in columns))
    hashed = df.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"), row.alias("row"))
    return hashed.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum(F.col("row").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("mix")
    )


def compare_by_digests(
    stored: DataFrame, computed: DataFrame, keys: Sequence[str], measures: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """The counts of ``compare_tables``; only rows of buckets whose digests differ are joined.

    The digests, at most ``buckets`` rows of four numbers a side, are compared while the plan is built. Tables that agree are
    each read once, by an aggregate, and no row of theirs is exchanged.
    """
    typed = computed.select(*(computed[name].cast(stored.schema[name].dataType) for name in (*keys, *measures)))
    left = digests(stored, keys, measures, buckets).toDF("bucket", "n", "sum", "mix")
    right = digests(typed, keys, measures, buckets).toDF("bucket", "_n", "_sum", "_mix")
    both = left.join(right, "bucket", "full_outer").collect()
    same = [row for row in both if (row.n, row.sum, row.mix) == (row._n, row._sum, row._mix)]
    differing = sorted({row.bucket for row in both} - {row.bucket for row in same})
    equal = sum(row.n for row in same)
    if not differing:
        schema = "stored bigint, computed bigint, missing bigint, extra bigint, different bigint"
        return stored.sparkSession.createDataFrame([(equal, equal, 0, 0, 0)], schema)
    chosen = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").isin(differing)
    counts = compare_tables(stored.filter(chosen), typed.filter(chosen), keys, measures)
    return counts.withColumns({name: F.col(name) + F.lit(equal) for name in ("stored", "computed")})


def verdict(counts: DataFrame, name: str, expected: int | None = None) -> DataFrame:
    """The counts of a comparison with ``exact``: as many stored as computed (and expected), and no difference."""
    exact = (F.col("stored") == F.col("computed")) & (F.col("missing") + F.col("extra") + F.col("different") == 0)
    if expected is not None:
        exact = exact & (F.col("stored") == expected)
    return counts.select(F.lit(name).alias("table_name"), "*", F.lit(expected).cast("bigint").alias("expected"), exact.alias("exact"))


# The names under which the demand comparison is reported.
DEMAND_METRICS = {
    "gold_total": "stored",
    "repro_total": "computed",
    "sin_key": "missing",
    "extras": "extra",
    "dif_total": "different",
}


def _long(counts: DataFrame, names: Mapping[str, str]) -> DataFrame:
    metrics = F.array(
        *(F.struct(F.lit(name).alias("chk"), F.col(column).alias("n")) for name, column in names.items())
    )
    return counts.select(F.inline(metrics))


def demand(stored: DataFrame, computed: DataFrame, by_digests: bool = False) -> DataFrame:
    """The demand comparison in long form."""
    compare = compare_by_digests if by_digests else compare_tables
    return _long(compare(stored, computed, DEMAND_GRAIN, DEMAND_MEASURES), DEMAND_METRICS)


def metrics(stored: DataFrame, computed: DataFrame, places: int | None = None) -> DataFrame:
    """The supplier comparison. ``places`` rounds both sides' means and deviations before they are compared."""
    if places is not None:
        rounded = {name: F.round(name, places) for name in ("lead_time_promedio_dias", "desviacion_lead_time")}
        stored, computed = stored.withColumns(rounded), computed.withColumns(rounded)
    return compare_tables(stored, computed, METRICS_GRAIN, METRICS_MEASURES)


def expected_counts(tables: Mapping[str, DataFrame], expectations: DataFrame) -> DataFrame:
    """Row counts next to expected ones. ``expectations`` has (table_name, expected)."""
    counted = union_all(
        [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    )
    return counted.join(expectations, "table_name", "left").withColumn(
        "status", F.when(F.col("n") == F.col("expected"), "OK").otherwise("NO COINCIDE")
    )
