"""Reading and writing layer tables."""

from __future__ import annotations

import functools
import json
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from datetime import date, timedelta
from decimal import Decimal

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abasto.schemas import struct_of
from abasto.session import shared_folder

# Where a row sits in its file: the same at every reading, so it can order rows that are otherwise equal.
POSITION = ["_file", "_row"]

# The column by which tables are partitioned that are stored by month.
MONTH_PART = "month_part"

# The names the schema listing gives to types.
TYPE_NAMES = {
    T.StringType: "text",
    T.IntegerType: "integer",
    T.LongType: "bigint",
    T.DecimalType: "numeric",
    T.DoubleType: "double precision",
    T.DateType: "date",
    T.TimestampType: "timestamp with time zone",
}


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, position: bool = False
) -> DataFrame:
    """A parquet table, with the position of every row when asked for."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(path)
    if position:
        table = table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return table


def read_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text; named frames are referred to as ``{name}``."""
    return spark.sql(text, **frames)


def jdbc_options(
    url: str, table: str, split_on: str | None = None, lower=None, upper=None, splits: int = 1, fetch: int = 10_000
) -> dict[str, str]:
    """Options of a database read. With ``split_on`` the table is read by ``splits`` tasks over ranges of that column."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch)}
    if split_on is not None:
        if lower is None or upper is None or splits < 1:
            raise ValueError("a split read needs lower, upper and splits")
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(splits),
        }
    return options


def histogram_query(table: str, column: str, splits: int) -> str:
    """SQL for the database: the key values that part a table into equal numbers of rows, as one row ``b1, b2, ...``."""
    if splits < 2:
        raise ValueError("a histogram parts a table in two at least")
    bounds = (
        f"percentile_disc({number / splits:.6f}) WITHIN GROUP (ORDER BY {column}) AS b{number}" for number in range(1, splits)
    )
    return f"SELECT {', '.join(bounds)} FROM {table}"


def balanced_predicates(column: str, bounds: Sequence) -> list[str]:
    """Conditions that part the rows of a table at the bounds, each row in exactly one; NULL keys come first.

    A key that fills several parts gives equal bounds: its rows are one part, as they cannot be told apart by the key.
    """
    marks = [_literal(bound) for bound in sorted({bound for bound in bounds if bound is not None})]
    if not marks:
        return ["1 = 1"]
    inner = [f"{column} > {low} AND {column} <= {high}" for low, high in zip(marks, marks[1:], strict=False)]
    return [f"{column} IS NULL OR {column} <= {marks[0]}", *inner, f"{column} > {marks[-1]}"]


def _literal(value) -> str:
    if isinstance(value, bool) or not isinstance(value, int | float | Decimal | str | date):
        raise TypeError(f"no bound: {value!r}")
    return str(value) if isinstance(value, int | float | Decimal) else "'" + str(value).replace("'", "''") + "'"


def read_jdbc(spark: SparkSession, properties: Mapping[str, str] | None = None, **options) -> DataFrame:
    """A table of an external database. Credentials go in ``properties``."""
    return spark.read.format("jdbc").options(**jdbc_options(**options), **(properties or {})).load()


def read_jdbc_balanced(
    spark: SparkSession, url: str, table: str, split_on: str, splits: int, properties: Mapping[str, str] | None = None, fetch: int = 10_000
) -> DataFrame:
    """A table read by tasks with about as many rows each, however its key is spread: the database gives the bounds first."""
    query = f"({histogram_query(table, split_on, splits)}) histogram"
    bounds = list(read_jdbc(spark, properties, url=url, table=query).first())
    given = {**(properties or {}), "fetchsize": str(fetch)}
    return spark.read.jdbc(url, table, predicates=balanced_predicates(split_on, bounds), properties=given)


# Where staged tables go while ``staging`` is open.
_STAGING: ContextVar[str | None] = ContextVar("staging", default=None)


def _filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its own form."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def delete_folder(spark: SparkSession, path: str) -> None:
    filesystem, found = _filesystem(spark, path)
    filesystem.delete(found, True)


@contextmanager
def staging(spark: SparkSession, folder: str) -> Iterator[str]:
    """Keep staged tables in a folder of the caller's choice, and delete it in the end."""
    own = f"{folder.rstrip('/')}/staging-{uuid.uuid4().hex}"
    token = _STAGING.set(own)
    try:
        yield own
    finally:
        _STAGING.reset(token)
        delete_folder(spark, own)


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write a frame to the staging folder and read it back: one evaluation, and a lost executor costs nothing.

    Outside ``staging`` the table goes to the shared folder and stays there as long as the application's checkpoints.
    ``compression`` is a parquet codec other than the session's.
    """
    spark = df.sparkSession
    path = f"{_STAGING.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


class Conflict(RuntimeError):
    """Another load of the layer became current first; nothing of this one is left."""


@dataclass(frozen=True)
class Snapshot:
    """The tables of a layer as one pointer file names them. Later loads do not change what it reads."""

    warehouse: Warehouse
    layer: str
    number: int
    versions: Mapping[str, str]

    def path(self, table: str) -> str:
        if table not in self.versions:
            raise LookupError(f"no table {self.layer}.{table} in {self.warehouse.root}")
        return f"{self.warehouse.root}/{self.layer}/{table}/{self.versions[table]}"

    def table(self, table: str, position: bool = False, month: bool = False) -> DataFrame:
        """The declared columns; with ``month`` also the partition column of a table that is stored by month."""
        declared = struct_of(self.layer, table)
        stored = read_parquet(self.warehouse.spark, self.path(table), declared, position)
        wanted = [*declared.names, *(POSITION if position else []), *([MONTH_PART] if month and MONTH_PART in stored.columns else [])]
        return stored if stored.columns == wanted else stored.select(*wanted)


class Warehouse:
    """Layer tables as parquet folders ``root/layer/table/version``.

    Which version of which table is current is in the newest of the layer's numbered ``_current-*.json`` files. A load
    writes new versions first and names them last, by creating the next pointer file, which fails if that file is there:
    of loads that began from the same pointer exactly one becomes current, on object stores too. Replaced versions
    stay readable for ``keep`` after they were replaced, so readers with a ``snapshot`` can finish; ``keep`` has to be longer
    than any load takes.
    """

    def __init__(self, spark: SparkSession, root: str, keep: timedelta = timedelta(days=1)):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep
        self._open: dict[str, dict[str, str]] = {}

    # -- pointers --------------------------------------------------------------------------------------------------

    def _list(self, path: str) -> list[tuple[str, float]]:
        """Names in a folder with the time they changed, in seconds."""
        filesystem, folder = _filesystem(self.spark, path)
        if not filesystem.exists(folder):
            return []
        return [(status.getPath().getName(), status.getModificationTime() / 1000) for status in filesystem.listStatus(folder)]

    def _pointer(self, layer: str, number: int) -> str:
        return f"{self.root}/{layer}/_current-{number:08d}.json"

    def _pointers(self, layer: str) -> list[tuple[int, float]]:
        """Numbers of the pointer files, ascending, with their times."""
        names = self._list(f"{self.root}/{layer}")
        found = [(name[9:-5], time) for name, time in names if name.startswith("_current-") and name.endswith(".json")]
        return sorted((int(number), time) for number, time in found)

    def _read(self, layer: str, number: int) -> dict[str, str] | None:
        """What a pointer names; nothing while it is being written."""
        filesystem, path = _filesystem(self.spark, self._pointer(layer, number))
        stream = filesystem.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except json.JSONDecodeError:
            return None
        finally:
            stream.close()

    def snapshot(self, layer: str) -> Snapshot:
        """The layer as it is now."""
        for number, _ in reversed(self._pointers(layer)):
            if (found := self._read(layer, number)) is not None:
                return Snapshot(self, layer, number, found)
        return Snapshot(self, layer, 0, {})

    def versions(self, layer: str) -> dict[str, str]:
        """Table to current version; inside ``loading``, with the tables loaded so far."""
        return dict(self.snapshot(layer).versions) | self._open.get(layer, {})

    def path(self, layer: str, table: str) -> str:
        return Snapshot(self, layer, 0, self.versions(layer)).path(table)

    def table(self, layer: str, table: str, position: bool = False, month: bool = False) -> DataFrame:
        return Snapshot(self, layer, 0, self.versions(layer)).table(table, position, month)

    # -- loads -----------------------------------------------------------------------------------------------------

    def _publish(self, before: Snapshot, tables: Mapping[str, str]) -> None:
        """Make versions current after ``before``, or raise ``Conflict``."""
        layer, number = before.layer, before.number + 1
        pointers = dict(self._pointers(layer))
        if number in pointers and pointers[number] < time.time() - self.keep.total_seconds() and self._read(layer, number) is None:
            delete_folder(self.spark, self._pointer(layer, number))  # begun by a load that died
        filesystem, path = _filesystem(self.spark, self._pointer(layer, number))
        content = bytearray(json.dumps(dict(before.versions) | dict(tables)), "utf-8")
        builder = filesystem.createFile(path).recursive().overwrite(False)
        try:
            # Where a store can make creation conditional, the check happens when the file is completed.
            out = builder.opt("fs.option.create.conditional.overwrite", "true").build()
            out.write(content)
            out.close()
        except Py4JJavaError as error:
            name = error.java_exception.getClass().getSimpleName()
            if name == "FileAlreadyExistsException" or "already exists" in str(error.java_exception.getMessage()):
                raise Conflict(f"another load of {layer} came first") from None
            raise

    def _drop_versions(self, layer: str, tables: Mapping[str, str]) -> None:
        for table, version in tables.items():
            delete_folder(self.spark, f"{self.root}/{layer}/{table}/{version}")

    @contextmanager
    def loading(self, layer: str) -> Iterator[None]:
        """Loads inside become current together in the end, or not at all."""
        if layer in self._open:
            raise RuntimeError(f"{layer} is being loaded already")
        before, loaded = self.snapshot(layer), {}
        self._open[layer] = loaded
        try:
            yield
            self._publish(before, loaded)
        except BaseException:
            self._drop_versions(layer, loaded)
            raise
        finally:
            del self._open[layer]
        self.vacuum(layer)

    def load(self, layer: str, table: str, df: DataFrame, month_of: str | None = None) -> DataFrame:
        """Replace a table by ``df``, cast to the declared schema, and return the stored table.

        With ``month_of``, a date column, there is a folder for each month. Give rows in date order, so that a task has few.
        """
        if layer not in self._open:
            with self.loading(layer):
                return self.load(layer, table, df, month_of)
        schema, version = struct_of(layer, table), uuid.uuid4().hex
        typed = df.select(*(F.col(field.name).cast(field.dataType) for field in schema))
        path = f"{self.root}/{layer}/{table}/{version}"
        try:
            if month_of is None:
                typed.write.parquet(path)
            else:
                typed.withColumn(MONTH_PART, F.trunc(month_of, "MM")).write.partitionBy(MONTH_PART).parquet(path)
        except BaseException:
            delete_folder(self.spark, path)
            raise
        self._open[layer][table] = version
        return self.table(layer, table)

    def vacuum(self, layer: str, keep: timedelta | None = None) -> None:
        """Delete pointers that were replaced longer than ``keep`` ago, and versions of that age that no pointer left names."""
        oldest = time.time() - (self.keep if keep is None else keep).total_seconds()
        current, pointers = self.snapshot(layer).number, self._pointers(layer)
        stale = [number for (number, _), (_, replaced) in zip(pointers, pointers[1:], strict=False) if replaced < oldest and number < current]
        named: set[tuple[str, str]] = set()
        for number, _ in pointers:
            if number not in stale:
                named |= set((self._read(layer, number) or {}).items())
        for table, _ in self._list(f"{self.root}/{layer}"):
            if table.startswith("_"):
                continue
            for version, changed in self._list(f"{self.root}/{layer}/{table}"):
                if changed < oldest and (table, version) not in named and self._open.get(layer, {}).get(table) != version:
                    delete_folder(self.spark, f"{self.root}/{layer}/{table}/{version}")
        for number in stale:
            delete_folder(self.spark, self._pointer(layer, number))


def load_catalog_table(df: DataFrame, database: str, table: str) -> DataFrame:
    """Replace one table of a catalog database; other tables of the database are left alone."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    df.write.mode("overwrite").format("parquet").saveAsTable(f"`{database}`.`{table}`")
    return spark.table(f"`{database}`.`{table}`")


def type_name(data_type: T.DataType) -> str:
    return TYPE_NAMES.get(type(data_type), data_type.simpleString())


def schema_listing(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Table, column, position and type name, with the row count of the table."""
    listings = []
    for name, df in frames.items():
        columns = F.array(
            *(
                F.struct(
                    F.lit(position).alias("ordinal_position"),
                    F.lit(field.name).alias("column_name"),
                    F.lit(type_name(field.dataType)).alias("data_type"),
                )
                for position, field in enumerate(df.schema, start=1)
            )
        )
        counted = df.agg(F.count("*").alias("table_rows"))
        listings.append(counted.select(F.lit(name).alias("table_name"), F.inline(columns), "table_rows"))
    return union_all(listings)


def sample_rows(df: DataFrame, order_by: Sequence, rows: int = 3) -> DataFrame:
    """The first rows by an order, so that the sample is the same every time."""
    return df.orderBy(*order_by).limit(rows)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def findings(df: DataFrame, section: str, object_column: str, values: Sequence[str]) -> DataFrame:
    """Long form ``(section, object, metric, value)`` of a result, for the report sink."""
    metrics = F.array(
        *(F.struct(F.lit(name).alias("metric"), F.col(name).cast("string").alias("value")) for name in values)
    )
    return df.select(
        F.lit(section).alias("section"), F.col(object_column).cast("string").alias("object"), F.inline(metrics)
    )


def save_findings(df: DataFrame, path: str, form: str = "json") -> None:
    """Write findings as JSON lines or CSV. Every report has a path of its own, so none replaces another."""
    writer = df.write.mode("overwrite")
    if form == "csv":
        writer.option("header", True).csv(path)
    elif form == "json":
        writer.json(path)
    else:
        raise ValueError(f"form is json or csv, not {form!r}")
