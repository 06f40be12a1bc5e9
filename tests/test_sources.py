import json
import os
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from abasto.schemas import struct_of
from abasto.session import shared_folder
from abasto.sources import tables


def test_jdbc_options():
    plain = tables.jdbc_options("jdbc:postgresql://host/db", "silver.recepcion")
    assert plain == {"url": "jdbc:postgresql://host/db", "dbtable": "silver.recepcion", "fetchsize": "10000"}
    split = tables.jdbc_options("u", "t", split_on="solnum", lower=1, upper=900, splits=8)
    assert split["partitionColumn"] == "solnum" and split["numPartitions"] == "8" and split["upperBound"] == "900"
    with pytest.raises(ValueError):
        tables.jdbc_options("u", "t", split_on="solnum")


def test_balanced_reads(spark):
    assert tables.histogram_query("silver.recepcion", "solnum", 4) == (
        "SELECT percentile_disc(0.250000) WITHIN GROUP (ORDER BY solnum) AS b1, "
        "percentile_disc(0.500000) WITHIN GROUP (ORDER BY solnum) AS b2, "
        "percentile_disc(0.750000) WITHIN GROUP (ORDER BY solnum) AS b3 FROM silver.recepcion"
    )
    with pytest.raises(ValueError):
        tables.histogram_query("t", "k", 1)
    with pytest.raises(TypeError):
        tables.balanced_predicates("k", [b"x"])
    # A key with a third of the rows: by equal ranges one task has most rows, by the histogram none has more than that key.
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 100 = 1 THEN NULL ELSE id * id END AS k")
    bounds = list(df.selectExpr(*(f"percentile_disc({i / 8}) WITHIN GROUP (ORDER BY k)" for i in range(1, 8))).first())
    parts = [df.filter(condition).count() for condition in tables.balanced_predicates("k", bounds)]
    assert sum(parts) == 3000 and max(parts) < 1500 and min(parts) > 100
    assert tables.balanced_predicates("k", [None]) == ["1 = 1"]
    assert tables.balanced_predicates("k", ["o'x", "a", "a"]) == ["k IS NULL OR k <= 'a'", "k > 'a' AND k <= 'o''x'", "k > 'o''x'"]


def test_query_read(spark):
    df = spark.range(5)
    assert tables.read_sql(spark, "SELECT count(*) AS n FROM {numbers}", numbers=df).collect()[0].n == 5


def test_warehouse_casts_and_replaces(spark, tmp_path):
    warehouse = tables.Warehouse(spark, str(tmp_path))
    for text in ("1", "2"):
        df = spark.createDataFrame([("g" + text, "name", text)], "artgrinv string, nombre string, extra string")
        stored = warehouse.load("silver", "grupos", df)
    assert [tuple(r) for r in stored.collect()] == [("g2", "name")]
    assert stored.schema == struct_of("silver", "grupos")
    assert "_row" in warehouse.table("silver", "grupos", position=True).columns


def test_catalog_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS layer_test LOCATION '{tmp_path}/layer'")
    for upto in (3, 2):
        stored = tables.load_catalog_table(spark.range(upto), "layer_test", "numbers")
    assert stored.count() == 2
    spark.sql("DROP DATABASE layer_test CASCADE")


def test_schema_listing(spark):
    df = spark.createDataFrame([], struct_of("silver", "maestro_articulos"))
    listed = tables.schema_listing({"silver.maestro_articulos": df}).orderBy("ordinal_position").collect()
    assert [(r.column_name, r.data_type) for r in listed[4:7]] == [
        ("artcosu1", "numeric"), ("artstseg", "integer"), ("artfusal", "date"),
    ]
    assert len(listed) == 12 and listed[0].table_rows == 0


def test_findings(spark, tmp_path):
    df = spark.createDataFrame([("t", 3, 1)], "table_name string, total bigint, surplus bigint")
    long = tables.findings(df, "duplicates", "table_name", ["total", "surplus"])
    tables.save_findings(long, str(tmp_path / "json"))
    tables.save_findings(long, str(tmp_path / "csv"), "csv")
    lines = []
    for name in os.listdir(tmp_path / "json"):
        if name.endswith(".json"):
            lines += [json.loads(line) for line in open(tmp_path / "json" / name)]
    assert {(line["object"], line["metric"], line["value"]) for line in lines} == {("t", "total", "3"), ("t", "surplus", "1")}
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    with pytest.raises(ValueError):
        tables.save_findings(long, str(tmp_path / "x"), "xml")


def test_staged_frames_are_read_from_the_shared_folder(spark):
    staged = tables.stage(spark.range(10).withColumn("r", F.rand()), "test")
    folder = shared_folder(spark).removeprefix("file:")
    assert staged.inputFiles() and all(folder in path for path in staged.inputFiles())
    assert staged.collect() == staged.collect()


def test_a_failed_load_leaves_the_stored_table(spark, tmp_path):
    warehouse = tables.Warehouse(spark, str(tmp_path))
    good = spark.createDataFrame([("g", "n")], "artgrinv string, nombre string")
    warehouse.load("silver", "grupos", good)
    bad = good.withColumn("nombre", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        warehouse.load("silver", "grupos", bad)
    assert [tuple(row) for row in warehouse.table("silver", "grupos").collect()] == [("g", "n")]
    with pytest.raises(ValueError, match="second"), warehouse.loading("silver"):
        warehouse.load("silver", "grupos", good.withColumn("nombre", F.lit("new")))
        raise ValueError("second table fails")
    assert warehouse.table("silver", "grupos").first().nombre == "n"
    assert len(list((tmp_path / "silver" / "grupos").iterdir())) == 1
    with warehouse.loading("silver"):
        warehouse.load("silver", "grupos", good.withColumn("nombre", F.lit("new")))
        assert tables.Warehouse(spark, str(tmp_path)).table("silver", "grupos").first().nombre == "n"
    assert warehouse.table("silver", "grupos").first().nombre == "new"
    assert len(versions(tmp_path)) == 2  # the replaced one can still be read
    warehouse.vacuum("silver", timedelta(0))
    assert len(versions(tmp_path)) == 1 and warehouse.table("silver", "grupos").first().nombre == "new"


def versions(root, layer="silver", table="grupos"):
    return sorted(path.name for path in (root / layer / table).iterdir())


def groups(spark, name):
    return spark.createDataFrame([("g", name)], "artgrinv string, nombre string")


def test_a_snapshot_outlives_loads(spark, tmp_path):
    warehouse = tables.Warehouse(spark, str(tmp_path))
    warehouse.load("silver", "grupos", groups(spark, "old"))
    before = warehouse.snapshot("silver")
    read = before.table("grupos")
    with warehouse.loading("silver"):
        warehouse.load("silver", "grupos", groups(spark, "new"))
    assert read.first().nombre == "old" and before.table("grupos").first().nombre == "old"
    assert warehouse.snapshot("silver").table("grupos").first().nombre == "new"
    assert (before.number, warehouse.snapshot("silver").number) == (1, 2)
    with pytest.raises(LookupError):
        before.table("articulos")
    warehouse.keep = timedelta(0)
    warehouse.load("silver", "grupos", groups(spark, "newest"))
    assert len(versions(tmp_path)) == 1 and warehouse.table("silver", "grupos").first().nombre == "newest"
    assert len(list((tmp_path / "silver").glob("_current-*.json"))) == 1


def test_of_two_loads_one_wins(spark, tmp_path):
    one, other = tables.Warehouse(spark, str(tmp_path)), tables.Warehouse(spark, str(tmp_path))
    with pytest.raises(tables.Conflict), one.loading("silver"):
        one.load("silver", "grupos", groups(spark, "first"))
        with other.loading("silver"):
            other.load("silver", "grupos", groups(spark, "second"))
    assert one.table("silver", "grupos").first().nombre == "second" and len(versions(tmp_path)) == 1
    one.load("silver", "grupos", groups(spark, "third"))
    assert other.table("silver", "grupos").first().nombre == "third"


def test_a_failed_publication_leaves_nothing(spark, tmp_path, monkeypatch):
    warehouse = tables.Warehouse(spark, str(tmp_path))
    warehouse.load("silver", "grupos", groups(spark, "old"))

    def fail(*_):
        raise OSError("no pointer")

    with monkeypatch.context() as patch:
        patch.setattr(tables.Warehouse, "_publish", fail)
        for act in (warehouse.load, lambda *given: in_one(warehouse, *given)):
            with pytest.raises(OSError):
                act("silver", "grupos", groups(spark, "new"))
    assert len(versions(tmp_path)) == 1 and warehouse.table("silver", "grupos").first().nombre == "old"


def in_one(warehouse, layer, table, df):
    with warehouse.loading(layer):
        warehouse.load(layer, table, df)


def test_unfinished_pointers_are_passed_over(spark, tmp_path):
    warehouse = tables.Warehouse(spark, str(tmp_path))
    warehouse.load("silver", "grupos", groups(spark, "old"))
    (tmp_path / "silver" / "_current-00000002.json").write_text("")  # being written, or left by a load that died
    assert warehouse.table("silver", "grupos").first().nombre == "old"
    with pytest.raises(tables.Conflict):
        warehouse.load("silver", "grupos", groups(spark, "new"))
    assert len(versions(tmp_path)) == 1
    warehouse.keep = timedelta(0)
    time.sleep(0.01)
    warehouse.load("silver", "grupos", groups(spark, "new"))
    assert warehouse.table("silver", "grupos").first().nombre == "new"


def test_staging_ends_without_a_trace(spark, tmp_path):
    with tables.staging(spark, str(tmp_path)):
        assert tables.stage(spark.range(5), "five").count() == 5
        assert list(tmp_path.iterdir())
    assert not list(tmp_path.iterdir())


def test_shared_folder_has_to_be_named(spark):
    class Context:
        own, master = None, "spark://host:7077"

        def getCheckpointDir(self):
            return self.own

    class Conf:
        named = None

        def get(self, name, default=None):
            return self.named if name == "spark.checkpoint.dir" else "/w/"

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())
    Session.sparkContext.master = "local[4]"
    assert shared_folder(Session()) == "/w/checkpoints"
    Session.conf.named, Session.sparkContext.own = "/data/ck", "file:/data/ck2/x"
    assert shared_folder(Session()) == "/data/ck"
    Session.sparkContext.own = "file:/data/ck/x"
    assert shared_folder(Session()) == "file:/data/ck/x"
