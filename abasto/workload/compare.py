"""Run queries in Spark and DuckDB and compare the rows.

    python -m abasto.workload.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime

import duckdb

from abasto.session import local_session
from abasto.workload import queries_layers, queries_reports  # noqa: F401  (registers the queries)
from abasto.workload.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, connection, folder: str, name: str) -> dict:
    """Row counts, column names, the type families and the rows of both sides."""
    item = QUERIES[name]
    started = time.time()
    frame = item(spark, folder)
    got = frame.collect()
    result = {"query": name, "seconds": round(time.time() - started, 2), "rows": len(got)}
    if item.oracle is None:
        return result | {"ok": len(got) > 0, "note": "rows only"}
    answer = connection.execute(item.oracle)
    columns = [column[0] for column in answer.description]
    wanted = answer.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return result | {"ok": False, "note": f"columns {sorted(frame.columns)} against {sorted(columns)}"}
    left, right = _rows(frame.columns, got), _rows(columns, wanted)
    if left != right:
        extra, missing = list((left - right).items())[:2], list((right - left).items())[:2]
        note = f"{sum((left - right).values())} rows differ of {len(got)}/{len(wanted)}: {extra} against {missing}"
        return result | {"ok": False, "note": note}
    spark_types = {field.name: field.dataType.simpleString() for field in frame.schema}
    duck_types = {column[0]: str(column[1]).lower() for column in answer.description}
    same = {"string": "varchar", "int": "integer", "number": "number"}
    odd = [
        f"{name}: {kind}/{duck_types[name]}"
        for name, kind in spark_types.items()
        if same.get(kind, kind) != duck_types[name]
    ]
    return result | {"ok": True, "note": "; ".join(odd)}


def main(folder: str, names: list[str]) -> int:
    spark, connection, failed = local_session(8), duck(folder), 0
    for name in names or QUERIES:
        try:
            result = compare(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            result = {"query": name, "ok": False, "rows": None, "seconds": None, "note": str(error)[:600]}
        failed += not result["ok"]
        print("ok  " if result["ok"] else "FAIL", result["query"], result["rows"], result["seconds"], result["note"], flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
