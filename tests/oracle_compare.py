"""Compare registered queries with their SQL twins: ``python tests/oracle_compare.py DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
FAMILIES = {
    "int": "int", "bigint": "bigint", "double": "double", "string": "varchar", "date": "date", "boolean": "boolean",
    "timestamp_ntz": "timestamp",
}


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as from '{folder}/{table}.parquet'")
    return connection


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value + 0.0))
    return (1, str(value))


def _rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_cell(record[i]) for i in order) for record in records])


def differences(df, connection, sql: str) -> list[str]:
    """Empty when names, types, row count and every value agree exactly."""
    result = connection.execute(sql)
    expected_types = {c[0]: str(c[1]).lower() for c in result.description}
    expected = result.fetchall()
    types = {name: FAMILIES.get(kind, kind) for name, kind in df.dtypes}
    actual = df.collect()
    problems = []
    if sorted(types) != sorted(expected_types):
        return [f"columns {sorted(types)} against {sorted(expected_types)}"]
    aliases = {"integer": "int", "number": "double"}
    for name, kind in types.items():
        wanted = aliases.get(expected_types[name], expected_types[name])
        if wanted != kind:
            problems.append(f"type of {name}: {kind} against {wanted}")
    if len(actual) != len(expected):
        problems.append(f"rows {len(actual)} against {len(expected)}")
    left, right = _rows(list(df.columns), actual), _rows(list(expected_types), expected)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return problems


def main(folder: str, names: list[str]) -> int:
    from shelfcast.oracle import ORACLE_SQL
    from shelfcast.plans.queries import PLANS, run
    from shelfcast.session import build_session

    spark = build_session("oracle-compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    failed = 0
    for name in names or list(PLANS):
        started = time.time()
        try:
            df = run(name, spark, folder)
            if name in ORACLE_SQL:
                problems = differences(df, connection, ORACLE_SQL[name])
                state = "match" if not problems else f"DIFF {problems}"
            else:
                problems, state = [], f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            problems, state = [str(error)], f"FAIL {str(error)[:600]}"
        failed += bool(problems)
        print(f"{name:30s} {time.time() - started:6.2f}s {state}", flush=True)
    print(f"{failed} of {len(names or PLANS)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) != 0)
