"""Run every query in Spark and its SQL in DuckDB and compare schema, rows and values.

    python tests/check_oracles.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def normal_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return None if v is None or (isinstance(v, float) and math.isnan(v)) else v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, sf_dir: str, name: str) -> list[str]:
    frame = contract.queries()[name](spark, sf_dir)
    columns = frame.columns
    spark_rows = normal_rows([tuple(r) for r in frame.collect()], columns)
    cursor = connection.execute(contract.oracle_sql()[name])
    duck_columns = [d[0] for d in cursor.description]
    duck_types = {d[0]: str(d[1]) for d in cursor.description}
    duck_rows = normal_rows(cursor.fetchall(), duck_columns)
    problems = []
    if sorted(columns) != sorted(duck_columns):
        return [f"columns {sorted(columns)} != {sorted(duck_columns)}"]
    for column, spark_type in frame.dtypes:
        if DUCK_TYPES.get(spark_type, spark_type) != duck_types[column]:
            problems.append(f"type of {column}: {spark_type} / {duck_types[column]}")
    if len(spark_rows) != len(duck_rows):
        problems.append(f"rows {len(spark_rows)} != {len(duck_rows)}")
    different = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[0]}")
    return problems


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(contract.queries())
    # a session that knows nothing of this library: the queries bring their settings
    builder = SparkSession.builder.appName("check").master("local[8]").config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    spark = builder.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            problems = compare(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {name} {time.time() - started:.1f}s", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
