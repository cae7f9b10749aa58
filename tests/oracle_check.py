"""Run every registered query next to its SQL and compare types and rows.

    python tests/oracle_check.py [folder] [query ...]
"""

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FAMILY = {
    "BIGINT": "int", "INTEGER": "int", "HUGEINT": "int", "SMALLINT": "int", "TINYINT": "int",
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int",
    "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp",
    "BOOLEAN": "boolean", "timestamp_ntz": "timestamp",
}


def tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{file}'")
    return connection


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def ordered(rows, names):
    places = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(row[i]) for i in places) for row in rows), key=repr)


def compare(left, connection, sql) -> str | None:
    """What differs between a query's result and its SQL, None if nothing does."""
    right = connection.execute(sql)
    left_types = {name: FAMILY.get(kind, kind) for name, kind in left.dtypes}
    right_types = {column[0]: FAMILY.get(str(column[1]), str(column[1])) for column in right.description}
    if left_types != right_types:
        return f"columns {sorted(left_types.items() ^ right_types.items())}"
    left_rows = ordered([tuple(row) for row in left.collect()], list(left_types))
    right_rows = ordered(right.fetchall(), list(right_types))
    if len(left_rows) != len(right_rows):
        return f"{len(left_rows)} rows against {len(right_rows)}"
    for a, b in zip(left_rows, right_rows):
        if a != b:
            return f"{a}\n     against {b}"
    return None if left_rows else "no rows"


def local_session() -> SparkSession:
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    for key, value in {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import __spark_entry__ as contract

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, connection = local_session(), tables(folder)
    queries, oracles = contract.queries(), contract.oracle_sql()
    print("without SQL:", sorted(set(queries) - set(oracles)), "SQL without query:", sorted(set(oracles) - set(queries)))
    bad = 0
    for name, query in queries.items():
        if name not in oracles or (only and name not in only):
            continue
        start = time.time()
        try:
            problem = compare(query(spark, folder), connection, oracles[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'DIFF' if problem else 'same'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
