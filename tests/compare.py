"""Run catalogue queries and their SQL side by side: ``python tests/compare.py [folder] [query ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import tempfile
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        [tuple(_plain(row[i]) for i in order) for row in rows], key=repr
    )


def spark_table(frame):
    return _table(frame.columns, [tuple(r) for r in frame.collect()])


def sql_table(connection, sql):
    result = connection.execute(sql)
    return _table([d[0] for d in result.description], result.fetchall())


# Column types of the two engines that hold the same values.
SAME_TYPE = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "date": "DATE",
}


def type_difference(frame, connection, sql) -> str | None:
    described = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    wrong = [(n, t, described.get(n)) for n, t in frame.dtypes if SAME_TYPE.get(t) != described.get(n)]
    return f"types {wrong}" if wrong else None


def difference(frame, connection, sql) -> str | None:
    """A short description of the first difference, or None."""
    names, rows = spark_table(frame)
    sql_names, sql_rows = sql_table(connection, sql)
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    if len(rows) != len(sql_rows):
        extra = set(rows) - set(sql_rows)
        lacking = set(sql_rows) - set(rows)
        return f"{len(rows)} rows != {len(sql_rows)}; only Spark {list(extra)[:3]}; only SQL {list(lacking)[:3]}"
    for a, b in zip(rows, sql_rows):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as driver

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    queries, oracles = driver.queries(), driver.oracle_sql()
    failed = []
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            frame = queries[name](spark, folder)
            problem = type_difference(frame, connection, oracles[name])
            problem = problem or difference(frame, connection, oracles[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name}: {'ok' if problem is None else problem} ({time.time() - start:.1f}s)", flush=True)
        if problem is not None:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}; without SQL: {sorted(set(queries) - set(oracles))}")


if __name__ == "__main__":
    main()
