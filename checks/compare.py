"""Compare Spark results with DuckDB's over the same files.

Usage: python -m checks.compare FOLDER [QUERY ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import datetime, timezone
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def _plain(value):
    if isinstance(value, datetime) and value.tzinfo:
        return value.astimezone(timezone.utc).replace(tzinfo=None)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


def differences(df: DataFrame, connection, sql: str) -> list[str]:
    """What differs between the two results; empty when they are the same bag."""
    relation = connection.sql(sql)
    found = []
    spark_types = {n: _KINDS.get(t, t) for n, t in df.dtypes}
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    if spark_types != sql_types:
        changed = set(spark_types.items()) ^ set(sql_types.items())
        found.append(f"columns differ: {sorted(changed)}")
    if set(spark_types) != set(sql_types):
        return found
    ours = _bag(df.columns, df.collect())
    theirs = _bag(relation.columns, relation.fetchall())
    if ours != theirs:
        extra, missing = list((ours - theirs).items()), list((theirs - ours).items())
        found.append(
            f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only here {extra[:3]}, only there {missing[:3]}"
        )
    if not ours:
        found.append("no rows")
    return found


def main(arguments: list[str]) -> int:
    from checks.oracle import all_sql
    from checks.registry import all_queries
    from reelhouse.session import build_session

    folder, names = arguments[0], arguments[1:]
    spark = build_session(
        "compare",
        "local[8]",
        8,
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, failed = connect(folder), all_sql(), 0
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        if name in sql:
            found = differences(query(spark, folder), connection, sql[name])
        else:
            found = [] if query(spark, folder).count() else ["no rows"]
        failed += bool(found)
        took = time.perf_counter() - start
        print(f"{'FAIL' if found else 'ok  '} {took:6.2f}s {name} {' | '.join(found)}")
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
