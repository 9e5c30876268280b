"""Run queries on Spark and their oracle on DuckDB and compare the rows.

Usage: python -m checks.compare SF_DIR [query ...]
"""

import math
import sys
import time

import duckdb

from checks.feeds import TABLES
from checks.oracles import oracle_sql
from checks.queries import QUERIES
from martwright.session import build_session


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def difference(spark, connection, name, sf_dir):
    """None where both engines agree, else what differs first."""
    result = QUERIES[name](spark, sf_dir)
    ours = rows_of(result.columns, [tuple(r) for r in result.collect()])
    cursor = connection.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    if sorted(result.columns) != sorted(columns):
        return f"columns {sorted(result.columns)} != {sorted(columns)}"
    if ours == theirs:
        return None
    first = next((pair for pair in zip(ours, theirs) if pair[0] != pair[1]), "length only")
    return f"{len(ours)} != {len(theirs)} rows; first: {first}"


def main(sf_dir, names):
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    failed = 0
    for name in names or QUERIES:
        begin = time.time()
        try:
            problem = difference(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - begin:6.1f}s {problem or 'ok'}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
