"""Compare registered queries that have SQL with it in DuckDB: columns, row count, values.

    python tests/oracle_check.py [scale folder] [name prefix ...]
"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry  # noqa: E402

TABLES = ["orders", "lineitem", "events", "documents", "conversations", "benchmark"]


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def compare(spark, con, sf_dir, name):
    """None if equal, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    found = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = canonical(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if found == expected:
        return None
    left, right = set(found), set(expected)
    return (
        f"{len(found)} against {len(expected)} rows; only here {sorted(left - right)[:2]},"
        f" only expected {sorted(right - left)[:2]}"
    )


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in entry.queries():
        if not name.startswith(prefixes) or name not in entry.oracle_sql():
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # show every failing query, not only the first
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("different:", bad)
    sys.exit(bad > 0)
