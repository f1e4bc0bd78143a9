"""Runs registered queries and their SQL side by side.

python tests/compare.py [sf folder] [query ...]
"""

import collections
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def difference(spark_df, con, sql):
    """None if both give the same rows under the same column names."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    columns = sorted(names)
    if columns != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {columns}"
    order = [names.index(c) for c in columns]
    expected = collections.Counter(tuple(r[i] for i in order) for r in result.fetchall())
    actual = collections.Counter(tuple(r) for r in spark_df.select(*columns).collect())
    if actual != expected:
        return (
            f"{sum(actual.values())} rows against {sum(expected.values())}; "
            f"only Spark {list((actual - expected).items())[:3]}; "
            f"only SQL {list((expected - actual).items())[:3]}"
        )
    return None


def main():
    from __spark_entry__ import oracle_sql, queries
    from tenantlens.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = build_session(
        "compare", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in names:
        start = time.time()
        try:
            problem = difference(queries()[name](spark, folder), con, oracle_sql()[name])
        except Exception as error:  # shown, and the others still run
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {'same' if problem is None else problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} the same")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
