"""Run registered queries against their SQL: python tests/compare.py [sf] [names...]."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def normalized(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns by name, in an order that ignores theirs."""
    by_name = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in by_name) for r in rows), key=repr)


def compare(spark, db, sf_dir: str, name: str) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf_dir)
    got = normalized(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracle_sql():
        return len(got) > 0, f"{len(got)} rows, no SQL"
    relation = db.sql(oracle_sql()[name])
    want = normalized(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return False, f"columns {df.columns} vs {relation.columns}"
    if got == want:
        return True, f"{len(got)} rows"
    differ = [(g, w) for g, w in zip(got, want) if g != w][:3]
    return False, f"{len(got)} vs {len(want)} rows; {differ}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from __spark_entry__ import queries

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    directory = f"/root/testdata/sf{scale}"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    connection = database(directory)
    failed = []
    for query in sys.argv[2:] or queries():
        began = time.time()
        try:
            ok, message = compare(session, connection, directory, query)
        except Exception as error:  # report and go on with the others
            ok, message = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print("ok  " if ok else "FAIL", f"{time.time() - began:6.1f}s", query, message, flush=True)
        if not ok:
            failed.append(query)
    print("failed:", failed)
