"""Compare queries with their SQL: ``python -m workload.check [sf_dir] [name ...]``."""

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .appName("casebook-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value if value is None else str(value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(cells, key=lambda r: tuple((c is None, c or "") for c in r))


def compare(df, names: list[str], rows: list[tuple]) -> str:
    """Empty when both results are the same, else what differs."""
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    mine = _rows(df.columns, df.collect())
    theirs = _rows(names, rows)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else ""


def main() -> int:
    from workload import ORACLES, QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        began = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                cursor = con.execute(ORACLES[name])
                names_found, rows = [d[0] for d in cursor.description], cursor.fetchall()
                n = len(rows)
                fault = compare(df, names_found, rows)
            else:
                n, fault = df.count(), ""
        except Exception as error:  # noqa: BLE001 - reported and counted
            n, fault = -1, f"{type(error).__name__}: {str(error)[:700]}"
        failed += bool(fault)
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'FAIL' if fault else 'ok  '} {name:28} {kind} {n:7} {time.time() - began:6.1f}s {fault}")
        sys.stdout.flush()
    print(f"{len(names)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
