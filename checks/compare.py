"""Run the queries next to their SQL and report where they differ.

    python -m checks.compare SF_DIR [name-part ...]
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks import QUERIES_AND_ORACLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows with columns by name, values comparable, in a fixed order."""
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    rows = [
        tuple(float(v) if isinstance(v, float) else v for v in row)
        for row in frame.itertuples(index=False, name=None)
    ]
    return sorted(rows, key=repr)


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    """What differs first, or None."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"
    for ours, theirs in zip(canonical(spark_rows), canonical(sql_rows)):
        if ours != theirs:
            return f"{str(ours)[:300]} / {str(theirs)[:300]}"
    return None


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def main(sf_dir: str, parts: list[str]) -> int:
    queries, oracles = QUERIES_AND_ORACLES
    spark, db = session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name, query in queries.items():
        if parts and not any(part in name for part in parts):
            continue
        try:
            start = time.time()
            ours = query(spark, sf_dir).toPandas()
            took, start = time.time() - start, time.time()
            verdict = "rows only"
            if name in oracles:
                found = difference(ours, db.execute(oracles[name]).df())
                verdict = "ok" if found is None else f"DIFFERS {found}"
            print(f"{name}: {len(ours)} rows, {took:.2f}s / {time.time() - start:.2f}s: {verdict}")
            failed += verdict.startswith("DIFFERS")
        except Exception as error:  # report and go on with the next query
            print(f"{name}: FAILED {str(error)[:600]}")
            failed += 1
        sys.stdout.flush()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
