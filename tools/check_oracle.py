"""Compare every catalogue query with its SQL twin: ``python tools/check_oracle.py SF_DIR [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from foulee.session import build_session  # noqa: E402
from foulee.testbed.catalogue import QUERIES  # noqa: E402
from foulee.testbed.oracle import oracle_sql  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir: str, name: str) -> str | None:
    """None when both engines give the same columns and rows; else what differs."""
    frame = QUERIES[name](spark, sf_dir)
    got = _bag(frame.columns, frame.collect())
    result = connection.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    expected = _bag(columns, result.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} / {sorted(columns)}"
    if got != expected:
        extra, missing = got - expected, expected - got
        return (
            f"rows {sum(got.values())} / {sum(expected.values())}, {sum(extra.values())} only in Spark "
            f"{sorted(columns)} {list(extra)[:2]}, {sum(missing.values())} only in SQL {list(missing)[:2]}"
        )
    return None


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        failures += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{len(names) - failures}/{len(names)} match")
    return min(failures, 1)


if __name__ == "__main__":
    sys.exit(main())
