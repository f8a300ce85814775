"""Compare every query with its SQL counterpart: python tests/oracle_check.py <sf_dir> [names...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def _clean(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def differences(df, relation) -> list[str]:
    """What differs between a Spark result and a DuckDB result; empty when nothing does."""
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} != {sorted(relation.columns)}"]
    types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    found = [
        f"type of {n}: {t} != {types[n]}" for n, t in df.dtypes if TYPES.get(t, t) != types[n]
    ]
    ours = sorted((tuple(_clean(v) for v in r) for r in df.select(*names).collect()), key=_key)
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = sorted((tuple(_clean(v) for v in r) for r in relation.project(quoted).fetchall()), key=_key)
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows != {len(theirs)} rows")
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if unequal:
        found.append(f"{len(unequal)} unequal rows of {names}, first {unequal[0]}")
    return found


def main() -> int:
    import __spark_entry__ as entry
    from salesloom.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.monotonic()
        try:
            df = query(spark, sf_dir)
            problems = differences(df, con.sql(oracle[name])) if name in oracle else [f"rows only: {df.count()}"]
        except Exception as error:
            problems = [f"error: {str(error)[:700]}"]
        failed += bool(problems) and name in oracle
        print(f"{time.monotonic() - start:6.2f}s {name:28s} {'ok' if not problems else problems}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
