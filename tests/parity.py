"""Run every registered query against its SQL counterpart: ``python tests/parity.py [sf] [names]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, as text; empty when columns and rows (as a multiset) are equal."""
    relation = con.execute(sql)
    names = [c[0] for c in relation.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    order = sorted(names)
    want = Counter(tuple(row[names.index(c)] for c in order) for row in relation.fetchall())
    got = Counter(tuple(row) for row in df.select(*[f"`{c}`" for c in order]).collect())
    if want == got:
        return []
    extra, missing = got - want, want - got
    return [
        f"{sum(got.values())} rows, expected {sum(want.values())}; columns {order}",
        *(f"  only Spark : {x}" for x in list(extra)[:3]),
        *(f"  only DuckDB: {x}" for x in list(missing)[:3]),
    ]


def main() -> int:
    import __spark_entry__ as contract

    from tarmac import build_session

    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    chosen = sys.argv[2:] or list(contract.queries())
    spark = build_session(
        "parity", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name in chosen:
        start = time.time()
        try:
            found = differences(
                contract.queries()[name](spark, folder), con, contract.oracle_sql()[name]
            )
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n  ")
    print(f"{len(chosen) - bad} of {len(chosen)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
