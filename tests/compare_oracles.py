"""Compare every registered query with its SQL oracle at any scale factor.

    python tests/compare_oracles.py /root/testdata/sf0.01 [query ...]

Runs each query on Spark and its oracle on DuckDB over the same Parquet
tables, and reports row counts, column names, value equality (order
insensitive, floats to 9 digits) and dtype differences.  Exit status 1 if
any query differs.  A development tool for fixture scales: it brings both
results to the driver to compare them (the library itself never does).
"""

from __future__ import annotations

import os
import sys
import time

from helpers import canon


def _rows(frame):
    return frame[sorted(frame.columns)].itertuples(index=False)


def main(argv: list[str]) -> int:
    if not argv:
        print(__doc__)
        return 2
    base, only = argv[0], set(argv[1:])
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import duckdb

    import __spark_entry__ as entry
    from matchday.session import build_session

    spark = build_session("local[*]", app_name="matchday-check")
    con = duckdb.connect()
    for table in ("lineitem", "orders", "documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{base}/{table}.parquet')")
    oracles = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.perf_counter()
        got = query(spark, base).toPandas()
        seconds = time.perf_counter() - start
        if name not in oracles:
            print(f"{name:28s} rows {len(got):>8}  (no oracle)  {seconds:6.1f}s")
            continue
        want = con.execute(oracles[name]).df()
        same_cols = sorted(got.columns) == sorted(want.columns)
        same = same_cols and len(got) == len(want) and canon(_rows(got)) == canon(_rows(want))
        bad += not same
        print(f"{name:28s} rows {len(got):>8}/{len(want):<8} {'equal' if same else 'DIFFERENT'}  {seconds:6.1f}s")
        if same_cols:
            kinds = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns if str(got[c].dtype) != str(want[c].dtype)}
            if kinds:
                print(f"    dtypes differ: {kinds}")
    spark.stop()
    print(f"{bad} different")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
