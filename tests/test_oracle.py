"""Every registered query against its SQL oracle (DuckDB) at sf0.001."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from helpers import canon

# the pipeline operators are compared in tests/llm
ORACLES = {k: v for k, v in entry.oracle_sql().items() if not k.startswith("op") and k != "pipeline"}


def test_every_query_registered_has_callable():
    qs = entry.queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) >= 26


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 50
    assert df.columns == ["competition", "pos", "team", "pld", "w", "d", "l", "gf", "ga", "gd", "pts"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    spark_pd = sdf.toPandas()
    duck_pd = duck.execute(ORACLES[name]).df()
    assert sorted(spark_pd.columns) == sorted(duck_pd.columns)
    cols = sorted(spark_pd.columns)
    assert len(spark_pd) == len(duck_pd)
    assert canon(spark_pd[cols].itertuples(index=False)) == canon(duck_pd[cols].itertuples(index=False))
    for c in cols:
        # same kind of value: integer, float or text (pandas makes integers with nulls floats)
        assert spark_pd[c].dtype.kind == duck_pd[c].dtype.kind or len(spark_pd) == 0 or spark_pd[c].isna().any(), c


def test_every_query_documented_and_oracles_read_driver_tables_only():
    import os
    import re

    readme = open(os.path.join(os.path.dirname(os.path.dirname(__file__)), "README.md")).read()
    for name in entry.queries():
        if not name.startswith("op"):
            assert f"`{name}`" in readme, name
    driver_tables = {"lineitem", "orders"}
    for name, sql in ORACLES.items():
        used = set()
        for a, b in re.findall(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+)|,\s*([a-z_0-9]+)\s+AS\s+t\(", sql, flags=re.I):
            used.add((a or b).lower())
        ctes = set(re.findall(r"\b([a-z_0-9]+)\s+AS\s+\(", sql, flags=re.I))
        base = {t for t in used if t not in ctes and t not in ("range",)}
        assert base <= driver_tables, (name, base)
