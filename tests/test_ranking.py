"""Global and group positions: brute force, hot groups, empty tables, scratch names."""

import random

import pytest
from pyspark.sql import functions as F

from matchday import operators as op


def table(spark, n=500, hot=0.4, seed=3):
    r = random.Random(seed)
    rows = [("hot" if r.random() < hot else r.choice(["a", "b", None, ""]), r.randint(0, 60), i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "g string, x long, id long").repartition(7)


def order_key(row):
    return (row[0] is not None, row[0] or "", row[1], row[2])


@pytest.mark.parametrize("partitions", [1, 4, 64, None])
def test_positions_equal_a_sort(spark, partitions):
    rows, df = table(spark)
    got = op.global_positions(df, ["g", "x", "id"], "pos", partitions)
    want = {r: i for i, r in enumerate(sorted(rows, key=order_key), 1)}
    assert {tuple(r)[:3]: r["pos"] for r in got.collect()} == want


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_group_positions_equal_a_sort_in_each_group(spark, partitions):
    rows, df = table(spark)
    got = op.group_positions(df, ["g"], [F.desc("x"), "id"], "pos", partitions)
    want = {}
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        want |= {r: i for i, r in enumerate(mine, 1)}
    assert {tuple(r)[:3]: r["pos"] for r in got.collect()} == want


def test_one_group_only_and_nan_groups(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, i) for i in range(200)], "g double, id long")
    got = op.group_positions(df, ["g"], ["id"], "pos", 16).collect()
    assert sorted((r["id"], r["pos"]) for r in got) == [(i, i + 1) for i in range(200)]


def test_empty_and_clashing_names(spark):
    rows, df = table(spark, 50)
    empty = df.limit(0)
    assert op.global_positions(empty, ["x"]).collect() == []
    assert op.group_positions(empty, ["g"], ["x"]).collect() == []
    clash = df.withColumns({"_part": F.lit("own"), "_place": F.lit("own"), "position": F.col("id")})
    for out in (op.global_positions(clash, ["id"]), op.group_positions(clash, ["g"], ["id"])):
        assert sorted(out.columns) == sorted(clash.columns)
        assert {r["_part"] + r["_place"] for r in out.collect()} == {"ownown"}


def test_repeated_rows_get_different_positions(spark):
    df = spark.createDataFrame([(1,)] * 90, "x long").repartition(5)
    assert sorted(r["position"] for r in op.global_positions(df, ["x"]).collect()) == list(range(1, 91))


def test_plan_has_no_window(spark):
    _, df = table(spark)
    plan = op.global_positions(df, ["x", "id"])._jdf.queryExecution().toString()
    assert "Window" not in plan
