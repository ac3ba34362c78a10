"""Same results under any shuffle partitioning, with AQE on and off."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from helpers import canon

NAMES = [
    "league_table",
    "global_positions",
    "best_teams",
    "lowest_pass_ratio",
    "pass_ratio_by_team",
    "most_minutes_by_role",
    "plus_minus",
    "label_index",
    "cyclic_accuracy",
    "tree_predictions",
    "random_split",
    "part_label_index",
]


@pytest.mark.parametrize("name", NAMES)
def test_partition_independent(spark, name):
    q = entry.queries()[name]
    results = []
    old = (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled"))
    try:
        for parts, aqe in [(1, "true"), (4, "false"), (64, "true"), (64, "false")]:
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            spark.conf.set("spark.sql.adaptive.enabled", aqe)
            results.append(canon(tuple(r) for r in q(spark, SF_SMALL).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.enabled", old[1])
    assert all(r == results[0] for r in results[1:])
