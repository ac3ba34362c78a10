"""Pass counts, pass ratios, lowest ratio, best teams."""

from pyspark.sql import functions as F

from helpers import events, rows_of
from matchday import operators as op


def _pass(m, home, away, team, tags, comp="C"):
    return (m, comp, home, away, team, "Pass", tags, "1H", 1)


def test_pass_counts_and_mean_of_match_ratios(spark):
    ev = events(
        spark,
        [
            _pass(1, "H", "A", "H", ["Accurate"]),
            _pass(1, "H", "A", "H", ["Accurate"]),
            _pass(1, "H", "A", "H", None),  # null tags: a pass, not accurate
            _pass(1, "H", "A", "A", ["Not accurate"]),
            _pass(1, "H", "A", "X", ["Accurate"]),  # neither side: ignored
            (1, "C", "H", "A", "H", "Duel", ["Accurate"], "1H", 1),  # not a pass
            _pass(2, "H", "B", "H", ["Accurate"]),
        ],
    )
    counts = op.match_pass_counts(ev)
    assert rows_of(counts, "match_id", "team", "accurate_passes", "total_passes") == [
        (1, "A", 0, 1),
        (1, "H", 2, 3),
        (2, "H", 1, 1),
    ]
    ratios = op.pass_ratio_by_team(counts)
    # per match 66.67 and 100.0 -> mean 83.335 -> 83.34 (pooled ratio would be 75.0)
    assert rows_of(ratios, "team", "pass_success_ratio") == [("A", 0.0), ("H", 83.34)]


def test_half_up_rounding_is_exact(spark):
    # 1/8 = 12.5% -> 12.5; 1/32 = 3.125% -> 3.13 (half up); 2/3 -> 66.67
    counts = spark.createDataFrame(
        [(1, "T1", "C", "S", 1, 8), (1, "T2", "C", "S", 1, 32), (1, "T3", "C", "S", 2, 3)],
        "match_id int, team string, competition string, season string, accurate_passes bigint, total_passes bigint",
    )
    assert rows_of(op.pass_ratio_by_team(counts), "team", "pass_success_ratio") == [
        ("T1", 12.5),
        ("T2", 3.13),
        ("T3", 66.67),
    ]


def test_first_n_per_group(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", 1, 2), ("a", 2, 3), ("b", 5, 4)], "g string, v int, id int")
    top = op.first_n_per_group(df, ["g"], [F.desc("v"), F.asc("id")], n=2, rank_col="rk")
    assert rows_of(top, "g", "v", "rk") == [("a", 2, 2), ("a", 3, 1), ("b", 5, 1)]


def test_lowest_pass_ratio_ties_by_team(spark):
    ratios = spark.createDataFrame(
        [("C1", "B", 50.0), ("C1", "A", 50.0), ("C1", "C", 70.0), ("C2", "D", 10.0)],
        "competition string, team string, pass_success_ratio double",
    )
    assert [tuple(r) for r in op.lowest_pass_ratio(ratios).collect()] == [("C2", "D", 10.0), ("C1", "A", 50.0)]


def _standings(spark, rows):
    return spark.createDataFrame(
        rows,
        "competition string, season string, team string, games bigint, wins bigint, draws bigint, losses bigint, goals_scored bigint, goals_conceded bigint, points bigint",
    )


def test_best_teams_team_in_two_competitions(spark):
    st = _standings(
        spark,
        [
            ("C1", "S", "A", 2, 2, 0, 0, 4, 0, 6),
            ("C1", "S", "B", 2, 0, 0, 2, 0, 4, 0),
            ("C2", "S", "A", 3, 1, 1, 1, 3, 3, 4),
            ("C2", "S", "D", 3, 2, 0, 1, 5, 2, 6),
        ],
    )
    ratios = spark.createDataFrame(
        [("C1", "A", 80.0), ("C1", "B", 60.0), ("C2", "A", 40.0), ("C2", "D", 55.5)],
        "competition string, team string, pass_success_ratio double",
    )
    best = op.best_teams(st, ratios, n=1)
    assert [tuple(r) for r in best.select("team", "competition", "pos", "gd", "avg", "pass_ratio").collect()] == [
        ("A", "C1", 1, "+4", 3.0, 80.0),
        ("D", "C2", 1, "+3", 2.0, 55.5),
    ]
    both = op.best_teams(st, ratios, n=2)
    assert both.count() == 4
    assert rows_of(both.filter(F.col("team") == "A"), "competition", "pass_ratio") == [("C1", 80.0), ("C2", 40.0)]


def test_best_teams_limit_is_top_k(spark):
    rows = []
    for c in range(7):
        rows.append((f"C{c}", "S", f"T{c}a", 3, 3, 0, 0, 9, 0, 9 - c))
        rows.append((f"C{c}", "S", f"T{c}b", 3, 0, 0, 3, 0, 9, 0))
    best = op.best_teams(_standings(spark, rows), spark.createDataFrame([], "competition string, team string, pass_success_ratio double"))
    out = best.collect()
    assert len(out) == 10
    avgs = [r["avg"] for r in out]
    assert avgs == sorted(avgs, reverse=True)


def test_bottom_n_per_group(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", 1, 2), ("a", 1, 3), ("b", 5, 4)], "g string, v int, id int")
    low = op.bottom_n_per_group(df, ["g"], ["v"], n=1, tie_break=["id"])
    assert rows_of(low, "g", "v", "id") == [("a", 1, 2), ("b", 5, 4)]
