"""Match results, team rows, standings, league table."""

from pyspark.sql import functions as F

from conftest import SF_CHECK
from helpers import events, goal, rows_of
from matchday import operators as op
from matchday.plans import football as fb


def _edge_events(spark):
    return events(
        spark,
        [
            goal(1, "H", "A", "A"),  # saved by A -> goal for H
            goal(1, "H", "A", "H", period="2H"),  # goal for A
            goal(1, "H", "A", None),  # unknown side: counts for nobody in results
            goal(1, "H", "A", "X"),  # neither side: counts for nobody
            (1, "C", "H", "A", "A", "Save attempt", None, "1H", 100),  # null tags: no goal
            (1, "C", "H", "A", "A", "Save attempt", ["Accurate"], "1H", 100),  # not a goal
            (2, "C", "H", "B", "H", "Pass", ["Accurate"], "1H", 10),  # match without goals
        ],
    )


def test_match_results_edge_rows(spark):
    res = op.match_results(_edge_events(spark))
    assert rows_of(res, "match_id", "home_team", "away_team", "home_goals", "away_goals") == [
        (1, "H", "A", 1, 1),
        (2, "H", "B", 0, 0),
    ]


def test_team_match_rows_flags(spark):
    res = spark.createDataFrame(
        [(1, "C", "S", "H", "A", 2, 1), (2, "C", "S", "A", "H", 0, 0)],
        "match_id int, competition string, season string, home_team string, away_team string, home_goals bigint, away_goals bigint",
    )
    rows = rows_of(op.team_match_rows(res), "match_id", "team", "goals_scored", "goals_conceded", "wins", "draws", "losses", "games")
    assert rows == [
        (1, "A", 1, 2, 0, 0, 1, 1),
        (1, "H", 2, 1, 1, 0, 0, 1),
        (2, "A", 0, 0, 0, 1, 0, 1),
        (2, "H", 0, 0, 0, 1, 0, 1),
    ]


def _results(spark, rows):
    return spark.createDataFrame(
        [(i, comp, "S", h, a, hg, ag) for i, (comp, h, a, hg, ag) in enumerate(rows)],
        "match_id int, competition string, season string, home_team string, away_team string, home_goals bigint, away_goals bigint",
    )


def test_league_table_order_and_signed_gd(spark):
    res = _results(
        spark,
        [
            ("C", "A", "B", 2, 0),
            ("C", "C", "D", 1, 1),
            ("C", "B", "C", 0, 0),
            ("C", "D", "A", 1, 0),
            ("E", "Q", "P", 1, 1),  # equal points, GD and GF: name decides
        ],
    )
    table = op.league_table(op.season_standings(op.team_match_rows(res)))
    assert rows_of(table, "competition", "pos", "team", "pld", "w", "d", "l", "gf", "ga", "gd", "pts") == [
        ("C", 1, "D", 2, 1, 1, 0, 2, 1, "+1", 4),
        ("C", 2, "A", 2, 1, 0, 1, 2, 1, "+1", 3),
        ("C", 3, "C", 2, 0, 2, 0, 1, 1, "+0", 2),
        ("C", 4, "B", 2, 0, 1, 1, 0, 2, "-2", 1),
        ("E", 1, "P", 1, 0, 1, 0, 1, 1, "+0", 1),
        ("E", 2, "Q", 1, 0, 1, 0, 1, 1, "+0", 1),
    ]
    one = op.league_table(op.season_standings(op.team_match_rows(res)), "E")
    assert [r["team"] for r in one.collect()] == ["P", "Q"]


def test_gd_ranked_as_number_not_text(spark):
    # "+9" sorts after "+10" as text; as numbers 10 > 9
    res = _results(spark, [("C", "A", "Z", 10, 0), ("C", "B", "Y", 9, 0), ("C", "Z", "B", 0, 0), ("C", "Y", "A", 0, 0)])
    table = op.league_table(op.season_standings(op.team_match_rows(res)))
    top = [r["team"] for r in table.orderBy("pos").collect()][:2]
    assert top == ["A", "B"]


def test_standings_properties(spark):
    st = fb.season_standings(spark, SF_CHECK)
    bad = st.filter(F.col("games") != F.col("wins") + F.col("draws") + F.col("losses")).count()
    assert bad == 0
    per_comp = st.groupBy("competition").agg(F.sum("goals_scored").alias("gf"), F.sum("goals_conceded").alias("ga"))
    assert per_comp.filter(F.col("gf") != F.col("ga")).count() == 0
    table = fb.league_table(spark, SF_CHECK)
    pos = table.groupBy("competition").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.count("*").alias("n"))
    assert pos.filter((F.col("lo") != 1) | (F.col("hi") != F.col("n"))).count() == 0
    rows = fb.team_match_rows(spark, SF_CHECK)
    pts = rows.groupBy("match_id").agg(F.sum(F.col("wins") * 3 + F.col("draws")).alias("p"))
    assert pts.filter(~F.col("p").isin(2, 3)).count() == 0


def test_league_table_by_season(spark):
    res = spark.createDataFrame(
        [(1, "C", "S1", "A", "B", 1, 0), (2, "C", "S2", "A", "B", 0, 2)],
        "match_id int, competition string, season string, home_team string, away_team string, home_goals bigint, away_goals bigint",
    )
    st = op.season_standings(op.team_match_rows(res))
    per_season = op.league_table(st, by_season=True)
    assert rows_of(per_season, "season", "pos", "team", "pts") == [
        ("S1", 1, "A", 3),
        ("S1", 2, "B", 0),
        ("S2", 1, "B", 3),
        ("S2", 2, "A", 0),
    ]
    pooled = op.league_table(st)
    assert rows_of(pooled, "pos", "team", "pts", "gd") == [(1, "B", 3, "+1"), (2, "A", 3, "-1")]
