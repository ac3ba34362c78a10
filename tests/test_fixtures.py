"""The fixture views equal their SQL statements (DuckDB) row for row."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import canon
from matchday.plans.oracle import _team, with_views
from matchday.sources.fixtures import events_view, matches_view, measurements_view, players_view


def _compare(sdf, duck, sql):
    s = sdf.toPandas()
    d = duck.execute(sql).df()
    cols = sorted(s.columns)
    assert sorted(d.columns) == cols
    assert canon(s[cols].itertuples(index=False)) == canon(d[cols].itertuples(index=False))


def test_events_view(spark, duck):
    ev = events_view(spark, SF_SMALL)
    flat = ev.withColumn("tag", F.col("tags")[0]).drop("tags")
    _compare(flat, duck, with_views("SELECT * FROM fb_events", "fb_events"))
    # tags is a one-element array exactly when the flat tag is set
    assert ev.filter(F.col("tags").isNotNull() & (F.size("tags") != 1)).count() == 0


def test_matches_view_flattened(spark, duck):
    ms = matches_view(spark, SF_SMALL)
    lineups = ms.select(
        "match_id", F.explode(F.array("home_team_data", "away_team_data")).alias("side")
    ).select("match_id", F.col("side.team").alias("team"), F.explode("side.lineup").alias("player_id"))
    sql = f"""
SELECT m AS match_id, {_team("tn")} AS team, tno * 100 + n AS player_id
FROM fb_match_sides, range(1, 12) AS t(n)
WHERE NOT (side = 'away' AND m % 97 = 5)
"""
    _compare(lineups, duck, with_views(sql, "fb_match_sides"))


def test_players_view(spark, duck):
    _compare(players_view(spark, SF_SMALL), duck, with_views("SELECT * FROM fb_players", "fb_players"))


def test_measurements_view(spark, duck):
    _compare(measurements_view(spark, SF_SMALL), duck, with_views("SELECT * FROM fb_measurements", "fb_measurements"))
