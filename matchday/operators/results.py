"""Match results and per-team match rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.functions.columns import is_goal
from matchday.schemas import require_columns

MATCH_KEYS = ["match_id", "competition", "season", "home_team", "away_team"]


def match_results(events: DataFrame) -> DataFrame:
    """Goals per side for every match that has at least one event.

    A goal is a save attempt tagged ``Goal``; it counts for the side that did
    *not* attempt the save.  An event team that is null or neither side adds
    nothing.  Matches without goals come out 0-0.

    One aggregation over the match keys with conditional counts: a single
    scan of the events, partial (map-side) aggregation before the shuffle, so
    a match holding a large share of all events collapses to one row per map
    task before it is shuffled.

    Output: match_id, competition, season, home_team, away_team,
    home_goals bigint, away_goals bigint.
    """
    require_columns(events, MATCH_KEYS + ["event_team", "event", "tags"], "events")
    goal = is_goal()
    return events.groupBy(*MATCH_KEYS).agg(
        F.count_if(goal & (F.col("event_team") == F.col("away_team"))).alias("home_goals"),
        F.count_if(goal & (F.col("event_team") == F.col("home_team"))).alias("away_goals"),
    )


def _side(team: str, scored: str, conceded: str) -> F.Column:
    return F.struct(
        F.col(team).alias("team"),
        F.col(scored).alias("goals_scored"),
        F.col(conceded).alias("goals_conceded"),
    )


def team_match_rows(results: DataFrame) -> DataFrame:
    """Two rows per match, one per side: goals scored and conceded, win, draw
    and loss flags and ``games = 1``.

    Both sides come from one pass over the results (``inline`` of a two-element
    array) instead of a union of two projections, so the input is planned and
    scanned once.

    Output: match_id, competition, season, team, goals_scored, goals_conceded,
    wins, draws, losses, games (flags int).
    """
    sides = F.array(
        _side("home_team", "home_goals", "away_goals"),
        _side("away_team", "away_goals", "home_goals"),
    )
    rows = results.select("match_id", "competition", "season", F.inline(sides))
    scored, conceded = F.col("goals_scored"), F.col("goals_conceded")
    return rows.select(
        "match_id",
        "competition",
        "season",
        "team",
        "goals_scored",
        "goals_conceded",
        (scored > conceded).cast("int").alias("wins"),
        (scored == conceded).cast("int").alias("draws"),
        (scored < conceded).cast("int").alias("losses"),
        F.lit(1).alias("games"),
    )
