"""Most minutes per role, goal minutes, plus-minus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.functions.columns import full_name, goal_minute, is_goal, scoring_team
from matchday.operators.presence import minutes_per_player
from matchday.operators.topn import first_n_per_group
from matchday.schemas import PLAYERS, require_columns


def most_minutes_by_role(presence: DataFrame, players: DataFrame) -> DataFrame:
    """The player with the most minutes for each role.

    Players without minutes stay (left join) and sort last; a role in which
    nobody played still shows one player, the lowest id.  Ties go to the
    lowest player id.  The window keeps one row per role per map task before
    its shuffle (``WindowGroupLimit``), so large player tables are fine.

    Output: role, player ("first last", null parts skipped), birth_area,
    minutes bigint; by minutes descending.
    """
    require_columns(players, PLAYERS, "players")
    joined = players.join(minutes_per_player(presence), "player_id", "left")
    top = first_n_per_group(joined, ["role"], [F.desc_nulls_last("minutes"), F.asc("player_id")], 1)
    return top.select("role", full_name().alias("player"), "birth_area", "minutes").orderBy(
        F.desc_nulls_last("minutes"), F.asc("role")
    )


def goal_minutes(events: DataFrame) -> DataFrame:
    """Every goal with its match minute and scoring side.

    Output: match_id, competition, season, goal_minute bigint, scoring_team.
    """
    return events.filter(is_goal()).select(
        "match_id",
        "competition",
        "season",
        goal_minute().alias("goal_minute"),
        scoring_team().alias("scoring_team"),
    )


def plus_minus(goals: DataFrame, presence: DataFrame) -> DataFrame:
    """Plus-minus per player: for every goal scored while the player was on
    the pitch (interval closed at both ends), +1 if their team scored, else -1.

    Interval join, shaped for skew: goals are first counted per (match,
    minute, scoring team) with map-side partial aggregation, which bounds the
    goal side of the join to (2 teams x minutes of a match) rows per match no
    matter how many goals one match holds; the presence side is bounded by
    the team sheets (at most 28 rows per match).  The equi-join on match keeps
    the minute range as a residual condition, so no pair outside one match is
    ever formed.

    Output: player_id, plus_minus bigint.
    """
    # goal rows, or goal counts that are already aggregated (column ``goals``)
    weight = F.col("goals") if "goals" in goals.columns else F.lit(1)
    counts = goals.groupBy("match_id", "goal_minute", "scoring_team").agg(F.sum(weight).alias("goals"))
    on_pitch = presence.select("match_id", "player_id", "player_team", "start_minute", "end_minute")
    hits = counts.join(on_pitch, "match_id").filter(
        F.col("goal_minute").between(F.col("start_minute"), F.col("end_minute"))
    )
    signed = F.when(F.col("scoring_team") == F.col("player_team"), F.col("goals")).otherwise(-F.col("goals"))
    return hits.groupBy("player_id").agg(F.sum(signed).alias("plus_minus"))


def top_plus_minus(pm: DataFrame, players: DataFrame, above: int = 65) -> DataFrame:
    """Players with plus-minus strictly above ``above``: name, birth area,
    role and value, by value descending then birth area ascending.

    Output: player, birth_area, role, plus_minus.
    """
    require_columns(players, PLAYERS, "players")
    return (
        players.join(pm.filter(F.col("plus_minus") > above), "player_id")
        .select(full_name().alias("player"), "birth_area", "role", "plus_minus")
        .orderBy(F.desc("plus_minus"), F.asc_nulls_first("birth_area"), F.asc("player"))
    )
