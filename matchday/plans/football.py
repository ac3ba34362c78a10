"""Football queries: (spark, sf_dir) -> DataFrame, composed from operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchday import operators as op
from matchday.sources.fixtures import events_view, match_numbers, matches_view, players_view

# Plus-minus threshold used by the registered query.  The original report
# uses +65 on full seasons of real data; the fixture has about one goal a match
# and 18 matches a player, so the registered query lists players above +5.
TOP_PLUS_MINUS_ABOVE = 5


def match_results(spark: SparkSession, base: str) -> DataFrame:
    return op.match_results(events_view(spark, base))


def team_match_rows(spark: SparkSession, base: str) -> DataFrame:
    return op.team_match_rows(match_results(spark, base))


def season_standings(spark: SparkSession, base: str) -> DataFrame:
    return op.season_standings(team_match_rows(spark, base))


def league_table(spark: SparkSession, base: str, competition: str | None = None) -> DataFrame:
    return op.league_table(season_standings(spark, base), competition)


def global_positions(spark: SparkSession, base: str) -> DataFrame:
    """Positions of all teams and seasons of all competitions in one order."""
    return op.overall_table(season_standings(spark, base))


def match_pass_counts(spark: SparkSession, base: str) -> DataFrame:
    return op.match_pass_counts(events_view(spark, base))


def pass_ratio_by_team(spark: SparkSession, base: str) -> DataFrame:
    return op.pass_ratio_by_team(match_pass_counts(spark, base))


def lowest_pass_ratio(spark: SparkSession, base: str) -> DataFrame:
    return op.lowest_pass_ratio(pass_ratio_by_team(spark, base))


def best_teams(spark: SparkSession, base: str) -> DataFrame:
    """Results and pass counts from one pass over the events."""
    return op.best_teams_from_events(events_view(spark, base), n=2, limit=10)


def best_teams_composed(spark: SparkSession, base: str) -> DataFrame:
    """The same report composed from the separate operators (two event scans)."""
    return op.best_teams(season_standings(spark, base), pass_ratio_by_team(spark, base), n=2, limit=10)


def match_length(spark: SparkSession, base: str) -> DataFrame:
    return op.match_length(events_view(spark, base))


def substitution_rows(spark: SparkSession, base: str) -> DataFrame:
    return op.substitution_rows(matches_view(spark, base), events_view(spark, base))


def lineup_rows(spark: SparkSession, base: str) -> DataFrame:
    return op.lineup_rows(matches_view(spark, base), events_view(spark, base))


def player_presence(spark: SparkSession, base: str) -> DataFrame:
    return op.player_presence(matches_view(spark, base), events_view(spark, base))


def presence_from_flat(spark: SparkSession, base: str) -> DataFrame:
    """The same intervals from flat line-up and substitution tables, by a join
    that splits hot keys."""
    return op.presence_from_flat(lineup_rows(spark, base), substitution_rows(spark, base))


def minutes_per_player(spark: SparkSession, base: str) -> DataFrame:
    return op.minutes_per_player(player_presence(spark, base))


def most_minutes_by_role(spark: SparkSession, base: str) -> DataFrame:
    numbers = match_numbers(spark, base)  # one read of orders for sheets and players
    presence = op.player_presence(matches_view(spark, base, numbers), events_view(spark, base))
    return op.most_minutes_by_role(presence, players_view(spark, base, numbers))


def goal_minutes(spark: SparkSession, base: str) -> DataFrame:
    return op.goal_minutes(events_view(spark, base))


def plus_minus(spark: SparkSession, base: str, numbers: DataFrame | None = None) -> DataFrame:
    """Goal rows joined to presence intervals; both filters reach the scan."""
    events = events_view(spark, base)
    return op.plus_minus(op.goal_minutes(events), op.player_presence(matches_view(spark, base, numbers), events))


def top_plus_minus(spark: SparkSession, base: str, above: int = TOP_PLUS_MINUS_ABOVE) -> DataFrame:
    numbers = match_numbers(spark, base)  # one read of orders for sheets and players
    return op.top_plus_minus(plus_minus(spark, base, numbers), players_view(spark, base, numbers), above=above)
