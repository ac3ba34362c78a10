"""Season standings and league tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchday.functions.columns import signed_text
from matchday.operators.ranking import global_positions


def season_standings(team_rows: DataFrame) -> DataFrame:
    """Per competition, season and team: games, wins, draws, losses, goals
    scored and conceded, and ``points = 3 * wins + draws``.

    Output: competition, season, team, games, wins, draws, losses,
    goals_scored, goals_conceded, points (all bigint).
    """
    return team_rows.groupBy("competition", "season", "team").agg(
        F.sum("games").alias("games"),
        F.sum("wins").alias("wins"),
        F.sum("draws").alias("draws"),
        F.sum("losses").alias("losses"),
        F.sum("goals_scored").alias("goals_scored"),
        F.sum("goals_conceded").alias("goals_conceded"),
        (F.sum("wins") * 3 + F.sum("draws")).alias("points"),
    )


def competition_totals(standings: DataFrame, by_season: bool = False) -> DataFrame:
    """Standings summed over seasons per (competition, team) -- or kept per
    season -- in table terms: pld, w, d, l, gf, ga, gd (numeric), pts."""
    keys = ["competition", "season", "team"] if by_season else ["competition", "team"]
    return standings.groupBy(*keys).agg(
        F.sum("games").alias("pld"),
        F.sum("wins").alias("w"),
        F.sum("draws").alias("d"),
        F.sum("losses").alias("l"),
        F.sum("goals_scored").alias("gf"),
        F.sum("goals_conceded").alias("ga"),
        (F.sum("goals_scored") - F.sum("goals_conceded")).alias("gd"),
        F.sum("points").alias("pts"),
    )


def table_order() -> list[F.Column]:
    """Table order: points, goal difference, goals for (all descending), then
    team name so positions are total and reproducible."""
    return [F.desc("pts"), F.desc("gd"), F.desc("gf"), F.asc("team")]


def league_table(standings: DataFrame, competition: str | None = None, by_season: bool = False) -> DataFrame:
    """League table per competition (one competition if given); seasons are
    pooled unless ``by_season``, which gives one table per competition and
    season (with a ``season`` column).

    Positions come from ``row_number`` over a window partitioned by
    competition -- never a global window, and never a position taken from a
    generated id (which is only contiguous inside one partition).  Goal
    difference is ranked as a number and only then rendered as text with a
    ``+`` for values >= 0.

    Output: competition, pos int, team, pld, w, d, l, gf, ga, gd string, pts.
    """
    if competition is not None:
        standings = standings.filter(F.col("competition") == competition)
    groups = ["competition", "season"] if by_season else ["competition"]
    ranked = competition_totals(standings, by_season).withColumn(
        "pos", F.row_number().over(Window.partitionBy(*groups).orderBy(*table_order()))
    )
    return ranked.select(
        *groups,
        "pos",
        "team",
        "pld",
        "w",
        "d",
        "l",
        "gf",
        "ga",
        signed_text("gd").alias("gd"),
        "pts",
    ).orderBy(*groups, "pos")


def overall_table(standings: DataFrame, partitions: int | None = None) -> DataFrame:
    """Every team and season of all competitions in one order of merit.

    Positions are those of a global sort in table order; equal rows go by
    competition, then season, nulls first.  No group and no global window: see
    ``ranking.global_positions``.

    Output: position bigint (from 1), competition, season, team, pld, w, d, l,
    gf, ga, gd bigint, pts.
    """
    order = [*table_order(), F.asc("competition"), F.asc("season")]
    ranked = global_positions(competition_totals(standings, by_season=True), order, partitions=partitions)
    return ranked.select("position", "competition", "season", "team", "pld", "w", "d", "l", "gf", "ga", "gd", "pts")
