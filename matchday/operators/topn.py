"""First/last n per group and the best-teams report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.functions.columns import half_up_ratio, signed_text
from matchday.operators.standings import competition_totals, table_order


def first_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    n: int = 1,
    rank_col: str | None = None,
) -> DataFrame:
    """Keep the first ``n`` rows of each group under ``order``.

    ``row_number`` directly followed by the filter lets Catalyst insert a
    ``WindowGroupLimit`` on both sides of the shuffle: every map task keeps at
    most ``n`` rows per group before anything is exchanged, so a group with a
    huge number of rows never reaches one task whole.  Give ``order`` a total
    ordering (append a unique key) for reproducible ties.
    If ``rank_col`` is given the position is kept in that column.
    """
    name = rank_col or "_row_in_group"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= n)
    return kept if rank_col else kept.drop(name)


def bottom_n_per_group(
    df: DataFrame, group: Sequence[str], keys: Sequence[str], n: int = 1, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Keep the ``n`` rows with the smallest ``keys`` (ascending, then
    ``tie_break``) in each group; see ``first_n_per_group``."""
    order = [F.asc(k) for k in (*keys, *tie_break)]
    return first_n_per_group(df, group, order, n)


def lowest_pass_ratio(ratios: DataFrame, n: int = 1) -> DataFrame:
    """Team(s) with the lowest pass success ratio per competition, listed by
    ratio ascending.

    Output: competition, team, pass_success_ratio.
    """
    worst = bottom_n_per_group(ratios, ["competition"], ["pass_success_ratio"], n, tie_break=["team"])
    return worst.select("competition", "team", "pass_success_ratio").orderBy(
        F.asc("pass_success_ratio"), F.asc("competition"), F.asc("team")
    )


def top_teams_report(totals: DataFrame, n: int = 2, limit: int = 10) -> DataFrame:
    """Top ``n`` per competition of per-(competition, team) totals (pld, w,
    d, l, gf, ga, gd numeric, pts, pass_ratio), formatted as the best-teams
    report and cut to ``limit`` rows by points per game."""
    top = first_n_per_group(totals, ["competition"], table_order(), n, rank_col="pos")
    report = top.select(
        "team",
        "competition",
        "pos",
        "pld",
        "w",
        "d",
        "l",
        "gf",
        "ga",
        signed_text("gd").alias("gd"),
        "pts",
        half_up_ratio("pts", "pld", digits=2).alias("avg"),
        "pass_ratio",
    )
    # the limit is the feature (a top-k report); the sort key is total so the
    # cut is reproducible
    return report.orderBy(F.desc("avg"), F.desc("pts"), F.asc("competition"), F.asc("pos")).limit(limit)


def best_teams(standings: DataFrame, ratios: DataFrame, n: int = 2, limit: int = 10) -> DataFrame:
    """Top ``n`` teams of every competition with position, points per game
    and pass ratio; at most ``limit`` rows by points per game descending.

    The pass ratio is joined on (competition, team): a team playing in two
    competitions keeps one row and one ratio per competition.  Points per game
    is ``round(pts / pld, 2)`` computed exactly.  (``best_teams_from_events``
    computes the same report in one pass over the events.)

    Output: team, competition, pos int, pld, w, d, l, gf, ga, gd string, pts,
    avg double, pass_ratio double.
    """
    joined = competition_totals(standings).join(
        ratios.select("competition", "team", F.col("pass_success_ratio").alias("pass_ratio")),
        ["competition", "team"],
        "left",
    )
    return top_teams_report(joined, n, limit)
