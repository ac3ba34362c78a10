"""Single-pass plan for a query that needs two things from the events.

``best_teams`` needs match results *and* pass counts.  Composed from the
separate operators it scans and aggregates the large events table twice.
Here ``match_summary`` counts goals and passes of both sides in one
aggregation per match, and ``best_teams_from_events`` runs results,
standings, ratios and the top-n report from it without a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.functions.columns import (
    ACCURATE_TAG,
    PASS_EVENT,
    half_up_ratio,
    int_div,
    is_goal,
)
from matchday.operators.results import MATCH_KEYS
from matchday.operators.topn import top_teams_report
from matchday.schemas import require_columns


def match_summary(events: DataFrame) -> DataFrame:
    """Per match: goals of each side and accurate/all passes of each side.

    Output: match keys, home_goals, away_goals, home_accurate_passes,
    home_passes, away_accurate_passes, away_passes (bigint).
    """
    require_columns(events, MATCH_KEYS + ["event_team", "event", "tags"], "events")
    goal = is_goal()
    is_pass = F.col("event") == PASS_EVENT
    accurate = F.coalesce(F.array_contains(F.col("tags"), ACCURATE_TAG), F.lit(False))
    home = F.col("event_team") == F.col("home_team")
    away = F.col("event_team") == F.col("away_team")
    return events.groupBy(*MATCH_KEYS).agg(
        F.count_if(goal & away).alias("home_goals"),
        F.count_if(goal & home).alias("away_goals"),
        F.count_if(is_pass & home & accurate).alias("home_accurate_passes"),
        F.count_if(is_pass & home).alias("home_passes"),
        F.count_if(is_pass & away & accurate).alias("away_accurate_passes"),
        F.count_if(is_pass & away).alias("away_passes"),
    )


def _side(prefix: str, other: str) -> F.Column:
    return F.struct(
        F.col(f"{prefix}_team").alias("team"),
        F.col(f"{prefix}_goals").alias("goals_scored"),
        F.col(f"{other}_goals").alias("goals_conceded"),
        F.col(f"{prefix}_accurate_passes").alias("accurate_passes"),
        F.col(f"{prefix}_passes").alias("total_passes"),
    )


def best_teams_from_events(events: DataFrame, n: int = 2, limit: int = 10) -> DataFrame:
    """``best_teams`` computed in one pass over the events (same output).

    Each side's match row carries its result and its passes; per
    (competition, team) the standings are summed and the per-match pass
    ratios (matches with at least one pass) averaged, exactly rounded.
    """
    sides = match_summary(events).select(
        "competition", F.inline(F.array(_side("home", "away"), _side("away", "home")))
    )
    scored, conceded, passes = F.col("goals_scored"), F.col("goals_conceded"), F.col("total_passes")
    cents = F.when(passes > 0, int_div(F.col("accurate_passes") * 20000 + passes, passes * 2))
    totals = sides.groupBy("competition", "team").agg(
        F.count(F.lit(1)).alias("pld"),
        F.count_if(scored > conceded).alias("w"),
        F.count_if(scored == conceded).alias("d"),
        F.count_if(scored < conceded).alias("l"),
        F.sum(scored).alias("gf"),
        F.sum(conceded).alias("ga"),
        (F.sum(scored) - F.sum(conceded)).alias("gd"),
        (F.count_if(scored > conceded) * 3 + F.count_if(scored == conceded)).alias("pts"),
        F.sum(cents).alias("_cents"),
        F.count_if(passes > 0).alias("_pass_matches"),
    )
    with_ratio = totals.withColumn(
        "pass_ratio", half_up_ratio(F.col("_cents"), F.col("_pass_matches") * 100, digits=2)
    ).drop("_cents", "_pass_matches")
    return top_teams_report(with_ratio, n, limit)
