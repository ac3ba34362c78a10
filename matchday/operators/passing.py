"""Pass counts and pass success ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.functions.columns import ACCURATE_TAG, PASS_EVENT, half_up_ratio
from matchday.schemas import require_columns


def match_pass_counts(events: DataFrame) -> DataFrame:
    """Per match and team: accurate passes and all passes.

    Only passes by one of the two sides count.  One filter (``event = 'Pass'``
    is pushed into the Parquet scan) and one aggregation keyed by the event
    team, instead of one aggregation per side and a union.

    Output: match_id, team, competition, season, accurate_passes bigint,
    total_passes bigint.
    """
    require_columns(events, ["match_id", "competition", "season", "home_team", "away_team", "event_team", "event", "tags"], "events")
    team = F.col("event_team")
    passes = events.filter(
        (F.col("event") == PASS_EVENT) & ((team == F.col("home_team")) | (team == F.col("away_team")))
    )
    return passes.groupBy("match_id", team.alias("team"), "competition", "season").agg(
        F.count_if(F.array_contains(F.col("tags"), ACCURATE_TAG)).alias("accurate_passes"),
        F.count(F.lit(1)).alias("total_passes"),
    )


def pass_ratio_by_team(pass_counts: DataFrame, by_season: bool = False) -> DataFrame:
    """Mean per-match pass success ratio per competition and team.

    Per match ``round(accurate / total * 100, 2)``, then the mean of those
    rounded ratios, rounded to 2 (the mean of match ratios, not the pooled
    ratio).  Seasons are pooled unless ``by_season``.

    Both roundings are done in exact integer hundredths (see
    ``half_up_ratio``): the result does not depend on summation order, hence
    not on partitioning.

    Output: competition, [season,] team, pass_success_ratio double.
    """
    keys = ["competition", "season", "team"] if by_season else ["competition", "team"]
    per_match_cents = F.call_function(
        "div", F.col("accurate_passes") * 20000 + F.col("total_passes"), F.col("total_passes") * 2
    )
    return (
        pass_counts.filter(F.col("total_passes") > 0)
        .groupBy(*keys)
        .agg(F.sum(per_match_cents).alias("_cents"), F.count(F.lit(1)).alias("_matches"))
        .select(
            *keys,
            # mean of cents / 100, rounded to 2 decimals
            half_up_ratio(F.col("_cents"), F.col("_matches") * 100, digits=2).alias("pass_success_ratio"),
        )
    )
