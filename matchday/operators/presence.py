"""Match length, team sheets to rows, time on the pitch.

A match sheet row holds both teams, each with a lineup array and up to three
substitutions.  Everything here is computed *inside* that row with generators
and higher-order functions, so turning sheets into intervals needs no join
and no shuffle; the only shuffle is the aggregation of the events into a
match length and its join to the sheets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.functions.columns import SECOND_HALF
from matchday.operators.joins import skew_join
from matchday.schemas import MATCHES, require_columns

_SUBS = ["substitution1", "substitution2", "substitution3"]


def match_length(events: DataFrame) -> DataFrame:
    """Length of every match in minutes: ``ceil(max second-half event time / 60 + 45)``.

    Matches without a second-half event have no length.
    Output: match_id, match_length bigint.
    """
    require_columns(events, ["match_id", "event_period", "event_time"], "events")
    return (
        events.filter(F.col("event_period") == SECOND_HALF)
        .groupBy("match_id")
        .agg(F.ceil(F.max("event_time") / 60 + 45).alias("match_length"))
    )


def matches_with_length(
    matches: DataFrame, events: DataFrame | None = None, lengths: DataFrame | None = None
) -> DataFrame:
    """Match sheets joined (inner) to their length; a match without a
    second-half event is dropped.  ``lengths`` (match_id, match_length) may be
    given instead of the events when it is already known."""
    require_columns(matches, MATCHES, "matches")
    if lengths is None:
        if events is None:
            raise ValueError("give events or lengths")
        lengths = match_length(events)
    return matches.join(lengths, "match_id")


def _side_rows(
    matches: DataFrame, events: DataFrame | None, *extra: Column, lengths: DataFrame | None = None
) -> DataFrame:
    """One row per (match, side): the side's sheet as ``side``."""
    return matches_with_length(matches, events, lengths).select(
        "match_id",
        "competition",
        "season",
        "match_length",
        *extra,
        F.explode(F.array("home_team_data", "away_team_data")).alias("side"),
    )


def _present(subs: Column) -> Column:
    return F.filter(subs, lambda s: s.isNotNull())


def substitution_rows(matches: DataFrame, events: DataFrame) -> DataFrame:
    """One row per substitution actually made, both sides.

    Output: match_id, player_id (coming on), player_out_id, competition,
    season, player_team, sub_minute int, match_length bigint.
    """
    sides = _side_rows(matches, events)
    subs = sides.select(
        "match_id",
        "competition",
        "season",
        "match_length",
        F.col("side.team").alias("player_team"),
        F.explode(_present(F.array(*[F.col(f"side.{s}") for s in _SUBS]))).alias("sub"),
    )
    return subs.select(
        "match_id",
        F.col("sub.player_in").alias("player_id"),
        F.col("sub.player_out").alias("player_out_id"),
        "competition",
        "season",
        "player_team",
        F.col("sub.minute").alias("sub_minute"),
        "match_length",
    )


def lineup_rows(matches: DataFrame, events: DataFrame) -> DataFrame:
    """One row per starting player; a null or empty lineup gives no rows.

    Output: match_id, competition, season, player_team, player_id,
    match_length bigint, start_minute int (0).
    """
    sides = _side_rows(matches, events)
    return sides.select(
        "match_id",
        "competition",
        "season",
        F.col("side.team").alias("player_team"),
        F.explode(F.col("side.lineup")).alias("player_id"),
        "match_length",
        F.lit(0).alias("start_minute"),
    )


# The interval array of one side, as one SQL expression (higher-order
# functions with SQL lambdas): the same functions as the Column API, built on
# the JVM in one call instead of one driver round trip per node.
_STARTER = "named_struct('player_id', CAST(pid AS {id}), 'start_minute', 0, 'end_minute', CAST({end} AS BIGINT))"
_SIDE_INTERVALS = """
concat(
  flatten(transform(coalesce(side.lineup, array()), pid ->
    CASE WHEN size(filter(match_subs, s -> s.player_out = pid)) > 0
         THEN transform(filter(match_subs, s -> s.player_out = pid), s -> {replaced})
         ELSE array({whole})
    END)),
  transform(
    filter(array(side.substitution1, side.substitution2, side.substitution3), s -> s IS NOT NULL),
    s -> named_struct('player_id', CAST(s.player_in AS {id}), 'start_minute', CAST(s.minute AS INT),
                      'end_minute', CAST(match_length AS BIGINT))))
"""


def _side_intervals(matches: DataFrame) -> Column:
    """The expression with the id type of the sheets (the wider one, if sides
    or line-ups and substitutions differ)."""
    kinds = set()
    for team in ("home_team_data", "away_team_data"):
        sheet = matches.schema[team].dataType
        kinds |= {sheet["lineup"].dataType.elementType.simpleString(), sheet["substitution1"].dataType["player_in"].dataType.simpleString()}
    kind = kinds.pop() if len(kinds) == 1 else "bigint"
    return F.expr(
        _SIDE_INTERVALS.format(
            id=kind,
            replaced=_STARTER.format(id=kind, end="coalesce(s.minute, match_length)"),
            whole=_STARTER.format(id=kind, end="match_length"),
        )
    )


_MATCH_SUBS = (
    "filter(array(" + ", ".join(f"{side}.{sub}" for side in ("home_team_data", "away_team_data") for sub in _SUBS)
    + "), s -> s IS NOT NULL)"
)


def presence_rows(matches: DataFrame, lengths: DataFrame) -> DataFrame:
    """Time-on-pitch intervals from match sheets joined to ``lengths``
    (match_id, match_length).

    Per side: every starter gets one interval per substitution that took
    them off (``filter`` of the match's substitutions on ``player_out``), to
    its minute or, if that is null, to the match length; if none did, one
    interval to the match length.  Every substitute gets one interval from
    their minute to the match length.

    Output: match_id, player_id (type of the sheets), competition, season,
    player_team, start_minute int, end_minute bigint.
    """
    sides = _side_rows(matches, None, F.expr(_MATCH_SUBS).alias("match_subs"), lengths=lengths)
    rows = sides.select(
        "match_id",
        "competition",
        "season",
        F.col("side.team").alias("player_team"),
        F.inline(_side_intervals(matches)),
    )
    return rows.select(
        "match_id", "player_id", "competition", "season", "player_team", "start_minute", "end_minute"
    )


def player_presence(
    matches: DataFrame, events: DataFrame | None = None, lengths: DataFrame | None = None
) -> DataFrame:
    """Time-on-pitch interval per player and match, closed at both ends.

    * Starter: from 0 to the minute of the substitution that took them off (to
      the match length if that minute is null), else to the match length.  A starter listed as replaced in several
      substitutions gets one interval per substitution.
    * Substitute: from the minute they came on to the match length (even if
      later replaced).

    The lookup "which substitution of this match took player p off" runs on
    the array of the match's (at most six) substitutions inside the row,
    equivalent to a left join on (match, player = player_out) without one.
    Match lengths come from ``events`` or, if known, from ``lengths``.

    Output: match_id, player_id, competition, season, player_team,
    start_minute int, end_minute bigint, minutes bigint (null where a
    substitute's minute is).
    """
    if lengths is None:
        if events is None:
            raise ValueError("give events or lengths")
        lengths = match_length(events)
    rows = presence_rows(matches, lengths.select("match_id", "match_length"))
    return rows.withColumn("minutes", F.col("end_minute") - F.col("start_minute"))


def presence_from_flat(lineups: DataFrame, substitutions: DataFrame, **skew) -> DataFrame:
    """``player_presence`` from flat tables: line-ups (as of ``lineup_rows``)
    and substitutions (as of ``substitution_rows``) without a bounded array per match.

    A left join on (match, player taken off) finds who was replaced.  One
    match, or rows without ids, may hold any share of the rows: see
    ``joins.skew_join``, which takes ``skew``.  Equal line-up rows give an
    interval each.

    Output: as ``player_presence``.
    """
    off = substitutions.select("match_id", F.col("player_out_id").alias("player_id"), "sub_minute")
    started = skew_join(lineups, off, ["match_id", "player_id"], "left", **skew)
    keys = ["match_id", "player_id", "competition", "season", "player_team"]
    end = F.coalesce("sub_minute", "match_length").cast("long").alias("end_minute")
    starters = started.select(*keys, "start_minute", end)
    came_on = substitutions.select(
        *keys, F.col("sub_minute").alias("start_minute"), F.col("match_length").cast("long").alias("end_minute")
    )
    rows = starters.unionByName(came_on)
    return rows.withColumn("minutes", F.col("end_minute") - F.col("start_minute"))


def minutes_per_player(presence: DataFrame) -> DataFrame:
    """Total minutes per player over all matches (partial aggregation first).

    Output: player_id, minutes bigint.
    """
    return presence.groupBy("player_id").agg(F.sum("minutes").alias("minutes"))
