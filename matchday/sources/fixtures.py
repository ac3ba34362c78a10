"""Fixture views: football and measurement tables derived from the driver's
TPC-H-style tables, so every query reads the given data and grows with it.

The mapping uses integer arithmetic only, so Spark and the DuckDB oracle build
identical rows (the SQL form lives in ``matchday.plans.oracle``).

* matches: 16 orders each, so their number grows with the tables.  A season
  has 450: 5 competitions x 10 teams, every ordered pair once.  Match number
  ``m``: season ``s = m div 450``; of the rest ``w = m % 450``, competition
  ``ci = w % 5``, pair ``w div 5``: home team ``hi = pair div 9``, away team
  ``ai = (hi + 1 + pair % 9) % 10``.
* team 0 of competition 1 bears the name of team 0 of competition 0.
* events: one per ``lineitem`` row, ``match_id = l_orderkey div 16``.
* match sheets: one per distinct ``o_orderkey div 16``, nested; the second
  substitution of every 11th match has no minute.
* players: 15 per team and season (number 15 never plays).
* measurements: one per ``lineitem`` row, Unix seconds plus seven doubles.

The views are written as layered SQL expressions (``selectExpr``): each layer
is one call into the JVM, where building the same columns one Column object
at a time costs thousands of driver round trips per query.  Team and
competition names are looked up by index in constant arrays instead of being
concatenated per row, which keeps pushed-down filters on them cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchday.sources.tables import read_table

# Fixed values of the fixture design.
ORDERS_PER_MATCH = 16
MATCHES_PER_SEASON = 450
TEAMS_PER_COMPETITION = 10
N_COMPETITIONS = 5
FIRST_YEAR = 2017
PLAYERS_PER_TEAM = 15
ROLE_BY_NUMBER = {
    1: "Goalkeeper",
    12: "Goalkeeper",
    2: "Defender",
    3: "Defender",
    4: "Defender",
    5: "Defender",
    6: "Midfielder",
    7: "Midfielder",
    8: "Midfielder",
    9: "Midfielder",
    13: "Midfielder",
    10: "Attacker",
    11: "Attacker",
    14: "Attacker",
    15: "Attacker",
}


def _sql_array(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


# names by rule: T<competition>_<team number>, L<competition>; one name is shared
_TEAMS = _sql_array(
    [
        "T0_0" if (c, t) == (1, 0) else f"T{c}_{t}"
        for c in range(N_COMPETITIONS)
        for t in range(TEAMS_PER_COMPETITION)
    ]
)
_COMPETITIONS = _sql_array([f"L{c}" for c in range(N_COMPETITIONS)])


def _team_name(ci: str, number: str) -> str:
    return f"element_at({_TEAMS}, CAST({ci} * {TEAMS_PER_COMPETITION} + {number} + 1 AS INT))"


def _competition_name(ci: str) -> str:
    return f"element_at({_COMPETITIONS}, CAST({ci} + 1 AS INT))"


_PAIR = f"((m % {MATCHES_PER_SEASON}) div {N_COMPETITIONS})"
_MATCH_PARTS = [
    f"m div {MATCHES_PER_SEASON} AS s",
    f"m % {MATCHES_PER_SEASON} % {N_COMPETITIONS} AS ci",
    f"{_PAIR} div 9 AS hi",
    f"({_PAIR} div 9 + 1 + {_PAIR} % 9) % 10 AS ai",
]
_SEASON = f"concat(CAST({FIRST_YEAR} + s AS STRING), '-', CAST({FIRST_YEAR} + 1 + s AS STRING))"
_TEAM_NUMBER = f"(s * {N_COMPETITIONS * TEAMS_PER_COMPETITION} + ci * {TEAMS_PER_COMPETITION} + {{}})"


def events_view(spark: SparkSession, base: str) -> DataFrame:
    """Match events (schema ``matchday.schemas.EVENTS``) from ``lineitem``."""
    numbered = read_table(spark, base, "lineitem").selectExpr(
        f"l_orderkey div {ORDERS_PER_MATCH} AS m",
        "(l_partkey + l_linenumber) % 50 AS r",
        "(l_orderkey + l_suppkey) % 2 = 0 AS even",
        "l_suppkey % 3 = 0 AS home_side",
        "l_quantity > 10 AS accurate",
        "CASE WHEN l_linenumber = 7 THEN 'E1' WHEN l_linestatus = 'O' THEN '1H' ELSE '2H' END AS event_period",
        "CAST((l_orderkey * 31 + l_linenumber * 397 + l_partkey * 7) % 2880 AS DOUBLE) AS event_time",
    )
    keep = ["r", "even", "home_side", "accurate", "event_period", "event_time"]
    parts = numbered.selectExpr("m", *_MATCH_PARTS, *keep)
    named = parts.selectExpr(
        "m AS match_id",
        f"{_competition_name('ci')} AS competition",
        f"{_SEASON} AS season",
        f"{_team_name('ci', 'hi')} AS home_team",
        f"{_team_name('ci', 'ai')} AS away_team",
        *keep,
    )
    tag = (
        "CASE WHEN r < 2 AND even THEN 'Goal' WHEN r < 40 AND accurate THEN 'Accurate' "
        "WHEN r < 40 THEN 'Not accurate' END"
    )
    return named.selectExpr(
        "match_id",
        "competition",
        "season",
        "home_team",
        "away_team",
        "CASE WHEN home_side THEN home_team ELSE away_team END AS event_team",
        "CASE WHEN r < 2 THEN 'Save attempt' WHEN r < 40 THEN 'Pass' ELSE 'Duel' END AS event",
        f"CASE WHEN r < 40 THEN array({tag}) END AS tags",
        "event_period",
        "event_time",
    )


def match_numbers(spark: SparkSession, base: str) -> DataFrame:
    """Distinct match numbers with their season, competition and team numbers; pass
    the same DataFrame to ``matches_view`` and ``players_view`` when a query
    needs both, so the plan reads ``orders`` once."""
    orders = read_table(spark, base, "orders")
    numbers = orders.selectExpr(f"o_orderkey div {ORDERS_PER_MATCH} AS m").distinct()
    return numbers.selectExpr("m", *_MATCH_PARTS)


def _sheet(tno: str, team_number: str, lineup_null: str) -> str:
    def sub(k: int) -> str:
        minute = f"CAST(46 + (m * 7 + {k * 11}) % 40 AS INT)"
        if k == 2:
            minute = f"CASE WHEN m % 11 != 3 THEN {minute} END"
        return (
            f"named_struct('player_in', {tno} * 100 + 11 + {k}, "
            f"'player_out', {tno} * 100 + 2 + (m + {k * 3}) % 10, "
            f"'minute', {minute})"
        )

    lineup = f"transform(sequence(1, 11), n -> {tno} * 100 + n)"
    return (
        f"named_struct('team', {_team_name('ci', team_number)}, "
        f"'lineup', CASE WHEN NOT ({lineup_null}) THEN {lineup} END, "
        f"'substitution1', {sub(1)}, "
        f"'substitution2', {sub(2)}, "
        f"'substitution3', CASE WHEN m % 3 != 0 THEN {sub(3)} END)"
    )


def matches_view(spark: SparkSession, base: str, numbers: DataFrame | None = None) -> DataFrame:
    """Nested match sheets (schema ``matchday.schemas.MATCHES``) from ``orders``."""
    numbers = numbers if numbers is not None else match_numbers(spark, base)
    return numbers.selectExpr(
        "m AS match_id",
        f"{_competition_name('ci')} AS competition",
        f"{_SEASON} AS season",
        f"{_sheet(_TEAM_NUMBER.format('hi'), 'hi', 'false')} AS home_team_data",
        f"{_sheet(_TEAM_NUMBER.format('ai'), 'ai', 'm % 97 = 5')} AS away_team_data",
    )


def players_view(spark: SparkSession, base: str, numbers: DataFrame | None = None) -> DataFrame:
    """Players (schema ``matchday.schemas.PLAYERS``): 15 per team and season
    that appears in the matches view."""
    numbers = numbers if numbers is not None else match_numbers(spark, base)
    teams = numbers.selectExpr("s", "ci", "explode(array(hi, ai)) AS tn").distinct()
    role = "CASE " + " ".join(f"WHEN n = {k} THEN '{v}'" for k, v in ROLE_BY_NUMBER.items()) + " END"
    return teams.selectExpr("s", "ci", "tn", f"explode(sequence(1, {PLAYERS_PER_TEAM})) AS n").selectExpr(
        f"{_TEAM_NUMBER.format('tn')} * 100 + n AS player_id",
        "CASE WHEN n != 9 THEN concat('F', CAST(n AS STRING)) END AS first_name",
        f"{_team_name('ci', 'tn')} AS last_name",
        "CASE WHEN n != 13 THEN concat('A', CAST(n % 4 AS STRING)) END AS birth_area",
        f"{role} AS role",
    )


def measurements_view(spark: SparkSession, base: str) -> DataFrame:
    """Minute measurements (schema ``matchday.schemas.MEASUREMENTS``) from ``lineitem``.

    Temperature is null for every 37th part and negative for small quantities,
    so cleaning and the non-negative guard have work to do.
    """
    return read_table(spark, base, "lineitem").selectExpr(
        "unix_timestamp(l_shipdate) + (l_partkey * 3607 + l_linenumber * 211) % 86400 AS time",
        "CASE WHEN l_partkey % 37 != 0 THEN l_quantity - 3 END AS temperature",
        "round(l_discount * 100) AS humidity",
        "round(l_tax * 100) AS wind_speed",
        "CAST(l_partkey % 500 AS DOUBLE) AS power_tenants",
        "CAST(l_suppkey % 90 AS DOUBLE) AS power_maintenance",
        "CAST((l_partkey * 7 + l_linenumber) % 300 AS DOUBLE) AS power_solar_panels",
        "CAST((l_orderkey + l_linenumber) % 120 AS DOUBLE) AS electricity_price",
    )


def periods_view(spark: SparkSession, base: str) -> DataFrame:
    """Overlapping periods (period_id, period_start, period_end in seconds)
    from ``orders``: ten minutes to four hours, every 499th one 45 days."""
    return read_table(spark, base, "orders").selectExpr(
        "o_orderkey AS period_id",
        "unix_timestamp(o_orderdate) + o_orderkey * 7919 % 86400 AS period_start",
        "unix_timestamp(o_orderdate) + o_orderkey * 7919 % 86400"
        " + CASE WHEN o_orderkey % 499 = 0 THEN 45 * 86400 ELSE 600 * (1 + o_custkey % 24) END AS period_end",
    )
