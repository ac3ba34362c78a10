"""SQL oracles (DuckDB dialect) for the registered queries.

Each query is restated independently in SQL over the driver tables: the
fixture views are CTEs (``fb_*``, never shadowing the driver's own ``events``
view) and the operators are written the plain relational way -- distinct plus
left join for results, one aggregation per side plus union for passes, a left
join of lineups to substitutions for presence, a join with a ``BETWEEN``
condition for plus-minus -- so a mistake in the Spark formulation shows up as
a mismatch.

Type rules: sums are cast to BIGINT (DuckDB gives HUGEINT), ``row_number``
to INTEGER, ``ceil`` to BIGINT, calendar fields to INTEGER, to match Spark.
Ratios are rounded as decimals, the Spark operators by exact integer division.
"""

from __future__ import annotations

# --- fixture views -----------------------------------------------------------

_CTES: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, deps: list[str], sql: str) -> None:
    _CTES[name] = (deps, sql.strip())


# match number -> season, competition, home and away team; a shared team name
_PARTS = """{m} // 450 AS s, {m} % 450 % 5 AS ci, ({m} % 450 // 5) // 9 AS hi,
       (({m} % 450 // 5) // 9 + 1 + {m} % 450 // 5 % 9) % 10 AS ai"""


def _team(number: str) -> str:
    return f"CASE WHEN ci = 1 AND {number} = 0 THEN 'T0_0' ELSE 'T' || CAST(ci AS VARCHAR) || '_' || CAST({number} AS VARCHAR) END"


_SEASON = "CAST(2017 + s AS VARCHAR) || '-' || CAST(2018 + s AS VARCHAR)"

_cte(
    "fb_base",
    [],
    f"""
SELECT l_orderkey AS ok, l_partkey AS p, l_suppkey AS sk, l_linenumber AS ln,
       l_quantity AS q, l_linestatus AS ls,
       {_PARTS.format(m="(l_orderkey // 16)")},
       l_orderkey // 16 AS m,
       (l_partkey + l_linenumber) % 50 AS r
FROM lineitem
""",
)

_cte(
    "fb_events",
    ["fb_base"],
    f"""
SELECT m AS match_id,
       'L' || CAST(ci AS VARCHAR) AS competition,
       {_SEASON} AS season,
       {_team("hi")} AS home_team,
       {_team("ai")} AS away_team,
       CASE WHEN sk % 3 = 0 THEN {_team("hi")} ELSE {_team("ai")} END AS event_team,
       CASE WHEN r < 2 THEN 'Save attempt' WHEN r < 40 THEN 'Pass' ELSE 'Duel' END AS event,
       CASE WHEN r < 2 AND (ok + sk) % 2 = 0 THEN 'Goal'
            WHEN r < 40 AND q > 10 THEN 'Accurate'
            WHEN r < 40 THEN 'Not accurate' END AS tag,
       CASE WHEN ln = 7 THEN 'E1' WHEN ls = 'O' THEN '1H' ELSE '2H' END AS event_period,
       CAST((ok * 31 + ln * 397 + p * 7) % 2880 AS DOUBLE) AS event_time
FROM fb_base
""",
)

_cte(
    "fb_goals",
    ["fb_events"],
    """
SELECT match_id, competition, season, home_team, away_team,
       sum(CASE WHEN event_team = away_team THEN 1 ELSE 0 END) AS hg,
       sum(CASE WHEN event_team = home_team THEN 1 ELSE 0 END) AS ag
FROM fb_events
WHERE event = 'Save attempt' AND tag = 'Goal'
GROUP BY match_id, competition, season, home_team, away_team
""",
)

_cte(
    "fb_results",
    ["fb_events", "fb_goals"],
    """
SELECT a.match_id, a.competition, a.season, a.home_team, a.away_team,
       CAST(coalesce(g.hg, 0) AS BIGINT) AS home_goals,
       CAST(coalesce(g.ag, 0) AS BIGINT) AS away_goals
FROM (SELECT DISTINCT match_id, competition, season, home_team, away_team FROM fb_events) a
LEFT JOIN fb_goals g
  ON a.match_id = g.match_id AND a.competition = g.competition AND a.season = g.season
 AND a.home_team = g.home_team AND a.away_team = g.away_team
""",
)

_cte(
    "fb_team_rows",
    ["fb_results"],
    """
SELECT match_id, competition, season, home_team AS team,
       home_goals AS goals_scored, away_goals AS goals_conceded,
       CAST(home_goals > away_goals AS INTEGER) AS wins,
       CAST(home_goals = away_goals AS INTEGER) AS draws,
       CAST(home_goals < away_goals AS INTEGER) AS losses,
       1 AS games
FROM fb_results
UNION ALL
SELECT match_id, competition, season, away_team AS team,
       away_goals AS goals_scored, home_goals AS goals_conceded,
       CAST(away_goals > home_goals AS INTEGER) AS wins,
       CAST(away_goals = home_goals AS INTEGER) AS draws,
       CAST(away_goals < home_goals AS INTEGER) AS losses,
       1 AS games
FROM fb_results
""",
)

_cte(
    "fb_standings",
    ["fb_team_rows"],
    """
SELECT competition, season, team,
       CAST(sum(games) AS BIGINT) AS games,
       CAST(sum(wins) AS BIGINT) AS wins,
       CAST(sum(draws) AS BIGINT) AS draws,
       CAST(sum(losses) AS BIGINT) AS losses,
       CAST(sum(goals_scored) AS BIGINT) AS goals_scored,
       CAST(sum(goals_conceded) AS BIGINT) AS goals_conceded,
       CAST(sum(wins) * 3 + sum(draws) AS BIGINT) AS points
FROM fb_team_rows
GROUP BY competition, season, team
""",
)

_cte(
    "fb_totals",
    ["fb_standings"],
    """
SELECT competition, team,
       CAST(sum(games) AS BIGINT) AS pld,
       CAST(sum(wins) AS BIGINT) AS w,
       CAST(sum(draws) AS BIGINT) AS d,
       CAST(sum(losses) AS BIGINT) AS l,
       CAST(sum(goals_scored) AS BIGINT) AS gf,
       CAST(sum(goals_conceded) AS BIGINT) AS ga,
       CAST(sum(goals_scored) - sum(goals_conceded) AS BIGINT) AS gd,
       CAST(sum(points) AS BIGINT) AS pts
FROM fb_standings
GROUP BY competition, team
""",
)

_cte(
    "fb_pass_counts",
    ["fb_events"],
    """
SELECT match_id, home_team AS team, competition, season,
       CAST(sum(CASE WHEN tag = 'Accurate' THEN 1 ELSE 0 END) AS BIGINT) AS accurate_passes,
       CAST(count(*) AS BIGINT) AS total_passes
FROM fb_events
WHERE event = 'Pass' AND event_team = home_team
GROUP BY match_id, home_team, competition, season
UNION ALL
SELECT match_id, away_team AS team, competition, season,
       CAST(sum(CASE WHEN tag = 'Accurate' THEN 1 ELSE 0 END) AS BIGINT) AS accurate_passes,
       CAST(count(*) AS BIGINT) AS total_passes
FROM fb_events
WHERE event = 'Pass' AND event_team = away_team
GROUP BY match_id, away_team, competition, season
""",
)

# decimal rounding, half up: ties are exact at twelve digits
_ROUND2 = "round(CAST({x} AS DECIMAL(38, 12)), 2)"

_cte(
    "fb_ratios",
    ["fb_pass_counts"],
    f"""
SELECT competition, team,
       CAST({_ROUND2.format(x="CAST(sum(ratio) AS DOUBLE) / count(*)")} AS DOUBLE) AS pass_success_ratio
FROM (SELECT competition, team, {_ROUND2.format(x="100.0 * accurate_passes / total_passes")} AS ratio
      FROM fb_pass_counts) per_match
GROUP BY competition, team
""",
)

_cte(
    "fb_length",
    ["fb_events"],
    """
SELECT match_id, CAST(ceil(max(event_time) / 60 + 45) AS BIGINT) AS match_length
FROM fb_events
WHERE event_period = '2H'
GROUP BY match_id
""",
)

_cte(
    "fb_match_sides",
    [],
    f"""
SELECT m, s, ci, 'home' AS side, hi AS tn, s * 50 + ci * 10 + hi AS tno
FROM (SELECT m, {_PARTS.format(m="m")} FROM (SELECT DISTINCT o_orderkey // 16 AS m FROM orders) ids) home
UNION ALL
SELECT m, s, ci, 'away' AS side, ai AS tn, s * 50 + ci * 10 + ai AS tno
FROM (SELECT m, {_PARTS.format(m="m")} FROM (SELECT DISTINCT o_orderkey // 16 AS m FROM orders) ids) away
""",
)

_cte(
    "fb_sheet",
    ["fb_match_sides", "fb_length"],
    f"""
SELECT x.m AS match_id, x.m, x.side,
       'L' || CAST(x.ci AS VARCHAR) AS competition,
       {_SEASON} AS season,
       {_team("tn")} AS team,
       x.tno,
       l.match_length
FROM fb_match_sides x
JOIN fb_length l ON l.match_id = x.m
""",
)

_cte(
    "fb_subs",
    ["fb_sheet"],
    """
SELECT match_id,
       tno * 100 + 11 + k AS player_id,
       tno * 100 + 2 + (m + k * 3) % 10 AS player_out_id,
       competition, season, team AS player_team,
       CASE WHEN NOT (k = 2 AND m % 11 = 3) THEN CAST(46 + (m * 7 + k * 11) % 40 AS INTEGER) END AS sub_minute,
       match_length
FROM fb_sheet, range(1, 4) AS t(k)
WHERE NOT (k = 3 AND m % 3 = 0)
""",
)

_cte(
    "fb_lineup",
    ["fb_sheet"],
    """
SELECT match_id, competition, season, team AS player_team,
       tno * 100 + n AS player_id,
       match_length,
       0 AS start_minute
FROM fb_sheet, range(1, 12) AS t(n)
WHERE NOT (side = 'away' AND m % 97 = 5)
""",
)

_cte(
    "fb_presence",
    ["fb_lineup", "fb_subs"],
    """
SELECT lu.match_id, lu.player_id, lu.competition, lu.season, lu.player_team,
       lu.start_minute,
       CAST(coalesce(sb.sub_minute, lu.match_length) AS BIGINT) AS end_minute,
       CAST(coalesce(sb.sub_minute, lu.match_length) - lu.start_minute AS BIGINT) AS minutes
FROM fb_lineup lu
LEFT JOIN fb_subs sb ON lu.match_id = sb.match_id AND lu.player_id = sb.player_out_id
UNION ALL
SELECT match_id, player_id, competition, season, player_team,
       sub_minute AS start_minute,
       CAST(match_length AS BIGINT) AS end_minute,
       CAST(match_length - sub_minute AS BIGINT) AS minutes
FROM fb_subs
""",
)

_cte(
    "fb_players",
    ["fb_match_sides"],
    f"""
SELECT tno * 100 + n AS player_id,
       CASE WHEN n <> 9 THEN 'F' || CAST(n AS VARCHAR) END AS first_name,
       {_team("tn")} AS last_name,
       CASE WHEN n <> 13 THEN 'A' || CAST(n % 4 AS VARCHAR) END AS birth_area,
       CASE WHEN n IN (1, 12) THEN 'Goalkeeper'
            WHEN n BETWEEN 2 AND 5 THEN 'Defender'
            WHEN n BETWEEN 6 AND 9 OR n = 13 THEN 'Midfielder'
            ELSE 'Attacker' END AS role
FROM (SELECT DISTINCT ci, tn, tno FROM fb_match_sides) teams, range(1, 16) AS t(n)
""",
)

_cte(
    "fb_goal_minutes",
    ["fb_events"],
    """
SELECT match_id, competition, season,
       CAST(CASE WHEN event_period = '1H' THEN ceil(event_time / 60)
                 ELSE ceil(event_time / 60 + 45) END AS BIGINT) AS goal_minute,
       CASE WHEN event_team = home_team THEN away_team ELSE home_team END AS scoring_team
FROM fb_events
WHERE event = 'Save attempt' AND tag = 'Goal'
""",
)

_cte(
    "fb_plus_minus",
    ["fb_goal_minutes", "fb_presence"],
    """
SELECT pr.player_id,
       CAST(sum(CASE WHEN g.scoring_team = pr.player_team THEN 1 ELSE -1 END) AS BIGINT) AS plus_minus
FROM fb_goal_minutes g
JOIN fb_presence pr
  ON g.match_id = pr.match_id AND g.goal_minute BETWEEN pr.start_minute AND pr.end_minute
GROUP BY pr.player_id
""",
)

_cte(
    "fb_measurements",
    [],
    """
SELECT CAST(epoch_ms(l_shipdate) // 1000 AS BIGINT) + (l_partkey * 3607 + l_linenumber * 211) % 86400 AS time,
       CASE WHEN l_partkey % 37 <> 0 THEN l_quantity - 3 END AS temperature,
       round(l_discount * 100) AS humidity,
       round(l_tax * 100) AS wind_speed,
       CAST(l_partkey % 500 AS DOUBLE) AS power_tenants,
       CAST(l_suppkey % 90 AS DOUBLE) AS power_maintenance,
       CAST((l_partkey * 7 + l_linenumber) % 300 AS DOUBLE) AS power_solar_panels,
       CAST((l_orderkey + l_linenumber) % 120 AS DOUBLE) AS electricity_price
FROM lineitem
""",
)

_MEASURE_COLS = [
    "temperature",
    "humidity",
    "wind_speed",
    "power_tenants",
    "power_maintenance",
    "power_solar_panels",
    "electricity_price",
]

_cte(
    "fb_clean",
    ["fb_measurements"],
    "SELECT * FROM fb_measurements WHERE time IS NOT NULL AND "
    + " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in _MEASURE_COLS),
)

_cte(
    "fb_calendar",
    ["fb_clean"],
    """
SELECT *,
       CAST(month(make_timestamp(time * 1000000)) AS INTEGER) AS month,
       CAST(hour(make_timestamp(time * 1000000)) AS INTEGER) AS hour,
       dayname(make_timestamp(time * 1000000)) AS weekday
FROM fb_clean
""",
)

_cte(
    "fb_weekday",
    ["fb_clean"],
    """
SELECT *, dayname(make_timestamp(time * 1000000)) AS weekday
FROM fb_clean
WHERE temperature >= 0 AND humidity >= 0 AND wind_speed >= 0
""",
)


def with_views(body: str, *names: str) -> str:
    """``WITH <needed fixture CTEs> <body>``, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _CTES[name][0]:
            visit(dep)
        order.append(name)

    for name in names:
        visit(name)
    ctes = ",\n".join(f"{n} AS (\n{_CTES[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


_SIGNED_GD = "CASE WHEN gd >= 0 THEN '+' || CAST(gd AS VARCHAR) ELSE CAST(gd AS VARCHAR) END"

FOOTBALL: dict[str, str] = {
    "match_results": with_views("SELECT * FROM fb_results", "fb_results"),
    "team_match_rows": with_views("SELECT * FROM fb_team_rows", "fb_team_rows"),
    "season_standings": with_views("SELECT * FROM fb_standings", "fb_standings"),
    "league_table": with_views(
        f"""
SELECT competition,
       CAST(row_number() OVER (PARTITION BY competition ORDER BY pts DESC, gd DESC, gf DESC, team ASC) AS INTEGER) AS pos,
       team, pld, w, d, l, gf, ga, {_SIGNED_GD} AS gd, pts
FROM fb_totals
""",
        "fb_totals",
    ),
    "global_positions": with_views(
        """
SELECT row_number() OVER (ORDER BY pts DESC, gd DESC, gf DESC, team, competition, season) AS position, *
FROM (SELECT competition, season, team, games AS pld, wins AS w, draws AS d, losses AS l, goals_scored AS gf,
             goals_conceded AS ga, goals_scored - goals_conceded AS gd, points AS pts
      FROM fb_standings) totals
""",
        "fb_standings",
    ),
    "match_pass_counts": with_views("SELECT * FROM fb_pass_counts", "fb_pass_counts"),
    "pass_ratio_by_team": with_views("SELECT * FROM fb_ratios", "fb_ratios"),
    "lowest_pass_ratio": with_views(
        """
SELECT competition, team, pass_success_ratio
FROM (SELECT *, row_number() OVER (PARTITION BY competition ORDER BY pass_success_ratio ASC, team ASC) AS rn
      FROM fb_ratios) ranked
WHERE rn = 1
""",
        "fb_ratios",
    ),
    "best_teams": with_views(
        f"""
SELECT team, competition, pos, pld, w, d, l, gf, ga, {_SIGNED_GD} AS gd, pts,
       CAST({_ROUND2.format(x="CAST(pts AS DOUBLE) / pld")} AS DOUBLE) AS "avg",
       pass_ratio
FROM (SELECT t.*, r.pass_success_ratio AS pass_ratio,
             CAST(row_number() OVER (PARTITION BY t.competition ORDER BY t.pts DESC, t.gd DESC, t.gf DESC, t.team ASC) AS INTEGER) AS pos
      FROM fb_totals t
      LEFT JOIN fb_ratios r ON t.competition = r.competition AND t.team = r.team) ranked
WHERE pos <= 2
ORDER BY "avg" DESC, pts DESC, competition ASC, pos ASC
LIMIT 10
""",
        "fb_totals",
        "fb_ratios",
    ),
    "match_length": with_views("SELECT * FROM fb_length", "fb_length"),
    "substitution_rows": with_views(
        """
SELECT match_id, player_id, player_out_id, competition, season, player_team, sub_minute, match_length
FROM fb_subs
""",
        "fb_subs",
    ),
    "lineup_rows": with_views(
        """
SELECT match_id, competition, season, player_team, player_id, match_length, start_minute
FROM fb_lineup
""",
        "fb_lineup",
    ),
    "player_presence": with_views("SELECT * FROM fb_presence", "fb_presence"),
    "minutes_per_player": with_views(
        "SELECT player_id, CAST(sum(minutes) AS BIGINT) AS minutes FROM fb_presence GROUP BY player_id",
        "fb_presence",
    ),
    "most_minutes_by_role": with_views(
        """
SELECT role, player, birth_area, minutes
FROM (SELECT p.role, concat_ws(' ', p.first_name, p.last_name) AS player, p.birth_area, m.minutes,
             row_number() OVER (PARTITION BY p.role ORDER BY m.minutes DESC NULLS LAST, p.player_id ASC) AS rn
      FROM fb_players p
      LEFT JOIN (SELECT player_id, CAST(sum(minutes) AS BIGINT) AS minutes
                 FROM fb_presence GROUP BY player_id) m
        ON p.player_id = m.player_id) ranked
WHERE rn = 1
""",
        "fb_players",
        "fb_presence",
    ),
    "goal_minutes": with_views("SELECT * FROM fb_goal_minutes", "fb_goal_minutes"),
    "plus_minus": with_views("SELECT * FROM fb_plus_minus", "fb_plus_minus"),
    "top_plus_minus": with_views(
        """
SELECT concat_ws(' ', p.first_name, p.last_name) AS player, p.birth_area, p.role, pm.plus_minus
FROM fb_players p
JOIN fb_plus_minus pm ON p.player_id = pm.player_id
WHERE pm.plus_minus > 5
""",
        "fb_players",
        "fb_plus_minus",
    ),
}

ENERGY: dict[str, str] = {
    "clean_measurements": with_views("SELECT * FROM fb_clean", "fb_clean"),
    "calendar_labels": with_views("SELECT * FROM fb_calendar", "fb_calendar"),
    "nonnegative_rows": with_views("SELECT * FROM fb_weekday", "fb_weekday"),
    "split_rows": with_views(
        "SELECT *, CASE WHEN (time // 60) % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM fb_clean",
        "fb_clean",
    ),
    "label_index": with_views(
        """
SELECT month,
       CAST(row_number() OVER (ORDER BY n DESC, CAST(month AS VARCHAR) ASC) - 1 AS DOUBLE) AS label_index,
       n
FROM (SELECT month, count(*) AS n FROM fb_calendar GROUP BY month) counts
""",
        "fb_calendar",
    ),
}


def all_oracles() -> dict[str, str]:
    return {**FOOTBALL, **ENERGY}


# --- multinomial naive Bayes, stated in SQL ----------------------------------
# Label index: frequency descending, ties by label text, fitted on all rows.
# Test rows: (time div 60) % 5 = 0.  Classes are the labels present in the
# training part, in index order; the prediction is the position of the best
# class (first on ties), the probability a softmax of the class scores.
# Score of class c: log prior + sum_j x_j * log theta_cj, smoothing 1.

_cte(
    "fb_weather",
    ["fb_calendar"],
    "SELECT * FROM fb_calendar WHERE temperature >= 0 AND humidity >= 0 AND wind_speed >= 0",
)


def _bayes_views(label: str, rows: str) -> str:
    """Register the naive Bayes CTEs of one label; their name suffix."""
    nb = f"_{label}"
    _cte(
        f"nb_index{nb}",
        [rows],
        f"""
SELECT {label}, row_number() OVER (ORDER BY n DESC, CAST({label} AS VARCHAR) ASC) - 1 AS label_index
FROM (SELECT {label}, count(*) AS n FROM {rows} GROUP BY {label}) counts
""",
    )
    _cte(
        f"nb_rows{nb}",
        [rows, f"nb_index{nb}"],
        f"""
SELECT row_number() OVER () AS rid, w.time, w.{label}, w.temperature, w.humidity, w.wind_speed, i.label_index,
       (w.time // 60) % 5 = 0 AS is_test
FROM {rows} w JOIN nb_index{nb} i ON w.{label} = i.{label}
""",
    )
    _cte(
        f"nb_model{nb}",
        [f"nb_rows{nb}"],
        f"""
SELECT label_index AS class_index,
       row_number() OVER (ORDER BY label_index) - 1 AS pos,
       ln(n + 1.0) - ln(sum(n) OVER () + count(*) OVER ()) AS pi,
       ln(s0 + 1.0) - ln(s0 + s1 + s2 + 3.0) AS t0,
       ln(s1 + 1.0) - ln(s0 + s1 + s2 + 3.0) AS t1,
       ln(s2 + 1.0) - ln(s0 + s1 + s2 + 3.0) AS t2
FROM (SELECT label_index, count(*) AS n, sum(temperature) AS s0, sum(humidity) AS s1, sum(wind_speed) AS s2
      FROM nb_rows{nb} WHERE NOT is_test GROUP BY label_index) per_class
""",
    )
    _cte(
        f"nb_pred{nb}",
        [f"nb_rows{nb}", f"nb_model{nb}"],
        f"""
SELECT rid, any_value(label_index) AS label_index,
       any_value(time) AS time, any_value({label}) AS {label},
       any_value(temperature) AS temperature, any_value(humidity) AS humidity, any_value(wind_speed) AS wind_speed,
       min(pos) FILTER (WHERE raw = max_raw) AS prediction,
       sum(CASE WHEN pos = label_index THEN exp(raw - max_raw) END) / sum(exp(raw - max_raw)) AS true_prob
FROM (SELECT r.rid, r.label_index, r.time, r.{label}, r.temperature, r.humidity, r.wind_speed,
             m.pos, raw, max(raw) OVER (PARTITION BY r.rid) AS max_raw
      FROM nb_rows{nb} r, nb_model{nb} m,
           LATERAL (SELECT m.pi + (m.t0 * r.temperature + m.t1 * r.humidity + m.t2 * r.wind_speed) AS raw) s
      WHERE r.is_test) scored
GROUP BY rid
""",
    )
    return nb


_bayes_views("weekday", "fb_weekday")
_bayes_views("month", "fb_weather")
_bayes_views("hour", "fb_weather")


_PERCENT = "((2 * count(*) FILTER (WHERE {cond}) * 10000 + count(*)) // (2 * count(*))) / 100"


def _percents(label_expr: str, pred_expr: str, cycle: int) -> str:
    d = f"abs(({label_expr}) - ({pred_expr}))"
    return f"""{_PERCENT.format(cond=f"{d} = 0")} AS correct,
       {_PERCENT.format(cond=f"{d} <= 1 OR {d} = {cycle - 1}")} AS within_one,
       {_PERCENT.format(cond=f"{d} <= 2 OR {d} >= {cycle - 2}")} AS within_two"""


def _nb_report(label: str, label_expr: str, pred_expr: str, cycle: int, more: str = "") -> str:
    return f"""
SELECT 'NaiveBayes' AS classifier, 'temperature humidity wind_speed' AS input, '{label}' AS label,
       {_percents(label_expr, pred_expr, cycle)},
       round(avg(coalesce(true_prob, 0.0)), 4) AS avg_prob{more}
FROM nb_pred_{label}
"""


_DAYS = "['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']"


def _calendar(label: str, index: str, col: str) -> str:
    """Calendar number of the label with an index."""
    value = f"list_position({_DAYS}, x.weekday) - 1" if label == "weekday" else f"x.{label}"
    return f"(SELECT {value} FROM {index} x WHERE x.label_index = {col})"


ENERGY["nb_predictions"] = with_views(
    """
SELECT time, temperature, humidity, wind_speed, weekday,
       CAST(label_index AS DOUBLE) AS label_index,
       CAST(prediction AS DOUBLE) AS prediction,
       round(coalesce(true_prob, 0.0), 6) AS true_prob
FROM nb_pred_weekday
""",
    "nb_pred_weekday",
)
ENERGY["nb_report"] = with_views(_nb_report("weekday", "label_index", "prediction", 24), "nb_pred_weekday")
ENERGY["nb_calendar_report"] = with_views(
    _nb_report(
        "weekday",
        *(_calendar("weekday", "nb_index_weekday", f"nb_pred_weekday.{c}") for c in ("label_index", "prediction")),
        7,
    ),
    "nb_pred_weekday",
    "nb_index_weekday",
)
ENERGY["nb_month_hour_reports"] = with_views(
    "UNION ALL".join(
        _nb_report(
            label,
            *(
                c if order == "frequency" else _calendar(label, f"nb_index_{label}", f"nb_pred_{label}.{c}")
                for c in ("label_index", "prediction")
            ),
            cycle,
            f", '{order}' AS distance",
        )
        for label, cycle in (("month", 12), ("hour", 24))
        for order in ("frequency", "calendar")
    ),
    "nb_pred_month",
    "nb_pred_hour",
)

# --- arithmetic predictions, forest rows --------------------------------------

for _label in ("month", "hour", "weekday"):
    _cte(
        f"cy_index_{_label}",
        ["fb_calendar"],
        f"""
SELECT {_label}, row_number() OVER (ORDER BY n DESC, CAST({_label} AS VARCHAR) ASC) - 1 AS label_index
FROM (SELECT {_label}, count(*) AS n FROM fb_calendar GROUP BY {_label}) counts
""",
    )
    _cte(
        f"cy_pred_{_label}",
        [f"cy_index_{_label}"],
        f"""
SELECT i.label_index, ((i.label_index + (c.time // 60) % 7 - 3) % k.n + k.n) % k.n AS prediction, k.n AS n_classes
FROM fb_calendar c JOIN cy_index_{_label} i ON c.{_label} = i.{_label},
     (SELECT count(*) AS n FROM cy_index_{_label}) k
""",
    )

ENERGY["cyclic_accuracy"] = with_views(
    "UNION ALL".join(
        f"""
SELECT '{label}' AS label, '{order}' AS distance, {cycle} AS cycle, count(*) AS n_test,
       {_percents(*(c if order == "frequency" else _calendar(label, f"cy_index_{label}", f"cy_pred_{label}.{c}")
                    for c in ("label_index", "prediction")), cycle)},
       round(1.0::DOUBLE / any_value(n_classes), 4) AS avg_prob
FROM cy_pred_{label}
"""
        for label, cycle in (("month", 12), ("hour", 24), ("weekday", 7))
        for order in ("frequency", "calendar")
    ),
    "cy_pred_month",
    "cy_pred_hour",
    "cy_pred_weekday",
)
ENERGY["rf_scored_rows"] = with_views(
    """
SELECT c.time, c.month, CAST(i.label_index AS DOUBLE) AS label_index,
       CAST((SELECT count(*) FROM cy_index_month) AS INTEGER) AS n_classes,
       1.0::DOUBLE AS prob_sum, true AS is_most_probable
FROM fb_calendar c JOIN cy_index_month i ON c.month = i.month
WHERE (c.time // 60) % 5 = 0
""",
    "fb_calendar",
    "cy_index_month",
)


# --- random forests, stated in SQL --------------------------------------------
# Bins: quantiles of a histogram of 4096 equal cells between the least and the
# greatest train value.  Bags: four hex digits of md5(row key : seed : tree div
# 8) against the Poisson distribution.  Each node looks at the features with
# the smallest md5(seed : tree : node : feature).  Cuts: all (node, feature,
# bin) against all label weights of the node; the greatest sum of squares over
# sum on both sides wins, then the first feature and bin.  Votes: a leaf's
# label weights in units of 2^-40, rounded down, summed over trees.

#: 65536 times the Poisson distribution function with mean 1, rounded down.
_POISSON = [24109, 48218, 60273, 64291, 65296, 65497, 65530, 65535]
_SEVEN = [
    "temperature", "humidity", "wind_speed", "power_tenants", "power_maintenance", "power_solar_panels", "electricity_price",
]


def _forest_views(
    name: str, rows: str, features: list[str], label: str, key: list[str], trees: int = 8, depth: int = 5, subset: int = 0, bagged: bool = True
) -> str:
    """Register the CTEs of one forest; the name of its predictions, a row a
    test row: rid, columns of the rows, label_index, prediction, p."""
    looked = subset or next(m for m in range(1, 10) if m * m >= len(features))
    column = lambda template: ", ".join(template.format(i=i, f=f) for i, f in enumerate(features))
    digests = ", ".join(f"md5({' || '.join(['concat_ws(' + repr('|') + ', ' + ', '.join(key) + ')', repr(f':1:{t}')])})" for t in range(-(-trees // 8)))
    _cte(f"{name}_index", [rows], f"""
SELECT {label}, row_number() OVER (ORDER BY n DESC, CAST({label} AS VARCHAR) ASC) - 1 AS label_index
FROM (SELECT {label}, count(*) AS n FROM {rows} GROUP BY {label}) counts
""")
    _cte(f"{name}_rows", [rows, f"{name}_index"], f"""
SELECT row_number() OVER () AS rid, r.*, i.label_index, (r.time // 60) % 5 = 0 AS is_test, [{digests}] AS digests
FROM {rows} r JOIN {name}_index i ON r.{label} = i.{label}
""")
    _cte(f"{name}_ends", [f"{name}_rows"], "UNION ALL".join(f"""
SELECT {i} AS feature, min({f}) AS low, max({f}) AS high FROM {name}_rows WHERE NOT is_test
""" for i, f in enumerate(features)))
    _cte(f"{name}_cells", [f"{name}_rows", f"{name}_ends"], f"""
SELECT rid, is_test, feature, CASE WHEN high > low
    THEN greatest(0, least(4095, floor((x - low) / (high - low) * 4096.0::DOUBLE)))::BIGINT ELSE 0 END AS cell
FROM (SELECT rid, is_test, unnest([{column("{i}")}]) AS feature, unnest([{column("{f}")}]) AS x FROM {name}_rows) long
JOIN {name}_ends USING (feature)
""")
    _cte(f"{name}_grid", [f"{name}_cells"], f"""
SELECT feature, cell, coalesce(sum(n) OVER (PARTITION BY feature ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    * 32 // sum(n) OVER (PARTITION BY feature) AS bin
FROM (SELECT f.feature, c.cell, coalesce(k.n, 0) AS n
      FROM range(0, {len(features)}) AS f(feature) CROSS JOIN range(0, 4096) AS c(cell)
      LEFT JOIN (SELECT feature, cell, count(*) AS n FROM {name}_cells WHERE NOT is_test GROUP BY feature, cell) k
        ON k.feature = f.feature AND k.cell = c.cell) counts
""")
    _cte(f"{name}_bins", [f"{name}_cells", f"{name}_grid"], f"""
SELECT rid, feature, bin FROM {name}_cells JOIN {name}_grid USING (feature, cell)
""")
    drawn = "CAST('0x' || substr(digests[t.tree // 8 + 1], 1 + 4 * (t.tree % 8)::INT, 4) AS INTEGER)"
    weight = " + ".join(f"({drawn} >= {x})::INT" for x in _POISSON) if bagged else "1"
    _cte(f"{name}_at0", [f"{name}_rows"], f"""
SELECT rid, is_test, label_index, t.tree, {weight} AS w, 1 AS node FROM {name}_rows CROSS JOIN range(0, {trees}) AS t(tree)
""")
    for d in range(depth):
        _cte(f"{name}_sums{d}", [f"{name}_at{d}", f"{name}_bins"], f"""
SELECT tree, node, feature, bin, label_index, sum(w) AS w
FROM {name}_at{d} JOIN (
    SELECT tree, node, feature
    FROM (SELECT DISTINCT tree, node FROM {name}_at{d} WHERE node >= {1 << d}) nodes CROSS JOIN range(0, {len(features)}) AS f(feature)
    QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY md5('1:' || tree || ':' || node || ':' || feature)) <= {looked}
) looked USING (tree, node) JOIN {name}_bins USING (rid, feature)
WHERE NOT is_test AND w > 0
GROUP BY tree, node, feature, bin, label_index
""")
        _cte(f"{name}_cut{d}", [f"{name}_sums{d}"], f"""
SELECT tree, node, feature, bin
FROM (SELECT tree, node, feature, bin, sum(l) AS nl, sum(a) AS na, sum(l * l) AS sl, sum((a - l) * (a - l)) AS sr, sum(a * a) AS sa
      FROM (SELECT c.tree, c.node, c.feature, c.bin, s.label_index, sum(s.w) AS a,
                   coalesce(sum(s.w) FILTER (s.bin <= c.bin), 0) AS l
            FROM (SELECT DISTINCT tree, node, feature, bin FROM {name}_sums{d}) c JOIN {name}_sums{d} s USING (tree, node, feature)
            GROUP BY c.tree, c.node, c.feature, c.bin, s.label_index) sides
      GROUP BY tree, node, feature, bin) weighed
WHERE nl < na AND sl::DOUBLE / nl::DOUBLE + sr::DOUBLE / (na - nl)::DOUBLE > sa::DOUBLE / na::DOUBLE
QUALIFY row_number() OVER (
    PARTITION BY tree, node ORDER BY sl::DOUBLE / nl::DOUBLE + sr::DOUBLE / (na - nl)::DOUBLE DESC, feature, bin) = 1
""")
        _cte(f"{name}_at{d + 1}", [f"{name}_at{d}", f"{name}_cut{d}", f"{name}_bins"], f"""
SELECT a.rid, a.is_test, a.label_index, a.tree, a.w,
       CASE WHEN c.feature IS NULL THEN a.node ELSE 2 * a.node + (b.bin > c.bin)::INT END AS node
FROM {name}_at{d} a LEFT JOIN {name}_cut{d} c ON c.tree = a.tree AND c.node = a.node
LEFT JOIN {name}_bins b ON b.rid = a.rid AND b.feature = c.feature
""")
    _cte(f"{name}_votes", [f"{name}_at{depth}"], f"""
SELECT tree, node, label_index, (w::HUGEINT * 1099511627776 // sum(w) OVER (PARTITION BY tree, node))::BIGINT AS votes
FROM (SELECT tree, node, label_index, sum(w) AS w FROM {name}_at{depth} WHERE NOT is_test GROUP BY tree, node, label_index) leaves
WHERE w > 0
""")
    _cte(f"{name}_pred", [f"{name}_rows", f"{name}_at{depth}", f"{name}_votes"], f"""
SELECT r.*, p.prediction, p.true_prob
FROM {name}_rows r JOIN (
    SELECT rid, arg_max(label, (votes, -label)) AS prediction,
           coalesce(sum(votes) FILTER (label = label_index), 0)::DOUBLE / sum(votes)::DOUBLE AS true_prob
    FROM (SELECT a.rid, a.label_index, v.label_index AS label, sum(v.votes)::BIGINT AS votes
          FROM {name}_at{depth} a JOIN {name}_votes v USING (tree, node) WHERE a.is_test GROUP BY a.rid, a.label_index, v.label_index) summed
    GROUP BY rid) p USING (rid)
""")
    return f"{name}_pred"


def _forest_rows(pred: str, *columns: str) -> str:
    return f"""
SELECT {", ".join(columns)}, CAST(label_index AS DOUBLE) AS label_index, CAST(prediction AS DOUBLE) AS prediction,
       round(true_prob, 6) AS true_prob
FROM {pred}
"""


def _forest_report(pred: str, features: list[str], label: str, cycle: int) -> str:
    return f"""
SELECT 'RandomForest' AS classifier, '{" ".join(features)}' AS input, '{label}' AS label,
       {_percents("label_index", "prediction", cycle)}, round(avg(true_prob), 4) AS avg_prob
FROM {pred}
"""


_WEATHER, _POWER = _SEVEN[:3], _SEVEN[3:6]
_pred = _forest_views("rf_month", "fb_calendar", _SEVEN, "month", [*_SEVEN, "r.month", "time"])
ENERGY["rf_predictions"] = with_views(_forest_rows(_pred, "time", "month"), _pred)
_pred = _forest_views(
    "rf_tree", "fb_calendar", _WEATHER, "month", [*_WEATHER, "r.month", "time"], trees=1, depth=3, subset=3, bagged=False
)
ENERGY["tree_predictions"] = with_views(_forest_rows(_pred, "time", *_WEATHER, "month"), _pred)
_reports, _used = [], []
for _number, (_features, _label, _cycle) in enumerate([
    (_SEVEN, "month", 12), (_WEATHER, "month", 12), (_POWER, "month", 12), (_SEVEN, "hour", 24), (_POWER, "hour", 24), (_WEATHER, "hour", 24),
]):
    _key = [*_SEVEN, *("r.month" if c == _label == "month" else "r.hour" if c == _label else c for c in ("month", "hour")), "time"]
    _used.append(_forest_views(f"rf_run{_number}", "fb_calendar", _features, _label, _key))
    _reports.append(_forest_report(_used[-1], _features, _label, _cycle))
ENERGY["rf_experiments"] = with_views("UNION ALL".join(_reports), *_used)
_pred = _forest_views("rf_weekday", "fb_weekday", _WEATHER, "weekday", [*_WEATHER, "r.weekday", "time"])
ENERGY["model_comparison"] = with_views(
    _nb_report("weekday", "label_index", "prediction", 24) + "UNION ALL" + _forest_report(_pred, _WEATHER, "weekday", 24),
    "nb_pred_weekday", _pred,
)

# --- splits, many labels, periods -----------------------------------------------

ENERGY["random_split"] = with_views(
    f"""
SELECT * EXCLUDE (place), CASE WHEN place <= count(*) OVER () * 8 // 10 THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', time, {", ".join(_SEVEN)}) || ':1')) AS place FROM fb_clean) placed
""",
    "fb_clean",
)
ENERGY["part_label_index"] = """
SELECT l_orderkey, l_linenumber, l_partkey, label_index
FROM lineitem JOIN (
    SELECT l_partkey, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS DOUBLE) AS label_index
    FROM lineitem GROUP BY l_partkey) parts USING (l_partkey)
"""
ENERGY["period_measurements"] = with_views(
    """
SELECT period_id, period_start, period_end, count(*) AS n, CAST(sum(power_tenants) AS BIGINT) AS power, max(electricity_price) AS top_price
FROM (SELECT o_orderkey AS period_id, start AS period_start,
             start + CASE WHEN o_orderkey % 499 = 0 THEN 45 * 86400 ELSE 600 * (1 + o_custkey % 24) END AS period_end
      FROM (SELECT *, CAST(epoch_ms(o_orderdate) // 1000 AS BIGINT) + o_orderkey * 7919 % 86400 AS start FROM orders) started) periods
JOIN fb_clean ON time BETWEEN period_start AND period_end
GROUP BY period_id, period_start, period_end
""",
    "fb_clean",
)
