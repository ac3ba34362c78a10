"""Match length, sheets to rows, presence, minutes, plus-minus."""

from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from helpers import events, goal, matches, players, rows_of, sheet, sub
from matchday import operators as op
from matchday.plans import football as fb


def _sheets(spark):
    return matches(
        spark,
        [
            # substitute 4 later replaced by 5; away starter 12 listed twice as replaced
            (1, "C", sheet("H", [1, 2, 3], (sub(4, 2, 60), sub(5, 4, 80), None)),
             sheet("A", [11, 12], (sub(13, 12, 50), sub(14, 12, 70), None))),
            # empty and null lineups, a substitution of a player not in the lineup
            (2, "C", sheet("H2", [], (sub(21, 99, 30), None, None)), sheet("A2", None)),
            # no second-half event: dropped
            (3, "C", sheet("H3", [31]), sheet("A3", [41])),
        ],
    )


def _events(spark):
    return events(
        spark,
        [
            (1, "C", "H", "A", "H", "Pass", None, "2H", 2700),  # length ceil(45 + 45) = 90
            (1, "C", "H", "A", "H", "Pass", None, "1H", 2900),  # first half events do not count
            (2, "C", "H2", "A2", "H2", "Pass", None, "2H", 1),  # length ceil(45.02) = 46
            (3, "C", "H3", "A3", "H3", "Pass", None, "1H", 10),
        ],
    )


def test_match_length(spark):
    assert rows_of(op.match_length(_events(spark))) == [(1, 90), (2, 46)]


def test_substitution_and_lineup_rows(spark):
    subs = op.substitution_rows(_sheets(spark), _events(spark))
    assert rows_of(subs, "match_id", "player_id", "player_out_id", "player_team", "sub_minute", "match_length") == [
        (1, 4, 2, "H", 60, 90),
        (1, 5, 4, "H", 80, 90),
        (1, 13, 12, "A", 50, 90),
        (1, 14, 12, "A", 70, 90),
        (2, 21, 99, "H2", 30, 46),
    ]
    lineup = op.lineup_rows(_sheets(spark), _events(spark))
    assert rows_of(lineup, "match_id", "player_id", "player_team", "start_minute") == [
        (1, 1, "H", 0),
        (1, 2, "H", 0),
        (1, 3, "H", 0),
        (1, 11, "A", 0),
        (1, 12, "A", 0),
    ]


def test_player_presence_intervals(spark):
    pres = op.player_presence(_sheets(spark), _events(spark))
    assert rows_of(pres, "match_id", "player_id", "player_team", "start_minute", "end_minute", "minutes") == [
        (1, 1, "H", 0, 90, 90),
        (1, 2, "H", 0, 60, 60),
        (1, 3, "H", 0, 90, 90),
        (1, 4, "H", 60, 90, 30),  # substitute keeps the interval to the end
        (1, 5, "H", 80, 90, 10),
        (1, 11, "A", 0, 90, 90),
        (1, 12, "A", 0, 50, 50),  # listed twice as replaced: two intervals
        (1, 12, "A", 0, 70, 70),
        (1, 13, "A", 50, 90, 40),
        (1, 14, "A", 70, 90, 20),
        (2, 21, "H2", 30, 46, 16),
    ]
    assert dict(rows_of(op.minutes_per_player(pres)))[12] == 120


def test_goal_minutes(spark):
    ev = events(
        spark,
        [
            goal(1, "H", "A", "A", "1H", 600),  # 10
            goal(1, "H", "A", "A", "1H", 2760),  # 46: first-half stoppage time
            goal(1, "H", "A", "H", "2H", 61),  # ceil(46.02) = 47
            goal(1, "H", "A", "H", "E1", 30),  # extra time counts as second half: 46
            goal(1, "H", "A", None, "1H", 60),  # unknown saving side -> home scores
        ],
    )
    assert rows_of(op.goal_minutes(ev), "goal_minute", "scoring_team") == [
        (1, "H"),
        (10, "H"),
        (46, "A"),
        (46, "H"),
        (47, "A"),
    ]


def test_plus_minus_interval_join(spark):
    ev = _events(spark).unionByName(
        events(
            spark,
            [
                goal(1, "H", "A", "A", "2H", 900),  # H scores at 60: the substitution minute
                goal(1, "H", "A", "A", "2H", 900),  # again at 60
                goal(1, "H", "A", "H", "2H", 2400),  # A scores at 85
            ],
        )
    )
    pres = op.player_presence(_sheets(spark), ev)
    pm = dict(rows_of(op.plus_minus(op.goal_minutes(ev), pres)))
    assert pm == {1: 1, 2: 2, 3: 1, 4: 1, 5: -1, 11: -1, 12: -2, 13: -1, 14: 1}


def _players(spark):
    return players(
        spark,
        [
            (1, "Ann", "One", "X", "Goalkeeper"),
            (2, None, "Two", "Y", "Defender"),  # null first name: skipped in the name
            (3, "Cid", "Three", None, "Defender"),
            (4, "Dan", "Four", "Z", "Attacker"),  # never plays: role keeps one row
            (5, "Eve", "Five", "W", "Midfielder"),
        ],
    )


def test_most_minutes_by_role(spark):
    pres = spark.createDataFrame(
        [(1, 1, 90), (1, 2, 60), (2, 2, 30), (1, 3, 90), (1, 5, 10)],
        "match_id int, player_id int, minutes bigint",
    )
    out = op.most_minutes_by_role(pres, _players(spark))
    assert [tuple(r) for r in out.collect()] == [
        ("Defender", "Two", "Y", 90),  # 60 + 30 ties 90: lowest id wins
        ("Goalkeeper", "Ann One", "X", 90),
        ("Midfielder", "Eve Five", "W", 10),
        ("Attacker", "Dan Four", "Z", None),
    ]


def test_top_plus_minus_threshold_and_order(spark):
    pm = spark.createDataFrame([(1, 7), (2, 6), (3, 7), (5, 5)], "player_id int, plus_minus bigint")
    out = op.top_plus_minus(pm, _players(spark), above=5)
    # value descending, then birth area ascending with nulls first
    assert [tuple(r) for r in out.collect()] == [
        ("Cid Three", None, "Defender", 7),
        ("Ann One", "X", "Goalkeeper", 7),
        ("Two", "Y", "Defender", 6),
    ]


def test_null_substitution_minute_falls_back_to_match_length(spark):
    sheets = matches(spark, [(1, "C", sheet("H", [1, 2], (sub(4, 2, None), None, None)), sheet("A", [11]))])
    pres = op.player_presence(sheets, _events(spark))
    assert rows_of(pres, "player_id", "start_minute", "end_minute", "minutes") == [
        (1, 0, 90, 90),
        (2, 0, 90, 90),  # taken off at an unknown minute: counts to the end
        (4, None, 90, None),
        (11, 0, 90, 90),
    ]
    minutes = op.minutes_per_player(pres)
    assert dict(rows_of(minutes)) == {1: 90, 2: 90, 4: None, 11: 90}
    top = op.most_minutes_by_role(pres, _players(spark))
    assert ("Defender", 90) in {(r["role"], r["minutes"]) for r in top.collect()}


def test_match_whose_second_half_events_have_no_time_is_kept(spark):
    ev = events(spark, [(1, "C", "H", "A", "H", "Pass", None, "2H", 0), goal(1, "H", "A", "A", "1H", 600)])
    ev = ev.withColumn("event_time", F.when(F.col("event_period") == "1H", F.col("event_time")))
    assert rows_of(op.match_length(ev)) == [(1, None)]
    sheets = matches(spark, [(1, "C", sheet("H", [1, 2], (sub(4, 2, 60), None, None)), sheet("A", [11]))])
    pm = op.plus_minus(op.goal_minutes(ev), op.player_presence(sheets, ev))
    # only the interval with a known end holds the goal at minute 10
    assert dict(rows_of(pm)) == {2: 1}


def test_wide_ids_keep_their_type(spark):
    big = 3_000_000_000
    kind = "struct<team:string,lineup:array<bigint>,{}>".format(
        ",".join(f"substitution{k}:struct<player_in:bigint,player_out:bigint,minute:int>" for k in (1, 2, 3))
    )
    sheets = spark.createDataFrame(
        [(big, "C", "S", ("H", [big + 1], (big + 2, big + 1, 60), None, None), ("A", [big + 3], None, None, None))],
        f"match_id bigint, competition string, season string, home_team_data {kind}, away_team_data {kind}",
    )
    lengths = spark.createDataFrame([(big, 90)], "match_id bigint, match_length bigint")
    pres = op.player_presence(sheets, lengths=lengths)
    assert pres.schema["player_id"].dataType.simpleString() == "bigint"
    assert rows_of(pres, "player_id", "minutes") == [(big + 1, 60), (big + 2, 30), (big + 3, 90)]


def test_fixture_grows_with_the_tables(spark):
    small, large = (fb.match_results(spark, d).count() for d in (SF_SMALL, SF_CHECK))
    assert large > 9 * small
    sheets = fb.lineup_rows(spark, SF_CHECK)
    assert sheets.count() > 9 * fb.lineup_rows(spark, SF_SMALL).count()
    assert sheets.select("season").distinct().count() == 3
    names = fb.season_standings(spark, SF_CHECK).select("competition", "team").distinct().groupBy("team").count()
    assert [r["team"] for r in names.filter("count > 1").collect()] == ["T0_0"]  # one name in two competitions
    subs = fb.substitution_rows(spark, SF_CHECK)
    assert subs.filter("sub_minute is null").count() > 0
    assert fb.plus_minus(spark, SF_CHECK).filter("abs(plus_minus) > 5").count() > 0
