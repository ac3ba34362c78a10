"""camelCase source tables read into the library schemas."""

from pyspark.sql import Row

from helpers import rows_of
from matchday import operators as op
from matchday import schemas
from matchday.sources import read_events, read_matches, read_players
from matchday.sources.football import snake


def test_snake_names():
    assert snake("matchId") == "match_id"
    assert snake("homeTeamData") == "home_team_data"
    assert snake("substitution1") == "substitution1"
    assert snake("firstname") == "first_name"
    assert snake("lastName") == "last_name"
    assert snake("match_id") == "match_id"


def test_camel_case_tables_round_trip(spark, tmp_path):
    ev = spark.createDataFrame(
        [Row(matchId=1, competition="C", season="S", homeTeam="H", awayTeam="A", eventTeam="A",
             event="Save attempt", tags=["Goal"], eventPeriod="2H", eventTime=2700.0)]
    )
    # fields deliberately in another order than the target struct
    sheet = "struct<substitution1:struct<minute:int,playerOut:int,playerIn:int>,team:string,lineup:array<int>," \
            "substitution2:struct<playerIn:int,playerOut:int,minute:int>,substitution3:struct<playerIn:int,playerOut:int,minute:int>>"
    matches = spark.createDataFrame(
        [(1, "C", "S", ((60, 2, 4), "H", [1, 2], None, None), (None, "A", [11], None, None))],
        f"matchId int, competition string, season string, homeTeamData {sheet}, awayTeamData {sheet}",
    )
    players = spark.createDataFrame(
        [Row(playerId=1, firstname="Ann", lastName="One", birthArea="X", role="Goalkeeper")]
    )
    for name, df in (("events", ev), ("matches", matches), ("players", players)):
        df.write.parquet(str(tmp_path / name))
    events = read_events(spark, str(tmp_path / "events"))
    sheets = read_matches(spark, str(tmp_path / "matches"))
    people = read_players(spark, str(tmp_path / "players"))
    # as the schema, but ids keep the width of the source
    assert events.schema["match_id"].dataType.simpleString() == "bigint"
    assert events.drop("match_id").schema.simpleString() == schemas.EVENTS.simpleString().replace("match_id:int,", "")
    assert sheets.schema.simpleString() == schemas.MATCHES.simpleString()
    assert people.columns == ["player_id", "first_name", "last_name", "birth_area", "role"]
    home = sheets.first()["home_team_data"]
    assert (home["substitution1"]["player_in"], home["substitution1"]["player_out"], home["substitution1"]["minute"]) == (4, 2, 60)
    assert home["substitution2"] is None  # a missing substitution stays null
    pres = op.player_presence(sheets, events)
    assert rows_of(pres, "player_id", "start_minute", "end_minute") == [(1, 0, 90), (2, 0, 60), (4, 60, 90), (11, 0, 90)]


def test_command_line_lists_queries(capsys):
    from matchday.__main__ import main

    assert main(["--list"]) == 0
    out = capsys.readouterr().out
    assert "league_table" in out and "SQL oracle" in out and "rows only" in out
