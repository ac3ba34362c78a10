"""Plan shape: top-n pruning, single scans, pushdown, no Python in the plans."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from helpers import events
from matchday import operators as op
from matchday.plans import football as fb


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["lowest_pass_ratio", "best_teams", "most_minutes_by_role"])
def test_window_group_limit(spark, name):
    assert "WindowGroupLimit" in plan(getattr(fb, name)(spark, SF_SMALL))


@pytest.mark.parametrize(
    "name", ["match_results", "match_pass_counts", "best_teams", "most_minutes_by_role"]
)
def test_one_event_scan(spark, name):
    """The events (derived from lineitem) are read once per query."""
    p = plan(getattr(fb, name)(spark, SF_SMALL))
    assert p.count("lineitem.parquet") == 1  # the events are scanned once


def test_presence_needs_one_join(spark):
    p = plan(fb.player_presence(spark, SF_SMALL))
    assert p.count("Join") == 1  # sheets to match length; intervals are built in the row


def test_pass_filter_pushed_to_parquet(spark, tmp_path):
    ev = events(spark, [(1, "C", "H", "A", "H", "Pass", ["Accurate"], "1H", 1)])
    path = str(tmp_path / "events")
    ev.write.parquet(path)
    p = plan(op.match_pass_counts(spark.read.parquet(path)))
    assert "EqualTo(event,Pass)" in p
    # also through the name-conforming reader
    from matchday.sources import read_events

    p = plan(op.match_pass_counts(read_events(spark, path)))
    assert "EqualTo(event,Pass)" in p


def test_plus_minus_filters_reach_the_scan(spark, tmp_path):
    from test_presence_plusminus import _events, _sheets

    path = str(tmp_path / "events")
    _events(spark).write.parquet(path)
    ev = spark.read.parquet(path)
    p = plan(op.plus_minus(op.goal_minutes(ev), op.player_presence(_sheets(spark), ev)))
    assert "EqualTo(event,Save attempt)" in p and "EqualTo(event_period,2H)" in p
    assert p.count("parquet") and "PushedFilters: []" not in p


def test_reports_score_the_test_part_in_one_scan(spark):
    from matchday.plans import energy

    p = plan(energy.model_comparison(spark, SF_SMALL))
    assert p.count("lineitem.parquet") == 1
    assert plan(energy.label_index(spark, SF_SMALL)).count("lineitem.parquet") == 1


def test_session_needs_no_checkpoint_folder(spark, tmp_path):
    import os
    import subprocess
    import sys

    code = (
        "from matchday.session import build_session\n"
        "s = build_session('local[2]', 2)\n"
        "import __spark_entry__ as e\n"
        f"assert e.queries()['league_table'](s, '{SF_SMALL}').count() == 50\n"
        "assert s.sparkContext.getCheckpointDir() is None\n"
    )
    root = __file__.rsplit("/tests/", 1)[0]
    bare = os.environ | {"SPARK_CONF_DIR": str(tmp_path)}  # no defaults of this machine
    subprocess.run([sys.executable, "-c", code], cwd=root, env=bare, check=True, timeout=300)


# fitting starts jobs; operators in Python are those of matchday.llm
FITTED = ("rf_experiments", "model_comparison", "rf_predictions", "rf_scored_rows")


@pytest.mark.parametrize(
    "name", [n for n in entry.queries() if n not in FITTED and not n.startswith("op") and n != "pipeline"]
)
def test_no_python_udf(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas"):
        assert marker not in p


def test_bucketed_tables_need_no_shuffle_before_match_keyed_work(spark, tmp_path):
    from matchday.sources.fixtures import events_view, matches_view
    from matchday.sources.tables import save_bucketed

    ev = save_bucketed(events_view(spark, SF_SMALL), "events_b", str(tmp_path / "events_b"), buckets=4)
    ms = save_bucketed(matches_view(spark, SF_SMALL), "matches_b", str(tmp_path / "matches_b"), buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "Exchange" not in plan(op.match_results(ev))
        assert "Exchange" not in plan(op.match_length(ev))
        presence = plan(op.player_presence(ms, ev))
        assert "SortMergeJoin" in presence and "Exchange" not in presence
        # plus-minus: goals are counted and joined in the buckets of the match
        pm = plan(op.plus_minus(op.goal_minutes(ev), op.player_presence(ms, ev)))
        assert "hashpartitioning(match_id" not in pm.replace("hashpartitioning(match_id, goal_minute", "")
        # same rows as from the unbucketed views
        assert op.match_results(ev).count() == fb.match_results(spark, SF_SMALL).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS events_b")
        spark.sql("DROP TABLE IF EXISTS matches_b")
