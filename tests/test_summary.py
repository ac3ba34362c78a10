"""Single-pass plans equal the composition of the separate operators."""

import pytest

from conftest import SF_CHECK, SF_SMALL
from helpers import canon, events, goal
from matchday import operators as op
from matchday.plans import football as fb


def _same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    assert canon(tuple(r) for r in a.select(cols).collect()) == canon(tuple(r) for r in b.select(cols).collect())


@pytest.mark.parametrize("base", [SF_SMALL, SF_CHECK])
def test_fused_equals_composed_on_fixture(spark, base):
    _same(fb.best_teams(spark, base), fb.best_teams_composed(spark, base))


def test_fused_best_teams_edge_rows(spark):
    def pas(m, comp, h, a, team, tags):
        return (m, comp, h, a, team, "Pass", tags, "1H", 1)

    ev = events(
        spark,
        [
            goal(1, "A", "B", "B", comp="C1"),
            pas(1, "C1", "A", "B", "A", ["Accurate"]),
            pas(1, "C1", "A", "B", "A", None),
            pas(1, "C1", "A", "B", "X", ["Accurate"]),
            goal(2, "B", "A", None, comp="C1"),  # unknown side: no goal in results
            pas(3, "C2", "A", "D", "D", ["Accurate"]),  # A plays a second competition, passes only by D
            goal(3, "A", "D", "A", comp="C2"),
        ],
    )
    composed = op.best_teams(
        op.season_standings(op.team_match_rows(op.match_results(ev))),
        op.pass_ratio_by_team(op.match_pass_counts(ev)),
    )
    _same(op.best_teams_from_events(ev), composed)
    got = {(r["competition"], r["team"]): r["pass_ratio"] for r in op.best_teams_from_events(ev).collect()}
    assert got[("C1", "A")] == 50.0 and got[("C2", "A")] is None and got[("C2", "D")] == 100.0
