"""Small builders for hand-made test tables."""

from __future__ import annotations

import math
import numbers

from matchday import schemas


def events(spark, rows):
    """rows: (match_id, competition, home, away, event_team, event, tags, period, seconds)."""
    full = [
        (m, comp, "2017-2018", home, away, team, ev, tags, period, float(t))
        for (m, comp, home, away, team, ev, tags, period, t) in rows
    ]
    return spark.createDataFrame(full, schemas.EVENTS)


def goal(m, home, away, saving_team, period="1H", seconds=600.0, comp="C"):
    return (m, comp, home, away, saving_team, "Save attempt", ["Goal"], period, seconds)


def sub(player_in, player_out, minute):
    return (player_in, player_out, minute)


def sheet(team, lineup, subs=(None, None, None)):
    return (team, lineup, *subs)


def matches(spark, rows):
    """rows: (match_id, competition, home_sheet, away_sheet)."""
    return spark.createDataFrame([(m, c, "2017-2018", h, a) for (m, c, h, a) in rows], schemas.MATCHES)


def players(spark, rows):
    return spark.createDataFrame(rows, schemas.PLAYERS)


def _natural(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def rows_of(df, *cols):
    """Rows as tuples of the named columns, in natural sorted order (nulls last)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_natural)


def _missing(v):
    import pandas as pd

    return v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v))


def canon(rows):
    """Order-insensitive, NaN/float-tolerant form for comparing result sets."""
    out = []
    for row in rows:
        out.append(
            tuple(
                None if _missing(v) else round(float(v), 9) if isinstance(v, numbers.Real) and not isinstance(v, bool) else v
                for v in row
            )
        )
    return sorted(out, key=repr)
