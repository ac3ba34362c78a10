"""Column expressions used across operators.

All of them are plain Spark SQL expressions, so they stay inside whole-stage
code generation and are visible to the optimizer (no Python UDFs).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the event data model (literal strings of the event feed).
SAVE_ATTEMPT_EVENT = "Save attempt"
PASS_EVENT = "Pass"
GOAL_TAG = "Goal"
ACCURATE_TAG = "Accurate"
FIRST_HALF = "1H"
SECOND_HALF = "2H"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def int_div(num: Column, den: Column) -> Column:
    """Integral division ``num div den`` (exact, bigint)."""
    return F.call_function("div", num, den)


def half_up_ratio(num: str | Column, den: str | Column, digits: int = 2, scale: int = 1) -> Column:
    """``round(num / den * scale, digits)`` computed exactly, half up.

    Rounding a double ratio is at the mercy of binary representation and, for
    averages, of summation order (so of partitioning).  For non-negative
    integer counts the rounded value is an integer number of
    ``10**-digits`` units: ``(2*num*scale*10**digits + den) div (2*den)``.
    The result is the double closest to that decimal, identical on every
    engine and every partitioning.  ``den <= 0`` gives null, as ``try_divide``.
    """
    num, den = _c(num), _c(den)
    unit = 10**digits
    units = int_div(num * (2 * scale * unit) + den, den * 2)
    return F.when(den > 0, units / F.lit(unit))


def is_goal(event: str = "event", tags: str = "tags") -> Column:
    """A goal is a save attempt tagged ``Goal`` (null-safe: null tags -> not a goal)."""
    return (F.col(event) == SAVE_ATTEMPT_EVENT) & F.coalesce(
        F.array_contains(F.col(tags), GOAL_TAG), F.lit(False)
    )


def scoring_team(event_team: str = "event_team", home: str = "home_team", away: str = "away_team") -> Column:
    """The side that did not attempt the save.  A null or unknown event team
    falls to the home side, as in the minute-level goal list."""
    return F.when(F.col(event_team) == F.col(home), F.col(away)).otherwise(F.col(home))


def goal_minute(period: str = "event_period", seconds: str = "event_time") -> Column:
    """Match minute of an event: ``ceil(t/60)`` in the first half, else
    ``ceil(t/60 + 45)`` (extra time and penalties count as second half)."""
    t = F.col(seconds) / 60
    return F.when(F.col(period) == FIRST_HALF, F.ceil(t)).otherwise(F.ceil(t + 45))


def signed_text(col: str | Column) -> Column:
    """Number as text with a leading ``+`` for values >= 0 (goal difference)."""
    c = _c(col)
    return F.when(c >= 0, F.concat(F.lit("+"), c.cast("string"))).otherwise(c.cast("string"))


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    """``first last``; a null part is skipped (``concat_ws``)."""
    return F.concat_ws(" ", F.col(first), F.col(last))


def all_nonnegative(cols: list[str]) -> Column:
    """Every named column is non-null, not NaN and >= 0.

    The NaN test is needed: Spark orders NaN above every number, so
    ``NaN >= 0`` is true.
    """
    preds = [F.col(c).isNotNull() & ~F.isnan(F.col(c)) & (F.col(c) >= 0) for c in cols]
    return reduce(lambda a, b: a & b, preds)


def cyclic_within(label: Column, prediction: Column, cycle: int, k: int) -> Column:
    """``|label - prediction| <= k`` or the wrapped distance over a cycle.

    k = 1 keeps only the exact wrap (``d == cycle - 1``), k = 2 every
    ``d >= cycle - 2``, which is how within-one and within-two are defined.
    """
    d = F.abs(label - prediction)
    if k == 1:
        return (d <= 1) | (d == cycle - 1)
    return (d <= k) | (d >= cycle - k)


def local_wall_clock(seconds: str | Column, zone: str = "UTC") -> Column:
    """Unix seconds -> local wall-clock ``timestamp_ntz`` in ``zone``.

    Independent of ``spark.sql.session.timeZone``: the instant is built as a
    zone-free timestamp and moved to ``zone`` explicitly.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = F.timestamp_add("SECOND", _c(seconds), epoch)
    if zone.upper() in ("UTC", "ETC/UTC", "Z", "GMT"):
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """For each name, one that no column of ``df`` bears: scratch columns
    must not replace a user's own."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
