"""Cleaning and labelling minute measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.functions.columns import all_nonnegative, local_wall_clock

# English day names in ``dayofweek`` order (1 = Sunday).
DAY_NAMES_FROM_SUNDAY = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def clean_measurements(df: DataFrame) -> DataFrame:
    """Drop every row with a null or NaN in any column."""
    return df.na.drop(how="any")


def calendar_labels(
    df: DataFrame,
    time_col: str = "time",
    zone: str = "UTC",
    fields: Sequence[str] = ("month", "hour"),
) -> DataFrame:
    """Add calendar fields of the Unix-seconds column in ``zone``.

    ``month`` 1-12, ``hour`` 0-23, ``weekday`` English day name.  The wall
    clock is derived without the session time zone, so results are the same
    on every cluster.
    """
    local = local_wall_clock(time_col, zone)
    # day names by position: a lookup instead of formatting a date per row
    day_names = F.array(*[F.lit(d) for d in DAY_NAMES_FROM_SUNDAY])
    exprs = {
        "month": F.month(local),
        "hour": F.hour(local),
        "weekday": F.element_at(day_names, F.dayofweek(local)),
    }
    unknown = set(fields) - set(exprs)
    if unknown:
        raise ValueError(f"unknown calendar fields {sorted(unknown)}")
    return df.withColumns({name: exprs[name] for name in fields})


def nonnegative_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every named column is non-null, not NaN and >= 0
    (multinomial naive Bayes rejects negative features)."""
    return df.filter(all_nonnegative(list(cols)))
