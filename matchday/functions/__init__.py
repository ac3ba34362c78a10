"""Column expressions shared by the operators (all built-in Spark SQL)."""

from matchday.functions.columns import (
    ACCURATE_TAG,
    GOAL_TAG,
    PASS_EVENT,
    SAVE_ATTEMPT_EVENT,
    all_nonnegative,
    cyclic_within,
    full_name,
    goal_minute,
    half_up_ratio,
    int_div,
    is_goal,
    local_wall_clock,
    scoring_team,
    signed_text,
)

__all__ = [
    "ACCURATE_TAG",
    "GOAL_TAG",
    "PASS_EVENT",
    "SAVE_ATTEMPT_EVENT",
    "all_nonnegative",
    "cyclic_within",
    "full_name",
    "goal_minute",
    "half_up_ratio",
    "int_div",
    "is_goal",
    "local_wall_clock",
    "scoring_team",
    "signed_text",
]
