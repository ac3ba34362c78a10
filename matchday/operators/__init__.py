"""User-level operators: DataFrames in, DataFrames out."""

from matchday.operators.classify import (
    fit_label_index,
    fit_label_indexes,
    label_index_map,
    label_positions,
    naive_bayes_job,
    random_forest_job,
    split_rows,
    with_label_index,
    with_split,
)
from matchday.operators.evaluate import (
    CLASSIFIER_NAMES,
    FOREST_RUNS,
    WEEKDAY_RUNS,
    Run,
    compare_models,
    evaluate_predictions,
    evaluate_tables,
    experiment_report,
    model_report,
)
from matchday.operators.forest import apply_forest, fit_forest
from matchday.operators.joins import hot_keys, interval_join, skew_join
from matchday.operators.measurements import calendar_labels, clean_measurements, nonnegative_rows
from matchday.operators.passing import match_pass_counts, pass_ratio_by_team
from matchday.operators.plusminus import goal_minutes, most_minutes_by_role, plus_minus, top_plus_minus
from matchday.operators.presence import (
    lineup_rows,
    match_length,
    matches_with_length,
    minutes_per_player,
    player_presence,
    presence_from_flat,
    presence_rows,
    substitution_rows,
)
from matchday.operators.ranking import global_positions, group_positions, numbered
from matchday.operators.results import match_results, team_match_rows
from matchday.operators.sampling import with_random_split
from matchday.operators.standings import competition_totals, league_table, overall_table, season_standings
from matchday.operators.summary import best_teams_from_events, match_summary
from matchday.operators.topn import (
    best_teams,
    bottom_n_per_group,
    first_n_per_group,
    lowest_pass_ratio,
    top_teams_report,
)

__all__ = [
    "CLASSIFIER_NAMES",
    "FOREST_RUNS",
    "Run",
    "WEEKDAY_RUNS",
    "apply_forest",
    "best_teams",
    "best_teams_from_events",
    "bottom_n_per_group",
    "calendar_labels",
    "clean_measurements",
    "compare_models",
    "competition_totals",
    "evaluate_predictions",
    "evaluate_tables",
    "experiment_report",
    "first_n_per_group",
    "fit_forest",
    "fit_label_index",
    "fit_label_indexes",
    "global_positions",
    "goal_minutes",
    "group_positions",
    "hot_keys",
    "interval_join",
    "label_index_map",
    "label_positions",
    "league_table",
    "lineup_rows",
    "lowest_pass_ratio",
    "match_length",
    "match_pass_counts",
    "match_results",
    "match_summary",
    "matches_with_length",
    "minutes_per_player",
    "model_report",
    "most_minutes_by_role",
    "naive_bayes_job",
    "nonnegative_rows",
    "numbered",
    "overall_table",
    "pass_ratio_by_team",
    "player_presence",
    "plus_minus",
    "presence_from_flat",
    "presence_rows",
    "random_forest_job",
    "season_standings",
    "skew_join",
    "split_rows",
    "substitution_rows",
    "team_match_rows",
    "top_plus_minus",
    "top_teams_report",
    "with_label_index",
    "with_random_split",
    "with_split",
]
