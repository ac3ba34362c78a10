"""Table sources: Parquet scans and fixture views over the driver tables."""

from matchday.sources.tables import read_table
from matchday.sources.football import read_events, read_matches, read_measurements, read_players
from matchday.sources.fixtures import (
    events_view,
    matches_view,
    measurements_view,
    players_view,
)

__all__ = [
    "read_table",
    "read_events",
    "read_matches",
    "read_players",
    "read_measurements",
    "events_view",
    "matches_view",
    "players_view",
    "measurements_view",
]
