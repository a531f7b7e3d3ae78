from .incremental import Load, load_changed_seasons, read_roster
from .reports import (
    average_age_ranking,
    expiring_contracts,
    most_discussed_player,
    nationality_histogram,
    popular_nationality,
)
from .roster import build_roster, load_roster, standardize_roster

__all__ = [
    "Load",
    "average_age_ranking",
    "build_roster",
    "expiring_contracts",
    "load_changed_seasons",
    "load_roster",
    "most_discussed_player",
    "nationality_histogram",
    "popular_nationality",
    "read_roster",
    "standardize_roster",
]
