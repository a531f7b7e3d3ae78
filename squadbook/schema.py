"""Fixed values of the roster data model.

Column names, types, synonyms and orders below are fixed values: a roster written
by this package has to line up with rosters users already have.
"""

from __future__ import annotations

PLAYER_ID = "player_id"
YEAR = "year"
GENDER = "gender"
ENTITY_KEY = "sofifa_id"
URL_COLUMN = "player_url"

# The seasons a complete load holds.
EXPECTED_SEASONS: dict[str, tuple[int, ...]] = {
    "male": tuple(range(2015, 2023)),
    "female": tuple(range(2016, 2023)),
}

# Present in every roster, as typed NULLs where a season lacks them.
REQUIRED_COLUMNS = (
    "sofifa_id short_name long_name player_positions age height_cm weight_kg "
    "nationality_name club_name league_name overall potential value_eur wage_eur "
    "release_clause_eur contract_valid_until"
).split()

LONG_COLUMNS = ["sofifa_id"]

INT_COLUMNS = "year contract_valid_until age height_cm weight_kg".split()

TIMESTAMP_COLUMNS = ["club_joined", "dob"]

# Fixed values, by name.
DOUBLE_COLUMNS = """
    attacking_crossing attacking_finishing attacking_heading_accuracy
    attacking_short_passing attacking_volleys cam cb cdm cf club_jersey_number
    club_team_id cm defending defending_marking_awareness defending_sliding_tackle
    defending_standing_tackle dribbling gk goalkeeping_diving goalkeeping_handling
    goalkeeping_kicking goalkeeping_positioning goalkeeping_reflexes goalkeeping_speed
    international_reputation lam lb lcb lcm ldm league_level lf lm ls lw lwb
    mentality_aggression mentality_composure mentality_interceptions mentality_penalties
    mentality_positioning mentality_vision movement_acceleration movement_agility
    movement_balance movement_reactions movement_sprint_speed nation_jersey_number
    nation_team_id nationality_id overall pace passing physic potential power_jumping
    power_long_shots power_shot_power power_stamina power_strength ram rb rcb rcm rdm
    release_clause_eur rf rm rs rw rwb shooting skill_ball_control skill_curve
    skill_dribbling skill_fk_accuracy skill_long_passing skill_moves st value_eur
    wage_eur weak_foot
""".split()

TYPE_MAP: dict[str, str] = {
    **dict.fromkeys(LONG_COLUMNS, "bigint"),
    **dict.fromkeys(INT_COLUMNS, "int"),
    **dict.fromkeys(DOUBLE_COLUMNS, "double"),
    **dict.fromkeys(TIMESTAMP_COLUMNS, "timestamp"),
}

# Synonym -> canonical column. Where several synonyms hold a value, the earlier wins.
SYNONYMS: dict[str, str] = {
    "nationality": "nationality_name",
    "team_jersey_number": "club_jersey_number",
    "club": "club_name",
    "club_contract_valid_until": "contract_valid_until",
    "contract": "contract_valid_until",
    "contract_end_year": "contract_valid_until",
}

# Copied (not renamed) when the left column is missing.
NAME_FALLBACKS: dict[str, str] = {"short_name": "name", "long_name": "full_name"}

CORE_COLUMNS = (
    "player_id year gender sofifa_id short_name long_name club_name league_name "
    "contract_valid_until age nationality_name"
).split()

SORT_COLUMNS = "year gender player_id club_name short_name".split()

SEARCH_PAGE_SCHEMA = "items array<struct<id: struct<videoId: string>>>"

COMMENT_PAGE_SCHEMA = (
    "items array<struct<id: string, snippet: struct<topLevelComment: struct<"
    "snippet: struct<authorDisplayName: string, textDisplay: string>>>>>, "
    "nextPageToken string"
)

COMMENT_SCHEMA = "video_id string, comment_id string, author string, text string"
