"""Column types, null rules and unknown members of the warehouse tables."""

from datetime import date

SENTINEL = -1

# Text tokens that mean NULL on read. The first five are set for this warehouse, the
# others are the defaults of the CSV reader its files were made for.
NULL_TOKENS = (
    "", "NA", "N/A", "null", "None",
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "NULL", "NaN", "n/a", "nan",
)

# The default of each null category. Money uses -1 because 0 means "free".
NULL_DEFAULTS = {
    "measure": 0,
    "attribute": SENTINEL,
    "money": SENTINEL,
    "optional_key": SENTINEL,
    "flag": False,
    "unknown_date": date(1900, 1, 1),
    "open_date": date(9999, 12, 31),
}
TEXT_DEFAULTS = {True: "N/A", False: "Unknown"}  # by "is a dimension"

# Target types of the warehouse tables.
TABLES = {
    "dim_date": {
        "date_id": "int", "full_date": "date", "year": "int", "quarter": "int", "month": "int",
        "month_name": "string", "week": "int", "day_of_year": "int", "day_of_month": "int",
        "day_of_week": "int", "day_name": "string", "is_weekend": "boolean", "season_start_year": "int",
    },
    "dim_competitions": {
        "competition_id": "string", "competition_code": "string", "name": "string", "sub_type": "string",
        "type": "string", "country_id": "int", "country_name": "string", "domestic_league_code": "string",
        "confederation": "string", "url": "string", "is_major_national_league": "boolean",
    },
    "dim_clubs": {
        "club_id": "int", "club_code": "string", "name": "string", "domestic_competition_id": "string",
        "total_market_value": "decimal(15,2)", "squad_size": "int", "average_age": "decimal(4,2)",
        "foreigners_number": "int", "foreigners_percentage": "decimal(5,2)", "national_team_players": "int",
        "stadium_name": "string", "stadium_seats": "int", "net_transfer_record": "string",
        "coach_name": "string", "last_season": "int", "url": "string",
    },
    "dim_players": {
        "player_id": "int", "first_name": "string", "last_name": "string", "name": "string",
        "last_season": "int", "current_club_id": "int", "player_code": "string", "country_of_birth": "string",
        "city_of_birth": "string", "country_of_citizenship": "string", "date_of_birth": "date",
        "sub_position": "string", "position": "string", "foot": "string", "height_in_cm": "decimal(5,2)",
        "contract_expiration_date": "date", "agent_name": "string", "image_url": "string", "url": "string",
        "current_club_domestic_competition_id": "string", "current_club_name": "string",
        "market_value_in_eur": "decimal(15,2)", "highest_market_value_in_eur": "decimal(15,2)",
    },
    "dim_games": {
        "game_id": "int", "competition_id": "string", "season": "int", "round": "string", "date": "date",
        "home_club_id": "int", "away_club_id": "int", "home_club_name": "string", "away_club_name": "string",
        "stadium": "string", "attendance": "int", "referee": "string", "url": "string",
        "home_club_formation": "string", "away_club_formation": "string", "home_club_manager_name": "string",
        "away_club_manager_name": "string", "aggregate": "string", "competition_type": "string",
    },
    "fact_games": {
        "game_id": "int", "competition_id": "string", "home_club_id": "int", "away_club_id": "int",
        "date_id": "int", "season": "int", "home_club_goals": "int", "away_club_goals": "int",
        "home_club_position": "int", "away_club_position": "int", "attendance": "int",
        "goal_difference": "int", "total_goals": "int", "is_home_win": "boolean", "is_draw": "boolean",
        "is_away_win": "boolean",
    },
    "fact_appearances": {
        "appearance_id": "string", "game_id": "int", "player_id": "int", "club_id": "int",
        "competition_id": "string", "date_id": "int", "player_name": "string", "type": "string",
        "position": "string", "team_captain": "boolean", "minutes_played": "int", "goals": "int",
        "assists": "int", "yellow_cards": "int", "red_cards": "int",
    },
    "fact_game_events": {
        "event_id": "string", "game_id": "int", "club_id": "int", "player_id": "int", "date_id": "int",
        "competition_id": "string", "type": "string", "description": "string", "player_in_id": "int",
        "player_assist_id": "int", "minute": "int",
    },
    "fact_transfers": {
        "transfer_id": "bigint", "player_id": "int", "from_club_id": "int", "to_club_id": "int",
        "transfer_date_id": "int", "transfer_season": "int", "player_name": "string",
        "from_club_name": "string", "to_club_name": "string", "transfer_fee": "decimal(15,2)",
        "market_value_in_eur": "decimal(15,2)",
    },
    "fact_player_valuations": {
        "valuation_id": "bigint", "player_id": "int", "club_id": "int", "competition_id": "string",
        "date_id": "int", "market_value_in_eur": "decimal(15,2)",
    },
}

# The null category of each column, by table.
NULL_RULES = {
    "dim_date": {},
    "dim_competitions": {
        "text": ["competition_code", "name", "sub_type", "type", "country_name", "domestic_league_code",
                 "confederation", "url"],
        "attribute": ["country_id"],
        "flag": ["is_major_national_league"],
    },
    "dim_clubs": {
        "text": ["club_code", "name", "domestic_competition_id", "stadium_name", "net_transfer_record",
                 "coach_name", "url"],
        "measure": ["average_age", "foreigners_percentage"],
        "attribute": ["squad_size", "foreigners_number", "national_team_players", "stadium_seats",
                      "last_season"],
        "money": ["total_market_value"],
    },
    "dim_players": {
        "text": ["first_name", "last_name", "name", "player_code", "country_of_birth", "city_of_birth",
                 "country_of_citizenship", "sub_position", "position", "foot", "agent_name", "image_url",
                 "url", "current_club_domestic_competition_id", "current_club_name"],
        "attribute": ["last_season", "current_club_id", "height_in_cm"],
        "money": ["market_value_in_eur", "highest_market_value_in_eur"],
        "unknown_date": ["date_of_birth"],
        "open_date": ["contract_expiration_date"],
    },
    "dim_games": {
        "text": ["competition_id", "round", "home_club_name", "away_club_name", "stadium", "referee", "url",
                 "home_club_formation", "away_club_formation", "home_club_manager_name",
                 "away_club_manager_name", "aggregate", "competition_type"],
        "attribute": ["game_id", "season", "home_club_id", "away_club_id", "attendance"],
        "unknown_date": ["date"],
    },
    "fact_games": {
        "text": ["competition_id"],
        "measure": ["home_club_goals", "away_club_goals", "goal_difference", "total_goals",
                    "home_club_position", "away_club_position"],
        "attribute": ["game_id", "home_club_id", "away_club_id", "date_id", "season", "attendance"],
        "flag": ["is_home_win", "is_draw", "is_away_win"],
    },
    "fact_appearances": {
        "text": ["appearance_id", "competition_id", "player_name", "type", "position"],
        "measure": ["minutes_played", "goals", "assists", "yellow_cards", "red_cards"],
        "attribute": ["game_id", "player_id", "club_id", "date_id"],
        "flag": ["team_captain"],
    },
    "fact_game_events": {
        "text": ["event_id", "competition_id", "type", "description"],
        "attribute": ["game_id", "club_id", "player_id", "date_id", "minute"],
        "optional_key": ["player_assist_id", "player_in_id"],
    },
    "fact_transfers": {
        "text": ["player_name", "from_club_name", "to_club_name"],
        "attribute": ["transfer_id", "player_id", "transfer_date_id", "transfer_season"],
        "optional_key": ["from_club_id", "to_club_id"],
        "money": ["transfer_fee", "market_value_in_eur"],
    },
    "fact_player_valuations": {
        "text": ["competition_id"],
        "attribute": ["valuation_id", "player_id", "club_id", "date_id"],
        "money": ["market_value_in_eur"],
    },
}

UNKNOWN_NAME = "Desconocido"  # fixed value: the name of the unknown member


def unknown_member(table: str, key: str) -> dict[str, object]:
    """The unknown-member row of a dimension: every column at its marker, -1 for all numbers."""
    row: dict[str, object] = {}
    for column, kind in TABLES[table].items():
        if kind == "string":
            row[column] = TEXT_DEFAULTS[True]
        elif kind == "date":
            open_dates = NULL_RULES[table].get("open_date", [])
            row[column] = NULL_DEFAULTS["open_date" if column in open_dates else "unknown_date"]
        else:
            row[column] = SENTINEL
    return {**row, key: SENTINEL, "name": UNKNOWN_NAME}
