"""Slices and dices: one or more dimensions fixed, the rest reported."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import concat_text, matches, n_distinct, ratio, sum_case, sum_where
from starmart.operators import aggregate, any_of, dice, slice_, star_join, top_overall
from starmart.plans.common import (
    BIG_FIVE,
    Mart,
    fact,
    player_keys,
    with_calendar,
    with_club_league,
    with_league,
    with_player,
)


def paid():
    """Transfers with a known fee; -1 marks an unknown fee and 0 a free move."""
    return F.col("transfer_fee") > 0


def q01_1(mart: Mart, season: int = 2023, top: int = 15) -> DataFrame:
    """Buying clubs of one season with number, spend and mean fee of their transfers."""
    moves = slice_(mart["fact_transfers"], "transfer_season", season)
    by_club = aggregate(
        moves, ["to_club_id"],
        {"n": F.count(F.lit(1)), "fees": sum_where("transfer_fee", paid()), "priced": F.count_if(paid())},
    )
    named = with_club_league(by_club, mart, "to_club_id", {"name": "league"}, club="club")
    result = aggregate(
        named, ["club", "league"],
        {
            "transfers": F.sum("n"),
            "spend": F.sum("fees"),
            "mean_fee": ratio(F.sum("fees"), F.sum("priced"), 2),
        },
    )
    return top_overall(result, [F.desc_nulls_last("spend"), F.asc("club"), F.asc_nulls_last("league")], top)


def q01_2(mart: Mart, competition: str = "GB1", min_games: int = 20, top: int = 15) -> DataFrame:
    """Home record of each club in one competition."""
    games = slice_(mart["fact_games"], "competition_id", competition)
    games = games.join(mart["dim_games"].select("game_id", "home_club_name"), "game_id")
    n = F.count(F.lit(1))
    result = aggregate(
        games, [F.col("home_club_name").alias("club")],
        {
            "home_games": n,
            "goals_for": F.sum("home_club_goals"),
            "goals_against": F.sum("away_club_goals"),
            "home_wins": sum_case(F.col("is_home_win")),
            "goals_per_game": ratio(F.sum("home_club_goals"), n, 2),
            "win_pct": ratio(sum_case(F.col("is_home_win")), n, 1, factor=100),
        },
        having=F.col("home_games") >= min_games,
    )
    return top_overall(result, [F.desc_nulls_last("win_pct"), F.asc("club")], top)


def q01_3(mart: Mart, club_id: int = 131, top: int = 30) -> DataFrame:
    """Latest paid transfers into and out of one club."""
    moves = any_of(
        mart["fact_transfers"].filter(paid()), [F.col("to_club_id") == club_id, F.col("from_club_id") == club_id]
    )
    incoming = F.col("to_club_id") == club_id
    rows = with_calendar(moves, mart, "transfer_date_id", ["full_date", "year"]).select(
        "full_date", "year", "player_name",
        F.when(incoming, "FICHAJE").otherwise("VENTA").alias("operation"),
        F.when(incoming, F.col("from_club_name")).otherwise(F.col("to_club_name")).alias("counterpart"),
        "transfer_fee",
        F.col("market_value_in_eur").alias("market_value"),
    )
    ordering = [F.desc("full_date"), F.desc("transfer_fee"), F.asc("player_name"), F.asc("operation"),
                F.asc("counterpart"), F.desc("market_value")]
    return top_overall(rows, ordering, top)


def q02_1(
    mart: Mart, country: str = "Spain", leagues=BIG_FIVE, years=(2020, 2024), top: int = 20,
    split_homonyms: bool = False,
) -> DataFrame:
    """Goals and assists of the players of one nationality, per league."""
    lines = with_calendar(dice(fact(mart, "fact_appearances", years), {"competition_id": list(leagues)}), mart, years=years)
    players = slice_(mart["dim_players"], "country_of_citizenship", country)
    lines = with_league(with_player(lines, mart, {"name": "player", "position": "position"}, players), mart)
    games = n_distinct("game_id")
    result = aggregate(
        lines, player_keys(["player", "position", "league"], split_homonyms),
        {
            "goals": F.sum("goals"),
            "assists": F.sum("assists"),
            "goal_involvements": F.sum(F.col("goals") + F.col("assists")),
            "games": games,
            "goals_per_game": ratio(F.sum("goals"), games, 2),
        },
        having=F.col("goals") > 0,
    )
    return top_overall(result, [F.desc("goals"), F.asc("player"), F.asc("position"), F.asc("league")], top)


def q02_2(
    mart: Mart, from_league: str = "L1", to_league: str = "GB1", years=(2018, 2024),
    min_fee: int = 10_000_000, top: int = 20,
) -> DataFrame:
    """Dearest transfers from the clubs of one league to those of another."""
    moves = with_calendar(mart["fact_transfers"], mart, "transfer_date_id", years=years)
    moves = moves.filter(F.col("transfer_fee") > min_fee)
    clubs = mart["dim_clubs"]
    moves = star_join(
        moves,
        [
            ("from_club_id", slice_(clubs, "domestic_competition_id", from_league), "club_id", {}),
            ("to_club_id", slice_(clubs, "domestic_competition_id", to_league), "club_id", {}),
            ("transfer_date_id", mart["dim_date"], "date_id", {"year": "year"}),
        ],
    )
    rows = moves.select(
        F.col("player_name").alias("player"), "from_club_name", "to_club_name", "year",
        F.col("transfer_fee").alias("fee"), F.col("market_value_in_eur").alias("market_value"),
        ratio(F.col("transfer_fee"), F.col("market_value_in_eur"), 2).alias("fee_to_value"),
    )
    ordering = [F.desc("fee"), F.asc("player"), F.asc("from_club_name"), F.asc("to_club_name"), F.asc("year"),
                F.desc("market_value")]
    return top_overall(rows, ordering, top)


def q02_3(
    mart: Mart, event_type: str = "Cards", pattern: str = "%Red card%", leagues=BIG_FIVE, top: int = 25
) -> DataFrame:
    """Latest red cards at weekends, with match and player."""
    cards = dice(
        mart["fact_game_events"],
        {"type": event_type, "competition_id": list(leagues), "description": lambda c: matches(c, pattern)},
    )
    weekend = mart["dim_date"].filter("is_weekend")
    cards = star_join(
        cards, [("date_id", weekend, "date_id", {"full_date": "full_date", "day_name": "day_name"})]
    )
    cards = with_player(with_league(cards, mart), mart, {"name": "player"})
    games = mart["dim_games"].select(
        "game_id", concat_text(F.col("home_club_name"), F.lit(" vs "), F.col("away_club_name")).alias("match")
    )
    rows = cards.join(games, "game_id").select(
        "league", "match", "full_date", "day_name", "player", "minute", F.col("description").alias("detail")
    )
    ordering = [F.desc("full_date"), F.asc("match"), F.asc("minute"), F.asc("player"), F.asc("detail"), F.asc("league")]
    return top_overall(rows, ordering, top)
