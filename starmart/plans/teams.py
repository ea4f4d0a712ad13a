"""Clubs and competitions: attack and defence, spend against results, seasons, spectacular games."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import ratio, scaled, sum_case, sum_where
from starmart.operators import (
    aggregate,
    child_counts,
    dice,
    either_role,
    order,
    period_change,
    rank_columns,
    star_join,
    tiers,
    top_overall,
    two_perspectives,
    vs_group,
)
from starmart.plans.common import BIG_FIVE, Mart, fact, with_calendar, with_club, with_club_league, with_league


def q12_1(mart: Mart, leagues=BIG_FIVE, min_games: int = 50, ranks: int = 5) -> DataFrame:
    """Clubs among the best attacks or the best defences of each league."""
    games = dice(mart["fact_games"], {"competition_id": list(leagues)})
    sides = either_role(
        games, "home_club_id", "away_club_id", "club_id", ["competition_id", "home_club_goals", "away_club_goals"]
    )
    home, away = F.col("is_first"), F.col("is_second")
    by_club = aggregate(
        sides, ["competition_id", "club_id"],
        {
            "rows": F.count(F.lit(1)),
            "games": F.count_if(home) + F.count_if(away),
            "goals_for": sum_case(home, "home_club_goals") + sum_case(away, "away_club_goals"),
            "goals_against": sum_case(home, "away_club_goals") + sum_case(away, "home_club_goals"),
        },
    )
    named = with_club(with_league(by_club, mart), mart)
    totals = aggregate(
        named, ["league", "club"], {c: F.sum(c) for c in ("rows", "games", "goals_for", "goals_against")},
        having=F.col("rows") >= min_games,
    ).drop("rows")
    ranked = rank_columns(
        totals, ["league"], {"attack_rank": [F.desc("goals_for")], "defence_rank": [F.asc("goals_against")]}
    )
    best = ranked.filter((F.col("attack_rank") <= ranks) | (F.col("defence_rank") <= ranks))
    result = best.select(
        "league", "club", "games", "goals_for",
        ratio(F.col("goals_for"), F.col("games"), 2).alias("goals_for_per_game"), "attack_rank", "goals_against",
        ratio(F.col("goals_against"), F.col("games"), 2).alias("goals_against_per_game"), "defence_rank",
        (F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
    )
    return order(result, [("league", "asc", "last"), ("attack_rank", "asc", "last"), ("club", "asc", "last")])


def club_results(mart: Mart, leagues=BIG_FIVE, seasons=(2018, 2024)) -> DataFrame:
    """Wins, draws, losses and goals of every club, home and away together, in one scan."""
    games = with_calendar(dice(fact(mart, "fact_games", seasons=seasons), {"competition_id": list(leagues)}), mart, seasons=seasons)

    def view(key: str, won: str, lost: str, scored: str, conceded: str) -> dict:
        return {
            "club_id": F.col(key).cast("bigint"), "won": F.col(won), "drawn": F.col("is_draw"), "lost": F.col(lost),
            "scored": F.col(scored), "conceded": F.col(conceded),
        }

    sides = two_perspectives(
        games,
        [
            view("home_club_id", "is_home_win", "is_away_win", "home_club_goals", "away_club_goals"),
            view("away_club_id", "is_away_win", "is_home_win", "away_club_goals", "home_club_goals"),
        ],
    )
    return aggregate(
        sides, ["club_id"],
        {
            "wins": sum_case(F.col("won")),
            "draws": sum_case(F.col("drawn")),
            "losses": sum_case(F.col("lost")),
            "games": sum_case(F.col("won")) + sum_case(F.col("drawn")) + sum_case(F.col("lost")),
            "goals_for": F.sum("scored"),
            "goals_against": F.sum("conceded"),
        },
    )


def q12_2(
    mart: Mart, leagues=BIG_FIVE, seasons=(2018, 2024), min_games: int = 50, top: int = 30,
    unknown_spend: str = "first",
) -> DataFrame:
    """Spend against win rate per club, with the quartile of each.

    A club without any known fee counts as the highest spender in the quartiles when
    ``unknown_spend`` is "first", as the published query has it, and as the lowest with "last".
    """
    priced = F.col("transfer_fee") > 0
    moves = mart["fact_transfers"].filter(F.col("transfer_season").between(*seasons))
    by_club = aggregate(
        moves, ["to_club_id"], {"spend": sum_where("transfer_fee", priced), "priced_transfers": F.count_if(priced)}
    )
    spend = with_club_league(by_club, mart, "to_club_id", {"name": "league"}, club="club", leagues=leagues)
    spend = spend.withColumn("club_id", F.col("to_club_id").cast("bigint")).drop("to_club_id")
    results = club_results(mart, leagues, seasons).filter(F.col("games") >= min_games)
    rows = spend.join(results, "club_id").select(
        "club_id", "club", "league", "spend", "priced_transfers", "games", "wins",
        ratio(F.col("wins"), F.col("games"), 1, factor=100).alias("win_pct"),
        (F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
        ratio(F.col("wins"), F.col("games"), 12).alias("_rate"),
    )
    by_spend = F.desc_nulls_first("spend") if unknown_spend == "first" else F.desc_nulls_last("spend")
    rows = tiers(rows, [by_spend, F.asc("club_id")], 4, "spend_quartile")
    rows = tiers(rows, [F.desc_nulls_last("_rate"), F.asc("club_id")], 4, "result_quartile")
    first = top_overall(rows, [F.desc_nulls_last("spend"), F.asc("club_id")], top)
    return first.select(
        "club", "league", scaled(F.col("spend"), 1_000_000, 1).alias("spend_m"), "priced_transfers", "games",
        "wins", "win_pct", "goal_difference", "spend_quartile", "result_quartile",
    )


def season_goals(mart: Mart, leagues=BIG_FIVE, seasons=(2010, 2024), min_games: int = 30) -> DataFrame:
    """Games and goals of every league and season."""
    games = with_calendar(dice(fact(mart, "fact_games", seasons=seasons), {"competition_id": list(leagues)}), mart, seasons=seasons)
    by_day = aggregate(
        games, ["competition_id", "date_id"], {"n": F.count(F.lit(1)), "total": F.sum("total_goals")}
    )
    days = with_league(with_calendar(by_day, mart, columns=["season_start_year"]), mart)
    return aggregate(
        days, ["league", F.col("season_start_year").alias("season")],
        {"games": F.sum("n"), "goals": F.sum("total"), "goals_per_game": ratio(F.sum("total"), F.sum("n"), 3)},
        having=F.col("games") >= min_games,
    )


def q12_3(mart: Mart, leagues=BIG_FIVE, seasons=(2010, 2024), min_games: int = 30) -> DataFrame:
    """Goals per game by season against the league's mean, the season before, and its extremes."""
    rows = season_goals(mart, leagues, seasons, min_games)
    stats = vs_group(rows, ["league"], "goals_per_game", "_league")
    moved = period_change(stats, ["league"], "season", "goals_per_game", "_before")
    ranked = rank_columns(moved, ["league"], {"season_rank": [F.desc("goals_per_game")]}, how="rank")
    result = ranked.select(
        "league", "season", "games", "goals", "goals_per_game",
        F.round("_league_avg", 3).alias("league_mean"),
        F.round("_league_deviation", 3).alias("deviation"),
        F.round(F.col("goals_per_game") - F.col("_before"), 3).alias("change"),
        "season_rank",
        F.col("_league_max").alias("league_max"),
        F.col("_league_min").alias("league_min"),
    )
    return order(result, [("league", "asc", "last"), ("season", "asc", "last")])


def q12_4(mart: Mart, leagues=BIG_FIVE, top: int = 25) -> DataFrame:
    """Highest-scoring games with their cards and substitutions.

    The games are chosen first; only their events are counted.
    """
    games = dice(mart["fact_games"], {"competition_id": list(leagues)})
    ordering = [F.desc("total_goals"), F.desc("goal_difference"), F.asc("game_id")]
    chosen = top_overall(games, ordering, top, "rank")
    events = mart["fact_game_events"].join(chosen.select("game_id"), "game_id", "left_semi")
    counted = child_counts(
        chosen, events, "game_id",
        {"cards": F.col("type") == "Cards", "substitutions": F.col("type") == "Substitutions"},
    )
    calendar = {"full_date": "full_date", "season_start_year": "season_start_year"}
    named = star_join(
        with_league(counted, mart),
        [
            ("date_id", mart["dim_date"], "date_id", calendar),
            ("game_id", mart["dim_games"], "game_id", {"home_club_name": "home", "away_club_name": "away"}),
        ],
    )
    outcome = (
        F.when(F.col("is_home_win"), "Victoria local").when(F.col("is_away_win"), "Victoria visitante").otherwise("Empate")
    )
    return named.orderBy("rank").select(
        "rank", "league", "full_date", F.col("season_start_year").alias("season"), "home",
        F.col("home_club_goals").alias("home_goals"), F.col("away_club_goals").alias("away_goals"), "away",
        "total_goals", F.abs("goal_difference").alias("difference"), outcome.alias("outcome"), "cards",
        "substitutions",
    )
