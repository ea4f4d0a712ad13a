"""Pivots, grouping sets, cubes and two-sided balances."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import ratio, scaled, sum_where
from starmart.operators import (
    aggregate,
    balance,
    cube,
    dice,
    grouping_sets,
    level_label,
    order,
    pivot,
    top_overall,
)
from starmart.plans.common import BIG_FIVE, UNNAMED, Mart, fact, with_calendar, with_club, with_club_league, with_league

# Column names of the league and weekday matrices.
LEAGUE_COLUMNS = {
    "ES1": "la_liga", "GB1": "premier_league", "IT1": "serie_a", "L1": "bundesliga", "FR1": "ligue_1",
}
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def q05_1(mart: Mart, leagues=BIG_FIVE, seasons=(2015, 2024)) -> DataFrame:
    """Goals by season and league as a matrix with the season total."""
    games = with_calendar(dice(fact(mart, "fact_games", seasons=seasons), {"competition_id": list(leagues)}), mart, seasons=seasons)
    by_day = aggregate(games, ["date_id", "competition_id"], {"goals": F.sum("total_goals")})
    days = with_calendar(by_day, mart, columns=["season_start_year"]).withColumnRenamed("season_start_year", "season")
    columns = {code: name for code, name in LEAGUE_COLUMNS.items() if code in leagues}
    return order(pivot(days, ["season"], "competition_id", columns, "goals", "total"), [("season", "asc", "last")])


def q05_2(mart: Mart, seasons=(2020, 2024), top: int = 10) -> DataFrame:
    """Spend in millions by buying club and season, for the clubs with the highest total."""
    moves = mart["fact_transfers"].filter(F.col("transfer_season").between(*seasons))
    fee = F.when(F.col("transfer_fee") > 0, F.col("transfer_fee"))
    names = {season: f"spend_{season}_m" for season in range(seasons[0], seasons[1] + 1)}
    by_club = pivot(moves, ["to_club_id"], "transfer_season", names, fee, "total_m")
    amounts = [*names.values(), "total_m"]
    summed = aggregate(with_club(by_club, mart, "to_club_id"), ["club"], {c: F.sum(c) for c in amounts})
    first = top_overall(summed, [F.desc_nulls_last("total_m"), F.asc("club")], top)
    return first.select("club", *[scaled(F.col(c), 1_000_000, 1).alias(c) for c in amounts])


def q05_3(mart: Mart, leagues=BIG_FIVE) -> DataFrame:
    """Events by type and weekday as a matrix."""
    events = dice(mart["fact_game_events"], {"competition_id": list(leagues)})
    by_day = aggregate(events, ["date_id", "type"], {"n": F.count(F.lit(1))})
    days = with_calendar(by_day, mart, columns=["day_name"])
    matrix = pivot(days, ["type"], "day_name", {d: d.lower() for d in WEEKDAYS}, "n", "total")
    counts = matrix.na.fill(0, [d.lower() for d in WEEKDAYS])
    return order(counts, [("total", "desc", "last"), ("type", "asc", "last")])


def q07_1(mart: Mart, leagues=BIG_FIVE, seasons=(2020, 2024)) -> DataFrame:
    """Goals by league and season, by league, by season and in total, in one pass."""
    games = with_calendar(dice(fact(mart, "fact_games", seasons=seasons), {"competition_id": list(leagues)}), mart, seasons=seasons)
    by_day = aggregate(
        games, ["competition_id", "date_id"], {"goals": F.sum("total_goals"), "games": F.count(F.lit(1))}
    )
    days = with_league(with_calendar(by_day, mart, columns=["season_start_year"]), mart)
    result = grouping_sets(
        days, [["league", "season_start_year"], ["league"], ["season_start_year"], []],
        {
            "league_label": level_label("league", "** TODAS LAS LIGAS **"),
            "season_label": level_label("season_start_year", "** TODAS **", F.col("season_start_year").cast("string")),
            "goals": F.sum("goals"),
            "games": F.sum("games"),
            "goals_per_game": ratio(F.sum("goals"), F.sum("games"), 2),
            "all_leagues": F.grouping("league").cast("int"),
            "all_seasons": F.grouping("season_start_year").cast("int"),
        },
    ).select(
        F.col("league_label").alias("league"), F.col("season_label").alias("season"), "goals", "games",
        "goals_per_game", "all_leagues", "all_seasons",
    )
    return order(result, [(c, "asc", "last") for c in ("all_leagues", "all_seasons", "league", "season")])


def q07_2(mart: Mart, leagues=BIG_FIVE) -> DataFrame:
    """Appearances by position, type and captaincy at all eight grouping levels."""
    lines = dice(mart["fact_appearances"], {"competition_id": list(leagues)})
    lines = lines.filter(~F.col("position").isin(*UNNAMED))
    keys = ["position", "type", "team_captain"]
    # Summed to the finest level first, so the cube repeats those few rows and not the lines.
    sums = {c: F.sum(c).alias(c) for c in ("goals", "assists", "minutes_played", "yellow_cards", "red_cards")}
    finest = lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.count("minutes_played").alias("_timed"), *sums.values()
    )
    result = cube(
        finest, keys,
        {
            "position_label": level_label("position", "** TODAS **"),
            "type_label": level_label("type", "** TODOS **"),
            "captain": level_label(
                "team_captain", "** TODOS **", F.when(F.col("team_captain"), "Si").otherwise("No")
            ),
            "levels": F.grouping_id(),
            "appearances": F.sum("_n"),
            "goals": F.sum("goals"),
            "assists": F.sum("assists"),
            "mean_minutes": ratio(F.sum("minutes_played"), F.sum("_timed"), 0),
            "yellow_cards": F.sum("yellow_cards"),
            "red_cards": F.sum("red_cards"),
        },
    )
    return order(
        result, [("levels", "asc", "last"), ("position_label", "asc", "last"), ("type_label", "asc", "last")]
    ).select(
        F.col("position_label").alias("position"), F.col("type_label").alias("type"), "captain", "appearances",
        "goals", "assists", "mean_minutes", "yellow_cards", "red_cards",
    )


def _side(mart: Mart, key: str, amount: str, seasons) -> DataFrame:
    moves = mart["fact_transfers"].filter(F.col("transfer_season").between(*seasons))
    by_club = aggregate(moves, [key], {"fees": sum_where("transfer_fee", F.col("transfer_fee") > 0)})
    named = with_club_league(by_club, mart, key, {"confederation": "confederation", "name": "league"})
    return aggregate(named, ["confederation", "league"], {amount: F.sum("fees")})


def _state(difference: Column) -> Column:
    return F.when(difference > 0, "SUPERAVIT").when(difference < 0, "DeFICIT").otherwise("EQUILIBRIO")


def q07_3(mart: Mart, seasons=(2020, 2024), top: int = 20) -> DataFrame:
    """Money spent and earned per league; leagues without a name never pair up."""
    both = balance(
        _side(mart, "to_club_id", "spend", seasons), _side(mart, "from_club_id", "income", seasons),
        "league", ["confederation"], ["spend", "income"],
    )
    result = both.select(
        F.coalesce("confederation", F.lit("** TOTAL **")).alias("confederation"),
        F.coalesce("league", F.lit("** TOTAL **")).alias("league"),
        "spend", "income",
        (F.col("income") - F.col("spend")).alias("net"),
        _state(F.col("income") - F.col("spend")).alias("state"),
    )
    return top_overall(result, [F.desc("net"), F.asc("league"), F.desc("spend")], top)
