"""Windows over periods and the combined studies built on them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import matches, n_distinct, per_90, period_label, ratio, sum_case, sum_where
from starmart.operators import (
    aggregate,
    cube,
    dice,
    level_label,
    lookup_key,
    moving_avg,
    order,
    period_change,
    restrict_to_top,
    roll_up,
    running_total,
    slice_,
    tiers,
    top_overall,
    top_per_group,
)
from starmart.plans.common import (
    BIG_FIVE,
    UNNAMED,
    Mart,
    fact,
    player_keys,
    with_calendar,
    with_club,
    with_club_league,
    with_league,
    with_player,
)
from starmart.session import cut_lineage


def _paid():
    return F.col("transfer_fee") > 0


def q06_1(mart: Mart, club: str = "%Chelsea%", seasons=(2015, 2024)) -> DataFrame:
    """Spend of one club per season with its running total."""
    chosen = mart["dim_clubs"].filter(matches("name", club)).select(F.col("club_id").alias("to_club_id"))
    moves = mart["fact_transfers"].filter(F.col("transfer_season").between(*seasons))
    moves = moves.join(chosen, "to_club_id", "left_semi")
    spend = sum_where("transfer_fee", _paid())
    by_season = aggregate(
        moves, [F.col("transfer_season").alias("season")],
        {"transfers": F.count(F.lit(1)), "spend": spend, "mean_fee": ratio(spend, F.count_if(_paid()), 0)},
    )
    result = running_total(by_season, [], "season", "spend", "running_spend")
    return order(result, [("season", "asc", "last")])


def q06_2(mart: Mart, competition: str = "ES1", years=(2020, 2024), rows: int = 3) -> DataFrame:
    """Goals per match by month with a moving average."""
    games = with_calendar(slice_(fact(mart, "fact_games", years), "competition_id", competition), mart, years=years)
    by_day = aggregate(games, ["date_id"], {"goals": F.sum("total_goals"), "games": F.count(F.lit(1))})
    days = with_calendar(by_day, mart, columns=["year", "month"])
    by_month = aggregate(
        days, ["year", "month"],
        {
            "games": F.sum("games"),
            "goals": F.sum("goals"),
            "goals_per_game": ratio(F.sum("goals"), F.sum("games"), 2),
        },
    ).select(period_label("year", "month").alias("period"), "games", "goals", "goals_per_game")
    result = moving_avg(by_month, [], ["period"], "goals_per_game", rows, "moving_average", 2)
    return order(result, [("period", "asc", "last")])


def q06_3(mart: Mart, player: str = "%Mbapp%", strict: bool = False) -> DataFrame:
    """Highest market value per year of the players of one name, and its change."""
    chosen = mart["dim_players"].filter(matches("name", player)).select("player_id")
    values = mart["fact_player_valuations"].filter(F.col("market_value_in_eur") > 0)
    values = values.join(chosen, "player_id", "left_semi")
    by_day = aggregate(values, ["date_id"], {"value": F.max("market_value_in_eur")})
    by_year = aggregate(with_calendar(by_day, mart, columns=["year"]), ["year"], {"value": F.max("value")})
    result = period_change(by_year, [], "year", "value", "previous_value", "change_pct", digits=1, strict=strict)
    return order(result, [("year", "asc", "last")])


# Names of the four scoring tiers.
TIER_NAMES = {1: "Tier 1 (Elite)", 2: "Tier 2 (Alto)", 3: "Tier 3 (Medio)", 4: "Tier 4 (Bajo)"}


def q06_4(
    mart: Mart, leagues=BIG_FIVE, positions=("Attack", "Midfield"), split_homonyms: bool = False
) -> DataFrame:
    """Scoring players in four tiers of equal size, with the goals of each tier."""
    lines = dice(mart["fact_appearances"], {"competition_id": list(leagues)})
    by_player = aggregate(lines, ["player_id"], {"goals": F.sum("goals")})
    players = dice(mart["dim_players"], {"position": list(positions)})
    named = with_player(by_player, mart, {"name": "player"}, players)
    scorers = aggregate(
        named, player_keys(["player"], split_homonyms), {"goals": F.sum("goals")}, having=F.col("goals") > 0
    )
    ties = [F.asc("player_id")] if split_homonyms else []
    tiered = tiers(scorers, [F.desc_nulls_last("goals"), F.asc("player"), *ties], 4)
    name = F.lit(None).cast("string")
    for tier, text in TIER_NAMES.items():
        name = F.when(F.col("tier") == tier, text).otherwise(name)
    result = aggregate(
        tiered, ["tier"],
        {
            "category": F.min(name),
            "players": F.count(F.lit(1)),
            "min_goals": F.min("goals"),
            "max_goals": F.max("goals"),
            "mean_goals": ratio(F.sum("goals"), F.count(F.lit(1)), 1),
        },
    )
    return result.orderBy("tier").drop("tier")


def q06_5(mart: Mart, leagues=BIG_FIVE, split_homonyms: bool = False) -> DataFrame:
    """Best scorer of every club in every league."""
    lines = with_league(dice(mart["fact_appearances"], {"competition_id": list(leagues)}), mart)
    lines = with_player(with_club(lines, mart), mart, {"name": "player", "position": "position"})
    scorers = aggregate(
        lines, player_keys(["league", "club", "player", "position"], split_homonyms),
        {"goals": F.sum("goals"), "games": n_distinct("game_id")},
        having=F.col("goals") > 0,
    )
    best = top_per_group(
        scorers, ["league", "club"], [F.desc("goals"), F.asc("player"), F.asc("position")]
    )
    result = best.select("league", "club", "player", "position", "goals", "games")
    return order(result, [("league", "asc", "last"), ("goals", "desc", "last"), ("club", "asc", "last")])


def q08_1(mart: Mart, competition: str = "ES1", top: int = 5, years=(2022, 2024), rows: int = 6) -> DataFrame:
    """Monthly market value of the most valuable players of a league, with a moving average."""
    values = mart["fact_player_valuations"]
    in_league = slice_(values, "competition_id", competition).filter(F.col("market_value_in_eur") > 0)
    peaks = aggregate(in_league, ["player_id"], {"peak": F.max("market_value_in_eur")})
    named = peaks.join(mart["dim_players"].select("player_id", F.col("name").alias("player")), "player_id")
    recent = with_calendar(fact(mart, "fact_player_valuations", years), mart, years=years)
    chosen = restrict_to_top(
        recent, named, "player_id", top, [F.desc("peak"), F.asc("player_id")]
    )
    days = with_calendar(chosen, mart, columns=["year", "month"])
    by_month = aggregate(days, ["player", "year", "month"], {"value": F.max("market_value_in_eur")})
    result = moving_avg(by_month, ["player"], ["year", "month"], "value", rows, "moving_average", 0)
    result = result.select("player", period_label("year", "month").alias("period"), "value", "moving_average")
    return order(result, [("player", "asc", "last"), ("period", "asc", "last")])


def q08_2(mart: Mart, leagues=BIG_FIVE, types=("starting_lineup", "substitutes")) -> DataFrame:
    """Goals per 90 minutes of starters and substitutes, by league and over all leagues."""
    lines = dice(
        mart["fact_appearances"],
        {"competition_id": list(leagues), "type": list(types), "minutes_played": lambda c: c > 0},
    )
    by_league = aggregate(
        lines, ["competition_id", "type"],
        {"n": F.count(F.lit(1)), "goals": F.sum("goals"), "minutes": F.sum("minutes_played")},
    )
    result = roll_up(
        with_league(by_league, mart), ["league"],
        {
            "label": level_label("league", "** TOTAL BIG FIVE **"),
            "is_total": F.grouping("league"),
            "appearances": F.sum("n"),
            "goals": F.sum("goals"),
            "minutes": F.sum("minutes"),
            "goals_per_90": per_90(F.sum("goals"), F.sum("minutes"), 3),
        },
        fixed=["type"],
    )
    return order(result, [("is_total", "asc", "last"), ("label", "asc", "last"), ("type", "asc", "last")]).select(
        F.col("label").alias("league"), "type", "appearances", "goals", "minutes", "goals_per_90"
    )


def q08_3(mart: Mart, leagues=BIG_FIVE, seasons=(2016, 2024)) -> DataFrame:
    """Spend per league and season against the season before."""
    moves = mart["fact_transfers"].filter(F.col("transfer_season").between(*seasons))
    by_club = aggregate(
        moves, ["to_club_id", "transfer_season"], {"fees": sum_where("transfer_fee", _paid())}
    )
    named = with_club_league(by_club, mart, "to_club_id", {"name": "league"}, leagues=leagues)
    by_season = aggregate(
        named, ["league", F.col("transfer_season").alias("season")], {"spend": F.sum("fees")}
    )
    changed = period_change(by_season, ["league"], "season", "spend", "previous_spend", "change_pct", digits=1)
    spend, previous = F.col("spend"), F.col("previous_spend")
    result = changed.filter(previous.isNotNull()).withColumn(
        "trend", F.when(spend > previous, "SUBE").when(spend < previous, "BAJA").otherwise("--> ESTABLE")
    )
    return order(result, [("league", "asc", "last"), ("season", "asc", "last")])


def q08_4a(mart: Mart, leagues=BIG_FIVE) -> DataFrame:
    """Cards by position and league at all four grouping levels."""
    lines = dice(mart["fact_appearances"], {"competition_id": list(leagues)})
    lines = lines.filter(~F.col("position").isin(*UNNAMED))
    by_league = aggregate(
        lines, ["position", "competition_id"],
        {"yellow": F.sum("yellow_cards"), "red": F.sum("red_cards"), "n": F.count(F.lit(1))},
    )
    result = cube(
        with_league(by_league, mart), ["position", "league"],
        {
            "position_label": level_label("position", "** TODAS **"),
            "league_label": level_label("league", "** TODAS LAS LIGAS **"),
            "levels": F.grouping_id(),
            "yellow_cards": F.sum("yellow"),
            "red_cards": F.sum("red"),
            "cards": F.sum(F.col("yellow") + F.col("red")),
            "appearances": F.sum("n"),
            "yellow_pct": ratio(F.sum("yellow"), F.sum("n"), 2, factor=100),
        },
    ).filter(F.col("cards") > 0)
    return order(result, [("levels", "asc", "last"), ("cards", "desc", "last")]).select(
        F.col("position_label").alias("position"), F.col("league_label").alias("league"), "yellow_cards",
        "red_cards", "cards", "appearances", "yellow_pct",
    )


def q08_4b(mart: Mart, leagues=BIG_FIVE, ranks: int = 10, split_homonyms: bool = False) -> DataFrame:
    """Most booked players: everyone at one of the highest distinct card counts.

    The players' totals are written once, as they are both searched and joined back.
    """
    lines = with_league(dice(mart["fact_appearances"], {"competition_id": list(leagues)}), mart)
    lines = with_player(lines, mart, {"name": "player", "position": "position"})
    booked = aggregate(
        lines, player_keys(["player", "position", "league"], split_homonyms),
        {
            "yellow_cards": F.sum("yellow_cards"),
            "red_cards": F.sum("red_cards"),
            "cards": F.sum(F.col("yellow_cards") + F.col("red_cards")),
            "games": n_distinct("game_id"),
        },
    )
    first = top_overall(cut_lineage(booked), [], ranks, how="dense_rank", by="cards")
    result = first.select(
        "player", "position", "league", "yellow_cards", "red_cards", "cards", "games",
        ratio(F.col("yellow_cards"), F.col("games"), 1, factor=100).alias("yellow_pct"),
    )
    return order(result, [("cards", "desc", "last"), ("player", "asc", "last"), ("league", "asc", "last")])


def q08_5(mart: Mart, competition: str = "ES1", season: int = 2023, club: str = "%Real Madrid%") -> DataFrame:
    """Month-by-month record of one club in one season, with running totals."""
    games = with_calendar(
        slice_(fact(mart, "fact_games", seasons=(season, season)), "competition_id", competition), mart, seasons=(season, season)
    )
    own = lookup_key(mart["dim_clubs"], "name", club, "club_id")
    games = games.withColumn("_club", own)
    home = F.col("home_club_id") == F.col("_club")
    away = F.col("away_club_id") == F.col("_club")
    won = (F.col("is_home_win") & home) | (F.col("is_away_win") & away)
    games = games.filter(home | away)
    by_day = aggregate(
        games, ["date_id"],
        {
            "n": F.count(F.lit(1)),
            "won": sum_case(won),
            "drawn": sum_case(F.col("is_draw")),
            "scored": F.sum(F.when(home, F.col("home_club_goals")).otherwise(F.col("away_club_goals"))),
            "conceded": F.sum(F.when(home, F.col("away_club_goals")).otherwise(F.col("home_club_goals"))),
        },
    )
    days = with_calendar(by_day, mart, columns=["month", "month_name"])
    monthly = aggregate(
        days, ["month", "month_name"],
        {
            "games": F.sum("n"),
            "wins": F.sum("won"),
            "draws": F.sum("drawn"),
            "goals_for": F.sum("scored"),
            "goals_against": F.sum("conceded"),
        },
    )
    totals = running_total(monthly, [], "month", "wins", "running_wins")
    totals = running_total(totals, [], "month", "goals_for", "running_goals")
    return totals.orderBy("month").select(
        "month_name", "games", "wins", "draws",
        (F.col("games") - F.col("wins") - F.col("draws")).alias("losses"),
        "goals_for", "goals_against",
        (F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
        "running_wins", "running_goals",
    )
