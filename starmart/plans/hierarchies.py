"""Roll-ups and drill-downs along time, geography, sport and market value."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import concat_text, matches, n_distinct, period_label, ratio, sum_where
from starmart.operators import aggregate, dice, drill_down, order, roll_up, slice_, star_join, top_overall
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


def q03_1(mart: Mart, years=(2020, 2024)) -> DataFrame:
    """Goals by month, quarter, year and in total."""
    by_day = aggregate(
        with_calendar(fact(mart, "fact_games", years), mart, years=years), ["date_id"],
        {"goals": F.sum("total_goals"), "games": F.count(F.lit(1))},
    )
    days = with_calendar(by_day, mart, columns=["year", "quarter", "month"])
    result = roll_up(
        days, ["year", "quarter", "month"],
        {
            "goals": F.sum("goals"),
            "games": F.sum("games"),
            "goals_per_game": ratio(F.sum("goals"), F.sum("games"), 2),
        },
    )
    return order(result, [(c, "asc", "last") for c in ("year", "quarter", "month")])


def q03_2(mart: Mart) -> DataFrame:
    """Income from sold players by club, league, confederation and in total."""
    sales = mart["fact_transfers"].filter(F.col("transfer_fee") > 0)
    by_club = aggregate(
        sales, ["from_club_id"], {"n": F.count(F.lit(1)), "fees": F.sum("transfer_fee")}
    )
    named = with_club_league(
        by_club, mart, "from_club_id", {"confederation": "confederation", "name": "league"}, club="club"
    )
    result = roll_up(
        named, ["confederation", "league", "club"],
        {"sales": F.sum("n"), "income": F.sum("fees"), "mean_income": ratio(F.sum("fees"), F.sum("n"), 2)},
    )
    return order(
        result,
        [("confederation", "asc", "last"), ("league", "asc", "last"), ("income", "desc", "last"), ("club", "asc", "last")],
    )


def q03_3(mart: Mart, leagues=BIG_FIVE) -> DataFrame:
    """Goals by player, country, position and in total, with distinct games at every level."""
    lines = dice(mart["fact_appearances"], {"competition_id": list(leagues)})
    players = mart["dim_players"].filter(F.col("position") != "N/A")
    lines = with_player(
        lines, mart, {"position": "position", "country_of_citizenship": "country", "name": "player"}, players
    )
    result = roll_up(
        lines, ["position", "country", "player"],
        {"goals": F.sum("goals"), "assists": F.sum("assists"), "games": n_distinct("game_id")},
    ).filter(F.col("goals") > 0)
    return order(
        result,
        [("position", "asc", "last"), ("country", "asc", "last"), ("goals", "desc", "last"), ("player", "asc", "last")],
    )


def _attendance(mart: Mart, competition: str, years, path) -> DataFrame:
    games = with_calendar(slice_(fact(mart, "fact_games", years), "competition_id", competition), mart, years=years)
    seen = F.col("attendance") > 0
    by_day = aggregate(
        games, ["date_id"],
        {"people": sum_where("attendance", seen), "counted": F.count_if(seen), "n": F.count(F.lit(1))},
    )
    days = with_calendar(by_day, mart, columns=["year", "quarter", "month", "month_name"])
    return drill_down(
        days, ["year", "quarter", "month"], path,
        {
            "mean_attendance": ratio(F.sum("people"), F.sum("counted"), 0),
            "attendance": F.sum("people"),
            "games": F.sum("n"),
            "month_name": F.min("month_name"),
        },
    )


def _level(result: DataFrame, level: str, period, sort: str) -> DataFrame:
    return result.orderBy(sort).select(
        F.lit(level).alias("level"), period.alias("period"), "mean_attendance", "attendance", "games"
    )


def q04_1a(mart: Mart, competition: str = "GB1", years=(2018, 2024)) -> DataFrame:
    """Attendance in one competition by year."""
    result = _attendance(mart, competition, years, ())
    return _level(result, "Nivel 1: Año", F.col("year").cast("string"), "year")


def q04_1b(mart: Mart, competition: str = "GB1", year: int = 2023) -> DataFrame:
    """Attendance by quarter of one year."""
    result = _attendance(mart, competition, (year, year), (year,))
    return _level(result, "Nivel 2: Trimestre", concat_text(F.col("year"), F.lit("-Q"), F.col("quarter")), "quarter")


def q04_1c(mart: Mart, competition: str = "GB1", year: int = 2023, quarter: int = 1) -> DataFrame:
    """Attendance by month of one quarter."""
    result = _attendance(mart, competition, (year, year), (year, quarter))
    return _level(result, "Nivel 3: Mes", period_label("year", "month", "month_name"), "month")


def _at(df: DataFrame, level: str) -> DataFrame:
    """Name the level of a drill-down in a first column."""
    return df.select(F.lit(level).alias("level"), *df.columns)


def q04_2a(mart: Mart, leagues=BIG_FIVE, season: int = 2022) -> DataFrame:
    """Goals of one season by league."""
    lines = with_calendar(
        dice(fact(mart, "fact_appearances", seasons=(season, season)), {"competition_id": list(leagues)}), mart, seasons=(season, season)
    )
    by_league = aggregate(lines, ["competition_id"], {"n": F.sum("goals")})
    result = aggregate(with_league(by_league, mart), ["league"], {"goals": F.sum("n")})
    return order(_at(result, "Nivel 1: Liga"), [("goals", "desc", "last"), ("league", "asc", "last")])


def q04_2b(mart: Mart, competition: str = "ES1", season: int = 2022, top: int = 15) -> DataFrame:
    """Goals and distinct players of the clubs of one league."""
    lines = with_calendar(
        slice_(fact(mart, "fact_appearances", seasons=(season, season)), "competition_id", competition), mart, seasons=(season, season)
    )
    lines = lines.groupBy("club_id", "player_id").agg(F.sum("goals").alias("n"))
    named = lines.join(mart["dim_clubs"].select("club_id", F.col("name").alias("club")), "club_id")
    result = aggregate(
        named, ["club"], {"goals": F.sum("n"), "players": n_distinct("player_id")}, having=F.col("goals") > 0
    )
    return top_overall(_at(result, "Nivel 2: Club"), [F.desc("goals"), F.asc("club")], top)


def q04_2c(
    mart: Mart, competition: str = "ES1", season: int = 2022, club: str = "%Real Madrid%",
    split_homonyms: bool = False,
) -> DataFrame:
    """Goals, assists and minutes of the players of one club."""
    lines = with_calendar(
        slice_(fact(mart, "fact_appearances", seasons=(season, season)), "competition_id", competition), mart, seasons=(season, season)
    )
    chosen = mart["dim_clubs"].filter(matches("name", club)).select("club_id")
    lines = lines.join(chosen, "club_id", "left_semi")
    player = {"name": "player", "position": "position"}
    lines = star_join(lines, [("player_id", mart["dim_players"], "player_id", player)])
    result = aggregate(
        lines, player_keys(["player", "position"], split_homonyms),
        {
            "goals": F.sum("goals"),
            "assists": F.sum("assists"),
            "games": n_distinct("game_id"),
            "minutes": F.sum("minutes_played"),
        },
        having=F.col("goals") > 0,
    )
    result = _at(result, "Nivel 3: Jugador")
    return order(result, [("goals", "desc", "last"), ("player", "asc", "last"), ("position", "asc", "last")])


def _values(mart: Mart, year: int, month: int) -> DataFrame:
    first = year * 10000 + month * 100
    return fact(mart, "fact_player_valuations", (year, year)).filter(F.col("date_id").between(first + 1, first + 31))


def q04_3a(mart: Mart, year: int = 2024, month: int = 1) -> DataFrame:
    """Market value of one month by confederation."""
    rows = with_league(_values(mart, year, month), mart, confederation="confederation")
    result = aggregate(
        rows, ["confederation"],
        {
            "value": sum_where("market_value_in_eur", F.col("market_value_in_eur") > 0),
            "players": n_distinct("player_id"),
        },
    )
    result = _at(result, "Nivel 1: Confederacion")
    return order(result, [("value", "desc", "last"), ("confederation", "asc", "last")])


def q04_3b(
    mart: Mart, year: int = 2024, month: int = 1, confederation: str = "europa", top: int = 10
) -> DataFrame:
    """Market value of one month by league of one confederation."""
    rows = with_league(_values(mart, year, month), mart, confederation="confederation")
    rows = slice_(rows, "confederation", confederation)
    priced = F.col("market_value_in_eur") > 0
    result = aggregate(
        rows, ["league"],
        {
            "value": sum_where("market_value_in_eur", priced),
            "players": n_distinct("player_id"),
            "mean_value": ratio(sum_where("market_value_in_eur", priced), F.count_if(priced), 0),
        },
    )
    return top_overall(_at(result, "Nivel 2: Liga"), [F.desc_nulls_last("value"), F.asc("league")], top)
