"""Presentable rankings and comparisons over the large leagues."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import bucket, n_distinct, per_90, ratio, scaled, sum_case, sum_where
from starmart.operators import (
    aggregate,
    balance,
    dice,
    drill_across,
    exact_median,
    order,
    period_change,
    share_of_total,
    tally,
    top_overall,
    top_per_group,
    with_ties,
)
from starmart.plans.common import (
    BIG_FIVE,
    Mart,
    fact,
    name_list,
    named,
    player_keys,
    with_calendar,
    with_club_league,
    with_league,
    with_person,
    with_player,
)

def _paid() -> Column:
    return F.col("transfer_fee") > 0


def _lines(mart: Mart, leagues) -> DataFrame:
    return dice(mart["fact_appearances"], {"competition_id": list(leagues)})


def q09_1(mart: Mart, leagues=BIG_FIVE, top: int = 25, split_homonyms: bool = False) -> DataFrame:
    """Top scorers with their leagues, clubs, and goals per match and per 90 minutes."""
    keys = ["player", "position", "country"]
    lines = with_person(_lines(mart, leagues), mart, keys, split_homonyms)
    totals = tally(
        lines, ["person"], ["goals", "assists", "minutes_played"], {"games": "game_id"},
        {"_leagues": "competition_id", "_clubs": "club_id"},
    ).filter(F.col("goals") > 0)
    # Ties at the cut are broken by names, so rows with as many goals as the last come along.
    ordering = [F.desc("goals"), F.asc("player"), F.asc("position"), F.asc("country")]
    first = top_overall(named(with_ties(totals, [F.desc("goals")], top), mart, keys, split_homonyms), ordering, top, "rank")
    keys = player_keys(keys, split_homonyms)
    first = name_list(first, "_leagues", mart["dim_competitions"], "competition_id", "leagues")
    first = name_list(first, "_clubs", mart["dim_clubs"], "club_id", "clubs")
    return first.orderBy("rank").select(
        *keys, "goals", "assists", (F.col("goals") + F.col("assists")).alias("goal_involvements"), "games",
        ratio(F.col("goals"), F.col("games"), 2).alias("goals_per_game"), F.col("minutes_played").alias("minutes"),
        per_90(F.col("goals"), F.col("minutes_played"), 2).alias("goals_per_90"), "rank", "leagues", "clubs",
    )


def q09_2(mart: Mart, leagues=BIG_FIVE, top: int = 25, split_homonyms: bool = False) -> DataFrame:
    """Top assist makers."""
    keys = ["player", "position", "country"]
    lines = with_person(_lines(mart, leagues), mart, keys, split_homonyms)
    totals = tally(lines, ["person"], ["assists", "goals"], {"games": "game_id"}, {"_clubs": "club_id"})
    ordering = [F.desc("assists"), F.asc("player"), F.asc("position"), F.asc("country")]
    makers = with_ties(totals.filter(F.col("assists") > 0), [F.desc("assists")], top)
    first = top_overall(named(makers, mart, keys, split_homonyms), ordering, top, "rank")
    keys = player_keys(keys, split_homonyms)
    first = name_list(first, "_clubs", mart["dim_clubs"], "club_id", "clubs")
    return first.orderBy("rank").select(
        *keys, "assists", "goals", "games", ratio(F.col("assists"), F.col("games"), 2).alias("assists_per_game"), "rank", "clubs"
    )


def q09_3(mart: Mart, top: int = 20) -> DataFrame:
    """Dearest transfers, judged against the market value."""
    fee, value = F.col("transfer_fee"), F.col("market_value_in_eur")
    moves = mart["fact_transfers"].filter((fee > 0) & (value > 0))
    ordering = [F.desc("transfer_fee"), F.asc("player_name"), F.asc("from_club_name"), F.asc("to_club_name"),
                F.asc("transfer_date_id"), F.desc("market_value_in_eur")]
    first = with_calendar(top_overall(moves, ordering, top, "rank"), mart, "transfer_date_id", ["year"])
    verdict = (
        F.when(fee > value * F.lit(1.3).cast("decimal(2,1)"), "SOBREPAGADO")
        .when(fee < value * F.lit(0.7).cast("decimal(2,1)"), "GANGA")
        .otherwise("PRECIO JUSTO")
    )
    return first.orderBy("rank").select(
        "rank", F.col("player_name").alias("player"), "from_club_name", "to_club_name", "year",
        ratio(fee, F.lit(1_000_000)).alias("fee_m"), ratio(value, F.lit(1_000_000)).alias("market_value_m"),
        ratio(fee, value, 2).alias("fee_to_value"), verdict.alias("verdict"),
    )


def q09_4(mart: Mart, leagues=BIG_FIVE) -> DataFrame:
    """Home wins, draws and away wins per league."""
    games = dice(mart["fact_games"], {"competition_id": list(leagues)})
    flags = ("is_home_win", "is_draw", "is_away_win")
    by_league = aggregate(
        games, ["competition_id"],
        {
            "n": F.count(F.lit(1)),
            **{f"_{f}": sum_case(F.col(f)) for f in flags},
            "home_goals": F.sum("home_club_goals"),
            "away_goals": F.sum("away_club_goals"),
        },
    )
    n = F.sum("n")
    home, draw, away = (F.sum(f"_{f}") for f in flags)
    result = aggregate(
        with_league(by_league, mart), ["league"],
        {
            "games": n,
            "home_wins": home,
            "draws": draw,
            "away_wins": away,
            "home_win_pct": ratio(home, n, 1, factor=100),
            "draw_pct": ratio(draw, n, 1, factor=100),
            "away_win_pct": ratio(away, n, 1, factor=100),
            "home_goals_per_game": ratio(F.sum("home_goals"), n, 2),
            "away_goals_per_game": ratio(F.sum("away_goals"), n, 2),
        },
    )
    return order(result, [("home_win_pct", "desc", "last"), ("league", "asc", "last")])


def q09_5(mart: Mart, leagues=BIG_FIVE, seasons=(2015, 2024), split_homonyms: bool = False) -> DataFrame:
    """Top scorer of every league and season; ties are all kept."""
    lines = dice(fact(mart, "fact_appearances", seasons=seasons), {"competition_id": list(leagues)})
    lines = with_calendar(lines, mart, columns=["season_start_year"], seasons=seasons)
    lines = with_league(lines.withColumnRenamed("season_start_year", "season"), mart)
    lines = with_person(lines, mart, ["player"], split_homonyms)
    totals = tally(lines, ["league", "season", "person"], ["goals"], {"games": "game_id"}, {"_clubs": "club_id"})
    best = top_per_group(totals.filter(F.col("goals") > 0), ["league", "season"], [F.desc("goals")], how="rank")
    best = name_list(best, "_clubs", mart["dim_clubs"], "club_id", "clubs")
    result = named(best, mart, ["player"], split_homonyms).select(
        "league", "season", "player", "clubs", "goals", "games", ratio(F.col("goals"), F.col("games"), 2).alias("goals_per_game")
    )
    return order(result, [("league", "asc", "last"), ("season", "asc", "last"), ("player", "asc", "last")])


def club_balances(mart: Mart, leagues=BIG_FIVE) -> DataFrame:
    """Spend, income and net result in millions of every club of the leagues."""

    def side(key: str, amount: str) -> DataFrame:
        by_club = aggregate(mart["fact_transfers"], [key], {"fees": sum_where("transfer_fee", _paid())})
        named = with_club_league(by_club, mart, key, {"name": "league"}, club="club", leagues=leagues)
        return aggregate(named, ["club", "league"], {amount: F.sum("fees")})

    both = balance(side("to_club_id", "spend"), side("from_club_id", "income"), "club", ["league"], ["spend", "income"])
    net = F.col("income") - F.col("spend")
    return both.select(
        "club", "league", scaled(F.col("spend"), 1_000_000, 1).alias("spend_m"),
        scaled(F.col("income"), 1_000_000, 1).alias("income_m"), scaled(net, 1_000_000, 1).alias("net_m"),
        F.when(net > 0, "SUPERAVIT").otherwise("DEFICIT").alias("state"),
    )


def q09_6(mart: Mart, leagues=BIG_FIVE, top: int = 30) -> DataFrame:
    """The clubs with the worst transfer balance."""
    return top_overall(club_balances(mart, leagues), [F.asc_nulls_last("net_m"), F.asc("club")], top)


# The minute bands and their names.
MINUTE_BANDS = (
    (1, 15, "01-15 (Inicio 1ª parte)"),
    (16, 30, "16-30 (Media 1ª parte)"),
    (31, 45, "31-45 (Final 1ª parte)"),
    (46, 60, "46-60 (Inicio 2ª parte)"),
    (61, 75, "61-75 (Media 2ª parte)"),
    (76, 90, "76-90 (Final 2ª parte)"),
    (91, None, "90+   (Tiempo añadido)"),
)


def q09_7(mart: Mart, leagues=BIG_FIVE, event_type: str = "Goals") -> DataFrame:
    """Goals per band of minutes and their share."""
    goals = dice(
        mart["fact_game_events"],
        {"type": event_type, "competition_id": list(leagues), "minute": lambda c: c > 0},
    )
    bands = aggregate(
        goals, [bucket("minute", MINUTE_BANDS, "Desconocido").alias("minute_band")],
        {"goals": F.count(F.lit(1)), "first_minute": F.min("minute")},
    )
    return share_of_total(bands, "goals", "share_pct", 1).orderBy("first_minute").drop("first_minute")


def q09_8(mart: Mart, leagues=BIG_FIVE, top: int = 10) -> DataFrame:
    """Nationalities with most goals, per player and per match."""
    lines = _lines(mart, leagues)
    players = mart["dim_players"].filter(F.col("country_of_citizenship") != "N/A")
    country = {"country_of_citizenship": "country"}
    by_player = aggregate(lines, ["player_id"], {"goals": F.sum("goals"), "assists": F.sum("assists")})
    totals = aggregate(
        with_player(by_player, mart, country, players), ["country"],
        {"players": F.count(F.lit(1)), "goals": F.sum("goals"), "assists": F.sum("assists")},
        having=F.col("goals") > 0,
    )
    games = aggregate(with_player(lines, mart, country, players), ["country"], {"games": n_distinct("game_id")})
    joined = drill_across([totals, games], ["country"], "inner").select(
        "country", "players", "goals", "assists",
        ratio(F.col("goals"), F.col("players"), 1).alias("goals_per_player"),
        ratio(F.col("goals"), F.col("games"), 2).alias("goals_per_game"),
    )
    return top_overall(joined, [F.desc("goals"), F.asc("country")], top, "rank")


def q09_9(mart: Mart, years=(2012, 2025), approx: bool = False) -> DataFrame:
    """Number, mean, median, maximum and total of the fees by year, in millions.

    The exact median is found by global position; ``approx`` uses a sketch in the same scan.
    """
    moves = with_calendar(mart["fact_transfers"], mart, "transfer_date_id", ["year"], years=years)
    fee = F.when(_paid(), F.col("transfer_fee"))
    aggs = {
        "transfers": F.count(fee),
        "mean_fee": ratio(F.sum(fee), F.count(fee) * 1_000_000, 2),
        "max_fee": scaled(F.max("transfer_fee"), 1_000_000, 1),
        "market": scaled(F.sum(fee), 1_000_000, 1),
    }
    if approx:
        aggs["median_fee"] = F.round(F.percentile_approx(fee, 0.5).cast("double") / 1_000_000, 2)
        by_year = aggregate(moves, ["year"], aggs)
    else:
        middle = exact_median(moves.filter(_paid()), ["year"], "transfer_fee", "_median")
        in_millions = F.round(F.col("_median").cast("decimal(18,3)") / 1_000_000, 2).alias("median_fee")
        by_year = drill_across([aggregate(moves, ["year"], aggs), middle.select("year", in_millions)], ["year"])
    changed = period_change(by_year, [], "year", "mean_fee", "_before", "change_pct", digits=1)
    return changed.orderBy("year").select(
        "year", "transfers", F.col("mean_fee").alias("mean_fee_m"), F.col("median_fee").alias("median_fee_m"),
        F.col("max_fee").alias("max_fee_m"), F.col("market").alias("market_m"), "change_pct",
    )


def q09_10(mart: Mart, leagues=BIG_FIVE) -> DataFrame:
    """Scorecard of the leagues from games, transfers and appearances."""
    seen = F.col("attendance") > 0
    n = F.count(F.lit(1))
    games = aggregate(
        dice(mart["fact_games"], {"competition_id": list(leagues)}), ["competition_id"],
        {
            "games": n,
            "goals": F.sum("total_goals"),
            "goals_per_game": ratio(F.sum("total_goals"), n, 2),
            "mean_attendance": ratio(sum_where("attendance", seen), F.count_if(seen), 0),
        },
    )
    by_club = aggregate(
        mart["fact_transfers"], ["to_club_id"],
        {"fees": sum_where("transfer_fee", _paid()), "priced": F.count_if(_paid())},
    )
    moves = with_club_league(by_club, mart, "to_club_id", {"competition_id": "competition_id"}, leagues=leagues)
    transfers = aggregate(
        moves, ["competition_id"],
        {
            "transfers": F.sum("priced"),
            "spend_bn": scaled(F.sum("fees"), 1_000_000_000, 2),
            "mean_fee_m": ratio(F.sum("fees"), F.sum("priced") * 1_000_000, 2),
        },
    )
    cards = aggregate(
        _lines(mart, leagues), ["competition_id"],
        {
            "yellow_cards": F.sum("yellow_cards"),
            "red_cards": F.sum("red_cards"),
            "yellow_pct": ratio(F.sum("yellow_cards"), n, 2, factor=100),
        },
    )
    result = with_league(drill_across([games, transfers, cards], ["competition_id"]), mart).select(
        "league", "games", "goals", "goals_per_game", "mean_attendance", "transfers", "spend_bn", "mean_fee_m",
        "yellow_cards", "red_cards", "yellow_pct",
    )
    return order(result, [("goals", "desc", "last"), ("league", "asc", "last")])
