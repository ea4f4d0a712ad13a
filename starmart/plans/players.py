"""Profiles of players: use, captaincy, clubs, value jumps, foot."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import count_where, n_distinct, per_90, ratio, scaled, sum_where
from starmart.operators import (
    aggregate,
    dice,
    known,
    order,
    period_change,
    tally,
    tile_of,
    top_overall,
    with_ties,
)
from starmart.plans.common import (
    BIG_FIVE,
    PLAYER,
    UNNAMED,
    Mart,
    fact,
    name_list,
    named,
    player_keys,
    with_calendar,
    with_person,
    with_player,
)
from starmart.session import cut_lineage


def _lines(mart: Mart, leagues) -> DataFrame:
    return dice(mart["fact_appearances"], {"competition_id": list(leagues)})


def _positioned(mart: Mart) -> DataFrame:
    return mart["dim_players"].filter(~F.col("position").isin(*UNNAMED))


def q11_1(
    mart: Mart, leagues=BIG_FIVE, min_games: int = 100, top: int = 20, split_homonyms: bool = False
) -> DataFrame:
    """Most used players with their share of starts and their quartile of use.

    The quartile counts all qualified players. The rows shown are the first of the same order, so
    their position and the number of qualified players give it without ranking the rest. The
    qualified players are written once, as they are both counted and ranked.
    """
    lines = with_player(_lines(mart, leagues), mart, PLAYER)
    starts = count_where(F.col("type") == "starting_lineup")
    used = aggregate(
        lines, player_keys(["player", "position", "country"], split_homonyms),
        {
            "games": n_distinct("game_id"),
            "minutes": F.sum("minutes_played"),
            "minutes_per_game": ratio(F.sum("minutes_played"), F.count("minutes_played"), 0),
            "goals": F.sum("goals"),
            "assists": F.sum("assists"),
            "starts": starts,
            "from_bench": count_where(F.col("type") == "substitutes"),
            "start_pct": ratio(starts, F.count(F.lit(1)), 1, factor=100),
        },
        having=F.col("games") >= min_games,
    )
    ordering = [F.desc("games"), F.asc("player"), F.asc("position"), F.asc("country")]
    used = cut_lineage(used)
    qualified = used.agg(F.count(F.lit(1))).scalar()
    first = top_overall(used, ordering, top, "rank")
    return first.withColumn("use_quartile", tile_of(F.col("rank"), qualified, 4))


def q11_2(mart: Mart, leagues=BIG_FIVE, as_published: bool = False) -> DataFrame:
    """Output per match as captain and not, by position.

    The published query divides the goals of all matches by the captain's (or other) matches alone;
    ``as_published`` repeats that, the default counts the same matches above and below.
    """
    lines = _lines(mart, leagues).filter(F.col("minutes_played") > 0)
    lines = with_player(lines, mart, {"position": "position"}, _positioned(mart))
    by_role = aggregate(
        lines, ["position", "team_captain"],
        {
            "games": n_distinct("game_id"),
            "goals": F.sum("goals"),
            "assists": F.sum("assists"),
            "yellow_cards": F.sum("yellow_cards"),
        },
    )
    roles = {"normal": ~F.col("team_captain"), "captain": F.col("team_captain")}

    def games(role: str):
        return sum_where("games", roles[role])

    def per_game(measure: str, role: str, digits: int | None = 3):
        amount = F.sum(measure) if as_published else sum_where(measure, roles[role])
        return ratio(amount, games(role), digits)

    def exact(role: str):
        amount = F.sum("goals") if as_published else sum_where("goals", roles[role])
        return amount.cast("decimal(20,0)") / F.nullif(games(role), F.lit(0)).cast("decimal(18,0)")

    result = aggregate(
        by_role, ["position"],
        {
            "games_normal": games("normal"),
            "goals_per_game_normal": per_game("goals", "normal"),
            "assists_per_game_normal": per_game("assists", "normal"),
            "games_captain": games("captain"),
            "goals_per_game_captain": per_game("goals", "captain"),
            "assists_per_game_captain": per_game("assists", "captain"),
            "goals_per_game_delta": F.round(exact("captain") - exact("normal"), 3),
            "yellow_per_game_normal": per_game("yellow_cards", "normal"),
            "yellow_per_game_captain": per_game("yellow_cards", "captain"),
        },
    )
    return order(result, [("position", "asc", "last")])


def q11_3(
    mart: Mart, leagues=BIG_FIVE, min_clubs: int = 4, top: int = 25, split_homonyms: bool = False
) -> DataFrame:
    """Players with many clubs: their clubs, leagues and seasons."""
    keys = ["player", "position", "country"]
    lines = with_person(known(_lines(mart, leagues), "club_id"), mart, keys, split_homonyms)
    lines = with_calendar(lines, mart, columns=["season_start_year"])
    distinct = {"clubs": "club_id", "leagues": "competition_id", "seasons": "season_start_year", "games": "game_id"}
    totals = tally(lines, ["person"], ["goals", "assists"], distinct, {"_clubs": "club_id"}).filter(F.col("clubs") >= min_clubs)
    # Ties at the cut are broken by names, so rows level with the last come along.
    counts = [F.desc("clubs"), F.desc("games")]
    ordering = [*counts, F.asc("player"), F.asc("position"), F.asc("country")]
    first = top_overall(named(with_ties(totals, counts, top), mart, keys, split_homonyms), ordering, top, "rank")
    return name_list(first, "_clubs", mart["dim_clubs"], "club_id", "club_list", " --> ").orderBy("rank")


def q11_4(
    mart: Mart, years=(2015, 2024), min_value: int = 1_000_000, top: int = 20, strict: bool = False
) -> DataFrame:
    """Largest rises of a player's yearly maximum value, with the direction afterwards."""
    values = with_calendar(
        fact(mart, "fact_player_valuations", years).filter(F.col("market_value_in_eur") > 0), mart, years=years
    )
    values = values.filter(F.col("player_id") != -1).withColumn("year", F.floor(F.col("date_id") / 10000).cast("int"))
    yearly = aggregate(values, ["player_id", "year"], {"value": F.max("market_value_in_eur")})
    moved = period_change(
        yearly, ["player_id"], "year", "value", "before", "rise_pct", following="after", digits=1, strict=strict
    )
    value, before, after = F.col("value"), F.col("before"), F.col("after")
    risen = moved.filter(before.isNotNull() & (before > min_value) & (value > before))
    named = with_player(risen, mart, PLAYER)
    ordering = [F.desc("rise_pct"), F.asc("player_id"), F.asc("year")]
    first = top_overall(named, ordering, top, "rank")
    return first.orderBy("rank").select(
        "rank", "player", "position", "country", "year",
        scaled(before, 1_000_000, 1).alias("from_m"), scaled(value, 1_000_000, 1).alias("to_m"), "rise_pct",
        scaled(value - before, 1_000_000, 1).alias("rise_m"),
        F.when(after > value, "SIGUE SUBIENDO").when(after < value, "Corrigio despues").otherwise("-").alias("next_year"),
    )


def q11_5(mart: Mart, leagues=BIG_FIVE, feet=("left", "right", "both")) -> DataFrame:
    """Output per 90 minutes by preferred foot, one row per position."""
    lines = _lines(mart, leagues).filter(F.col("minutes_played") > 0)
    measures = {"goals": "goals", "assists": "assists", "yellow": "yellow_cards"}
    by_player = aggregate(
        lines, ["player_id"],
        {"minutes": F.sum("minutes_played"), **{name: F.sum(column) for name, column in measures.items()}},
    )
    players = dice(_positioned(mart), {"foot": list(feet)})
    rows = with_player(by_player, mart, {"position": "position", "foot": "foot"}, players)
    aggs = {f"players_{foot}": F.count_if(F.col("foot") == foot) for foot in feet}
    for measure in measures:
        for foot in feet:
            if measure == "yellow" and foot == "both":
                continue  # the report has no such column
            mine = F.col("foot") == foot
            aggs[f"{measure}_per_90_{foot}"] = per_90(sum_where(measure, mine), sum_where("minutes", mine), 3)
    return order(aggregate(rows, ["position"], aggs), [("position", "asc", "last")])
