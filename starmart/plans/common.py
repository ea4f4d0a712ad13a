"""What the reports share: the default leagues and the joins to the calendar and dimensions.

The load keeps every foreign key valid, so a dimension is joined only where a report uses one of
its columns. Filters on years and seasons are also put on the fact's own date key, where they
reach the scan.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import string_list
from starmart.operators import aggregate, dice, known, star_join
from starmart.sources import Warehouse

Mart = Mapping[str, DataFrame]
Span = tuple[int, int]

# Competition codes of the five large leagues.
BIG_FIVE = ("ES1", "GB1", "IT1", "FR1", "L1")

UNNAMED = ("Unknown", "N/A")  # markers of an unknown text

# Attributes that identify a player in a report, and their names there.
PLAYER = {"name": "player", "position": "position", "country_of_citizenship": "country"}


def fact(mart: Mart, name: str, years: Span | None = None, seasons: Span | None = None) -> DataFrame:
    """A fact without the year folders that a span of years or seasons cannot be in.

    Where the facts of a mart lie in no folders, all rows; ``with_calendar`` filters the dates.
    """
    spans = [*([years] if years else []), *([(seasons[0], seasons[1] + 1)] if seasons else [])]
    if not spans or not isinstance(mart, Warehouse):
        return mart[name]
    return mart.in_years(name, max(a for a, _ in spans), min(b for _, b in spans))


def with_calendar(
    df: DataFrame,
    mart: Mart,
    date_key: str = "date_id",
    columns: Sequence[str] = (),
    years: Span | None = None,
    seasons: Span | None = None,
) -> DataFrame:
    """Restrict a fact to a span of years or seasons and add calendar columns."""
    key = F.col(date_key)
    if years:
        df = df.filter(key.between(years[0] * 10000 + 101, years[1] * 10000 + 1231))
    if seasons:
        df = df.filter(key.between(seasons[0] * 10000 + 701, (seasons[1] + 1) * 10000 + 630))
    if not columns:
        return df
    return star_join(df, [(date_key, mart["dim_date"], "date_id", {c: c for c in columns})])


def with_league(df: DataFrame, mart: Mart, how: str = "inner", name: str = "league", **more: str) -> DataFrame:
    """Add the name of ``competition_id``; ``more`` names further columns, output name first."""
    attributes = {"name": name, **{source: target for target, source in more.items()}}
    return star_join(df, [("competition_id", mart["dim_competitions"], "competition_id", attributes)], how)


def with_club(df: DataFrame, mart: Mart, key: str = "club_id", name: str = "club") -> DataFrame:
    """Add the name of a club role and drop the rows of the unknown club."""
    return star_join(known(df, key), [(key, mart["dim_clubs"], "club_id", {"name": name})])


def with_club_league(
    df: DataFrame, mart: Mart, key: str, attributes: Mapping[str, str], club: str | None = None,
    leagues: Sequence[str] | None = None,
) -> DataFrame:
    """Add attributes of the league a club role plays in at home, NULL without one.

    ``leagues`` keeps only clubs of these leagues, which the club dimension decides alone.
    """
    columns = {"domestic_competition_id": "_home_league", **({"name": club} if club else {})}
    clubs = mart["dim_clubs"]
    if leagues is not None:
        clubs = dice(clubs, {"domestic_competition_id": list(leagues)})
    df = star_join(known(df, key), [(key, clubs, "club_id", columns)])
    how = "inner" if leagues is not None else "left"
    league = [("_home_league", mart["dim_competitions"], "competition_id", attributes)]
    return star_join(df, league, how).drop("_home_league")


def with_player(
    df: DataFrame, mart: Mart, attributes: Mapping[str, str], players: DataFrame | None = None
) -> DataFrame:
    """Add player attributes and drop the rows of the unknown player."""
    players = mart["dim_players"] if players is None else players
    return star_join(known(df, "player_id"), [("player_id", players, "player_id", attributes)])


def player_keys(keys: Sequence[str], split_homonyms: bool) -> list[str]:
    """Grouping keys of a player report; by name alone, players of one name count as one."""
    return [*keys, "player_id"] if split_homonyms else list(keys)


def persons(mart: Mart, keys: Sequence[str], split_homonyms: bool = False) -> DataFrame:
    """The players' dictionary: of each player the smallest id with the same ``keys`` (names of PLAYER).

    Facts are grouped by this one number, ``person``; names come back for the rows a report returns.
    """
    players = known(mart["dim_players"], "player_id")
    columns = [c for c, name in PLAYER.items() if name in keys]
    if split_homonyms:
        return players.select("player_id", F.col("player_id").alias("person"))
    first = aggregate(players, [F.col(c).alias(f"_{c}") for c in columns], {"person": F.min("player_id")})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]
    return players.join(first, same).select("player_id", "person")


def with_person(df: DataFrame, mart: Mart, keys: Sequence[str], split_homonyms: bool) -> DataFrame:
    """Add the person of each line and drop the lines of the unknown player."""
    return star_join(known(df, "player_id"), [("player_id", persons(mart, keys, split_homonyms), "player_id", {"person": "person"})])


def named(df: DataFrame, mart: Mart, keys: Sequence[str], split_homonyms: bool) -> DataFrame:
    """Replace the person of a few rows by the names in ``keys``, and the id where homonyms are split."""
    attributes = {c: name for c, name in PLAYER.items() if name in keys}
    rows = star_join(df, [("person", mart["dim_players"], "player_id", attributes)])
    return rows.withColumnRenamed("person", "player_id") if split_homonyms else rows.drop("person")


def name_list(df: DataFrame, column: str, dim: DataFrame, key: str, name: str, separator: str = ", ") -> DataFrame:
    """Replace an array of ids, in a few different rows, by the sorted distinct names of these, joined; NULL without any."""
    others = [c for c in df.columns if c != column]
    ids = df.select(*others, F.explode_outer(column).alias("_id"))
    names = star_join(ids, [("_id", dim, key, {"name": "_name"})], "left")
    return aggregate(names, others, {name: F.nullif(string_list("_name", separator), F.lit(""))})
