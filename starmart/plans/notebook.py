"""Follow-up computations on report results: matrices, reference lines, best rows, trend, KPIs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import concat_text, date_text, label, leading_token, word
from starmart.operators import (
    arg_max,
    best_per_group,
    dedupe,
    extremes,
    kpi_ranking,
    medians,
    order,
    pivot_matrix,
    trend,
    with_mean,
)
from starmart.plans.common import BIG_FIVE, Mart
from starmart.plans.highlights import club_balances, q09_5, q09_7, q09_9, q09_10
from starmart.plans.teams import q12_2, q12_4, season_goals

# Short axis names of the minute bands.
BAND_LABELS = {
    "01-15": "01-15 Inicio 1ª",
    "16-30": "16-30 Medio 1ª",
    "31-45": "31-45 Final 1ª",
    "46-60": "46-60 Inicio 2ª",
    "61-75": "61-75 Medio 2ª",
    "76-90": "76-90 Final 2ª",
    "90+": "90+ Añadido",
}

# The KPIs compared between leagues; True where lower is better.
LEAGUE_KPIS = {"goals_per_game": False, "mean_attendance": False, "mean_fee_m": False, "yellow_pct": True}


def season_winners(mart: Mart, leagues=BIG_FIVE) -> DataFrame:
    """One top scorer per league and season: the first by name among equals."""
    return dedupe(q09_5(mart, leagues), ["league", "season"], [F.asc("player")])


def cell_text(name: str, amount: str) -> Column:
    """``Surname (n)`` for a matrix cell."""
    return F.format_string("%s (%d)", word(name, -1), F.col(amount))


def winner_matrix(mart: Mart, league_names: dict[str, str], leagues=BIG_FIVE) -> DataFrame:
    """Season by league with the winner's surname and goals; columns in the order given."""
    winners = season_winners(mart, leagues)
    return order(
        pivot_matrix(winners, "season", "league", cell_text("player", "goals"), league_names), [("season", "asc", "last")]
    )


def goals_matrix(mart: Mart, league_names: dict[str, str], leagues=BIG_FIVE) -> DataFrame:
    """Season by league with the winner's goals."""
    return order(
        pivot_matrix(season_winners(mart, leagues), "season", "league", "goals", league_names),
        [("season", "asc", "last")],
    )


def extreme_balances(mart: Mart, n: int = 12, leagues=BIG_FIVE) -> DataFrame:
    """The n worst and n best transfer balances, chosen among all clubs."""
    return order(extremes(club_balances(mart, leagues), "net_m", n, "club"), [("net_m", "asc", "last"), ("club", "asc", "last")])


def minute_bands(mart: Mart, leagues=BIG_FIVE) -> DataFrame:
    """Goals per minute band with short labels and the mean per band."""
    bands = with_mean(q09_7(mart, leagues), [], "goals", "mean_goals")
    return bands.select(
        label(leading_token("minute_band"), BAND_LABELS).alias("band"), "goals", "share_pct", "mean_goals"
    )


def dearest_year(mart: Mart) -> DataFrame:
    """The year with the highest mean fee."""
    return arg_max(q09_9(mart), "mean_fee_m", "year", ["year", "mean_fee_m"])


def season_lines(mart: Mart, leagues=BIG_FIVE) -> DataFrame:
    """Goals per season with each league's mean as reference."""
    return with_mean(season_goals(mart, leagues), ["league"], "goals", "mean_goals")


def best_seasons(mart: Mart, leagues=BIG_FIVE) -> DataFrame:
    """The season with most goals of every league."""
    return best_per_group(season_goals(mart, leagues), ["league"], [F.desc("goals"), F.asc("season")])


def spend_trend(mart: Mart) -> DataFrame:
    """Straight line of win rate on spend over the clubs of the spend report."""
    return trend(q12_2(mart), "spend_m", "win_pct")


def spend_thresholds(mart: Mart) -> DataFrame:
    """Median spend and win rate of the same clubs."""
    return medians(q12_2(mart), ["spend_m", "win_pct"])


def league_ranking(mart: Mart, leagues=BIG_FIVE) -> DataFrame:
    """Rank of every league on every KPI."""
    return kpi_ranking(q09_10(mart, leagues), "league", LEAGUE_KPIS)


def match_labels(mart: Mart, leagues=BIG_FIVE) -> DataFrame:
    """Score line and date text of the highest-scoring games."""
    score = concat_text(
        word("home", 1), F.lit("  "), F.col("home_goals"), F.lit(" – "), F.col("away_goals"), F.lit("  "), word("away", 1)
    )
    return q12_4(mart, leagues).select("rank", date_text("full_date").alias("date_text"), score.alias("match"), "total_goals")
