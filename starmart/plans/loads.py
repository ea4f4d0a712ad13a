"""Load jobs of the ten warehouse tables.

Every ``mark_*`` takes source rows as text and the already loaded parents and returns the rows of the
table with the rule that rejects them, if one does; ``build_*`` returns the finished table as one
lazy plan. ``load_*`` stage the CSV as Parquet in one parse, build and write, counting rejected rows
while they write. The order of the steps differs from table to table on purpose: games, appearances,
events and valuations fill NULLs before the key checks, so a NULL club becomes the unknown club and
stays; transfers check first and fill last.
"""

import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart.functions import clean_text, date_id, money, null_unless, season_start, to_date_lenient, to_number
from starmart.operators.joins import counted_side, union_all
from starmart.operators.ledger import ADDED, REJECT, accepted, accepted_and_counted, reject_missing, reject_orphans
from starmart.operators.loading import (
    add_unknown_member,
    apply_null_rules,
    dedupe,
    derive_outcome,
    detect_date_formats,
    enrich,
    file_order_key,
    first_available,
    iso_dates,
    redirect_fk,
    rename,
    select_available,
    truncate_text,
    widen_by_role,
    with_file_order_key,
)
from starmart.operators.quality import key_check, load_rate, null_audit, orphan_counts, verify_derived
from starmart.schemas import NULL_DEFAULTS, NULL_RULES, TABLES, TEXT_DEFAULTS, unknown_member
from starmart.session import remove_folder, shuffles_removed
from starmart.sources.calendar import date_dimension
from starmart.sources.csv import BAD_LINE, OPEN_QUOTE, ROW_ORDER, read_csv, read_csv_lines
from starmart.sources.tables import (
    FOLDERS,
    Warehouse,
    current_root,
    in_folders,
    load_metrics,
    publish,
    read_table,
    write_folders,
    write_table,
)

# Text limits of the game dimension.
GAME_TEXT_LIMITS = {
    "home_club_formation": 20,
    "away_club_formation": 20,
    "aggregate": 20,
    "round": 50,
    "competition_type": 50,
}


def _typed(df: DataFrame, table: str) -> DataFrame:
    """Cast the text columns that belong to a table to its types, leniently."""
    kinds = TABLES[table]

    def cast(column: str) -> Column:
        kind = kinds.get(column)
        if kind is None or kind == "string":
            return F.col(column)
        return to_date_lenient(column) if kind == "date" else to_number(column, kind)

    text = dict(df.dtypes)
    return df.select(*[cast(c).alias(c) if text[c] == "string" else F.col(c) for c in df.columns])


def _final(df: DataFrame, table: str) -> DataFrame:
    """All columns of the table in its order and types; columns the source lacks are at their marker."""
    defaults = {**NULL_DEFAULTS, "text": TEXT_DEFAULTS[table.startswith("dim_")]}
    markers = {c: F.lit(defaults[category]) for category, columns in NULL_RULES[table].items() for c in columns}
    absent = [c for c in TABLES[table] if c not in df.columns and c not in markers]
    if absent:
        raise ValueError(f"{table}: the source has no {', '.join(absent)}")
    finished = [(F.col(c) if c in df.columns else markers[c]).cast(k).alias(c) for c, k in TABLES[table].items()]
    return df.select(*finished, *[c for c in (REJECT,) if c in df.columns])


def _keep_order(columns: Sequence[str]) -> list[str]:
    return [*columns, ROW_ORDER]


def _short_place(df: DataFrame) -> DataFrame:
    """The number of a row alone as its place, where that only tells rows apart: joins send it along."""
    whole = ROW_ORDER in df.columns and isinstance(df.schema[ROW_ORDER].dataType, StructType)
    return df.withColumn(ROW_ORDER, F.col(f"{ROW_ORDER}.row")) if whole else df


def _filled(df: DataFrame, table: str) -> DataFrame:
    return apply_null_rules(df, NULL_RULES[table], table.startswith("dim_"))


def _dimension(source: DataFrame, table: str, key: str, critical: Sequence[str]) -> DataFrame:
    rows = _typed(select_available(source, _keep_order(TABLES[table])), table)
    if table == "dim_games":
        rows = truncate_text(rows, GAME_TEXT_LIMITS)
    rows = reject_missing(dedupe(rows, [key], [F.asc(ROW_ORDER)]), "missing", critical)
    return _filled(rows, table)


def _with_unknown(rows: DataFrame, table: str, key: str) -> DataFrame:
    return add_unknown_member(rows, key, {**unknown_member(table, key), REJECT: ADDED})


def mark_dim_competitions(source: DataFrame) -> DataFrame:
    return _final(_dimension(source, "dim_competitions", "competition_id", ["competition_id"]), "dim_competitions")


def mark_dim_clubs(source: DataFrame) -> DataFrame:
    rows = _final(_dimension(source, "dim_clubs", "club_id", ["club_id"]), "dim_clubs")
    return _with_unknown(rows, "dim_clubs", "club_id")


def mark_dim_players(source: DataFrame) -> DataFrame:
    rows = _final(_dimension(source, "dim_players", "player_id", ["player_id"]), "dim_players")
    return _with_unknown(rows, "dim_players", "player_id")


def mark_dim_games(source: DataFrame, clubs: DataFrame, competitions: DataFrame) -> DataFrame:
    rows = _dimension(source, "dim_games", "game_id", ["game_id", "competition_id", "date"])
    rows = reject_orphans(rows, "home_club_id", "home_club_id", clubs, "club_id")
    rows = reject_orphans(rows, "away_club_id", "away_club_id", clubs, "club_id")
    rows = reject_orphans(rows, "competition_id", "competition_id", competitions, "competition_id")
    return _final(rows, "dim_games")


def mark_fact_games(
    source: DataFrame, club_games: DataFrame, games: DataFrame, competitions: DataFrame, clubs: DataFrame,
    dates: DataFrame,
) -> DataFrame:
    sides = club_games.select(
        to_number("game_id", "int").alias("game_id"), "hosting", to_number("own_position", "int").alias("own_position")
    )
    places = widen_by_role(
        sides, "game_id", "hosting", "own_position", {"Home": "home_club_position", "Away": "away_club_position"}
    )
    rows = _short_place(source.drop("home_club_position", "away_club_position"))
    rows = _typed(rows.withColumn("date_id", date_id(to_date_lenient("date"))), "fact_games")
    rows = _filled(_final(rows.join(counted_side(places, sides), "game_id", "left"), "fact_games"), "fact_games")
    rows = derive_outcome(rows, "home_club_goals", "away_club_goals")
    rows = reject_orphans(rows, "game_id", "game_id", games, "game_id")
    rows = reject_orphans(rows, "competition_id", "competition_id", competitions, "competition_id")
    rows = reject_orphans(rows, "home_club_id", "home_club_id", clubs, "club_id")
    rows = reject_orphans(rows, "away_club_id", "away_club_id", clubs, "club_id")
    rows = reject_orphans(rows, "date_id", "date_id", dates, "date_id")
    return _final(rows, "fact_games")


def _game_info(games: DataFrame) -> DataFrame:
    return games.select("game_id", "competition_id", date_id("date").alias("date_id"))


def mark_fact_appearances(
    source: DataFrame, lineups: DataFrame, games: DataFrame, players: DataFrame, clubs: DataFrame
) -> DataFrame:
    rows = _typed(rename(_short_place(source), {"player_club_id": "club_id"}), "fact_appearances")
    roles = _typed(
        lineups.select("game_id", "player_id", "type", "position", "team_captain", ROW_ORDER), "fact_appearances"
    )
    rows = enrich(rows, roles, ["game_id", "player_id"], ["type", "position", "team_captain"], [F.asc(ROW_ORDER)])
    rows = reject_orphans(rows, "game_id", "game_id", _game_info(games), "game_id", ["competition_id", "date_id"])
    rows = _filled(_final(rows, "fact_appearances"), "fact_appearances")
    rows = reject_orphans(rows, "player_id", "player_id", players, "player_id")
    return _final(reject_orphans(rows, "club_id", "club_id", clubs, "club_id"), "fact_appearances")


EVENT_IDS = ("game_event_id", "id")  # columns that may name an event; without them, events are numbered


def mark_fact_game_events(
    source: DataFrame, games: DataFrame, players: DataFrame, clubs: DataFrame
) -> DataFrame:
    event_id = first_available(source, EVENT_IDS)
    if event_id is None:
        source = with_file_order_key(source, "event_id", ROW_ORDER)
        source = source.withColumn("event_id", F.col("event_id").cast("string"))
    else:
        source = source.withColumn("event_id", event_id)
    rows = _typed(_short_place(source), "fact_game_events")
    rows = reject_orphans(rows, "game_id", "game_id", _game_info(games), "game_id", ["competition_id", "date_id"])
    rows = _final(rows, "fact_game_events").withColumns(
        {
            "description": clean_text("description"),
            "player_in_id": null_unless("player_in_id", F.col("type") == "Substitutions"),
            "player_assist_id": null_unless("player_assist_id", F.col("type") == "Goals"),
        }
    )
    rows = _filled(rows, "fact_game_events")
    rows = reject_orphans(rows, "club_id", "club_id", clubs, "club_id")
    rows = reject_orphans(rows, "player_id", "player_id", players, "player_id")
    rows = redirect_fk(rows, "player_in_id", players, "player_id")
    rows = redirect_fk(rows, "player_assist_id", players, "player_id")
    return _final(rows, "fact_game_events")


def mark_fact_transfers(
    source: DataFrame, players: DataFrame, clubs: DataFrame, dates: DataFrame
) -> DataFrame:
    day = to_date_lenient(first_available(source, ["transfer_date", "date"]))
    rows = source.withColumns(
        {
            "transfer_date_id": date_id(day),
            "transfer_fee": money("transfer_fee"),
            "transfer_season": season_start("transfer_season"),
        }
    )
    rows = _typed(select_available(rows, _keep_order(TABLES["fact_transfers"])), "fact_transfers")
    rows = reject_missing(rows, "missing", ["player_id", "transfer_date_id"])
    rows = reject_orphans(rows, "player_id", "player_id", players, "player_id")
    rows = redirect_fk(rows, "from_club_id", clubs, "club_id")
    rows = redirect_fk(rows, "to_club_id", clubs, "club_id")
    return reject_orphans(rows, "transfer_date_id", "transfer_date_id", dates, "date_id")


def _number_transfers(rows: DataFrame, number: Callable[..., DataFrame] = with_file_order_key) -> DataFrame:
    return _final(number(_filled(rows, "fact_transfers"), "transfer_id", ROW_ORDER), "fact_transfers")


def mark_fact_player_valuations(
    source: DataFrame, players: DataFrame, clubs: DataFrame, dates: DataFrame
) -> DataFrame:
    rows = source.withColumn("date_id", date_id(to_date_lenient("date")))
    rows = rename(
        rows, {"current_club_id": "club_id", "player_club_domestic_competition_id": "competition_id"}
    )
    rows = _typed(select_available(rows, _keep_order(TABLES["fact_player_valuations"])), "fact_player_valuations")
    rows = _filled(rows, "fact_player_valuations")
    rows = reject_orphans(rows, "player_id", "player_id", players, "player_id")
    rows = reject_orphans(rows, "club_id", "club_id", clubs, "club_id")
    return reject_orphans(rows, "date_id", "date_id", dates, "date_id")


def _number_valuations(rows: DataFrame, number: Callable[..., DataFrame] = with_file_order_key) -> DataFrame:
    return _final(number(rows, "valuation_id", ROW_ORDER), "fact_player_valuations")


def _built(mark: Callable[..., DataFrame], number: Callable[[DataFrame], DataFrame] | None = None) -> Callable[..., DataFrame]:
    def build(*tables: DataFrame) -> DataFrame:
        rows = accepted(mark(*tables))
        return number(rows) if number else rows

    return build


build_dim_competitions = _built(mark_dim_competitions)
build_dim_clubs = _built(mark_dim_clubs)
build_dim_players = _built(mark_dim_players)
build_dim_games = _built(mark_dim_games)
build_fact_games = _built(mark_fact_games)
build_fact_appearances = _built(mark_fact_appearances)
build_fact_game_events = _built(mark_fact_game_events)
build_fact_transfers = _built(mark_fact_transfers, _number_transfers)
build_fact_player_valuations = _built(mark_fact_player_valuations, _number_valuations)

# -- from files to tables ----------------------------------------------------------------------

# Each table with its sources and parents, in dependency order.
JOBS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...], tuple[str, ...]]] = {
    "dim_competitions": (build_dim_competitions, ("competitions",), ()),
    "dim_clubs": (build_dim_clubs, ("clubs",), ()),
    "dim_players": (build_dim_players, ("players",), ()),
    "dim_games": (build_dim_games, ("games",), ("dim_clubs", "dim_competitions")),
    "fact_games": (
        build_fact_games,
        ("games", "club_games"),
        ("dim_games", "dim_competitions", "dim_clubs", "dim_date"),
    ),
    "fact_appearances": (
        build_fact_appearances,
        ("appearances", "game_lineups"),
        ("dim_games", "dim_players", "dim_clubs"),
    ),
    "fact_game_events": (
        build_fact_game_events, ("game_events",), ("dim_games", "dim_players", "dim_clubs"),
    ),
    "fact_transfers": (build_fact_transfers, ("transfers",), ("dim_players", "dim_clubs", "dim_date")),
    "fact_player_valuations": (
        build_fact_player_valuations, ("player_valuations",), ("dim_players", "dim_clubs", "dim_date"),
    ),
}


# Columns a source must have; without one of them a load would be empty or meaningless.
REQUIRED = {
    "competitions": ("competition_id",),
    "clubs": ("club_id",),
    "players": ("player_id",),
    "games": ("game_id", "competition_id", "date", "home_club_id", "away_club_id"),
    "club_games": ("game_id", "hosting", "own_position"),
    "appearances": ("game_id", "player_id", "player_club_id"),
    "game_lineups": ("game_id", "player_id", "type", "position", "team_captain"),
    "game_events": ("game_id", "club_id", "player_id", "type", "description", "player_in_id", "player_assist_id"),
    "transfers": ("player_id", "from_club_id", "to_club_id", "transfer_season", "transfer_fee"),
    "player_valuations": ("player_id", "date", "current_club_id"),
}

# Of each table, the rules in the order in which they reject rows; tables named in DEDUPED also
# lose rows whose key came before. Numbered tables get their key from accepted rows only.
REJECT_RULES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "dim_competitions": (mark_dim_competitions, ("missing",)),
    "dim_clubs": (mark_dim_clubs, ("missing",)),
    "dim_players": (mark_dim_players, ("missing",)),
    "dim_games": (mark_dim_games, ("missing", "home_club_id", "away_club_id", "competition_id")),
    "fact_games": (mark_fact_games, ("game_id", "competition_id", "home_club_id", "away_club_id", "date_id")),
    "fact_appearances": (mark_fact_appearances, ("game_id", "player_id", "club_id")),
    "fact_game_events": (mark_fact_game_events, ("game_id", "club_id", "player_id")),
    "fact_transfers": (mark_fact_transfers, ("missing", "player_id", "transfer_date_id")),
    "fact_player_valuations": (mark_fact_player_valuations, ("player_id", "club_id", "date_id")),
}
DEDUPED = ("dim_competitions", "dim_clubs", "dim_players", "dim_games")
NUMBERED = {"fact_transfers": _number_transfers, "fact_player_valuations": _number_valuations}

# The key of each table, unique after a load.
KEYS = {
    "dim_date": "date_id", "dim_competitions": "competition_id", "dim_clubs": "club_id", "dim_players": "player_id",
    "dim_games": "game_id", "fact_games": "game_id", "fact_appearances": "appearance_id", "fact_game_events": "event_id",
    "fact_transfers": "transfer_id", "fact_player_valuations": "valuation_id",
}


# Columns that hold dates, and the formats besides ISO that a load tells by itself, by a sample.
DATE_COLUMNS = {
    "players": ("date_of_birth", "contract_expiration_date"), "games": ("date",), "transfers": ("transfer_date", "date"),
    "player_valuations": ("date",),
}
DATE_FORMATS = ("dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy", "dd-MM-yyyy", "yyyy/MM/dd", "yyyyMMdd")
DATE_SAMPLE = 200_000  # rows


def stage_source(spark: SparkSession, src_dir: str, root: str, name: str, multi_line: bool | None = None) -> dict[str, int]:
    """Parse one CSV source and write it as text columns to ``sources`` under ``root``.

    Returns its ``rows`` and ``bad_lines`` (more or fewer fields than the header), counted while it is
    written. Files are split over tasks and parsed once. Only if a line is found whose quotes do not
    pair, the source has line breaks inside of fields and is staged again by whole files;
    ``multi_line`` True or False settles the question beforehand. Raises if a required column is absent.
    """
    path = f"{src_dir}/{name}.csv"

    def write(rows: DataFrame) -> dict[str, int]:
        absent = [c for c in REQUIRED[name] if c not in rows.columns]
        if absent:
            raise ValueError(f"{name}.csv has no column {', '.join(absent)}")
        observation = Observation()
        open_lines = F.count_if(F.col(OPEN_QUOTE)) if OPEN_QUOTE in rows.columns else F.count_if(F.lit(False))
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(BAD_LINE).isNotNull()).alias("bad_lines"), open_lines.alias("open_quotes")]
        write_table(rows.observe(observation, *counts), root, f"sources/{name}", mode="overwrite")
        return observation.get

    if not multi_line:
        counts = write(read_csv_lines(spark, path))
        if multi_line is False or not counts["open_quotes"]:
            return counts
    return write(read_csv(spark, path, multi_line=True, with_order=True, bad_lines=True))


def staged(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A staged source: its columns as text, dates as ISO dates, and the position of its rows."""
    rows = read_table(spark, root, f"sources/{name}").drop(BAD_LINE, OPEN_QUOTE)
    return iso_dates(rows, detect_date_formats(rows, DATE_COLUMNS.get(name, ()), DATE_FORMATS, DATE_SAMPLE))


# Large tables are built in rounds, each a query with its share of the source rows whose shuffle files go as
# it ends. The number of rounds is bounded, as each reads the sources.
ROUND_ROWS = 1_000_000  # of the source
MOST_ROUNDS = 8
# Sources that a job joins or dedupes are dealt to rounds by this key, so that equal keys meet; others by place.
ROUND_KEYS = {"dim_games": "game_id", "fact_games": "game_id", "fact_appearances": "game_id"}
ONE_ROUND = ("dim_competitions", "dim_clubs", "dim_players")  # these are small and add a row


def _round_count(name: str, source: DataFrame) -> int:
    numbered_first = name == "fact_game_events" and first_available(source, EVENT_IDS) is None
    return 1 if name in ONE_ROUND or numbered_first else max(1, min(MOST_ROUNDS, -(-source.count() // ROUND_ROWS)))


def _of_round(source: DataFrame, name: str, number: int, rounds: int) -> DataFrame:
    """The rows of a staged source that belong to a round of a table's build."""
    if rounds == 1:
        return source
    place = F.xxhash64(ROW_ORDER)
    if name in ROUND_KEYS:
        key = to_number(ROUND_KEYS[name], TABLES[name][ROUND_KEYS[name]])
        # Rows without a key are one group of a dedupe, and meet no other row of a join.
        place = F.xxhash64(key) if name in DEDUPED else F.when(key.isNull(), place).otherwise(F.xxhash64(key))
    return source.filter(F.pmod(place, F.lit(rounds)) == number)


def _write_rows(spark: SparkSession, root: str, name: str, years: tuple[int, int] | None = None) -> dict[str, int]:
    """Build a table from its staged sources, write it, and return its counts (see ``accepted_and_counted``).

    A span of years is written in one round, as its folders are replaced at once.
    """
    _, own, parents = JOBS[name]
    mark, rules = REJECT_RULES[name]
    sources, dims = [staged(spark, root, s) for s in own], [read_table(spark, root, p) for p in parents]
    rounds = 1 if years else _round_count(name, sources[0])
    held = f"_accepted/{name}"  # rows of a numbered table, until all are there
    counts: Counter[str] = Counter()
    with shuffles_removed(spark):
        for number in range(rounds):
            marked = mark(*[_of_round(s, name, number, rounds) for s in sources], *dims)
            if name in NUMBERED:
                rows, observation = accepted_and_counted(marked, rules)
                write_table(rows, root, held, mode="append" if number else "overwrite")
            else:
                rows, observation = accepted_and_counted(in_folders(marked, name, years), rules)
                write_folders(rows, root, name, years=years, ready=True, more=number > 0)
            counts.update(observation.get)
        if name in NUMBERED:
            accepted_rows = spark.read.schema(rows.schema).parquet(f"{root}/{held}")
            for number in range(rounds):
                numbered = NUMBERED[name](accepted_rows, partial(file_order_key, part=number, parts=rounds))
                write_folders(numbered, root, name, years=years, more=number > 0)
            remove_folder(spark, f"{root}/_accepted")
    return dict(counts)


def load_dim_date(spark: SparkSession, root: str) -> int:
    counted, observation = load_metrics(date_dimension(spark), "dim_date")
    write_table(counted, root, "dim_date", mode="overwrite")
    return observation.get["row_count"]


def load_table(spark: SparkSession, src_dir: str, root: str, name: str, multi_line: bool | None = None) -> int:
    """Load one table from its CSV files, replacing it, and return its row count.

    Its parents must be loaded. ``multi_line`` as for :func:`stage_source`.
    """
    if name == "dim_date":
        return load_dim_date(spark, root)
    for source in JOBS[name][1]:
        stage_source(spark, src_dir, root, source, multi_line)
    counts = _write_rows(spark, root, name)
    return counts["rows"] - sum(counts[f"rule {rule}"] for rule in REJECT_RULES[name][1])


def refresh_years(
    spark: SparkSession, src_dir: str, root: str, name: str, first: int, last: int, multi_line: bool | None = None
) -> None:
    """Replace the rows of a fact that lie in a span of years (seasons for transfers), in the current tables.

    Only the folders of these years are written; years without rows in the source keep theirs. The
    dimensions stay as they are. Numbered keys are those of a full load of the same source.
    """
    if name not in FOLDERS:
        raise ValueError(f"{name} has no year folders")
    folder = current_root(spark, root)
    for source in JOBS[name][1]:
        stage_source(spark, src_dir, folder, source, multi_line)
    _write_rows(spark, folder, name, (first, last))


def foreign_keys(tables: Mapping[str, DataFrame]) -> dict[str, tuple[DataFrame, str, DataFrame, str]]:
    """The references between the tables, as checks for :func:`orphan_counts`."""
    # Fact, column, dimension and key of every reference.
    references = [
        ("dim_games", "competition_id", "dim_competitions", "competition_id"),
        ("dim_games", "home_club_id", "dim_clubs", "club_id"),
        ("dim_games", "away_club_id", "dim_clubs", "club_id"),
        ("fact_games", "game_id", "dim_games", "game_id"),
        ("fact_games", "competition_id", "dim_competitions", "competition_id"),
        ("fact_games", "home_club_id", "dim_clubs", "club_id"),
        ("fact_games", "away_club_id", "dim_clubs", "club_id"),
        ("fact_games", "date_id", "dim_date", "date_id"),
        ("fact_appearances", "game_id", "dim_games", "game_id"),
        ("fact_appearances", "player_id", "dim_players", "player_id"),
        ("fact_appearances", "club_id", "dim_clubs", "club_id"),
        ("fact_appearances", "competition_id", "dim_competitions", "competition_id"),
        ("fact_appearances", "date_id", "dim_date", "date_id"),
        ("fact_game_events", "game_id", "dim_games", "game_id"),
        ("fact_game_events", "club_id", "dim_clubs", "club_id"),
        ("fact_game_events", "player_id", "dim_players", "player_id"),
        ("fact_game_events", "player_in_id", "dim_players", "player_id"),
        ("fact_game_events", "player_assist_id", "dim_players", "player_id"),
        ("fact_game_events", "competition_id", "dim_competitions", "competition_id"),
        ("fact_game_events", "date_id", "dim_date", "date_id"),
        ("fact_transfers", "player_id", "dim_players", "player_id"),
        ("fact_transfers", "from_club_id", "dim_clubs", "club_id"),
        ("fact_transfers", "to_club_id", "dim_clubs", "club_id"),
        ("fact_transfers", "transfer_date_id", "dim_date", "date_id"),
        ("fact_player_valuations", "player_id", "dim_players", "player_id"),
        ("fact_player_valuations", "club_id", "dim_clubs", "club_id"),
        ("fact_player_valuations", "competition_id", "dim_competitions", "competition_id"),
        ("fact_player_valuations", "date_id", "dim_date", "date_id"),
    ]
    return {
        f"{fact}.{column}": (tables[fact], column, tables[dim], key) for fact, column, dim, key in references
    }


STATUS = "check_type string, check_name string, found bigint, ok boolean"
JOB_LOG = "table_name string, seconds double"


def status_checks(tables: Mapping[str, DataFrame]) -> Iterator[DataFrame]:
    """The checks of :func:`load_status` in queries of one table each.

    The plan of all checks in one query takes hundreds of megabytes of the driver, whatever the tables' size.
    """
    tables = dict(tables)  # each opened once, so that the references of a fact share its scan

    def status(kind: str, check: DataFrame) -> DataFrame:
        return check.select(F.lit(kind).alias("check_type"), "check_name", "found", (F.col("found") == 0).alias("ok"))

    for name, df in tables.items():
        nulls = null_audit({name: df}).groupBy(F.col("table_name").alias("check_name")).agg(F.sum("nulls").alias("found"))
        yield status("nulls", nulls)
    by_fact: dict[str, dict] = {}
    for name, reference in foreign_keys(tables).items():
        by_fact.setdefault(name.split(".")[0], {})[name] = reference
    for own in by_fact.values():
        yield status("orphans", orphan_counts(own).withColumnRenamed("orphans", "found"))
    for name, key in KEYS.items():
        repeated = key_check(tables[name], [key])
        yield status("repeated_keys", repeated.select(F.lit(name).alias("check_name"), F.coalesce("extra_rows", F.lit(0)).alias("found")))
    home, away = F.col("home_club_goals"), F.col("away_club_goals")
    rules = {
        "goal_difference": home - away, "total_goals": home + away,
        "is_home_win": home > away, "is_draw": home == away, "is_away_win": home < away,
    }
    verified = verify_derived(tables["fact_games"], rules)
    wrong = verified.select(*[(F.col("row_count") - F.col(f"{c}_ok")).alias(c) for c in rules])
    derived = wrong.unpivot([], wrong.columns, "measure", "found")
    yield status("wrong_measures", derived.select(F.concat(F.lit("fact_games."), "measure").alias("check_name"), "found"))


def load_status(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs per table, orphans per reference, rows on a repeated key and derived measures that are wrong."""
    return union_all(*status_checks(tables))


def load_all(
    spark: SparkSession, src_dir: str, root: str, strict: bool = False, multi_line: bool | None = None,
    on_staged: Callable[[str], None] | None = None,
) -> DataFrame:
    """Load all tables in dependency order and return the checks as a status table.

    The tables are written to a new version folder under ``root``, which becomes the current one at
    the end: a run that fails leaves the tables of the run before as they are, and queries already
    running keep their files. Old versions are for the caller to delete. The version also holds the
    staged sources (``sources``) and the time per job (``job_log``).

    The status has the malformed lines per source file; per table the rows loaded, the rows
    rejected by each rule (``table.rule``; ``duplicate`` for a key that came before) and the source rows
    in neither; the NULLs per table, the orphans per reference, the rows on a repeated key and the
    derived measures that differ from their rule; it is computed once. Each source is parsed once,
    and rejected rows are counted while the tables are written. The first failing job raises and
    ends the run. With ``strict``, malformed lines end it before anything is loaded, and any other
    failed check raises at its end.

    ``on_staged`` is called with the name of each source that has been staged: its files are not read again.
    """
    def stop_on(rows: list) -> None:
        failed = [r for r in rows if not r[3]]
        if strict and failed:
            raise ValueError("; ".join(f"{kind} in {name}: {found}" for kind, name, found, _ in failed))

    version = f"version-{uuid.uuid4().hex}"
    folder = f"{root}/{version}"
    log: list[tuple[str, float]] = []

    def timed(job: str, run: Callable, *args):
        start = time.monotonic()
        result = run(*args)
        log.append((job, time.monotonic() - start))
        return result

    files = sorted({s for _, sources, _ in JOBS.values() for s in sources})
    sources = {}
    for s in files:
        sources[s] = timed(f"sources/{s}", stage_source, spark, src_dir, folder, s, multi_line)
        if on_staged:
            on_staged(s)
    rows: list[tuple] = [("bad_lines", s, counts["bad_lines"], not counts["bad_lines"]) for s, counts in sources.items()]
    stop_on(rows)
    rows.append(("rows_loaded", "dim_date", timed("dim_date", load_dim_date, spark, folder), True))
    for name, (_, own, _) in JOBS.items():
        counts = timed(name, _write_rows, spark, folder, name)
        rejected = {rule: counts[f"rule {rule}"] for rule in REJECT_RULES[name][1]}
        left = sources[own[0]]["rows"] - (counts["rows"] - counts["added"])
        if name in DEDUPED:
            rejected["duplicate"], left = left, 0
        rows.append(("rows_loaded", name, counts["rows"] - sum(n for rule, n in rejected.items() if rule != "duplicate"), True))
        rows += [("rows_rejected", f"{name}.{rule}", n, True) for rule, n in rejected.items()]
        rows.append(("rows_unaccounted", name, left, left == 0))
    with shuffles_removed(spark):
        for check in status_checks(Warehouse.in_folder(spark, folder)):
            rows += [tuple(r) for r in check.collect()]  # a row per table, key and reference
    stop_on(rows)
    write_table(spark.createDataFrame(log, JOB_LOG), folder, "job_log")
    publish(spark, root, version)
    return spark.createDataFrame(rows, STATUS)


def source_load_rate(spark: SparkSession, src_dir: str, root: str, multi_line: bool = True) -> DataFrame:
    """Source rows against loaded rows per table and in total.

    Rows of sources that the load has staged are counted there; others are read from their files.
    """
    root = current_root(spark, root)

    def rows_of(source: str) -> DataFrame:
        try:
            return read_table(spark, root, f"sources/{source}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return read_csv(spark, f"{src_dir}/{source}.csv", multi_line=multi_line)

    return load_rate({name: (rows_of(sources[0]), read_table(spark, root, name)) for name, (_, sources, _) in JOBS.items()})


def job_log(spark: SparkSession, root: str) -> DataFrame:
    """Seconds per job of the load published last."""
    return read_table(spark, current_root(spark, root), "job_log")
