"""Sources, sinks, load steps and load jobs."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import clean_text, date_id, money, null_unless, season_start, to_date_lenient, to_number
from starmart.operators import (
    add_unknown_member,
    apply_null_rules,
    dedupe,
    derive_outcome,
    detect_date_formats,
    enrich,
    filter_fk,
    first_available,
    iso_dates,
    lookup,
    redirect_fk,
    rename,
    require,
    select_available,
    truncate_text,
    widen_by_role,
    with_surrogate_key,
)
from starmart.plans import loads
from starmart.session import remove_folder, shared_folder, shuffles_removed
from starmart.sources import date_dimension, load_metrics, read_csv, read_table, write_table
from checks.sources import BUILT, RAW, integer, raw_tables, with_raw
from checks.testmart import Tables, with_mart

OPERATORS: dict[str, tuple] = {}


def _folder(t: Tables) -> str:
    """A new folder in the shared folder for one run."""
    return f"{shared_folder(t.spark)}/starmart-{uuid.uuid4()}"


# -- sources and sinks -------------------------------------------------------------------------


def _csv_round_trip(t: Tables):
    """Write customers as CSV with null tokens in it and read them back."""
    root = _folder(t)
    rows = t["customer"].select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "N/A").when(F.col("c_mktsegment") == "FURNITURE", "None")
        .when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    rows.write.option("header", True).csv(f"{root}/customer.csv")
    return read_csv(t.spark, f"{root}/customer.csv", ["c_custkey", "c_mktsegment"])


def _csv_with_breaks(t: Tables):
    """Write customers whose names hold quotes, commas and line breaks, and read them back."""
    root = _folder(t)
    name = F.concat(F.lit('"'), "c_name", F.lit('",\n'), "c_mktsegment")
    rows = t["customer"].select(F.col("c_custkey").cast("string").alias("c_custkey"), name.alias("c_name"))
    rows.write.option("header", True).option("escape", '"').csv(f"{root}/customer.csv")
    return read_csv(t.spark, f"{root}/customer.csv", multi_line=True)


OPERATORS["src_csv_multiline"] = (
    _csv_with_breaks,
    """select cast(c_custkey as varchar) as c_custkey, '"' || c_name || '",' || chr(10) || c_mktsegment as c_name
       from customer""",
)
OPERATORS["src_csv"] = (
    _csv_round_trip,
    """select cast(c_custkey as varchar) as c_custkey,
              case when c_mktsegment not in ('MACHINERY', 'FURNITURE', 'BUILDING') then c_mktsegment end as c_mktsegment
       from customer""",
)
OPERATORS["src_select_available"] = (
    lambda t: select_available(t["part"], ["p_brand", "p_colour", "p_partkey"]),
    "select p_brand, p_partkey from part",
)
OPERATORS["src_table_scan"] = (
    lambda t: read_table(t.spark, t.sf_dir, "orders.parquet").select("o_orderkey", "o_orderpriority"),
    "select o_orderkey, o_orderpriority from orders",
)


def _written(t: Tables, modes: list[str]):
    root = _folder(t)
    for mode in modes:
        write_table(t["customer"], root, "customer", mode=mode)
    return read_table(t.spark, root, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("row_count"))


OPERATORS["sink_append"] = (
    lambda t: _written(t, ["append", "append"]),
    "select c_nationkey, 2 * count(*) as row_count from customer group by c_nationkey",
)
OPERATORS["sink_overwrite"] = (
    lambda t: _written(t, ["append", "overwrite"]),
    "select c_nationkey, count(*) as row_count from customer group by c_nationkey",
)


def _observed(t: Tables):
    counted, observation = load_metrics(t["orders"])
    write_table(counted, _folder(t), "orders", mode="overwrite")
    return t.spark.range(1).select(F.lit(observation.get["row_count"]).alias("row_count"))


OPERATORS["sink_observe"] = (_observed, "select count(*) as row_count from orders")


def _calendar_of_orders(t: Tables):
    """The calendar from the first to the last order date."""
    first, last = t["orders"].agg(
        F.min("o_orderdate").cast("date").cast("string"), F.max("o_orderdate").cast("date").cast("string")
    ).first()
    return date_dimension(t.spark, first, last)


OPERATORS["dim_date"] = (
    _calendar_of_orders,
    """with bounds as (select cast(min(o_orderdate) as date) as a, cast(max(o_orderdate) as date) as b from orders),
            days as (select a + cast(i as int) as d from bounds, range(0, 100000) r(i) where a + cast(i as int) <= b)
       select cast(strftime(d, '%Y%m%d') as int) as date_id, d as full_date, cast(year(d) as int) as year,
              cast(quarter(d) as int) as quarter, cast(month(d) as int) as month, monthname(d) as month_name,
              cast(week(d) as int) as week, cast(dayofyear(d) as int) as day_of_year, cast(day(d) as int) as day_of_month,
              cast(isodow(d) - 1 as int) as day_of_week, dayname(d) as day_name, isodow(d) >= 6 as is_weekend,
              cast(year(d) - case when month(d) < 7 then 1 else 0 end as int) as season_start_year
       from days""",
)


def _unknown_nation(t: Tables):
    nations = t["nation"].select("n_nationkey", "n_name")
    once = add_unknown_member(nations, "n_nationkey", {"n_nationkey": -1, "n_name": "Desconocido"})
    return add_unknown_member(once, "n_nationkey", {"n_nationkey": -1, "n_name": "again"})


OPERATORS["dim_unknown_member"] = (
    _unknown_nation,
    "select n_nationkey, n_name from nation union all select -1, 'Desconocido'",
)
OPERATORS["load_surrogate_key"] = (
    lambda t: with_surrogate_key(
        t["orders"].select("o_orderkey", "o_orderdate"), "order_number", [F.asc("o_orderdate"), F.asc("o_orderkey")]
    ).select("order_number", "o_orderkey"),
    "select row_number() over (order by o_orderdate, o_orderkey) as order_number, o_orderkey from orders",
)

# -- load steps --------------------------------------------------------------------------------

OPERATORS["load_rename"] = (
    lambda t: rename(t["region"], {"r_regionkey": "competition_id", "r_name": "name"}),
    "select r_regionkey as competition_id, r_name as name from region",
)
OPERATORS["load_first_available"] = (
    lambda t: t["orders"].select("o_orderkey", first_available(t["orders"], ["transfer_date", "o_orderdate"]).cast("date").alias("day")),
    "select o_orderkey, cast(o_orderdate as date) as day from orders",
)
OPERATORS["load_try_cast"] = (
    lambda t: raw_tables(t.spark, t.sf_dir)["games"].select(
        "game_id", to_number("attendance", "int").alias("attendance"), to_number("away_club_id", "int").alias("away_club_id"),
        to_number("home_club_name", "decimal(15,2)").alias("name_as_number"),
    ),
    with_raw("raw_games", """
    select game_id, try_cast(attendance as int) as attendance, cast(try_cast(away_club_id as double) as int) as away_club_id,
           try_cast(home_club_name as double) as name_as_number from raw_games"""),
)
OPERATORS["load_try_date"] = (
    lambda t: raw_tables(t.spark, t.sf_dir)["games"].select("game_id", to_date_lenient("date").alias("day")),
    with_raw("raw_games", "select game_id, try_cast(date as date) as day from raw_games"),
)


def _detected_dates(t: Tables):
    """Dates in two formats that are told from the rows themselves."""
    day = F.col("o_orderdate").cast("date")
    rows = t["orders"].select("o_orderkey", F.date_format(day, "dd/MM/yyyy").alias("day"), F.date_format(day, "yyyyMMdd").alias("packed"))
    rows = iso_dates(rows, detect_date_formats(rows, ["day", "packed", "absent"], loads.DATE_FORMATS, 100_000))
    return rows.select("o_orderkey", to_date_lenient("day").alias("day"), to_date_lenient("packed").alias("packed"))


OPERATORS["load_detect_dates"] = (
    _detected_dates,
    "select o_orderkey, cast(o_orderdate as date) as day, cast(o_orderdate as date) as packed from orders",
)
OPERATORS["load_date_id"] = (
    lambda t: t["orders"].select("o_orderkey", date_id("o_orderdate").alias("date_id")),
    "select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as int) as date_id from orders",
)
OPERATORS["load_truncate"] = (
    lambda t: truncate_text(
        t["orders"].select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority")), {"priority": 4, "absent": 2}
    ),
    "select o_orderkey, left(nullif(o_orderpriority, '5-LOW'), 4) as priority from orders",
)
_LINE_ORDER = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
OPERATORS["load_dedupe"] = (
    lambda t: dedupe(t["lineitem"], ["l_orderkey"], [F.asc(c) for c in _LINE_ORDER]).select(
        "l_orderkey", "l_linenumber", "l_partkey"
    ),
    f"""select l_orderkey, l_linenumber, l_partkey from (
            select *, row_number() over (partition by l_orderkey order by {', '.join(_LINE_ORDER)}) as rn from lineitem) l
        where rn = 1""",
)
OPERATORS["load_require"] = (
    lambda t: require(
        t["orders"].select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status")), ["status", "absent"]
    ),
    "select o_orderkey, o_orderstatus as status from orders where o_orderstatus <> 'P'",
)


def _with_gaps(t: Tables):
    gap = F.col("l_returnflag") == "N"
    return t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.when(~gap, F.col("l_linestatus")).alias("status"),
        F.when(~gap, F.col("l_linenumber")).alias("goals"),
        F.when(~gap, F.col("l_quantity").cast("int")).alias("minute"),
        F.when(~gap, F.col("l_extendedprice").cast("decimal(15,2)")).alias("fee"),
        F.when(~gap, F.col("l_suppkey")).alias("club_id"),
        F.when(~gap, F.col("l_tax") > 0.04).alias("captain"),
        F.when(~gap, F.col("l_shipdate").cast("date")).alias("born"),
        F.when(~gap, F.col("l_shipdate").cast("date")).alias("expires"),
    )


_GAP_RULES = {
    "text": ["status"], "measure": ["goals"], "attribute": ["minute"], "money": ["fee"], "optional_key": ["club_id"],
    "flag": ["captain"], "unknown_date": ["born"], "open_date": ["expires"],
}
OPERATORS["load_null_rules"] = (
    lambda t: apply_null_rules(_with_gaps(t), _GAP_RULES, is_dimension=False),
    """select l_orderkey, l_partkey, l_suppkey, case when gap then 'Unknown' else l_linestatus end as status,
              case when gap then 0 else l_linenumber end as goals, case when gap then -1 else cast(l_quantity as int) end as minute,
              case when gap then -1 else l_extendedprice end as fee, case when gap then -1 else l_suppkey end as club_id,
              case when gap then false else l_tax > 0.04 end as captain,
              case when gap then date '1900-01-01' else cast(l_shipdate as date) end as born,
              case when gap then date '9999-12-31' else cast(l_shipdate as date) end as expires
       from (select *, l_returnflag = 'N' as gap from lineitem) l""",
)
_EUROPE = "select n_nationkey from nation where n_regionkey <= 2"
OPERATORS["load_fk_filter"] = (
    lambda t: filter_fk(
        t["customer"].select("c_custkey", "c_nationkey"), "c_nationkey", t["nation"].filter("n_regionkey <= 2"), "n_nationkey"
    ),
    f"select c_custkey, c_nationkey from customer where c_nationkey in ({_EUROPE})",
)
OPERATORS["load_fk_redirect"] = (
    lambda t: redirect_fk(
        t["customer"].select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("club_id")),
        "club_id", t["nation"].filter("n_regionkey <= 2"), "n_nationkey",
    ),
    f"""select c_custkey, case when not c_acctbal > 0 then null when c_nationkey in ({_EUROPE}) then c_nationkey
                               else -1 end as club_id from customer""",
)
OPERATORS["load_null_unless"] = (
    lambda t: t["events"].select("event_id", null_unless("user_id", F.col("event_type") == "purchase").alias("buyer")),
    "select event_id, case when event_type = 'purchase' then user_id end as buyer from events",
)
OPERATORS["load_clean_text"] = (
    lambda t: raw_tables(t.spark, t.sf_dir)["game_events"].select("game_event_id", clean_text("description").alias("description")),
    with_raw("raw_game_events", """
    select game_event_id, nullif(trim(ltrim(description, ', ')), '') as description from raw_game_events"""),
)
OPERATORS["load_widen_roles"] = (
    lambda t: widen_by_role(
        raw_tables(t.spark, t.sf_dir)["club_games"], "game_id", "hosting", "own_position",
        {"Home": "home_position", "Away": "away_position"},
    ),
    with_raw("raw_club_games", """
    select game_id, max(own_position) filter (where trim(hosting) = 'Home') as home_position,
           max(own_position) filter (where trim(hosting) = 'Away') as away_position
    from raw_club_games group by game_id"""),
)
OPERATORS["load_enrich"] = (
    lambda t: enrich(
        raw_tables(t.spark, t.sf_dir)["appearances"].select("appearance_id", "game_id", "player_id", "minutes_played"),
        raw_tables(t.spark, t.sf_dir)["game_lineups"], ["game_id", "player_id"], ["type", "team_captain"], [F.asc("_row_order")],
    ),
    with_raw("raw_appearances raw_game_lineups", """
    select appearance_id, a.game_id, a.player_id, minutes_played, type, team_captain
    from raw_appearances a left join (
        select *, row_number() over (partition by game_id, player_id order by _row_order) as rn from raw_game_lineups) l
        on a.game_id = l.game_id and a.player_id = l.player_id and rn = 1"""),
)
OPERATORS["load_lookup"] = (
    lambda t: lookup(
        t["orders"].select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.lit("csv").alias("c_mktsegment")),
        t["customer"], "c_custkey", ["c_mktsegment", "c_nationkey"],
    ),
    """select o_orderkey, o_custkey as c_custkey, c_mktsegment, c_nationkey
       from orders left join customer on o_custkey = c_custkey""",
)
OPERATORS["load_derive"] = (
    lambda t: derive_outcome(
        t.mart["fact_games"].select("game_id", "home_club_goals", "away_club_goals"), "home_club_goals", "away_club_goals"
    ),
    with_mart("fact_games", """
    select game_id, home_club_goals, away_club_goals, goal_difference, total_goals, is_home_win, is_draw, is_away_win
    from fact_games"""),
)
OPERATORS["load_money"] = (
    lambda t: raw_tables(t.spark, t.sf_dir)["transfers"].select("_row_order", money("transfer_fee").alias("fee")),
    with_raw("raw_transfers", """
    select _row_order, case when lower(trim(transfer_fee)) in ('free', 'loan', 'free transfer', '-', '?') then 0
           else try_cast(regexp_extract(lower(transfer_fee), '[\\d.]+') as double)
                * case regexp_extract(lower(transfer_fee), '[\\d.]+\\s*([mk])', 1) when 'm' then 1000000 when 'k' then 1000 else 1 end
           end as fee
    from raw_transfers"""),
)
OPERATORS["load_season"] = (
    lambda t: raw_tables(t.spark, t.sf_dir)["transfers"].select("_row_order", season_start("transfer_season").alias("season")),
    with_raw("raw_transfers", """
    select _row_order, cast(case when regexp_full_match(transfer_season, '\\d+/\\d+')
           then cast(split_part(transfer_season, '/', 1) as int)
                + case when cast(split_part(transfer_season, '/', 1) as int) < 50 then 2000 else 1900 end
           else -1 end as int) as season
    from raw_transfers"""),
)

# -- load jobs ---------------------------------------------------------------------------------


def _built(t: Tables, table: str):
    """A table built from the source rows; its parents are loaded first, as in a full load."""
    raw = raw_tables(t.spark, t.sf_dir)
    root = _folder(t)
    loaded: dict[str, DataFrame] = {}

    def load(name: str) -> DataFrame:
        if name not in loaded:
            write_table(build(name), root, name, mode="overwrite")
            loaded[name] = read_table(t.spark, root, name)
        return loaded[name]

    def build(name: str) -> DataFrame:
        if name == "dim_date":
            return date_dimension(t.spark)
        function, sources, parents = loads.JOBS[name]
        return function(*[raw[s] for s in sources], *[load(p) for p in parents])

    return build(table)


_PARENTS = "raw_competitions built_competitions raw_clubs built_clubs"
_ALL_PARENTS = f"{_PARENTS} raw_players built_players raw_games built_games"


def _job(key: str, table: str, views: str, final: str, money_columns: tuple[str, ...] = ()) -> None:
    replaced = ", ".join(f"cast({c} as double) as {c}" for c in money_columns)
    columns = f"* replace ({replaced})" if replaced else "*"
    OPERATORS[key] = (lambda t: _built(t, table), with_raw(f"{views} {final}", f"select {columns} from {final}"))


_job("job_dim_competitions", "dim_competitions", "raw_competitions", "built_competitions")
_job("job_dim_clubs", "dim_clubs", "raw_clubs", "built_clubs", ("total_market_value", "average_age", "foreigners_percentage"))
_job("job_dim_players", "dim_players", "raw_players", "built_players",
     ("height_in_cm", "market_value_in_eur", "highest_market_value_in_eur"))
_job("job_dim_games", "dim_games", f"{_PARENTS} raw_games", "built_games")
_job("job_fact_games", "fact_games", f"{_PARENTS} raw_games built_games raw_club_games dim_date", "built_fact_games")
_job("job_fact_appearances", "fact_appearances", f"{_ALL_PARENTS} raw_appearances raw_game_lineups", "built_fact_appearances")
_job("job_fact_game_events", "fact_game_events", f"{_ALL_PARENTS} raw_game_events", "built_fact_game_events")
_job("job_fact_transfers", "fact_transfers", f"{_ALL_PARENTS} dim_date raw_transfers", "built_fact_transfers",
     ("transfer_fee", "market_value_in_eur"))
_job("job_fact_valuations", "fact_player_valuations", f"{_ALL_PARENTS} dim_date raw_player_valuations",
     "built_fact_player_valuations", ("market_value_in_eur",))


def _load_everything(t: Tables):
    """Write the source rows as CSV files, load all tables from them and return the status."""
    return _load_all(t, _folder(t))


def _load_all(t: Tables, root: str) -> DataFrame:
    """Write the source rows as CSV files and load all tables from them; the files go as they are staged."""
    with shuffles_removed(t.spark):
        for name, rows in raw_tables(t.spark, t.sf_dir).items():
            rows.drop("_row_order").write.options(header=True, compression="gzip").csv(f"{root}/csv/{name}.csv")
    return loads.load_all(t.spark, f"{root}/csv", f"{root}/tables", on_staged=lambda name: remove_folder(t.spark, f"{root}/csv/{name}.csv"))


def _view(table: str) -> str:
    return table if table == "dim_date" else "built_" + table.removeprefix("dim_")


def _rejects_sql() -> str:
    """Source rows per table and rule: each is lost to the first rule that it fails."""
    clubs, players, games, dates = (
        f"(select {key} from {_view(dim)})"
        for key, dim in (("club_id", "dim_clubs"), ("player_id", "dim_players"), ("game_id", "dim_games"), ("date_id", "dim_date"))
    )
    leagues = f"(select competition_id from {_view('dim_competitions')})"
    number = lambda column: f"coalesce({integer(column)}, -1)"
    key = lambda column: f"coalesce(cast(strftime(try_cast({column} as date), '%Y%m%d') as int), -1)"
    earlier = lambda column: f"row_number() over (partition by {column} order by _row_order) > 1"
    rules = {
        ("dim_competitions", "competitions"): {"duplicate": earlier("competition_id"), "missing": "competition_id is null"},
        ("dim_clubs", "clubs"): {"duplicate": earlier("club_id"), "missing": f"{integer('club_id')} is null"},
        ("dim_players", "players"): {"duplicate": earlier("player_id"), "missing": f"{integer('player_id')} is null"},
        ("dim_games", "games"): {
            "duplicate": earlier("game_id"),
            "missing": f"{integer('game_id')} is null or competition_id is null or try_cast(date as date) is null",
            "home_club_id": f"{number('home_club_id')} not in {clubs}", "away_club_id": f"{number('away_club_id')} not in {clubs}",
            "competition_id": f"competition_id not in {leagues}",
        },
        ("fact_games", "games"): {
            "game_id": f"{number('game_id')} not in {games}", "competition_id": f"coalesce(competition_id, 'Unknown') not in {leagues}",
            "home_club_id": f"{number('home_club_id')} not in {clubs}", "away_club_id": f"{number('away_club_id')} not in {clubs}",
            "date_id": f"{key('date')} not in {dates}",
        },
        ("fact_appearances", "appearances"): {
            "game_id": f"{number('game_id')} not in {games}", "player_id": f"{number('player_id')} not in {players}",
            "club_id": f"{number('player_club_id')} not in {clubs}",
        },
        ("fact_game_events", "game_events"): {
            "game_id": f"{number('game_id')} not in {games}", "club_id": f"{number('club_id')} not in {clubs}",
            "player_id": f"{number('player_id')} not in {players}",
        },
        ("fact_transfers", "transfers"): {
            "missing": f"{integer('player_id')} is null or try_cast(transfer_date as date) is null",
            "player_id": f"{number('player_id')} not in {players}", "transfer_date_id": f"{key('transfer_date')} not in {dates}",
        },
        ("fact_player_valuations", "player_valuations"): {
            "player_id": f"{number('player_id')} not in {players}", "club_id": f"{number('current_club_id')} not in {clubs}",
            "date_id": f"{key('date')} not in {dates}",
        },
    }
    parts = []
    for (table, source), own in rules.items():
        first = " ".join(f"when {condition} then '{rule}'" for rule, condition in own.items())
        names = ", ".join(f"('{rule}')" for rule in own)
        parts.append(f"""
            select 'rows_rejected', '{table}.' || rule, count(failed) from (values {names}) r(rule)
            left join (select case {first} end as failed from raw_{source}) x on failed = rule group by rule""")
    return " union all ".join(parts)


def _status_sql() -> str:
    """The status of a full load: counts of the tables that must come out, and their orphans."""
    files = sorted({s for _, sources, _ in loads.JOBS.values() for s in sources})
    parts = [f"select 'bad_lines' as check_type, '{f}' as check_name, 0 as found" for f in files]
    for table in ("dim_date", *loads.JOBS):
        parts.append(f"select 'rows_loaded', '{table}', count(*) from {_view(table)}")
        parts.append(f"select 'nulls', '{table}', 0")
        parts.append(f"select 'repeated_keys', '{table}', count(*) - count(distinct {loads.KEYS[table]}) from {_view(table)}")
    parts += [f"select 'rows_unaccounted', '{table}', 0" for table in loads.JOBS]
    measures = ("goal_difference", "total_goals", "is_home_win", "is_draw", "is_away_win")
    parts += [f"select 'wrong_measures', 'fact_games.{c}', 0" for c in measures]
    for name, (fact, column, dim, key) in loads.foreign_keys({n: n for n in ("dim_date", *loads.JOBS)}).items():
        parts.append(
            f"select 'orphans', '{name}', count(*) from {_view(fact)} "
            f"where {column} is null or {column} not in (select {key} from {_view(dim)})"
        )
    rows = " union all ".join([*parts, _rejects_sql()])
    return f"""select check_type, check_name, cast(found as bigint) as found,
                      check_type in ('rows_loaded', 'rows_rejected') or found = 0 as ok from ({rows}) s"""


OPERATORS["job_all"] = (_load_everything, with_raw(" ".join([*RAW, "dim_date", *BUILT]), _status_sql()))


def _load_rates(t: Tables):
    """Rows of the source files against rows loaded, after a full load."""
    root = _folder(t)
    _load_all(t, root)
    return loads.source_load_rate(t.spark, f"{root}/csv", f"{root}/tables").select("table_name", "source_rows", "loaded_rows")


_RATES = " union all ".join(
    f"select '{table}' as table_name, (select count(*) from raw_{sources[0]}) as source_rows, (select count(*) from {_view(table)}) as loaded_rows"
    for table, (_, sources, _) in loads.JOBS.items()
)
OPERATORS["dq_source_load_rate"] = (_load_rates, with_raw(" ".join([*RAW, "dim_date", *BUILT]), f"""
    select * from ({_RATES}) r
    union all select 'TOTAL', cast(sum(source_rows) as bigint), cast(sum(loaded_rows) as bigint) from ({_RATES}) r"""))
