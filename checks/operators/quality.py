"""Data-quality and reject reports."""

from pyspark.sql import functions as F

from starmart.operators import (
    cascade_counts,
    date_range,
    fact_stats,
    key_check,
    load_rate,
    measure_totals,
    null_audit,
    null_counts,
    null_summary,
    orphan_counts,
    orphans,
    reject_classes,
    reject_counts,
    reject_examples,
    row_counts,
    sample_rows,
    sentinel_audit,
    value_counts,
    verify_derived,
)
from checks.sources import raw_tables, with_raw
from checks.sql import isum, rounded
from checks.testmart import SOURCES, Tables, with_mart

OPERATORS: dict[str, tuple] = {}

OPERATORS["dq_row_counts"] = (
    lambda t: row_counts({name: t[name] for name in SOURCES}),
    " union all ".join(f"select '{n}' as table_name, count(*) as row_count from {n}" for n in SOURCES),
)


def _home_nations(t: Tables):
    return t["nation"].filter("n_regionkey <= 2")


OPERATORS["dq_orphans"] = (
    lambda t: orphan_counts(
        {
            "customer to nation": (t["customer"], "c_nationkey", _home_nations(t), "n_nationkey"),
            "supplier to nation": (t["supplier"], "s_nationkey", t["nation"], "n_nationkey"),
            "lineitem to order": (t["lineitem"], "l_orderkey", t["orders"].filter("o_orderstatus <> 'P'"), "o_orderkey"),
            "gaps to nation": (
                t["customer"].withColumn("key", F.when(F.col("c_acctbal") > 0, F.col("c_nationkey"))), "key",
                t["nation"], "n_nationkey",
            ),
        }
    ),
    """select 'customer to nation' as check_name, count(*) as orphans from customer
           where c_nationkey not in (select n_nationkey from nation where n_regionkey <= 2)
       union all select 'supplier to nation', 0
       union all select 'lineitem to order', count(*) from lineitem
           where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')
       union all select 'gaps to nation', count(*) from customer where not c_acctbal > 0""",
)


def _gaps(t: Tables):
    return raw_tables(t.spark, t.sf_dir)["games"].select("game_id", "home_club_id", "home_club_goals", "away_club_goals")


OPERATORS["dq_null_counts"] = (
    lambda t: null_counts(_gaps(t), ["game_id", "home_club_id", "home_club_goals"]),
    with_raw("raw_games", """
    select count(*) - count(game_id) as nulls_game_id, count(*) - count(home_club_id) as nulls_home_club_id,
           count(*) - count(home_club_goals) as nulls_home_club_goals from raw_games"""),
)
OPERATORS["dq_null_audit"] = (
    lambda t: null_audit({"games": _gaps(t), "customer": t["customer"]}),
    with_raw("raw_games", " union all ".join(
        f"select '{table}' as table_name, '{c}' as column_name, count(*) - count({c}) as nulls from {view}"
        for table, view, columns in (
            ("games", "raw_games", ("game_id", "home_club_id", "home_club_goals", "away_club_goals")),
            ("customer", "customer", ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")),
        )
        for c in columns)),
)
OPERATORS["dq_null_summary"] = (
    lambda t: null_summary(_gaps(t)),
    with_raw("raw_games", """
    select 'home_club_id' as column_name, count(*) - count(home_club_id) as nulls from raw_games
    union all select 'home_club_goals', count(*) - count(home_club_goals) from raw_games"""),
)
OPERATORS["dq_date_range"] = (
    lambda t: date_range(t.mart["fact_games"], "date_id", t.mart["dim_date"]),
    with_mart("fact_games dim_date", """
    select min(full_date) as first_date, max(full_date) as last_date, count(distinct year) as years
    from fact_games join dim_date using (date_id)"""),
)
OPERATORS["dq_fact_stats"] = (
    lambda t: fact_stats(t.mart["fact_games"], "total_goals", ["is_home_win", "is_draw", "is_away_win"]),
    with_mart("fact_games", f"""
    select {rounded('sum(total_goals)', 'count(*)', 2)} as avg_total_goals, max(total_goals) as max_total_goals,
           count(*) filter (where is_home_win) as is_home_win_rows, count(*) filter (where is_draw) as is_draw_rows,
           count(*) filter (where is_away_win) as is_away_win_rows from fact_games"""),
)
OPERATORS["dq_measure_totals"] = (
    lambda t: measure_totals(
        t.mart["fact_appearances"], ["goals", "assists", "yellow_cards", "red_cards"], ["minutes_played"]
    ),
    with_mart("fact_appearances", f"""
    select count(*) as row_count, {isum('goals')} as total_goals, {isum('assists')} as total_assists,
           {isum('yellow_cards')} as total_yellow_cards, {isum('red_cards')} as total_red_cards,
           cast(sum(minutes_played) as double) / count(*) as avg_minutes_played from fact_appearances"""),
)


def _load_pairs(t: Tables):
    return {
        "customer": (t["customer"], t["customer"].filter("c_acctbal > 0")),
        "orders": (t["orders"], t["orders"].filter("o_orderstatus <> 'P'")),
        "part": (t["part"], t["part"]),
    }


OPERATORS["dq_load_rate"] = (
    lambda t: load_rate(_load_pairs(t)),
    f"""with c as (
            select 'customer' as table_name, count(*) as s, count(*) filter (where c_acctbal > 0) as l from customer
            union all select 'orders', count(*), count(*) filter (where o_orderstatus <> 'P') from orders
            union all select 'part', count(*), count(*) from part)
        select coalesce(table_name, 'TOTAL') as table_name, {isum('s')} as source_rows, {isum('l')} as loaded_rows,
               {rounded('sum(l)', 'sum(s)', 1, 100)} as loaded_pct
        from c group by rollup (table_name)""",
)


def _stored(t: Tables):
    """Games whose stored difference is wrong where the attendance is unknown."""
    wrong = F.col("attendance") == -1
    return t.mart["fact_games"].withColumn(
        "goal_difference", F.when(wrong, F.col("goal_difference") + 1).otherwise(F.col("goal_difference"))
    )


OPERATORS["dq_verify_derived"] = (
    lambda t: verify_derived(
        _stored(t),
        {
            "goal_difference": F.col("home_club_goals") - F.col("away_club_goals"),
            "total_goals": F.col("home_club_goals") + F.col("away_club_goals"),
            "is_draw": F.col("home_club_goals") == F.col("away_club_goals"),
        },
    ),
    with_mart("fact_games", """
    select count(*) as row_count, count(*) filter (where attendance <> -1) as goal_difference_ok,
           count(*) as total_goals_ok, count(*) as is_draw_ok from fact_games"""),
)
OPERATORS["dq_key_check"] = (
    lambda t: key_check(t["lineitem"], ["l_orderkey", "l_linenumber"]),
    f"""select min(l_orderkey) as min_key, max(l_orderkey) as max_key, {isum('n')} as row_count,
               count(*) as distinct_keys, {isum('n')} - count(*) as extra_rows
        from (select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2) k""",
)
OPERATORS["dq_value_counts"] = (
    lambda t: value_counts(t["events"], "event_type", 3),
    """select event_type, count(*) as row_count from events group by event_type
       order by row_count desc, event_type limit 3""",
)


def _reject_rules(t: Tables):
    return {
        "cheap order": F.col("o_totalprice") < 20000,
        "pending": F.col("o_orderstatus") == "P",
        "customer unknown": ("o_custkey", t["customer"].filter("c_acctbal > 0"), "c_custkey"),
    }


OPERATORS["dq_reject_counts"] = (
    lambda t: reject_counts(t["orders"], _reject_rules(t)),
    """select 'cheap order' as rule, count(*) as rejected from orders where o_totalprice < 20000
       union all select 'pending', count(*) from orders where o_orderstatus = 'P'
       union all select 'customer unknown', count(*) from orders
           where o_custkey not in (select c_custkey from customer where c_acctbal > 0)""",
)
_VALIDITY = """, v as (
        select game_id, home_club_id, away_club_id, home_club_id in (select club_id from dim_clubs
                   where domestic_competition_id <> 'GB1') as home_ok,
               away_club_id in (select club_id from dim_clubs where domestic_competition_id <> 'GB1') as away_ok
        from fact_games)"""


def _valid_clubs(t: Tables):
    return t.mart["dim_clubs"].filter("domestic_competition_id <> 'GB1'")


OPERATORS["dq_reject_classes"] = (
    lambda t: reject_classes(t.mart["fact_games"], "home_club_id", "away_club_id", _valid_clubs(t), "club_id"),
    with_mart("fact_games dim_clubs", f"""{_VALIDITY}
    {' union all '.join(
        f"select '{name}' as reject_class, count(*) filter (where {c}) as row_count, "
        f"{rounded(f'count(*) filter (where {c})', 'count(*)', 1, 100)} as pct from v"
        for name, c in (("both_valid", "home_ok and away_ok"), ("first_invalid", "not home_ok"),
                        ("second_invalid", "not away_ok"), ("both_invalid", "not home_ok and not away_ok")))}"""),
)
OPERATORS["dq_reject_examples"] = (
    lambda t: reject_examples(
        t.mart["fact_games"],
        {
            "home_club_id no existe": ("home_club_id", _valid_clubs(t), "club_id"),
            "away_club_id no existe": ("away_club_id", _valid_clubs(t), "club_id"),
        },
        5, [F.asc("game_id")], ["game_id", "home_club_id", "away_club_id"],
    ),
    with_mart("fact_games dim_clubs", f"""{_VALIDITY}
    select game_id, home_club_id, away_club_id,
           concat_ws(' AND ', case when not home_ok then 'home_club_id no existe' end,
                     case when not away_ok then 'away_club_id no existe' end) as reason
    from v where not (home_ok and away_ok) order by game_id limit 5"""),
)
OPERATORS["dq_cascade"] = (
    lambda t: cascade_counts(
        t.mart["fact_appearances"], orphans(t.mart["fact_games"], "home_club_id", _valid_clubs(t), "club_id"), "game_id"
    ),
    with_mart("fact_appearances fact_games dim_clubs", f"""{_VALIDITY}
    select game_id, count(*) as lost_rows from fact_appearances
    where game_id in (select game_id from v where not home_ok) group by game_id"""),
)


def _audit(table: str, column: str) -> str:
    return f"""select '{table}' as table_name, '{column}' as fk_column, count(*) filter (where {column} = -1) as sentinel_rows,
        count(*) filter (where {column} <> -1) as real_rows, count(*) as total_rows,
        {rounded(f'count(*) filter (where {column} = -1)', 'count(*)', 1, 100)} as unknown_pct from {table}"""


OPERATORS["dq_sentinel_audit"] = (
    lambda t: sentinel_audit(
        {
            "fact_transfers": (t.mart["fact_transfers"], ["from_club_id", "to_club_id"]),
            "fact_game_events": (t.mart["fact_game_events"], ["player_in_id", "player_assist_id"]),
        }
    ).orderBy("table_name", "fk_column"),
    with_mart("fact_transfers fact_game_events", " union all ".join(
        _audit(*pair) for pair in (
            ("fact_transfers", "from_club_id"), ("fact_transfers", "to_club_id"),
            ("fact_game_events", "player_in_id"), ("fact_game_events", "player_assist_id")))),
)
OPERATORS["dq_sample_rows"] = (
    lambda t: sample_rows(
        t.mart["fact_games"].select("game_id", "home_club_goals", "away_club_goals"), F.col("home_club_goals") > 3, 5,
        [F.asc("game_id")],
    ),
    with_mart("fact_games", """
    select game_id, home_club_goals, away_club_goals from fact_games where home_club_goals > 3 order by game_id limit 5"""),
)
