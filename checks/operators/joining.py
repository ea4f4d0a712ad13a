"""Selection, joins and set operations."""

from pyspark.sql import functions as F

from starmart.functions import between, concat_text, matches
from starmart.operators import (
    aggregate,
    any_of,
    balance,
    child_counts,
    dice,
    drill_across,
    either_role,
    known,
    lookup_key,
    orphans,
    restrict_to_top,
    semi,
    slice_,
    star_join,
    two_perspectives,
    union_all,
)
from checks.sql import isum, msum
from checks.testmart import Tables, with_mart

OPERATORS: dict[str, tuple] = {}

# -- selection ---------------------------------------------------------------------------------

OPERATORS["olap_slice"] = (
    lambda t: slice_(t["orders"], "o_orderstatus", "F").select("o_orderkey", "o_orderstatus"),
    "select o_orderkey, o_orderstatus from orders where o_orderstatus = 'F'",
)
OPERATORS["olap_dice"] = (
    lambda t: dice(
        t["lineitem"],
        {"l_returnflag": "A", "l_linenumber": [1, 2, 3], "l_quantity": between(10, 20)},
    ).select("l_orderkey", "l_partkey", "l_returnflag", "l_linenumber", "l_quantity"),
    """select l_orderkey, l_partkey, l_returnflag, l_linenumber, l_quantity from lineitem
       where l_returnflag = 'A' and l_linenumber in (1, 2, 3) and l_quantity between 10 and 20""",
)
OPERATORS["flt_in_list"] = (
    lambda t: dice(
        t["orders"],
        {"o_orderpriority": ["1-URGENT", "2-HIGH"], "o_orderstatus": lambda c: ~c.isin("F", "P")},
    ).select("o_orderkey", "o_orderpriority", "o_orderstatus"),
    """select o_orderkey, o_orderpriority, o_orderstatus from orders
       where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus not in ('F', 'P')""",
)
OPERATORS["flt_between"] = (
    lambda t: dice(
        t["orders"], {"o_orderdate": between(F.lit("1997-01-01").cast("date"), F.lit("1997-12-31").cast("date"))}
    ).select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date")),
    """select o_orderkey, cast(o_orderdate as date) as order_date from orders
       where o_orderdate between date '1997-01-01' and date '1997-12-31'""",
)
OPERATORS["flt_or"] = (
    lambda t: any_of(t["lineitem"], [F.col("l_quantity") > 45, F.col("l_discount") > 0.09])
    .groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("row_count")),
    """select l_returnflag, count(*) as row_count from lineitem
       where l_quantity > 45 or l_discount > 0.09 group by l_returnflag""",
)
OPERATORS["flt_ilike"] = (
    lambda t: t["part"].filter(matches("p_name", "%RING%")).select("p_partkey", "p_name"),
    "select p_partkey, p_name from part where p_name ilike '%ring%'",
)
OPERATORS["flt_bool"] = (
    lambda t: t.mart["fact_games"].filter(F.col("is_home_win") & ~F.col("is_draw")).groupBy("competition_id")
    .agg(F.count(F.lit(1)).alias("home_wins")),
    with_mart("fact_games", """
    select competition_id, count(*) as home_wins from fact_games where is_home_win and not is_draw
    group by competition_id"""),
)
OPERATORS["flt_known"] = (
    lambda t: known(t.mart["fact_transfers"], "from_club_id").filter(F.col("transfer_fee") > 0)
    .groupBy("from_club_id").agg(F.count(F.lit(1)).alias("moves"), F.sum("transfer_fee").alias("fees")),
    with_mart("fact_transfers", f"""
    select from_club_id, count(*) as moves, {msum('transfer_fee')} as fees from fact_transfers
    where from_club_id <> -1 and transfer_fee > 0 group by from_club_id"""),
)


def _scalar_lookup(t: Tables):
    club = lookup_key(t["nation"], "n_name", "%NATION_2%", "n_nationkey")
    return t["customer"].filter(F.col("c_nationkey") == club).select("c_custkey", "c_nationkey")


OPERATORS["flt_scalar_lookup"] = (
    _scalar_lookup,
    """select c_custkey, c_nationkey from customer
       where c_nationkey = (select min(n_nationkey) from nation where n_name ilike '%nation_2%')""",
)

# -- joins -------------------------------------------------------------------------------------

OPERATORS["join_star"] = (
    lambda t: aggregate(
        star_join(
            t["lineitem"],
            [
                ("l_suppkey", t["supplier"], "s_suppkey", {"s_nationkey": "nation_key"}),
                ("nation_key", t["nation"], "n_nationkey", {"n_name": "nation", "n_regionkey": "region_key"}),
                ("region_key", t["region"], "r_regionkey", {"r_name": "region"}),
            ],
        ),
        ["region", "nation"], {"quantity": F.sum(F.col("l_quantity").cast("bigint"))},
    ),
    f"""select r_name as region, n_name as nation, {isum('cast(l_quantity as bigint)')} as quantity
       from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
            join region on n_regionkey = r_regionkey
       group by r_name, n_name""",
)
OPERATORS["join_left"] = (
    lambda t: aggregate(
        star_join(
            t.mart["dim_clubs"],
            [("domestic_competition_id", t.mart["dim_competitions"], "competition_id", {"name": "league"})], "left",
        ),
        ["league"], {"clubs": F.count(F.lit(1))},
    ),
    with_mart("dim_clubs dim_competitions", """
    select comp.name as league, count(*) as clubs
    from dim_clubs left join dim_competitions comp on domestic_competition_id = competition_id group by comp.name"""),
)
OPERATORS["join_left_filtered"] = (
    lambda t: slice_(
        star_join(
            t.mart["dim_clubs"],
            [("domestic_competition_id", t.mart["dim_competitions"], "competition_id", {"confederation": "confederation"})],
            "left",
        ),
        "confederation", "europa",
    ).select("club_id", "confederation"),
    with_mart("dim_clubs dim_competitions", """
    select club_id, confederation from dim_clubs
         left join dim_competitions on domestic_competition_id = competition_id where confederation = 'europa'"""),
)
OPERATORS["join_role_playing"] = (
    lambda t: aggregate(
        star_join(
            t.mart["fact_transfers"],
            [
                ("from_club_id", t.mart["dim_clubs"], "club_id", {"name": "seller"}),
                ("to_club_id", t.mart["dim_clubs"], "club_id", {"name": "buyer"}),
            ],
        ),
        ["seller", "buyer"], {"moves": F.count(F.lit(1))},
    ),
    with_mart("fact_transfers dim_clubs", """
    select s.name as seller, b.name as buyer, count(*) as moves
    from fact_transfers join dim_clubs s on from_club_id = s.club_id join dim_clubs b on to_club_id = b.club_id
    group by s.name, b.name"""),
)


def _customers_and_suppliers(t: Tables):
    customers = t["customer"].filter(F.col("c_acctbal") > 9000).groupBy(F.col("c_nationkey").alias("nation_key"))
    suppliers = t["supplier"].filter(F.col("s_acctbal") > 5000).groupBy(F.col("s_nationkey").alias("nation_key"))
    return (
        customers.agg(F.count(F.lit(1)).alias("customers")),
        suppliers.agg(F.count(F.lit(1)).alias("suppliers")),
    )


_CUSTOMERS_AND_SUPPLIERS = """
    from (select c_nationkey as nation_key, count(*) as customers from customer where c_acctbal > 9000 group by 1) c
         full join (select s_nationkey as nation_key, count(*) as suppliers from supplier where s_acctbal > 5000 group by 1) s
         on c.nation_key = s.nation_key"""
OPERATORS["join_full_outer"] = (
    lambda t: balance(*_customers_and_suppliers(t), "nation_key"),
    f"select coalesce(c.nation_key, s.nation_key) as nation_key, customers, suppliers {_CUSTOMERS_AND_SUPPLIERS}",
)
OPERATORS["olap_balance"] = (
    lambda t: balance(*_customers_and_suppliers(t), "nation_key", measures=["customers", "suppliers"])
    .withColumn("net", F.col("customers") - F.col("suppliers")),
    f"""select coalesce(c.nation_key, s.nation_key) as nation_key, coalesce(customers, 0) as customers,
               coalesce(suppliers, 0) as suppliers, coalesce(customers, 0) - coalesce(suppliers, 0) as net
        {_CUSTOMERS_AND_SUPPLIERS}""",
)


def _either_role(t: Tables):
    sides = either_role(t.mart["fact_games"], "home_club_id", "away_club_id", "club_id", ["total_goals"])
    named = star_join(sides, [("club_id", t.mart["dim_clubs"], "club_id", {"name": "club"})])
    return aggregate(
        named, ["club"],
        {
            "games": F.count(F.lit(1)),
            "at_home": F.count_if("is_first"),
            "away": F.count_if("is_second"),
            "goals": F.sum("total_goals"),
        },
    )


OPERATORS["join_either_role"] = (
    _either_role,
    with_mart("fact_games dim_clubs", f"""
    select name as club, count(*) as games, count(*) filter (where home_club_id = club_id) as at_home,
           count(*) filter (where away_club_id = club_id) as away, {isum('total_goals')} as goals
    from fact_games join dim_clubs on home_club_id = club_id or away_club_id = club_id group by name"""),
)


def _drill_across(t: Tables):
    games = aggregate(t.mart["fact_games"], ["competition_id"], {"goals": F.sum("total_goals")})
    lines = aggregate(t.mart["fact_appearances"], ["competition_id"], {"cards": F.sum("yellow_cards")})
    events = aggregate(t.mart["fact_game_events"], ["competition_id"], {"events": F.count(F.lit(1))})
    return drill_across([games, lines, events], ["competition_id"])


OPERATORS["join_drill_across"] = (
    _drill_across,
    with_mart("fact_games fact_appearances fact_game_events", f"""
    select competition_id, goals, cards, events
    from (select competition_id, {isum('total_goals')} as goals from fact_games group by 1) g
         left join (select competition_id, {isum('yellow_cards')} as cards from fact_appearances group by 1) a using (competition_id)
         left join (select competition_id, count(*) as events from fact_game_events group by 1) e using (competition_id)"""),
)
OPERATORS["join_preagg_children"] = (
    lambda t: child_counts(
        t["orders"].select("o_orderkey"), t["lineitem"].withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey",
        {"returned": F.col("l_returnflag") == "R", "open_lines": F.col("l_linestatus") == "O"},
    ),
    """select o_orderkey, count(l_orderkey) filter (where l_returnflag = 'R') as returned,
              count(l_orderkey) filter (where l_linestatus = 'O') as open_lines
       from orders left join lineitem on o_orderkey = l_orderkey group by o_orderkey""",
)


def _top_parts(t: Tables):
    ranked = aggregate(t["lineitem"], ["l_partkey"], {"quantity": F.sum(F.col("l_quantity").cast("bigint"))})
    lines = t["lineitem"].select("l_partkey", "l_orderkey", "l_linenumber")
    return restrict_to_top(lines, ranked, "l_partkey", 5, [F.desc("quantity"), F.asc("l_partkey")])


OPERATORS["join_topn_subset"] = (
    _top_parts,
    f"""select l_partkey, l_orderkey, l_linenumber, quantity from lineitem join (
           select l_partkey, {isum('cast(l_quantity as bigint)')} as quantity from lineitem group by l_partkey
           order by quantity desc, l_partkey limit 5) best using (l_partkey)""",
)
OPERATORS["join_using"] = (
    lambda t: t.mart["fact_player_valuations"].join(t.mart["dim_players"].select("player_id", "name"), "player_id")
    .groupBy("name").agg(F.max("market_value_in_eur").alias("peak")),
    with_mart("fact_player_valuations dim_players", """
    select name, cast(max(market_value_in_eur) as double) as peak
    from fact_player_valuations join dim_players using (player_id) group by name"""),
)
OPERATORS["join_semi"] = (
    lambda t: semi(t["customer"], "c_custkey", t["orders"].filter("o_totalprice > 400000"), "o_custkey")
    .select("c_custkey", "c_name"),
    "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_totalprice > 400000)",
)
OPERATORS["join_anti"] = (
    lambda t: orphans(t["customer"], "c_custkey", t["orders"].filter("o_totalprice > 400000"), "o_custkey")
    .select("c_custkey", "c_name"),
    """select c_custkey, c_name from customer
       where c_custkey not in (select o_custkey from orders where o_totalprice > 400000)""",
)

# -- set operations ----------------------------------------------------------------------------

OPERATORS["set_union_all"] = (
    lambda t: union_all(
        t["customer"].select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation_key")),
        t["supplier"].select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nation_key")),
    ),
    """select 'customer' as kind, c_nationkey as nation_key from customer
       union all select 'supplier', s_nationkey from supplier""",
)


def _perspectives(t: Tables):
    def view(club: str, scored: str, conceded: str) -> dict:
        return {"club_id": F.col(club).cast("bigint"), "scored": F.col(scored), "conceded": F.col(conceded)}

    sides = two_perspectives(
        t.mart["fact_games"],
        [
            view("home_club_id", "home_club_goals", "away_club_goals"),
            view("away_club_id", "away_club_goals", "home_club_goals"),
        ],
    )
    return aggregate(
        sides, ["club_id"], {"games": F.count(F.lit(1)), "scored": F.sum("scored"), "conceded": F.sum("conceded")}
    )


OPERATORS["set_two_perspectives"] = (
    _perspectives,
    with_mart("fact_games", f"""
    select cast(club_id as bigint) as club_id, count(*) as games, {isum('scored')} as scored, {isum('conceded')} as conceded
    from (select home_club_id as club_id, home_club_goals as scored, away_club_goals as conceded from fact_games
          union all select away_club_id, away_club_goals, home_club_goals from fact_games) s
    group by club_id"""),
)
OPERATORS["fn_project"] = (
    lambda t: t["part"].select(
        "p_partkey", F.lit("part").alias("kind"), concat_text(F.col("p_brand"), F.lit("/"), F.col("p_type")).alias("code"),
        (F.col("p_size") * 2).alias("double_size"),
    ),
    "select p_partkey, 'part' as kind, p_brand || '/' || p_type as code, p_size * 2 as double_size from part",
)
