"""Aggregations, grouping sets, pivots and scalar functions."""

from pyspark.sql import functions as F

from starmart.functions import (
    avg_where,
    bucket,
    concat_text,
    count_where,
    date_text,
    distinct_ids,
    highest,
    label,
    leading_token,
    lowest,
    n_distinct,
    n_distinct_where,
    number,
    per_90,
    period_label,
    quotient,
    ratio,
    scaled,
    string_list,
    sum_case,
    sum_where,
    total,
    word,
)
from starmart.operators import (
    aggregate,
    cube,
    distinct_counts,
    drill_down,
    exact_median,
    grouping_sets,
    level_label,
    pivot,
    roll_up,
    share_of_total,
    tally,
)
from checks.sql import isum, msum, rounded
from checks.testmart import Tables, with_mart

OPERATORS: dict[str, tuple] = {}

PRICE_SQL = "cast(l_extendedprice as decimal(15,2))"
QUANTITY_SQL = "cast(l_quantity as bigint)"


def _lines(t: Tables):
    """Line items with an exact price and a whole quantity."""
    return t["lineitem"].withColumns(
        {"price": F.col("l_extendedprice").cast("decimal(15,2)"), "quantity": F.col("l_quantity").cast("bigint")}
    )


OPERATORS["agg_basic"] = (
    lambda t: aggregate(
        _lines(t), ["l_returnflag", "l_linestatus"],
        {
            "row_count": F.count(F.lit(1)),
            "price": F.sum("price"),
            "mean_quantity": ratio(F.sum("quantity"), F.count(F.lit(1))),
            "lowest": F.min("price"),
            "highest": F.max("price"),
            "quantity_and_line": F.sum(F.col("quantity") + F.col("l_linenumber")),
        },
    ),
    f"""select l_returnflag, l_linestatus, count(*) as row_count, {msum(PRICE_SQL)} as price,
               cast(sum({QUANTITY_SQL}) as double) / count(*) as mean_quantity,
               cast(min({PRICE_SQL}) as double) as lowest, cast(max({PRICE_SQL}) as double) as highest,
               {isum(f'{QUANTITY_SQL} + l_linenumber')} as quantity_and_line
        from lineitem group by l_returnflag, l_linestatus""",
)
OPERATORS["agg_filter"] = (
    lambda t: aggregate(
        _lines(t), ["l_returnflag"],
        {
            "large_price": sum_where("price", F.col("quantity") > 40),
            "large_rows": count_where(F.col("quantity") > 40),
            "large_mean_line": avg_where("l_linenumber", F.col("quantity") > 40),
        },
    ),
    f"""select l_returnflag, cast(sum({PRICE_SQL}) filter (where l_quantity > 40) as double) as large_price,
               count(*) filter (where l_quantity > 40) as large_rows,
               cast(sum(l_linenumber) filter (where l_quantity > 40) as double)
                   / count(*) filter (where l_quantity > 40) as large_mean_line
        from lineitem group by l_returnflag""",
)
OPERATORS["agg_case"] = (
    lambda t: aggregate(
        _lines(t), ["l_linestatus"],
        {
            "returned": sum_case(F.col("l_returnflag") == "R"),
            "returned_price": sum_case(F.col("l_returnflag") == "R", "price"),
        },
    ),
    f"""select l_linestatus, cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as returned,
               {msum(f"case when l_returnflag = 'R' then {PRICE_SQL} else 0 end")} as returned_price
        from lineitem group by l_linestatus""",
)
OPERATORS["agg_count_distinct"] = (
    lambda t: aggregate(t["lineitem"], ["l_returnflag"], {"parts": n_distinct("l_partkey")}),
    "select l_returnflag, count(distinct l_partkey) as parts from lineitem group by l_returnflag",
)
OPERATORS["agg_multi_distinct"] = (
    lambda t: distinct_counts(
        t["lineitem"], ["l_returnflag"], {"parts": "l_partkey", "suppliers": "l_suppkey", "orders": "l_orderkey"},
        {"row_count": F.count(F.lit(1))},
    ),
    """select l_returnflag, count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers,
              count(distinct l_orderkey) as orders, count(*) as row_count from lineitem group by l_returnflag""",
)
OPERATORS["agg_distinct_rollup"] = (
    lambda t: roll_up(
        t["lineitem"], ["l_returnflag", "l_linestatus"],
        {
            "suppliers": distinct_ids("l_suppkey"), "last_part": highest("l_partkey"), "first_part": lowest("l_partkey"),
            "mean_lines": quotient(number(), number(F.col("l_linenumber") == 1), 2),
        },
    ),
    """select l_returnflag, l_linestatus, count(distinct l_suppkey) as suppliers, max(l_partkey) as last_part,
              min(l_partkey) as first_part,
              cast(round(cast(count(*) as decimal(26,4)) / count(*) filter (l_linenumber = 1), 2) as double) as mean_lines
       from lineitem group by rollup (l_returnflag, l_linestatus)""",
)
OPERATORS["agg_tally"] = (
    lambda t: tally(
        t["lineitem"], ["l_returnflag"], ["l_linenumber"],
        {"suppliers": "l_suppkey", "parts": "l_partkey", "states": "l_linestatus"}, {"state_list": "l_linestatus"},
    ).withColumn("state_list", F.array_join("state_list", ", ")),
    """select l_returnflag, cast(sum(l_linenumber) as bigint) as l_linenumber, count(distinct l_suppkey) as suppliers,
              count(distinct l_partkey) as parts, count(distinct l_linestatus) as states,
              array_to_string(list_sort(list(distinct l_linestatus)), ', ') as state_list
       from lineitem group by l_returnflag""",
)
OPERATORS["agg_distinct_filter"] = (
    lambda t: aggregate(
        t["lineitem"], ["l_returnflag"],
        {
            "open_parts": n_distinct_where("l_partkey", F.col("l_linestatus") == "O"),
            "done_parts": n_distinct_where("l_partkey", F.col("l_linestatus") == "F"),
        },
    ),
    """select l_returnflag, count(distinct l_partkey) filter (where l_linestatus = 'O') as open_parts,
              count(distinct l_partkey) filter (where l_linestatus = 'F') as done_parts
       from lineitem group by l_returnflag""",
)
OPERATORS["agg_string_distinct"] = (
    lambda t: aggregate(
        t["part"], ["p_name"], {"brands": string_list("p_brand"), "types": string_list("p_type", " --> ")}
    ),
    """select p_name, string_agg(distinct p_brand, ', ' order by p_brand) as brands,
              string_agg(distinct p_type, ' --> ' order by p_type) as types from part group by p_name""",
)
OPERATORS["agg_median"] = (
    lambda t: exact_median(_lines(t).filter(F.col("quantity") > 5), ["l_returnflag", "l_linestatus"], "price", "median_price"),
    f"""select l_returnflag, l_linestatus, quantile_cont(cast({PRICE_SQL} as double), 0.5) as median_price
        from lineitem where l_quantity > 5 group by l_returnflag, l_linestatus""",
)
OPERATORS["agg_median_total"] = (
    lambda t: exact_median(t["orders"].withColumn("price", F.col("o_totalprice").cast("decimal(15,2)")), [], "price", "median_price"),
    "select quantile_cont(o_totalprice, 0.5) as median_price from orders",
)
OPERATORS["agg_having"] = (
    lambda t: aggregate(
        t["orders"], ["o_custkey"], {"orders": F.count(F.lit(1))}, having=F.col("orders") >= 12
    ),
    "select o_custkey, count(*) as orders from orders group by o_custkey having count(*) >= 12",
)


def _calendar_orders(t: Tables):
    day = F.col("o_orderdate").cast("date")
    return t["orders"].select(
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"), "o_orderstatus",
        "o_orderpriority", F.col("o_totalprice").cast("decimal(15,2)").alias("price"),
    )


_CALENDAR_ORDERS = """(select year(o_orderdate) as year, quarter(o_orderdate) as quarter, month(o_orderdate) as month,
        o_orderstatus, o_orderpriority, cast(o_totalprice as decimal(15,2)) as price from orders) o"""
OPERATORS["agg_rollup"] = (
    lambda t: roll_up(
        _calendar_orders(t), ["year", "quarter", "month"], {"orders": number(), "total": total("price")}
    ),
    f"""select year, quarter, month, count(*) as orders, {msum('price')} as total from {_CALENDAR_ORDERS}
        group by rollup (year, quarter, month)""",
)
OPERATORS["agg_rollup_partial"] = (
    lambda t: roll_up(_calendar_orders(t), ["year"], {"orders": F.count(F.lit(1))}, fixed=["o_orderstatus"]),
    f"""select year, o_orderstatus, count(*) as orders from {_CALENDAR_ORDERS}
        group by grouping sets ((year, o_orderstatus), (o_orderstatus))""",
)
OPERATORS["agg_cube"] = (
    lambda t: cube(
        _calendar_orders(t), ["year", "o_orderstatus", "o_orderpriority"],
        {"level": F.grouping_id().cast("int"), "orders": number()},
    ),
    f"""select year, o_orderstatus, o_orderpriority,
               cast(grouping(year, o_orderstatus, o_orderpriority) as int) as level, count(*) as orders
        from {_CALENDAR_ORDERS} group by cube (year, o_orderstatus, o_orderpriority)""",
)
OPERATORS["agg_grouping_sets"] = (
    lambda t: grouping_sets(
        _calendar_orders(t), [["year", "o_orderstatus"], ["year"], ["o_orderstatus"], []],
        {"orders": number(), "total": total("price")},
    ),
    f"""select year, o_orderstatus, count(*) as orders, {msum('price')} as total from {_CALENDAR_ORDERS}
        group by grouping sets ((year, o_orderstatus), (year), (o_orderstatus), ())""",
)
OPERATORS["agg_grouping_flag"] = (
    lambda t: grouping_sets(
        _calendar_orders(t).withColumn("status", F.nullif("o_orderstatus", F.lit("P"))), [["year", "status"], ["year"]],
        {
            "status_label": level_label("status", "** ALL **"),
            "is_total": F.grouping("status").cast("int"),
            "orders": F.count(F.lit(1)),
        },
    ).drop("status"),
    f"""select year, case when grouping(status) = 1 then '** ALL **' else status end as status_label,
               cast(grouping(status) as int) as is_total, count(*) as orders
        from (select *, nullif(o_orderstatus, 'P') as status from {_CALENDAR_ORDERS}) s
        group by grouping sets ((year, status), (year))""",
)
OPERATORS["agg_pivot"] = (
    lambda t: pivot(
        _calendar_orders(t), ["year"], "o_orderstatus", {"F": "finished", "O": "open"}, "price", "total"
    ),
    f"""select year, cast(sum(price) filter (where o_orderstatus = 'F') as double) as finished,
               cast(sum(price) filter (where o_orderstatus = 'O') as double) as open, {msum('price')} as total
        from {_CALENDAR_ORDERS} group by year""",
)
OPERATORS["agg_pivot_counts"] = (
    lambda t: pivot(
        _calendar_orders(t), ["o_orderpriority"], "o_orderstatus", {"F": "finished", "O": "open", "P": "pending"},
        total="total", counted=True,
    ),
    f"""select o_orderpriority, count(*) filter (where o_orderstatus = 'F') as finished,
               count(*) filter (where o_orderstatus = 'O') as open,
               count(*) filter (where o_orderstatus = 'P') as pending, count(*) as total
        from {_CALENDAR_ORDERS} group by o_orderpriority""",
)
OPERATORS["agg_drill_down"] = (
    lambda t: drill_down(_calendar_orders(t), ["year", "quarter", "month"], (1997, 2), {"orders": F.count(F.lit(1))}),
    f"""select year, quarter, month, count(*) as orders from {_CALENDAR_ORDERS} where year = 1997 and quarter = 2
        group by year, quarter, month""",
)
OPERATORS["agg_ratio"] = (
    lambda t: aggregate(
        t.mart["fact_appearances"], ["club_id"],
        {
            "goals_per_line": ratio(F.sum("goals"), F.count(F.lit(1))),
            "goals_per_red": ratio(F.sum("goals"), F.sum("red_cards"), 2),
            "goals_per_90": per_90(F.sum("goals"), F.sum("minutes_played"), 3),
        },
    ),
    with_mart("fact_appearances", f"""
    select club_id, cast(sum(goals) as double) / count(*) as goals_per_line,
           {rounded('sum(goals)', 'sum(red_cards)', 2)} as goals_per_red,
           {rounded('sum(goals)', 'sum(minutes_played)', 3, 90)} as goals_per_90
    from fact_appearances group by club_id"""),
)
_SIZES = ((1, 10, "small"), (11, 30, "medium"), (31, None, "large"))
OPERATORS["agg_bucket"] = (
    lambda t: aggregate(
        t["part"], [bucket("p_size", _SIZES, "unknown").alias("size_band")],
        {"parts": F.count(F.lit(1)), "first_size": F.min("p_size")},
    ),
    """select case when p_size between 1 and 10 then 'small' when p_size between 11 and 30 then 'medium'
                   when p_size >= 31 then 'large' else 'unknown' end as size_band,
              count(*) as parts, min(p_size) as first_size from part group by 1""",
)
OPERATORS["agg_two_level"] = (
    lambda t: aggregate(
        aggregate(t["orders"], ["o_custkey"], {"n": F.count(F.lit(1))}), ["n"],
        {"customers": F.count(F.lit(1)), "orders": F.sum("n")},
    ),
    f"""select n, count(*) as customers, {isum('n')} as orders
        from (select o_custkey, count(*) as n from orders group by o_custkey) c group by n""",
)
OPERATORS["win_share_of_total"] = (
    lambda t: share_of_total(
        aggregate(t["orders"], ["o_orderpriority"], {"orders": F.count(F.lit(1))}), "orders", "share_pct", 1
    ),
    f"""select o_orderpriority, count(*) as orders, {rounded('count(*)', 'sum(count(*)) over ()', 1, 100)} as share_pct
        from orders group by o_orderpriority""",
)

# -- scalar functions --------------------------------------------------------------------------

OPERATORS["fn_round"] = (
    lambda t: _lines(t).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        ratio(F.col("price"), F.col("quantity"), 2).alias("unit_price"),
        ratio(F.col("price"), F.col("quantity"), 0).alias("whole_price"),
    ),
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, {rounded(PRICE_SQL, 'l_quantity', 2)} as unit_price,
               {rounded(PRICE_SQL, 'l_quantity', 0)} as whole_price from lineitem""",
)
OPERATORS["fn_nullif_coalesce"] = (
    lambda t: t["orders"].select(
        "o_orderkey", F.coalesce(F.nullif("o_orderstatus", F.lit("P")), "o_orderpriority").alias("status_or_priority")
    ),
    "select o_orderkey, coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) as status_or_priority from orders",
)
OPERATORS["fn_case"] = (
    lambda t: t["orders"].select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 300000, "high").when(F.col("o_totalprice") < 50000, "low").otherwise("middle").alias("band"),
    ),
    """select o_orderkey, case when o_totalprice > 300000 then 'high' when o_totalprice < 50000 then 'low'
                               else 'middle' end as band from orders""",
)
OPERATORS["fn_string_format"] = (
    lambda t: t["orders"].select(
        "o_orderkey",
        concat_text(F.col("o_orderstatus"), F.lit(" vs "), F.col("o_orderpriority")).alias("pair"),
        period_label(F.year("o_orderdate"), F.month("o_orderdate")).alias("period"),
        period_label(F.year("o_orderdate"), F.month("o_orderdate"), F.date_format("o_orderdate", "MMMM")).alias("named_period"),
        date_text("o_orderdate").alias("day_text"),
    ),
    """select o_orderkey, o_orderstatus || ' vs ' || o_orderpriority as pair,
              strftime(o_orderdate, '%Y-%m') as period, strftime(o_orderdate, '%Y-%m (%B)') as named_period,
              strftime(o_orderdate, '%d/%m/%Y') as day_text from orders""",
)
OPERATORS["fn_scale"] = (
    lambda t: aggregate(
        _lines(t), ["l_shipdate"], {"price_m": scaled(F.sum("price"), 1_000_000, 2)}
    ).select(F.col("l_shipdate").cast("date").alias("ship_date"), "price_m"),
    f"""select cast(l_shipdate as date) as ship_date, {rounded(f'sum({PRICE_SQL})', '1000000', 2)} as price_m
        from lineitem group by l_shipdate""",
)
OPERATORS["fn_abs"] = (
    lambda t: t.mart["fact_games"].select("game_id", F.abs("goal_difference").alias("difference")),
    with_mart("fact_games", "select game_id, abs(goal_difference) as difference from fact_games"),
)
OPERATORS["fn_words"] = (
    lambda t: t["part"].select(
        "p_partkey", word("p_name", 1).alias("first_word"), word("p_name", -1).alias("last_word"),
        word("p_name", 3).alias("third_word"), leading_token("p_name").alias("leading"),
    ),
    """select p_partkey, split_part(p_name, ' ', 1) as first_word, split_part(p_name, ' ', -1) as last_word,
              nullif(split_part(p_name, ' ', 3), '') as third_word, regexp_extract(p_name, '^(\\S+)', 1) as leading
       from part""",
)
OPERATORS["fn_map_label"] = (
    lambda t: t["orders"].select("o_orderkey", label("o_orderstatus", {"F": "finished", "O": "open"}).alias("status")),
    """select o_orderkey, case o_orderstatus when 'F' then 'finished' when 'O' then 'open' else o_orderstatus end as status
       from orders""",
)
