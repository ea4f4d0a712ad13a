"""Sorting, top-k, ranks, tiles and period windows."""

from pyspark.sql import functions as F

from starmart.operators import (
    aggregate,
    moving_avg,
    order,
    period_change,
    running_total,
    tiers,
    top_by_any,
    top_overall,
    top_per_group,
    vs_group,
)
from checks.sql import rounded
from checks.testmart import Tables

OPERATORS: dict[str, tuple] = {}


def _customer_totals(t: Tables):
    return aggregate(
        t["orders"], ["o_custkey"],
        {"orders": F.count(F.lit(1)), "spent": F.sum(F.col("o_totalprice").cast("decimal(15,2)"))},
    )


def _by_nation(t: Tables):
    totals = _customer_totals(t).withColumnRenamed("o_custkey", "c_custkey")
    return totals.join(t["customer"].select("c_custkey", "c_nationkey"), "c_custkey")


_TOTALS = """(select o_custkey, count(*) as orders, sum(cast(o_totalprice as decimal(15,2))) as spent
              from orders group by o_custkey) c"""
_NATIONS = f"(select o_custkey as c_custkey, orders, spent, c_nationkey from {_TOTALS} join customer on o_custkey = c_custkey) n"

OPERATORS["sort_nulls_last"] = (
    lambda t: order(
        t["orders"].select(F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_orderkey"),
        [("status", "desc", "last"), ("o_orderkey", "asc", "last")],
    ),
    "select nullif(o_orderstatus, 'P') as status, o_orderkey from orders order by status desc nulls last, o_orderkey",
)
OPERATORS["sort_multi"] = (
    lambda t: order(
        t["part"].select("p_brand", "p_size", "p_partkey"),
        [("p_brand", "asc", "last"), ("p_size", "desc", "last"), ("p_partkey", "asc", "last")],
    ),
    "select p_brand, p_size, p_partkey from part order by p_brand, p_size desc, p_partkey",
)
OPERATORS["sort_topk"] = (
    lambda t: top_overall(_customer_totals(t), [F.desc_nulls_last("spent"), F.asc("o_custkey")], 10),
    f"""select o_custkey, orders, cast(spent as double) as spent from {_TOTALS}
        order by c.spent desc nulls last, o_custkey limit 10""",
)
OPERATORS["sort_by_hidden"] = (
    lambda t: top_overall(_customer_totals(t), [F.desc("spent"), F.asc("o_custkey")], 25).select("o_custkey", "orders"),
    f"select o_custkey, orders from {_TOTALS} order by spent desc, o_custkey limit 25",
)
OPERATORS["win_global_topk"] = (
    lambda t: top_overall(_customer_totals(t), [F.desc("orders"), F.asc("o_custkey")], 20, "rank").select(
        "rank", "o_custkey", "orders"
    ),
    f"""select cast(row_number() over (order by orders desc, o_custkey) as int) as rank, o_custkey, orders
        from {_TOTALS} order by rank limit 20""",
)
OPERATORS["win_top1_per_group"] = (
    lambda t: top_per_group(_by_nation(t), ["c_nationkey"], [F.desc("spent"), F.asc("c_custkey")]),
    f"""select c_custkey, orders, cast(spent as double) as spent, c_nationkey from (
            select *, row_number() over (partition by c_nationkey order by spent desc, c_custkey) as rn from {_NATIONS}) r
        where rn = 1""",
)
OPERATORS["win_rank"] = (
    lambda t: top_per_group(_by_nation(t), ["c_nationkey"], [F.desc("orders")], n=3, how="rank", name="place").select(
        "c_nationkey", "c_custkey", "orders", "place"
    ),
    f"""select c_nationkey, c_custkey, orders, cast(place as int) as place from (
            select *, rank() over (partition by c_nationkey order by orders desc) as place from {_NATIONS}) r
        where place <= 3""",
)
OPERATORS["win_dense_rank"] = (
    lambda t: top_overall(_customer_totals(t), [], 4, "place", how="dense_rank", by="orders").select(
        "o_custkey", "orders", "place"
    ),
    f"""select o_custkey, orders, cast(place as int) as place from (
            select *, dense_rank() over (order by orders desc) as place from {_TOTALS}) r where place <= 4""",
)


def _two_ranks(t: Tables):
    best = top_by_any(_by_nation(t), ["c_nationkey"], {"most": ("orders", "desc"), "cheapest": ("spent", "asc")}, 2)
    return best.select("c_nationkey", "c_custkey", "most", "cheapest")


OPERATORS["win_two_ranks"] = (
    _two_ranks,
    f"""select c_nationkey, c_custkey, cast(most as int) as most, cast(cheapest as int) as cheapest from (
            select *, dense_rank() over (partition by c_nationkey order by orders desc) as most,
                   dense_rank() over (partition by c_nationkey order by spent) as cheapest from {_NATIONS}) r
        where most <= 2 or cheapest <= 2""",
)
OPERATORS["win_ntile"] = (
    lambda t: tiers(
        t["orders"].select("o_orderkey", "o_totalprice"),
        [F.desc_nulls_last("o_totalprice"), F.asc("o_orderkey")], 7,
    ).select("o_orderkey", "tier"),
    """select o_orderkey, cast(ntile(7) over (order by o_totalprice desc nulls last, o_orderkey) as int) as tier
       from orders""",
)


def _months(t: Tables, *conditions):
    """Orders per status and month, months numbered through the years."""
    day = F.col("o_orderdate")
    orders = t["orders"]
    for condition in conditions:
        orders = orders.filter(condition)
    return orders.groupBy(
        "o_orderstatus", (F.year(day) * 12 + F.month(day) - 1).alias("month_number")
    ).agg(F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("total"), F.count(F.lit(1)).alias("orders"))


_MONTHS = """(select o_orderstatus, year(o_orderdate) * 12 + month(o_orderdate) - 1 as month_number,
                     sum(cast(o_totalprice as decimal(15,2))) as total, count(*) as orders
              from orders group by 1, 2) m"""
_BY_STATUS = "(partition by o_orderstatus order by month_number)"


def _busy_months(t: Tables):
    """The months without February, so that there are gaps."""
    return _months(t, F.month("o_orderdate") != 2)


OPERATORS["win_lag_pct"] = (
    lambda t: period_change(
        _months(t), ["o_orderstatus"], "month_number", "orders", "before", "change_pct", digits=1
    ).filter(F.col("before").isNotNull()).select("o_orderstatus", "month_number", "orders", "before", "change_pct"),
    f"""select o_orderstatus, month_number, orders, before, {rounded('orders - before', 'before', 1, 100)} as change_pct
        from (select *, lag(orders) over {_BY_STATUS} as before from {_MONTHS}) l where before is not null""",
)
OPERATORS["win_lag_lead"] = (
    lambda t: period_change(
        _months(t), ["o_orderstatus"], "month_number", "orders", "before", following="after"
    ).select(
        "o_orderstatus", "month_number", "orders", "before", "after",
        F.when(F.col("after") > F.col("orders"), "up").when(F.col("after") < F.col("orders"), "down").otherwise("-").alias("next"),
    ),
    f"""select o_orderstatus, month_number, orders, before, after,
               case when after > orders then 'up' when after < orders then 'down' else '-' end as next
        from (select *, lag(orders) over {_BY_STATUS} as before, lead(orders) over {_BY_STATUS} as after from {_MONTHS}) l""",
)
OPERATORS["win_lag_strict"] = (
    lambda t: period_change(
        _busy_months(t), ["o_orderstatus"], "month_number", "orders", "before", strict=True
    ).select("o_orderstatus", "month_number", "orders", "before"),
    f"""with m as (select * from {_MONTHS.replace('from orders', 'from orders where month(o_orderdate) <> 2')})
        select a.o_orderstatus, a.month_number, a.orders, b.orders as before
        from m a left join m b on a.o_orderstatus = b.o_orderstatus and b.month_number = a.month_number - 1""",
)
OPERATORS["win_running_total"] = (
    lambda t: running_total(_months(t), ["o_orderstatus"], "month_number", "total", "running").select(
        "o_orderstatus", "month_number", "total", "running"
    ),
    f"""select o_orderstatus, month_number, cast(total as double) as total,
               cast(sum(total) over {_BY_STATUS} as double) as running from {_MONTHS}""",
)
OPERATORS["win_moving_avg"] = (
    lambda t: moving_avg(
        moving_avg(_months(t), ["o_orderstatus"], ["month_number"], "orders", 3, "average_3", 2),
        ["o_orderstatus"], ["month_number"], "orders", 6, "average_6", 2,
    ).select("o_orderstatus", "month_number", "average_3", "average_6"),
    f"""select o_orderstatus, month_number, {rounded('sum(orders) over w3', 'count(*) over w3', 2)} as average_3,
               {rounded('sum(orders) over w6', 'count(*) over w6', 2)} as average_6
        from {_MONTHS}
        window w3 as (partition by o_orderstatus order by month_number rows between 2 preceding and current row),
               w6 as (partition by o_orderstatus order by month_number rows between 5 preceding and current row)""",
)
OPERATORS["win_partition_stats"] = (
    lambda t: vs_group(_by_nation(t).select("c_nationkey", "c_custkey", "orders"), ["c_nationkey"], "orders", "nation", 4),
    f"""select c_nationkey, c_custkey, orders, {rounded('sum(orders) over g', 'count(*) over g', 4)} as nation_avg,
               max(orders) over g as nation_max, min(orders) over g as nation_min,
               cast(orders - cast({rounded('sum(orders) over g', 'count(*) over g', 4)} as decimal(18,4)) as double) as nation_deviation
        from {_NATIONS} window g as (partition by c_nationkey)""",
)
