"""Operators against brute force on small and skewed inputs, and the invariants of reports."""

import random
import re
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.functions import distinct_ids, highest, lowest, number, quotient, ratio, total
from starmart.operators import (
    add_unknown_member,
    aggregate,
    assert_no_nulls,
    balance,
    cube,
    dedupe,
    distinct_counts,
    drill_across,
    either_role,
    exact_median,
    filter_fk,
    grouping_sets,
    kpi_ranking,
    moving_avg,
    order,
    orphan_counts,
    period_change,
    prefix_sums,
    redirect_fk,
    reject_classes,
    reject_counts,
    roll_up,
    share_of_total,
    tally,
    tiers,
    top_by_any,
    top_overall,
    top_per_group,
    trend,
    file_order_key,
    with_file_order_key,
    with_surrogate_key,
)
from starmart.operators import loading
from starmart.sources import date_dimension
from checks.testmart import testmart as open_mart


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows of which a third share one key and one value."""
    rng = random.Random(7)
    rows = [(i, "hot", 5) if i % 3 == 0 else (i, f"k{rng.randrange(40)}", rng.randrange(1000)) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id int, key string, value int").repartition(6).cache()


def test_prefix_sums_and_positions(skewed):
    rows, df = skewed
    result = prefix_sums(df, [F.desc("value"), F.asc("id")], F.col("value").cast("long"), "running", "everything")
    wanted, running = {}, 0
    for identity, _, value in sorted(rows, key=lambda r: (-r[2], r[0])):
        running += value
        wanted[identity] = running
    assert {r.id: r.running for r in result.collect()} == wanted
    assert {r.everything for r in result.select("everything").distinct().collect()} == {running}


@pytest.mark.parametrize("n", [1, 4, 7, 3000, 5000])
def test_tiers_are_ntile(skewed, n):
    rows, df = skewed
    got = {r.id: r.tier for r in tiers(df, [F.desc("value"), F.asc("id")], n).collect()}
    ordered = sorted(rows, key=lambda r: (-r[2], r[0]))
    size, extra = divmod(len(ordered), n)
    wanted, tile, left = {}, 1, size + (1 if extra else 0)
    for identity, _, _ in ordered:
        if left == 0:
            tile += 1
            left = size + (1 if tile <= extra else 0)
        wanted[identity] = tile
        left -= 1
    assert got == wanted


def test_five_rows_in_four_tiles(spark):
    df = spark.createDataFrame([(i,) for i in range(5)], "id int")
    counts = tiers(df, [F.asc("id")], 4).groupBy("tier").count().orderBy("tier").collect()
    assert [r["count"] for r in counts] == [2, 1, 1, 1]


def test_exact_median_with_a_hot_group(spark, skewed):
    rows, df = skewed
    extra = spark.createDataFrame([(-1, None, 3), (-2, None, 4), (-3, "hot", None)], "id int, key string, value int")
    got = {r.key: r.median for r in exact_median(df.union(extra), ["key"], "value", "median").collect()}
    wanted = {k: statistics.median([r[2] for r in rows if r[1] == k]) for k in {r[1] for r in rows}}
    assert got == {**wanted, None: 3.5}
    assert exact_median(df, [], "value", "median").first().median == statistics.median([r[2] for r in rows])


def test_surrogate_keys_are_dense_and_repeatable(skewed):
    rows, df = skewed
    first = {r.id: r.number for r in with_surrogate_key(df, "number", [F.asc("id")]).collect()}
    second = {r.id: r.number for r in with_surrogate_key(df.repartition(3), "number", [F.asc("id")]).collect()}
    assert first == second == {identity: identity + 1 for identity, _, _ in rows}


def test_dedupe_keeps_the_first(skewed):
    rows, df = skewed
    wanted = {}
    for identity, key, _ in rows:
        wanted.setdefault(key, identity)
    assert {r.key: r.id for r in dedupe(df, ["key"], [F.asc("id")]).collect()} == wanted


def test_dense_rank_keeps_every_tie(skewed):
    rows, df = skewed
    top = top_overall(df, [], 3, "place", how="dense_rank", by="value").collect()
    highest = sorted({r[2] for r in rows}, reverse=True)[:3]
    assert sorted((r.id, r.place) for r in top) == sorted(
        (identity, highest.index(value) + 1) for identity, _, value in rows if value in highest
    )


def test_ties_by_row_number_and_rank(spark):
    df = spark.createDataFrame([("a", 3, 1), ("b", 3, 1), ("c", 2, 1)], "name string, goals int, league int")
    assert top_per_group(df, ["league"], [F.desc("goals"), F.asc("name")]).count() == 1
    assert top_per_group(df, ["league"], [F.desc("goals")], how="rank").count() == 2


def test_lag_bridges_a_gap_unless_strict(spark):
    df = spark.createDataFrame([(2015, 10), (2017, 20), (2018, 30)], "year int, value int")
    bridged = period_change(df, [], "year", "value", "before").orderBy("year").collect()
    strict = period_change(df, [], "year", "value", "before", strict=True).orderBy("year").collect()
    assert [r.before for r in bridged] == [None, 10, 20]
    assert [r.before for r in strict] == [None, None, 20]


def test_moving_average_starts_with_fewer_rows(spark):
    df = spark.createDataFrame([(1, 3), (2, 6), (3, 9), (4, 12)], "month int, value int")
    rows = moving_avg(df, [], ["month"], "value", 3, "mean", 2).orderBy("month").collect()
    assert [float(r["mean"]) for r in rows] == [3.0, 4.5, 6.0, 9.0]


def test_balance_does_not_match_null_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "league string, spend int")
    right = spark.createDataFrame([("a", 5), (None, 6), ("b", 7)], "league string, income int")
    rows = balance(left, right, "league", measures=["spend", "income"]).collect()
    assert sorted((r.league or "", r.spend, r.income) for r in rows) == [("", 0, 6), ("", 2, 0), ("a", 1, 5), ("b", 0, 7)]


def test_either_role_equals_the_disjunctive_join(spark):
    games = spark.createDataFrame([(1, 10, 20), (2, 20, 20), (3, 30, 10), (4, None, 10)], "game int, home int, away int")
    clubs = spark.createDataFrame([(10,), (20,)], "club int")
    literal = games.join(clubs, (F.col("home") == F.col("club")) | (F.col("away") == F.col("club")))
    rewritten = either_role(games, "home", "away", "club", ["game"]).join(clubs, "club")
    assert sorted((r.game, r.club) for r in rewritten.collect()) == sorted((r.game, r.club) for r in literal.collect())
    same = rewritten.filter("game = 2").first()
    assert same.is_first and same.is_second


def test_keys_are_filtered_and_redirected(spark):
    rows = spark.createDataFrame([(1, 10), (2, 99), (3, None), (4, -1)], "id int, club int")
    clubs = spark.createDataFrame([(10,), (-1,)], "club_id int")
    assert {r.id for r in filter_fk(rows, "club", clubs, "club_id").collect()} == {1, 4}
    assert {r.id: r.club for r in redirect_fk(rows, "club", clubs, "club_id").collect()} == {1: 10, 2: -1, 3: None, 4: -1}


def test_unknown_member_is_added_once(spark):
    clubs = spark.createDataFrame([(1, "x")], "club_id int, name string")
    row = {"club_id": -1, "name": "Desconocido"}
    twice = add_unknown_member(add_unknown_member(clubs, "club_id", row), "club_id", row)
    assert sorted((r.club_id, r.name) for r in twice.collect()) == [(-1, "Desconocido"), (1, "x")]


def test_calendar(spark):
    days = {str(r.full_date): r for r in date_dimension(spark).collect()}
    assert len(days) == 11323
    third = days["2021-01-03"]
    assert (third.week, third.day_of_week, third.is_weekend, third.day_name) == (53, 6, True, "Sunday")
    assert days["2023-06-30"].season_start_year == 2022 and days["2023-07-01"].season_start_year == 2023
    assert days["2024-02-29"].date_id == 20240229


def test_trend_needs_two_rows(spark):
    line = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, None)], "x double, y double")
    fitted = trend(line, "x", "y").first()
    assert (round(fitted.slope, 9), round(fitted.intercept, 9), fitted.n) == (2.0, 1.0, 2)
    assert trend(line.limit(1), "x", "y").first().slope is None


def test_assert_no_nulls(spark):
    with pytest.raises(ValueError, match=r"b \(1\)"):
        assert_no_nulls(spark.createDataFrame([(1, None), (2, 3)], "a int, b int"))
    assert_no_nulls(spark.createDataFrame([(1, 2)], "a int, b int"))


def test_totals_shares_and_rejects_add_up(spark, sf_dir):
    games = open_mart(spark, sf_dir)["fact_games"]
    goals = {"goals": F.sum("total_goals")}
    flat = games.agg(F.sum("total_goals")).first()[0]
    for result in (roll_up(games, ["competition_id", "season"], goals), cube(games, ["competition_id", "season"], goals)):
        total = result.filter("competition_id is null and season is null").first().goals
        detail = result.filter("competition_id is not null and season is not null").agg(F.sum("goals")).first()[0]
        assert total == detail == flat
    sets = grouping_sets(games, [["season"], []], goals).collect()
    assert sum(r.goals for r in sets if r.season is not None) == flat
    shares = share_of_total(games.groupBy("season").count(), "count", "share_pct")
    assert shares.agg(F.sum("share_pct")).first()[0] == pytest.approx(100)
    clubs = open_mart(spark, sf_dir)["dim_clubs"].filter("club_id < 10")
    loaded = filter_fk(games, "home_club_id", clubs, "club_id").count()
    rejected = reject_counts(games, {"home": ("home_club_id", clubs, "club_id")}).first().rejected
    assert loaded + rejected == games.count()
    classes = {r.reject_class: r.row_count for r in reject_classes(games, "home_club_id", "away_club_id", clubs, "club_id").collect()}
    assert classes["both_valid"] + classes["first_invalid"] + classes["second_invalid"] - classes["both_invalid"] == games.count()


def test_order_puts_nulls_and_ties_where_told(spark):
    df = spark.createDataFrame([(1, "b"), (None, "a"), (2, "a"), (1, "a"), (2, None)], "n int, t string")
    keys = [("n", "desc", "last"), ("t", "asc", "first")]
    assert [tuple(r) for r in order(df, keys).collect()] == [(2, None), (2, "a"), (1, "a"), (1, "b"), (None, "a")]
    keys = [("n", "asc", "first"), ("t", "desc", "last")]
    assert [tuple(r) for r in order(df, keys).collect()] == [(None, "a"), (1, "b"), (1, "a"), (2, "a"), (2, None)]


def test_top_k_is_numbered_in_its_order(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", None)], "k string, v int")
    rows = top_overall(df, [F.desc_nulls_last("v"), F.asc("k")], 3, "place").orderBy("place").collect()
    assert [(r.k, r.place) for r in rows] == [("b", 1), ("c", 2), ("a", 3)]


def test_dense_rank_follows_its_ordering_and_keeps_null(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", None)], "k string, v int")
    up = top_overall(df, [F.asc_nulls_first("v")], 2, "place", how="dense_rank", by="v").collect()
    assert sorted((r.k, r.place) for r in up) == [("a", 2), ("d", 1)]
    down = top_overall(df, [], 3, "place", how="dense_rank", by="v").collect()
    assert sorted((r.k, r.place) for r in down) == [("a", 2), ("b", 1), ("c", 1), ("d", 3)]


def test_drill_across_joins_null_keys_when_told(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, b int")
    joined = {r.k: r.b for r in drill_across([a, b], ["k"], null_safe=True).collect()}
    assert joined == {None: 10, "x": 20}


def test_unknown_member_stays_when_it_is_added_again(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    row = {"id": -1, "name": "none"}
    once = add_unknown_member(df, "id", row)
    assert sorted(tuple(r) for r in add_unknown_member(once, "id", row).collect()) == [(-1, "none"), (1, "a")]


def test_orphans_are_counted_by_value_whatever_the_types(spark):
    rows = [(1.0, Decimal("1.00"), "1", 1, None), (2.0, Decimal("2.50"), "x", 7, "b"), (9.0, Decimal("2.00"), " 2", None, "a")]
    fact = spark.createDataFrame(rows, "d double, n decimal(10,2), t string, i int, s string")
    ids = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    names = spark.createDataFrame([("a",), (None,)], "name string")
    found = orphan_counts({
        "double": (fact, "d", ids, "id"), "decimal": (fact, "n", ids, "id"), "text": (fact, "t", ids, "id"), "int": (fact, "i", ids, "id"),
        "name": (fact, "s", names, "name"), "no parent": (fact, "i", ids.limit(0), "id"), "same": (ids, "id", ids, "id"),
    })
    assert {r.check_name: r.orphans for r in found.collect()} == {
        "double": 1, "decimal": 1, "text": 1, "int": 2, "name": 2, "no parent": 3, "same": 1,
    }


def test_kpi_ranks_equal_a_window_per_kpi(spark):
    rows = [(i, (i * 7) % 5, None if i % 9 == 0 else (i % 4) / 2) for i in range(60)]
    frame = spark.createDataFrame(rows, "id int, a int, b double")
    ranked = kpi_ranking(frame, "id", {"a": False, "b": True})
    assert "Window" not in ranked._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    for kpi, sign in (("a", -1), ("b", 1)):
        values = {r[0]: r[1 if kpi == "a" else 2] for r in rows}
        signed = {k: float("inf") if v is None else sign * v for k, v in values.items()}
        expected = {k: 1 + sum(o < s for o in signed.values()) for k, s in signed.items()}
        assert {r.id: r.kpi_rank for r in ranked.filter(F.col("kpi") == kpi).collect()} == expected
    assert kpi_ranking(frame.limit(0), "id", {"a": False}).count() == 0


def test_tally_equals_a_loop(spark):
    made = random.Random(4)
    rows = [(made.choice([None, "x", "y"]), made.choice([None, 1, 2]), made.randint(1, 30), made.choice([None, 5, 6]), made.randint(0, 3)) for _ in range(400)]
    frame = spark.createDataFrame(rows, "k string, j int, game int, club int, goals int").repartition(5)
    found = tally(frame, ["k", "j"], ["goals"], {"games": "game", "clubs": "club"}, {"list": "club"}).collect()
    for r in found:
        own = [x for x in rows if (x[0], x[1]) == (r.k, r.j)]
        clubs = sorted({x[3] for x in own} - {None})
        assert (r.goals, r.games, r.clubs, r.list) == (sum(x[4] for x in own), len({x[2] for x in own}), len(clubs), clubs)
    assert len(found) == len({(x[0], x[1]) for x in rows})
    alone = {r.k: r.clubs for r in tally(frame, ["k"], [], {"clubs": "club"}).collect()}
    assert alone == {k: len({x[3] for x in rows if x[0] == k} - {None}) for k in {x[0] for x in rows}}
    with pytest.raises(ValueError):
        tally(frame, ["k"], ["goals"], {"keys": "k"})


def test_merged_subtotals_equal_those_over_rows(spark):
    made = random.Random(6)
    rows = [(made.choice("ab"), made.choice([1, 2, None]), made.choice([1, 32768, 32769, 65536, None]), made.choice([0, 3, None])) for _ in range(300)]
    frame = spark.createDataFrame(rows, "k string, j int, id int, v int").repartition(4)
    merged = {"n": number(), "some": number(F.col("v") == 3), "sum": total("v"), "low": lowest("v"), "high": highest("v"),
              "mean": quotient(total("v"), number(F.col("v").isNotNull()), 2), "ids": distinct_ids("id", 65536)}
    plain = {"n": F.count(F.lit(1)), "some": F.count_if(F.col("v") == 3), "sum": F.sum("v"), "low": F.min("v"), "high": F.max("v"),
             "mean": ratio(F.sum("v"), F.count("v"), 2), "ids": F.countDistinct("id")}
    columns = ["k", "j", "level", *plain]
    for subtotals in (lambda a: cube(frame, ["k", "j"], a), lambda a: roll_up(frame, ["k", "j"], a),
                      lambda a: grouping_sets(frame, [["k", "j"], ["j"], []], a)):
        a, b = (subtotals({"level": F.grouping_id(), **aggs}).select(columns) for aggs in (merged, plain))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert str(aggregate(frame, [], merged).first()) == str(aggregate(frame, [], plain).first())
    text = cube(frame, ["k", "j"], {"n": number(), "sum": total("v")})._jdf.queryExecution().executedPlan().toString()
    assert text.index("Expand") < text.rindex("HashAggregate(keys=[k")  # the groups of rows lie below
    with pytest.raises(Exception, match="out of its span"):
        aggregate(frame, [], {"ids": distinct_ids("id", 32768)}).collect()
    with pytest.raises(ValueError):
        distinct_ids("id", 1 << 30)


def test_distinct_counts_choose_bitmaps_for_small_ids(spark):
    frame = spark.createDataFrame([("a", 1, 5, "x"), ("a", 40000, 5, "x"), ("b", None, -2, None), ("a", 1, 7, "y")], "k string, id int, odd int, t string")
    small = distinct_counts(frame, ["k"], {"ids": "id"}, {"n": F.count(F.lit(1))})
    assert "Expand" not in small._jdf.queryExecution().executedPlan().toString()
    mixed = distinct_counts(frame, ["k"], {"ids": "id", "odds": "odd", "texts": "t"}, {"n": number()})
    assert sorted(map(tuple, mixed.select("k", "ids", "odds", "texts", "n").collect())) == [("a", 2, 2, 2, 3), ("b", 0, 1, 0, 1)]
    assert sorted(map(tuple, small.select("k", "ids", "n").collect())) == [("a", 2, 3), ("b", 0, 1)]
    assert distinct_counts(frame.limit(0), ["k"], {"ids": "id"}).count() == 0


def test_keys_in_file_order_are_dense_over_pieces(spark, monkeypatch):
    monkeypatch.setattr(loading, "PIECE_ROWS", 8)
    rows = [(f"f{i % 3}", (i % 2) * 100, i * 3) for i in range(200)]
    random.Random(2).shuffle(rows)
    frame = spark.createDataFrame(rows, "file string, block long, row long").repartition(6)
    placed = frame.select(F.struct("file", "block", "row").alias("place"))
    numbered = {tuple(r.place): r.id for r in with_file_order_key(placed, "id", "place").collect()}
    assert numbered == {row: i for i, row in enumerate(sorted(rows), 1)}
    plain = {r.row: r.id for r in with_file_order_key(frame, "id", "row").collect()}
    assert plain == {r: i for i, r in enumerate(sorted(r for *_, r in rows), 1)}
    assert with_file_order_key(frame.limit(0), "id", "row").count() == 0


def test_keys_in_file_order_are_the_same_in_parts(spark, monkeypatch):
    monkeypatch.setattr("starmart.operators.loading.PIECE_ROWS", 10)
    frame = spark.createDataFrame([(i * 3,) for i in range(100)], "row long")
    whole = sorted(map(tuple, file_order_key(frame, "id", "row").collect()))
    parts = [[tuple(r) for r in file_order_key(frame, "id", "row", p, 3).collect()] for p in range(3)]
    assert sorted(sum(parts, [])) == whole and [k for _, k in whole] == list(range(1, 101))
    assert all(len({r // 10 for r, _ in part}) < 30 for part in parts)


def test_rows_among_the_first_in_any_order(spark):
    made = random.Random(9)
    rows = [(i, made.choice([None, "a", "b"]), made.choice([None, 1, 2, 3, 4, 5]), made.randint(0, 8)) for i in range(150)]
    frame = spark.createDataFrame(rows, "id int, g string, x int, y int").repartition(5)
    found = {r.id: (r.most, r.least) for r in top_by_any(frame, ["g"], {"most": ("x", "desc"), "least": ("y", "asc")}, 2).collect()}
    expected = {}
    for i, g, x, y in rows:
        own = [r for r in rows if r[1] == g]
        most = 1 + len({r[2] for r in own if r[2] is not None and (x is None or r[2] > x)})
        least = 1 + len({r[3] for r in own if r[3] < y})
        if most <= 2 or least <= 2:
            expected[i] = (most, least)
    assert found == expected
    assert top_by_any(frame.limit(0), ["g"], {"most": ("x", "desc")}, 2).count() == 0


def test_distinct_ids_of_any_span_at_every_level(spark):
    made = random.Random(8)
    ids = [-1, 0, 63, 64, 70_000, 1 << 40, -(1 << 62), None]
    rows = [(made.choice(["a", "b", None]), made.choice([1, 2, None]), made.choice(ids)) for _ in range(200)] + [("none", 1, None)]
    frame = spark.createDataFrame(rows, "k string, j int, id long").repartition(4)
    merged, plain = {"n": number(), "ids": distinct_ids("id")}, {"n": F.count(F.lit(1)), "ids": F.countDistinct("id")}
    for subtotals in (lambda a: cube(frame, ["k", "j"], a), lambda a: roll_up(frame, ["k", "j"], a), lambda a: roll_up(frame, ["k"], a, ["j"]),
                      lambda a: grouping_sets(frame, [["k", "j"], ["j"], []], a), lambda a: aggregate(frame, ["j"], a)):
        a, b = (subtotals(aggs) for aggs in (merged, plain))
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_distinct_counts_keep_bitmaps_from_groups_of_single_values(spark):
    frame = spark.createDataFrame([(None, 1, 1 << 40, "x"), (None, 2, -5, "x"), ("b", None, None, None), ("b", 1, -5, "y")], "k string, id int, far long, t string")
    counted = distinct_counts(frame, ["k"], {"far": "far", "ids": "id", "texts": "t"}, {"n": F.count(F.lit(1))})
    assert counted.columns == ["k", "far", "ids", "texts", "n"]
    assert sorted(map(tuple, counted.collect()), key=str) == [("b", 1, 1, 1, 2), (None, 2, 2, 1, 2)]
    text = counted._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in text.split("\n") if "bitmap" in x and re.search(r"keys=\[k#\d+, ", x)]
    assert distinct_counts(frame, [], {"far": "far", "texts": "t"}).first() == (2, 2)
    assert distinct_counts(frame.limit(0), [], {"far": "far", "texts": "t"}).first() == (0, 0)
