"""The plans the operators are meant to have."""

import re

import pytest
from pyspark.sql import functions as F

from starmart.operators import joins
from starmart.operators import (
    aggregate,
    dice,
    distinct_counts,
    either_role,
    enrich,
    filter_fk,
    null_audit,
    orphan_counts,
    redirect_fk,
    reject_orphans,
    share_of_total,
    star_join,
    top_overall,
    top_per_group,
    with_ties,
)
from starmart.plans import highlights, players, slices, teams, trends
from starmart.session import shared_folder
from checks.testmart import Tables
from checks.testmart import testmart as open_mart


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return Tables(spark, sf_dir)


@pytest.fixture
def no_broadcast(spark):
    """Every table counts as larger than the broadcast limit."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(dice(tables["orders"], {"o_orderstatus": "F", "o_orderkey": lambda c: c > 10}).select("o_orderkey"))
    assert "EqualTo(o_orderstatus,F)" in text and "GreaterThan(o_orderkey,10)" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>", text)


def test_either_role_is_an_equality_join(tables):
    sides = either_role(tables.mart["fact_games"], "home_club_id", "away_club_id", "club_id", ["total_goals"])
    text = plan(star_join(sides, [("club_id", tables.mart["dim_clubs"], "club_id", {"name": "club"})]))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_key_filter_is_a_semi_join(tables):
    assert "LeftSemi" in plan(filter_fk(tables["customer"], "c_nationkey", tables["nation"], "n_nationkey"))


def test_numbered_top_k_takes_the_rows_before_the_window(tables):
    totals = aggregate(tables["orders"], ["o_custkey"], {"n": F.count(F.lit(1))})
    text = plan(top_overall(totals, [F.desc("n"), F.asc("o_custkey")], 5, "rank"))
    assert text.index("Window") < text.index("TakeOrderedAndProject")


def test_top_per_group_is_cut_before_the_shuffle(tables):
    text = plan(top_per_group(tables["orders"], ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")]))
    assert text.count("WindowGroupLimit") == 2


def test_null_audit_scans_each_table_once(tables):
    assert plan(null_audit({"orders": tables["orders"], "part": tables["part"]})).count("FileScan") == 2


def test_orphans_of_a_large_parent_are_counted_per_value_before_the_join(tables, no_broadcast):
    text = plan(orphan_counts({"c": (tables["lineitem"], "l_orderkey", tables["orders"], "o_orderkey")}))
    assert "partial_count" in text[text.index("LeftAnti"):]


def test_share_of_total_is_no_join(tables):
    totals = aggregate(tables["orders"], ["o_orderpriority"], {"n": F.count(F.lit(1))})
    text = plan(share_of_total(totals, "n", "share"))
    assert "Join" not in text and "Subquery" in text


@pytest.mark.parametrize(
    "report",
    [slices.q01_1, slices.q02_1, trends.q06_1, trends.q06_5, trends.q08_4b, highlights.q09_1, highlights.q09_7,
     teams.q12_1, teams.q12_4],
)
def test_reports_have_no_cross_join(spark, sf_dir, report):
    text = plan(report(open_mart(spark, sf_dir)))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_year_filter_is_put_on_the_date_key(spark, tmp_path, sf_dir):
    mart = open_mart(spark, sf_dir)
    mart["fact_games"].write.parquet(f"{tmp_path}/fact_games")
    games = spark.read.parquet(f"{tmp_path}/fact_games")
    text = plan(trends.q06_2({"fact_games": games, "dim_date": mart["dim_date"]}))
    assert "GreaterThanOrEqual(date_id,20200101)" in text and "LessThanOrEqual(date_id,20241231)" in text


def test_large_dimensions_are_shuffled_not_broadcast(tables, no_broadcast):
    """Past the size limit the same join shuffles both sides."""
    text = plan(star_join(tables["orders"], [("o_custkey", tables["customer"], "c_custkey", {"c_name": "name"})]))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_folder(spark) == configured


@pytest.mark.parametrize("report", [highlights.q09_1, highlights.q09_2, highlights.q09_5, players.q11_3])
def test_player_reports_read_the_appearances_once(spark, tmp_path_factory, sf_dir, report):
    mart, folder = open_mart(spark, sf_dir), tmp_path_factory.mktemp("mart")
    for name in ("fact_appearances", "dim_players", "dim_clubs", "dim_competitions"):
        mart[name].write.parquet(f"{folder}/{name}")
    stored = {name: spark.read.parquet(f"{folder}/{name}") for name in ("fact_appearances", "dim_players", "dim_clubs", "dim_competitions")}
    text = plan(report({**stored, "dim_date": mart["dim_date"]}))
    assert len(re.findall(r"FileScan parquet .*fact_appearances", text)) == 1


def test_ties_at_a_cut_are_limited_in_every_task(tables):
    totals = aggregate(tables["orders"], ["o_custkey"], {"n": F.count(F.lit(1))})
    assert plan(with_ties(totals, [F.desc("n")], 5)).count("WindowGroupLimit") == 2


def test_distinct_counts_of_keys_repeat_no_row(tables):
    counted = distinct_counts(tables["lineitem"], ["l_returnflag"], {"parts": "l_partkey", "suppliers": "l_suppkey", "orders": "l_orderkey"})
    assert "Expand" not in plan(counted)


def test_load_joins_send_no_large_side_through_the_driver(spark, monkeypatch):
    monkeypatch.setattr(joins, "MOST_SENT", 40)
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("t"))
    many, few = spark.range(50).select(F.col("id").alias("key")), spark.range(30).select(F.col("id").alias("key"))
    for dim, strategy, found in ((many, "SortMergeJoin", 50), (few, "BroadcastHashJoin", 30)):
        marked, redirected = reject_orphans(rows, "k", "k", dim, "key"), redirect_fk(rows, "k", dim, "key")
        added = enrich(rows, dim.withColumnsRenamed({"key": "k"}).withColumn("v", F.lit(1)), ["k"], ["v"], [F.asc("v")])
        for df in (marked, redirected, added, filter_fk(rows, "k", dim, "key"), orphan_counts({"c": (rows, "k", dim, "key")})):
            assert strategy in plan(df) and ("Broadcast" in plan(df)) == (dim is few)
        assert [marked.filter("_reject is null").count(), redirected.filter("k >= 0").count(), added.filter("v = 1").count()] == [found] * 3
        assert orphan_counts({"c": (rows, "k", dim, "key")}).first().orphans == 100 - found
