"""Full load of small CSV files, with every rule a table has."""

import re
import shutil
import time
from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starmart.functions import to_number
from starmart.operators import accepted_and_counted, reject_missing, reject_orphans, reject_where
from starmart.plans import hierarchies, loads, slices
from starmart.plans.common import fact
from starmart.schemas import TABLES, unknown_member
from starmart.sources import Warehouse, count_bad_lines, current_root, read_csv, read_folders, write_folders, write_table
from checks.reports import REPORTS

FILES = {
    "competitions": """competition_id,competition_code,name,sub_type,type,country_id,country_name,domestic_league_code,confederation,url,is_major_national_league
ES1,laliga,LaLiga,first_tier,domestic_league,157,Spain,ES1,europa,u,true
GB1,premier,Premier League,N/A,domestic_league,None,England,GB1,europa,,1.0
ES1,copy,Copy,,,,,,,,false
""",
    "clubs": """club_id,club_code,name,domestic_competition_id,total_market_value,squad_size,average_age,foreigners_number,foreigners_percentage,national_team_players,stadium_name,stadium_seats,net_transfer_record,coach_name,last_season,url
10,a,"Club ""A"", FC",ES1,,25,24.7,7,28.0,3,Park,1000,+1m,None,2023,u
20,b,Club B,GB1,€1m,26.0,,8,many,,Ground,2000,-1m,C,2023,u
10,dup,Second A,ES1,1,1,1,1,1,1,x,1,x,x,1,x
,lost,Lost,ES1,1,1,1,1,1,1,x,1,x,x,1,x
""",
    "players": """player_id,name,position,date_of_birth,height_in_cm,contract_expiration_date,market_value_in_eur,current_club_id,extra
1,Ana One,Attack,1990-05-17,183.5,2026-06-30,1000000,10,ignored
2,N/A,,unknown,,,,,ignored
1,Second Ana,Midfield,,,,,,ignored
3,Cam Three,Defender,1999-12-31,x,,500,20,ignored
""",
    "games": """game_id,competition_id,season,round,date,home_club_id,away_club_id,home_club_name,away_club_name,attendance,home_club_formation,home_club_goals,away_club_goals,home_club_position
100,ES1,2023,1. Matchday,2023-08-11,10,20,A,B,5000,4-3-3 attacking with two wide forwards,2,1,9
101,ES1,2023,2. Matchday,2023-08-18,,20,,B,,4-4-2,,,9
102,ES1,2023,3. Matchday,2023-08-25,10,99,A,X,10,4-4-2,1,0,9
103,XX,2023,4. Matchday,2023-09-01,10,20,A,B,10,4-4-2,1,0,9
104,ES1,2023,5. Matchday,not a date,10,20,A,B,10,4-4-2,1,0,9
105,GB1,1999,6. Matchday,1999-12-31,20,10,B,A,10,4-4-2,1,1,9
""",
    "club_games": """game_id,hosting,own_position
100, Home,3
100,Away ,7
105,Home,
""",
    "appearances": """appearance_id,game_id,player_id,player_club_id,player_name,competition_id,minutes_played,goals,assists,yellow_cards,red_cards
100_1,100,1,10,Ana One,WRONG,90,2,,0,0
100_3,100,3,20,,WRONG,,,,,
100_9,100,9,10,Nobody,ES1,90,0,0,0,0
102_1,102,1,10,Ana One,ES1,90,1,0,0,0
101_1,101,1,99,Ana One,ES1,90,1,0,0,0
""",
    "game_lineups": """game_id,player_id,type,position,team_captain
100,1,starting_lineup,Centre-Forward,1.0
100,1,substitutes,Goalkeeper,0
""",
    "game_events": """game_event_id,game_id,club_id,player_id,type,description,player_in_id,player_assist_id,minute
e1,100,10,1,Goals,", Header ",3,3,12
e2,100,20,3,Cards,", ",,1,
e3,100,10,1,Substitutions,,99,1,60
e4,100,10,,Goals,Own goal,,77,70
e5,102,10,1,Goals,x,,,5
e6,100,10,88,Goals,x,,,5
""",
    "transfers": """player_id,transfer_date,transfer_season,from_club_id,to_club_id,from_club_name,to_club_name,transfer_fee,market_value_in_eur,player_name
1,2023-07-01,23/24,10,99,A,X,€50.00m,40000000,Ana One
3,2023-07-02,99/00,,20,,B,free transfer,,Cam Three
9,2023-07-03,23/24,10,20,A,B,€1k,1,Nobody
1,soon,23/24,10,20,A,B,€1k,1,Ana One
1,1999-01-01,98/99,10,20,A,B,€1k,1,Ana One
2,2023-07-04,bad,20,10,B,A,?,5,
""",
    "player_valuations": """player_id,date,market_value_in_eur,current_club_id,player_club_domestic_competition_id
1,2023-01-01,100,10,ES1
1,2024-01-01,,,
7,2024-01-01,5,10,ES1
3,bad,5,10,ES1
""",
}


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("source")
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    root = str(tmp_path_factory.mktemp("warehouse"))
    status = loads.load_all(spark, str(folder), root).collect()
    return Warehouse.at(spark, root), status, str(folder), root


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_all_tables_are_loaded_without_nulls(warehouse):
    tables, status, _, _ = warehouse
    found = {(r.check_type, r.check_name): r.found for r in status}
    assert {name: found["rows_loaded", name] for name in TABLES} == {
        "dim_date": 11323, "dim_competitions": 2, "dim_clubs": 3, "dim_players": 4, "dim_games": 3, "fact_games": 2,
        "fact_appearances": 2, "fact_game_events": 4, "fact_transfers": 3, "fact_player_valuations": 2,
    }
    assert all(found["nulls", name] == 0 for name in TABLES)
    orphaned = {name for (kind, name), n in found.items() if kind == "orphans" and n}
    assert orphaned == {"fact_player_valuations.competition_id"}


def test_dimensions_keep_the_first_row_and_fill_markers(warehouse):
    tables = warehouse[0]
    competitions = by(tables["dim_competitions"], "competition_id")
    assert competitions["ES1"].name == "LaLiga" and competitions["ES1"].is_major_national_league
    assert (competitions["GB1"].sub_type, competitions["GB1"].country_id, competitions["GB1"].url) == ("N/A", -1, "N/A")
    assert competitions["GB1"].is_major_national_league
    clubs = by(tables["dim_clubs"], "club_id")
    assert clubs[10].name == 'Club "A", FC' and clubs[10].coach_name == "N/A"
    assert (clubs[20].total_market_value, clubs[20].squad_size, clubs[20].average_age) == (Decimal("-1.00"), 26, Decimal("0.00"))
    assert clubs[-1].asDict() == {
        k: Decimal("-1.00") if isinstance(clubs[-1][k], Decimal) else v
        for k, v in unknown_member("dim_clubs", "club_id").items()
    }
    players = by(tables["dim_players"], "player_id")
    assert (players[1].name, players[1].height_in_cm) == ("Ana One", Decimal("183.50"))
    assert (players[2].name, players[2].position) == ("N/A", "N/A")
    assert (players[2].date_of_birth, players[2].contract_expiration_date) == (date(1900, 1, 1), date(9999, 12, 31))
    assert players[-1].name == "Desconocido"


def test_games_with_an_unknown_club_stay_and_with_an_unlisted_one_go(warehouse):
    tables = warehouse[0]
    games = by(tables["dim_games"], "game_id")
    assert set(games) == {100, 101, 105}
    assert games[101].home_club_id == -1 and games[101].home_club_name == "N/A"
    assert games[100].home_club_formation == "4-3-3 attacking with"
    facts = by(tables["fact_games"], "game_id")
    assert set(facts) == {100, 101}  # 105 lies before the calendar
    assert (facts[100].home_club_position, facts[100].away_club_position) == (3, 7)
    assert (facts[100].goal_difference, facts[100].total_goals, facts[100].is_home_win) == (1, 3, True)
    # An unknown result is stored as a goalless draw.
    assert (facts[101].home_club_goals, facts[101].is_draw, facts[101].is_home_win, facts[101].attendance) == (0, True, False, -1)


def test_appearances_take_their_role_from_the_first_lineup(warehouse):
    rows = by(warehouse[0]["fact_appearances"], "appearance_id")
    assert set(rows) == {"100_1", "100_3"}
    first, second = rows["100_1"], rows["100_3"]
    assert (first.type, first.position, first.team_captain, first.competition_id, first.date_id) == (
        "starting_lineup", "Centre-Forward", True, "ES1", 20230811
    )
    assert (second.type, second.team_captain, second.player_name, second.goals) == ("Unknown", False, "Unknown", 0)


def test_events_clear_and_redirect_their_players(warehouse):
    rows = by(warehouse[0]["fact_game_events"], "event_id")
    assert set(rows) == {"e1", "e2", "e3", "e4"}
    assert (rows["e1"].description, rows["e1"].player_in_id, rows["e1"].player_assist_id) == ("Header", -1, 3)
    assert (rows["e2"].description, rows["e2"].player_assist_id, rows["e2"].minute) == ("Unknown", -1, -1)
    assert (rows["e3"].player_in_id, rows["e3"].player_assist_id) == (-1, -1)
    assert (rows["e4"].player_id, rows["e4"].player_assist_id) == (-1, -1)


def test_event_ids_are_numbered_when_the_source_has_none(spark, warehouse):
    tables, _, folder, _ = warehouse
    source = read_csv(spark, f"{folder}/game_events.csv", with_order=True).drop("game_event_id")
    rows = loads.build_fact_game_events(source, tables["dim_games"], tables["dim_players"], tables["dim_clubs"]).collect()
    assert sorted(r.event_id for r in rows) == ["1", "2", "3", "4"]


def test_transfers_are_checked_before_they_are_filled(warehouse):
    rows = by(warehouse[0]["fact_transfers"], "player_name")
    ana, cam, unnamed = rows["Ana One"], rows["Cam Three"], rows["Unknown"]
    assert (ana.from_club_id, ana.to_club_id, ana.transfer_fee, ana.transfer_season) == (10, -1, Decimal("50000000.00"), 2023)
    assert (cam.from_club_id, cam.transfer_fee, cam.market_value_in_eur, cam.transfer_season) == (
        -1, Decimal("0.00"), Decimal("-1.00"), 1999
    )
    assert (unnamed.player_id, unnamed.transfer_season) == (2, -1)
    assert [ana.transfer_id, cam.transfer_id, unnamed.transfer_id] == [1, 2, 3]  # in file order


def test_valuations_without_a_club_belong_to_the_unknown_club(warehouse):
    rows = by(warehouse[0]["fact_player_valuations"], "date_id")
    assert set(rows) == {20230101, 20240101}
    assert (rows[20240101].club_id, rows[20240101].competition_id, rows[20240101].market_value_in_eur) == (
        -1, "Unknown", Decimal("-1.00")
    )


def test_loading_again_gives_the_same_tables(spark, warehouse):
    tables, _, folder, root = warehouse
    before = {n: sorted(map(str, tables[n].collect())) for n in ("dim_clubs", "fact_transfers")}
    loads.load_all(spark, folder, root)
    again = Warehouse.at(spark, root)
    assert {n: sorted(map(str, again[n].collect())) for n in before} == before


def test_strict_load_raises_on_a_broken_reference(spark, warehouse):
    _, _, folder, root = warehouse
    with pytest.raises(ValueError, match="orphans in fact_player_valuations.competition_id"):
        loads.load_all(spark, folder, root, strict=True)


def test_a_load_checks_its_tables_in_queries_of_few_scans(warehouse):
    checks = list(loads.status_checks(warehouse[0]))
    scans = [check._jdf.queryExecution().optimizedPlan().collectLeaves().size() for check in checks]
    assert len(checks) > 20 and max(scans) <= 10


def test_load_rate_counts_sources_and_tables(spark, warehouse):
    _, _, folder, root = warehouse
    rate = by(loads.source_load_rate(spark, folder, root), "table_name")
    assert (rate["fact_games"].source_rows, rate["fact_games"].loaded_rows) == (6, 2)
    assert float(rate["fact_games"].loaded_pct) == 33.3
    assert rate["TOTAL"].source_rows == sum(r.source_rows for n, r in rate.items() if n != "TOTAL")


def test_rejected_rows_are_counted_by_the_first_rule_they_fail(warehouse):
    found = {r.check_name: r.found for r in warehouse[1] if r.check_type == "rows_rejected" and r.found}
    assert found == {
        "dim_competitions.duplicate": 1, "dim_clubs.duplicate": 1, "dim_clubs.missing": 1, "dim_players.duplicate": 1,
        "dim_games.missing": 1, "dim_games.away_club_id": 1, "dim_games.competition_id": 1,
        "fact_games.game_id": 3, "fact_games.date_id": 1,
        "fact_appearances.game_id": 1, "fact_appearances.player_id": 1, "fact_appearances.club_id": 1,
        "fact_game_events.game_id": 1, "fact_game_events.player_id": 1,
        "fact_transfers.missing": 1, "fact_transfers.player_id": 1, "fact_transfers.transfer_date_id": 1,
        "fact_player_valuations.player_id": 1, "fact_player_valuations.date_id": 1,
    }
    assert all(r.ok for r in warehouse[1] if r.check_type in ("rows_unaccounted", "repeated_keys", "wrong_measures"))


def test_marked_rows_keep_their_first_rule_and_added_rows_stay(spark):
    rows = spark.createDataFrame([(1, 10), (2, None), (3, 77), (None, 10), (5, 10)], "id int, club int")
    clubs = spark.createDataFrame([(10, "A"), (10, "A")], "club_id int, name string")
    marked = reject_orphans(reject_missing(rows, "no id", ["id", "absent"]), "no club", "club", clubs, "club_id", ["name"])
    marked = reject_where(marked, "late", F.col("id") == 5).unionByName(spark.createDataFrame([(-1, -1, "", "?")], "id int, club int, _reject string, name string"))
    kept, counts = accepted_and_counted(marked, ["no id", "no club", "late"])
    assert sorted((r.id, r.name) for r in kept.collect()) == [(-1, "?"), (1, "A")]
    assert counts.get == {"rows": 6, "added": 1, "rule no id": 1, "rule no club": 2, "rule late": 1}


def test_tables_built_in_rounds_are_the_same_and_leave_no_shuffle_files(spark, warehouse, tmp_path, monkeypatch):
    tables, _, _, root = warehouse
    folder = f"{tmp_path}/version"
    shutil.copytree(current_root(spark, root).removeprefix("file:"), folder)
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        found = disk.getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}

    whole = {name: loads._write_rows(spark, folder, name, None) for name in ("dim_games", "fact_transfers")}
    monkeypatch.setattr(loads, "ROUND_ROWS", 3)
    before = shuffled()
    for name in loads.JOBS:
        if name not in loads.ONE_ROUND:
            counts = loads._write_rows(spark, folder, name)
            assert counts == whole.get(name, counts), name
            again = Warehouse.in_folder(spark, folder)[name]
            assert sorted(map(str, again.collect())) == sorted(map(str, tables[name].collect())), name
    for _ in range(40):  # files are removed in the background
        if not shuffled() - before:
            break
        time.sleep(0.25)
    assert not shuffled() - before
    assert not list(tmp_path.glob("version/_accepted"))
    assert {p.suffixes[-2] for p in tmp_path.glob("version/fact_*/**/*.parquet")} == {".zstd"}


def test_a_load_tells_which_sources_it_has_read(spark, warehouse, tmp_path):
    shutil.copytree(warehouse[2], tmp_path / "csv")
    with open(tmp_path / "csv" / "clubs.csv", "a", encoding="utf-8") as f:
        f.write("30,short\n")
    told = []
    with pytest.raises(ValueError, match="bad_lines in clubs: 1"):
        loads.load_all(spark, str(tmp_path / "csv"), str(tmp_path / "tables"), strict=True, on_staged=told.append)
    assert sorted(told) == sorted(FILES)


def test_rounds_have_every_row_once_and_equal_keys_together(spark):
    keys = [None if i % 4 == 0 else f"{i % 7}.0" if i % 3 else f"{i % 7}" for i in range(400)]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "game_id string, _row_order long")

    def rounds(name: str) -> list[list]:
        return [loads._of_round(rows, name, n, 4).withColumn("key", to_number("game_id", "int")).collect() for n in range(4)]

    for name in ("dim_games", "fact_appearances", "fact_transfers"):
        dealt = rounds(name)
        assert sorted(r._row_order for part in dealt for r in part) == list(range(400)), name
        lost = sum(any(r.key is None for r in part) for part in dealt)
        assert lost == (1 if name == "dim_games" else 4), name
        if name != "fact_transfers":
            assert all(sum(any(r.key == k for r in part) for part in dealt) == 1 for k in range(7)), name


def test_sources_are_staged_and_the_jobs_timed(spark, warehouse):
    _, _, folder, root = warehouse
    current = current_root(spark, root)
    for name in FILES:
        lines = read_csv(spark, f"{folder}/{name}.csv", multi_line=True)
        assert sorted(map(str, loads.staged(spark, current, name).select(lines.columns).collect())) == sorted(map(str, lines.collect())), name
    jobs = {r.table_name: r.seconds for r in loads.job_log(spark, root).collect()}
    assert set(jobs) == {"dim_date", *loads.JOBS, *[f"sources/{s}" for s in FILES]} and all(s > 0 for s in jobs.values())


def test_lines_with_open_quotes_make_the_source_be_read_by_whole_files(spark, tmp_path):
    text = 'club_id,name,code\n1,"a ""b"", c",x\n\n2,N/A\n3,"open\nend",y\n4,z,"last\n5,q,r"\n6,d,e,f\n'
    (tmp_path / "clubs.csv").write_text(text, encoding="utf-8")
    counts = loads.stage_source(spark, str(tmp_path), str(tmp_path / "whole"), "clubs")
    rows = {r.club_id: (r.name, r.code) for r in loads.staged(spark, str(tmp_path / "whole"), "clubs").collect()}
    assert rows == {"1": ('a "b", c', "x"), "2": (None, None), "3": ("open\nend", "y"), "4": ("z", "last\n5,q,r"), "6": ("d", "e")}
    assert (counts["rows"], counts["bad_lines"]) == (5, 2)
    split = loads.stage_source(spark, str(tmp_path), str(tmp_path / "split"), "clubs", multi_line=False)
    assert split["open_quotes"] == 4 and split["rows"] == 7


def test_dates_in_another_format_give_the_same_tables(spark, warehouse, tmp_path):
    tables, _, folder, _ = warehouse
    shutil.copytree(folder, tmp_path / "csv")
    for name in ("players", "games", "transfers", "player_valuations"):
        path = tmp_path / "csv" / f"{name}.csv"
        path.write_text(re.sub(r"\b(\d{4})-(\d\d)-(\d\d)\b", r"\3/\2/\1", path.read_text(encoding="utf-8")), encoding="utf-8")
    loads.load_all(spark, str(tmp_path / "csv"), str(tmp_path / "tables"))
    other = Warehouse.at(spark, str(tmp_path / "tables"))
    for name in ("dim_players", "dim_games", "fact_games", "fact_transfers", "fact_player_valuations"):
        assert sorted(map(str, other[name].collect())) == sorted(map(str, tables[name].collect())), name


def files_read(df) -> set:
    return {r.f.split("/")[-2] for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


def test_reports_read_the_folders_of_their_years(spark, warehouse):
    tables = Warehouse.at(spark, warehouse[3])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    text = plan(slices.q01_1(tables, season=2023))
    assert re.search(r"PartitionFilters: \[isnotnull\(transfer_season#\d+\), \(transfer_season#\d+ = 2023\)\]", text)
    text = plan(hierarchies.q04_1a(tables, years=(2023, 2023)))
    assert re.search(r"PartitionFilters: \[isnotnull\(folder_year#\d+\), \(folder_year#\d+ >= 2023\), \(folder_year#\d+ <= 2023\)\]", text)
    assert files_read(tables["fact_transfers"].filter("transfer_season = 2023")) == {"transfer_season=2023"}
    assert files_read(fact(tables, "fact_player_valuations", (2024, 2024))) == {"folder_year=2024"}
    assert files_read(fact(tables, "fact_player_valuations", seasons=(2023, 2023))) == {"folder_year=2023", "folder_year=2024"}


def test_refreshing_years_leaves_the_other_folders(spark, warehouse, tmp_path):
    _, _, folder, _ = warehouse
    shutil.copytree(folder, tmp_path / "csv")
    root = str(tmp_path / "tables")
    loads.load_all(spark, str(tmp_path / "csv"), root)
    path = tmp_path / "csv" / "player_valuations.csv"
    path.write_text(path.read_text(encoding="utf-8").replace("1,2023-01-01,100", "1,2023-01-01,111").replace("1,2024-01-01,,", "1,2024-01-01,7,"), encoding="utf-8")
    loads.refresh_years(spark, str(tmp_path / "csv"), root, "fact_player_valuations", 2024, 2024)
    rows = by(Warehouse.at(spark, root)["fact_player_valuations"], "date_id")
    assert (rows[20230101].market_value_in_eur, rows[20240101].market_value_in_eur) == (Decimal("100.00"), Decimal("7.00"))
    assert (rows[20230101].valuation_id, rows[20240101].valuation_id) == (1, 2)
    with pytest.raises(ValueError, match="no year folders"):
        loads.refresh_years(spark, str(tmp_path / "csv"), root, "dim_clubs", 2024, 2024)


def test_a_fact_without_rows_can_be_read(spark, tmp_path):
    none = spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in TABLES["fact_games"].items()))
    write_folders(none, str(tmp_path), "fact_games")
    read = Warehouse(lambda name: read_folders(spark, str(tmp_path), name))
    assert read["fact_games"].columns == list(TABLES["fact_games"]) and read.in_years("fact_games", 2000, 2001).count() == 0


def test_only_a_missing_folder_means_that_nothing_is_published(spark, tmp_path):
    assert current_root(spark, str(tmp_path)) == str(tmp_path)
    (tmp_path / "current").mkdir()
    with pytest.raises(AnalysisException):
        current_root(spark, str(tmp_path))


def test_appending_adds_rows(spark, tmp_path):
    rows = spark.range(3)
    write_table(rows, str(tmp_path), "t")
    write_table(rows, str(tmp_path), "t")
    assert spark.read.parquet(f"{tmp_path}/t").agg(F.count(F.lit(1))).first()[0] == 6


def test_tables_have_all_their_columns(spark, warehouse):
    tables = Warehouse.at(spark, warehouse[3])  # opened anew, as a later load has replaced the files
    for name, kinds in TABLES.items():
        assert list(tables[name].columns) == list(kinds), name
    player = by(tables["dim_players"], "player_id")[1]
    assert (player.foot, player.country_of_citizenship) == ("N/A", "N/A")


def test_every_report_runs_on_a_loaded_warehouse(spark, warehouse):
    tables = Warehouse.at(spark, warehouse[3])
    for key, (report, parameters, _) in REPORTS.items():
        try:
            report(tables, **parameters).collect()
        except Exception as error:
            raise AssertionError(key) from error


def test_line_breaks_in_quotes_are_kept(spark, warehouse, tmp_path):
    (tmp_path / "clubs.csv").write_text('club_id,club_code,name,stadium_name\n10,a,"Club\nA",Park\n', encoding="utf-8")
    assert loads.load_table(spark, str(tmp_path), str(tmp_path), "dim_clubs") == 2
    club = by(spark.read.parquet(f"{tmp_path}/dim_clubs"), "club_id")[10]
    assert (club.name, club.stadium_name) == ("Club\nA", "Park")


def test_malformed_lines_are_counted_and_end_a_strict_load(spark, warehouse, tmp_path):
    _, _, folder, _ = warehouse
    shutil.copytree(folder, tmp_path / "csv")
    with open(tmp_path / "csv" / "club_games.csv", "a", encoding="utf-8") as file:
        file.write("105,Home,1,2\n105\n")
    assert count_bad_lines(spark, str(tmp_path / "csv" / "club_games.csv"), multi_line=True) == 2
    with pytest.raises(ValueError, match="bad_lines in club_games: 2"):
        loads.load_all(spark, str(tmp_path / "csv"), str(tmp_path / "tables"), strict=True)


def test_a_source_without_its_key_column_raises(spark, tmp_path):
    (tmp_path / "clubs.csv").write_text("club_code,name\na,A\n", encoding="utf-8")
    with pytest.raises(ValueError, match="clubs.csv has no column club_id"):
        loads.load_table(spark, str(tmp_path), str(tmp_path), "dim_clubs")


def test_a_failing_load_leaves_the_tables_before_it(spark, warehouse, tmp_path):
    _, _, folder, root = warehouse
    before = sorted(map(str, Warehouse.at(spark, root)["dim_clubs"].collect()))
    shutil.copytree(folder, tmp_path / "csv")
    (tmp_path / "csv" / "transfers.csv").write_text("player_id\n1\n", encoding="utf-8")
    with pytest.raises(ValueError, match="transfers.csv has no column"):
        loads.load_all(spark, str(tmp_path / "csv"), root)
    assert sorted(map(str, Warehouse.at(spark, root)["dim_clubs"].collect())) == before
