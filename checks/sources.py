"""Source rows as text, with the faults a load must deal with, as views over the test tables.

Each view stands for one CSV file after reading: all columns text, NULL for missing values and
``_row_order`` for the position in the file. Some parents are left out of their dimension on purpose, so
that their children have no parent. Both engines read the same view text.
"""

from pyspark.sql import SparkSession

from starmart.sources import Warehouse
from checks.testmart import DATE_SQL, DAY_SHIFT, league_code, sql_view

_DAY = f"(cast(o_orderdate as date) + {DAY_SHIFT})"

RAW = {
    "raw_competitions": f"""
        select {league_code('r_regionkey')} as competition_id,
               case when r_regionkey = 1 then null else lower(r_name) end as competition_code, lower(r_name) as name,
               cast(null as string) as sub_type, 'league' as type,
               case when r_regionkey = 0 then 'none' else cast(r_regionkey as string) || '.0' end as country_id,
               r_name as country_name, cast(null as string) as domestic_league_code, 'europa' as confederation,
               'u' as url, case r_regionkey % 3 when 0 then 'true' when 1 then '0.0' else null end as is_major_national_league,
               cast(r_regionkey as bigint) as _row_order
        from region
        union all
        select {league_code('r_regionkey')}, 'copy', 'copy', null, null, null, null, null, null, null, null,
               cast(r_regionkey + 100 as bigint) from region""",
    "raw_clubs": f"""
        select cast(n_nationkey as string) as club_id, lower(n_name) as club_code, n_name as name,
               {league_code('n_regionkey')} as domestic_competition_id,
               case n_nationkey % 3 when 0 then null when 1 then '12.5' else '€1m' end as total_market_value,
               '25.0' as squad_size, case when n_nationkey < 5 then null else '24.7' end as average_age,
               '7' as foreigners_number, 'many' as foreigners_percentage, cast(null as string) as national_team_players,
               'Park' as stadium_name, cast(n_nationkey * 1000 as string) as stadium_seats, '+1m' as net_transfer_record,
               cast(null as string) as coach_name, '2023' as last_season, 'u' as url,
               cast(n_nationkey as bigint) as _row_order
        from nation where n_regionkey < 4
        union all
        select cast(n_nationkey as string), 'copy', 'copy', null, null, null, null, null, null, null, null, null, null,
               null, null, null, cast(n_nationkey + 100 as bigint) from nation where n_regionkey = 1
        union all
        select null, 'lost', 'lost', null, null, null, null, null, null, null, null, null, null, null, null, null,
               cast(r_regionkey + 1000 as bigint) from region""",
    "raw_players": """
        select cast(p_partkey as string) as player_id, p_name as name, '2023.0' as last_season,
               case when p_size > 45 then null else cast(p_size as string) end as current_club_id,
               p_brand as country_of_citizenship,
               case p_size % 3 when 0 then '1990-05-17' when 1 then 'unknown' else null end as date_of_birth,
               case when p_type = 'SMALL' then null else p_type end as position,
               cast(100 + p_size as string) || '.5' as height_in_cm,
               case when p_size > 25 then '2026-06-30' else null end as contract_expiration_date,
               cast(p_retailprice as string) as market_value_in_eur,
               cast(null as string) as highest_market_value_in_eur, p_partkey as _row_order
        from part where p_size <> 13
        union all
        select cast(p_partkey as string), 'copy', null, null, null, null, null, null, null, null, null,
               p_partkey + 1000000000 from part where p_size = 7""",
    "raw_games": f"""
        select cast(o_orderkey as string) as game_id,
               case when o_orderpriority = '1-URGENT' and o_orderstatus = 'F' then 'XX1' else {league_code('n_regionkey')} end as competition_id,
               cast(year({_DAY}) as string) as season, 'Round of the very last sixteen clubs that are left in the competition' as round,
               case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then 'n.d.' else cast({_DAY} as string) end as date,
               case when c_mktsegment = 'MACHINERY' and o_orderstatus = 'O' then null else cast(c_nationkey as string) end as home_club_id,
               cast((o_orderkey * 7 + c_nationkey) % 25 as string) || '.0' as away_club_id,
               n_name as home_club_name, cast(null as string) as away_club_name,
               case when o_orderstatus = 'P' then 'sold out' else cast(o_custkey as string) end as attendance,
               '4-3-3 attacking, wide, high line' as home_club_formation, cast(null as string) as away_club_formation,
               case when o_orderstatus = 'P' then null else cast(cast(floor(o_totalprice) as bigint) % 5 as string) end as home_club_goals,
               cast(cast(floor(o_totalprice / 5) as bigint) % 4 as string) as away_club_goals,
               o_orderkey as _row_order
        from orders join customer on o_custkey = c_custkey join nation on n_nationkey = c_nationkey""",
    "raw_club_games": """
        select cast(o_orderkey as string) as game_id, ' Home' as hosting, cast(o_custkey % 20 + 1 as string) as own_position
        from orders
        union all
        select cast(o_orderkey as string), 'Away ', case when o_orderstatus = 'F' then null else cast(o_custkey % 18 + 1 as string) end
        from orders""",
    "raw_appearances": """
        select cast(l_orderkey as string) || '_' || cast(l_linenumber as string) as appearance_id,
               cast(l_orderkey as string) as game_id, cast(l_partkey as string) as player_id,
               cast(s_nationkey as string) as player_club_id, 'CSV' as competition_id,
               case when l_tax > 0.05 then null else 'Player ' || cast(l_partkey as string) end as player_name,
               cast(l_quantity as string) as minutes_played,
               case when l_returnflag = 'R' then null else cast(l_linenumber % 4 as string) end as goals,
               '1' as assists, '0' as yellow_cards, cast(null as string) as red_cards
        from lineitem join supplier on l_suppkey = s_suppkey""",
    "raw_game_lineups": """
        select cast(l_orderkey as string) as game_id, cast(l_partkey as string) as player_id,
               case when l_linestatus = 'O' then 'starting_lineup' else 'substitutes' end as type,
               case when l_returnflag = 'N' then null else 'Centre-Back' end as position,
               case when l_discount > 0.05 then '1.0' else 'false' end as team_captain,
               lpad(cast(l_linenumber as string), 3, '0') || lpad(cast(l_suppkey as string), 12, '0')
                   || lpad(cast(cast(l_extendedprice * 100 as bigint) as string), 12, '0') as _row_order
        from lineitem where l_shipdate >= date '1997-01-01'""",
    "raw_game_events": """
        select cast(event_id as string) as game_event_id, cast(cast(floor(event_id / 4) as bigint) as string) as game_id,
               cast(user_id % 27 as string) as club_id,
               case when value > 300 then null else cast(user_id as string) end as player_id,
               case event_type when 'purchase' then 'Goals' when 'error' then 'Cards' else 'Substitutions' end as type,
               case when value > 50 then ', Red card ' when value > 20 then ',, Yellow card' when value > 5 then ', '
                    else null end as description,
               case when value > 10 then cast(user_id + 1 as string) when value > 5 then '99999999' else null end as player_in_id,
               case when value > 15 then cast(user_id + 2 as string) else '99999999' end as player_assist_id,
               cast(minute(ts) as string) as minute, event_id as _row_order
        from events""",
    "raw_transfers": f"""
        select cast(o_custkey as string) as player_id,
               case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then 'soon' else cast({_DAY} as string) end as transfer_date,
               case when o_orderstatus = 'F' then lpad(cast(year({_DAY}) % 100 as string), 2, '0') || '/' || lpad(cast((year({_DAY}) + 1) % 100 as string), 2, '0')
                    when o_orderstatus = 'O' then cast(90 + o_custkey % 10 as string) || '/00'
                    when o_orderpriority = '1-URGENT' then null when o_orderpriority = '2-HIGH' then '2023' else 'x/y' end as transfer_season,
               case when c_acctbal < 0 then null else cast(c_nationkey as string) end as from_club_id,
               cast((o_orderkey * 7 + c_nationkey) % 30 as string) as to_club_id,
               case when o_orderstatus = 'P' then null else 'Club ' || cast(c_nationkey as string) end as from_club_name,
               'Next club' as to_club_name,
               case when o_orderpriority = '1-URGENT' then '€' || cast(o_custkey % 90 as string) || '.50m'
                    when o_orderpriority = '2-HIGH' then ' ' || cast(o_custkey % 900 as string) || ' K'
                    when o_orderpriority = '3-MEDIUM' then 'Free Transfer'
                    when o_orderpriority = '4-NOT SPECIFIED' then cast(o_custkey as string)
                    when o_orderstatus = 'F' then 'abc' when o_orderstatus = 'O' then '1.2.3m' else null end as transfer_fee,
               case when o_orderstatus = 'F' then 'n/k' else cast(o_totalprice as string) end as market_value_in_eur,
               'Player ' || cast(o_custkey as string) as player_name, o_orderkey as _row_order
        from orders join customer on o_custkey = c_custkey""",
    "raw_player_valuations": """
        select cast(user_id as string) as player_id,
               case when event_type = 'view' then '31/01/2024' else cast(cast(ts as date) as string) end as date,
               case when value > 200 then 'none' else cast(value as string) end as market_value_in_eur,
               case when value < 3 then null else cast(user_id % 27 as string) end as current_club_id,
               case when event_type = 'click' then null else 'ES1' end as player_club_domestic_competition_id,
               event_id as _row_order
        from events""",
}


def integer(column: str) -> str:
    return f"coalesce(try_cast({column} as int), cast(try_cast({column} as double) as int))"


def _absent(columns: str) -> str:
    """Text columns of a table that its source does not have."""
    return ", ".join(f"'N/A' as {c}" for c in columns.split())


# What each load must produce, written against the source rows.
BUILT = {
    "built_competitions": f"""
        select competition_id, coalesce(competition_code, 'N/A') as competition_code, coalesce(name, 'N/A') as name,
               coalesce(sub_type, 'N/A') as sub_type, coalesce(type, 'N/A') as type, coalesce({integer('country_id')}, -1) as country_id,
               coalesce(country_name, 'N/A') as country_name, coalesce(domestic_league_code, 'N/A') as domestic_league_code,
               coalesce(confederation, 'N/A') as confederation, coalesce(url, 'N/A') as url,
               coalesce(try_cast(is_major_national_league as boolean), try_cast(is_major_national_league as double) <> 0, false) as is_major_national_league
        from (select *, row_number() over (partition by competition_id order by _row_order) as rn from raw_competitions) r
        where rn = 1""",
    "built_clubs": f"""
        select {integer('club_id')} as club_id, coalesce(club_code, 'N/A') as club_code, coalesce(name, 'N/A') as name,
               coalesce(domestic_competition_id, 'N/A') as domestic_competition_id,
               coalesce(try_cast(total_market_value as decimal(15,2)), -1) as total_market_value,
               coalesce({integer('squad_size')}, -1) as squad_size, coalesce(try_cast(average_age as decimal(4,2)), 0) as average_age,
               coalesce({integer('foreigners_number')}, -1) as foreigners_number,
               coalesce(try_cast(foreigners_percentage as decimal(5,2)), 0) as foreigners_percentage,
               coalesce({integer('national_team_players')}, -1) as national_team_players,
               coalesce(stadium_name, 'N/A') as stadium_name, coalesce({integer('stadium_seats')}, -1) as stadium_seats,
               coalesce(net_transfer_record, 'N/A') as net_transfer_record, coalesce(coach_name, 'N/A') as coach_name,
               coalesce({integer('last_season')}, -1) as last_season, coalesce(url, 'N/A') as url
        from (select *, row_number() over (partition by club_id order by _row_order) as rn from raw_clubs) r
        where rn = 1 and club_id is not null
        union all
        select -1, 'N/A', 'Desconocido', 'N/A', -1, -1, -1, -1, -1, -1, 'N/A', -1, 'N/A', 'N/A', -1, 'N/A'""",
    "built_players": f"""
        select *, {_absent(
            "first_name last_name player_code country_of_birth city_of_birth sub_position foot agent_name image_url url "
            "current_club_domestic_competition_id current_club_name"
        )}
        from (
        select {integer('player_id')} as player_id, coalesce(name, 'N/A') as name, coalesce({integer('last_season')}, -1) as last_season,
               coalesce({integer('current_club_id')}, -1) as current_club_id,
               coalesce(country_of_citizenship, 'N/A') as country_of_citizenship,
               coalesce(try_cast(date_of_birth as date), date '1900-01-01') as date_of_birth,
               coalesce(position, 'N/A') as position, coalesce(try_cast(height_in_cm as decimal(5,2)), -1) as height_in_cm,
               coalesce(try_cast(contract_expiration_date as date), date '9999-12-31') as contract_expiration_date,
               coalesce(try_cast(market_value_in_eur as decimal(15,2)), -1) as market_value_in_eur,
               coalesce(try_cast(highest_market_value_in_eur as decimal(15,2)), -1) as highest_market_value_in_eur
        from (select *, row_number() over (partition by player_id order by _row_order) as rn from raw_players) r where rn = 1
        union all
        select -1, 'Desconocido', -1, -1, 'N/A', date '1900-01-01', 'N/A', -1, date '9999-12-31', -1, -1) p""",
    "built_games": f"""
        select * from (
            select {integer('game_id')} as game_id, competition_id, coalesce({integer('season')}, -1) as season,
                   coalesce(left(round, 50), 'N/A') as round, try_cast(date as date) as date,
                   coalesce({integer('home_club_id')}, -1) as home_club_id, coalesce({integer('away_club_id')}, -1) as away_club_id,
                   coalesce(home_club_name, 'N/A') as home_club_name, coalesce(away_club_name, 'N/A') as away_club_name,
                   coalesce({integer('attendance')}, -1) as attendance,
                   coalesce(left(home_club_formation, 20), 'N/A') as home_club_formation,
                   coalesce(left(away_club_formation, 20), 'N/A') as away_club_formation,
                   {_absent("stadium referee url home_club_manager_name away_club_manager_name aggregate competition_type")}
            from raw_games) g
        where date is not null and home_club_id in (select club_id from built_clubs)
          and away_club_id in (select club_id from built_clubs)
          and competition_id in (select competition_id from built_competitions)""",
    "built_fact_games": f"""
        select game_id, competition_id, home_club_id, away_club_id, date_id, season, home_club_goals, away_club_goals,
               home_club_position, away_club_position, attendance, home_club_goals - away_club_goals as goal_difference,
               home_club_goals + away_club_goals as total_goals, home_club_goals > away_club_goals as is_home_win,
               home_club_goals = away_club_goals as is_draw, home_club_goals < away_club_goals as is_away_win
        from (
            select {integer('r.game_id')} as game_id, competition_id, coalesce({integer('home_club_id')}, -1) as home_club_id,
                   coalesce({integer('away_club_id')}, -1) as away_club_id,
                   coalesce(cast(strftime(try_cast(date as date), '%Y%m%d') as int), -1) as date_id,
                   coalesce({integer('season')}, -1) as season, coalesce({integer('home_club_goals')}, 0) as home_club_goals,
                   coalesce({integer('away_club_goals')}, 0) as away_club_goals,
                   coalesce({integer('h.own_position')}, 0) as home_club_position,
                   coalesce({integer('a.own_position')}, 0) as away_club_position, coalesce({integer('attendance')}, -1) as attendance
            from raw_games r left join raw_club_games h on h.game_id = r.game_id and trim(h.hosting) = 'Home'
                 left join raw_club_games a on a.game_id = r.game_id and trim(a.hosting) = 'Away') g
        where game_id in (select game_id from built_games) and date_id in (select date_id from dim_date)""",
    "built_fact_appearances": f"""
        select appearance_id, game_id, player_id, club_id, competition_id, date_id,
               coalesce(player_name, 'Unknown') as player_name, coalesce(type, 'Unknown') as type,
               coalesce(position, 'Unknown') as position, coalesce(team_captain, false) as team_captain,
               coalesce(minutes_played, 0) as minutes_played, coalesce(goals, 0) as goals, coalesce(assists, 0) as assists,
               coalesce(yellow_cards, 0) as yellow_cards, coalesce(red_cards, 0) as red_cards
        from (
            select a.appearance_id, {integer('a.game_id')} as game_id, {integer('a.player_id')} as player_id,
                   {integer('player_club_id')} as club_id, player_name, l.type, l.position,
                   l.team_captain = '1.0' as team_captain, {integer('minutes_played')} as minutes_played, {integer('goals')} as goals,
                   {integer('assists')} as assists, {integer('yellow_cards')} as yellow_cards, {integer('red_cards')} as red_cards
            from raw_appearances a left join (
                select *, row_number() over (partition by game_id, player_id order by _row_order) as rn
                from raw_game_lineups) l on l.game_id = a.game_id and l.player_id = a.player_id and rn = 1) x
             join (select game_id, competition_id, cast(strftime(date, '%Y%m%d') as int) as date_id from built_games) g using (game_id)
        where player_id in (select player_id from built_players) and club_id in (select club_id from built_clubs)""",
    "built_fact_game_events": f"""
        select event_id, game_id, club_id, player_id, date_id, competition_id, type, coalesce(description, 'Unknown') as description,
               case when player_in_id in (select player_id from built_players) then player_in_id else -1 end as player_in_id,
               case when player_assist_id in (select player_id from built_players) then player_assist_id else -1 end as player_assist_id,
               minute
        from (
            select game_event_id as event_id, {integer('game_id')} as game_id, {integer('club_id')} as club_id,
                   coalesce({integer('player_id')}, -1) as player_id, type, nullif(trim(ltrim(description, ', ')), '') as description,
                   case when type = 'Substitutions' then coalesce({integer('player_in_id')}, -1) else -1 end as player_in_id,
                   case when type = 'Goals' then coalesce({integer('player_assist_id')}, -1) else -1 end as player_assist_id,
                   coalesce({integer('minute')}, -1) as minute
            from raw_game_events) e
             join (select game_id, competition_id, cast(strftime(date, '%Y%m%d') as int) as date_id from built_games) g using (game_id)
        where club_id in (select club_id from built_clubs) and player_id in (select player_id from built_players)""",
    "built_fact_transfers": f"""
        select row_number() over (order by _row_order) as transfer_id, player_key as player_id,
               case when from_key in (select club_id from built_clubs) then from_key else -1 end as from_club_id,
               case when to_key in (select club_id from built_clubs) then to_key else -1 end as to_club_id,
               transfer_date_id, season_start as transfer_season, coalesce(player_name, 'Unknown') as player_name,
               coalesce(from_club_name, 'Unknown') as from_club_name, coalesce(to_club_name, 'Unknown') as to_club_name,
               coalesce(fee, -1) as transfer_fee, coalesce(market_value, -1) as market_value_in_eur
        from (
            select *, {integer('player_id')} as player_key, cast(strftime(try_cast(transfer_date as date), '%Y%m%d') as int) as transfer_date_id,
                   case when regexp_full_match(transfer_season, '\\d+/\\d+')
                        then case when cast(split_part(transfer_season, '/', 1) as int) < 50 then 2000 else 1900 end
                             + cast(split_part(transfer_season, '/', 1) as int) else -1 end as season_start,
                   case when lower(trim(transfer_fee)) in ('free', 'loan', 'free transfer', '-', '?') then 0
                        else cast(try_cast(regexp_extract(lower(transfer_fee), '[\\d.]+') as decimal(12,2))
                             * case regexp_extract(lower(transfer_fee), '[\\d.]+\\s*([mk])', 1) when 'm' then 1000000 when 'k' then 1000 else 1 end
                             as decimal(15,2)) end as fee,
                   try_cast(market_value_in_eur as decimal(15,2)) as market_value,
                   {integer('from_club_id')} as from_key, {integer('to_club_id')} as to_key
            from raw_transfers) t
        where player_key in (select player_id from built_players) and transfer_date_id in (select date_id from dim_date)""",
    "built_fact_player_valuations": f"""
        select row_number() over (order by _row_order) as valuation_id, player_key as player_id, club_key as club_id,
               coalesce(player_club_domestic_competition_id, 'Unknown') as competition_id, date_key as date_id,
               coalesce(try_cast(market_value_in_eur as decimal(15,2)), -1) as market_value_in_eur
        from (
            select *, coalesce({integer('player_id')}, -1) as player_key, coalesce({integer('current_club_id')}, -1) as club_key,
                   coalesce(cast(strftime(try_cast(date as date), '%Y%m%d') as int), -1) as date_key
            from raw_player_valuations) v
        where player_key in (select player_id from built_players) and club_key in (select club_id from built_clubs)
          and date_key in (select date_id from dim_date)""",
}


def with_raw(names: str, query: str) -> str:
    """The check query preceded by the source and target views named."""
    views = {**RAW, **BUILT, "dim_date": DATE_SQL}
    parts = [f"{name} as ({views[name]})" for name in names.split()]
    return "with " + ",\n".join(parts) + "\n" + query.strip()


def raw_tables(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The source rows of one scale, by file name."""
    return Warehouse(lambda name: sql_view(spark, sf_dir, RAW[f"raw_{name}"]), [n.removeprefix("raw_") for n in RAW])
