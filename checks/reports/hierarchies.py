"""Check queries of the slices, dices, roll-ups and drill-downs.

Parameters differ from the defaults only where the test tables have other names or few rows.
"""

from starmart.plans import hierarchies, slices
from checks.sql import big_five, isum, msum, rounded
from checks.testmart import with_mart

# Each entry: report, parameters, check query.
REPORTS: dict[str, tuple] = {}

REPORTS["q01_1"] = (slices.q01_1, {}, with_mart("fact_transfers dim_clubs dim_competitions", f"""
    select c.name as club, comp.name as league, count(*) as transfers,
           cast(sum(transfer_fee) filter (where transfer_fee > 0) as double) as spend,
           {rounded('sum(transfer_fee) filter (where transfer_fee > 0)', 'count(*) filter (where transfer_fee > 0)', 2)} as mean_fee
    from fact_transfers t join dim_clubs c on t.to_club_id = c.club_id
         left join dim_competitions comp on c.domestic_competition_id = comp.competition_id
    where transfer_season = 2023 and c.club_id <> -1
    group by c.name, comp.name
    order by spend desc nulls last, club, league nulls last limit 15"""))

REPORTS["q01_2"] = (slices.q01_2, {}, with_mart("fact_games dim_games", f"""
    select g.home_club_name as club, count(*) as home_games, {isum('home_club_goals')} as goals_for,
           {isum('away_club_goals')} as goals_against, count(*) filter (where is_home_win) as home_wins,
           {rounded('sum(home_club_goals)', 'count(*)', 2)} as goals_per_game,
           {rounded('count(*) filter (where is_home_win)', 'count(*)', 1, 100)} as win_pct
    from fact_games f join dim_games g using (game_id)
    where f.competition_id = 'GB1'
    group by g.home_club_name having count(*) >= 20
    order by win_pct desc, club limit 15"""))

REPORTS["q01_3"] = (slices.q01_3, {"club_id": 7}, with_mart("fact_transfers dim_date", """
    select full_date, year, player_name,
           case when to_club_id = 7 then 'FICHAJE' when from_club_id = 7 then 'VENTA' end as operation,
           case when to_club_id = 7 then from_club_name else to_club_name end as counterpart,
           cast(transfer_fee as double) as transfer_fee, cast(market_value_in_eur as double) as market_value
    from fact_transfers join dim_date on transfer_date_id = date_id
    where (to_club_id = 7 or from_club_id = 7) and transfer_fee > 0
    order by full_date desc, transfer_fee desc, player_name, operation, counterpart, market_value desc limit 30"""))

REPORTS["q02_1"] = (slices.q02_1, {}, with_mart("fact_appearances dim_players dim_date dim_competitions", f"""
    select p.name as player, p.position as position, comp.name as league, {isum('goals')} as goals,
           {isum('assists')} as assists, {isum('goals + assists')} as goal_involvements,
           count(distinct game_id) as games, {rounded('sum(goals)', 'count(distinct game_id)', 2)} as goals_per_game
    from fact_appearances a join dim_players p using (player_id) join dim_date d using (date_id)
         join dim_competitions comp using (competition_id)
    where p.country_of_citizenship = 'Spain' and {big_five('a.competition_id')}
      and d.year between 2020 and 2024 and p.player_id <> -1
    group by p.name, p.position, comp.name having sum(goals) > 0
    order by goals desc, player, position, league limit 20"""))

REPORTS["q02_2"] = (slices.q02_2, {}, with_mart("fact_transfers dim_clubs dim_date", f"""
    select player_name as player, from_club_name, to_club_name, d.year as year,
           cast(transfer_fee as double) as fee, cast(market_value_in_eur as double) as market_value,
           {rounded('transfer_fee', 'market_value_in_eur', 2)} as fee_to_value
    from fact_transfers t join dim_date d on transfer_date_id = date_id
         join dim_clubs o on from_club_id = o.club_id join dim_clubs n on to_club_id = n.club_id
    where o.domestic_competition_id = 'L1' and n.domestic_competition_id = 'GB1'
      and d.year between 2018 and 2024 and transfer_fee > 10000000
    order by fee desc, player, from_club_name, to_club_name, year, market_value desc limit 20"""))

REPORTS["q02_3"] = (slices.q02_3, {}, with_mart("fact_game_events dim_games dim_date dim_players dim_competitions", f"""
    select comp.name as league, home_club_name || ' vs ' || away_club_name as match, full_date, day_name,
           p.name as player, minute, description as detail
    from fact_game_events e join dim_games g using (game_id) join dim_date d using (date_id)
         join dim_players p using (player_id) join dim_competitions comp on comp.competition_id = e.competition_id
    where type = 'Cards' and description ilike '%red card%' and {big_five('e.competition_id')}
      and is_weekend and player_id <> -1
    order by full_date desc, match, minute, player, detail, league limit 25"""))

REPORTS["q03_1"] = (hierarchies.q03_1, {}, with_mart("fact_games dim_date", f"""
    select year, quarter, month, {isum('total_goals')} as goals, count(*) as games,
           {rounded('sum(total_goals)', 'count(*)', 2)} as goals_per_game
    from fact_games join dim_date using (date_id) where year between 2020 and 2024
    group by rollup (year, quarter, month)"""))

REPORTS["q03_2"] = (hierarchies.q03_2, {}, with_mart("fact_transfers dim_clubs dim_competitions", f"""
    select confederation, comp.name as league, c.name as club, count(*) as sales,
           {msum('transfer_fee')} as income, {rounded('sum(transfer_fee)', 'count(*)', 2)} as mean_income
    from fact_transfers join dim_clubs c on from_club_id = club_id
         left join dim_competitions comp on domestic_competition_id = competition_id
    where club_id <> -1 and transfer_fee > 0
    group by rollup (confederation, comp.name, c.name)"""))

REPORTS["q03_3"] = (hierarchies.q03_3, {}, with_mart("fact_appearances dim_players", f"""
    select p.position as position, country_of_citizenship as country, p.name as player, {isum('goals')} as goals,
           {isum('assists')} as assists, count(distinct game_id) as games
    from fact_appearances a join dim_players p using (player_id)
    where {big_five()} and player_id <> -1 and p.position <> 'N/A'
    group by rollup (p.position, country_of_citizenship, p.name) having sum(goals) > 0"""))


def _attendance(level: str, period: str, where: str, keys: str) -> str:
    mean = rounded("sum(attendance) filter (where attendance > 0)", "count(*) filter (where attendance > 0)", 0)
    return with_mart("fact_games dim_date", f"""
    select '{level}' as level, {period} as period, {mean} as mean_attendance,
           cast(sum(attendance) filter (where attendance > 0) as bigint) as attendance, count(*) as games
    from fact_games join dim_date using (date_id) where competition_id = 'GB1' and {where} group by {keys}""")


REPORTS["q04_1a"] = (hierarchies.q04_1a, {}, _attendance(
    "Nivel 1: Año", "cast(year as varchar)", "year between 2018 and 2024", "year"))
REPORTS["q04_1b"] = (hierarchies.q04_1b, {}, _attendance(
    "Nivel 2: Trimestre", "year || '-Q' || quarter", "year = 2023", "year, quarter"))
REPORTS["q04_1c"] = (hierarchies.q04_1c, {}, _attendance(
    "Nivel 3: Mes", "year || '-' || lpad(cast(month as varchar), 2, '0') || ' (' || month_name || ')'",
    "year = 2023 and quarter = 1", "year, month, month_name"))

REPORTS["q04_2a"] = (hierarchies.q04_2a, {}, with_mart("fact_appearances dim_date dim_competitions", f"""
    select 'Nivel 1: Liga' as level, comp.name as league, {isum('goals')} as goals
    from fact_appearances a join dim_date using (date_id) join dim_competitions comp using (competition_id)
    where {big_five()} and season_start_year = 2022 group by comp.name"""))

REPORTS["q04_2b"] = (hierarchies.q04_2b, {}, with_mart("fact_appearances dim_date dim_clubs", f"""
    select 'Nivel 2: Club' as level, c.name as club, {isum('goals')} as goals, count(distinct player_id) as players
    from fact_appearances join dim_date using (date_id) join dim_clubs c using (club_id)
    where competition_id = 'ES1' and season_start_year = 2022
    group by c.name having sum(goals) > 0 order by goals desc, club limit 15"""))

REPORTS["q04_2c"] = (hierarchies.q04_2c, {"club": "%NATION_15%"}, with_mart("fact_appearances dim_date dim_clubs dim_players", f"""
    select 'Nivel 3: Jugador' as level, p.name as player, p.position as position, {isum('goals')} as goals,
           {isum('assists')} as assists, count(distinct game_id) as games, {isum('minutes_played')} as minutes
    from fact_appearances a join dim_date using (date_id) join dim_clubs c using (club_id)
         join dim_players p using (player_id)
    where competition_id = 'ES1' and season_start_year = 2022 and c.name ilike '%nation_15%'
    group by p.name, p.position having sum(goals) > 0"""))

REPORTS["q04_3a"] = (hierarchies.q04_3a, {}, with_mart("fact_player_valuations dim_date dim_competitions", """
    select 'Nivel 1: Confederacion' as level, confederation, cast(sum(market_value_in_eur) filter (where market_value_in_eur > 0) as double) as value,
           count(distinct player_id) as players
    from fact_player_valuations join dim_date using (date_id) join dim_competitions using (competition_id)
    where year = 2024 and month = 1 group by confederation"""))

REPORTS["q04_3b"] = (hierarchies.q04_3b, {}, with_mart("fact_player_valuations dim_date dim_competitions", f"""
    select 'Nivel 2: Liga' as level, name as league, cast(sum(market_value_in_eur) filter (where market_value_in_eur > 0) as double) as value,
           count(distinct player_id) as players,
           {rounded('sum(market_value_in_eur) filter (where market_value_in_eur > 0)',
                    'count(*) filter (where market_value_in_eur > 0)', 0)} as mean_value
    from fact_player_valuations join dim_date using (date_id) join dim_competitions using (competition_id)
    where year = 2024 and month = 1 and confederation = 'europa'
    group by name order by value desc nulls last, league limit 10"""))
