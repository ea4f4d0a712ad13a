"""Check queries of the cross tables and trends."""

from starmart.plans import crosstabs, trends
from checks.sql import big_five, isum, rounded
from checks.testmart import with_mart

FEE = "transfer_fee) filter (where transfer_fee > 0"
SPEND = f"cast(sum({FEE}) as double)"

REPORTS: dict[str, tuple] = {}

REPORTS["q05_1"] = (crosstabs.q05_1, {}, with_mart("fact_games dim_date", f"""
    select season_start_year as season,
           cast(sum(total_goals) filter (where competition_id = 'ES1') as bigint) as la_liga,
           cast(sum(total_goals) filter (where competition_id = 'GB1') as bigint) as premier_league,
           cast(sum(total_goals) filter (where competition_id = 'IT1') as bigint) as serie_a,
           cast(sum(total_goals) filter (where competition_id = 'L1') as bigint) as bundesliga,
           cast(sum(total_goals) filter (where competition_id = 'FR1') as bigint) as ligue_1,
           {isum('total_goals')} as total
    from fact_games join dim_date using (date_id)
    where {big_five()} and season_start_year between 2015 and 2024 group by season_start_year"""))

_SEASON_SPEND = ",\n".join(
    rounded(f"sum(transfer_fee) filter (where transfer_fee > 0 and transfer_season = {y})", "1000000", 1)
    + f" as spend_{y}_m" for y in range(2020, 2025))
REPORTS["q05_2"] = (crosstabs.q05_2, {}, with_mart("fact_transfers dim_clubs", f"""
    select name as club, {_SEASON_SPEND},
           {rounded(f'sum({FEE})', '1000000', 1)} as total_m
    from fact_transfers join dim_clubs on to_club_id = club_id
    where transfer_season between 2020 and 2024 and club_id <> -1
    group by name order by sum({FEE}) desc nulls last, name limit 10"""))

REPORTS["q05_3"] = (crosstabs.q05_3, {}, with_mart("fact_game_events dim_date", f"""
    select type, {', '.join(f"count(*) filter (where day_name = '{d}') as {d.lower()}" for d in crosstabs.WEEKDAYS)},
           count(*) as total
    from fact_game_events join dim_date using (date_id) where {big_five()} group by type"""))

REPORTS["q06_1"] = (trends.q06_1, {"club": "%NATION_1%"}, with_mart("fact_transfers dim_clubs", f"""
    select transfer_season as season, count(*) as transfers, {SPEND} as spend,
           cast(sum(sum({FEE})) over (order by transfer_season) as double) as running_spend,
           {rounded(f'sum({FEE})', 'count(*) filter (where transfer_fee > 0)', 0)} as mean_fee
    from fact_transfers join dim_clubs on to_club_id = club_id
    where name ilike '%nation_1%' and transfer_season between 2015 and 2024 group by transfer_season"""))

REPORTS["q06_2"] = (trends.q06_2, {}, with_mart("fact_games dim_date", f"""
    select period, games, goals, cast(per_game as double) as goals_per_game,
           {rounded('sum(per_game) over w', 'count(per_game) over w', 2)} as moving_average
    from (
        select year || '-' || lpad(cast(month as varchar), 2, '0') as period, count(*) as games,
               {isum('total_goals')} as goals,
               cast({rounded('sum(total_goals)', 'count(*)', 2)} as decimal(9,2)) as per_game
        from fact_games join dim_date using (date_id)
        where competition_id = 'ES1' and year between 2020 and 2024 group by year, month) m
    window w as (order by period rows between 2 preceding and current row)"""))

REPORTS["q06_3"] = (trends.q06_3, {"player": "%ring%"}, with_mart("fact_player_valuations dim_players dim_date", f"""
    select year, cast(value as double) as value, cast(before as double) as previous_value,
           {rounded('value - before', 'before', 1, 100)} as change_pct
    from (
        select year, max(market_value_in_eur) as value, lag(max(market_value_in_eur)) over (order by year) as before
        from fact_player_valuations join dim_players p using (player_id) join dim_date using (date_id)
        where p.name ilike '%ring%' and market_value_in_eur > 0 group by year) y"""))

REPORTS["q06_4"] = (trends.q06_4, {}, with_mart("fact_appearances dim_players", f"""
    select case tier when 1 then 'Tier 1 (Elite)' when 2 then 'Tier 2 (Alto)' when 3 then 'Tier 3 (Medio)'
                     when 4 then 'Tier 4 (Bajo)' end as category,
           count(*) as players, cast(min(goals) as bigint) as min_goals, cast(max(goals) as bigint) as max_goals,
           {rounded('sum(goals)', 'count(*)', 1)} as mean_goals
    from (
        select p.name, sum(goals) as goals, ntile(4) over (order by sum(goals) desc, p.name) as tier
        from fact_appearances join dim_players p using (player_id)
        where {big_five()} and player_id <> -1 and p.position in ('Attack', 'Midfield')
        group by p.name having sum(goals) > 0) t
    group by tier"""))

REPORTS["q06_5"] = (trends.q06_5, {}, with_mart("fact_appearances dim_players dim_clubs dim_competitions", f"""
    select league, club, player, position, goals, games from (
        select comp.name as league, c.name as club, p.name as player, p.position as position,
               {isum('goals')} as goals, count(distinct game_id) as games,
               row_number() over (partition by comp.name, c.name order by sum(goals) desc, p.name, p.position) as rn
        from fact_appearances a join dim_players p using (player_id) join dim_clubs c using (club_id)
             join dim_competitions comp using (competition_id)
        where {big_five()} and player_id <> -1 and club_id <> -1
        group by comp.name, c.name, p.name, p.position having sum(goals) > 0) r
    where rn = 1"""))

REPORTS["q07_1"] = (crosstabs.q07_1, {}, with_mart("fact_games dim_date dim_competitions", f"""
    select case when grouping(comp.name) = 1 then '** TODAS LAS LIGAS **' else comp.name end as league,
           case when grouping(season_start_year) = 1 then '** TODAS **' else cast(season_start_year as varchar) end as season,
           {isum('total_goals')} as goals, count(*) as games, {rounded('sum(total_goals)', 'count(*)', 2)} as goals_per_game,
           cast(grouping(comp.name) as int) as all_leagues, cast(grouping(season_start_year) as int) as all_seasons
    from fact_games join dim_date using (date_id) join dim_competitions comp using (competition_id)
    where {big_five()} and season_start_year between 2020 and 2024
    group by grouping sets ((comp.name, season_start_year), (comp.name), (season_start_year), ())"""))

REPORTS["q07_2"] = (crosstabs.q07_2, {}, with_mart("fact_appearances", f"""
    select case when grouping(position) = 1 then '** TODAS **' else position end as position,
           case when grouping(type) = 1 then '** TODOS **' else type end as type,
           case when grouping(team_captain) = 1 then '** TODOS **' when team_captain then 'Si' else 'No' end as captain,
           count(*) as appearances, {isum('goals')} as goals, {isum('assists')} as assists,
           {rounded('sum(minutes_played)', 'count(*)', 0)} as mean_minutes, {isum('yellow_cards')} as yellow_cards,
           {isum('red_cards')} as red_cards
    from fact_appearances where {big_five()} and position not in ('Unknown', 'N/A')
    group by cube (fact_appearances.position, fact_appearances.type, team_captain)"""))


def _side(key: str, amount: str) -> str:
    return f"""select confederation, comp.name as league, sum({FEE}) as {amount}
        from fact_transfers join dim_clubs c on {key} = club_id
             left join dim_competitions comp on domestic_competition_id = competition_id
        where club_id <> -1 and transfer_season between 2020 and 2024 group by confederation, comp.name"""


REPORTS["q07_3"] = (crosstabs.q07_3, {}, with_mart("fact_transfers dim_clubs dim_competitions", f"""
    select coalesce(b.confederation, s.confederation, '** TOTAL **') as confederation,
           coalesce(b.league, s.league, '** TOTAL **') as league,
           cast(coalesce(spend, 0) as double) as spend, cast(coalesce(income, 0) as double) as income,
           cast(coalesce(income, 0) - coalesce(spend, 0) as double) as net,
           case when coalesce(income, 0) > coalesce(spend, 0) then 'SUPERAVIT'
                when coalesce(income, 0) < coalesce(spend, 0) then 'DeFICIT' else 'EQUILIBRIO' end as state
    from ({_side('to_club_id', 'spend')}) b full join ({_side('from_club_id', 'income')}) s on b.league = s.league
    order by net desc, league, spend desc limit 20"""))

REPORTS["q08_1"] = (trends.q08_1, {}, with_mart("fact_player_valuations dim_players dim_date", f"""
    , first_five as (
        select player_id, p.name as player from fact_player_valuations join dim_players p using (player_id)
        where competition_id = 'ES1' and market_value_in_eur > 0
        group by player_id, p.name order by max(market_value_in_eur) desc, player_id limit 5),
    monthly as (
        select player, year, month, max(market_value_in_eur) as value
        from fact_player_valuations join first_five using (player_id) join dim_date using (date_id)
        where year between 2022 and 2024 group by player, year, month)
    select player, year || '-' || lpad(cast(month as varchar), 2, '0') as period, cast(value as double) as value,
           {rounded('sum(value) over w', 'count(value) over w', 0)} as moving_average
    from monthly
    window w as (partition by player order by year, month rows between 5 preceding and current row)"""))

REPORTS["q08_2"] = (trends.q08_2, {}, with_mart("fact_appearances dim_competitions", f"""
    select case when grouping(comp.name) = 1 then '** TOTAL BIG FIVE **' else comp.name end as league, type,
           count(*) as appearances, {isum('goals')} as goals, {isum('minutes_played')} as minutes,
           {rounded('sum(goals)', 'sum(minutes_played)', 3, 90)} as goals_per_90
    from fact_appearances join dim_competitions comp using (competition_id)
    where {big_five()} and type in ('starting_lineup', 'substitutes') and minutes_played > 0
    group by grouping sets ((comp.name, type), (type))"""))

REPORTS["q08_3"] = (trends.q08_3, {}, with_mart("fact_transfers dim_clubs dim_competitions", f"""
    select league, season, cast(spend as double) as spend, cast(before as double) as previous_spend,
           {rounded('spend - before', 'before', 1, 100)} as change_pct,
           case when spend > before then 'SUBE' when spend < before then 'BAJA' else '--> ESTABLE' end as trend
    from (
        select comp.name as league, transfer_season as season, sum({FEE}) as spend,
               lag(sum({FEE})) over (partition by comp.name order by transfer_season) as before
        from fact_transfers join dim_clubs c on to_club_id = club_id
             left join dim_competitions comp on domestic_competition_id = competition_id
        where transfer_season between 2016 and 2024 and club_id <> -1 and {big_five()}
        group by comp.name, transfer_season) s
    where before is not null"""))

REPORTS["q08_4a"] = (trends.q08_4a, {}, with_mart("fact_appearances dim_competitions", f"""
    select case when grouping(position) = 1 then '** TODAS **' else position end as position,
           case when grouping(comp.name) = 1 then '** TODAS LAS LIGAS **' else comp.name end as league,
           {isum('yellow_cards')} as yellow_cards, {isum('red_cards')} as red_cards,
           {isum('yellow_cards + red_cards')} as cards, count(*) as appearances,
           {rounded('sum(yellow_cards)', 'count(*)', 2, 100)} as yellow_pct
    from fact_appearances a join dim_competitions comp using (competition_id)
    where {big_five()} and position not in ('Unknown', 'N/A')
    group by cube (a.position, comp.name) having sum(yellow_cards + red_cards) > 0"""))

REPORTS["q08_4b"] = (trends.q08_4b, {}, with_mart("fact_appearances dim_players dim_competitions", f"""
    select player, position, league, yellow_cards, red_cards, cards, games,
           {rounded('yellow_cards', 'games', 1, 100)} as yellow_pct
    from (
        select p.name as player, p.position as position, comp.name as league, {isum('yellow_cards')} as yellow_cards,
               {isum('red_cards')} as red_cards, {isum('yellow_cards + red_cards')} as cards,
               count(distinct game_id) as games,
               dense_rank() over (order by sum(yellow_cards + red_cards) desc) as rk
        from fact_appearances a join dim_players p using (player_id) join dim_competitions comp using (competition_id)
        where {big_five()} and player_id <> -1 group by p.name, p.position, comp.name) r
    where rk <= 10"""))

_CLUB = "(select min(club_id) from dim_clubs where name ilike '%nation_15%')"
REPORTS["q08_5"] = (trends.q08_5, {"club": "%NATION_15%"}, with_mart("fact_games dim_clubs dim_date", f"""
    , monthly as (
        select month, month_name, count(*) as games,
               count(*) filter (where (is_home_win and home_club_id = {_CLUB}) or (is_away_win and away_club_id = {_CLUB})) as wins,
               count(*) filter (where is_draw) as draws,
               cast(sum(case when home_club_id = {_CLUB} then home_club_goals else away_club_goals end) as bigint) as goals_for,
               cast(sum(case when home_club_id = {_CLUB} then away_club_goals else home_club_goals end) as bigint) as goals_against
        from fact_games join dim_date using (date_id)
        where competition_id = 'ES1' and season_start_year = 2023
          and (home_club_id = {_CLUB} or away_club_id = {_CLUB}) group by month, month_name)
    select month_name, games, wins, draws, games - wins - draws as losses, goals_for, goals_against,
           goals_for - goals_against as goal_difference,
           cast(sum(wins) over (order by month) as bigint) as running_wins,
           cast(sum(goals_for) over (order by month) as bigint) as running_goals
    from monthly"""))
