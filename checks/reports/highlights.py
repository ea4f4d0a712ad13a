"""Check queries of the highlights, players, teams and follow-up computations."""

from pyspark.sql import functions as F

from starmart.plans import highlights, notebook, players, teams
from checks.sql import big_five, isum, rounded
from checks.testmart import with_mart

FEE = "transfer_fee) filter (where transfer_fee > 0"
PRICED = "count(*) filter (where transfer_fee > 0)"

REPORTS: dict[str, tuple] = {}

REPORTS["q09_1"] = (highlights.q09_1, {}, with_mart("fact_appearances dim_players dim_clubs dim_competitions", f"""
    , scorers as (
        select p.name as player, p.position as position, country_of_citizenship as country,
               string_agg(distinct comp.name, ', ' order by comp.name) as leagues,
               string_agg(distinct c.name, ', ' order by c.name) as clubs, {isum('goals')} as goals,
               {isum('assists')} as assists, {isum('goals + assists')} as goal_involvements,
               count(distinct game_id) as games, {rounded('sum(goals)', 'count(distinct game_id)', 2)} as goals_per_game,
               {isum('minutes_played')} as minutes, {rounded('sum(goals)', 'sum(minutes_played)', 2, 90)} as goals_per_90
        from fact_appearances a join dim_players p using (player_id) join dim_clubs c using (club_id)
             join dim_competitions comp using (competition_id)
        where {big_five()} and player_id <> -1
        group by p.name, p.position, country_of_citizenship having sum(goals) > 0)
    select cast(row_number() over (order by goals desc, player, position, country) as int) as rank, *
    from scorers order by rank limit 25"""))

REPORTS["q09_2"] = (highlights.q09_2, {}, with_mart("fact_appearances dim_players dim_clubs", f"""
    , makers as (
        select p.name as player, p.position as position, country_of_citizenship as country,
               string_agg(distinct c.name, ', ' order by c.name) as clubs, {isum('assists')} as assists,
               {isum('goals')} as goals, count(distinct game_id) as games,
               {rounded('sum(assists)', 'count(distinct game_id)', 2)} as assists_per_game
        from fact_appearances a join dim_players p using (player_id) join dim_clubs c using (club_id)
        where {big_five()} and player_id <> -1
        group by p.name, p.position, country_of_citizenship having sum(assists) > 0)
    select cast(row_number() over (order by assists desc, player, position, country) as int) as rank, *
    from makers order by rank limit 25"""))

REPORTS["q09_3"] = (highlights.q09_3, {}, with_mart("fact_transfers dim_date", f"""
    select cast(row_number() over (order by transfer_fee desc, player_name, from_club_name, to_club_name,
                transfer_date_id, market_value_in_eur desc) as int) as rank,
           player_name as player, from_club_name, to_club_name, year, cast(transfer_fee as double) / 1e6 as fee_m,
           cast(market_value_in_eur as double) / 1e6 as market_value_m,
           {rounded('transfer_fee', 'market_value_in_eur', 2)} as fee_to_value,
           case when transfer_fee * 10 > market_value_in_eur * 13 then 'SOBREPAGADO'
                when transfer_fee * 10 < market_value_in_eur * 7 then 'GANGA' else 'PRECIO JUSTO' end as verdict
    from fact_transfers join dim_date on transfer_date_id = date_id
    where transfer_fee > 0 and market_value_in_eur > 0 order by rank limit 20"""))

REPORTS["q09_4"] = (highlights.q09_4, {}, with_mart("fact_games dim_competitions", f"""
    select name as league, count(*) as games, count(*) filter (where is_home_win) as home_wins,
           count(*) filter (where is_draw) as draws, count(*) filter (where is_away_win) as away_wins,
           {rounded('count(*) filter (where is_home_win)', 'count(*)', 1, 100)} as home_win_pct,
           {rounded('count(*) filter (where is_draw)', 'count(*)', 1, 100)} as draw_pct,
           {rounded('count(*) filter (where is_away_win)', 'count(*)', 1, 100)} as away_win_pct,
           {rounded('sum(home_club_goals)', 'count(*)', 2)} as home_goals_per_game,
           {rounded('sum(away_club_goals)', 'count(*)', 2)} as away_goals_per_game
    from fact_games join dim_competitions using (competition_id) where {big_five()} group by name"""))

_TOP_SCORERS = f"""
    select * exclude (rk) from (
        select comp.name as league, season_start_year as season, p.name as player,
               string_agg(distinct c.name, ', ' order by c.name) as clubs, {isum('goals')} as goals,
               count(distinct game_id) as games, {rounded('sum(goals)', 'count(distinct game_id)', 2)} as goals_per_game,
               rank() over (partition by comp.name, season_start_year order by sum(goals) desc) as rk
        from fact_appearances a join dim_players p using (player_id) join dim_clubs c using (club_id)
             join dim_date using (date_id) join dim_competitions comp using (competition_id)
        where {big_five()} and player_id <> -1 and season_start_year between 2015 and 2024
        group by comp.name, season_start_year, p.name having sum(goals) > 0) r
    where rk = 1"""
_SCORER_TABLES = "fact_appearances dim_players dim_clubs dim_date dim_competitions"
REPORTS["q09_5"] = (highlights.q09_5, {}, with_mart(_SCORER_TABLES, _TOP_SCORERS))


def _club_side(key: str, amount: str) -> str:
    return f"""select c.name as club, comp.name as league, sum({FEE}) as {amount}
        from fact_transfers join dim_clubs c on {key} = club_id
             left join dim_competitions comp on domestic_competition_id = competition_id
        where club_id <> -1 and {big_five()} group by c.name, comp.name"""


_BALANCES = f"""
    select coalesce(g.club, i.club) as club, coalesce(g.league, i.league) as league,
           {rounded('coalesce(spend, 0)', '1000000', 1)} as spend_m, {rounded('coalesce(income, 0)', '1000000', 1)} as income_m,
           {rounded('coalesce(income, 0) - coalesce(spend, 0)', '1000000', 1)} as net_m,
           case when coalesce(income, 0) > coalesce(spend, 0) then 'SUPERAVIT' else 'DEFICIT' end as state
    from ({_club_side('to_club_id', 'spend')}) g full join ({_club_side('from_club_id', 'income')}) i on g.club = i.club"""
_BALANCE_TABLES = "fact_transfers dim_clubs dim_competitions"
REPORTS["q09_6"] = (highlights.q09_6, {}, with_mart(_BALANCE_TABLES, f"{_BALANCES} order by net_m, club limit 30"))

_BANDS = "case " + " ".join(
    f"when minute {'> 90' if high is None else f'between {low} and {high}'} then '{name}'"
    for low, high, name in highlights.MINUTE_BANDS) + " else 'Desconocido' end"
_BAND_QUERY = f"""
    select {_BANDS} as minute_band, count(*) as goals,
           {rounded('count(*)', 'sum(count(*)) over ()', 1, 100)} as share_pct
    from fact_game_events where type = 'Goals' and {big_five()} and minute > 0 group by minute_band"""
REPORTS["q09_7"] = (highlights.q09_7, {}, with_mart("fact_game_events", _BAND_QUERY))

REPORTS["q09_8"] = (highlights.q09_8, {}, with_mart("fact_appearances dim_players", f"""
    select cast(row_number() over (order by sum(goals) desc, country_of_citizenship) as int) as rank,
           country_of_citizenship as country, count(distinct player_id) as players, {isum('goals')} as goals,
           {isum('assists')} as assists, {rounded('sum(goals)', 'count(distinct player_id)', 1)} as goals_per_player,
           {rounded('sum(goals)', 'count(distinct game_id)', 2)} as goals_per_game
    from fact_appearances join dim_players using (player_id)
    where {big_five()} and player_id <> -1 and country_of_citizenship <> 'N/A'
    group by country_of_citizenship having sum(goals) > 0 order by rank limit 10"""))

_YEAR_BASE = f"""
    , base as (
        select year, {PRICED} as transfers,
               cast({rounded(f'sum({FEE})', f'{PRICED} * 1000000', 2)} as decimal(18,2)) as mean_fee,
               {rounded('cast(quantile_cont(transfer_fee, 0.5) filter (where transfer_fee > 0) as decimal(18,2))', '1000000', 2)} as median_fee_m,
               {rounded('max(transfer_fee)', '1000000', 1)} as max_fee_m, {rounded(f'sum({FEE})', '1000000', 1)} as market_m
        from fact_transfers join dim_date on transfer_date_id = date_id where year between 2012 and 2025 group by year)"""
_YEARS = f"""{_YEAR_BASE}
    select year, transfers, cast(mean_fee as double) as mean_fee_m, median_fee_m, max_fee_m, market_m,
           {rounded('mean_fee - lag(mean_fee) over (order by year)', 'lag(mean_fee) over (order by year)', 1, 100)} as change_pct
    from base"""
REPORTS["q09_9"] = (highlights.q09_9, {}, with_mart("fact_transfers dim_date", _YEARS))

_SCORECARD = f"""
    , g as (
        select competition_id, count(*) as games, {isum('total_goals')} as goals,
               {rounded('sum(total_goals)', 'count(*)', 2)} as goals_per_game,
               {rounded('sum(attendance) filter (where attendance > 0)', 'count(*) filter (where attendance > 0)', 0)} as mean_attendance
        from fact_games where {big_five()} group by competition_id),
    f as (
        select competition_id, {PRICED} as transfers, {rounded(f'sum({FEE})', '1000000000', 2)} as spend_bn,
               {rounded(f'sum({FEE})', f'{PRICED} * 1000000', 2)} as mean_fee_m
        from fact_transfers join dim_clubs c on to_club_id = club_id
             left join dim_competitions on domestic_competition_id = competition_id
        where {big_five()} and club_id <> -1 group by competition_id),
    t as (
        select competition_id, {isum('yellow_cards')} as yellow_cards, {isum('red_cards')} as red_cards,
               {rounded('sum(yellow_cards)', 'count(*)', 2, 100)} as yellow_pct
        from fact_appearances where {big_five()} group by competition_id),
    scorecard as (
        select name as league, games, goals, goals_per_game, mean_attendance, transfers, spend_bn, mean_fee_m,
               yellow_cards, red_cards, yellow_pct
        from g join dim_competitions using (competition_id) left join f using (competition_id) left join t using (competition_id))"""
_SCORECARD_TABLES = "fact_games fact_transfers fact_appearances dim_clubs dim_competitions"
REPORTS["q09_10"] = (highlights.q09_10, {}, with_mart(_SCORECARD_TABLES, f"{_SCORECARD} select * from scorecard"))

REPORTS["q11_1"] = (players.q11_1, {"min_games": 20}, with_mart("fact_appearances dim_players", f"""
    , used as (
        select p.name as player, p.position as position, country_of_citizenship as country,
               count(distinct game_id) as games, {isum('minutes_played')} as minutes,
               {rounded('sum(minutes_played)', 'count(*)', 0)} as minutes_per_game, {isum('goals')} as goals,
               {isum('assists')} as assists, count(*) filter (where type = 'starting_lineup') as starts,
               count(*) filter (where type = 'substitutes') as from_bench,
               {rounded("count(*) filter (where type = 'starting_lineup')", 'count(*)', 1, 100)} as start_pct
        from fact_appearances a join dim_players p using (player_id)
        where {big_five()} and player_id <> -1
        group by p.name, p.position, country_of_citizenship having count(distinct game_id) >= 20)
    select cast(row_number() over w as int) as rank, *, cast(ntile(4) over w as int) as use_quartile
    from used window w as (order by games desc, player, position, country) order by rank limit 20"""))


def _captains(published: bool) -> str:
    def games(role: str) -> str:
        return f"sum(games) filter (where {role})"

    def amount(measure: str, role: str) -> str:
        return f"sum({measure})" if published else f"sum({measure}) filter (where {role})"

    normal, captain = "not team_captain", "team_captain"
    delta = rounded(
        f"{amount('goals', captain)} * {games(normal)} - {amount('goals', normal)} * {games(captain)}",
        f"{games(captain)} * {games(normal)}", 3)
    return with_mart("fact_appearances dim_players", f"""
    , roles as (
        select p.position as position, team_captain, count(distinct game_id) as games, sum(goals) as goals,
               sum(assists) as assists, sum(yellow_cards) as yellow
        from fact_appearances a join dim_players p using (player_id)
        where {big_five()} and player_id <> -1 and p.position not in ('Unknown', 'N/A') and minutes_played > 0
        group by p.position, team_captain)
    select position, cast({games(normal)} as bigint) as games_normal,
           {rounded(amount('goals', normal), games(normal), 3)} as goals_per_game_normal,
           {rounded(amount('assists', normal), games(normal), 3)} as assists_per_game_normal,
           cast({games(captain)} as bigint) as games_captain,
           {rounded(amount('goals', captain), games(captain), 3)} as goals_per_game_captain,
           {rounded(amount('assists', captain), games(captain), 3)} as assists_per_game_captain,
           {delta} as goals_per_game_delta,
           {rounded(amount('yellow', normal), games(normal), 3)} as yellow_per_game_normal,
           {rounded(amount('yellow', captain), games(captain), 3)} as yellow_per_game_captain
    from roles group by position""")


REPORTS["q11_2"] = (players.q11_2, {}, _captains(False))
REPORTS["q11_2_as_published"] = (players.q11_2, {"as_published": True}, _captains(True))

REPORTS["q11_3"] = (players.q11_3, {}, with_mart("fact_appearances dim_players dim_clubs dim_date", f"""
    , nomads as (
        select p.name as player, p.position as position, country_of_citizenship as country,
               cast(count(distinct club_id) as int) as clubs, cast(count(distinct competition_id) as int) as leagues,
               cast(count(distinct season_start_year) as int) as seasons,
               string_agg(distinct c.name, ' --> ' order by c.name) as club_list, {isum('goals')} as goals,
               {isum('assists')} as assists, count(distinct game_id) as games
        from fact_appearances a join dim_players p using (player_id) join dim_clubs c using (club_id)
             join dim_date using (date_id)
        where {big_five()} and player_id <> -1 and club_id <> -1
        group by p.name, p.position, country_of_citizenship having count(distinct club_id) >= 4)
    select cast(row_number() over (order by clubs desc, games desc, player, position, country) as int) as rank, *
    from nomads order by rank limit 25"""))

_RISE = rounded("value - before", "before", 1, 100)
REPORTS["q11_4"] = (players.q11_4, {}, with_mart("fact_player_valuations dim_players dim_date", f"""
    , yearly as (
        select player_id, p.name as player, position, country_of_citizenship as country, year,
               max(market_value_in_eur) as value
        from fact_player_valuations join dim_players p using (player_id) join dim_date using (date_id)
        where market_value_in_eur > 0 and player_id <> -1 and year between 2015 and 2024
        group by player_id, p.name, position, country_of_citizenship, year),
    moved as (
        select *, lag(value) over w as before, lead(value) over w as after
        from yearly window w as (partition by player_id order by year)),
    risen as (
        select *, {_RISE} as rise_pct from moved where before is not null and before > 1000000 and value > before)
    select cast(row_number() over (order by rise_pct desc, player_id, year) as int) as rank, player, position, country,
           year, {rounded('before', '1000000', 1)} as from_m, {rounded('value', '1000000', 1)} as to_m, rise_pct,
           {rounded('value - before', '1000000', 1)} as rise_m,
           case when after > value then 'SIGUE SUBIENDO' when after < value then 'Corrigio despues' else '-' end as next_year
    from risen order by rank limit 20"""))


def _feet() -> str:
    columns = []
    for foot in ("left", "right", "both"):
        mine = f"filter (where foot = '{foot}')"
        columns.append(f"count(distinct player_id) {mine} as players_{foot}")
        for name, measure in (("goals", "goals"), ("assists", "assists"), ("yellow", "yellow_cards")):
            if (name, foot) != ("yellow", "both"):
                value = rounded(f"sum({measure}) {mine}", f"sum(minutes_played) {mine}", 3, 90)
                columns.append(f"{value} as {name}_per_90_{foot}")
    return with_mart("fact_appearances dim_players", f"""
    select p.position as position, {', '.join(columns)}
    from fact_appearances a join dim_players p using (player_id)
    where {big_five()} and player_id <> -1 and foot in ('left', 'right', 'both')
      and p.position not in ('Unknown', 'N/A') and minutes_played > 0
    group by p.position""")


REPORTS["q11_5"] = (players.q11_5, {}, _feet())

REPORTS["q12_1"] = (teams.q12_1, {}, with_mart("fact_games dim_clubs dim_competitions", f"""
    , stats as (
        select comp.name as league, c.name as club,
               count(*) filter (where home_club_id = club_id) + count(*) filter (where away_club_id = club_id) as games,
               cast(coalesce(sum(home_club_goals) filter (where home_club_id = club_id), 0)
                  + coalesce(sum(away_club_goals) filter (where away_club_id = club_id), 0) as bigint) as goals_for,
               cast(coalesce(sum(away_club_goals) filter (where home_club_id = club_id), 0)
                  + coalesce(sum(home_club_goals) filter (where away_club_id = club_id), 0) as bigint) as goals_against
        from fact_games f join dim_clubs c on (home_club_id = club_id or away_club_id = club_id)
             join dim_competitions comp using (competition_id)
        where {big_five()} and club_id <> -1 group by comp.name, c.name having count(*) >= 50),
    ranked as (
        select *, cast(dense_rank() over (partition by league order by goals_for desc) as int) as attack_rank,
               cast(dense_rank() over (partition by league order by goals_against) as int) as defence_rank from stats)
    select league, club, games, goals_for, {rounded('goals_for', 'games', 2)} as goals_for_per_game, attack_rank,
           goals_against, {rounded('goals_against', 'games', 2)} as goals_against_per_game, defence_rank,
           goals_for - goals_against as goal_difference
    from ranked where attack_rank <= 5 or defence_rank <= 5"""))

_SPEND_RESULTS = f"""
    , spent as (
        select club_id, c.name as club, comp.name as league, sum({FEE}) as spend, {PRICED} as priced_transfers
        from fact_transfers join dim_clubs c on to_club_id = club_id
             left join dim_competitions comp on domestic_competition_id = competition_id
        where transfer_season between 2018 and 2024 and club_id <> -1 and {big_five()}
        group by club_id, c.name, comp.name),
    sides as (
        select home_club_id as club_id, is_home_win as won, home_club_goals - away_club_goals as diff
        from fact_games join dim_date using (date_id) where {big_five()} and season_start_year between 2018 and 2024
        union all
        select away_club_id, is_away_win, away_club_goals - home_club_goals
        from fact_games join dim_date using (date_id) where {big_five()} and season_start_year between 2018 and 2024),
    results as (
        select club_id, count(*) filter (where won) as wins, count(*) as games, {isum('diff')} as goal_difference
        from sides group by club_id having count(*) >= 50),
    report as (
        select club, league, {rounded('spend', '1000000', 1)} as spend_m, priced_transfers, games, wins,
               {rounded('wins', 'games', 1, 100)} as win_pct, goal_difference,
               cast(ntile(4) over (order by spend desc nulls first, club_id) as int) as spend_quartile,
               cast(ntile(4) over (order by cast(wins as double) / games desc nulls last, club_id) as int) as result_quartile
        from spent join results using (club_id) order by spend desc nulls last, club_id limit 30)"""
_SPEND_TABLES = "fact_transfers fact_games dim_clubs dim_competitions dim_date"
REPORTS["q12_2"] = (teams.q12_2, {}, with_mart(_SPEND_TABLES, f"{_SPEND_RESULTS} select * from report"))

_SEASONS = f"""
    , seasons as (
        select name as league, season_start_year as season, count(*) as games, {isum('total_goals')} as goals,
               cast({rounded('sum(total_goals)', 'count(*)', 3)} as decimal(9,3)) as per_game
        from fact_games join dim_date using (date_id) join dim_competitions using (competition_id)
        where {big_five()} and season_start_year between 2010 and 2024 group by name, season_start_year
        having count(*) >= 30)"""
_SEASON_TABLES = "fact_games dim_date dim_competitions"
REPORTS["q12_3"] = (teams.q12_3, {}, with_mart(_SEASON_TABLES, f"""{_SEASONS}
    select league, season, games, goals, cast(per_game as double) as goals_per_game,
           {rounded('10 * sum(per_game) over l', '10 * count(*) over l', 3)} as league_mean,
           {rounded('10 * (per_game * count(*) over l - sum(per_game) over l)', '10 * count(*) over l', 3)} as deviation,
           cast(per_game - lag(per_game) over (partition by league order by season) as double) as change,
           cast(rank() over (partition by league order by per_game desc) as int) as season_rank,
           cast(max(per_game) over l as double) as league_max, cast(min(per_game) over l as double) as league_min
    from seasons window l as (partition by league)"""))

_SPECTACULAR = f"""
    , spectacular as (
        select cast(row_number() over (order by total_goals desc, goal_difference desc, f.game_id) as int) as rank,
               comp.name as league, full_date, season_start_year as season, home_club_name as home,
               home_club_goals as home_goals, away_club_goals as away_goals, away_club_name as away, total_goals,
               abs(goal_difference) as difference,
               case when is_home_win then 'Victoria local' when is_away_win then 'Victoria visitante' else 'Empate' end as outcome,
               count(event_id) filter (where type = 'Cards') as cards,
               count(event_id) filter (where type = 'Substitutions') as substitutions
        from fact_games f join dim_games g on f.game_id = g.game_id join dim_date using (date_id)
             join dim_competitions comp on comp.competition_id = f.competition_id
             left join fact_game_events e on f.game_id = e.game_id
        where {big_five('f.competition_id')}
        group by f.game_id, comp.name, full_date, season_start_year, home_club_name, away_club_name, home_club_goals,
                 away_club_goals, total_goals, goal_difference, is_home_win, is_away_win
        order by rank limit 25)"""
_SPECTACULAR_TABLES = "fact_games fact_game_events dim_games dim_date dim_competitions"
REPORTS["q12_4"] = (teams.q12_4, {}, with_mart(_SPECTACULAR_TABLES, f"{_SPECTACULAR} select * from spectacular"))

# -- follow-up computations --------------------------------------------------------------------

_LEAGUE_NAMES = {"africa": "africa", "america": "america", "asia": "asia", "europe": "europe"}
_WINNERS = f"""
    , scorers as ({_TOP_SCORERS}),
    winners as (
        select * exclude (rn) from (
            select *, row_number() over (partition by league, season order by player) as rn from scorers) w where rn = 1)"""
REPORTS["nb_break_ties"] = (
    notebook.season_winners, {}, with_mart(_SCORER_TABLES, f"{_WINNERS} select * from winners"))
REPORTS["nb_pivot_matrix"] = (notebook.winner_matrix, {"league_names": _LEAGUE_NAMES}, with_mart(_SCORER_TABLES, f"""{_WINNERS}
    select season, {', '.join(
        f"max(split_part(player, ' ', -1) || ' (' || goals || ')') filter (where league = '{n}') as {n}"
        for n in _LEAGUE_NAMES)}
    from winners group by season"""))
REPORTS["nb_goals_matrix"] = (notebook.goals_matrix, {"league_names": _LEAGUE_NAMES}, with_mart(_SCORER_TABLES, f"""{_WINNERS}
    select season, {', '.join(f"max(goals) filter (where league = '{n}') as {n}" for n in _LEAGUE_NAMES)}
    from winners group by season"""))
REPORTS["sort_top_bottom"] = (notebook.extreme_balances, {"n": 3}, with_mart(_BALANCE_TABLES, f"""
    , balances as ({_BALANCES})
    select * from (select * from balances order by net_m, club limit 3) low
    union
    select * from (select * from balances order by net_m desc, club limit 3) high"""))
_BAND_LABEL_CASE = "case split_part(minute_band, ' ', 1) " + " ".join(
    f"when '{k}' then '{v}'" for k, v in notebook.BAND_LABELS.items()) + " end"
REPORTS["nb_reference_mean"] = (notebook.minute_bands, {}, with_mart("fact_game_events", f"""
    select {_BAND_LABEL_CASE} as band, goals, share_pct,
           cast(sum(goals) over () as double) / count(*) over () as mean_goals
    from ({_BAND_QUERY}) b"""))
REPORTS["nb_argmax"] = (notebook.dearest_year, {}, with_mart("fact_transfers dim_date", f"""{_YEAR_BASE}
    select year, cast(mean_fee as double) as mean_fee_m from base order by mean_fee desc, year limit 1"""))
REPORTS["nb_season_lines"] = (notebook.season_lines, {}, with_mart(_SEASON_TABLES, f"""{_SEASONS}
    select league, season, games, goals, cast(per_game as double) as goals_per_game,
           cast(sum(goals) over (partition by league) as double) / count(*) over (partition by league) as mean_goals
    from seasons"""))
REPORTS["nb_best_per_group"] = (notebook.best_seasons, {}, with_mart(_SEASON_TABLES, f"""{_SEASONS}
    select league, season, games, goals, cast(per_game as double) as goals_per_game from (
        select *, row_number() over (partition by league order by goals desc, season) as rn from seasons) s where rn = 1"""))


def _trend_digits(mart):
    """The trend to the digits both engines agree on."""
    line = notebook.spend_trend(mart)
    return line.select(F.round("slope", 9).alias("slope"), F.round("intercept", 4).alias("intercept"), "n")


REPORTS["nb_trend"] = (_trend_digits, {}, with_mart(_SPEND_TABLES, f"""{_SPEND_RESULTS}
    select round(regr_slope(win_pct, spend_m), 9) as slope, round(regr_intercept(win_pct, spend_m), 4) as intercept,
           count(*) as n from report where spend_m is not null and win_pct is not null"""))
REPORTS["nb_median_thresholds"] = (notebook.spend_thresholds, {}, with_mart(_SPEND_TABLES, f"""{_SPEND_RESULTS}
    select 'spend_m' as measure, median(spend_m) as median from report
    union all select 'win_pct', median(win_pct) from report"""))
REPORTS["nb_kpi_ranking"] = (notebook.league_ranking, {}, with_mart(_SCORECARD_TABLES, f"""{_SCORECARD}
    , kpis as (
        {' union all '.join(
            f"select league, '{k}' as kpi, {k} as value, {k if low else '-' + k} as signed from scorecard"
            for k, low in notebook.LEAGUE_KPIS.items())})
    select league, kpi, value, cast(rank() over (partition by kpi order by signed nulls last) as int) as kpi_rank from kpis"""))
REPORTS["nb_match_labels"] = (notebook.match_labels, {}, with_mart(_SPECTACULAR_TABLES, f"""{_SPECTACULAR}
    select rank, strftime(full_date, '%d/%m/%Y') as date_text,
           split_part(home, ' ', 1) || '  ' || home_goals || ' – ' || away_goals || '  ' || split_part(away, ' ', 1) as match,
           total_goals from spectacular"""))
