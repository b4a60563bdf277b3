"""DuckDB SQL equal in meaning to each registered query.

The fixtures come first as ``WITH`` entries (same text as in Spark); the
rest uses only functions both engines share or their DuckDB spelling.
"""

from __future__ import annotations

from pitchspark.sources.fixtures import FIXTURE_SQL as FIXTURE_TEXT
from pitchspark.sources.fixtures import with_clause

# P1 in DuckDB spelling, applied to a column named market_value.
MONEY_SQL = """case when market_value is null or market_value = '-' then 0.0
  else case when contains(b, 'm') then try_cast(replace(b, 'm', '') as double)
            when contains(b, 'k') then try_cast(replace(b, 'k', '') as double) / 1000.0
            else 0.0 end end"""
STRIP_SQL = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _money_cte(src: str = "fx_roster") -> str:
    return f"""parsed as (
  select *, {MONEY_SQL} as market_value_m
  from (select *, {STRIP_SQL.format(x="replace(market_value, '€', '')")} as b from {src}) t
)"""


SQUAD_VALUE = with_clause("fx_roster") + f""", {_money_cte()},
top as (select country, market_value_m,
          row_number() over (partition by country order by market_value_m desc) as rn from parsed)
select country,
  round(cast(sum(cast(market_value_m as decimal(24,6))) as double), 6) as top_value_sum,
  round(ln(1 + cast(sum(cast(market_value_m as decimal(24,6))) as double)), 6) as log_squad_value
from top where rn <= 15 group by country
"""

ORACLE_SQL: dict[str, str] = {
    "squad_value": SQUAD_VALUE,
}

CHEMISTRY = with_clause("fx_roster") + f""", {_money_cte()},
per_group as (
  select country, club, count(*) as n,
         cast(sum(cast(market_value_m as decimal(24,6))) / count(*) as double) as mean_value
  from parsed where club is not null and club not in ('Unknown', 'Without Club', 'Retired')
  group by country, club having count(*) >= 2),
scored as (
  select country, sum(n * (n - 1) / 2.0 * case when mean_value > 0 then ln(1 + mean_value) else 1.0 end) as s
  from per_group group by country)
select c.country, round(coalesce(s.s, 0.0), 6) as chemistry_score
from (select distinct country from fx_roster) c left join scored s on s.country = c.country
"""

LEAGUE_VALUES = """(values ('england_premier_league', 1.00, true), ('spain_la_liga', 0.97, true),
  ('italy_serie_a', 0.96, true), ('germany_bundesliga', 0.95, true), ('france_ligue_1', 0.93, true),
  ('portugal_primeira_liga', 0.89, false), ('netherlands_eredivisie', 0.87, false), ('brazil_serie_a', 0.86, false),
  ('england_efl_championship', 0.84, false), ('argentina_liga_profesional', 0.83, false),
  ('turkiye_super_lig', 0.82, false), ('saudi_arabia_pro_league', 0.82, false), ('usa_mls', 0.81, false),
  ('spain_la_liga_2', 0.80, false), ('germany_2.bundesliga', 0.79, false), ('italy_serie_b', 0.78, false),
  ('france_ligue_2', 0.77, false)) as w(league_key, league_weight, top5)"""


def _key(x: str) -> str:
    return f"lower({STRIP_SQL.format(x=x)})"


FORM_RATING = with_clause("fx_roster", "fx_league_ratings") + f""",
uni as (
  select {_key('player')} as match_name, k.league_key, w.top5, rating * cast(w.league_weight as double) as weighted_rating
  from (select *, replace(replace(replace(replace(source_file, '.csv', ''), '_25_26', ''), '_2026', ''), '_2025', '') as league_key
        from fx_league_ratings where not contains(source_file, 'tm_')) k
  join {LEAGUE_VALUES} on w.league_key = k.league_key
  where rating is not null),
ros as (select country, {_key('name')} as match_name from fx_roster),
sizes as (select country, count(*) as roster_rows from ros group by country),
merged as (select r.country, r.match_name, u.top5, coalesce(u.weighted_rating, 3.25) as final_rating
           from ros r left join uni u on u.match_name = r.match_name),
form as (select country, avg(final_rating) as f from (
           select country, final_rating, row_number() over (partition by country order by final_rating desc) as rn
           from merged) t where rn <= 15 group by country),
t5 as (select country, count(distinct match_name) as t5 from merged where top5 group by country)
select s.country, round(f.f, 6) as current_form_rating,
  round(case when roster_rows > 0 then coalesce(t5.t5, 0) / roster_rows else 0.0 end, 6) as top5_league_density
from sizes s left join form f on f.country = s.country left join t5 on t5.country = s.country
"""

AVERAGE_RANK = with_clause("fx_entity") + """
select entity_id, f_cnt,
  round(rank() over (order by f_cnt desc) + (count(*) over (partition by f_cnt) - 1) / 2.0, 6) as avg_rank
from fx_entity
"""

PAIR_MATRIX = with_clause("fx_entity") + """
select a.nation, a.country as team_a, b.country as team_b,
  round(cast(a.f_cnt - b.f_cnt as double), 6) as delta_f_cnt,
  round(a.f_value - b.f_value, 6) as delta_f_value,
  round(a.f_max - b.f_max, 6) as delta_f_max
from fx_entity a join fx_entity b on a.nation = b.nation and a.entity_id < b.entity_id
"""

TRAINING_MATRIX = with_clause("fx_matches", "fx_team") + """,
played as (select m.* from fx_matches m join fx_team a on a.team = m.team_a join fx_team b on b.team = m.team_b
           where home_score is not null and away_score is not null and date is not null),
mx as (select max(date) as latest from played)
select m.match_id, m.team_a, m.team_b, m.home_score, m.away_score,
  case when m.home_score > m.away_score then 2 when m.home_score = m.away_score then 1 else 0 end as target,
  round(cast(a.f_cnt - b.f_cnt as double), 6) as delta_f_cnt,
  round(a.f_value - b.f_value, 6) as delta_f_value,
  round(a.f_max - b.f_max, 6) as delta_f_max,
  cast(m.neutral as integer) as is_neutral,
  cast(floor((epoch(mx.latest) - epoch(m.date)) / 86400) as bigint) as days_ago,
  round(exp(-floor((epoch(mx.latest) - epoch(m.date)) / 86400) / 1000.0), 6) as match_weight
from played m join fx_team a on a.team = m.team_a join fx_team b on b.team = m.team_b cross join mx
"""

# Elo as a recursive CTE: one match per step per pool, ratings carried in a
# MAP; the same stateless terms as the Spark side.
_ELO_CORE = with_clause("fx_matches").replace("with ", "with recursive ", 1) + """,
prep as (
  select match_id, pool, date, team_a, team_b,
    case when home_score > away_score then 1.0 when home_score = away_score then 0.5 else 0.0 end as s,
    case when coalesce(neutral, false) or (contains(lower(tournament), 'world cup') and not contains(lower(tournament), 'qualifying'))
         then 0.0 else 100.0 end as h,
    case when contains(lower(tournament), 'world cup') and not contains(lower(tournament), 'qualifying') then 60.0
         when contains(lower(tournament), 'euro') or contains(lower(tournament), 'copa') or contains(lower(tournament), 'cup of nations') then 40.0
         when contains(lower(tournament), 'qualifying') or contains(lower(tournament), 'nations league') then 30.0
         else 20.0 end as k,
    case when abs(home_score - away_score) <= 1 then 1.0 when abs(home_score - away_score) = 2 then 1.5
         else (11.0 + abs(home_score - away_score)) / 8.0 end as g_raw,
    row_number() over (partition by pool order by date, match_id) as step
  from fx_matches where date is not null and home_score is not null and away_score is not null),
fold(pool, step, ratings, match_id, team_a, team_b, ra, rb, x) as (
  select pool, 0, map([]::bigint[], []::double[]), null::bigint, null::bigint, null::bigint, null::double, null::double, null::double
  from (select distinct pool from prep)
  union all
  select pool, step, map_concat(ratings, map([team_a, team_b], [ra + x, rb - x])), match_id, team_a, team_b, ra, rb, x
  from (
    select pool, step, ratings, match_id, team_a, team_b, ra, rb,
      k * (case when (s = 1.0 and e > 0.8) or (s = 0.0 and 1.0 - e > 0.8) then least(g_raw, 1.5) else g_raw end) * (s - e) as x
    from (
      select f.pool, p.step, f.ratings, p.match_id, p.team_a, p.team_b, p.s, p.k, p.g_raw, ra, rb,
        1.0 / (1.0 + pow(10.0, (rb - (ra + p.h)) / 400.0)) as e
      from (select *, coalesce(ratings[team_a_], 1500.0) as ra, coalesce(ratings[team_b_], 1500.0) as rb
            from (select f.pool, f.step, f.ratings, p.team_a as team_a_, p.team_b as team_b_ from fold f
                  join prep p on p.pool = f.pool and p.step = f.step + 1) q) f
      join prep p on p.pool = f.pool and p.step = f.step + 1) t) u
),
hist as (select f.match_id, f.pool, f.team_a, f.team_b, f.ra as elo_a, f.rb as elo_b, f.ra + f.x as post_a, f.rb - f.x as post_b,
           p.date, p.step from fold f join prep p on p.match_id = f.match_id where f.step > 0)
"""

ELO_HISTORY = _ELO_CORE + """
select match_id, pool, team_a, team_b, round(elo_a, 6) as elo_a, round(elo_b, 6) as elo_b,
  round(elo_a - elo_b, 6) as delta_elo from hist
"""

_ELO_FINAL = """,
sides as (select team_a as team, date, step, 0 as side, post_a as r from hist
          union all select team_b, date, step, 1, post_b from hist),
final as (select team, arg_max(r, step * 2 + side) as elo_rating, max(date) as last_date from sides group by team)
"""

ELO_LEADERBOARD = _ELO_CORE + _ELO_FINAL + """
select team, round(elo_rating, 6) as elo_rating from final where last_date >= timestamp '1998-01-01'
"""

ELO_TOP15 = _ELO_CORE + _ELO_FINAL + """
select team, round(elo_rating, 6) as elo_rating from final where last_date >= timestamp '1998-01-01'
order by elo_rating desc, team limit 15
"""

_POINTS = with_clause("fx_matches") + """,
res as (select pool, team_a, team_b,
          case when home_score > away_score then 2 when home_score = away_score then 1 else 0 end as o, date from fx_matches
          where home_score is not null and away_score is not null),
sides as (
  select pool, team_a as team, case o when 2 then 3 when 1 then 1 else 0 end as pts,
    cast(o = 2 as integer) as w, cast(o = 1 as integer) as d, cast(o = 0 as integer) as l from res
  union all
  select pool, team_b, case o when 0 then 3 when 1 then 1 else 0 end,
    cast(o = 0 as integer), cast(o = 1 as integer), cast(o = 2 as integer) from res),
tbl as (select pool, team, count(*) as played, cast(sum(w) as bigint) as wins, cast(sum(d) as bigint) as draws,
          cast(sum(l) as bigint) as losses, cast(sum(pts) as bigint) as points
        from sides group by pool, team),
ranked as (select *, cast(row_number() over (partition by pool order by points desc, team) as integer) as position from tbl)
"""

STANDINGS = _POINTS + """
select pool, team, played, wins, draws, losses, points, position from ranked
"""

WILD_CARDS = _POINTS + """
select pool, team, points, wildcard_rank from (
  select pool, team, points, cast(row_number() over (order by points desc, team) as integer) as wildcard_rank
  from ranked where position = 3) t where wildcard_rank <= 8
"""

U_SQL = "(('0x' || substr(md5({s}), 1, 8))::bigint / 4294967296.0)"

STANDINGS_BY_RATING = _ELO_CORE + _ELO_FINAL + """,
pts as (select pool, team, cast(sum(p) as bigint) as points from (
          select pool, team_a as team, case when home_score > away_score then 3 when home_score = away_score then 1 else 0 end as p from fx_matches
          where home_score is not null and away_score is not null
          union all
          select pool, team_b, case when home_score < away_score then 3 when home_score = away_score then 1 else 0 end from fx_matches
          where home_score is not null and away_score is not null) x group by pool, team)
select pool, team, points, elo_rating,
  cast(row_number() over (partition by pool order by points desc, elo_rating desc, team) as integer) as position
from (select pts.*, round(final.elo_rating, 6) as elo_rating from pts join final using (team)) t
"""

POSITION_COUNTS = with_clause("fx_matches") + """,
res as (select year(date) as y, pool, team_a, team_b,
          case when home_score > away_score then 2 when home_score = away_score then 1 else 0 end as o from fx_matches
        where home_score is not null and away_score is not null and date is not null),
tbl as (select y, pool, team, sum(pts) as points from (
          select y, pool, team_a as team, case o when 2 then 3 when 1 then 1 else 0 end as pts from res
          union all select y, pool, team_b, case o when 0 then 3 when 1 then 1 else 0 end from res) s group by y, pool, team),
ranked as (select *, row_number() over (partition by y, pool order by points desc, team) as position from tbl)
select pool, team, count(*) as tables, count_if(position = 1)::bigint as times_1, count_if(position = 2)::bigint as times_2,
  count_if(position = 3)::bigint as times_3 from ranked group by pool, team
"""

ADVANCEMENT = POSITION_COUNTS[:POSITION_COUNTS.index("select pool, team, count(*)")].rstrip() + """,
wild as (select y, pool, team, row_number() over (partition by y order by points desc, team) as w from ranked where position = 3)
select r.pool, r.team, count(*) as tables, count_if(position = 1)::bigint as times_1, count_if(position = 2)::bigint as times_2,
  count_if(position = 3)::bigint as times_3, count_if(position = 4)::bigint as times_4, count_if(position <= 2 or coalesce(w <= 8, false))::bigint as advances
from ranked r left join wild on wild.y = r.y and wild.pool = r.pool and wild.team = r.team group by r.pool, r.team
"""

STAGE_RATES = with_clause("fx_stage_log") + """
select entity, stage, count(distinct run_id) as runs,
  round(count(distinct run_id) / (select count(distinct run_id) from fx_stage_log) * 100.0, 6) as pct
from fx_stage_log group by entity, stage
"""

ACCURACY = with_clause("fx_predictions") + """
select round(avg(cast(label = prediction as double)), 6) as accuracy, count(*) as rows from fx_predictions
"""

CLASS_REPORT = with_clause("fx_predictions") + """,
cls as (select * from (values (0), (1), (2)) v(c)),
per as (
  select c, sum(case when label = c and prediction = c then 1 else 0 end) as tp,
    sum(case when prediction = c then 1 else 0 end) as pred_n,
    sum(case when label = c then 1 else 0 end) as support
  from cls, fx_predictions group by c),
m as (
  select c, support,
    case when pred_n > 0 then tp / pred_n else 0.0 end as precision,
    case when support > 0 then tp / support else 0.0 end as recall from per),
f as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0.0 end as f1 from m)
select cast(c as varchar) as class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1,
  cast(support as bigint) as support from f
union all
select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), cast(sum(support) as bigint) from f
union all
select 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), cast(sum(support) as bigint) from f
"""

CONFUSION_MATRIX = with_clause("fx_predictions") + """
select l.label, cast(count_if(p.prediction = 0) as bigint) as pred_0, cast(count_if(p.prediction = 1) as bigint) as pred_1,
  cast(count_if(p.prediction = 2) as bigint) as pred_2,
  cast(count_if(p.label is not null and (p.prediction is null or p.prediction not in (0, 1, 2))) as bigint) as pred_other
from (values (0), (1), (2)) l(label) left join fx_predictions p on p.label = l.label
group by l.label
"""

STRATIFIED_SPLIT = with_clause("fx_predictions") + f""",
o as (select row_id, label,
        row_number() over (partition by label order by {U_SQL.format(s="concat_ws('|', '42', cast(row_id as varchar))")}, row_id) as pos,
        count(*) over (partition by label) as nc from fx_predictions)
select row_id, label, pos <= cast(round(nc * 0.2) as bigint) as is_test,
  case when pos <= cast(round(nc * 0.2) as bigint) then null
       else cast((pos - cast(round(nc * 0.2) as bigint) - 1) % 5 as integer) end as fold
from o
"""

RUN_LEADERBOARD = with_clause("fx_runs") + """
select run_name, round(case when accuracy is null then -1.0 else accuracy end, 6) as score,
  case when accuracy is null then 'N/A' else format('{:,.2f}', accuracy * 100) end as accuracy_pct,
  case when accuracy is null then substr(coalesce(error, ''), 1, 60) else 'ok' end as status,
  cast(row_number() over (order by case when accuracy is null then -1.0 else accuracy end desc, run_name) as integer) as position
from fx_runs
"""

PAIR_LOOKUP = with_clause("fx_entity") + """,
pairs as (select a.country as team_a, b.country as team_b, a.f_cnt - b.f_cnt as d1, a.f_value - b.f_value as d2,
            a.f_max - b.f_max as d3 from fx_entity a join fx_entity b on a.entity_id < b.entity_id),
req as (select case when x.entity_id % 2 = 1 then upper(y.country) else x.country end as req_a,
               case when x.entity_id % 2 = 1 then x.country else y.country end as req_b
        from fx_entity x join fx_entity y on y.entity_id = x.entity_id + 1)
select r.req_a, r.req_b, lower(r.req_a) <> lower(p.team_a) as reversed,
  round(cast(case when lower(r.req_a) <> lower(p.team_a) then -p.d1 else p.d1 end as double), 6) + 0.0 as delta_f_cnt,
  round(case when lower(r.req_a) <> lower(p.team_a) then -p.d2 else p.d2 end, 6) + 0.0 as delta_f_value,
  round(case when lower(r.req_a) <> lower(p.team_a) then -p.d3 else p.d3 end, 6) + 0.0 as delta_f_max
from req r join pairs p
  on least(lower(r.req_a), lower(r.req_b)) = least(lower(p.team_a), lower(p.team_b))
 and greatest(lower(r.req_a), lower(r.req_b)) = greatest(lower(p.team_a), lower(p.team_b))
"""

PROBS_LABEL = with_clause("fx_probs") + """
select pair_id, cast(case when p0 >= p1 and p0 >= p2 then 0 when p1 >= p2 then 1 else 2 end as integer) as label_idx,
  case when p0 >= p1 and p0 >= p2 then 'Away Win' when p1 >= p2 then 'Draw' else 'Home Win' end as label_name,
  round(p2 / (p2 + p0), 6) as p_two_way
from fx_probs
"""

ORACLE_SQL.update({
    "chemistry": CHEMISTRY,
    "form_rating": FORM_RATING,
    "average_rank": AVERAGE_RANK,
    "pair_matrix": PAIR_MATRIX,
    "training_matrix": TRAINING_MATRIX,
    "elo_history": ELO_HISTORY,
    "elo_leaderboard": ELO_LEADERBOARD,
    "elo_top15": ELO_TOP15,
    "standings": STANDINGS,
    "wild_cards": WILD_CARDS,
    "standings_by_rating": STANDINGS_BY_RATING,
    "position_counts": POSITION_COUNTS,
    "advancement": ADVANCEMENT,
    "elo_history_sliced": ELO_HISTORY,
    "stage_rates": STAGE_RATES,
    "accuracy": ACCURACY,
    "class_report": CLASS_REPORT,
    "confusion_matrix": CONFUSION_MATRIX,
    "stratified_split": STRATIFIED_SPLIT,
    "run_leaderboard": RUN_LEADERBOARD,
    "pair_lookup": PAIR_LOOKUP,
    "probs_label": PROBS_LABEL,
})

TOKEN_SORT_SQL = ("array_to_string(list_sort(list_filter(string_split_regex(trim(lower(regexp_replace("
                  "regexp_replace({x}, '[\\x{{80}}-\\x{{FF}}]', '', 'g'), '[^\\p{{L}}\\p{{N}}]', ' ', 'g'))), '\\s+'), "
                  "lambda t: t <> '')), ' ')")
_MASK = ("cast(list_sum(list_transform(range(length(p)), lambda j: case when substr(p, j + 1, 1) = c "
         "then (1::bigint << j) else 0::bigint end)) as bigint)")
LCS_SQL = ("(length(p) - bit_count(list_reduce(string_split(t, ''), lambda v, c: ((v + (v & " + _MASK + ")) | (v & ~"
           + _MASK + ")) & ((1::bigint << length(p)) - 1), (1::bigint << length(p)) - 1)))")

# Brute force over distinct normalised names with the length filter only:
# fine at the oracle's scale, and independent of the Spark blocking.
def fuzzy_ctes(q_sql: str, minutes: str = "fx_appearances", x: str = "") -> str:
    """CTEs ``app, q, ln, rn, ..., res`` (names ending in ``x``); ``q_sql`` selects rows with ``match_name``.

    Brute force over distinct normalised names with the length filter only:
    fine at the oracle's scale, and independent of the Spark blocking.
    """
    return f"""
app{x} as (select {_key('player')} as match_name,
          sum(coalesce(try_cast(cast(minutes as varchar) as double), 0.0)) as minutes
        from {minutes} group by 1),
q{x} as ({q_sql}),
ln{x} as (select distinct match_name as lkey, {TOKEN_SORT_SQL.format(x='match_name')} as lp from q{x}),
rn{x} as (select match_name as rkey, minutes as rvalue, {TOKEN_SORT_SQL.format(x='match_name')} as rp from app{x}),
lpd{x} as (select distinct lp from ln{x} where length(lp) > 0),
rpd{x} as (select distinct rp from rn{x} where length(rp) > 0),
pairs{x} as (select lp, rp, case when length(lp) <= length(rp) then lp else rp end as p,
            case when length(lp) <= length(rp) then rp else lp end as t, length(lp) + length(rp) as tot
          from lpd{x}, rpd{x}
          where least(length(lp), length(rp)) >= (169 * (length(lp) + length(rp))) // 400 + 1),
sc{x} as (select lp, rp, tot, {LCS_SQL} as lcs from pairs{x}),
sc2{x} as (select lp, rp, (200 * lcs) // tot as q, (200 * lcs) % tot as r, tot from sc{x}),
scored{x} as (select lp, rp, cast(q + case when 2 * r > tot or (2 * r = tot and q % 2 = 1) then 1 else 0 end as integer) as score
           from sc2{x}),
best{x} as (select lp, rkey as best_key, score, rvalue as value from (
           select s.lp, r.rkey, s.score, r.rvalue,
             row_number() over (partition by s.lp order by s.score desc, r.rkey) as rn_
           from scored{x} s join rn{x} r on r.rp = s.rp where s.score >= 85) x where rn_ = 1),
res{x} as (select ln.lkey as match_name, b.best_key, coalesce(b.score, 0) as score, coalesce(b.value, 0.0) as value
        from ln{x} ln left join best{x} b on b.lp = ln.lp)
"""


_FUZZY = with_clause("fx_fuzzy_queries", "fx_appearances") + ", " + fuzzy_ctes(
    f"select *, {_key('name')} as match_name from fx_fuzzy_queries")

FUZZY_LOOKUP = _FUZZY + """
select q.query_id, r.best_key, r.score, round(r.value, 6) as minutes
from q left join res r on r.match_name = q.match_name
"""

def _experience(q: str, minutes: str, out: str) -> str:
    return with_clause(q, minutes) + ", " + fuzzy_ctes(f"select *, {_key('name')} as match_name from {q}", minutes) + f""",
mins as (select q.country, r.value as minutes from q left join res r on r.match_name = q.match_name)
select country, round(avg(minutes), 6) as {out} from (
  select country, minutes, row_number() over (partition by country order by minutes desc) as rn from mins) t
where rn <= 15 group by country
"""


EXPERIENCE = _experience("fx_fuzzy_queries", "fx_appearances", "experience_minutes")
TOURNAMENT_EXPERIENCE = _experience("fx_roster", "fx_tournaments", "tournament_minutes")

ORACLE_SQL.update({"fuzzy_lookup": FUZZY_LOOKUP, "experience": EXPERIENCE, "tournament_experience": TOURNAMENT_EXPERIENCE})

TITLE_SQL = ("array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|\\P{{L}}+)', 1), "
             "lambda t: upper(t[1]) || lower(t[2:])), '')")

# National Elo: the same fold as above over one pool of country names.
_COUNTRY_ELO = (_ELO_CORE.split("prep as (", 1)[1]
                .replace("from fx_matches where", "from (select match_id, 0 as pool, date, home_score, away_score, tournament, neutral, "
                         + ", ".join(f"{TITLE_SQL.format(x=f'trim({t})')} as {t}" for t in ("team_a", "team_b")) + " from fx_country_matches) where")
                .replace("map([]::bigint[], []::double[]), null::bigint, null::bigint, null::bigint", "map([]::varchar[], []::double[]), null::bigint, null::varchar, null::varchar"))

_MASTER = with_clause("fx_roster", "fx_league_ratings", "fx_appearances", "fx_tournaments", "fx_rankings", "fx_country_matches").replace("with ", "with recursive ", 1) + f""", {_money_cte()},
prep as (""" + _COUNTRY_ELO + _ELO_FINAL + """,
""" + fuzzy_ctes(f"select *, {_key('name')} as match_name from fx_roster") + """,
""" + fuzzy_ctes(f"select *, {_key('name')} as match_name from fx_roster", "fx_tournaments", "_t") + f""",
base as (select country, cast(sum(cast(market_value_m as decimal(24,6))) as double) as total_market_value
         from parsed group by country),
med as (select country, median(market_value_m) as median_top11_value from (
          select country, market_value_m, row_number() over (partition by country order by market_value_m desc) as rn
          from parsed) t where rn <= 11 group by country),
sq as (select country, ln(1 + cast(sum(cast(market_value_m as decimal(24,6))) as double)) as log_squad_value from (
          select country, market_value_m, row_number() over (partition by country order by market_value_m desc) as rn
          from parsed) t where rn <= 15 group by country),
per_group as (
  select country, club, count(*) as n,
         cast(sum(cast(market_value_m as decimal(24,6))) / count(*) as double) as mean_value
  from parsed where club is not null and club not in ('Unknown', 'Without Club', 'Retired')
  group by country, club having count(*) >= 2),
chem as (
  select c.country, coalesce(s.s, 0.0) as chemistry_score
  from (select distinct country from fx_roster) c left join (
    select country, sum(n * (n - 1) / 2.0 * case when mean_value > 0 then ln(1 + mean_value) else 1.0 end) as s
    from per_group group by country) s on s.country = c.country),
uni as (
  select {_key('player')} as match_name, k.league_key, w.top5, rating * cast(w.league_weight as double) as weighted_rating
  from (select *, replace(replace(replace(replace(source_file, '.csv', ''), '_25_26', ''), '_2026', ''), '_2025', '') as league_key
        from fx_league_ratings where not contains(source_file, 'tm_')) k
  join {LEAGUE_VALUES} on w.league_key = k.league_key
  where rating is not null),
ros as (select country, {_key('name')} as match_name from fx_roster),
sizes as (select country, count(*) as roster_rows from ros group by country),
merged as (select r.country, r.match_name, u.top5, coalesce(u.weighted_rating, 3.25) as final_rating
           from ros r left join uni u on u.match_name = r.match_name),
form as (select country, avg(final_rating) as current_form_rating from (
           select country, final_rating, row_number() over (partition by country order by final_rating desc) as rn
           from merged) t where rn <= 15 group by country),
t5 as (select country, count(distinct match_name) as t5 from merged where top5 group by country),
dens as (select s.country, case when roster_rows > 0 then coalesce(t5.t5, 0) / roster_rows else 0.0 end as top5_league_density
         from sizes s left join t5 on t5.country = s.country),
ucl as (select country, avg(minutes) as ucl_minutes from (
          select q.country, r.value as minutes, row_number() over (partition by q.country order by r.value desc) as rn
          from q left join res r on r.match_name = q.match_name) t where rn <= 15 group by country),
trn as (select country, avg(minutes) as tournament_minutes from (
          select q_t.country, r.value as minutes, row_number() over (partition by q_t.country order by r.value desc) as rn
          from q_t left join res_t r on r.match_name = q_t.match_name) t where rn <= 15 group by country),
m as (
  select {TITLE_SQL.format(x='base.country')} as country, base.total_market_value, med.median_top11_value,
    chem.chemistry_score, form.current_form_rating, coalesce(dens.top5_league_density, 0.0) as top5_league_density,
    ucl.ucl_minutes, trn.tournament_minutes, sq.log_squad_value, coalesce(rk.fifa_rank, 100.0)::double as fifa_rank,
    coalesce(rk.fifa_points, 1000.0)::double as fifa_points, final.elo_rating,
    rank() over (order by total_market_value desc) + (count(*) over (partition by total_market_value) - 1) / 2.0 as tm_value_rank
  from base left join med using (country) left join chem using (country) left join form using (country)
    left join dens using (country) left join ucl using (country) left join trn using (country) left join sq using (country)
    left join fx_rankings rk on lower(trim(rk.country)) = lower(trim(base.country))
    left join final on lower(final.team) = lower(trim(base.country)))
"""

MASTER = _MASTER + """
select country, round(total_market_value, 6) as total_market_value, round(median_top11_value, 6) as median_top11_value,
  round(chemistry_score, 6) as chemistry_score, round(current_form_rating, 6) as current_form_rating,
  round(top5_league_density, 6) as top5_league_density, round(ucl_minutes, 6) as ucl_minutes,
  round(tournament_minutes, 6) as tournament_minutes, round(elo_rating, 6) as elo_rating,
  round(log_squad_value, 6) as log_squad_value, round(fifa_rank, 6) as fifa_rank, round(fifa_points, 6) as fifa_points,
  round(tm_value_rank, 6) as tm_value_rank
from m
"""

_PAIR_FEATURES = ["total_market_value", "median_top11_value", "chemistry_score", "current_form_rating", "ucl_minutes", "tournament_minutes",
                  "tm_value_rank", "fifa_rank", "fifa_points", "top5_league_density"]

MASTER_PAIRS = _MASTER + "select a.country as team_a, b.country as team_b, " + ", ".join(
    f"round(a.{f} - b.{f}, 6) as delta_{f}" for f in [*_PAIR_FEATURES, "elo_rating"]) + " from m a join m b on a.country < b.country"

MASTER_TRAINING = _MASTER + """,
played as (select h.match_id, h.team_a, h.team_b, h.elo_a - h.elo_b as delta_elo, f.home_score, f.away_score, f.date, f.neutral
           from hist h join fx_country_matches f on f.match_id = h.match_id join m a on a.country = h.team_a join m b on b.country = h.team_b),
mx as (select max(date) as latest from played)
select p.match_id, p.team_a, p.team_b, case when home_score > away_score then 2 when home_score = away_score then 1 else 0 end as target,
  """ + ", ".join(f"round(a.{f} - b.{f}, 6) as delta_{f}" for f in _PAIR_FEATURES) + """,
  round(delta_elo, 6) as delta_elo, cast(neutral as integer) as is_neutral,
  cast(floor((epoch(mx.latest) - epoch(p.date)) / 86400) as bigint) as days_ago,
  round(exp(-floor((epoch(mx.latest) - epoch(p.date)) / 86400) / 1000.0), 6) as match_weight
from played p join m a on a.country = p.team_a join m b on b.country = p.team_b cross join mx
"""

TRAINING_WITH_ELO = _ELO_CORE + """,
fx_team as (""" + FIXTURE_TEXT["fx_team"] + """),
played as (select m.* from fx_matches m join fx_team a on a.team = m.team_a join fx_team b on b.team = m.team_b
           where home_score is not null and away_score is not null and date is not null),
mx as (select max(date) as latest from played)
select m.match_id,
  case when m.home_score > m.away_score then 2 when m.home_score = m.away_score then 1 else 0 end as target,
  round(cast(a.f_cnt - b.f_cnt as double), 6) as delta_f_cnt,
  round(a.f_value - b.f_value, 6) as delta_f_value,
  round(a.f_max - b.f_max, 6) as delta_f_max,
  cast(m.neutral as integer) as is_neutral,
  round(exp(-floor((epoch(mx.latest) - epoch(m.date)) / 86400) / 1000.0), 6) as match_weight,
  round(h.elo_a, 6) as elo_a, round(h.elo_b, 6) as elo_b, round(h.elo_a - h.elo_b, 6) as delta_elo
from played m join fx_team a on a.team = m.team_a join fx_team b on b.team = m.team_b cross join mx
join hist h on h.match_id = m.match_id
"""

_GROUP_PROBS = with_clause("fx_team_groups", "fx_probs") + """,
pairs as (select a.grp, a.team as team_a, b.team as team_b, b.team_key as key_b,
            a.is_host as ha, b.is_host as hb
          from fx_team_groups a join fx_team_groups b on a.grp = b.grp and a.slot < b.slot),
o as (select *, (hb and not ha) as reversed, case when ha <> hb then 0 else 1 end as is_neutral from pairs),
pp as (select o.grp, o.team_a, o.team_b, o.reversed, o.is_neutral,
         case when o.reversed then p.p2 else p.p0 end as p0, p.p1,
         case when o.reversed then p.p0 else p.p2 end as p2
       from o join fx_probs p on p.pair_id = o.key_b)
"""

GROUP_PROBABILITIES = _GROUP_PROBS + """
select grp, team_a, team_b, reversed, is_neutral, round(p0, 6) as p0, round(p1, 6) as p1, round(p2, 6) as p2 from pp
"""

ORACLE_SQL.update({
    "master": MASTER,
    "master_pairs": MASTER_PAIRS,
    "master_training": MASTER_TRAINING,
    "training_with_elo": TRAINING_WITH_ELO,
    "group_probabilities": GROUP_PROBABILITIES,
})

UNMATCHED_TEAMS = with_clause("fx_matches", "fx_team_partial") + """
select distinct t.team from (select team_a as team from fx_matches union all select team_b from fx_matches) t
where not exists (select 1 from fx_team_partial f where f.team = t.team)
"""

ORACLE_SQL["unmatched_teams"] = UNMATCHED_TEAMS

_SPLIT = with_clause("fx_matches", "fx_team") + f""",
rows as (select m.match_id, case when home_score > away_score then 2 when home_score = away_score then 1 else 0 end as target, date
         from fx_matches m join fx_team a on a.team = m.team_a join fx_team b on b.team = m.team_b
         where home_score is not null and away_score is not null and date is not null),
mx as (select max(date) as latest from rows),
placed as (select match_id, target, exp(-floor((epoch(mx.latest) - epoch(date)) / 86400) / 1000.0) as w,
             row_number() over (partition by target order by {U_SQL.format(s="concat_ws('|', '42', cast(match_id as varchar))")}, match_id) as pos,
             count(*) over (partition by target) as nc from rows, mx),
split as (select match_id, target, w, pos <= cast(round(nc * 0.2) as bigint) as is_test, (pos - cast(round(nc * 0.2) as bigint) - 1) % 5 as fold from placed)
"""

_AS_GOOD = """
union all select 'as_good_as_majority', 1.0 union all select 'loss_below_prior', 1.0"""
_CHECKS = """select 'support_' || c as metric, (select count(*) from split where is_test and target = c)::double as value from range(0, 3) r(c)
union all select 'probability_off', 0.0 union all select 'outside_classes', 0.0
union all select 'train_rows', count(*)::double from split where not is_test
union all select 'train_weight', round(sum(case when target = 1 then w * 1.35 else w end), 6) from split where not is_test
"""

FILE_ROUND_TRIP = with_clause("fx_roster", "fx_league_ratings") + """,
l as (select *, ((row_id % 4) + 4) % 4 as layout, ((row_id % 10) + 10) % 10 = 0 as spoilt from fx_league_ratings)
select 'squad ' || replace(upper(country[1]) || lower(country[2:]), '_', ' ') as item, count(*) as n, round(sum(player_id)::double, 6) as total from fx_roster group by country
union all select 'good ratings', count(*), round(sum(rating::decimal(24,6))::double, 6) from l where layout < 3 and not spoilt
union all select 'quarantined', count(*), 0.0 from l where layout < 3 and spoilt
union all select 'skipped layouts', 1, 0.0
union all select 'plain table', count(*), round(sum(row_id)::double, 6) from l where layout = 3
"""

ORACLE_SQL.update({
    "train_evaluate": _SPLIT + _CHECKS + _AS_GOOD,
    "grid_search": _SPLIT + _CHECKS + """ union all select 'as_good_as_majority', 1.0 union all select 'points', 8.0 union all select 'chosen_is_best', 1.0 union all select 'accuracies_in_range', 1.0
union all select 'fold_' || fold, count(*)::double from split where not is_test group by fold""",
    "batch_scores": _SPLIT + "select match_id, target, true as label_is_largest, true as reloaded_equal from split",
    "importance": """select row_number() over (order by f)::int as position, true as falling, true as sums_to_one, f as one_of_the_features
from (select unnest(['delta_f_cnt', 'delta_f_value', 'delta_f_max', 'delta_elo', 'is_neutral']) as f)""",
    "inspect_run": _SPLIT + """select 'support_' || c as metric, (select count(*) from split where is_test and target = c)::double as value from range(0, 3) r(c)
union all select 'accuracy_as_stored', 1.0 union all select 'test_rows', count(*)::double from split where is_test
union all select 'confusion_rows', count(*)::double from split where is_test union all select 'training_rows', count(*)::double from split""",
    "file_round_trip": FILE_ROUND_TRIP,
})

ORACLE_SQL.update({
    "league_files": with_clause("fx_league_ratings") + f""",
uni as (
  select {_key('player')} as match_name, k.league_key, w.top5, rating * cast(w.league_weight as double) as weighted_rating
  from (select *, replace(replace(replace(replace(source_file, '.csv', ''), '_25_26', ''), '_2026', ''), '_2025', '') as league_key
        from fx_league_ratings where not contains(source_file, 'tm_')) k
  join {LEAGUE_VALUES} on w.league_key = k.league_key
  where rating is not null)
select league_key, top5, count(*) as n, count(distinct match_name) as players, round(sum(weighted_rating::decimal(24,6))::double, 3) as total
from uni group by league_key, top5""",
    "match_flow": with_clause("fx_matches", "fx_team_partial") + """,
t as (select distinct team from fx_team_partial),
r as (select *, case when home_score is null or away_score is null then 'no score' when date is null then 'no date' else 'kept' end as outcome from fx_matches),
s as (select case when team_a is null or team_a not in (select team from t where team is not null) then 'team_a without features'
                  when team_b is null or team_b not in (select team from t where team is not null) then 'team_b without features' else 'kept' end as outcome
      from r where outcome = 'kept')
select 'results' as stage, o.outcome, (select count(*) from r where o.outcome in ('read', r.outcome)) as rows
from (select unnest(['read', 'no score', 'no date', 'kept']) as outcome) o
union all select 'sides', o.outcome, (select count(*) from s where o.outcome in ('read', s.outcome))
from (select unnest(['read', 'team_a without features', 'team_b without features', 'kept']) as outcome) o""",
})
