"""Stand-in domain tables derived from the driver's Parquet tables.

One SQL text per fixture serves both Spark (``spark.sql``) and DuckDB (as a
``WITH`` entry), so the two engines see identical rows. The texts are the
ones in FIXTURES.md; only functions both engines share are used.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# A person's name: two words from a hash of the key, so names are as varied as people's and grow with the table.
PERSON = "concat(substr(md5(cast({k} as varchar(20))), 1, 6), ' ', substr(md5(cast({k} as varchar(20))), 9, 7))"

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")

FIXTURE_SQL: dict[str, str] = {
    "fx_roster": f"""
select n.n_name as country, c.c_custkey as player_id,
 concat('  ', upper(substr(c.person, 1, 3)), substr(c.person, 4), ' ') as name,
 case when c.c_custkey % 23 = 0 then 'Unknown' when c.c_custkey % 29 = 0 then 'Without Club'
      when c.c_custkey % 31 = 0 then 'Retired' when c.c_custkey % 37 = 0 then null
      else concat('Club#', cast(c.c_custkey % 41 as varchar(20))) end as club,
 case when c.c_custkey % 13 = 0 then '-' when c.c_custkey % 17 = 0 then null
      when c.c_custkey % 5 = 0 then concat('€', cast(cast(floor(abs(c.c_acctbal)) as bigint) as varchar(20)), 'k')
      when c.c_custkey % 19 = 0 then concat('€', cast(cast(floor(abs(c.c_acctbal)) as bigint) as varchar(20)))
      else concat('€', cast(cast(floor(abs(c.c_acctbal) / 100) as bigint) as varchar(20)), '.5m') end as market_value
from (select *, {PERSON.format(k='c_custkey')} as person from customer) c join nation n on n.n_nationkey = c.c_nationkey
""",
    "fx_league_ratings": f"""
select concat(case when o.o_orderkey % 6 = 0 then 'england_premier_league_25_26' when o.o_orderkey % 6 = 3 then 'brazil_serie_a_2026'
   when o.o_orderkey % 3 = 1 then 'spain_la_liga_25_26' else 'usa_mls_2025' end, '.csv') as source_file, o.o_orderkey as row_id,
 {PERSON.format(k='o.o_custkey')} as player,
 case when o.o_orderkey % 41 = 0 then null else cast(5.0 + (o.o_orderkey % 50) / 10.0 as double) end as rating
from orders o
union all
select concat(case s_suppkey % 2 when 0 then 'tm_england_premier_league' else 'unlisted_league' end, '.csv'),
 -1 - s_suppkey, s_name, cast(9.0 as double) from supplier
""",
    # Fifteen customers stand behind each supplier; the name of one of them, edited, with minutes as scraped text.
    "fx_appearances": f"""
select s_suppkey as row_id, concat(' ', upper(case s_suppkey % 5 when 0 then person
   when 1 then concat(substr(person, 8), ' ', substr(person, 1, 6)) when 2 then concat(substr(person, 1, 2), substr(person, 4))
   when 3 then concat(person, '-x') else concat('nobody ', person, ' ', reverse(person)) end)) as player,
 case when s_suppkey % 11 = 0 then 'n/a' when s_suppkey % 17 = 0 then null
      else cast((1 + s_suppkey % 50) * 9 as varchar(20)) end as minutes
from (select s_suppkey, {PERSON.format(k='(s_suppkey * 15)')} as person from supplier) t
""",
    "fx_tournaments": f"""
select s_suppkey as row_id, case s_suppkey % 3 when 0 then person
   when 1 then concat(substr(person, 1, 9), 'z', substr(person, 10)) else concat(substr(person, 8), '  ', substr(person, 1, 6)) end as player,
 case when s_suppkey % 13 = 0 then '-' else cast((1 + s_suppkey % 30) * 30 as varchar(20)) end as minutes
from (select s_suppkey, {PERSON.format(k='(s_suppkey * 15 - 4)')} as person from supplier) t
""",
    "fx_fuzzy_queries": f"""
select c_custkey as query_id, n_name as country, case c_custkey % 5
  when 0 then person
  when 1 then concat(substr(person, 8), ' ', substr(person, 1, 6))
  when 2 then concat(substr(person, 1, 2), substr(person, 4))
  when 3 then concat(person, '-xyzw')
  else concat('zq', cast(c_custkey as varchar(20))) end as name
from (select c_custkey, c_nationkey, {PERSON.format(k='c_custkey')} as person from customer) t
join nation on n_nationkey = c_nationkey
""",
    "fx_rankings": """
select concat(' ', lower(n_name)) as country, cast(1 + (n_nationkey * 7) % 25 as double) as fifa_rank,
 1200 + n_nationkey * 17.5 as fifa_points from nation where n_nationkey % 4 <> 0
""",
    # National teams: every customer stands for one match between two nations.
    "fx_country_matches": """
select c_custkey as match_id, cast(timestamp '1990-01-01 00:00:00' + (c_custkey % 3000) * interval '1' day as timestamp) as date,
 case when c_custkey % 2 = 0 then concat(' ', lower(a.n_name)) else a.n_name end as team_a, concat(b.n_name, ' ') as team_b,
 case when c_custkey % 53 = 0 then null else c_custkey % 5 end as home_score, cast(floor(abs(c_acctbal)) as bigint) % 4 as away_score,
 case when c_custkey % 3 = 0 then 'World Cup' when c_custkey % 3 = 1 then 'Euro Qualifying' else 'Friendly' end as tournament,
 c_custkey % 7 = 0 as neutral
from customer join nation a on a.n_nationkey = c_nationkey
join nation b on b.n_nationkey = (c_nationkey + 1 + c_custkey % 24) % 25
""",
    "fx_matches": """
select o.o_orderkey as match_id, a.c_nationkey as pool, case when o.o_orderkey % 89 = 0 then null else o.o_orderdate end as date, a.c_custkey as team_a, b.c_custkey as team_b,
 case when o.o_orderkey % 97 = 0 then null else o.o_orderkey % 6 end as home_score, cast(floor(o.o_totalprice) as bigint) % 4 as away_score,
 case o.o_orderpriority when '1-URGENT' then 'World Cup' when '2-HIGH' then 'World Cup Qualifying'
   when '3-MEDIUM' then 'Copa America' when '4-NOT SPECIFIED' then 'Nations League' else 'Friendly' end as tournament,
 o.o_orderstatus = 'P' as neutral
from orders o
join (select c_nationkey, c_custkey, row_number() over (partition by c_nationkey order by c_custkey) - 1 as i,
        count(*) over (partition by c_nationkey) as n from customer) a on a.c_custkey = o.o_custkey
join (select c_nationkey, c_custkey, row_number() over (partition by c_nationkey order by c_custkey) - 1 as i
        from customer) b
  on b.c_nationkey = a.c_nationkey and b.i = (a.i + 1 + o.o_orderkey % (a.n - 1)) % a.n
""",
    "fx_team": """
select o_custkey as team, count(*) as f_cnt, cast(sum(cast(o_totalprice as decimal(18,4))) as double) as f_value,
 max(o_totalprice) as f_max from orders group by o_custkey
""",
    # Only for the report of teams without a feature row.
    "fx_team_partial": """
select distinct o_custkey as team from orders where o_custkey % 50 <> 0
""",
    "fx_entity": """
select s_suppkey as entity_id, s_name as country, s_nationkey as nation, count(*) as f_cnt,
 cast(sum(cast(l_extendedprice as decimal(18,4))) as double) as f_value, max(l_quantity) as f_max
from supplier join lineitem on l_suppkey = s_suppkey group by s_suppkey, s_name, s_nationkey
""",
    # Groups of four teams cut from the whole customer table, so the number
    # of groups (and of pairs) grows with the data.
    "fx_team_groups": """
select cast(floor(c_custkey / 4) as bigint) as grp, concat('T', cast(c_custkey as varchar(20))) as team,
 c_custkey as team_key, cast(c_custkey % 4 as integer) as slot, c_acctbal as rating, c_custkey % 9 = 0 as is_host
from customer
""",
    "fx_probs": """
select pair_id, w0 / (w0 + w1 + w2) as p0, w1 / (w0 + w1 + w2) as p1, w2 / (w0 + w1 + w2) as p2
from (select c_custkey as pair_id, cast(1 + c_custkey % 5 as double) as w0, cast(1 + c_custkey % 3 as double) as w1,
        cast(1 + c_custkey % 7 as double) as w2 from customer) t
""",
    "fx_predictions": """
select event_id as row_id, event_id % 3 as label,
 case when event_id % 7 < 4 then event_id % 3 else event_id % 2 end as prediction from events
""",
    "fx_stage_log": """
select user_id as run_id, concat('e', cast(event_id % 7 as varchar(20))) as entity, event_type as stage from events
""",
    "fx_runs": """
select concat('run_', cast(c_custkey as varchar(20))) as run_name,
 case when c_custkey % 9 = 0 then null else cast(floor(abs(c_acctbal)) as double) / 10000 end as accuracy,
 case when c_custkey % 9 = 0 then concat(repeat('x', 70), cast(c_custkey as varchar(20))) else null end as error
from customer
""",
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one fixture as a lazy DataFrame over the tables in ``sf_dir``.

    The tables are arguments of the query alone; nothing is registered in the
    caller's session.
    """
    text = FIXTURE_SQL[name]
    used = [t for t in BASE_TABLES if re.search(rf"\b(from|join) {t}\b", text)]
    for t in used:
        text = re.sub(rf"\b(from|join) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def with_clause(*names: str) -> str:
    """``WITH`` prefix defining the given fixtures, for DuckDB oracle SQL."""
    return "with " + ",\n".join(f"{n} as ({FIXTURE_SQL[n].strip()})" for n in names) + "\n"
