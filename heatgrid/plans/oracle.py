"""DuckDB SQL for every registered query (the correctness oracle).

The views ``region nation customer supplier part orders lineitem ...`` are
registered by the checker; the CTEs below derive the landing tables as
FIXTURES.md specifies, with every line item a weather reading (its variant
that keeps return flag N as the ignored datatype PRCP), and then state each
query in plain SQL.
"""

from __future__ import annotations

# Landing tables and refresh outputs, as CTE bodies in dependency order.
_CTES: dict[str, str] = {
    "city_dim": """
select n_name as city, r_name as state,
  concat('GHCND:USW', lpad(cast(n_nationkey as varchar), 8, '0')) as noaa_station_id,
  case when n_nationkey % 6 = 5 then 'N/A' else concat('BA', cast(n_regionkey as varchar)) end as eia_ba_code,
  case when n_nationkey = 24 then null else cast(25 + n_nationkey as double) end as latitude,
  cast(-120 + 2*n_nationkey as double) as longitude,
  cast(n_nationkey as bigint) as cfg_pos
from nation join region on n_regionkey = r_regionkey
union all
select 'UNLANDED CITY', 'NOWHERE', 'GHCND:USW00000099', 'N/A', null, null, 25""",
    "raw_weather": """
select n_name as city, l_shipdate as date,
  case l_returnflag when 'A' then 'TMAX' when 'R' then 'TMIN' else 'PRCP' end as datatype,
  (l_quantity*10 - 100 + l_linenumber)/10 as value,
  row_number() over (partition by n_name order by l_orderkey, l_linenumber, l_partkey, l_suppkey,
                     l_quantity, l_returnflag, l_shipdate) as pos
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey""",
    "raw_energy": """
select n_name as city, o_orderdate as period, o_orderstatus as type,
  case when o_orderkey % 97 = 0 then 'n/a'
       when o_orderkey % 13 = 0 then cast(-o_totalprice as varchar)
       else cast(o_totalprice as varchar) end as value
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "weather_first": """
select * from (select *, row_number() over (partition by city, cast(date as date), datatype order by pos) as rn
               from raw_weather) t where rn = 1""",
    "weather_daily": """
select city, cast(date as date) as date,
  round(max(case when datatype = 'TMAX' then value end)*9/5+32, 2) as TMAX_F,
  round(max(case when datatype = 'TMIN' then value end)*9/5+32, 2) as TMIN_F
from weather_first group by city, cast(date as date)""",
    "energy_cities": """
select city from city_dim
where city is not null and noaa_station_id is not null and eia_ba_code is not null
  and length(eia_ba_code) > 0 and upper(trim(eia_ba_code)) not in ('NONE', 'N/A')""",
    "energy_daily": """
select city, cast(period as date) as date,
  coalesce(cast(round_even(sum(try_cast(try_cast(value as double) as decimal(28,6))), 2) as double), 0.0) as energy_mwh
from raw_energy where city in (select city from energy_cities) and cast(period as date) is not null
group by city, cast(period as date)""",
    "merged": """
select coalesce(w.city, e.city) as city, coalesce(w.date, e.date) as date, TMAX_F, TMIN_F, energy_mwh
from weather_daily w full outer join energy_daily e on w.city = e.city and w.date = e.date""",
    "master": """
select date, TMAX_F, TMIN_F, energy_mwh, city from merged
union all
select null, null, null, null, city from (select distinct city from city_dim where city is not null) c
where not exists (select 1 from merged m where m.city = c.city)""",
    "coords": """
select city, latitude, longitude from (
  select *, row_number() over (partition by city order by cfg_pos desc) as rn from city_dim where city is not null
) t where rn = 1""",
    "stations": """
select concat(case s_suppkey % 3 when 0 then 'GHCND:USW' else 'GHCND:USC' end, lpad(cast(s_suppkey as varchar), 8, '0')) as id,
  case s_suppkey % 5 when 0 then 'HOUSTON INTL AIRPORT, TX US' when 1 then 'NEW YORK CNTRL PK, NY US'
    when 2 then 'PHOENIX, AZ US' when 3 then 'JUNEAU AIRPORT, AK US' else 'NOWHERE 5 N, ZZ US' end as name,
  case s_suppkey % 5 when 0 then 'Texas' when 1 then 'New York' when 2 then 'Arizona' when 3 then 'Alaska'
    else 'Atlantis' end as state,
  cast(20 + s_nationkey as double) as latitude, cast(-60 - s_nationkey as double) as longitude,
  case when s_suppkey % 5 = 3 then date '1999-01-01' when s_suppkey % 7 = 0 then date '2000-01-01'
    when s_suppkey % 5 = 2 and s_suppkey % 3 = 0 then date '2000-06-01' else date '2001-11-04' end as maxdate
from supplier""",
}


def _ana(metric: str = "avg", start: str | None = None, end: str | None = None,
         city: str | None = None) -> str:
    t = {"max": "m.TMAX_F", "min": "m.TMIN_F", "avg": "(m.TMAX_F + m.TMIN_F)/2"}[metric]
    conds = ["m.date is not null", f"{t} is not null"]
    if start:
        conds.append(f"m.date >= date '{start}'")
    if end:
        conds.append(f"m.date <= date '{end}'")
    if city:
        conds.append(f"m.city = '{city}'")
    return (f"select m.*, c.latitude, c.longitude, {t} as temp_for_analysis "
            f"from master m left join coords c on m.city = c.city where " + " and ".join(conds))


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with every CTE (unused ones cost nothing in DuckDB)."""
    ctes = dict(_CTES)
    ctes.update(extra or {})
    parts = [f"{name} as ({sql.strip()})" for name, sql in ctes.items()]
    return "with " + ",\n".join(parts) + "\n" + body.strip()


def ana_cte(**kw) -> dict[str, str]:
    return {"ana": _ana(**kw)}
