"""Registered queries: one Spark plan and one oracle SQL per operator key.

Every query reads the given tables through ``Inputs`` (so its work grows
with the data) and returns a lazy DataFrame. Column names equal the oracle's.
"""

from __future__ import annotations

import datetime as _dt
import os as _os
import uuid as _uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatgrid.functions.dates import RunMode
from heatgrid.functions.temperature import WEEKDAYS
from heatgrid.functions.text import city_slug
from heatgrid.operators import analysis, clean, master as mst, quality, stations as stn
from heatgrid.plans.inputs import Inputs
from heatgrid.plans.oracle import ana_cte, with_ctes
from heatgrid import schemas as _schemas
from heatgrid.plans.refresh import refresh as _refresh, report_from_stage
from heatgrid.session import ensure_checkpoint_dir as _ckpt_dir
from heatgrid.sources import landed as _landed, lookups, sinks as _sinks, storage as _storage
from heatgrid.sources.fixtures import STATIONS_AS_OF

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}

# Fixed parameters of the registered queries.
RANGE_START, RANGE_END = "1995-01-01", "1996-06-30"
MAP_END = "1998-07-10"      # of the map queries: six cities have a percent change, one from a negative day
ONE_CITY = "NATION_7"


def register(name: str, sql: str | None):
    def deco(fn: Callable[[Inputs], DataFrame]):
        _QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


# ============================================================ refresh / master
@register("weather_daily", with_ctes("select city, date, TMAX_F, TMIN_F from weather_daily"))
def _weather_daily(i: Inputs) -> DataFrame:
    return i.weather_daily()


@register("energy_daily", with_ctes("select city, date, energy_mwh from energy_daily"))
def _energy_daily(i: Inputs) -> DataFrame:
    return i.energy_daily()


@register("weather_energy_outer", with_ctes("select city, date, TMAX_F, TMIN_F, energy_mwh from merged"))
def _weather_energy_outer(i: Inputs) -> DataFrame:
    return i.merged()


@register("master", with_ctes("select date, TMAX_F, TMIN_F, energy_mwh, city from master"))
def _master(i: Inputs) -> DataFrame:
    return i.master()


# ============================================================ usage heatmap
_HEAT_LONG_SQL = """
, cells as (
  select case when temp_for_analysis < 50 then 0 when temp_for_analysis < 60 then 1
              when temp_for_analysis < 70 then 2 when temp_for_analysis < 80 then 3
              when temp_for_analysis < 90 then 4 else 5 end as bin_order,
         isodow(date) - 1 as day_order,
         round_even(cast(sum(cast(energy_mwh as decimal(28,6))) as double) / count(energy_mwh), 0) as avg_energy_mwh
  from ana group by all),
bins as (select * from (values (0, '<50°F'), (1, '50-60°F'), (2, '60-70°F'), (3, '70-80°F'),
                                (4, '80-90°F'), (5, '>90°F')) t(bin_order, temp_bin)),
days as (select * from (values (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'),
                                (4, 'Friday'), (5, 'Saturday'), (6, 'Sunday')) t(day_order, day_of_week))
"""


def _heat_sql(final: str) -> str:
    sql = with_ctes("select 1", ana_cte(metric="avg"))
    head = sql[: sql.rindex("select 1")].rstrip()
    return head + _HEAT_LONG_SQL + final


@register("usage_heatmap_long", _heat_sql("""
select b.bin_order, b.temp_bin, d.day_order, d.day_of_week, c.avg_energy_mwh
from bins b cross join days d left join cells c on c.bin_order = b.bin_order and c.day_order = d.day_order"""))
def _usage_heatmap_long(i: Inputs) -> DataFrame:
    return analysis.usage_heatmap_long(i.base("avg"))


@register("usage_heatmap", _heat_sql(
    "select b.bin_order, b.temp_bin, "
    + ", ".join(f"max(case when c.day_order = {k} then c.avg_energy_mwh end) as {d}"
                for k, d in enumerate(WEEKDAYS))
    + " from bins b left join cells c on c.bin_order = b.bin_order group by b.bin_order, b.temp_bin"))
def _usage_heatmap(i: Inputs) -> DataFrame:
    return analysis.usage_heatmap(i.base("avg"))


# ============================================================ scans and gates

CITY_COLS = ["city", "state", "noaa_station_id", "eia_ba_code", "latitude", "longitude"]
# run mode of the range-filter query: last 730 days up to a fixed as-of date
RANGE_MODE, RANGE_AS_OF = RunMode(historical_days=730), _dt.date(1996, 12, 31)
FRESHNESS_AS_OF = "1998-12-31"


@register("weather_raw", with_ctes("select city, date, datatype, value from raw_weather"))
def _weather_raw(i: Inputs) -> DataFrame:
    return i.raw_weather().select("city", "date", "datatype", "value")


@register("energy_raw", with_ctes("select city, period, type, value from raw_energy"))
def _energy_raw(i: Inputs) -> DataFrame:
    return i.raw_energy()


@register("energy_ba_gate", with_ctes(
    "select city, period, type, value from raw_energy where city in (select city from energy_cities)"))
def _energy_ba_gate(i: Inputs) -> DataFrame:
    return clean.gate_energy(i.raw_energy(), i.city_dim())


_rs, _re = RANGE_MODE.resolve(RANGE_AS_OF)


@register("raw_range_filter", with_ctes(
    f"select city, date, datatype, value from raw_weather "
    f"where cast(date as date) between date '{_rs}' and date '{_re}'"))
def _raw_range_filter(i: Inputs) -> DataFrame:
    s, e = RANGE_MODE.resolve(RANGE_AS_OF)
    return clean.weather_in_range(i.raw_weather(), s, e).select("city", "date", "datatype", "value")


@register("energy_coerced", with_ctes(
    "select city, cast(period as date) as date, try_cast(value as double) as energy_mwh from raw_energy"))
def _energy_coerced(i: Inputs) -> DataFrame:
    return clean.energy_coerced(i.raw_energy())


@register("weather_dedup", with_ctes(
    "select city, cast(date as date) as date, datatype, value from weather_first"))
def _weather_dedup(i: Inputs) -> DataFrame:
    return clean.weather_dedup(i.raw_weather())


@register("weather_fahrenheit", with_ctes(
    "select city, cast(date as date) as date, datatype, round(value*9/5+32, 2) as temp_f "
    "from weather_first where datatype in ('TMAX', 'TMIN')"))
def _weather_fahrenheit(i: Inputs) -> DataFrame:
    return clean.weather_fahrenheit(i.raw_weather())


@register("missing_cities", with_ctes(
    "select distinct city from city_dim c where city is not null "
    "and not exists (select 1 from merged m where m.city = c.city)"))
def _missing_cities(i: Inputs) -> DataFrame:
    return mst.missing_cities(i.city_dim(), i.merged())


# ============================================================ quality
def _q_sql(body: str) -> str:
    return with_ctes(body)


_DUP_SQL = """
select 'noaa_' || replace(lower(city), ' ', '_') || '.json' as file, 'Duplicate Raw Data' as "check",
  'WARNING' as level,
  'Duplicate weather data points found. This can cause processing errors. Taking first entry.' as message,
  '{"duplicate_groups": ' || count(*) || ', "duplicate_rows": ' || sum(n) || '}' as details
from (select city, cast(date as date) d, datatype, count(*) n from raw_weather group by all having count(*) > 1) g
group by city"""

_PYF = "regexp_replace(printf('%.2f', {x}), '(\\.\\d)0$', '\\1')"

_TEMP_SQL = f"""
select 'noaa_' || replace(lower(city), ' ', '_') || '.json' as file, 'Temperature Logic' as "check",
  'WARNING' as level,
  'Date ' || cast(date as varchar) || ': TMIN (' || {_PYF.format(x='TMIN_F')} || '°F) > TMAX ('
    || {_PYF.format(x='TMAX_F')} || '°F).' as message,
  '{{"date": "' || cast(date as varchar) || '", "tmin_f": ' || {_PYF.format(x='TMIN_F')}
    || ', "tmax_f": ' || {_PYF.format(x='TMAX_F')} || '}}' as details
from weather_daily where TMIN_F > TMAX_F"""

_NEG_SQL = f"""
select 'eia_' || replace(lower(city), ' ', '_') || '.json' as file, 'Negative Energy' as "check",
  'WARNING' as level,
  'Date ' || cast(date as varchar) || ': Negative energy consumption detected ('
    || {_PYF.format(x='energy_mwh')} || ' MWh).' as message,
  '{{"date": "' || cast(date as varchar) || '", "energy_mwh": ' || {_PYF.format(x='energy_mwh')}
    || '}}' as details
from energy_daily where energy_mwh < 0"""


@register("q_duplicates", _q_sql(_DUP_SQL))
def _q_duplicates(i: Inputs) -> DataFrame:
    return quality.q_duplicates(i.raw_weather())


@register("q_duplicate_rows", with_ctes("""
select r.city, cast(r.date as date) as date, r.datatype, r.value from raw_weather r
where (r.city, cast(r.date as date), r.datatype) in (
  select (city, cast(date as date), datatype) from raw_weather group by all having count(*) > 1)"""))
def _q_duplicate_rows(i: Inputs) -> DataFrame:
    return quality.duplicate_rows(i.raw_weather())


@register("q_temp_logic", _q_sql(_TEMP_SQL))
def _q_temp_logic(i: Inputs) -> DataFrame:
    return quality.q_temp_logic(i.weather_daily())


@register("q_negative_energy", _q_sql(_NEG_SQL))
def _q_negative_energy(i: Inputs) -> DataFrame:
    return quality.q_negative_energy(i.energy_daily())


_BAD_SQL = """
select 'noaa_' || replace(lower(city), ' ', '_') || '.json' as file, 'Data Pivoting' as "check",
  'ERROR' as level,
  'Could not pivot data, likely due to duplicate TMAX/TMIN values for a single day. Error: unparsable date or corrupt record in file' as message,
  '{}' as details
from (select city, case when city like '%3' and value < 0 then 'no day' else cast(date as varchar) end as date
      from raw_weather) r
group by city having bool_or(date is not null and try_cast(date as timestamp) is null)"""


@register("q_bad_files", _q_sql(_BAD_SQL))
def _q_bad_files(i: Inputs) -> DataFrame:
    # cold readings of the cities whose names end in 3 get a date that does not parse
    lost = F.col("city").endswith("3") & (F.col("value") < 0)
    raw = i.raw_weather().withColumn("date", F.when(lost, "no day").otherwise(F.col("date").cast("string")))
    return quality.q_bad_files(raw)


def _stage_report(i: Inputs) -> DataFrame:
    keys, processed = i.stage()
    return report_from_stage(keys, processed)


def _written_report(i: Inputs) -> DataFrame:
    """The report as its readers get it: written by the refresh's sink (S13), then read."""
    path = i._path("quality-report")
    _sinks.write_quality_report(_stage_report(i), path)
    return _landed.read_quality_report(i.spark, path)


@register("quality_report", _q_sql(
    "select * from (" + _DUP_SQL + ") union all select * from (" + _TEMP_SQL
    + ") union all select * from (" + _NEG_SQL + ")"))
def _quality_report(i: Inputs) -> DataFrame:
    return _stage_report(i)


@register("quality_view", _q_sql(
    "select level, \"check\", message, file from (select * from (" + _DUP_SQL + ") union all select * from ("
    + _TEMP_SQL + ") union all select * from (" + _NEG_SQL + "))"))
def _quality_view(i: Inputs) -> DataFrame:
    return quality.quality_view(_written_report(i))


@register("quality_summary", _q_sql(
    "select \"check\", level, count(*) as n_issues from (select * from (" + _DUP_SQL
    + ") union all select * from (" + _TEMP_SQL + ") union all select * from (" + _NEG_SQL
    + ")) group by all"))
def _quality_summary(i: Inputs) -> DataFrame:
    return quality.quality_summary(_written_report(i))


@register("q_missing_values", with_ctes("""
select city, column_name, n_rows, n_missing from (
  select city, count(*) as n_rows, count(*) - count(date) as date, count(*) - count(TMAX_F) as TMAX_F,
    count(*) - count(TMIN_F) as TMIN_F, count(*) - count(energy_mwh) as energy_mwh
  from master group by city
) unpivot (n_missing for column_name in (date, TMAX_F, TMIN_F, energy_mwh))"""))
def _q_missing_values(i: Inputs) -> DataFrame:
    return quality.q_missing_values(i.master())


@register("q_outliers", with_ctes("""
select city, date, column_name, value, case
  when column_name in ('TMAX_F', 'TMIN_F') and value > 130 then 'temperature above 130°F'
  when column_name in ('TMAX_F', 'TMIN_F') and value < -50 then 'temperature below -50°F'
  when column_name = 'energy_mwh' and value < 0 then 'negative energy' end as rule
from (select city, date, TMAX_F, TMIN_F, energy_mwh from master)
unpivot (value for column_name in (TMAX_F, TMIN_F, energy_mwh))
where rule is not null"""))
def _q_outliers(i: Inputs) -> DataFrame:
    return quality.q_outliers(i.master())


@register("q_freshness", with_ctes(f"""
select city, max(date) as latest_date,
  datediff('day', max(date), date '{FRESHNESS_AS_OF}') as days_since_latest
from master group by city"""))
def _q_freshness(i: Inputs) -> DataFrame:
    return quality.q_freshness(i.master(), FRESHNESS_AS_OF)


# ============================================================ analysis
_ANA_COLS = "date, TMAX_F, TMIN_F, energy_mwh, city, latitude, longitude, temp_for_analysis"


def _ana_sql(body: str, **kw) -> str:
    return with_ctes(body, ana_cte(**kw))


@register("analysis_base", _ana_sql(f"select {_ANA_COLS} from ana"))
def _analysis_base(i: Inputs) -> DataFrame:
    return i.base("avg")


for _m in ("max", "min", "avg"):
    def _mk(m):
        @register(f"temp_metric_{m}", _ana_sql("select city, date, temp_for_analysis from ana", metric=m))
        def _q(i: Inputs) -> DataFrame:
            return i.base(m).select("city", "date", "temp_for_analysis")
        return _q
    _mk(_m)


@register("date_filter", _ana_sql(f"select {_ANA_COLS} from ana", start=RANGE_START, end=RANGE_END))
def _date_filter(i: Inputs) -> DataFrame:
    return i.base("avg", RANGE_START, RANGE_END)


@register("city_filter", _ana_sql(f"select {_ANA_COLS} from ana", city=ONE_CITY))
def _city_filter(i: Inputs) -> DataFrame:
    return i.base("avg", city=ONE_CITY)


@register("filtered_export", _ana_sql(f"select {_ANA_COLS} from ana", start=RANGE_START, end=RANGE_END,
                                      city=ONE_CITY))
def _filtered_export(i: Inputs) -> DataFrame:
    return i.base("avg", RANGE_START, RANGE_END, ONE_CITY)


@register("with_coordinates", with_ctes(
    "select m.date, m.TMAX_F, m.TMIN_F, m.energy_mwh, m.city, c.latitude, c.longitude "
    "from master m left join coords c on m.city = c.city"))
def _with_coordinates(i: Inputs) -> DataFrame:
    return analysis.with_coordinates(i.master(), i.city_dim())


@register("date_bounds", with_ctes("select min(date) as min_date, max(date) as max_date from master"))
def _date_bounds(i: Inputs) -> DataFrame:
    return analysis.date_bounds(i.master())


@register("city_list", with_ctes("select distinct city from master"))
def _city_list(i: Inputs) -> DataFrame:
    return analysis.city_list(i.master())


@register("kpis", _ana_sql("""
select count(distinct city) as n_cities,
  cast((select datediff('day', min(date), max(date)) + 1 from master) as integer) as duration_days,
  round(avg(TMAX_F), 6) as avg_tmax_f, round(avg(TMIN_F), 6) as avg_tmin_f,
  round(cast(sum(cast(energy_mwh as decimal(28,6))) as double) / count(energy_mwh), 6) as avg_energy_mwh
from ana having count(*) > 0"""))
def _kpis(i: Inputs) -> DataFrame:
    m = i.master_snapshot()
    return analysis.kpis(i.base("avg", master=m), m)


@register("time_series", _ana_sql("select date, city, temp_for_analysis, energy_mwh from ana"))
def _time_series(i: Inputs) -> DataFrame:
    return analysis.time_series(i.base("avg"))


@register("total_energy_by_date", _ana_sql("""
select date, coalesce(cast(round_even(sum(cast(energy_mwh as decimal(28,6))), 2) as double), 0.0) as total_energy_mwh
from ana group by date"""))
def _total_energy_by_date(i: Inputs) -> DataFrame:
    return analysis.total_energy_by_date(i.base("avg"))


@register("weekend_bands", _ana_sql("""
select distinct date, cast(date as timestamp) - interval 12 hour as band_start,
  cast(date as timestamp) + interval 12 hour as band_end
from ana where isodow(date) >= 6"""))
def _weekend_bands(i: Inputs) -> DataFrame:
    return analysis.weekend_bands(i.base("avg"))


@register("ols_correlation", _ana_sql("""
select count(*) as n, round(regr_intercept(energy_mwh, temp_for_analysis), 6) as intercept,
  round(regr_slope(energy_mwh, temp_for_analysis), 6) as slope,
  round(regr_r2(energy_mwh, temp_for_analysis), 9) as r2,
  round(corr(temp_for_analysis, energy_mwh), 9) as r
from ana where energy_mwh is not null having count(*) > 0"""))
def _ols_correlation(i: Inputs) -> DataFrame:
    return analysis.ols_correlation(i.base("avg"))


@register("regression_line", _ana_sql("""
select p.point, round(p.x, 6) as temp, round(b0 + b1 * p.x, 6) as energy_fit
from (select regr_intercept(energy_mwh, temp_for_analysis) b0, regr_slope(energy_mwh, temp_for_analysis) b1,
             min(temp_for_analysis) x_min, max(temp_for_analysis) x_max
      from ana where energy_mwh is not null having count(*) > 0) f,
     lateral (select 0 as point, x_min as x union all select 1, x_max) p"""))
def _regression_line(i: Inputs) -> DataFrame:
    return analysis.regression_line(i.base("avg"))


_LATEST = "latest as (select * exclude (rn) from (select *, row_number() over (partition by city order by date desc) rn from ana) where rn = 1)"


@register("latest_per_city", _ana_sql(
    f"select {_ANA_COLS} from (select * from ana qualify row_number() over (partition by city order by date desc) = 1)"))
def _latest_per_city(i: Inputs) -> DataFrame:
    return analysis.latest_per_city(i.base("avg")).select(*_ANA_COLS.split(", "))


_GEO_TAIL = """
, rng as (select min(energy_mwh) as color_min, max(energy_mwh) as color_max from latest),
geo as (
  select l.*, p.energy_prev_day,
    case when l.energy_mwh is null or p.energy_prev_day is null then null
         when p.energy_prev_day <> 0 then (l.energy_mwh - p.energy_prev_day) / p.energy_prev_day * 100
         when l.energy_mwh > 0 then 'inf'::double when l.energy_mwh < 0 then '-inf'::double end as energy_pct_change
  from latest l left join prev p on l.city = p.city)
select g.city, g.date, g.latitude, g.longitude, g.temp_for_analysis, g.energy_mwh, g.energy_prev_day,
  g.energy_pct_change, coalesce(g.energy_mwh, 1000.0) as size_for_map,
  case when g.energy_mwh is null then 'Energy data not available' else format('{:,.0f}', g.energy_mwh) || ' MWh' end
    as hover_energy_text,
  case when g.energy_pct_change is null then 'No prior day data'
       when g.energy_pct_change = 'inf'::double then '+inf% vs yesterday'
       when g.energy_pct_change = '-inf'::double then '-inf% vs yesterday'
       else printf('%+.1f%% vs yesterday', g.energy_pct_change) end as hover_pct_change_text,
  r.color_min, r.color_max
from geo g cross join rng r
where g.latitude is not null and g.longitude is not null and g.temp_for_analysis is not null"""


def _geo_sql(prev: str) -> str:
    sql = with_ctes("select 1", ana_cte(metric="max", end=MAP_END))
    head = sql[: sql.rindex("select 1")].rstrip()
    return head + ",\n" + _LATEST + ",\n" + prev + _GEO_TAIL


@register("geo_latest", _geo_sql(
    "prev as (select city, energy_mwh as energy_prev_day from ana "
    "where date = (select min(date) - 1 from latest))"))
def _geo_latest(i: Inputs) -> DataFrame:
    return analysis.geo_latest(i.filtered("max", end=MAP_END, master=i.master_snapshot()))


@register("geo_latest_per_city_prev", _geo_sql(
    "prev as (select a.city, a.energy_mwh as energy_prev_day from ana a join latest l "
    "on a.city = l.city and a.date = l.date - 1)"))
def _geo_latest_per_city_prev(i: Inputs) -> DataFrame:
    return analysis.geo_latest_per_city_prev(i.filtered("max", end=MAP_END, master=i.master_snapshot()))


_BIN_CASE = """case when temp_for_analysis < 50 then 0 when temp_for_analysis < 60 then 1
  when temp_for_analysis < 70 then 2 when temp_for_analysis < 80 then 3
  when temp_for_analysis < 90 then 4 else 5 end"""


@register("temp_bins", _ana_sql(f"""
select city, date, temp_for_analysis, {_BIN_CASE} as bin_order,
  ['<50°F', '50-60°F', '60-70°F', '70-80°F', '80-90°F', '>90°F'][{_BIN_CASE} + 1] as temp_bin
from ana"""))
def _temp_bins(i: Inputs) -> DataFrame:
    return analysis.with_temp_bins(i.base("avg")).select(
        "city", "date", "temp_for_analysis", "bin_order", "temp_bin")


# ============================================================ stations
def _tier_sql() -> str:
    return f"""
tiered as (select *, case when maxdate >= timestamp '{STATIONS_AS_OF}' - interval 1 year and id like 'GHCND:USW%'
                            then 1 when maxdate >= timestamp '{STATIONS_AS_OF}' - interval 1 year then 2 else 3 end as tier
           from stations),
found as (select state, id as noaa_station_id, name, latitude, longitude, tier from tiered t
          where tier = (select min(tier) from tiered u where u.state = t.state)),
city_ba as ({lookups.values_sql(lookups.CITY_TO_BA, ('city_token', 'city_ba'))}),
state_ba as ({lookups.values_sql(lookups.STATE_TO_BA, ('state_key', 'state_ba'))}),
fips as ({lookups.values_sql(lookups.STATE_FIPS, ('state', 'fips'))}),
mapped as (
  select f.*, coalesce(c.city_ba, s.state_ba, 'N/A') as eia_ba_code,
    case when c.city_ba is not null then 'City Match' when s.state_ba is not null then 'State Estimate'
         else 'No Match' end as match_type
  from found f
  left join city_ba c on c.city_token = split_part(split_part(lower(f.name), ',', 1), ' ', 1)
  left join state_ba s on s.state_key = lower(f.state))"""


def _st_sql(body: str) -> str:
    sql = with_ctes("select 1")
    head = sql[: sql.rindex("select 1")].rstrip()
    return head + ",\n" + _tier_sql() + "\n" + body


@register("stations_by_state", _st_sql(
    "select s.*, f.fips from stations s join fips f on s.state = f.state where s.state = 'Texas'"))
def _stations_by_state(i: Inputs) -> DataFrame:
    return stn.stations_by_state(i.stations(), "Texas")


@register("station_search", _st_sql("select * from found"))
def _station_search(i: Inputs) -> DataFrame:
    return stn.station_search(i.stations(), STATIONS_AS_OF)


@register("station_ba_map", _st_sql("select * from mapped"))
def _station_ba_map(i: Inputs) -> DataFrame:
    return stn.station_ba_map(stn.station_search(i.stations(), STATIONS_AS_OF))


# ============================================================ the appended city list (onboarding -> save -> refresh)
# Config entries plus the stations picked by the search (U5): the city list a
# refresh validates (S4), slugs (P7) and whose coordinates a save casts.
# It grows with the station catalogue.
_APPENDED_SQL = f"""
appended as (
  select {', '.join(CITY_COLS)}, cfg_pos from city_dim
  union all
  select name as city, state, noaa_station_id, eia_ba_code, latitude, longitude,
         (select max(cfg_pos) from city_dim) + row_number() over (order by noaa_station_id) as cfg_pos
  from mapped),
edited as (
  select case when cfg_pos % 13 = 6 then null when cfg_pos % 5 = 1 then replace(lower(city), ' ', '_') else city end as city,
    state, case when cfg_pos % 7 = 3 then null else noaa_station_id end as noaa_station_id, eia_ba_code,
    case when cfg_pos % 11 = 4 then 'n/a' else cast(latitude as varchar) end as latitude,
    cast(longitude as varchar) as longitude, cfg_pos
  from appended)"""


def _appended_sql(body: str) -> str:
    return _st_sql("," + _APPENDED_SQL + "\n" + body)


def _edited(i: Inputs) -> DataFrame:
    """The appended list after an edit of its text: by position, some entries lose their name or station, some
    names change their case (their slugs clash then) and some latitudes do not parse."""
    k = F.col("cfg_pos")
    city = (F.when(k % 13 == 6, F.lit(None).cast("string")).when(k % 5 == 1, city_slug(F.col("city")))
            .otherwise(F.col("city")))
    return i.city_list().select(
        city.alias("city"), "state", F.when(k % 7 != 3, F.col("noaa_station_id")).alias("noaa_station_id"),
        "eia_ba_code", F.when(k % 11 == 4, F.lit("n/a")).otherwise(F.col("latitude").cast("string")).alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"), "cfg_pos")


@register("city_dim_append", _appended_sql(f"select {', '.join(CITY_COLS)}, cfg_pos from appended"))
def _city_dim_append(i: Inputs) -> DataFrame:
    return i.city_list().select(*CITY_COLS, "cfg_pos")


@register("city_dim_valid", _appended_sql(
    "select city, noaa_station_id, cfg_pos from edited where city is not null and noaa_station_id is not null"))
def _city_dim_valid(i: Inputs) -> DataFrame:
    return clean.valid_cities(_edited(i)).select("city", "noaa_station_id", "cfg_pos")


@register("city_slug", _appended_sql("""
select city, replace(lower(city), ' ', '_') as slug, cfg_pos,
  city = arg_max(city, cfg_pos) over (partition by replace(lower(city), ' ', '_')) as owns_file
from edited where city is not null and noaa_station_id is not null"""))
def _city_slug(i: Inputs) -> DataFrame:
    cd = clean.valid_cities(_edited(i))
    owners = mst.slug_owners(cd).select("slug", F.col("city").alias("_owner"))
    return (
        cd.select("city", city_slug(F.col("city")).alias("slug"), "cfg_pos")
        .join(owners, "slug")
        .select("city", "slug", "cfg_pos", (F.col("city") == F.col("_owner")).alias("owns_file"))
    )


_CAST_SQL = """
select city, cfg_pos, try_cast(latitude as double) as latitude, try_cast(longitude as double) as longitude,
  coalesce(bool_and((latitude is null or try_cast(latitude as double) is not null)
               and (longitude is null or try_cast(longitude as double) is not null)) over (), true) as edit_valid
from edited"""


@register("city_dim_cast", _appended_sql(_CAST_SQL + " where cfg_pos % 11 <> 4"))
def _city_dim_cast(i: Inputs) -> DataFrame:
    # an edit without the entries that do not parse is accepted
    text = _edited(i).filter(F.col("cfg_pos") % 11 != 4)
    return stn.city_dim_cast(text).select("city", "cfg_pos", "latitude", "longitude", "edit_valid")


@register("city_dim_cast_rejected", _appended_sql(_CAST_SQL))
def _city_dim_cast_rejected(i: Inputs) -> DataFrame:
    return stn.city_dim_cast(_edited(i)).select("city", "cfg_pos", "latitude", "longitude", "edit_valid")


# ============================================================ selection variants
@register("kpis_city_range", _ana_sql(f"""
select count(distinct city) as n_cities,
  cast(datediff('day', date '{RANGE_START}', date '{RANGE_END}') + 1 as integer) as duration_days,
  round(avg(TMAX_F), 6) as avg_tmax_f, round(avg(TMIN_F), 6) as avg_tmin_f,
  round(cast(sum(cast(energy_mwh as decimal(28,6))) as double) / count(energy_mwh), 6) as avg_energy_mwh
from ana having count(*) > 0""", metric="max", start=RANGE_START, end=RANGE_END, city=ONE_CITY))
def _kpis_city_range(i: Inputs) -> DataFrame:
    return analysis.kpis(i.base("max", RANGE_START, RANGE_END, ONE_CITY), None, RANGE_START, RANGE_END)


def _heat_sql_for(final: str, **kw) -> str:
    sql = with_ctes("select 1", ana_cte(**kw))
    head = sql[: sql.rindex("select 1")].rstrip()
    return head + _HEAT_LONG_SQL + final


@register("usage_heatmap_city_max", _heat_sql_for("""
select b.bin_order, b.temp_bin, d.day_order, d.day_of_week, c.avg_energy_mwh
from bins b cross join days d left join cells c on c.bin_order = b.bin_order and c.day_order = d.day_order""",
                                                  metric="max", city=ONE_CITY))
def _usage_heatmap_city_max(i: Inputs) -> DataFrame:
    return analysis.usage_heatmap_long(i.base("max", city=ONE_CITY))


# ============================================================ end to end through the landing path


# run range of the end-to-end refresh: wide enough to hold every fixture date
REFRESH_RANGE = ("1970-01-01", "2029-12-31")


def _root(i: Inputs) -> str:
    """A fresh folder under the session's checkpoint folder (shared storage on a cluster)."""
    return _os.path.join(_ckpt_dir(i.spark), f"refresh-{_uuid.uuid4().hex}")


def _run_refresh(i: Inputs) -> dict[str, str]:
    """Land the fixture's raw tables by years, then run the refresh job."""
    root = _root(i)
    w_root, e_root = _os.path.join(root, "landing", "noaa"), _os.path.join(root, "landing", "eia")
    _sinks.land_spans(i.raw_weather(), w_root, "noaa", i.city_dim(), *REFRESH_RANGE, grain="year")
    _sinks.land_spans(i.raw_energy(), e_root, "eia", i.city_dim(), *REFRESH_RANGE, grain="year")
    paths = _refresh(i.spark, w_root, e_root, i.city_dim(), _os.path.join(root, "out"),
                     RunMode(fetch_range=REFRESH_RANGE), layout="spans")
    _storage.delete(i.spark, _os.path.join(root, "landing"))
    return paths


@register("refresh_master", with_ctes("select date, TMAX_F, TMIN_F, energy_mwh, city from master"))
def _refresh_master(i: Inputs) -> DataFrame:
    return _landed.read_master(i.spark, _run_refresh(i)["master"])


@register("refresh_city_summary", with_ctes("""
select city, count(*) as n_rows, count(*) - count(date) as missing_date, count(*) - count(TMAX_F) as "missing_TMAX_F",
  count(*) - count(TMIN_F) as "missing_TMIN_F", count(*) - count(energy_mwh) as missing_energy_mwh,
  min(date) as min_date, max(date) as max_date
from master group by city"""))
def _refresh_city_summary(i: Inputs) -> DataFrame:
    return i.spark.read.parquet(_run_refresh(i)["city_summary"])


_SUFFIX = f"_{REFRESH_RANGE[0]}_to_{REFRESH_RANGE[1]}.json"


@register("refresh_quality_report", _q_sql(
    "select * from (" + _DUP_SQL.replace("'.json'", f"'{_SUFFIX}'") + ") union all select * from ("
    + _TEMP_SQL.replace("'.json'", f"'{_SUFFIX}'") + ") union all select * from ("
    + _NEG_SQL.replace("'.json'", f"'{_SUFFIX}'") + ")"))
def _refresh_quality_report(i: Inputs) -> DataFrame:
    return _landed.read_quality_report(i.spark, _run_refresh(i)["quality_report"])


# ============================================================ a refresh over several landed ranges, some of which failed
LANDED_RANGES = (("1992-01-01", "1995-12-31"), ("1996-01-01", "2003-12-31"))
SEVERAL_RANGE = ("1993-07-01", "2002-12-31")
# a landing of a city whose name ends in 3 loses the days of its cold readings, and so fails as a whole
_SEVERAL = {
    "landed_weather": f"""
select city, cast(date as date) as day, datatype, value, pos,
  case when cast(date as date) >= date '1996-01-01' then '1996-01-01_to_2003-12-31' else '1992-01-01_to_1995-12-31' end as part,
  city like '%3' and cast(date as date) >= date '1996-01-01' and value < 0 as lost
from (select n_name as city, l_shipdate as date,
  case l_returnflag when 'A' then 'TMAX' when 'R' then 'TMIN' else 'PRCP' end as datatype,
  (l_quantity*10 - 100 + l_linenumber)/10 as value,
  row_number() over (partition by n_name order by l_orderkey, l_linenumber, l_partkey, l_suppkey,
                     l_quantity, l_returnflag, l_shipdate) as pos
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey) t""",
    "in_range": f"""
select * from landed_weather
where lost or day between date '{SEVERAL_RANGE[0]}' and date '{SEVERAL_RANGE[1]}'""",
    "raw_weather": """
select city, day as date, datatype, value, pos from in_range r
where not exists (select 1 from in_range b where b.lost and b.city = r.city and b.part = r.part)""",
    "energy_daily": f"""
select city, cast(period as date) as date,
  coalesce(cast(round_even(sum(try_cast(try_cast(value as double) as decimal(28,6))), 2) as double), 0.0) as energy_mwh
from raw_energy where city in (select city from energy_cities)
  and cast(period as date) between date '{SEVERAL_RANGE[0]}' and date '{SEVERAL_RANGE[1]}'
group by city, cast(period as date)""",
}


def _several_sql(body: str) -> str:
    """The CTEs with those of the landed ranges before the tables that they replace."""
    first = {k: _SEVERAL[k] for k in ("landed_weather", "in_range")}
    sql = with_ctes(body, {k: v for k, v in _SEVERAL.items() if k not in first})
    return "with " + ",\n".join(f"{k} as ({v.strip()})" for k, v in first.items()) + ",\n" + sql[len("with "):]


def _run_several(i: Inputs) -> dict[str, str]:
    """Land two ranges by years, one after the other, and refresh a range that meets both."""
    root = _root(i)
    roots = {s: _os.path.join(root, "landing", s) for s in ("noaa", "eia")}
    lost = F.col("city").endswith("3") & (F.col("value") < 0)
    for k, (start, end) in enumerate(LANDED_RANGES):
        for source, raw, day in (("noaa", i.raw_weather(), "date"), ("eia", i.raw_energy(), "period")):
            part = raw.filter(F.col(day).cast("date").between(start, end))
            if source == "noaa" and k:
                part = part.withColumn(day, F.when(lost, F.lit("no day")).otherwise(F.col(day).cast("string")))
            _sinks.land_spans(part, roots[source], source, i.city_dim(), start, end, grain="year")
    paths = _refresh(i.spark, roots["noaa"], roots["eia"], i.city_dim(), _os.path.join(root, "out"),
                     RunMode(fetch_range=SEVERAL_RANGE), layout="spans")
    _storage.delete(i.spark, _os.path.join(root, "landing"))
    return paths


@register("refresh_several_ranges", _several_sql("select date, TMAX_F, TMIN_F, energy_mwh, city from master"))
def _refresh_several_ranges(i: Inputs) -> DataFrame:
    return _landed.read_master(i.spark, _run_several(i)["master"])


@register("refresh_file_verdicts", _several_sql("""
select 'noaa' as source, 'noaa_' || lower(city) || '_' || part || '.json' as file, city, bool_or(bad) as failed,
  count(*) filter (n > 1) as duplicate_groups, cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as duplicate_rows
from (select city, part, case when not lost then day end as day, datatype, count(*) as n, bool_or(lost) as bad
      from in_range group by all) g
group by city, part
union all
select 'eia', 'eia_' || lower(city) || '_' || part || '.json', city, false, 0, 0
from (select distinct city, case when cast(period as date) >= date '1996-01-01' then '1996-01-01_to_2003-12-31'
        else '1992-01-01_to_1995-12-31' end as part
      from raw_energy where city in (select city from energy_cities)
        and cast(period as date) between date '""" + SEVERAL_RANGE[0] + "' and date '" + SEVERAL_RANGE[1] + "') e"))
def _refresh_file_verdicts(i: Inputs) -> DataFrame:
    return i.spark.read.schema(_schemas.FILE_VERDICTS).parquet(_run_several(i)["file_verdicts"])


# ============================================================ branches that the plain fixture does not reach
@register("energy_respondents", with_ctes("""
select city, cast(period as date) as date,
  coalesce(cast(round_even(sum(try_cast(try_cast(value as double) as decimal(28,6))), 2) as double), 0.0) as energy_mwh
from (select r.*, c.eia_ba_code, case when try_cast(value as double) > 200000 then 'OTHER'
        when type = 'F' then ' ' || c.eia_ba_code || ' ' end as respondent
      from raw_energy r join city_dim c on r.city = c.city) e
where city in (select city from energy_cities) and (respondent is null or trim(respondent) = eia_ba_code)
group by city, cast(period as date)"""))
def _energy_respondents(i: Inputs) -> DataFrame:
    # dear orders are another respondent's, those of type F the city's own, and the others name none
    own = i.city_dim().select("city", "eia_ba_code")
    other = F.col("value").try_cast("double") > 200000
    raw = i.raw_energy().join(own, "city").withColumn("respondent", F.when(other, F.lit("OTHER")).when(
        F.col("type") == "F", F.concat(F.lit(" "), F.col("eia_ba_code"), F.lit(" ")))).drop("eia_ba_code")
    return clean.energy_daily(raw, i.city_dim())


_EXTREME = {"raw_weather": """
select n_name as city, l_shipdate as date,
  case l_returnflag when 'A' then 'TMAX' when 'R' then 'TMIN' else 'PRCP' end as datatype,
  case when l_quantity > 45 then 2 when l_quantity < 5 then 9 else 1 end * (l_quantity*10 - 100 + l_linenumber)/10 as value,
  row_number() over (partition by n_name order by l_orderkey, l_linenumber, l_partkey, l_suppkey,
                     l_quantity, l_returnflag, l_shipdate) as pos
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey"""}


@register("q_outliers_extreme", with_ctes("""
select city, date, column_name, value, case
  when column_name in ('TMAX_F', 'TMIN_F') and value > 130 then 'temperature above 130°F'
  when column_name in ('TMAX_F', 'TMIN_F') and value < -50 then 'temperature below -50°F'
  when column_name = 'energy_mwh' and value < 0 then 'negative energy' end as rule
from (select city, date, TMAX_F, TMIN_F, energy_mwh from master)
unpivot (value for column_name in (TMAX_F, TMIN_F, energy_mwh))
where rule is not null""", _EXTREME))
def _q_outliers_extreme(i: Inputs) -> DataFrame:
    # great and small readings are doubled and multiplied by nine, beyond both bounds (Q7)
    tenths = F.round(F.col("value") * 10)
    quantity = (tenths + 100 - F.pmod(tenths + 100, F.lit(10))) / 10
    times = F.when(quantity > 45, 2).when(quantity < 5, 9).otherwise(1)
    raw = i.raw_weather().withColumn("value", times * tenths / 10)
    master = mst.build_master(raw, i.raw_energy(), i.city_dim())
    return quality.q_outliers(master)


@register("master_no_data", with_ctes(
    "select cast(null as date) as date, cast(null as double) as TMAX_F, cast(null as double) as TMIN_F, "
    "cast(null as double) as energy_mwh, city from city_dim"))
def _master_no_data(i: Inputs) -> DataFrame:
    # a range without a reading: one placeholder per configured city
    return mst.build_master(i.raw_weather(), i.raw_energy(), i.city_dim(), "2040-01-01", "2040-12-31")


@register("q_duplicate_rows_ordered", with_ctes("""
select city, cast(date as date) as date, datatype, value,
  row_number() over (partition by city order by cast(date as date), datatype, pos) as place
from raw_weather r
where (r.city, cast(r.date as date), r.datatype) in (
  select (city, cast(date as date), datatype) from raw_weather group by all having count(*) > 1)"""))
def _q_duplicate_rows_ordered(i: Inputs) -> DataFrame:
    return quality.ordered_duplicates(i.raw_weather(), i._path("duplicates"))
