"""Edge-case semantics on tiny hand-written frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from heatgrid.functions.dates import RunMode
from heatgrid.functions.numeric import pct_change
from heatgrid.functions.temperature import TEMP_BIN_LABELS, temp_bin_label, temp_bin_order
from heatgrid.functions.text import energy_text, pct_text, py_float_text, station_city_token
from heatgrid.operators import analysis, clean, master as mst, quality, stations as stn
from heatgrid.schemas import CITY_DIM

D = dt.date


def city_dim(spark, rows):
    full = [(r + (None,) * (6 - len(r)))[:6] + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, CITY_DIM)


def raw_w(spark, rows):
    return spark.createDataFrame(rows, "city string, date string, datatype string, value double, pos long")


def raw_e(spark, rows):
    return spark.createDataFrame(rows, "city string, period string, value string")


def test_keep_first_even_when_first_value_is_null(spark):
    raw = raw_w(spark, [
        ("A", "2024-01-01T00:00:00", "TMAX", None, 1),
        ("A", "2024-01-01T00:00:00", "TMAX", 10.0, 2),
        ("A", "2024-01-01T00:00:00", "TMIN", 5.0, 4),
        ("A", "2024-01-01T00:00:00", "TMIN", 1.0, 3),
    ])
    row = clean.weather_daily(raw).collect()[0]
    assert row.TMAX_F is None and row.TMIN_F == pytest.approx(33.8)
    keys = clean.weather_keys(raw)
    daily = clean.weather_daily_from_keys(keys).collect()[0]
    assert daily.TMAX_F is None and daily.TMIN_F == pytest.approx(33.8)


def test_other_datatypes_and_null_dates_give_rows(spark):
    raw = raw_w(spark, [
        ("A", "2024-01-01", "PRCP", 3.0, 1),
        ("A", None, "TMAX", 1.0, 2),
    ])
    rows = {(r.date, r.TMAX_F) for r in clean.weather_daily(raw).collect()}
    assert rows == {(D(2024, 1, 1), None), (None, 33.8)}


def test_energy_sum_null_handling(spark):
    raw = raw_e(spark, [
        ("A", "2024-01-01", "n/a"), ("A", "2024-01-01", None),   # all NULL -> 0.0
        ("A", "2024-01-02", " 2 "), ("A", "2024-01-02", "1e3"), ("A", "2024-01-02", "0x10"),
        ("A", "2024-01-03", "nan"), ("A", "2024-01-03", "0.125"), ("A", "2024-01-03", "0.25"),
        ("A", None, "5"),                                          # NULL date dropped
    ])
    got = {r.date: r.energy_mwh for r in clean.energy_daily(raw.withColumn("period", F.col("period"))).collect()}
    assert got == {D(2024, 1, 1): 0.0, D(2024, 1, 2): 1002.0, D(2024, 1, 3): 0.38}


def test_ba_gate(spark):
    cd = city_dim(spark, [("A", "S", "st", "none"), ("B", "S", "st", " N/A "), ("C", "S", "st", ""),
                          ("D", "S", "st", None), ("E", "S", "st", "PJM"), ("F", "S", None, "PJM")])
    assert [r.city for r in clean.energy_cities(cd).collect()] == ["E"]


def test_temperature_bins_left_closed(spark):
    df = spark.createDataFrame([(t,) for t in [49.99, 50.0, 59.9, 60.0, 70.0, 80.0, 89.99, 90.0, 120.0]], "t double")
    got = [r.b for r in df.select(temp_bin_label(temp_bin_order(F.col("t"))).alias("b")).collect()]
    L = TEMP_BIN_LABELS
    assert got == [L[0], L[1], L[1], L[2], L[3], L[4], L[4], L[5], L[5]]


def test_full_grid_from_one_row(spark):
    base = spark.createDataFrame([(D(2024, 1, 1), "A", 55.0, 100.5)],
                                 "date date, city string, temp_for_analysis double, energy_mwh double")
    long = analysis.usage_heatmap_long(base).collect()
    assert len(long) == 42
    filled = [r for r in long if r.avg_energy_mwh is not None]
    assert len(filled) == 1 and filled[0].day_of_week == "Monday" and filled[0].avg_energy_mwh == 100.0
    wide = analysis.usage_heatmap(base).orderBy("bin_order").collect()
    assert [r.temp_bin for r in wide] == TEMP_BIN_LABELS and wide[1].Monday == 100.0


def test_percent_change_and_texts(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, 0.0), (-5.0, 0.0), (0.0, 0.0), (None, 1.0), (1.0, None)],
                               "e double, p double")
    rows = df.select(pct_change(F.col("e"), F.col("p")).alias("x")).collect()
    vals = [r.x for r in rows]
    assert vals[0] == pytest.approx(10.0) and vals[1] == math.inf and vals[2] == -math.inf
    assert vals[3] is None and vals[4] is None and vals[5] is None
    t = spark.createDataFrame([(0.25, 2.5, 38.6, 1234567.5)], "p double, e double, f double, big double")
    r = t.select(pct_text(F.col("p")).alias("p"), energy_text(F.col("e")).alias("e"),
                 py_float_text(F.col("f")).alias("f"), energy_text(F.col("big")).alias("b")).collect()[0]
    assert r.p == "+0.2% vs yesterday" and r.e == "2 MWh" and r.f == "38.6" and r.b == "1,234,568 MWh"


def test_regression_guards_constant_inputs(spark):
    cols = "temp_for_analysis double, energy_mwh double"
    const_x = spark.createDataFrame([(50.0, 1.0), (50.0, 2.0)], cols)
    r = analysis.ols_correlation(const_x).collect()[0]
    assert r.slope is None and r.r is None
    const_y = spark.createDataFrame([(50.0, 1.0), (60.0, 1.0)], cols)
    r = analysis.ols_correlation(const_y).collect()[0]
    assert r.r2 is None and r.r is None and r.slope == 0.0


def test_regression_line_passes_through_means(spark):
    df = spark.createDataFrame([(50.0, 10.0), (60.0, 30.0), (70.0, 20.0)], "temp_for_analysis double, energy_mwh double")
    pts = analysis.regression_line(df).orderBy("point").collect()
    (x0, y0), (x1, y1) = (pts[0].temp, pts[0].energy_fit), (pts[1].temp, pts[1].energy_fit)
    slope = (y1 - y0) / (x1 - x0)
    assert y0 + slope * (60.0 - x0) == pytest.approx(20.0)


def test_placeholders_and_no_data(spark):
    cd = city_dim(spark, [("A", "S", "st", "PJM"), ("B", "S", "st", "PJM"), ("C", "S", None, "PJM")])
    empty_w = raw_w(spark, [])
    empty_e = raw_e(spark, [])
    m = mst.build_master(empty_w, empty_e, cd).collect()
    assert sorted(r.city for r in m) == ["A", "B", "C"] and all(r.date is None for r in m)
    w = raw_w(spark, [("A", "2024-01-01", "TMAX", 1.0, 1)])
    m = mst.build_master(w, empty_e, cd).collect()
    assert sorted((r.city, r.date) for r in m if r.date) == [("A", D(2024, 1, 1))]
    assert sorted(r.city for r in m if r.date is None) == ["B", "C"]


def test_slug_collision_later_entry_owns_file(spark):
    cd = city_dim(spark, [("New York", "NY", "a"), ("new york", "NY", "b")])
    owners = {r.slug: r.city for r in mst.slug_owners(cd).collect()}
    assert owners == {"new_york": "new york"}


def test_station_tiers_and_ba_mapping(spark):
    st = spark.createDataFrame([
        ("GHCND:USW1", "HOUSTON HOBBY, TX US", 1.0, 1.0, D(2024, 5, 1), "Texas"),
        ("GHCND:USC1", "HOUSTON 2, TX US", 1.0, 1.0, D(2024, 5, 1), "Texas"),
        ("GHCND:USC2", "PHOENIX AP, AZ US", 1.0, 1.0, D(2024, 5, 1), "Arizona"),
        ("GHCND:USW3", "JUNEAU, AK US", 1.0, 1.0, D(2020, 1, 1), "Alaska"),
        ("GHCND:USW4", "SAN ANTONIO, TX US", 1.0, 1.0, D(2020, 1, 1), "Alaska"),
    ], "id string, name string, latitude double, longitude double, maxdate date, state string")
    found = stn.station_search(st, "2024-06-01")
    tiers = sorted((r.state, r.noaa_station_id, r.tier) for r in found.collect())
    assert tiers == [("Alaska", "GHCND:USW3", 3), ("Alaska", "GHCND:USW4", 3),
                     ("Arizona", "GHCND:USC2", 2), ("Texas", "GHCND:USW1", 1)]
    mapped = {r.noaa_station_id: (r.eia_ba_code, r.match_type) for r in stn.station_ba_map(found).collect()}
    assert mapped["GHCND:USW1"] == ("ERCO", "City Match")
    assert mapped["GHCND:USC2"] == ("AZPS", "City Match")
    assert mapped["GHCND:USW4"] == ("None", "State Estimate")  # 'san' token: multi-word keys never match
    assert mapped["GHCND:USW3"] == ("None", "State Estimate")
    tok = spark.createDataFrame([("New York CNTRL PK, NY US",)], "n string").select(
        station_city_token(F.col("n")).alias("t")).collect()[0].t
    assert tok == "new"


def test_active_cutoff_feb29(spark):
    st = spark.createDataFrame([("GHCND:USW1", "X", 0.0, 0.0, D(2023, 2, 28), "Texas")],
                               "id string, name string, latitude double, longitude double, maxdate date, state string")
    assert stn.station_tiers(st, "2024-02-29").collect()[0].tier == 1


def test_run_modes():
    as_of = D(2024, 3, 10)
    assert RunMode(fetch_range=("2024-01-01", "2024-01-31")).resolve(as_of) == (D(2024, 1, 1), D(2024, 1, 31))
    assert RunMode(historical_days=7).resolve(as_of) == (D(2024, 3, 3), as_of)
    assert RunMode(historical_days=0).resolve(as_of) == (D(2023, 3, 11), as_of)   # 0 is falsy -> default
    assert RunMode(daily=True).resolve(as_of) == (D(2024, 3, 9), D(2024, 3, 9))
    assert RunMode().resolve(as_of) == (D(2023, 3, 11), as_of)
    with pytest.raises(ValueError):
        RunMode(fetch_range=("2024/01/01", "x")).resolve(as_of)


def test_geo_latest_global_previous_day(spark):
    rows = [
        (D(2024, 1, 9), 50.0, 40.0, 100.0, "A", 1.0, 1.0, 45.0),
        (D(2024, 1, 10), 50.0, 40.0, 110.0, "A", 1.0, 1.0, 45.0),
        (D(2024, 1, 9), 50.0, 40.0, 0.0, "B", 2.0, 2.0, 45.0),
        (D(2024, 1, 12), 50.0, 40.0, 30.0, "B", 2.0, 2.0, 45.0),
    ]
    base = spark.createDataFrame(rows, "date date, TMAX_F double, TMIN_F double, energy_mwh double, city string, "
                                       "latitude double, longitude double, temp_for_analysis double")
    g = {r.city: r for r in analysis.geo_latest(base).collect()}
    # previous day = min(latest) - 1 = Jan 9, for every city
    assert g["A"].energy_pct_change == pytest.approx(10.0) and g["B"].energy_pct_change == math.inf
    assert g["A"].color_min == 30.0 and g["A"].color_max == 110.0
    v = {r.city: r.energy_prev_day for r in analysis.geo_latest_per_city_prev(base).collect()}
    assert v == {"A": 100.0, "B": None}


def test_quality_messages(spark):
    wd = spark.createDataFrame([("New York", D(2024, 1, 2), 30.2, 38.6)],
                               "city string, date date, TMAX_F double, TMIN_F double")
    r = quality.q_temp_logic(wd, "2024-01-01", "2024-01-31").collect()[0]
    assert r.file == "noaa_new_york_2024-01-01_to_2024-01-31.json"
    assert r.message == "Date 2024-01-02: TMIN (38.6°F) > TMAX (30.2°F)."
    assert r.details == '{"date": "2024-01-02", "tmin_f": 38.6, "tmax_f": 30.2}'


def test_entry_key_presence_not_value(spark):
    from heatgrid.sources.landed import city_dim_from_entries
    cd = city_dim_from_entries(spark, [
        {"name": "A", "noaa_station_id": None, "eia_ba_code": "PJM"},   # keys present: processed
        {"name": "B", "eia_ba_code": "PJM"},                             # key missing: skipped
        {"noaa_station_id": "x"},                                        # no name: skipped
    ])
    assert [r.city for r in clean.valid_cities(cd).collect()] == ["A"]
    assert [r.city for r in clean.energy_cities(cd).collect()] == ["A"]
    names = sorted(r.city for r in mst.configured_names(cd).collect())
    assert names == ["A", "B"]                                           # placeholders still cover B


def test_day_names_and_weekend(spark):
    from heatgrid.functions.temperature import WEEKDAYS, day_name, day_order, is_weekend
    days = [D(2024, 1, 1) + dt.timedelta(days=k) for k in range(7)]   # Monday .. Sunday
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(day_name(F.col("d")).alias("n"), day_order(F.col("d")).alias("o"),
                     is_weekend(F.col("d")).alias("w")).collect()
    assert [r.n for r in rows] == WEEKDAYS and [r.o for r in rows] == list(range(7))
    assert [r.w for r in rows] == [False] * 5 + [True] * 2


def test_coordinate_edit_rejected_as_a_whole(spark):
    text = spark.createDataFrame([("A", "40.5", "-70"), ("B", None, "x1"), ("C", "1", "2")],
                                 "city string, latitude string, longitude string")
    rows = stn.city_dim_cast(text).collect()
    assert all(r.edit_valid is False for r in rows)
    assert [(r.city, r.latitude, r.longitude) for r in rows if r.city == "A"] == [("A", 40.5, -70.0)]
    ok = stn.city_dim_cast(text.filter("city <> 'B'")).collect()
    assert all(r.edit_valid for r in ok)


def test_date_range_must_be_ordered(spark):
    m = spark.createDataFrame([(D(2024, 1, 1), 50.0, 40.0, 1.0, "A")],
                              "date date, TMAX_F double, TMIN_F double, energy_mwh double, city string")
    cd = city_dim(spark, [("A", "S", "st", "PJM", 1.0, 2.0)])
    with pytest.raises(ValueError):
        analysis.analysis_base(m, cd, "2024-02-01", "2024-01-01")
    assert analysis.analysis_base(m, cd, "2024-01-01", "2024-01-01").count() == 1


def test_station_state_needs_fips(spark):
    st = spark.createDataFrame([("GHCND:USW1", "X", 0.0, 0.0, D(2024, 1, 1), "Texas"),
                                ("GHCND:USW2", "Y", 0.0, 0.0, D(2024, 1, 1), "Atlantis")],
                               "id string, name string, latitude double, longitude double, maxdate date, state string")
    assert [r.fips for r in stn.stations_by_state(st, "Texas").collect()] == ["48"]
    assert stn.stations_by_state(st, "Atlantis").count() == 0


def test_append_keeps_duplicates_and_orders_after_config(spark):
    cd = city_dim(spark, [("A", "S", "st", "PJM", 1.0, 2.0)])
    chosen = spark.createDataFrame([("A", "S", "GHCND:USW9", "PJM", 3.0, 4.0)],
                                   "name string, state string, noaa_station_id string, eia_ba_code string, "
                                   "latitude double, longitude double")
    out = stn.city_dim_append(cd, chosen)
    assert out.count() == 2                                              # no dedup
    coords = {r.city: (r.latitude, r.longitude) for r in analysis.coordinates(out).collect()}
    assert coords == {"A": (3.0, 4.0)}                                   # appended entry wins


def test_map_texts_for_zero_previous_day(spark):
    rows = [
        (D(2024, 1, 9), 50.0, 40.0, 0.0, "A", 1.0, 1.0, 45.0),
        (D(2024, 1, 10), 50.0, 40.0, 1500.5, "A", 1.0, 1.0, 45.0),
        (D(2024, 1, 9), 50.0, 40.0, 0.0, "B", 2.0, 2.0, 45.0),
        (D(2024, 1, 10), 50.0, 40.0, None, "B", 2.0, 2.0, 45.0),
    ]
    base = spark.createDataFrame(rows, "date date, TMAX_F double, TMIN_F double, energy_mwh double, city string, "
                                       "latitude double, longitude double, temp_for_analysis double")
    g = {r.city: r for r in analysis.geo_latest(base).collect()}
    assert g["A"].hover_pct_change_text == "+inf% vs yesterday" and g["A"].hover_energy_text == "1,500 MWh"
    assert g["B"].energy_pct_change is None and g["B"].hover_pct_change_text == "No prior day data"
    assert g["B"].hover_energy_text == "Energy data not available" and g["B"].size_for_map == 1000.0
    assert len(analysis.geo_latest(base, city="A").collect()) == 1
