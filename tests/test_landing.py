"""Landed-file scans, sinks and the refresh job, in temporary folders."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from heatgrid.functions.dates import RunMode
from heatgrid.operators import analysis, clean
from heatgrid.plans.refresh import refresh
from heatgrid.sources import landed, sinks

CONFIG = [
    {"name": "New York", "state": "New York", "noaa_station_id": "GHCND:USW00094728", "eia_ba_code": "NYIS",
     "latitude": 40.7128, "longitude": -74.006},
    {"name": "Chicago", "state": "Illinois", "noaa_station_id": "GHCND:USW00094846", "eia_ba_code": "PJM",
     "latitude": 41.8781, "longitude": -87.6298},
    {"name": "Anchorage", "state": "Alaska", "noaa_station_id": "GHCND:USW00026451", "eia_ba_code": "None",
     "latitude": 61.2, "longitude": -149.9},
    {"name": "Nowhere", "state": "Texas", "noaa_station_id": "GHCND:USW0000000", "eia_ba_code": "ERCO"},
]
RANGE = ("2024-01-01", "2024-01-03")


def _write(folder, name, payload):
    with open(os.path.join(folder, name), "w") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload))


def _reference_layout(root):
    raw = os.path.join(root, "raw")
    os.makedirs(raw)
    s, e = RANGE
    _write(raw, f"noaa_new_york_{s}_to_{e}.json", [
        {"date": "2024-01-01T00:00:00", "datatype": "TMAX", "value": 10.6},
        {"date": "2024-01-01T00:00:00", "datatype": "TMAX", "value": 99.0},   # duplicate, dropped
        {"date": "2024-01-01T00:00:00", "datatype": "TMIN", "value": 1.0},
        {"date": "2024-01-02T00:00:00", "datatype": "TMAX", "value": -1.0},
        {"date": "2024-01-02T00:00:00", "datatype": "TMIN", "value": 2.0},    # TMIN > TMAX
        {"date": "2024-01-03T00:00:00", "datatype": "PRCP", "value": 4.0},
    ])
    _write(raw, f"noaa_chicago_{s}_to_{e}.json", '[{"date": "2024-01-01T00:00:00", "datatype": "TMAX", "va')
    _write(raw, f"noaa_anchorage_{s}_to_{e}.json", [])
    _write(raw, f"eia_new_york_{s}_to_{e}.json", [
        {"period": "2024-01-01", "value": "1200"}, {"period": "2024-01-01", "value": "n/a"},
        {"period": "2024-01-02", "value": "-5"}, {"period": "2024-01-04", "value": "7"},
    ])
    _write(raw, f"eia_chicago_{s}_to_{e}.json", [{"period": "2024-01-01", "value": 300.5}])
    _write(raw, f"eia_anchorage_{s}_to_{e}.json", [{"period": "2024-01-01", "value": "1"}])  # BA gate
    return raw


def test_reference_layout_scan_and_bad_file(spark, scratch):
    raw = _reference_layout(scratch)
    cd = landed.city_dim_from_entries(spark, CONFIG)
    w = landed.read_weather(spark, raw, cd, multi_line=True)
    assert {r.city for r in w.collect()} == {"New York", "Chicago"}
    daily = {(r.city, r.date): (r.TMAX_F, r.TMIN_F) for r in clean.weather_daily(w, cd).collect()}
    # Chicago's truncated file fails as a whole; New York keeps the first TMAX
    assert daily == {("New York", dt.date(2024, 1, 1)): (51.08, 33.8),
                     ("New York", dt.date(2024, 1, 2)): (30.2, 35.6),
                     ("New York", dt.date(2024, 1, 3)): (None, None)}


def test_refresh_end_to_end(spark, scratch):
    raw = _reference_layout(scratch)
    cd = landed.city_dim_from_entries(spark, CONFIG)
    out = os.path.join(scratch, "out")
    paths = refresh(spark, raw, raw, cd, out, RunMode(fetch_range=RANGE), multi_line=True)
    master = landed.read_master(spark, paths["master"]).collect()
    keys = [(r.city, r.date) for r in master]
    assert len(keys) == len(set(keys))
    # every configured city is present; written order is city, date with NULLs first
    assert {r.city for r in master} == {c["name"] for c in CONFIG}
    assert keys == sorted(keys, key=lambda k: (k[0], (k[1] is not None, k[1])))
    ny = {r.date: r.energy_mwh for r in master if r.city == "New York"}
    assert ny[dt.date(2024, 1, 1)] == 1200.0 and ny[dt.date(2024, 1, 2)] == -5.0
    assert dt.date(2024, 1, 4) not in ny                                  # outside the run range
    chicago = [r for r in master if r.city == "Chicago"]
    assert [(r.date, r.TMAX_F, r.energy_mwh) for r in chicago] == [(dt.date(2024, 1, 1), None, 300.5)]
    assert [r.date for r in master if r.city == "Anchorage"] == [None]    # BA gate + empty file

    report = landed.read_quality_report(spark, paths["quality_report"]).collect()
    checks = sorted((r.check, r.level, r.file) for r in report)
    assert checks == [
        ("Data Pivoting", "ERROR", "noaa_chicago_2024-01-01_to_2024-01-03.json"),
        ("Duplicate Raw Data", "WARNING", "noaa_new_york_2024-01-01_to_2024-01-03.json"),
        ("Negative Energy", "WARNING", "eia_new_york_2024-01-01_to_2024-01-03.json"),
        ("Temperature Logic", "WARNING", "noaa_new_york_2024-01-01_to_2024-01-03.json"),
    ]
    dup = [r for r in report if r.check == "Duplicate Raw Data"][0]
    assert json.loads(dup.details) == {"duplicate_groups": 1, "duplicate_rows": 2}


def test_own_landing_layout_round_trip(spark, scratch):
    cd = landed.city_dim_from_entries(spark, CONFIG)
    rows = [("New York", "2024-01-01", "TMAX", 5.0, 2), ("New York", "2024-01-01", "TMAX", 7.0, 1),
            ("New York", "2024-01-01", "TMIN", 1.0, 3)]
    df = spark.createDataFrame(rows, "city string, date string, datatype string, value double, pos long")
    root = os.path.join(scratch, "landing", "noaa")
    sinks.land_readings(df, root)
    back = landed.read_weather(spark, root, cd)
    got = clean.weather_daily(back, cd).collect()
    assert [(r.city, r.TMAX_F) for r in got] == [("New York", 44.6)]      # pos 1 wins


def test_master_csv_and_export_round_trip(spark, scratch):
    m = spark.createDataFrame([(dt.date(2024, 1, 1), 50.0, 40.0, 10.0, "A"), (None, None, None, None, "B")],
                              "date date, TMAX_F double, TMIN_F double, energy_mwh double, city string")
    p = os.path.join(scratch, "master_csv")
    sinks.write_master(m, p, "csv")
    back = landed.read_master(spark, p, "csv").collect()
    assert [(r.city, r.date) for r in back] == [("A", dt.date(2024, 1, 1)), ("B", None)]
    cd = landed.city_dim_from_entries(spark, [{"name": "A", "noaa_station_id": "x", "latitude": "1.5",
                                               "longitude": 2}])
    base = analysis.analysis_base(m, cd, metric="avg")
    e = os.path.join(scratch, "export")
    sinks.write_filtered_export(base, e)
    rows = spark.read.option("header", "true").csv(e).collect()
    assert len(rows) == 1 and rows[0].temp_for_analysis == "45.0" and rows[0].latitude == "1.5"


def test_range_filter_keeps_bad_rows_for_file_check(spark):
    raw = spark.createDataFrame([("A", "2024-01-01", "TMAX", 1.0, 1), ("A", "garbage", "TMAX", 1.0, 2),
                                 ("B", "2025-01-01", "TMAX", 1.0, 3)],
                                "city string, date string, datatype string, value double, pos long")
    kept = clean.weather_in_range(raw, "2024-01-01", "2024-12-31")
    assert sorted(r.date for r in kept.collect()) == ["2024-01-01", "garbage"]
    assert clean.weather_daily(kept).count() == 0                       # A's file failed as a whole
    assert clean.weather_daily(raw.filter(F.col("city") == "B")).count() == 1


def test_slug_collision_through_landing(spark, scratch):
    # two configured names share the file noaa_new_york_...: the later one owns it,
    # the earlier becomes a placeholder
    cfg = [{"name": "New York", "noaa_station_id": "a", "eia_ba_code": "NYIS"},
           {"name": "new york", "noaa_station_id": "b", "eia_ba_code": "NYIS"}]
    raw = os.path.join(scratch, "raw")
    os.makedirs(raw)
    _write(raw, "noaa_new_york_2024-01-01_to_2024-01-01.json",
           [{"date": "2024-01-01T00:00:00", "datatype": "TMAX", "value": 0.0}])
    cd = landed.city_dim_from_entries(spark, cfg)
    out = os.path.join(scratch, "out")
    paths = refresh(spark, raw, raw, cd, out, RunMode(fetch_range=("2024-01-01", "2024-01-01")), multi_line=True)
    rows = {(r.city, r.date, r.TMAX_F) for r in landed.read_master(spark, paths["master"]).collect()}
    assert rows == {("new york", dt.date(2024, 1, 1), 32.0), ("New York", None, None)}


def test_station_catalogue_round_trip(spark, scratch):
    from heatgrid.operators import stations
    path = os.path.join(scratch, "stations")
    os.makedirs(path)
    _write(path, "part-0.json", "\n".join(json.dumps(r) for r in [
        {"id": "GHCND:USW00012960", "name": "HOUSTON INTERCONTINENTAL AIRPORT, TX US", "latitude": 29.98,
         "longitude": -95.36, "maxdate": "2024-05-30", "state": "Texas"},
        {"id": "GHCND:USC00414300", "name": "HOUSTON WESTBURY, TX US", "latitude": 29.66,
         "longitude": -95.5, "maxdate": "2024-05-30", "state": "Texas"},
    ]))
    st = landed.read_stations(spark, path)
    found = stations.station_ba_map(stations.station_search(st, "2024-06-01")).collect()
    assert [(r.noaa_station_id, r.eia_ba_code, r.match_type) for r in found] == [
        ("GHCND:USW00012960", "ERCO", "City Match")]


def test_energy_of_other_respondents_is_left_out(spark, scratch):
    cities = landed.city_dim_from_entries(spark, [
        {"name": "A", "state": "S", "noaa_station_id": "G1", "eia_ba_code": "BA1", "latitude": 1, "longitude": 1}])
    rows = [("BA1", "1"), ("BA2", "20"), (None, "300"), ("BA1", "4000")]
    raw = spark.createDataFrame([("A", "2024-01-01", r, v) for r, v in rows],
                                "city string, period string, respondent string, value string")
    sinks.land_readings(raw, scratch + "/eia")
    got = clean.energy_daily(landed.read_energy(spark, scratch + "/eia", cities), cities).collect()
    assert [(r.city, r.energy_mwh) for r in got] == [("A", 4301.0)]


def _city(name, **more):
    return {"name": name, "state": "S", "noaa_station_id": f"G{name}", "eia_ba_code": "BA1", "latitude": 1,
            "longitude": 1, **more}


def _refresh(spark, scratch, raw, cities, fetch_range, **kw):
    cd = landed.city_dim_from_entries(spark, cities)
    paths = refresh(spark, raw, raw, cd, os.path.join(scratch, "out"), RunMode(fetch_range=fetch_range),
                    multi_line=True, **kw)
    master = {(r.city, r.date): (r.TMAX_F, r.energy_mwh) for r in landed.read_master(spark, paths["master"]).collect()}
    report = landed.read_quality_report(spark, paths["quality_report"]).collect()
    return master, sorted((r.check, r.file) for r in report)


def test_files_of_other_ranges_are_not_read(spark, scratch):
    _write(scratch, "noaa_a_2024-01-01_to_2024-12-31.json", [{"date": "2024-03-01", "datatype": "TMAX", "value": 10}])
    _write(scratch, "noaa_a_2020-01-01_to_2020-12-31.json", '[{"date": "2020-03-01", "datatype"')
    _write(scratch, "eia_a_2020-01-01_to_2020-12-31.json", '[{"period": "2020')
    _write(scratch, "eia_a_2024-01-01_to_2024-12-31.json", [{"period": "2024-03-01", "value": "7"}])
    master, report = _refresh(spark, scratch, scratch, [_city("A")], ("2024-01-01", "2024-12-31"))
    assert master == {("A", dt.date(2024, 3, 1)): (50.0, 7.0)} and report == []
    # a run over both years names the file that failed; the sound file of the same city stays
    master, report = _refresh(spark, scratch, scratch, [_city("A")], ("2020-01-01", "2024-12-31"))
    assert master == {("A", dt.date(2024, 3, 1)): (50.0, 7.0)}
    assert report == [("Data Pivoting", "noaa_a_2020-01-01_to_2020-12-31.json")]


def test_a_day_comes_from_one_file(spark, scratch):
    _write(scratch, "noaa_a_2024-01-01_to_2024-01-31.json", [
        {"date": "2024-01-05", "datatype": "TMAX", "value": 0}, {"date": "2024-01-20", "datatype": "TMAX", "value": 10},
        {"date": "2024-01-21", "datatype": "TMAX", "value": 20}])
    _write(scratch, "eia_a_2024-01-01_to_2024-01-31.json", [{"period": "2024-01-05", "value": 1},
                                                            {"period": "2024-01-20", "value": 2}])
    _write(scratch, "noaa_a_2024-01-20_to_2024-02-10.json", [{"date": "2024-01-20", "datatype": "TMAX", "value": 30}])
    _write(scratch, "eia_a_2024-01-20_to_2024-02-10.json", [{"period": "2024-01-20", "value": 40}])
    for k, name in enumerate(sorted(os.listdir(scratch))):
        os.utime(os.path.join(scratch, name), (k, 10 ** 9 + ("2024-01-20_" in name)))
    master, _ = _refresh(spark, scratch, scratch, [_city("A")], ("2024-01-02", "2024-02-28"))
    # the file modified last owns 20 January to 10 February; it has nothing for the 21st
    assert master == {("A", dt.date(2024, 1, 5)): (32.0, 1.0), ("A", dt.date(2024, 1, 20)): (86.0, 40.0)}
    # a file of exactly the run's range is the run's own file
    master, _ = _refresh(spark, scratch, scratch, [_city("A")], ("2024-01-01", "2024-01-31"))
    assert master[("A", dt.date(2024, 1, 20))] == (50.0, 2.0)


def test_no_landed_file_gives_placeholders(spark, scratch):
    os.makedirs(os.path.join(scratch, "raw"))
    master, report = _refresh(spark, scratch, os.path.join(scratch, "raw"), [_city("A")], ("2024-01-01", "2024-01-31"))
    assert master == {("A", None): (None, None)} and report == []


def test_a_damaged_processed_file_loses_its_city_only(spark, scratch):
    from heatgrid.plans.refresh import refresh_raw
    w = spark.createDataFrame([(c, dt.date(2024, 1, 1), "TMAX", 0.0, 1) for c in ("A", "B b/ü", "C")],
                              "city string, date date, datatype string, value double, pos long")
    e = spark.createDataFrame([], "city string, period date, value string")
    cd = landed.city_dim_from_entries(spark, [_city(c) for c in ("A", "B b/ü", "C")])

    def damage(path):
        folder, = [d for d in os.listdir(path) if d.startswith("city=B")]
        for f in os.listdir(os.path.join(path, folder)):
            full = os.path.join(path, folder, f)
            if f.endswith(".parquet"):
                size = os.path.getsize(full)
                with open(full, "r+b") as out:
                    out.truncate(size // 2)
            elif f.endswith(".crc"):
                os.unlink(full)
    paths = refresh_raw(w, e, cd, os.path.join(scratch, "out"), after_processed=damage)
    rows = {(r.city, r.date) for r in landed.read_master(spark, paths["master"]).collect()}
    assert rows == {("A", dt.date(2024, 1, 1)), ("C", dt.date(2024, 1, 1)), ("B b/ü", None)}
    report = landed.read_quality_report(spark, paths["quality_report"]).collect()
    assert [(r.check, r.level, json.loads(r.details)) for r in report] == [
        ("Processed File", "ERROR", {"city": "B b/ü"})]
    assert [r.city for r in spark.read.parquet(paths["quarantine"]).collect()] == ["B b/ü"]


def test_spans_are_pruned_and_landed_again(spark, scratch):
    rows = [("New York", f"2024-{m:02d}-{d:02d}", "TMAX", float(m), 100 * d - m) for m in range(1, 13) for d in (1, 2)]
    rows += [("Chicago", "2023-12-31", "TMIN", 1.0, 1), ("Chicago", None, "TMIN", 2.0, 2)]
    kinds = "city string, date string, datatype string, value double, pos long"
    cd = landed.city_dim_from_entries(spark, CONFIG)
    root = os.path.join(scratch, "noaa")
    sinks.land_spans(spark.createDataFrame(rows, kinds), root, "noaa", cd, "2023-12-31", "2024-12-31")
    june = landed.read_weather(spark, root, cd, layout="spans", start="2024-06-01", end="2024-06-30")
    plan = june._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "span" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted((r.city, r.date) for r in june.collect() if r.date) == [("New York", "2024-06-01"), ("New York", "2024-06-02")]
    before = {d: os.listdir(os.path.join(root, "slug=new_york", d)) for d in os.listdir(os.path.join(root, "slug=new_york"))}
    again = [("New York", "2024-06-03", "TMAX", 9.0, 1), ("New York", "2024-06-03", "TMAX", 8.0, 0)]
    sinks.land_spans(spark.createDataFrame(again, kinds), root, "noaa", cd, "2024-06-01", "2024-06-30")
    after = {d: os.listdir(os.path.join(root, "slug=new_york", d)) for d in os.listdir(os.path.join(root, "slug=new_york"))}
    assert {d for d in before if before[d] != after[d]} == {"span=2024-06"}
    june = landed.read_weather(spark, root, cd, layout="spans", start="2024-06-01", end="2024-06-30")
    got = clean.weather_daily(june, cd).filter("date is not null").collect()
    assert [(r.city, str(r.date), r.TMAX_F) for r in got] == [("New York", "2024-06-03", 46.4)]     # pos 0 is first


def test_a_run_killed_midway_leaves_the_old_snapshot(spark, scratch, monkeypatch):
    from heatgrid.plans import refresh as job
    out = os.path.join(scratch, "out")
    cd = landed.city_dim_from_entries(spark, [_city("A")])
    e = spark.createDataFrame([], "city string, period date, value string")

    def run(value):
        w = spark.createDataFrame([("A", dt.date(2024, 1, 1), "TMAX", value, 1)],
                                  "city string, date date, datatype string, value double, pos long")
        return job.refresh_raw(w, e, cd, out)
    read = lambda: [r.TMAX_F for r in landed.read_master(spark, os.path.join(out, "master")).collect()]
    run(0.0)
    assert read() == [32.0]
    write = sinks.write_quality_report

    def killed(*_):
        raise RuntimeError("killed")
    monkeypatch.setattr(sinks, "write_quality_report", killed)
    try:
        run(10.0)
    except RuntimeError:
        pass
    assert read() == [32.0]
    monkeypatch.setattr(sinks, "write_quality_report", write)
    for value in (20.0, 30.0, 40.0):
        run(value)
    assert read() == [104.0]
    assert len(os.listdir(os.path.join(out, "versions"))) == 2         # older versions and the killed run's are gone
    assert not [t for v in os.listdir(os.path.join(out, "versions"))
                for t in os.listdir(os.path.join(out, "versions", v)) if t.startswith("stage")]


def test_summary_answers_what_the_master_would(spark, scratch):
    from heatgrid.operators import quality, summary
    from heatgrid.plans.refresh import refresh_raw
    w = spark.createDataFrame([("A", dt.date(2024, 1, d), "TMAX", 0.0, d) for d in (1, 2)]
                              + [("B", dt.date(2024, 2, 1), "TMIN", 5.0, 9), ("B", None, "TMIN", 5.0, 10)],
                              "city string, date date, datatype string, value double, pos long")
    e = spark.createDataFrame([("A", dt.date(2024, 1, 2), "3")], "city string, period date, value string")
    cd = landed.city_dim_from_entries(spark, [_city("A"), _city("B"), _city("C")])
    paths = refresh_raw(w, e, cd, os.path.join(scratch, "out"))
    master = landed.read_master(spark, paths["master"])
    kept = spark.read.parquet(paths["city_summary"])
    same = lambda a, b: sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    assert same(summary.date_bounds(kept), analysis.date_bounds(master))
    assert same(summary.city_list(kept), analysis.city_list(master))
    assert same(summary.missing_values(kept), quality.q_missing_values(master))
    assert same(summary.freshness(kept, "2024-12-31"), quality.q_freshness(master, "2024-12-31"))
    parts = [summary.city_summary(master.filter(c)) for c in ("date < '2024-01-02'", "not (date < '2024-01-02') or date is null")]
    assert same(summary.merged(*parts), kept)


def _span_rows(spark):
    rows = [(c, f"{y}-0{m}-0{d}", t, float(d), (1 << 80) + k * 1000 - y)
            for k, (c, y, m, d, t) in enumerate((c, y, m, d, t) for c in ("New York", "Chicago") for y in (2001, 2002)
                                                for m in (1, 2) for d in (1, 2, 3) for t in ("TMAX", "TMIN"))]
    rows += [(c, d, t, v + 50, p - 1) for c, d, t, v, p in rows[::3]] + [("Chicago", "no day", "TMAX", 1.0, 5)]
    df = spark.createDataFrame([(*r[:4], str(r[4])) for r in rows],
                               "city string, date string, datatype string, value double, pos string")
    return rows, df.withColumn("pos", F.col("pos").cast("decimal(38,0)"))


def test_spans_are_landed_in_one_pass_and_keep_their_order(spark, scratch):
    rows, df = _span_rows(spark)
    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value
    cd = landed.city_dim_from_entries(spark, CONFIG)
    root = os.path.join(scratch, "noaa")
    sinks.land_spans(df.repartition(4).withColumn("value", F.udf(count, "double")("value")), root, "noaa", cd,
                     "2001-01-01", "2002-12-31", grain="year")
    assert seen.value == len(rows)                                      # a sample of the ranges read all rows before
    back = landed.read_weather(spark, root, cd, layout="spans", start="2001-01-01", end="2002-12-31")
    assert sorted((r.city, r.date, r.datatype, r.value, int(r.pos)) for r in back.collect()) == sorted(rows)
    first = {}
    for c, d, t, v, p in sorted(rows, key=lambda r: r[4]):
        first.setdefault((c, d, t), v)
    got = {(r.city, str(r.date), r.datatype): r.value for r in clean.weather_dedup(back).collect()}
    assert got == {(c, "None" if d == "no day" else d, t): v for (c, d, t), v in first.items()}
    assert [r.city for r in clean.failed_files(clean.weather_keys(back)).collect()] == ["Chicago"]


def test_days_of_landed_spans_are_not_parsed_again(spark, scratch):
    _, df = _span_rows(spark)
    cd = landed.city_dim_from_entries(spark, CONFIG)
    root = os.path.join(scratch, "noaa")
    sinks.land_spans(df, root, "noaa", cd, grain="year")
    days = {(r.date, r.day) for r in spark.read.parquet(root).select("date", "day").collect()}
    assert len(days) == 13 and ("no day", None) in days and ("2001-02-03", dt.date(2001, 2, 3)) in days
    back = landed.read_weather(spark, root, cd, layout="spans", start="2001-02-01", end="2001-12-31")
    kept = clean.weather_in_range(back, "2001-02-01", "2001-12-31")
    assert {r.date for r in kept.collect()} == {"2001-02-01", "2001-02-02", "2001-02-03", "no day"}


def test_spans_landed_by_older_versions_are_read(spark, scratch):
    rows = [("2001-01-01", "TMAX", 7.0, 1), ("2001-01-01", "TMAX", 5.0, 0), ("2001-01-02", "TMIN", 1.0, 2)]
    old = spark.createDataFrame(rows, "date string, datatype string, value double, seq long")
    root = os.path.join(scratch, "noaa")
    (old.selectExpr("*", "'noaa_new_york_2001-01-01_to_2001-12-31.json' as landing", "'new_york' as slug", "'2001' as span")
     .write.partitionBy("slug", "span").parquet(root))
    cd = landed.city_dim_from_entries(spark, CONFIG)
    back = landed.read_weather(spark, root, cd, layout="spans", start="2001-01-01", end="2001-12-31")
    got = clean.weather_daily(back, cd).collect()
    assert sorted((r.city, str(r.date), r.TMAX_F, r.TMIN_F) for r in got) == [
        ("New York", "2001-01-01", 41.0, None), ("New York", "2001-01-02", None, 33.8)]


def test_span_names_are_those_of_date_format(spark):
    from heatgrid.functions.dates import span_of
    days = spark.sql("select explode(array(date'0001-01-01', date'0000-05-05', date'-0007-02-03', date'0476-09-04',"
                     " date'2024-12-31', date'9999-01-01', date'+12345-10-01', cast(null as date))) as day")
    for grain, pattern in (("year", "yyyy"), ("month", "yyyy-MM")):
        rows = days.select(span_of(F.col("day"), grain), F.date_format("day", pattern)).collect()
        assert len(rows) == 8 and all(a == b for a, b in rows)


def test_landing_order_packs_all_keys(spark):
    from heatgrid.sources.fixtures import landing_order
    most = (2 ** 44 - 1, 2 ** 35 - 1, 2 ** 30 - 1, 7, 81.91)
    keys = [(0, 0, 0, 0, 0.0), most, (1, 2 ** 19 - 1, 5, 3, 50.0), (1, 2 ** 19, 5, 3, 50.0), (2 ** 43 + 9, 2 ** 34 + 1, 2 ** 29 + 3, 1, 0.29),
            (7, 8, 9, 2, -3.5), (7, 8, 9, 2, 123456.78)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"
    got = spark.createDataFrame(keys, names).select(*(n.split()[0] for n in names.split(", ")), landing_order().alias("pos")).collect()
    for o, p, s, n, q, pos in got:
        assert int(pos) == (((o * 8 + n) * 2 ** 35 + p) * 2 ** 30 + s) * 2 ** 13 + round(q * 100)
