"""Scheduled refresh over the landing folders with an availableNow stream."""

import datetime as dt
import os

from heatgrid.sources import landed, sinks
from heatgrid.streaming.incremental import run_scheduled_refresh

CONFIG = [{"name": "New York", "noaa_station_id": "s1", "eia_ba_code": "NYIS"},
          {"name": "Chicago", "noaa_station_id": "s2", "eia_ba_code": "PJM"}]


def _land(spark, root, w_rows, e_rows, tag):
    w = spark.createDataFrame(w_rows, "city string, date string, datatype string, value double, pos long")
    e = spark.createDataFrame(e_rows, "city string, period string, value string")
    # each scheduled fetch lands into its own run folder under the landing root
    sinks.land_readings(w, os.path.join(root, "noaa", f"run={tag}"))
    sinks.land_readings(e, os.path.join(root, "eia", f"run={tag}"))


def test_each_run_replaces_snapshot_with_new_files(spark, scratch):
    cd = landed.city_dim_from_entries(spark, CONFIG)
    land, out, ckpt = (os.path.join(scratch, x) for x in ("landing", "out", "ckpt"))
    _land(spark, land, [("New York", "2024-01-01", "TMAX", 10.0, 1), ("New York", "2024-01-01", "TMAX", 0.0, 2)],
          [("New York", "2024-01-01", "100")], "1")
    run_scheduled_refresh(spark, os.path.join(land, "noaa"), os.path.join(land, "eia"), cd, out, ckpt)
    m = {(r.city, r.date): (r.TMAX_F, r.energy_mwh) for r in landed.read_master(spark, os.path.join(out, "master")).collect()}
    assert m == {("New York", dt.date(2024, 1, 1)): (50.0, 100.0), ("Chicago", None): (None, None)}
    report = landed.read_quality_report(spark, os.path.join(out, "quality_report")).collect()
    assert [r.check for r in report] == ["Duplicate Raw Data"]

    _land(spark, land, [("Chicago", "2024-01-02", "TMIN", 1.0, 1)], [("Chicago", "2024-01-02", "7")], "2")
    run_scheduled_refresh(spark, os.path.join(land, "noaa"), os.path.join(land, "eia"), cd, out, ckpt)
    m = {(r.city, r.date): (r.TMIN_F, r.energy_mwh) for r in landed.read_master(spark, os.path.join(out, "master")).collect()}
    assert m == {("Chicago", dt.date(2024, 1, 2)): (33.8, 7.0), ("New York", None): (None, None)}


def test_run_without_new_files_keeps_snapshot(spark, scratch):
    cd = landed.city_dim_from_entries(spark, CONFIG)
    land, out, ckpt = (os.path.join(scratch, x) for x in ("landing", "out", "ckpt"))
    _land(spark, land, [("Chicago", "2024-02-01", "TMAX", 0.0, 1)], [("Chicago", "2024-02-01", "5")], "1")
    args = (spark, os.path.join(land, "noaa"), os.path.join(land, "eia"), cd, out, ckpt)
    run_scheduled_refresh(*args)
    def snapshot():
        return sorted((tuple(r) for r in landed.read_master(spark, os.path.join(out, "master")).collect()), key=repr)
    first = snapshot()
    run_scheduled_refresh(*args)                       # nothing new landed
    again = snapshot()
    assert first == again and len(first) == 2
