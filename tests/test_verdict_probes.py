"""Cases on small frames that once lost data or differed from Python's formatting."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from heatgrid.functions import numeric, text
from heatgrid.operators import clean, master as mst, quality
from heatgrid.sources import landed, sinks

CITY = "city string, state string, noaa_station_id string, eia_ba_code string, latitude double, longitude double"


def cities(spark, *rows):
    return landed.city_dim_from_entries(spark, [
        {k: v for k, v in zip(("name", "state", "noaa_station_id", "eia_ba_code", "latitude", "longitude"), r)
         if v is not None} for r in rows])


@pytest.mark.parametrize("values, want", [
    ([1e22, 5.0], 1e22), ([float("-inf"), 7.0], float("-inf")), ([1.005, 2.0, None], 3.0), ([None], 0.0)])
def test_energy_outside_the_decimal_is_not_lost(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(numeric.sum_or_zero(F.col("v"))).first()[0] == want


def test_percent_text_equals_python(spark):
    values = [0.35, 0.45, -0.04, 0.05, 0.25, 0.75, -0.25, 12.5, 99.95, 1234.05, 1e-9, 0.0, 3.0, -17.349999999999998,
              2.0 ** 53, 123456789.25]
    rows = spark.createDataFrame([(v,) for v in values], "p double").select("p", text.pct_text(F.col("p"))).collect()
    assert [r[1] for r in rows] == [f"{v:+.1f}% vs yesterday" for v in values]


def test_a_reading_without_date_stays_under_a_range(spark):
    raw = spark.createDataFrame([("a", dt.date(2024, 1, 2), "TMAX", 100.0, 1), ("a", None, "TMAX", 50.0, 2),
                                 ("a", dt.date(2020, 1, 2), "TMAX", 10.0, 3)],
                                "city string, date date, datatype string, value double, pos long")
    kept = clean.weather_in_range(raw, "2024-01-01", "2024-12-31").collect()
    assert {r.pos for r in kept} == {1, 2}


def test_an_incomplete_entry_owns_no_slug(spark):
    dim = cities(spark, ("New York", "NY", "S1", "NYIS", 1.0, 2.0), ("new york", "NY", None, "NYIS", 1.0, 2.0))
    assert [r.city for r in mst.slug_owners(dim).collect()] == ["New York"]


def test_landing_keeps_the_owners_rows_of_a_slug(spark, scratch):
    dim = cities(spark, ("New York", "NY", "S1", "NYIS", 1.0, 2.0), ("new york", "NY", "S2", "NYIS", 1.0, 2.0))
    df = spark.createDataFrame([("New York", 10.0), ("new york", 20.0)], "city string, value double")
    sinks.land_readings(df, f"{scratch}/noaa", city_dim=dim)
    assert [r.value for r in spark.read.json(f"{scratch}/noaa").collect()] == [20.0]


def test_a_damaged_master_file_is_not_skipped(spark, scratch):
    (spark.createDataFrame([], landed.schemas.MASTER).write.parquet(f"{scratch}/m"))
    with open(f"{scratch}/m/part-bad.parquet", "wb") as f:
        f.write(b"PAR1 not a parquet file")
    with pytest.raises(Exception):
        landed.read_master(spark, f"{scratch}/m").collect()


def test_a_day_without_date_has_a_message(spark):
    df = spark.createDataFrame([("a", None, 1.0, 2.0)], "city string, date date, TMAX_F double, TMIN_F double")
    check = quality.temp_logic_check()
    row = df.filter(check.cond if hasattr(check, "cond") else check[0]).select(
        (check.message if hasattr(check, "message") else check[4]).alias("m"),
        (check.details if hasattr(check, "details") else check[5]).alias("d")).first()
    assert row.m.startswith("Date NaT: TMIN (2.0") and row.d.startswith('{"date": null')
