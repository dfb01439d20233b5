"""The observations FIXTURES.md publishes for sf0.01, checked against our plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from heatgrid.operators import analysis, quality, stations
from heatgrid.plans.inputs import Inputs
from heatgrid.sources.fixtures import STATIONS_AS_OF


class Published(Inputs):
    """The variant whose observations FIXTURES.md publishes: readings of nation 23 and of flag N left out,
    no configured city besides the nations."""

    def raw_weather(self):
        return super().raw_weather().filter("city <> 'NATION_23' and datatype <> 'PRCP'")

    def city_dim(self):
        return super().city_dim().filter("city <> 'UNLANDED CITY'")


@pytest.fixture(scope="module")
def inp(spark):
    return Published(spark, SF01)


def test_every_line_item_is_a_reading(spark):
    full = Inputs(spark, SF01)
    assert full.raw_weather().count() == 60000
    assert full.raw_weather().select("city").distinct().count() == 25
    assert [r.city for r in full.master().filter(F.col("date").isNull()).collect()] == ["UNLANDED CITY"]


def test_refresh_counts(inp):
    assert inp.raw_weather().count() == 39335
    assert quality.duplicate_groups(inp.raw_weather()).count() == 6032
    w = inp.weather_daily()
    assert w.count() == 27071
    assert w.filter(F.col("TMAX_F").isNotNull()).count() == 16081
    assert w.filter(F.col("TMIN_F").isNotNull()).count() == 16155
    assert w.filter("TMIN_F > TMAX_F").count() == 2537
    e = inp.energy_daily()
    assert (e.count(), e.filter("energy_mwh < 0").count(), e.filter("energy_mwh = 0").count()) == (11204, 863, 107)
    m = inp.master()
    assert (m.count(), m.filter(F.col("date").isNotNull()).count(), m.select("city").distinct().count()) == (33448, 33447, 25)
    assert [r.city for r in m.filter(F.col("date").isNull()).collect()] == ["NATION_23"]


def test_analysis_observations(inp):
    ana = inp.base("avg")
    assert ana.count() == 5165 and ana.filter(F.col("energy_mwh").isNotNull()).count() == 892
    r = analysis.ols_correlation(ana).first()
    assert r.slope == pytest.approx(-269.701115, abs=1e-6)
    assert r.intercept == pytest.approx(250525.4617, abs=1e-4)
    assert r.r2 == pytest.approx(0.000485526, abs=1e-9)
    assert r.r == pytest.approx(-0.022034659, abs=1e-9)
    per_bin = {x.bin_order: x["count"] for x in analysis.with_temp_bins(ana).groupBy("bin_order").count().collect()}
    assert [per_bin[k] for k in range(6)] == [1539, 984, 1040, 755, 547, 300]
    assert analysis.weekend_bands(ana).count() == 639
    latest = analysis.latest_per_city(ana)
    b = latest.agg(F.count("*"), F.min("date"), F.max("date")).first()
    assert tuple(b) == (24, dt.date(2001, 6, 24), dt.date(2001, 11, 4))
    assert ana.filter(F.col("date") == dt.date(2001, 6, 23)).count() == 2
    totals = analysis.total_energy_by_date(ana)
    assert totals.count() == 2218
    s = totals.agg(F.sum(F.col("total_energy_mwh").cast("decimal(28,2)"))).first()[0]
    assert float(s) == pytest.approx(208968822.05, abs=0.005)


def test_station_tiers(inp):
    found = stations.station_search(inp.stations(), STATIONS_AS_OF)
    got = {r.state: (r.n, r.tier) for r in found.groupBy("state").agg(F.count("*").alias("n"), F.max("tier").alias("tier")).collect()}
    assert got == {"Alaska": (20, 3), "Arizona": (12, 2), "Atlantis": (6, 1), "New York": (6, 1), "Texas": (6, 1)}
