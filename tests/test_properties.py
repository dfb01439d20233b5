"""Properties of the refresh and the views, on the fixture and on random inputs."""

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from heatgrid.operators import analysis, clean
from heatgrid.plans.inputs import Inputs


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF001)


def test_master_keys_unique_and_complete(inputs):
    m = inputs.master()
    assert m.groupBy("city", "date").count().filter("count > 1").count() == 0
    configured = {r.city for r in inputs.city_dim().collect()}
    assert {r.city for r in m.select("city").distinct().collect()} == configured
    w = inputs.weather_daily().select("city", "date")
    e = inputs.energy_daily().select("city", "date")
    keys = w.union(e).distinct().count()
    placeholders = m.filter(F.col("date").isNull()).count()
    assert m.count() == keys + placeholders


def test_heatmap_cells_reproduce_overall_mean(inputs):
    base = inputs.base("avg")
    with_e = base.filter(F.col("energy_mwh").isNotNull())
    overall = with_e.agg(F.avg("energy_mwh")).first()[0]
    counts = analysis.with_temp_bins(with_e).groupBy(
        "bin_order", F.weekday("date").alias("day_order")).count()
    cells = analysis.usage_heatmap_long(base).join(counts, ["bin_order", "day_order"])
    total = sum(r["count"] for r in cells.collect())
    weighted = sum(r.avg_energy_mwh * r["count"] for r in cells.collect()) / total
    assert abs(weighted - overall) <= 0.5      # each cell is rounded to 0 decimals


def test_regression_line_through_means(inputs):
    base = inputs.base("avg")
    pairs = base.filter(F.col("energy_mwh").isNotNull())
    mx, my = pairs.agg(F.avg("temp_for_analysis"), F.avg("energy_mwh")).first()
    p = analysis.regression_line(base).orderBy("point").collect()
    slope = (p[1].energy_fit - p[0].energy_fit) / (p[1].temp - p[0].temp)
    assert p[0].energy_fit + slope * (mx - p[0].temp) == pytest.approx(my, rel=1e-6)


# ------------------------------------------------------------- brute force
DAYS = [None, "2024-01-01", "2024-01-02", "2024-01-03T06:00:00"]
TYPES = ["TMAX", "TMIN", "PRCP"]
reading = st.tuples(st.sampled_from(["A", "B"]), st.sampled_from(DAYS), st.sampled_from(TYPES),
                    st.one_of(st.none(), st.integers(-400, 400).map(lambda x: x / 10)))


def _f(c):
    return None if c is None else round(c * 9 / 5 + 32, 2)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(reading, max_size=25))
def test_weather_daily_matches_brute_force(spark, rows):
    data = [(c, d, t, v, i) for i, (c, d, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "city string, date string, datatype string, value double, pos long")
    first = {}
    for c, d, t, v, i in data:                       # keep first in landing order
        day = None if d is None else dt.date.fromisoformat(d[:10])
        first.setdefault((c, day, t), v)
    expect = defaultdict(lambda: [None, None])
    for (c, day, t), v in first.items():
        slot = expect[(c, day)]
        if t == "TMAX":
            slot[0] = _f(v)
        elif t == "TMIN":
            slot[1] = _f(v)
    got = {(r.city, r.date): [r.TMAX_F, r.TMIN_F] for r in clean.weather_daily(df).collect()}
    assert got == dict(expect)
    staged = {(r.city, r.date): [r.TMAX_F, r.TMIN_F]
              for r in clean.weather_daily_from_keys(clean.weather_keys(df)).collect()}
    assert staged == dict(expect)


energy = st.tuples(st.sampled_from(["A", "B"]), st.sampled_from(DAYS),
                   st.one_of(st.none(), st.just("n/a"), st.decimals(-1000, 1000, places=3).map(str)))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(energy, max_size=25))
def test_energy_daily_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "city string, period string, value string")
    sums = {}
    for c, d, v in rows:
        if d is None:
            continue
        key = (c, dt.date.fromisoformat(d[:10]))
        sums.setdefault(key, Decimal(0))
        try:
            sums[key] += Decimal(v)
        except Exception:
            pass
    expect = {k: float(v.quantize(Decimal("0.01"), rounding=ROUND_HALF_EVEN)) for k, v in sums.items()}
    got = {(r.city, r.date): r.energy_mwh for r in clean.energy_daily(df).collect()}
    assert got == expect
