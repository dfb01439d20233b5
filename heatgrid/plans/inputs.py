"""Shared inputs of the registered queries, built from one data folder.

Each accessor returns a lazy plan over the given tables, so every query's work
grows with the data it reads. Only ``stage`` and ``master_snapshot`` write a
table, for queries that read it more than once.
"""

from __future__ import annotations

import functools
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from heatgrid.operators import analysis, clean, master as mst, stations as stn
from heatgrid.schemas import MASTER_COLUMNS
from heatgrid.session import ensure_checkpoint_dir
from heatgrid.sources import fixtures


def _memo(fn):
    """Build each shared input once per query: one DataFrame object is reused
    wherever the plan needs it (fewer Py4J round trips and table resolutions
    while building, identical subtrees for exchange reuse). Materializing
    inputs (checkpoints) are not memoized."""
    @functools.wraps(fn)
    def wrapper(self, *args, **kwargs):
        key = (fn.__name__, args, tuple(sorted(kwargs.items())))
        if key not in self._cache:
            self._cache[key] = fn(self, *args, **kwargs)
        return self._cache[key]
    return wrapper


@dataclass
class Inputs:
    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict, repr=False)

    # landing tables
    @_memo
    def city_dim(self) -> DataFrame:
        return fixtures.city_dim(self.spark, self.sf_dir)

    @_memo
    def raw_weather(self) -> DataFrame:
        return fixtures.raw_weather(self.spark, self.sf_dir)

    @_memo
    def raw_energy(self) -> DataFrame:
        return fixtures.raw_energy(self.spark, self.sf_dir)

    @_memo
    def stations(self) -> DataFrame:
        return fixtures.stations(self.spark, self.sf_dir)

    @_memo
    def city_list(self) -> DataFrame:
        """Configured cities plus every station the search picks (U5), with its BA."""
        found = stn.station_ba_map(stn.station_search(self.stations(), fixtures.STATIONS_AS_OF))
        return stn.city_dim_append(self.city_dim(), found, self._path("appended-stations"))

    # refresh outputs
    @_memo
    def weather_daily(self) -> DataFrame:
        return clean.weather_daily(self.raw_weather(), self.city_dim())

    @_memo
    def energy_daily(self) -> DataFrame:
        return clean.energy_daily(self.raw_energy(), self.city_dim())

    @_memo
    def merged(self) -> DataFrame:
        return mst.weather_energy_outer(self.weather_daily(), self.energy_daily())

    @_memo
    def master(self) -> DataFrame:
        return mst.master(self.merged(), self.city_dim())

    def stage(self) -> tuple[DataFrame, DataFrame]:
        """The refresh's stage tables: weather keys (materialized) and processed.

        One scan per raw table feeds the daily pivot, the duplicate check and
        every later quality check (as in ``plans.refresh``); the keys are read
        twice (report and pivot), so they are written, while processed is read
        by one pass only.
        """
        keys = self._written("weather-keys", clean.weather_keys(self.raw_weather()))
        weather = clean.weather_daily_from_keys(keys, self.city_dim())
        processed = mst.weather_energy_outer(weather, self.energy_daily())
        return keys, processed

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        """A Parquet table in the session's checkpoint folder (shared storage on a cluster):
        it cuts the lineage to the raw tables and keeps column pruning and pushed filters."""
        path = self._path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _path(self, name: str) -> str:
        return f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def master_snapshot(self) -> DataFrame:
        """The refresh's master as a written table (what the dashboard reads)."""
        return self._written("master", self.master())

    def dated(self, start=None, end=None, city: str | None = None) -> DataFrame:
        """The master's rows with a date, of a range and a city.

        Range and city are group keys of both daily aggregates, so they are
        applied to the raw readings and reach the scans. Placeholders have no
        date, so they need not be made.
        """
        raw_weather, raw_energy = (analysis.select_city(raw, city) for raw in (self.raw_weather(), self.raw_energy()))
        merged = mst.weather_energy_outer(clean.weather_daily(raw_weather, self.city_dim(), start, end),
                                          clean.energy_daily(raw_energy, self.city_dim(), start, end))
        return merged.select(*MASTER_COLUMNS)

    # analysis frames
    def filtered(self, metric: str = "avg", start=None, end=None, master: DataFrame | None = None,
                 city: str | None = None) -> DataFrame:
        m = self.dated(start, end, city) if master is None else master
        return analysis.date_filtered(m, self.city_dim(), start, end, metric)

    def base(self, metric: str = "avg", start=None, end=None, city=None,
             master: DataFrame | None = None) -> DataFrame:
        return analysis.select_city(self.filtered(metric, start, end, master, city), city)
