"""Master table: weather ⟗ energy per city-day plus placeholders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatgrid.functions.text import city_slug
from heatgrid.operators import clean
from heatgrid.schemas import MASTER_COLUMNS


def weather_energy_outer(weather_daily: DataFrame, energy_daily: DataFrame) -> DataFrame:
    """Full outer join on (city, date), the per-city loop as one job.

    Both sides are already aggregated on exactly these keys, so the join
    reuses their hash partitioning instead of shuffling again.
    """
    return weather_daily.join(energy_daily, ["city", "date"], "full_outer")


def configured_names(city_dim: DataFrame) -> DataFrame:
    """Every configured city name (placeholders use all named entries)."""
    return city_dim.filter(F.col("city").isNotNull()).select("city")


def missing_cities(city_dim: DataFrame, merged: DataFrame) -> DataFrame:
    """Configured cities without any merged row (U3); set semantics."""
    return configured_names(city_dim).distinct().join(merged.select("city"), "city", "left_anti")


def master(merged: DataFrame, city_dim: DataFrame) -> DataFrame:
    """Merged rows plus one all-NULL placeholder per missing city.

    Written as ``configured names LEFT JOIN merged``: a city with rows keeps
    them, a city without gets the one NULL row the join emits. ``merged`` is
    read once (an anti join plus union would derive it twice from the raw
    tables, since the pruned second copy cannot reuse the first exchange).
    Merged cities are always configured ones, so no row is lost. The join
    key is the city, but a city has at most one merged row per day, so even
    a city holding a third of all raw readings is a small join partition.
    """
    names = configured_names(city_dim).distinct()
    return names.join(merged, "city", "left").select(*MASTER_COLUMNS)


def master_of_processed(processed: DataFrame, city_dim: DataFrame) -> DataFrame:
    """The written processed table plus placeholders.

    Which cities are there is known from the table's partition folders: that
    scan reads no column, and the rows themselves are not shuffled by city.
    """
    names = configured_names(city_dim).distinct()
    present = processed.select("city").distinct()
    return processed.select(*MASTER_COLUMNS).unionByName(
        names.join(present, "city", "left_anti"), allowMissingColumns=True)


def build_master(raw_weather: DataFrame, raw_energy: DataFrame, city_dim: DataFrame,
                 start=None, end=None) -> DataFrame:
    """The whole refresh as one lazy plan: raw scans -> master."""
    w = clean.weather_daily(raw_weather, city_dim, start, end)
    e = clean.energy_daily(raw_energy, city_dim, start, end)
    return master(weather_energy_outer(w, e), city_dim)


def slug_owners(city_dim: DataFrame) -> DataFrame:
    """``(slug, city)``: when two configured names share a slug (and so one
    landing file), the later-configured one of the complete entries owns it (P7)."""
    return (
        configured_names_with_pos(clean.valid_cities(city_dim))
        .groupBy(city_slug(F.col("city")).alias("slug"))
        .agg(F.max_by("city", "cfg_pos").alias("city"))
    )


def configured_names_with_pos(city_dim: DataFrame) -> DataFrame:
    return city_dim.filter(F.col("city").isNotNull()).select("city", "cfg_pos")
