"""Station search and onboarding.

The station catalogue is a landed table; searching it is a filter, a
per-state tier aggregate and a join back. BA mapping is two left joins
against fixed lookup tables (≤100 rows each, broadcast).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatgrid.functions.text import station_city_token
from heatgrid.operators.numbering import numbered
from heatgrid.session import ensure_checkpoint_dir
from heatgrid.sources import lookups

MAJOR_PREFIX = "GHCND:USW"  # fixed value: id prefix of major stations
CITY_MATCH, STATE_ESTIMATE, NO_MATCH, NO_BA = "City Match", "State Estimate", "No Match", "N/A"


def stations_by_state(stations: DataFrame, state: str) -> DataFrame:
    """Stations of one state; a state without a FIPS code finds nothing."""
    fips = F.broadcast(lookups.fips_table(stations.sparkSession))
    return stations.filter(F.col("state") == state).join(fips, "state")


def station_tiers(stations: DataFrame, as_of) -> DataFrame:
    """Tier per station (F8, F9): 1 active major, 2 active, 3 inactive.

    Active means ``maxdate >= as_of - 1 year`` with ``as_of`` a timestamp
    (a date means midnight); Feb 29 minus a year is Feb 28.
    """
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.expr("INTERVAL 1 YEAR")
    active = F.col("maxdate").cast("timestamp_ntz") >= cutoff
    major = F.col("id").startswith(MAJOR_PREFIX)
    return stations.withColumn("tier", F.when(active & major, 1).when(active, 2).otherwise(3))


def station_search(stations: DataFrame, as_of) -> DataFrame:
    """Tiered fallback per state (F10): major-and-active, else active, else all."""
    t = station_tiers(stations, as_of)
    best = t.groupBy("state").agg(F.min("tier").alias("best_tier"))
    return (
        t.join(best, "state")
        .filter(F.col("tier") == F.col("best_tier"))
        .select("state", F.col("id").alias("noaa_station_id"), "name", "latitude", "longitude", "tier")
    )


def station_ba_map(found: DataFrame) -> DataFrame:
    """BA code per found station (J5): city token, else state, else N/A.

    The token is one word, so multi-word city keys can never match.
    """
    spark = found.sparkSession
    city_ba = F.broadcast(lookups.city_ba_table(spark))
    state_ba = F.broadcast(lookups.state_ba_table(spark))
    df = (
        found.withColumn("city_token", station_city_token(F.col("name")))
        .withColumn("state_key", F.lower(F.col("state")))
        .join(city_ba, "city_token", "left")
        .join(state_ba, "state_key", "left")
    )
    return df.select(
        *found.columns,
        F.coalesce("city_ba", "state_ba", F.lit(NO_BA)).alias("eia_ba_code"),
        F.when(F.col("city_ba").isNotNull(), F.lit(CITY_MATCH))
        .when(F.col("state_ba").isNotNull(), F.lit(STATE_ESTIMATE))
        .otherwise(F.lit(NO_MATCH)).alias("match_type"),
    )


def city_dim_append(city_dim: DataFrame, chosen: DataFrame, path: str | None = None) -> DataFrame:
    """Append chosen stations to the city list, no dedup.

    The (editable) station name becomes the city name. Appended entries get
    configuration positions after every existing one, gapless, by station id
    and then by their other columns, whatever the layout of ``chosen``; the
    numbered stations are written under ``path`` (default: a new folder of the
    session's checkpoint folder).
    """
    path = path or f"{ensure_checkpoint_dir(city_dim.sparkSession).rstrip('/')}/appended-stations-{uuid.uuid4().hex}"
    columns = ["noaa_station_id", "name", "state", "eia_ba_code", "latitude", "longitude"]
    placed = numbered(chosen.select(*columns), columns, [], "place", path)
    top = city_dim.agg(F.coalesce(F.max("cfg_pos"), F.lit(-1))).scalar()  # scalar subquery
    added = placed.select(F.col("name").alias("city"), "state", "noaa_station_id", "eia_ba_code", "latitude",
                          "longitude", (top + F.col("place")).cast("long").alias("cfg_pos"))
    if "entry_complete" in city_dim.columns:
        added = added.withColumn("entry_complete", F.lit(True))
    return city_dim.unionByName(added)


def city_dim_cast(city_dim_text: DataFrame) -> DataFrame:
    """Coordinates given as text -> double.

    An edit whose non-NULL coordinate does not parse is rejected as a whole:
    ``edit_valid`` is one flag for all rows.
    """
    lat = F.col("latitude").try_cast("double")
    lon = F.col("longitude").try_cast("double")
    ok_row = ((F.col("latitude").isNull() | lat.isNotNull())
              & (F.col("longitude").isNull() | lon.isNotNull()))
    flag = city_dim_text.agg(F.coalesce(F.bool_and(ok_row), F.lit(True))).scalar()  # scalar subquery
    return (
        city_dim_text.withColumn("latitude", lat).withColumn("longitude", lon)
        .withColumn("edit_valid", flag)
    )
