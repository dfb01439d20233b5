"""Explicit schemas of every table the package reads or writes.

Reading with an explicit schema means a missing JSON field reads as NULL and an
empty ``[]`` file gives zero rows, so no "add the column if absent" step exists.
"""

from pyspark.sql import types as T

# Landed raw weather: long format, one object per (date, datatype) reading.
RAW_WEATHER = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("datatype", T.StringType()),
    T.StructField("value", T.DoubleType()),
    # landing order written by our own landing sink; wide enough for any sequence key
    T.StructField("pos", T.DecimalType(38, 0)),
    T.StructField("_corrupt", T.StringType()),
])

# Landed raw energy: value arrives as text or number; kept as text, coerced later.
RAW_ENERGY = T.StructType([
    T.StructField("period", T.StringType()),
    T.StructField("respondent", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("pos", T.DecimalType(38, 0)),
    T.StructField("_corrupt", T.StringType()),
])

# The landing by spans (months or years): Parquet under slug= and span= folders. ``pos`` is the landing order, ``day``
# the day of the row's text, null where it does not parse, ``landing`` the logical file (``<source>_<slug>_<from>_to_<to>.json``)
# that a row came with. Landings of older versions have ``seq`` in place of ``pos`` and no ``day``.
def _spans(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in (
        *fields, ("day", T.DateType()), ("pos", T.DecimalType(38, 0)), ("seq", T.LongType()), ("landing", T.StringType()), ("slug", T.StringType()),
        ("span", T.StringType()))])


WEATHER_SPANS = _spans(("date", T.StringType()), ("datatype", T.StringType()), ("value", T.DoubleType()))
ENERGY_SPANS = _spans(("period", T.StringType()), ("respondent", T.StringType()), ("value", T.StringType()))

WEATHER_DAILY = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("TMAX_F", T.DoubleType()),
    T.StructField("TMIN_F", T.DoubleType()),
])

ENERGY_DAILY = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("energy_mwh", T.DoubleType()),
])

# Column order of the master table is the reference's processed-file order.
MASTER = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("TMAX_F", T.DoubleType()),
    T.StructField("TMIN_F", T.DoubleType()),
    T.StructField("energy_mwh", T.DoubleType()),
    T.StructField("city", T.StringType()),
])
MASTER_COLUMNS = [f.name for f in MASTER.fields]

CITY_DIM = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("noaa_station_id", T.StringType()),
    T.StructField("eia_ba_code", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("cfg_pos", T.LongType()),
])

# Configuration entries also record whether their required keys are present
# (the reference checks key presence, not values).
CITY_DIM_ENTRIES = T.StructType(CITY_DIM.fields + [T.StructField("entry_complete", T.BooleanType())])

STATIONS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("maxdate", T.DateType()),
    T.StructField("state", T.StringType()),
])

QUALITY_REPORT = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("details", T.StringType()),
])
# One row per landed file of a run: whether it failed as a whole and its duplicate readings.
FILE_VERDICTS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("failed", T.BooleanType()),
    T.StructField("duplicate_groups", T.LongType()),
    T.StructField("duplicate_rows", T.LongType()),
])

QUALITY_COLUMNS = [f.name for f in QUALITY_REPORT.fields]
