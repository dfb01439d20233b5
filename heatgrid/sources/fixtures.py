"""Landing tables derived from the given star-schema tables.

The weather/energy application lands raw readings per configured city. For
testing at any scale the same shapes are derived, with Spark, from the given
tables (see FIXTURES.md): nations are the configured cities, line items are
weather readings of the supplier's city, orders are energy records of the
customer's city and suppliers are weather stations. All four grow with the
data; only ``nation``/``region`` are fixed size (25 and 5 rows by the TPC-H
specification), which is why they are the only explicitly broadcast sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatgrid.schemas import CITY_DIM
from heatgrid.sources.local import local_table
from heatgrid.sources.tables import read_table

# Fixed values of the test fixture (FIXTURES.md): the configured city without
# data, the placeholder BA rule and the nation without latitude.
NO_DATA_CITY = ("UNLANDED CITY", "NOWHERE", "GHCND:USW00000099", "N/A", None, None, 25)
NA_BA_MODULUS, NA_BA_REMAINDER = 6, 5
NO_LATITUDE_NATION = 24


def _nation_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nation has 25 rows by specification: a proven broadcast bound
    return F.broadcast(read_table(spark, sf_dir, "nation", "n_nationkey", "n_name"))


def city_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured cities: one per nation, in nation-key (configuration) order, and one without data."""
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = F.broadcast(read_table(spark, sf_dir, "region", "r_regionkey", "r_name"))
    key = F.col("n_nationkey")
    nations = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.concat(F.lit("GHCND:USW"), F.lpad(key.cast("string"), 8, "0")).alias("noaa_station_id"),
        F.when(key % NA_BA_MODULUS == NA_BA_REMAINDER, F.lit("N/A"))
        .otherwise(F.concat(F.lit("BA"), F.col("n_regionkey").cast("string"))).alias("eia_ba_code"),
        F.when(key == NO_LATITUDE_NATION, F.lit(None).cast("double"))
        .otherwise((key + 25).cast("double")).alias("latitude"),
        (key * 2 - 120).cast("double").alias("longitude"),
        key.cast("long").alias("cfg_pos"),
    )
    return nations.unionByName(local_table(spark, [NO_DATA_CITY], CITY_DIM))


# Bit widths of the packed landing order (see ``landing_order``).
_ORDER_BITS, _LINE_BITS, _PART_BITS, _SUPP_BITS, _QTY_BITS = 44, 3, 35, 30, 13
_HIGH_PART_BITS = 16        # bits of the partkey in the upper of two longs


def landing_order():
    """The fixture's landing order as one fixed-width, order-preserving key.

    FIXTURES.md orders readings by (orderkey, linenumber, partkey, suppkey,
    quantity, returnflag, shipdate). Inside one (city, date, datatype) group
    returnflag and the shipdate day are constant, and rows equal on the other
    fields carry the same value, so packing those fields into one
    ``decimal(38,0)`` (3 + 35 + 30 + 13 bits below an orderkey < 2^44, i.e.
    far past SF 100,000) keeps keep-first exact; a key beyond its bits raises
    an error. Unlike a struct, a decimal ordering keeps ``min_by`` in a hash
    aggregate (no sort of every task). The bits are put together in two longs
    that the partkey is cut between, so a row costs one decimal product.
    """
    dec = "decimal(38,0)"
    low_bits = _PART_BITS - _HIGH_PART_BITS
    part, below = F.col("l_partkey"), low_bits + _SUPP_BITS + _QTY_BITS
    high = (F.shiftleft(F.col("l_orderkey"), _LINE_BITS + _HIGH_PART_BITS)
            + F.shiftleft(F.col("l_linenumber").cast("long"), _HIGH_PART_BITS) + F.shiftright(part, low_bits))
    low = (F.shiftleft(part.bitwiseAND(F.lit((1 << low_bits) - 1)), _SUPP_BITS + _QTY_BITS)
           + F.shiftleft(F.col("l_suppkey"), _QTY_BITS) + F.round(F.col("l_quantity") * 100).cast("long"))
    k = high.cast("decimal(19,0)") * F.lit(1 << below).cast("decimal(19,0)") + low
    fits = F.lit(True)
    for key, bits in (("l_orderkey", _ORDER_BITS), ("l_linenumber", _LINE_BITS), ("l_partkey", _PART_BITS),
                      ("l_suppkey", _SUPP_BITS)):
        fits = fits & (F.col(key) >= 0) & (F.col(key) < F.lit(1 << bits))
    return F.when(fits, k.cast(dec)).otherwise(F.raise_error(F.lit("a key is beyond its bits of the landing order"))
                                               .cast(dec))


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-format readings ``(city, date, datatype, value, pos)``.

    Every line item becomes a reading: flag ``A`` -> TMAX, ``R`` -> TMIN and
    ``N`` -> PRCP, a datatype the pivot ignores (it still makes day rows and
    duplicates).

    ``pos`` is the landing order used for keep-first (``landing_order``); it
    needs no window, so no task ever sorts a whole city.
    The supplier join comes first so the optimizer sizes the plain supplier
    scan (it grows with the data: no forced broadcast); only the 25-row nation
    table is broadcast explicitly.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    sup = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    nat = _nation_city(spark, sf_dir)
    rf = F.col("l_returnflag")
    return (
        li.join(sup, li.l_suppkey == sup.s_suppkey)
        .join(nat, F.col("s_nationkey") == nat.n_nationkey)
        .select(
            F.col("n_name").alias("city"),
            F.col("l_shipdate").alias("date"),
            F.when(rf == "A", F.lit("TMAX")).when(rf == "R", F.lit("TMIN"))
            .otherwise(F.lit("PRCP")).alias("datatype"),
            ((F.col("l_quantity") * 10 - 100 + F.col("l_linenumber")) / 10).alias("value"),
            landing_order().alias("pos"),
        )
    )


def raw_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energy records ``(city, period, type, value)``; value is text, some unparsable."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                   "o_totalprice", "o_orderdate")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nat = _nation_city(spark, sf_dir)
    k = F.col("o_orderkey")
    joined = o.join(c, o.o_custkey == c.c_custkey).join(nat, F.col("c_nationkey") == nat.n_nationkey)
    return joined.select(
        F.col("n_name").alias("city"),
        F.col("o_orderdate").alias("period"),
        F.col("o_orderstatus").alias("type"),
        F.when(k % 97 == 0, F.lit("n/a"))
        .when(k % 13 == 0, (-F.col("o_totalprice")).cast("string"))
        .otherwise(F.col("o_totalprice").cast("string")).alias("value"),
    )


# Fixed values of the station fixture: five station names and their states.
STATION_NAMES = [
    "HOUSTON INTL AIRPORT, TX US",
    "NEW YORK CNTRL PK, NY US",
    "PHOENIX, AZ US",
    "JUNEAU AIRPORT, AK US",
    "NOWHERE 5 N, ZZ US",
]
STATION_STATES = ["Texas", "New York", "Arizona", "Alaska", "Atlantis"]
STATIONS_AS_OF = "2001-11-04"


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather-station catalogue ``(id, name, state, latitude, longitude, maxdate)``."""
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    k = F.col("s_suppkey")
    names = F.array(*[F.lit(x) for x in STATION_NAMES])
    states = F.array(*[F.lit(x) for x in STATION_STATES])
    return s.select(
        F.concat(F.when(k % 3 == 0, F.lit("GHCND:USW")).otherwise(F.lit("GHCND:USC")),
                 F.lpad(k.cast("string"), 8, "0")).alias("id"),
        F.element_at(names, (k % 5 + 1).cast("int")).alias("name"),
        F.element_at(states, (k % 5 + 1).cast("int")).alias("state"),
        (F.col("s_nationkey") + 20).cast("double").alias("latitude"),
        (-60 - F.col("s_nationkey")).cast("double").alias("longitude"),
        F.when(k % 5 == 3, F.lit("1999-01-01").cast("date"))
        .when(k % 7 == 0, F.lit("2000-01-01").cast("date"))
        .when((k % 5 == 2) & (k % 3 == 0), F.lit("2000-06-01").cast("date"))
        .otherwise(F.lit(STATIONS_AS_OF).cast("date")).alias("maxdate"),
    )
