"""Text column expressions: slugs, station tokens, display strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def city_slug(name: Column) -> Column:
    """File-name slug of a city: lower case, spaces -> underscores."""
    return F.regexp_replace(F.lower(name), " ", "_")


def station_city_token(name: Column) -> Column:
    """Lower-cased station name up to the first comma, then the first space."""
    return F.split_part(F.split_part(F.lower(name), F.lit(","), F.lit(1)), F.lit(" "), F.lit(1))


def py_float_text(x: Column) -> Column:
    """Text of a double already rounded to 2 decimals, as Python prints it.

    ``38.6`` -> ``'38.6'``, ``50.0`` -> ``'50.0'``, ``-12.25`` -> ``'-12.25'``.
    Built from a fixed 2-decimal format so it never switches to exponent form.
    """
    return F.regexp_replace(F.format_string("%.2f", x), r"(\.\d)0$", "$1")


def energy_text(e: Column) -> Column:
    """Hover text of an energy value: ``'1,235 MWh'`` or a fixed fallback."""
    return F.when(e.isNull(), F.lit("Energy data not available")).otherwise(
        F.concat(F.format_number(e, 0), F.lit(" MWh")))


def pct_text(p: Column) -> Column:
    """Hover text of a percent change to 1 decimal, rounded from the exact binary value."""
    return (
        F.when(p.isNull(), F.lit("No prior day data"))
        .when(p == float("inf"), F.lit("+inf% vs yesterday"))
        .when(p == float("-inf"), F.lit("-inf% vs yesterday"))
        .otherwise(F.concat(F.when(p < 0, F.lit("-")).otherwise(F.lit("+")), _one_decimal(F.abs(p)),
                            F.lit("% vs yesterday")))
    )


def _one_decimal(p: Column) -> Column:
    """``p >= 0`` with one decimal, half-even on its exact binary value.

    ``p = m / 2**k`` with a whole ``m < 2**55``, so tenths are whole numbers
    to divide: no decimal rendering of the double is rounded a second time.
    """
    k = (F.lit(53) - F.floor(F.log2(F.when(p > 0, p).otherwise(1.0)))).cast("int")
    small, whole = k > 62, k <= 1
    k = F.when(small | whole, F.lit(2)).otherwise(k)
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), k)
    tenths = F.when(small | whole, F.lit(0.0)).otherwise(p * F.pow(F.lit(2.0), k)).cast("long") * 10
    floor, rest = F.floor(F.try_divide(tenths - tenths % unit, unit)).cast("long"), tenths % unit * 2
    up = (rest > unit) | ((rest == unit) & (floor % 2 == 1))
    n = floor + up.cast("long")
    text = F.concat((n - n % 10).cast("decimal(20,0)").cast("string"), F.lit("")).substr(F.lit(1), F.length(
        (n - n % 10).cast("decimal(20,0)").cast("string")) - 1)
    text = F.when(n < 10, F.lit("0")).otherwise(text)
    return F.when(small, F.lit("0.0")).when(whole, F.format_string("%.1f", p)).otherwise(
        F.concat(text, F.lit("."), (n % 10).cast("string")))
