"""Temperature and calendar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: heatmap temperature bins
# (left-closed, upper bounds in °F) with their labels, and the weekday order.
TEMP_BIN_EDGES = [50, 60, 70, 80, 90]
TEMP_BIN_LABELS = ["<50°F", "50-60°F", "60-70°F", "70-80°F", "80-90°F", ">90°F"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

METRICS = ("max", "min", "avg")


def c_to_f(celsius: Column) -> Column:
    """°C -> °F rounded to 2 decimals; NULL stays NULL."""
    return F.round(celsius * 9 / 5 + 32, 2)


def temp_metric(metric: str = "max") -> Column:
    """Temperature chosen for analysis (P8): TMAX_F, TMIN_F or their mean.

    The mean is NULL when either side is NULL.
    """
    if metric == "max":
        return F.col("TMAX_F")
    if metric == "min":
        return F.col("TMIN_F")
    if metric == "avg":
        return (F.col("TMAX_F") + F.col("TMIN_F")) / 2
    raise ValueError(f"unknown temperature metric {metric!r}; expected one of {METRICS}")


def temp_bin_order(t: Column) -> Column:
    """0-based ordinal of the left-closed temperature bin; NULL for NULL."""
    expr = None
    for i, edge in enumerate(TEMP_BIN_EDGES):
        expr = F.when(t < edge, F.lit(i)) if expr is None else expr.when(t < edge, F.lit(i))
    return F.when(t.isNotNull(), expr.otherwise(F.lit(len(TEMP_BIN_EDGES))))


def temp_bin_label(order: Column) -> Column:
    """Label of a bin ordinal; labels are a fixed 6-element array."""
    labels = F.array(*[F.lit(s) for s in TEMP_BIN_LABELS])
    return F.when(order.isNotNull(), F.element_at(labels, order + 1))


def day_name(d: Column) -> Column:
    """Full English weekday name (P10); ``dayname()`` would abbreviate."""
    return F.date_format(d, "EEEE")


def day_order(d: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(d)


def is_weekend(d: Column) -> Column:
    """Saturday or Sunday."""
    return F.weekday(d) >= 5
