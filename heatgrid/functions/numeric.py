"""Numeric column expressions: coercion, exact sums, guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exact accumulation type for energy sums: wide enough for 100 TB of daily
# readings, 6 decimals kept before the final half-even rounding to 2.
SUM_DECIMAL = "decimal(28,6)"

POS_INF = float("inf")
NEG_INF = float("-inf")


def coerce_double(c: Column) -> Column:
    """Text/number -> double, unparsable -> NULL; text 'nan' -> NULL."""
    v = c.try_cast("double")
    return F.when(~F.isnan(v), v)


def exact_sum(c: Column) -> Column:
    """Order-independent sum of a double column via decimal accumulation."""
    return F.sum(c.try_cast(SUM_DECIMAL))


def beyond_decimal(c: Column) -> Column:
    """Whether a group holds a number outside the decimal (1e22 and more, inf)."""
    return F.count(c) > F.count(c.try_cast(SUM_DECIMAL))


def sum_or_zero(c: Column, scale: int = 2) -> Column:
    """Sum rounded half-even to ``scale``; an all-NULL group gives 0.0 (A4, A5).

    A group with a number outside the decimal is summed in double instead.
    """
    exact = F.bround(exact_sum(c), scale).cast("double")
    return F.coalesce(F.when(beyond_decimal(c), F.sum(c)).otherwise(exact), F.lit(0.0))


def exact_mean(c: Column) -> Column:
    """Mean of non-NULL values: exact decimal sum divided once in double.

    NULL for an empty group (mean of nothing), unlike ``sum_or_zero``.
    """
    exact = F.try_divide(exact_sum(c).cast("double"), F.count(c).cast("double"))
    return F.when(beyond_decimal(c), F.avg(c)).otherwise(exact)


def pct_change(cur: Column, prev: Column) -> Column:
    """(cur - prev) / prev * 100 with pandas float semantics.

    NULL if either side is NULL; prev = 0 gives +/-inf, 0/0 gives NULL.
    """
    return (
        F.when(cur.isNull() | prev.isNull(), F.lit(None).cast("double"))
        .when(prev != 0, (cur - prev) / prev * 100)
        .when(cur > 0, F.lit(POS_INF))
        .when(cur < 0, F.lit(NEG_INF))
    )


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson r that is NULL (not an error) for constant x or y."""
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
