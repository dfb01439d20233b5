"""Date handling: text/timestamp -> calendar date (P1) and run-mode ranges."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_day(df: DataFrame, col: str) -> Column:
    """Calendar date of ``col``, time of day dropped.

    Text is parsed leniently (unparsable -> NULL, never an ANSI error);
    timestamps and dates are cast. Rows of a landing by spans carry the day of
    their text in ``_day``.
    """
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.StringType):
        if "_day" in df.columns:
            return F.col("_day")
        return F.try_to_timestamp(c).cast("date")
    return c.cast("date")


def bad_day(df: DataFrame, col: str) -> Column:
    """True where a non-NULL date text does not parse (Q4's bad-date condition)."""
    if not isinstance(df.schema[col].dataType, T.StringType):
        return F.lit(False)
    return F.col(col).isNotNull() & to_day(df, col).isNull()


def span_of(day: Column, grain: str) -> Column:
    """The month or year of a day as text; years beyond four digits as ``date_format`` writes them."""
    year = F.lpad(F.year(day).cast("string"), 4, "0")
    text, pattern = (year, "yyyy") if grain == "year" else (
        F.concat(year, F.lit("-"), F.lpad(F.month(day).cast("string"), 2, "0")), "yyyy-MM")
    return F.when(F.year(day).between(1, 9999), text).otherwise(F.date_format(day, pattern))


@dataclass(frozen=True)
class RunMode:
    """How a refresh picks its date range.

    Precedence: explicit range, then last ``historical_days`` days, then
    yesterday, then the default of 365 days. ``historical_days = 0`` is falsy
    and falls through, as in the reference. Bounds are inclusive; the N-day
    mode ends on ``as_of`` itself and so spans N + 1 dates.
    """

    fetch_range: tuple[str, str] | None = None
    historical_days: int | None = None
    daily: bool = False
    default_days: int = 365

    def resolve(self, as_of: dt.date) -> tuple[dt.date, dt.date]:
        if self.fetch_range:
            try:
                start = dt.datetime.strptime(self.fetch_range[0], "%Y-%m-%d").date()
                end = dt.datetime.strptime(self.fetch_range[1], "%Y-%m-%d").date()
            except ValueError as exc:
                raise ValueError("fetch range must be YYYY-MM-DD YYYY-MM-DD") from exc
            return start, end
        if self.historical_days:
            return as_of - dt.timedelta(days=self.historical_days), as_of
        if self.daily:
            y = as_of - dt.timedelta(days=1)
            return y, y
        return as_of - dt.timedelta(days=self.default_days), as_of


def in_range(day: Column, start: dt.date | str | None, end: dt.date | str | None) -> Column:
    """Inclusive range predicate; NULL days drop out. Literal bounds push down."""
    cond = day.isNotNull()
    if start is not None:
        cond = cond & (day >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (day <= F.lit(end).cast("date"))
    return cond
