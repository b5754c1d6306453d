"""Calendar features (P1) and time-of-day / season predicates.

Feature columns are strings, as published; predicates use integer
``hour()``/``month()`` of the timestamp so no string-to-number cast sits in
the filter. Both work on ``timestamp`` and ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DAY_HOURS, RUSH_HOURS, SNOW_MONTHS

TS = "pickup_datetime"

# --- fixed values: weekday labels, Monday first (as date pattern "E") ---------
WEEKDAY_LABELS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def _two_digits(x: Column) -> Column:
    return F.lpad(x.cast("string"), 2, "0")


def calendar_columns(ts: str | Column = TS) -> dict[str, Column]:
    """The strings of date patterns y, M, E, HH and HH:mm:ss, built from field
    extraction: on ``timestamp_ntz`` no time zone is involved (a formatter
    would pass through the session zone and shift wall-clock times that fall
    in a daylight-saving gap); on ``timestamp`` the session zone applies, as
    for any formatter. A NULL timestamp gives NULL in every column."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    known = lambda x: F.when(ts.isNotNull(), x)
    return {
        "year": F.year(ts).cast("string"),
        "month": F.month(ts).cast("string"),
        "day_of_week": known(F.element_at(F.array(*[F.lit(d) for d in WEEKDAY_LABELS]), F.weekday(ts) + 1)),
        "hour": _two_digits(F.hour(ts)),
        "time": known(F.concat_ws(":", _two_digits(F.hour(ts)), _two_digits(F.minute(ts)), _two_digits(F.second(ts)))),
    }


def add_calendar_features(df: DataFrame, ts: str = TS, drop: bool = False) -> DataFrame:
    """Adds year, month, day_of_week, hour, time (strings). Stateless:
    calling it twice gives the same columns."""
    out = df.withColumns(calendar_columns(ts))
    return out.drop(ts) if drop else out


def _int_part(df: DataFrame, part: str) -> Column:
    # Prefer the timestamp; fall back to the published string feature.
    if TS in df.columns:
        return F.hour(TS) if part == "hour" else F.month(TS)
    return F.col(part).cast("int")


def is_rush_hour(df: DataFrame) -> Column:
    return _int_part(df, "hour").between(*RUSH_HOURS)


def is_midnight(df: DataFrame) -> Column:
    return ~_int_part(df, "hour").between(*DAY_HOURS)


def is_snow_season(df: DataFrame) -> Column:
    return _int_part(df, "month").between(*SNOW_MONTHS)


def rush_hour_rides(df: DataFrame) -> DataFrame:
    """pickup hour 16..20 inclusive."""
    return df.filter(is_rush_hour(df))


def midnight_rides(df: DataFrame) -> DataFrame:
    """pickup hour 23 or 0..6."""
    return df.filter(is_midnight(df))


def snow_season_rides(df: DataFrame) -> DataFrame:
    """pickup month January or February."""
    return df.filter(is_snow_season(df))


SLICES = {
    "snow": is_snow_season,
    "midnight": is_midnight,
    "rush": is_rush_hour,
}
