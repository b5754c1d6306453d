"""Cleaning steps (C1-C7) and the single-scan cleaning report.

Each step is a plain ``filter`` so consecutive steps fuse into one stage and
reach the scan. The report computes every step's size in one aggregation
(one job, one scan) instead of two counts per step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import MIN_FARE, NYC_BB
from ..functions.calendar import add_calendar_features
from .zones import box_predicate_both_ends


def fare_floor_predicate() -> Column:
    # NaN >= 2.5 is true in Spark's ordering; NULL is dropped.
    return F.col("fare_amount") >= MIN_FARE


def not_missing_predicate(df: DataFrame, subset: list[str] | None = None) -> Column:
    """Same rows as ``na.drop("any")``: no NULL anywhere, no NaN in float or
    double columns."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols = subset or list(fields)
    parts = []
    for c in cols:
        p = F.col(c).isNotNull()
        if isinstance(fields[c], (T.FloatType, T.DoubleType)):
            p = p & ~F.isnan(F.col(c))
        parts.append(p)
    return reduce(lambda a, b: a & b, parts)


def no_zeros_predicate() -> Column:
    cols = ("pickup_longitude", "dropoff_longitude", "dropoff_latitude",
            "pickup_latitude", "passenger_count")
    return reduce(lambda a, b: a & b, [F.col(c) != 0 for c in cols])


def fare_floor(df: DataFrame) -> DataFrame:
    """Keep fares >= 2.50."""
    return df.filter(fare_floor_predicate())


def drop_missing(df: DataFrame) -> DataFrame:
    """Drop rows with any NULL or NaN."""
    return df.filter(not_missing_predicate(df))


def drop_zeros(df: DataFrame) -> DataFrame:
    """Drop rows with a zero coordinate or zero passengers."""
    return df.filter(no_zeros_predicate())


def nyc_box_clean(df: DataFrame, bb=NYC_BB) -> DataFrame:
    """Keep rides whose both ends lie inside the frame (closed edges)."""
    return df.filter(box_predicate_both_ends(bb))


def clean_rides(df: DataFrame, features: bool = True, drop_ts: bool = False) -> DataFrame:
    """Fare floor, missing, zeros, then calendar features; one stage.

    The three steps are one conjunctive filter (same rows as applying them
    in turn, one analysis instead of three)."""
    out = df.filter(fare_floor_predicate() & not_missing_predicate(df) & no_zeros_predicate())
    return add_calendar_features(out, drop=drop_ts) if features else out


def cleaning_steps(df: DataFrame, with_box: bool = True) -> list[tuple[str, Column]]:
    steps = [("fare_floor", fare_floor_predicate()),
             ("drop_missing", not_missing_predicate(df)),
             ("drop_zeros", no_zeros_predicate())]
    if with_box:
        steps.append(("nyc_box", box_predicate_both_ends(NYC_BB)))
    return steps


def cleaning_report(df: DataFrame, with_box: bool = True) -> DataFrame:
    """C4: per step old size, new size, dropped, percent (2 decimals).

    One aggregate computes the survivor count after every prefix of the
    steps; ``inline`` then turns the single row into one row per step.
    Percent is NULL when the old size is 0.
    """
    steps = cleaning_steps(df, with_box)
    return report_of(df.agg(*survivors(steps)), [name for name, _ in steps])


def survivors(steps: list[tuple[str, Column]]) -> list[Column]:
    """n0, n1, ...: rows, and rows left after each step."""
    counts = [F.count(F.lit(1)).alias("n0")]
    keep = F.lit(True)
    for i, (_, pred) in enumerate(steps, start=1):
        keep = keep & F.coalesce(pred, F.lit(False))
        counts.append(F.count_if(keep).alias(f"n{i}"))
    return counts


def report_of(sizes: DataFrame, names: list[str]) -> DataFrame:
    """The cleaning report of one row of ``survivors``."""
    rows = F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("step_name"),
                 F.col(f"n{i - 1}").alias("old_size"), F.col(f"n{i}").alias("new_size"))
        for i, name in enumerate(names, start=1)])
    out = sizes.select(F.inline(rows))
    dropped = F.col("old_size") - F.col("new_size")
    pct = F.when(F.col("old_size") == 0, F.lit(None).cast("double")).otherwise(
        dropped.cast("double") / F.col("old_size").cast("double") * 100.0)
    return out.select("step", "step_name", "old_size", "new_size",
                      dropped.alias("dropped"), F.round(pct, 2).alias("dropped_pct"))


# --- fixed values: inverted frame that marks swapped lon/lat ----------------
SWAP_LON_RANGE = (40.5, 41.8)     # a longitude that looks like a NYC latitude
SWAP_LAT_RANGE = (-74.5, -72.8)   # a latitude that looks like a NYC longitude


def _is_swapped(lon: str, lat: str) -> Column:
    return (F.col(lon).between(*SWAP_LON_RANGE) & F.col(lat).between(*SWAP_LAT_RANGE))


def swap_repair(df: DataFrame) -> DataFrame:
    """Per ride end, exchange lon/lat when they fall in the inverted frame.
    Row-level and idempotent; flags tell which end was repaired."""
    out = df
    for side in ("pickup", "dropoff"):
        lon, lat = f"{side}_longitude", f"{side}_latitude"
        flag = f"{side}_swapped"
        out = out.withColumn(flag, F.coalesce(_is_swapped(lon, lat), F.lit(False)))
        out = out.withColumns({
            lon: F.when(F.col(flag), F.col(lat)).otherwise(F.col(lon)),
            lat: F.when(F.col(flag), F.col(lon)).otherwise(F.col(lat)),
        })
    return out
