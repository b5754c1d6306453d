"""Fare colour (P4) as a CASE expression instead of an RDD map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import COLOR_HIGH, COLOR_LOW


def fare_color(fare: str | Column = "fare_amount") -> Column:
    """'r' below 5, 'y' strictly between 5 and 10, 'b' otherwise (5.0, 10+,
    NaN); NULL stays NULL."""
    f = F.col(fare) if isinstance(fare, str) else fare
    return (F.when(f.isNull(), F.lit(None).cast("string"))
            .when(f < COLOR_LOW, F.lit("r"))
            .when((f > COLOR_LOW) & (f < COLOR_HIGH), F.lit("y"))
            .otherwise(F.lit("b")))
