"""Vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two arrays of equal length, summed in double precision."""
    steps = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2)))
    return F.aggregate(steps, F.lit(0.0), lambda total, step: total + step)
