"""Points to the intervals that hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def points_in_intervals(
    points: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, width: int
) -> DataFrame:
    """Every point beside every interval of its key with ``start <= at < end``.

    Both sides are cut into cells of ``width`` along the line, and an interval stands in each cell it touches, so the
    join is on (key, cell) and a long line is spread over many tasks. ``width`` is about an interval's usual
    length: an interval then stands in two cells at most. Points outside all intervals and nulls find none.
    """
    cells = F.sequence(F.expr(f"`{start}` div {width}"), F.expr(f"(`{end}` - 1) div {width}"))
    placed = intervals.where(F.col(end) > F.col(start)).withColumn("_cell", F.explode(cells))
    asked = points.withColumn("_cell", F.expr(f"`{at}` div {width}"))
    inside = (F.col(start) <= F.col(at)) & (F.col(at) < F.col(end))
    return asked.join(placed, [key, "_cell"]).where(inside).drop("_cell")
