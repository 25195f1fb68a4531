"""Set operations on grid and point tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def concat_years(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack per-year frames along time.  Duplicates are kept (no distinct),
    columns missing from a frame become NULL."""
    if not frames:
        raise ValueError("no frames to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def append_points(points: DataFrame, new: DataFrame) -> DataFrame:
    """Add newly chosen points to a context point set."""
    return points.unionByName(new, allowMissingColumns=True)


def unique_coords(df: DataFrame, cols: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """U4: distinct coordinate pairs."""
    return df.select(*cols).dropDuplicates(list(cols))


def sort_coords(df: DataFrame, cols: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """Order by the coordinates (a range-partitioned sort, no single task)."""
    return df.orderBy(*cols)
