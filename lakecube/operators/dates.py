"""Date sequences for task generation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def date_range_subsample(df: DataFrame, k: int, start=None, end=None, col: str = "time") -> DataFrame:
    """every k-th day of the daily range [start, end] (``pd.date_range(a, b)[::k]``).

    Bounds default to the table's first and last date (scalar subqueries).  The
    range is one row exploded into at most (end - start) / k dates.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if start is None or end is None:
        ext = df.select(F.struct(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))).scalar()
    lo = F.lit(start).cast("date") if start is not None else ext.getField("lo")
    hi = F.lit(end).cast("date") if end is not None else ext.getField("hi")
    days = F.sequence(lo, hi, F.expr(f"INTERVAL {int(k)} DAY"))
    return df.sparkSession.range(1).select(F.explode(days).alias("time"))


def every_kth(dates: DataFrame, k: int, col: str = "time") -> DataFrame:
    """Every k-th entry (0, k, 2k, ...) of an ordered set of distinct dates.

    The window has no partition: it runs on the date set only, whose size is
    bounded by the length of the record in days.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    w = Window.orderBy(col)
    return (dates.select(col).distinct().withColumn("__rn", F.row_number().over(w) - 1)
            .filter(F.col("__rn") % k == 0).drop("__rn"))


def circ_time_table(df: DataFrame, start=None, end=None, col: str = "time") -> DataFrame:
    """``cos_D``/``sin_D`` for every day of the range (default: the table's
    first to last date), one row per day."""
    from ..functions.columns import circ_time
    from .quality import daily_range
    cos_d, sin_d = circ_time("time")
    return daily_range(df, start, end, col).select("time", cos_d.alias("cos_D"), sin_d.alias("sin_D"))
