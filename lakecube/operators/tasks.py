"""Context/target task tables.

A task is not a Python object but rows of one long table::

    task_time DATE, role STRING, set_idx BIGINT, var STRING,
    point_id BIGINT, x1 DOUBLE, x2 DOUBLE, value DOUBLE

Static context sets (no time dimension) are stored once with ``task_time``
NULL and apply to every task, so a static grid is never repeated per date.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .normalize import apply_coord_map
from .quality import available_dates
from .sampling import sample_n_rows
from .grid import sample_at_points

TASK_COLUMNS = ["task_time", "role", "set_idx", "var", "point_id", "x1", "x2", "value"]

# Cells are numbered lat_idx * CELL_STRIDE + lon_idx; an index is below 2**32, so no two cells share a number.
CELL_STRIDE = 1 << 32


@dataclass
class TaskSet:
    """One context or target set: a variable of a table and how to sample it.

    ``sampling`` is ``"all"``, an integer N (N seeded cells with a value per
    date) or a point DataFrame (lat, lon, point_id) sampled at the nearest cell.
    """
    var: str
    frame: DataFrame
    sampling: object = "all"
    seed: int = 42
    time_col: str = "time"


def cell_id():
    return (F.col("lat_idx") * F.lit(CELL_STRIDE) + F.col("lon_idx")).cast("bigint")


def _rows(df: DataFrame, role: str, set_idx: int, var: str, coord_params: DataFrame,
          timed: bool, point_id=None) -> DataFrame:
    df = apply_coord_map(df, coord_params)
    return df.select(
        (F.col("time") if timed else F.lit(None).cast("date")).alias("task_time"),
        F.lit(role).alias("role"), F.lit(set_idx).cast("bigint").alias("set_idx"), F.lit(var).alias("var"),
        (point_id if point_id is not None else cell_id()).alias("point_id"),
        F.col("x1"), F.col("x2"), F.col(var).cast("double").alias("value"))


def set_rows(ts: TaskSet, dates: DataFrame, role: str, set_idx: int, coord_params: DataFrame) -> DataFrame:
    """Rows of one context/target set for all task dates."""
    cols = ts.frame.columns
    timed = ts.time_col in cols
    gridded = "lat_idx" in cols
    if timed and not gridded:
        # time-only series (e.g. day-of-year features): one value per task date
        s = ts.frame.withColumnRenamed(ts.time_col, "time").join(dates, "time", "left_semi")
        return s.select(F.col("time").alias("task_time"), F.lit(role).alias("role"),
                        F.lit(set_idx).cast("bigint").alias("set_idx"), F.lit(ts.var).alias("var"),
                        F.lit(None).cast("bigint").alias("point_id"), F.lit(None).cast("double").alias("x1"),
                        F.lit(None).cast("double").alias("x2"), F.col(ts.var).cast("double").alias("value"))
    frame = ts.frame.withColumnRenamed(ts.time_col, "time") if timed else ts.frame
    src = frame.join(dates, "time", "left_semi") if timed else frame
    if isinstance(ts.sampling, DataFrame):
        vals = sample_at_points(src, ts.sampling, value_cols=[ts.var])
        vals = vals.select(*(["time"] if timed else []), "point_id", "lat", "lon", ts.var)
        return _rows(vals, role, set_idx, ts.var, coord_params, timed, F.col("point_id").cast("bigint"))
    if isinstance(ts.sampling, int):
        by = "time" if timed else None
        if by:
            src = sample_n_rows(src, ts.sampling, ts.seed, by=by, value_col=ts.var)
        else:
            from .sampling import sample_rows
            keyed = src.filter(F.col(ts.var).isNotNull()).withColumn("__cell", cell_id())
            src = sample_rows(keyed, ts.sampling, ts.seed, key="__cell").drop("__cell")
    elif ts.sampling != "all":
        raise ValueError(f"unknown sampling {ts.sampling!r}")
    return _rows(src, role, set_idx, ts.var, coord_params, timed)


def build_tasks(dates: DataFrame, context: list[TaskSet], target: list[TaskSet] | None,
                coord_params: DataFrame) -> DataFrame:
    """The task table for ``dates``: context sets then target sets."""
    d = dates.select(F.col("time")).distinct()
    parts = [set_rows(ts, d, "context", i, coord_params) for i, ts in enumerate(context)]
    parts += [set_rows(ts, d, "target", i, coord_params) for i, ts in enumerate(target or [])]
    return reduce(DataFrame.unionByName, parts)


def build_tasks_safe(requested: DataFrame, data: DataFrame, context: list[TaskSet],
                     target: list[TaskSet] | None, coord_params: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep only requested dates present in ``data`` (semi join) and build the tasks;
    also (time, used) for every requested date, so skipped dates are listed."""
    used = available_dates(requested, data)
    tasks = build_tasks(used, context, target, coord_params)
    dates = requested.select("time").distinct()
    marked = used.select("time").distinct().withColumn("used", F.lit(True))
    return tasks, dates.join(marked, "time", "left").select("time", F.coalesce("used", F.lit(False)).alias("used"))


def target_none(dates: DataFrame, context: list[TaskSet], coord_params: DataFrame,
                lat: float, lon: float, var: str) -> DataFrame:
    """Context-only tasks plus one target location per date (value unknown)."""
    tasks = build_tasks(dates, context, None, coord_params)
    tgt = dates.select("time").distinct().select(
        "time", F.lit(lat).alias("lat"), F.lit(lon).alias("lon"), F.lit(None).cast("double").alias(var))
    rows = _rows(tgt, "target", 0, var, coord_params, True, F.lit(0).cast("bigint"))
    return tasks.unionByName(rows)


def task_report(tasks: DataFrame) -> DataFrame:
    """Per task date, role and set: points and missing values."""
    return tasks.groupBy("task_time", "role", "set_idx", "var").agg(
        F.count(F.lit(1)).alias("n_points"), F.count_if(F.col("value").isNull()).alias("n_missing"))


def remove_nans(tasks: DataFrame, role: str | None = None) -> DataFrame:
    """Drop rows with a missing value (for one role, or all)."""
    keep = F.col("value").isNotNull()
    if role is not None:
        keep = keep | (F.col("role") != F.lit(role))
    return tasks.filter(keep)

