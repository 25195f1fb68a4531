"""Monthly climatology and anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .clean import CELL, value_columns


def climatology(grid: DataFrame, value_cols: Sequence[str] | None = None,
                time_col: str = "time") -> DataFrame:
    """A1: mean of each variable per calendar month and cell (NULLs skipped).

    Plans as partial HashAggregate -> Exchange(month, cell) -> final aggregate,
    so a hot cell is pre-reduced on the map side before it is shuffled.
    """
    cols = list(value_cols) if value_cols is not None else value_columns(grid)
    return (grid.groupBy(F.month(time_col).cast("bigint").alias("month"), *CELL)
            .agg(*[F.avg(c).alias(c) for c in cols]))


def monthly_moments(grid: DataFrame, value_cols: Sequence[str], time_col: str = "time") -> DataFrame:
    """Per calendar month and cell and variable: ``<var>`` the mean, ``<var>__n`` the values and ``<var>__var`` their variance.

    The means are the climatology (A1).  Moments of groups merge, so the spread of the anomalies follows from
    them as well (``pooled_anomaly_params``): one pass over the cube serves both.
    """
    aggs = []
    for c in value_cols:
        aggs += [F.avg(c).alias(c), F.count(c).alias(f"{c}__n"), F.var_pop(c).alias(f"{c}__var")]
    return grid.groupBy(F.month(time_col).cast("bigint").alias("month"), *CELL).agg(*aggs)


def pooled_anomaly_params(moments: DataFrame, value_cols: Sequence[str], suffix: str = "_anom") -> DataFrame:
    """A4 of the anomalies against the moments' own means: (var, method, mean, std, min, max), one row per variable.

    Anomalies average to 0 in every group, so their variance is the groups' variance weighted by their counts.
    """
    none = F.lit(None).cast("double")
    rows = [F.struct(F.lit(f"{c}{suffix}").alias("var"), F.lit("mean_std").alias("method"),
                     F.when(F.sum(f"{c}__n") > 0, F.lit(0.0)).alias("mean"),
                     F.sqrt(F.try_divide(F.sum(F.col(f"{c}__n") * F.col(f"{c}__var")), F.sum(f"{c}__n"))).alias("std"),
                     none.alias("min"), none.alias("max")) for c in value_cols]
    return moments.agg(F.array(*rows).alias("__r")).select(F.explode("__r").alias("p")).select("p.*")


def anomalies(grid: DataFrame, clim: DataFrame, value_cols: Sequence[str] | None = None,
              time_col: str = "time") -> DataFrame:
    """Value minus the climatology of its month and cell.

    LEFT join: a cell/month absent from the climatology gives NULL.  Raises when
    no climatology is given (the reference's "call calculate first").
    """
    if clim is None:
        raise ValueError("anomalies need a climatology (see climatology())")
    cols = list(value_cols) if value_cols is not None else [c for c in value_columns(clim)]
    keys = ["__month", "__lat_idx", "__lon_idx"]
    renamed = clim.select(F.col("month").alias("__month"), F.col("lat_idx").alias("__lat_idx"),
                          F.col("lon_idx").alias("__lon_idx"),
                          *[F.col(c).alias(f"__clim_{c}") for c in cols])
    # No hint: a saved climatology carries file-size statistics, so Catalyst
    # broadcasts it when it is under the broadcast threshold; an in-flight
    # aggregate is measured by AQE at run time (and a hot cell on the big side
    # is split by AQE's skew-join handling).  Counting it first would cost a
    # full extra pass over the cube.
    small = renamed
    keyed = grid.withColumns({"__month": F.month(time_col).cast("bigint"),
                              "__lat_idx": F.col("lat_idx"), "__lon_idx": F.col("lon_idx")})
    joined = keyed.join(small, keys, "left")
    return joined.select(*[(F.col(c) - F.col(f"__clim_{c}")).alias(c) if c in cols else F.col(c)
                           for c in grid.columns])


def anomaly_window(grid: DataFrame, value_cols: Sequence[str] | None = None,
                   time_col: str = "time") -> DataFrame:
    """Anomaly in one pass, ``x - avg(x) OVER (PARTITION BY month, cell)``.

    One shuffle instead of aggregate + join.  A window partition holds one cell
    for one calendar month: at most 31 days per year of record, so the partition
    size is bounded by the record length, not by the table size.  Use
    ``anomalies`` (aggregate + join) for tables with duplicate days per cell.
    """
    cols = list(value_cols) if value_cols is not None else value_columns(grid)
    w = Window.partitionBy(F.month(time_col), *CELL)
    return grid.withColumns({c: F.col(c) - F.avg(c).over(w) for c in cols})


def time_mean(grid: DataFrame, value_cols: Sequence[str] | None = None) -> DataFrame:
    """A2: mean map over all dates."""
    cols = list(value_cols) if value_cols is not None else value_columns(grid)
    return grid.groupBy(*CELL).agg(*[F.avg(c).alias(c) for c in cols])


def month_mean(clim: DataFrame, value_cols: Sequence[str] | None = None) -> DataFrame:
    """A3: unweighted mean of the monthly means of each cell."""
    cols = list(value_cols) if value_cols is not None else value_columns(clim)
    return clim.groupBy(*CELL).agg(*[F.avg(c).alias(c) for c in cols])


def spatial_mean_per_date(grid: DataFrame, col: str, time_col: str = "time") -> DataFrame:
    """Mean over the cells of each date."""
    return grid.groupBy(time_col).agg(F.avg(col).alias(col))


def anomaly_check(anoms: DataFrame, col: str, time_col: str = "time") -> DataFrame:
    """Per calendar month, the mean over dates of the spatial mean anomaly (≈ 0)."""
    per_date = spatial_mean_per_date(anoms, col, time_col)
    return (per_date.groupBy(F.month(time_col).cast("bigint").alias("month"))
            .agg(F.avg(col).alias("mean_anomaly")))


def mean_curve_spatial(grid: DataFrame, col: str, time_col: str = "time") -> DataFrame:
    """Mean over dates of the per-date spatial mean (mean of means), one row."""
    per_date = spatial_mean_per_date(grid, col, time_col)
    return per_date.agg(F.avg(col).alias("mean_of_means"), F.count(col).alias("n_dates"))
