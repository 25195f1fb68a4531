"""Cleaning, projection and selection on grid / point tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.columns import FILL_VALUE, nan_to_null

CELL = ("lat_idx", "lon_idx")
KEY_COLUMNS = frozenset({"time", "lat_idx", "lon_idx", "lat", "lon", "month", "year",
                         "obs", "point_id", "iteration", "task_time", "set_idx",
                         "x1", "x2", "latitude", "longitude", "epoch", "batch"})


def value_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric non-key columns: the grid's variables."""
    skip = KEY_COLUMNS | set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in skip]


def sentinel_to_null(df: DataFrame, sentinel: float = FILL_VALUE,
                     cols: Sequence[str] | None = None) -> DataFrame:
    """Fill value and NaN -> NULL on every value column (keys untouched)."""
    cols = list(cols) if cols is not None else value_columns(df)
    return df.withColumns({
        c: F.when(nan_to_null(c) != F.lit(sentinel), F.col(c)) for c in cols})


def standardize_dates(df: DataFrame, col: str = "time") -> DataFrame:
    """F1 on a table: floor ``col`` to its day (DATE); a table without it is returned unchanged."""
    from ..functions.columns import standardize_dates as to_day
    return df.withColumn(col, to_day(col)) if col in df.columns else df


def drop_vars(df: DataFrame, *names: str) -> DataFrame:
    """Drop variables; absent names are ignored."""
    return df.drop(*names)


def rename_vars(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename variables/coordinates present in ``mapping``."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def select_var(df: DataFrame, candidates: Sequence[str], keys: Sequence[str] = (),
               alias: str | None = None) -> DataFrame:
    """Keep the keys and the first of ``candidates`` that exists."""
    for name in candidates:
        if name in df.columns:
            return df.select(*keys, F.col(name).alias(alias or name))
    raise ValueError(f"none of {list(candidates)} in {df.columns}")


def _as_date(v):
    return F.lit(v).cast("date") if isinstance(v, str) else F.lit(v)


def time_slice(df: DataFrame, start, end, col: str = "time") -> DataFrame:
    """Inclusive range; a plain comparison so Parquet/partition filters apply."""
    return df.filter(F.col(col).between(_as_date(start), _as_date(end)))


def time_exact(df: DataFrame, dates: Sequence, col: str = "time") -> DataFrame:
    """P5: rows on one or several dates."""
    return df.filter(F.col(col).isin([F.lit(d).cast("date") for d in dates]))


def time_nearest(df: DataFrame, target, col: str = "time") -> DataFrame:
    """Rows on the available date nearest to ``target`` (ties -> later date).

    The nearest date is a scalar subquery over the date column (partial
    aggregation, one value), so the big table is only filtered.
    """
    t = F.lit(target).cast("date")
    nearest = (df.select(F.min_by(F.col(col), F.struct(F.abs(F.datediff(F.col(col), t)),
                                                       -F.unix_date(F.col(col))))).scalar())
    return df.filter(F.col(col) == nearest)


def bbox(df: DataFrame, lat_range, lon_range, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Inclusive lat/lon box."""
    return df.filter(F.col(lat).between(*lat_range) & F.col(lon).between(*lon_range))


def cell_nearest(df: DataFrame, lat_value: float, lon_value: float) -> DataFrame:
    """Rows of the cell nearest to a point, chosen per axis (ties -> larger label)."""
    def pick(idx, label, v):
        return (df.select(F.min_by(F.col(idx), F.struct(F.abs(F.col(label) - F.lit(v)),
                                                        -F.col(label)))).scalar())
    return df.filter((F.col("lat_idx") == pick("lat_idx", "lat", lat_value))
                     & (F.col("lon_idx") == pick("lon_idx", "lon", lon_value)))


def axis_index(axis: DataFrame, label: str, name: str | None = None) -> DataFrame:
    """0-based position of each label on its (small, distinct) axis table.

    The window has no partition key, so it must only run on an axis table
    (one row per grid line, a few thousand rows), never on the cube.
    """
    w = Window.orderBy(F.col(label))
    return axis.withColumn(name or f"{label}_pos", (F.row_number().over(w) - 1).cast("bigint"))


def isel(df: DataFrame, label: str, start: int, stop: int) -> DataFrame:
    """Positional slice [start, stop) along one axis of ``df``."""
    axis = axis_index(df.select(label).distinct(), label, "_pos")
    keep = axis.filter(F.col("_pos").between(start, stop - 1)).select(label)
    return df.join(F.broadcast(keep), label, "left_semi")  # bounded by stop-start rows


def drop_null_coords(df: DataFrame, cols: Sequence[str] = ("latitude", "longitude")) -> DataFrame:
    """Drop rows with a missing coordinate."""
    return df.dropna(subset=list(cols))


def mask_filter(mask: DataFrame, col: str = "mask") -> DataFrame:
    """Cells where the mask is 1."""
    return mask.filter(F.col(col) == 1)


# Fixed train/validation ranges of the three run modes.
SPLIT_MODES = {
    "debug": (("2009-01-01", "2009-12-31"), ("2010-01-01", "2010-12-31")),
    "scaled": (("1995-01-01", "2016-12-31"), ("2017-01-01", "2022-12-31")),
    "full": (("1995-01-01", "2018-12-31"), ("2019-01-01", "2022-12-31")),
}


def split_by_date(df: DataFrame, mode: str = "scaled", col: str = "time",
                  train=None, val=None) -> DataFrame:
    """Label rows 'train' / 'val' by date range; rows outside both are dropped."""
    if mode not in SPLIT_MODES and (train is None or val is None):
        raise ValueError(f"Unknown mode {mode!r}")
    tr, va = (train, val) if train is not None else SPLIT_MODES[mode]
    t = F.col(col)
    label = (F.when(t.between(F.lit(tr[0]).cast("date"), F.lit(tr[1]).cast("date")), F.lit("train"))
             .when(t.between(F.lit(va[0]).cast("date"), F.lit(va[1]).cast("date")), F.lit("val")))
    return df.withColumn("split", label).filter(F.col("split").isNotNull())


def limit_report(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """First ``n`` rows in order plus how many were not shown.

    The limit is the feature (a report).  The total is a scalar subquery, so no
    window over the whole table and no driver round trip.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    total = df.select(F.count(F.lit(1))).scalar()
    return (df.orderBy(*order).limit(n)
            .withColumn("n_more", F.greatest(total - F.lit(n), F.lit(0)).cast("bigint")))


def overlap_slice(df: DataFrame, other: DataFrame, col: str = "time", other_col: str | None = None) -> DataFrame:
    """Keep rows inside [min, max] of ``other``'s time (two scalar subqueries)."""
    oc = other_col or col
    ext = other.select(F.struct(F.min(oc).alias("lo"), F.max(oc).alias("hi"))).scalar()
    return df.filter(F.col(col).between(ext.getField("lo"), ext.getField("hi")))
