"""Column expressions.  All are built-in Spark expressions, so they
stay inside whole-stage codegen; none needs a Python worker."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b, NULL where b is 0 (ANSI mode would raise on a zero divisor)."""
    return F.try_divide(_c(a), _c(b))


def _null_d() -> Column:
    return F.lit(None).cast("double")

# Fixed values used by the reference's formulas and data conventions.
FILL_VALUE = -99999.0           # missing-data marker of the gridded stores
ICE_LAND_VALUE = -1.0           # land marker of the ice-concentration grid
DAYS_PER_YEAR = 365.25          # day-of-year features divide by this
ICE_THRESHOLD = 0.2             # sst above this -> "no ice" (0), else 1
STD_FLOOR = 1e-6                # std floor before the Gaussian NLL
NUMERIC_STRING_PATTERN = r"^[-+]?\d*\.?\d+([eE][-+]?\d+)?$"


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN -> NULL so Spark aggregates skip it (NaN would poison avg/max)."""
    return F.nanvl(_c(c).cast("double"), _null_d())


def standardize_dates(c: ColumnOrName = "time") -> Column:
    """floor a timestamp to its day (DATE)."""
    return F.to_date(_c(c))


def clip(c: ColumnOrName, lo: float = 0.0, hi: float = 1.0) -> Column:
    """bound to [lo, hi]; NULL stays NULL (greatest/least would drop it)."""
    x = _c(c)
    return F.when(x < F.lit(lo), F.lit(lo)).when(x > F.lit(hi), F.lit(hi)).otherwise(x)


def rescale_cast(c: ColumnOrName, divisor: float = 100.0, dtype: str = "float") -> Column:
    """divide and cast (percent -> fraction, float32 at the sink)."""
    return (_c(c) / F.lit(divisor)).cast(dtype)


def transform_ice(c: ColumnOrName, threshold: float = ICE_THRESHOLD) -> Column:
    """value > threshold -> 0, otherwise 1, NULL kept."""
    x = _c(c)
    return (F.when(x.isNull(), F.lit(None).cast("bigint"))
            .when(x > F.lit(threshold), F.lit(0).cast("bigint"))
            .otherwise(F.lit(1).cast("bigint")))


def water_mask(depth: ColumnOrName) -> Column:
    """depth > 0 -> 1, else 0 (missing depth counts as land)."""
    return F.coalesce((_c(depth) > 0).cast("bigint"), F.lit(0).cast("bigint"))


def where_positive(c: ColumnOrName) -> Column:
    """P10: keep positive values, others become NULL."""
    x = _c(c)
    return F.when(x > 0, x)


def circ_time(c: ColumnOrName = "time") -> tuple[Column, Column]:
    """(cos_D, sin_D) of 2*pi*dayofyear/365.25."""
    ang = F.lit(2 * math.pi) * F.dayofyear(_c(c)).cast("double") / F.lit(DAYS_PER_YEAR)
    return F.cos(ang), F.sin(ang)


def std_floor(std: ColumnOrName, floor: float = STD_FLOOR) -> Column:
    """F8: std below the floor (or missing) -> floor."""
    s = _c(std)
    return F.when(s > F.lit(floor), s).otherwise(F.lit(floor))


def gaussian_nll(y: ColumnOrName, mean: ColumnOrName, std: ColumnOrName) -> Column:
    """0.5*ln(2*pi*s^2) + 0.5*(y-m)^2/s^2 with s = std_floor(std)."""
    s = std_floor(std)
    return (F.lit(0.5) * F.log(F.lit(2 * math.pi) * s * s)
            + F.lit(0.5) * (_c(y) - _c(mean)) * (_c(y) - _c(mean)) / (s * s))


def error(mean: ColumnOrName, truth: ColumnOrName) -> Column:
    """signed error mean - truth."""
    return _c(mean) - _c(truth)


def band(mean: ColumnOrName, std: ColumnOrName, k: float = 1.0) -> tuple[Column, Column]:
    """(mean - k*std, mean + k*std)."""
    return _c(mean) - F.lit(k) * _c(std), _c(mean) + F.lit(k) * _c(std)


def affine_forward(c: ColumnOrName, lo: ColumnOrName, span: ColumnOrName) -> Column:
    """(c - lo) / span."""
    return div(_c(c) - _c(lo), _c(span))


def affine_inverse(x: ColumnOrName, lo: ColumnOrName, span: ColumnOrName) -> Column:
    return _c(x) * _c(span) + _c(lo)


def mean_std_forward(c: ColumnOrName, mean: ColumnOrName, std: ColumnOrName) -> Column:
    """z-score."""
    return div(_c(c) - _c(mean), _c(std))


def mean_std_inverse(x: ColumnOrName, mean: ColumnOrName, std: ColumnOrName,
                     add_offset: bool = True) -> Column:
    """F12 inverse.  A predicted std is a scale: pass ``add_offset=False``."""
    out = _c(x) * _c(std)
    return out + _c(mean) if add_offset else out


def min_max_forward(c: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName,
                    feature_range: tuple[float, float] = (0.0, 1.0)) -> Column:
    """scale [lo, hi] onto ``feature_range``."""
    a, b = feature_range
    return div(_c(c) - _c(lo), _c(hi) - _c(lo)) * F.lit(b - a) + F.lit(a)


def min_max_inverse(x: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName,
                    feature_range: tuple[float, float] = (0.0, 1.0)) -> Column:
    a, b = feature_range
    return (_c(x) - F.lit(a)) / F.lit(b - a) * (_c(hi) - _c(lo)) + _c(lo)


def numeric_or_null(c: ColumnOrName) -> Column:
    """F16: a numeric-looking string (full match of the pattern) as DOUBLE, else NULL."""
    s = _c(c)
    return F.when(s.rlike(NUMERIC_STRING_PATTERN), s.try_cast("double"))


def numeric_or_null_array(c: ColumnOrName) -> Column:
    """F16 over an array of strings (element-wise, NULL for non-numeric elements)."""
    return F.transform(_c(c), numeric_or_null)


def store_path(base: ColumnOrName, name: ColumnOrName, year: ColumnOrName,
               suffix: str = ".zarr") -> Column:
    """``{base without trailing /}/{NAME}_{year}{suffix}``."""
    return F.concat(F.regexp_replace(_c(base), "/+$", ""), F.lit("/"), F.upper(_c(name)),
                    F.lit("_"), _c(year).cast("string"), F.lit(suffix))


def date_label(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """date text label."""
    return F.date_format(_c(c), fmt)
