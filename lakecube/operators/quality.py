"""Data-quality reports and date-set operators (SURVEY J8, J9, U2, U5, A7, A8,
A13-A15, A17, A19, F20)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize_small
from .clean import CELL, value_columns


def date_set(df: DataFrame, col: str = "time") -> DataFrame:
    """Distinct available dates (a DATE column named ``time``)."""
    return df.select(F.to_date(col).alias("time")).distinct()


def daily_range(df: DataFrame, start=None, end=None,
                col: str = "time") -> DataFrame:
    """Every day from ``start`` to ``end`` (defaults: the table's own first/last date).

    One row per day of the requested range; the range is bounded by the record
    length (≈ 10k days for 28 years) whatever the table size.
    """
    if start is None or end is None:
        ext = df.select(F.struct(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))).scalar()
    lo = F.lit(start).cast("date") if start is not None else ext.getField("lo")
    hi = F.lit(end).cast("date") if end is not None else ext.getField("hi")
    one = df.sparkSession.range(1)
    return one.select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("time"))


def available_dates(requested: DataFrame, data: DataFrame, col: str = "time") -> DataFrame:
    """Requested dates that exist in the data (left semi join)."""
    return requested.join(date_set(data, col), "time", "left_semi")


def missing_dates(df: DataFrame, start=None, end=None, col: str = "time") -> DataFrame:
    """Days of the expected daily range with no data (left anti join)."""
    return daily_range(df, start, end, col).join(date_set(df, col), "time", "left_anti")


def date_difference(df: DataFrame, start=None, end=None, col: str = "time") -> DataFrame:
    """Expected minus actual as a set difference (EXCEPT)."""
    return daily_range(df, start, end, col).subtract(date_set(df, col))


def axis_profile(grid: DataFrame, axes: Sequence[str], col: str | None = None, time_col: str | None = None) -> DataFrame:
    """One row per axis and label, with the range and count of ``col``: one pass over the grid.

    Every row adds to one group per axis; the groups are reduced before the
    shuffle, which carries one row per label and task.
    """
    at = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).cast("string").alias("label")) for a in axes]))
    value = F.col(col) if col else F.lit(None).cast("double")
    when = F.col(time_col) if time_col else F.lit(None).cast("date")
    return (grid.select(value.alias("__v"), when.alias("__t"), at.alias("__a")).groupBy("__a.axis", "__a.label")
            .agg(F.min("__v").alias("lo"), F.max("__v").alias("hi"), F.count("__v").alias("n"),
                 F.min("__t").alias("t_lo"), F.max("__t").alias("t_hi")))


def _labels(axis: str):
    return F.count_if((F.col("axis") == axis) & F.col("label").isNotNull())


def validate_grid(grid: DataFrame, col: str, time_col: str = "time") -> DataFrame:
    """Time range, axis sizes, value range and coverage in one row, from one pass over the grid.

    Coverage is counted against the dense cube (dates x lat x lon), the same as
    the fraction of non-missing cells of an array.
    """
    of_time = F.col("axis") == time_col
    out = axis_profile(grid, [time_col, "lat_idx", "lon_idx"], col, time_col).agg(
        F.min("t_lo").alias("time_min"), F.max("t_hi").alias("time_max"), F.min("lo").alias("value_min"), F.max("hi").alias("value_max"),
        F.coalesce(F.sum(F.when(of_time, F.col("n"))), F.lit(0)).alias("n_values"),
        _labels(time_col).alias("n_time"), _labels("lat_idx").alias("n_lat"), _labels("lon_idx").alias("n_lon"))
    return out.withColumn("coverage_pct", F.try_divide(F.lit(100.0) * F.col("n_values"), F.col("n_time") * F.col("n_lat") * F.col("n_lon")))


def validate_static(static: DataFrame, col: str) -> DataFrame:
    """A7 for a static field: sizes, range and coverage of the (lat, lon) grid."""
    n_lat = static.select(F.countDistinct("lat_idx")).scalar()
    n_lon = static.select(F.countDistinct("lon_idx")).scalar()
    return static.agg(F.min(col).alias("value_min"), F.max(col).alias("value_max"),
                      F.count(col).alias("n_values")).select(
        "*", n_lat.alias("n_lat"), n_lon.alias("n_lon"),
        F.try_divide(F.lit(100.0) * F.col("n_values"), n_lat * n_lon).alias("coverage_pct"))


def unique_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column (e.g. mask values)."""
    return df.select(col).distinct()


def all_null_point(grid: DataFrame, col: str) -> DataFrame:
    """Per cell, whether every value is missing (a land cell)."""
    return grid.groupBy(*CELL).agg((F.count(col) == 0).alias("all_null"),
                                   F.count(F.lit(1)).alias("n_rows"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed; empty bins kept.

    min/max are scalar subqueries; counting is a partial aggregate per bin;
    the bin axis (``bins`` rows) is generated and left-joined.
    """
    if bins < 1:
        raise ValueError("bins must be >= 1")
    ext = df.select(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    lo, hi = ext.getField("lo"), ext.getField("hi")
    width = (hi - lo) / F.lit(float(bins))
    # a constant column (hi = lo) puts every value in bin 0
    raw = F.floor(F.try_divide(F.col(col) - lo, hi - lo) * F.lit(float(bins)))
    b = F.when(raw.isNull(), F.lit(0)).when(raw > bins - 1, F.lit(bins - 1)).otherwise(raw)
    counts = df.filter(F.col(col).isNotNull()).groupBy(b.cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    axis = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return (axis.join(F.broadcast(counts), "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("lo"),
                    (lo + (F.col("bin") + 1) * width).alias("hi"),
                    F.coalesce("n", F.lit(0).cast("bigint")).alias("n")))


def count_by_year(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Rows per calendar year."""
    return df.groupBy(F.year(time_col).cast("bigint").alias("year")).agg(F.count(F.lit(1)).alias("n"))


def distinct_dates(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Number of distinct dates (one row)."""
    return date_set(df, time_col).agg(F.count(F.lit(1)).alias("n_dates"))


FETCH_ROWS = 100_000        # values ranked on the driver at most, for each percentile


def _at_ranks(df: DataFrame, rank: int, n: int) -> tuple[float, float]:
    """The values at ``rank`` and the next rank (0-based) among the ``n`` values of ``df.v``.

    A sketch gives two values around the rank (off by a ten-thousandth of the rows at most).  What lies below is counted exactly and what
    lies between is looked at alone: about a thousandth of the rows, in the same way again while that is too much to fetch.
    """
    while n > FETCH_ROWS:
        near = rank / (n - 1)
        lo, hi = df.agg(F.percentile_approx("v", [max(0.0, near - 5e-4), min(1.0, near + 5e-4)], 10_000)).first()[0]
        if near < 5e-4:
            lo = float("-inf")
        if near > 1 - 5e-4:
            hi = float("nan")                                   # the largest value of all in Spark's order
        inside = F.col("v").between(F.lit(lo), F.lit(hi))
        c = df.agg(F.count_if(F.col("v") < F.lit(lo)).alias("below"), F.count_if(inside).alias("n")).first()
        if not (c["below"] <= rank and min(rank + 1, n - 1) < c["below"] + c["n"]):
            break                                               # outside of the sketch's promise: rank all values
        df, rank = df.filter(inside), rank - c["below"]
        if c["n"] == n or lo == hi:
            break                                               # one value, or no progress
        n = c["n"]
    upto, found = 0, []
    # distinct values with their counts, in order; as many as FETCH_ROWS unless ties end the loop
    for r in df.groupBy("v").agg(F.count(F.lit(1)).alias("n")).orderBy("v").toLocalIterator():
        upto += r["n"]
        while len(found) < 2 and upto > rank + len(found):
            found.append(r["v"])
        if len(found) == 2:
            break
    return found[0], found[-1]


def robust_bounds(df: DataFrame, col: str, q: Sequence[float] = (0.02, 0.98)) -> DataFrame:
    """Exact 2nd/98th percentiles (linear interpolation between neighbouring ranks).

    Each is found by selection between sketched values (``_at_ranks``): aggregates only, no sort, window or
    write of the values.
    """
    spark = df.sparkSession
    v = df.filter(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("v"))
    total = v.count()
    names = [f"p{int(round(x * 100)):02d}" for x in q]
    if not total:
        return spark.createDataFrame([tuple(None for _ in q)], ", ".join(f"{n} double" for n in names))
    out = []
    for x in q:
        k, share = int(x * (total - 1)), x * (total - 1) - int(x * (total - 1))
        a, b = _at_ranks(v, k, total)
        out.append(a + share * (b - a))
    return spark.createDataFrame([tuple(out)], ", ".join(f"{n} double" for n in names))


def var_list_sizes(grid: DataFrame, time_col: str = "time") -> DataFrame:
    """variables and dimension sizes of a grid, as (kind, name, size) rows."""
    spark = grid.sparkSession
    variables = value_columns(grid)
    axes = {"time": time_col, "lat": "lat_idx", "lon": "lon_idx"}
    one = axis_profile(grid, list(axes.values())).agg(*[_labels(c).alias(n) for n, c in axes.items()])     # one pass
    dim_rows = one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("size")) for n in axes])).alias("d")).select("d.name", "d.size")
    var_rows = spark.createDataFrame([(v,) for v in variables], "name string").select(
        F.lit("var").alias("kind"), "name", F.lit(None).cast("bigint").alias("size"))
    return dim_rows.select(F.lit("dim").alias("kind"), "name", "size").unionByName(var_rows)
