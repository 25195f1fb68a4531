"""Grid alignment: masking, nearest regrid, bilinear sampling, block means
(SURVEY J2-J7, A9, W6).  All of them are separable: they work on small axis
tables first and only then touch the cube through equi-joins on integer keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize_small
from .clean import CELL, value_columns



def apply_mask(pred: DataFrame, mask: DataFrame, value_cols: Sequence[str] | None = None,
               mask_col: str = "mask", drop_land: bool = False) -> DataFrame:
    """Every variable becomes NULL where the mask is not 1 (``drop_land``:
    those rows are dropped instead).

    Inner join on the cell (labels must align); the static mask is broadcast
    after a size check, so the prediction is never shuffled.
    """
    if mask_col not in mask.columns:
        raise ValueError(f"the mask table has no column {mask_col!r}")
    cols = list(value_cols) if value_cols is not None else value_columns(pred)
    m = broadcast_if_small(mask.select(*CELL, F.col(mask_col).alias("__mask")))
    joined = pred.join(m, list(CELL), "inner")
    if drop_land:
        joined = joined.filter(F.col("__mask") == 1)
    return joined.select(*[F.when(F.col("__mask") == 1, F.col(c)).alias(c) if c in cols else F.col(c)
                           for c in pred.columns])


# --- axis tables -------------------------------------------------------------------------
# Windows without a partition key appear only here, on axis tables: one row per
# grid line (hundreds to a few thousand rows), never on the cube itself.

def axis_intervals(axis: DataFrame, label: str, idx: str | None = None) -> DataFrame:
    """Consecutive label pairs of an axis: (lo_idx, lo, hi_idx, hi, is_last)."""
    idx = idx or label
    w = Window.orderBy(F.col("lo"))
    a = axis.select(F.col(idx).alias("lo_idx"), F.col(label).alias("lo")).distinct()
    a = a.withColumns({"hi_idx": F.lead("lo_idx").over(w), "hi": F.lead("lo").over(w),
                       "is_last": F.lead("lo", 2).over(w).isNull()})
    return a.filter(F.col("hi").isNotNull())


def bracket(points: DataFrame, value: str, intervals: DataFrame, prefix: str,
            how: str = "left") -> DataFrame:
    """Attach the axis interval [lo, hi] that contains ``points[value]``.

    A range join done as an equi-join: the axis extent is cut into as many
    equal buckets as there are intervals, each interval is exploded into the
    buckets it overlaps, and a point joins only the intervals of its own
    bucket before the exact ``lo <= p < hi`` test (last interval closed).  The
    exploded interval table is size-checked before it is broadcast.  Points
    outside the axis get NULL brackets (``how='left'``) or are dropped.
    """
    # one scalar subquery (reused wherever it appears in the plan)
    ext = intervals.select(F.struct(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                    F.count(F.lit(1)).cast("double").alias("n"))).scalar()
    lo_min, hi_max, n = ext.getField("lo"), ext.getField("hi"), ext.getField("n")
    width = F.try_divide(hi_max - lo_min, n)        # NULL for an axis without intervals

    def bucket(c):
        return F.floor(F.try_divide(c - lo_min, width))

    iv = intervals.select(
        F.explode(F.sequence(bucket(F.col("lo")), bucket(F.col("hi")))).alias("__b"),
        F.col("lo_idx").alias(f"{prefix}_lo_idx"), F.col("lo").alias(f"{prefix}_lo"),
        F.col("hi_idx").alias(f"{prefix}_hi_idx"), F.col("hi").alias(f"{prefix}_hi"),
        F.col("is_last").alias(f"{prefix}_last"))
    iv = broadcast_if_small(iv)
    p = F.col(value)
    lo, hi, last = F.col(f"{prefix}_lo"), F.col(f"{prefix}_hi"), F.col(f"{prefix}_last")
    cond = ((F.col("__pb") == F.col("__b")) & (p >= lo) & ((p < hi) | ((p == hi) & last)))
    out = points.withColumn("__pb", bucket(p)).join(iv, cond, how)
    return (out.drop("__pb", "__b", f"{prefix}_last")
            .withColumn(f"{prefix}_t", (p - lo) / (hi - lo)))


def nearest_on_axis(points: DataFrame, value: str, axis: DataFrame, label: str,
                    idx: str | None = None, prefix: str = "n", prefer: str = "lower",
                    extrapolate: bool = False) -> DataFrame:
    """Nearest axis label for each point: adds ``{prefix}_idx`` and ``{prefix}``.

    ``prefer`` breaks exact ties ('lower' = interpolation rule, 'upper' = label
    selection rule).  Without ``extrapolate`` points outside the axis get NULL;
    with it they snap to the nearest end.
    """
    idx = idx or label
    iv = axis_intervals(axis, label, idx)
    src = points
    val = value
    ext = axis.select(F.struct(F.min(label).alias("lo"), F.max(label).alias("hi"),
                               F.min(idx).alias("lo_idx"))).scalar()
    if extrapolate:
        lo, hi = ext.getField("lo"), ext.getField("hi")
        v = F.col(value)
        # CASE form: a missing coordinate stays missing (least/greatest would skip NULL)
        src = points.withColumn("__clamped", F.when(v < lo, lo).when(v > hi, hi).otherwise(v))
        val = "__clamped"
    b = bracket(src, val, iv, "__br")
    p = F.col(val)
    d_lo = p - F.col("__br_lo")
    d_hi = F.col("__br_hi") - p
    take_lo = (d_lo < d_hi) | ((d_lo == d_hi) & F.lit(prefer == "lower"))
    # an axis with a single label has no interval: every point on it (or, with
    # extrapolation, every point) takes that label
    single = (ext.getField("lo") == ext.getField("hi")) & (
        (p == ext.getField("lo")) | F.lit(extrapolate)) & p.isNotNull()
    out = b.withColumns({
        f"{prefix}_idx": F.when(single, ext.getField("lo_idx"))
        .when(take_lo, F.col("__br_lo_idx")).otherwise(F.col("__br_hi_idx")),
        prefix: F.when(single, ext.getField("lo")).when(take_lo, F.col("__br_lo")).otherwise(F.col("__br_hi"))})
    return out.drop(*[c for c in out.columns if c.startswith("__br_")], "__clamped")


def nearest_axis_map(t_axis: DataFrame, t_val: str, s_axis: DataFrame, s_val: str, name: str,
                     prefer: str = "lower") -> DataFrame:
    """Nearest source label for every target label of two axis tables (no extrapolation).

    Both axes (one row per grid line) are sorted together once: for each
    target label the previous and next source labels come from running
    ``last``/``first`` windows, and the nearer one wins (ties -> ``prefer``).
    The window has no partition key and is only ever used on axis tables.
    """
    s = s_axis.select(F.col(s_val).cast("double").alias("__v"), F.lit(0).alias("__tag"),
                      F.col(s_val).alias("__s"))
    t = t_axis.select(F.col(t_val).cast("double").alias("__v"), F.lit(1).alias("__tag"),
                      F.lit(None).cast(s_axis.schema[s_val].dataType).alias("__s"), *t_axis.columns)
    u = s.unionByName(t, allowMissingColumns=True)
    w = Window.orderBy("__v", "__tag")
    prev = F.last("__s", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    nxt = F.first("__s", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    m = u.withColumns({"__p": prev, "__n": nxt}).filter(F.col("__tag") == 1)
    d_p = F.col("__v") - F.col("__p").cast("double")
    d_n = F.col("__n").cast("double") - F.col("__v")
    take_p = (d_p < d_n) | ((d_p == d_n) & F.lit(prefer == "lower"))
    pick = (F.when(d_p == 0, F.col("__p"))                        # on a source label (incl. the last)
            .when(F.col("__p").isNull() | F.col("__n").isNull(), F.lit(None))   # outside: no extrapolation
            .when(take_p, F.col("__p")).otherwise(F.col("__n")))
    return m.select(*t_axis.columns, pick.alias(name))


# --- regridding --------------------------------------------------------------------------

def regrid_nearest(source: DataFrame, target: DataFrame, value_cols: Sequence[str],
                   time_col: str = "time") -> DataFrame:
    """Values of ``source`` at every row of ``target`` by nearest neighbour on
    time, lat and lon (ties -> lower label; NULL outside the source's range).

    Separable: three axis maps (target label -> source label) are built on
    axis tables, broadcast after a size check, and the cube is touched by a
    single equi-join on (time, lat, lon) of the source.
    """
    def axis_map(t_axis, t_key, t_val, s_axis, s_val, name):
        # one sorted pass over the two axis tables, materialised once (one row per target label)
        return materialize_small(nearest_axis_map(t_axis, t_val, s_axis, s_val, name).select(t_key, name),
                                 "axis-map")

    t_time = target.select(time_col).distinct().withColumn("__d", F.unix_date(time_col).cast("double"))
    s_time = source.select(F.unix_date(time_col).cast("double").alias("__d")).distinct()
    m_time = axis_map(t_time, time_col, "__d", s_time, "__d", "__src_d")
    m_lat = axis_map(target.select("lat_idx", "lat").distinct(), "lat_idx", "lat",
                     source.select("lat").distinct(), "lat", "__src_lat")
    m_lon = axis_map(target.select("lon_idx", "lon").distinct(), "lon_idx", "lon",
                     source.select("lon").distinct(), "lon", "__src_lon")
    src = source.select(F.unix_date(time_col).cast("double").alias("__src_d"),
                        F.col("lat").alias("__src_lat"), F.col("lon").alias("__src_lon"),
                        *value_cols)
    keyed = (target.select(time_col, *CELL)
             .join(m_time, time_col, "left").join(m_lat, "lat_idx", "left").join(m_lon, "lon_idx", "left"))
    return (keyed.join(src, ["__src_d", "__src_lat", "__src_lon"], "left")
            .select(time_col, *CELL, *value_cols))


def bilinear_points(points: DataFrame, static: DataFrame, lat: str = "lat", lon: str = "lon",
                    value_col: str = "mask") -> DataFrame:
    """Bilinear value of a static field at each point, plus ``on_lake``.

    Points are bracketed on both axes (range join as above) and take their four
    corners by equi-joins on the cell, row by row: a point given twice gives two
    rows.  The value is NULL (and ``on_lake`` false) unless every corner with
    positive weight is there.  ``on_lake`` holds when all of those have value 1,
    i.e. the interpolated mask equals 1 exactly.  Points outside the grid are
    dropped (their interpolated value is missing).
    """
    lat_iv = axis_intervals(static.select("lat_idx", "lat"), "lat", "lat_idx")
    lon_iv = axis_intervals(static.select("lon_idx", "lon"), "lon", "lon_idx")
    pts = points.select(F.col(lat).alias("__plat"), F.col(lon).alias("__plon"), *points.columns)
    b = bracket(bracket(pts, "__plat", lat_iv, "__a", how="inner"), "__plon", lon_iv, "__o", how="inner")
    t1, t2 = F.col("__a_t"), F.col("__o_t")
    grid = broadcast_if_small(static.select(*CELL, F.col(value_col).alias("__v")))
    weights = {("lo", "lo"): (1 - t1) * (1 - t2), ("lo", "hi"): (1 - t1) * t2, ("hi", "lo"): t1 * (1 - t2), ("hi", "hi"): t1 * t2}
    terms, ones = [], []
    for (i, j), w in weights.items():
        side = grid.select(F.col("lat_idx").alias(f"__a_{i}_idx"), F.col("lon_idx").alias(f"__o_{j}_idx"), F.col("__v").alias(f"__v_{i}{j}"))
        b = b.join(side, [f"__a_{i}_idx", f"__o_{j}_idx"], "left")
        v = F.col(f"__v_{i}{j}")
        terms.append(F.when(w > 0, w * v).otherwise(F.lit(0.0)))         # NULL when a corner that counts is missing
        ones.append(F.when(w > 0, F.coalesce(v == 1, F.lit(False))).otherwise(F.lit(True)))
    return b.select(*points.columns, (terms[0] + terms[1] + terms[2] + terms[3]).alias("value"),
                    (ones[0] & ones[1] & ones[2] & ones[3]).alias("on_lake"))


def coarsen_mean(static: DataFrame, k_lat: int, k_lon: int, value_cols: Sequence[str]) -> DataFrame:
    """Block mean over k_lat x k_lon cells, trailing remainder trimmed,
    block coordinates = mean of the labels in the block."""
    if k_lat < 1 or k_lon < 1:
        raise ValueError("block sizes must be >= 1")
    def blocks(idx, label, k, name):
        ax = static.select(idx, label).distinct()
        pos = (F.row_number().over(Window.orderBy(label)) - 1)
        n = ax.select(F.count(F.lit(1))).scalar()
        ax = ax.withColumn("__pos", pos).filter(F.col("__pos") < F.floor(n / k) * k)
        return ax.select(idx, label, F.floor(F.col("__pos") / k).alias(name))

    la = broadcast_if_small(blocks("lat_idx", "lat", k_lat, "lat_block"))
    lo = broadcast_if_small(blocks("lon_idx", "lon", k_lon, "lon_block"))
    lat_c = la.groupBy("lat_block").agg(F.avg("lat").alias("lat"))
    lon_c = lo.groupBy("lon_block").agg(F.avg("lon").alias("lon"))
    agg = (static.select(*CELL, *value_cols)
           .join(la.select("lat_idx", "lat_block"), "lat_idx")
           .join(lo.select("lon_idx", "lon_block"), "lon_idx")
           .groupBy("lat_block", "lon_block").agg(*[F.avg(c).alias(c) for c in value_cols]))
    return agg.join(F.broadcast(lat_c), "lat_block").join(F.broadcast(lon_c), "lon_block")


def align_grids(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("time", *CELL),
                how: str = "left") -> DataFrame:
    """Two variables on identical labels side by side (equi-join on date and cell)."""
    return left.join(right, list(keys), how)


def merge_aux(static: DataFrame, series: DataFrame) -> DataFrame:
    """One table from (cell) variables and (time) variables.

    Each variable keeps its own dimensions, as in a dataset with mixed
    dimensions: rows of the static part have NULL time, rows of the time
    part NULL cell.  Consumers join each part on its own key; the
    (cell x time) product is never materialised.
    """
    shared = [c for c in static.columns if c in series.columns]
    if shared:
        return static.join(series, shared, "full_outer")
    return static.unionByName(series, allowMissingColumns=True)


def sample_at_points(grid: DataFrame, points: DataFrame, lat: str = "lat", lon: str = "lon",
                     value_cols: Sequence[str] | None = None) -> DataFrame:
    """Grid values at the cell nearest to each point (per axis, ties -> larger
    label, points beyond the edge snap to it), for every date of the grid.

    The point -> cell map is computed on axis tables, size-checked, broadcast
    and equi-joined to the cube on the integer cell key.
    """
    cols = list(value_cols) if value_cols is not None else value_columns(grid)
    lat_axis = materialize_small(grid.select("lat_idx", "lat").distinct())
    lon_axis = materialize_small(grid.select("lon_idx", "lon").distinct())
    m = nearest_on_axis(points, lat, lat_axis, "lat", "lat_idx", prefix="__nlat", prefer="upper", extrapolate=True)
    m = nearest_on_axis(m, lon, lon_axis, "lon", "lon_idx", prefix="__nlon", prefer="upper", extrapolate=True)
    cellmap = broadcast_if_small(m.select(*points.columns, F.col("__nlat_idx").alias("lat_idx"),
                                          F.col("__nlon_idx").alias("lon_idx")))
    when = ["time"] if "time" in grid.columns else []          # static fields have no time
    g = grid.select(*when, *CELL, *cols)
    return g.join(cellmap, list(CELL), "inner").select(*points.columns, *when, *CELL, *cols)


def buoys_on_lake(obs: DataFrame, mask: DataFrame, coord_params: DataFrame | None = None,
                  lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """M8: unique observation sites (U4) with both coordinates (P11), sorted (X8),
    kept where the bilinear lake mask is 1 (J6), with normalised x1/x2 (F11)."""
    from .normalize import apply_coord_map, fit_coord_map
    sites = (obs.select(F.col(lat).alias("lat"), F.col(lon).alias("lon")).dropDuplicates(["lat", "lon"])
             .dropna(subset=["lat", "lon"]))
    on = bilinear_points(sites, mask).filter("on_lake").select("lat", "lon")
    params = coord_params if coord_params is not None else fit_coord_map(mask)
    return apply_coord_map(on, params).orderBy("lat", "lon")
