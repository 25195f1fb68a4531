"""Queries: kernel neighbours, encoding, prediction, unnormalising and gap filling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fixture
from ..operators import dates as D
from ..operators import kernel as K
from ..operators import normalize as N
from ..operators import quality, sampling
from ..operators.tasks import cell_id
from .base import query, rounded
from .q_climate import sst_grid
from .q_tasks import _CP, _DATES5, _h

LS = 0.05          # length scale in normalised coordinates
RADIUS = 3 * LS    # compact support of the kernel
NOISE = 1.0
R2 = repr(RADIUS * RADIUS)
TWO_L2 = repr(2.0 * LS * LS)

_XY = ("(lat - cp.lo1) / ((cp.lo1 + cp.span) - cp.lo1) as x1, "
       "(lon - cp.lo2) / ((cp.lo2 + cp.span) - cp.lo2) as x2")

_KCTES = (
    f"with {_DATES5}, ad as (select time from d5 where time in (select time from sst_grid)), {_CP}, "
    "ctx as (select time as task_time, lat_idx * 4294967296 + lon_idx as point_id, " + _XY + ", sst as value "
    "from (select g.*, row_number() over (partition by time order by " + _h(42, "time, lat_idx, lon_idx") +
    ", lat_idx, lon_idx) as rn from sst_grid g where sst is not null and time in (select time from ad)) s, cp "
    "where rn <= 100), "
    "tgt as (select time as task_time, lat_idx * 4294967296 + lon_idx as target_id, " + _XY +
    " from sst_grid, cp where time in (select time from ad)), "
    "pairs as (select t.task_time, c.point_id, t.target_id, pow(c.x1 - t.x1, 2) + pow(c.x2 - t.x2, 2) as d2, "
    "c.value from tgt t join ctx c on c.task_time = t.task_time "
    f"where pow(c.x1 - t.x1, 2) + pow(c.x2 - t.x2, 2) <= {R2}), "
    f"s as (select task_time, target_id, sum(exp(-d2 / {TWO_L2})) as dens, "
    f"sum(exp(-d2 / {TWO_L2}) * value) as swy, sum(exp(-d2 / {TWO_L2}) * value * value) as swyy "
    "from pairs group by 1, 2) ")

_PRED = ("select t.task_time, t.target_id, round(s.swy / s.dens, 6) as mean, "
         "round(sqrt(greatest(coalesce(s.swyy / s.dens - (s.swy / s.dens) * (s.swy / s.dens), 0), 0) "
         f"+ {NOISE * NOISE!r} / (1 + coalesce(s.dens, 0))), 6) as std, round(coalesce(s.dens, 0), 6) as density "
         "from tgt t left join s on s.task_time = t.task_time and s.target_id = t.target_id")


def _inputs(spark, sf_dir, every=5):
    g = sst_grid(spark, sf_dir)
    cp = N.fit_coord_map(fixture(spark, sf_dir, "lakemask"))
    used = quality.available_dates(D.date_range_subsample(g, every), g)
    on_dates = g.join(used, "time", "left_semi")
    ctx = sampling.sample_n_rows(on_dates, 100, 42, by="time", value_col="sst")
    ctx = N.apply_coord_map(ctx, cp).select(F.col("time").alias("task_time"), cell_id().alias("point_id"),
                                            "x1", "x2", F.col("sst").alias("value"))
    tgt = N.apply_coord_map(on_dates, cp).select(F.col("time").alias("task_time"),
                                                 cell_id().alias("target_id"), "x1", "x2")
    return ctx, tgt


@query("kernel_neighbours",
       _KCTES + "select task_time, point_id, target_id, round(d2, 9) as d2 from pairs",
       uses=("sst_grid", "lakemask"))
def q_kernel_neighbours(spark, sf_dir):
    ctx, tgt = _inputs(spark, sf_dir)
    return rounded(K.kernel_neighbours(ctx, tgt, RADIUS).drop("value"), ["d2"], 9)


@query("kernel_encode",
       _KCTES + "select task_time, target_id, round(dens, 6) as density, round(swy / dens, 6) as signal from s",
       uses=("sst_grid", "lakemask"))
def q_kernel_encode(spark, sf_dir):
    ctx, tgt = _inputs(spark, sf_dir)
    return rounded(K.kernel_encode(ctx, tgt, LS, RADIUS), ["density", "signal"])


@query("predict_grid", _KCTES + _PRED, uses=("sst_grid", "lakemask"))
def q_predict_grid(spark, sf_dir):
    ctx, tgt = _inputs(spark, sf_dir)
    p = K.predict_grid(ctx, tgt, LS, NOISE, RADIUS)
    return rounded(p.select("task_time", "target_id", "mean", "std", "density"), ["mean", "std", "density"])


#: The daily series at one point: every date that the grid has, predicted from that date's context.
SERIES_SQL = (
    _KCTES.replace("interval 5 day", "interval 1 day").replace(
        "tgt as (select time as task_time, lat_idx * 4294967296 + lon_idx as target_id, " + _XY +
        " from sst_grid, cp where time in (select time from ad))",
        "tgt as (select time as task_time, 0::bigint as target_id, "
        "(45e0 - cp.lo1) / ((cp.lo1 + cp.span) - cp.lo1) as x1, "
        "(-85e0 - cp.lo2) / ((cp.lo2 + cp.span) - cp.lo2) as x2 from ad, cp)")
    + "select task_time, mean, std from (" + _PRED + ")")


def daily_series(spark, sf_dir):
    """Mean and std per available date at (45, -85)."""
    ctx, tgt = _inputs(spark, sf_dir, every=1)
    cp = N.fit_coord_map(fixture(spark, sf_dir, "lakemask"))
    point = (tgt.select("task_time").distinct()
             .select("task_time", F.lit(0).cast("bigint").alias("target_id"),
                     F.lit(45.0).alias("lat"), F.lit(-85.0).alias("lon")))
    point = N.apply_coord_map(point, cp).drop("lat", "lon")
    return rounded(K.predict_series(ctx, point, LS, NOISE, RADIUS), ["mean", "std"])


@query("predict_series", SERIES_SQL, uses=("sst_grid", "lakemask"))
def q_predict_series(spark, sf_dir):
    return daily_series(spark, sf_dir)


@query("unnormalise_pred",
       _KCTES.replace("sst as value from", "(sst - (select avg(sst) from sst_grid)) / "
                      "(select stddev_pop(sst) from sst_grid) as value from")
       + "select task_time, target_id, round(mean * (select stddev_pop(sst) from sst_grid) + "
       "(select avg(sst) from sst_grid), 6) as mean, round(std * (select stddev_pop(sst) from sst_grid), 6) as std "
       "from (select t.task_time, t.target_id, s.swy / s.dens as mean, "
       "sqrt(greatest(coalesce(s.swyy / s.dens - (s.swy / s.dens) * (s.swy / s.dens), 0), 0) "
       f"+ {NOISE * NOISE!r} / (1 + coalesce(s.dens, 0))) as std "
       "from tgt t left join s on s.task_time = t.task_time and s.target_id = t.target_id)",
       uses=("sst_grid", "lakemask"))
def q_unnormalise_pred(spark, sf_dir):
    g = sst_grid(spark, sf_dir)
    params = N.fit_mean_std(g, ["sst"])
    ctx, tgt = _inputs(spark, sf_dir)
    ctx = N.apply_mean_std(ctx.withColumnRenamed("value", "sst"), params, ["sst"]).withColumnRenamed("sst", "value")
    p = K.predict_grid(ctx, tgt, LS, NOISE, RADIUS)
    m = params.filter(F.col("var") == "sst").select(F.first("mean")).scalar()
    s = params.filter(F.col("var") == "sst").select(F.first("std")).scalar()
    out = K.unnormalise_pred(p, m, s).select("task_time", "target_id", "mean", "std")
    return rounded(out, ["mean", "std"])


_GF_R2 = repr(3.0 * 3.0)


@query("gap_fill",
       "with ctx as (select time, lat, lon, sst from sst_grid where sst is not null), "
       "tg as (select time, lat_idx, lon_idx, lat, lon from sst_grid where sst is null), "
       "pr as (select t.time, t.lat_idx, t.lon_idx, exp(-(pow(c.lat - t.lat, 2) + pow(c.lon - t.lon, 2)) / 2e0) as w, "
       "c.sst from tg t join ctx c on c.time = t.time "
       f"where pow(c.lat - t.lat, 2) + pow(c.lon - t.lon, 2) <= {_GF_R2}), "
       "s as (select time, lat_idx, lon_idx, sum(w) as dens, sum(w * sst) as swy, sum(w * sst * sst) as swyy "
       "from pr group by 1, 2, 3) "
       "select g.time, g.lat_idx, g.lon_idx, g.lat, g.lon, round(coalesce(g.sst, s.swy / s.dens), 6) as sst, "
       "g.sst is null and s.dens is not null as filled, "
       "round(case when g.sst is null then sqrt(greatest(coalesce(s.swyy / s.dens - (s.swy / s.dens) * "
       "(s.swy / s.dens), 0), 0) + 1e0 / (1 + coalesce(s.dens, 0))) end, 6) as fill_std "
       "from sst_grid g left join s on s.time = g.time and s.lat_idx = g.lat_idx and s.lon_idx = g.lon_idx",
       uses=("sst_grid",))
def q_gap_fill(spark, sf_dir):
    out = K.gap_fill(sst_grid(spark, sf_dir), "sst", lengthscale=1.0, noise=1.0, radius=3.0)
    return rounded(out, ["sst", "fill_std"])
