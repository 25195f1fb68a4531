"""Queries: cleaning, climatology, anomalies, masking, quality reports."""

from __future__ import annotations

from ..fixtures import fixture, fixtures
from ..functions import columns as C
from ..operators import climatology as clim
from ..operators import clean, grid, quality
from .base import query, rounded


def sst_grid(spark, sf_dir):
    """The SST cube cleaned by the library's own sentinel/NaN rule."""
    return clean.sentinel_to_null(fixture(spark, sf_dir, "sst_raw"))


@query("sentinel_to_null", "select * from sst_grid", uses=("sst_grid",))
def q_sentinel_to_null(spark, sf_dir):
    return sst_grid(spark, sf_dir)


@query("climatology",
       "select cast(month(time) as bigint) as month, lat_idx, lon_idx, round(avg(sst), 6) as sst "
       "from sst_grid group by 1, 2, 3", uses=("sst_grid",))
def q_climatology(spark, sf_dir):
    return rounded(clim.climatology(sst_grid(spark, sf_dir)), ["sst"])


_ANOM_SQL = ("with c as (select cast(month(time) as bigint) as m, lat_idx, lon_idx, avg(sst) as s "
             "from sst_grid group by 1, 2, 3) "
             "select g.time, g.lat_idx, g.lon_idx, g.lat, g.lon, round(g.sst - c.s, 6) as sst "
             "from sst_grid g left join c on cast(month(g.time) as bigint) = c.m "
             "and g.lat_idx = c.lat_idx and g.lon_idx = c.lon_idx")


@query("anomalies", _ANOM_SQL, uses=("sst_grid",))
def q_anomalies(spark, sf_dir):
    g = sst_grid(spark, sf_dir)
    return rounded(clim.anomalies(g, clim.climatology(g)), ["sst"])


@query("anomaly_window", _ANOM_SQL, uses=("sst_grid",))
def q_anomaly_window(spark, sf_dir):
    return rounded(clim.anomaly_window(sst_grid(spark, sf_dir)), ["sst"])


@query("time_mean",
       "select lat_idx, lon_idx, round(avg(sst), 6) as sst from sst_grid group by 1, 2",
       uses=("sst_grid",))
def q_time_mean(spark, sf_dir):
    return rounded(clim.time_mean(sst_grid(spark, sf_dir)), ["sst"])


@query("month_mean",
       "select lat_idx, lon_idx, round(avg(s), 6) as sst from (select cast(month(time) as bigint) m, "
       "lat_idx, lon_idx, avg(sst) as s from sst_grid group by 1, 2, 3) group by 1, 2",
       uses=("sst_grid",))
def q_month_mean(spark, sf_dir):
    return rounded(clim.month_mean(clim.climatology(sst_grid(spark, sf_dir))), ["sst"])


@query("anomaly_check",
       "with c as (select cast(month(time) as bigint) as m, lat_idx, lon_idx, avg(sst) as s "
       "from sst_grid group by 1, 2, 3), "
       "a as (select g.time, g.sst - c.s as sst from sst_grid g left join c "
       "on cast(month(g.time) as bigint) = c.m and g.lat_idx = c.lat_idx and g.lon_idx = c.lon_idx), "
       "d as (select time, avg(sst) as sst from a group by time) "
       "select cast(month(time) as bigint) as month, round(avg(sst), 6) as mean_anomaly from d group by 1",
       uses=("sst_grid",))
def q_anomaly_check(spark, sf_dir):
    g = sst_grid(spark, sf_dir)
    return rounded(clim.anomaly_check(clim.anomalies(g, clim.climatology(g)), "sst"), ["mean_anomaly"])


@query("mean_curve_spatial",
       "select round(avg(s), 6) as mean_of_means, count(s) as n_dates from "
       "(select time, avg(sst) as s from sst_grid group by time)", uses=("sst_grid",))
def q_mean_curve_spatial(spark, sf_dir):
    return rounded(clim.mean_curve_spatial(sst_grid(spark, sf_dir), "sst"), ["mean_of_means"])


@query("apply_mask",
       "select p.time, p.lat_idx, p.lon_idx, round(case when m.mask = 1 then p.mean end, 6) as mean, "
       "round(case when m.mask = 1 then p.std end, 6) as std "
       "from pred p join lakemask m on p.lat_idx = m.lat_idx and p.lon_idx = m.lon_idx",
       uses=("pred", "lakemask"))
def q_apply_mask(spark, sf_dir):
    pred, mask = fixtures(spark, sf_dir, "pred", "lakemask")
    return rounded(grid.apply_mask(pred, mask), ["mean", "std"])


@query("validate_grid",
       "select min(time) as time_min, max(time) as time_max, min(sst) as value_min, max(sst) as value_max, "
       "count(sst) as n_values, (select count(distinct time) from sst_grid) as n_time, "
       "(select count(distinct lat_idx) from sst_grid) as n_lat, "
       "(select count(distinct lon_idx) from sst_grid) as n_lon, "
       "round(100e0 * count(sst) / ((select count(distinct time) from sst_grid) * "
       "(select count(distinct lat_idx) from sst_grid) * (select count(distinct lon_idx) from sst_grid)), 6) "
       "as coverage_pct from sst_grid", uses=("sst_grid",))
def q_validate_grid(spark, sf_dir):
    return rounded(quality.validate_grid(sst_grid(spark, sf_dir), "sst"), ["coverage_pct"])


# --- flagship: monthly anomaly check of masked anomalies -------------------------------

_FLAGSHIP_SQL = (
    "with g as (select cast(time as date) as time, lat_idx, lon_idx, sst from sst_grid), "
    "c as (select cast(month(time) as bigint) as m, lat_idx, lon_idx, avg(sst) as s from g group by 1, 2, 3), "
    "a as (select g.time, g.lat_idx, g.lon_idx, g.sst - c.s as sst from g left join c "
    "on cast(month(g.time) as bigint) = c.m and g.lat_idx = c.lat_idx and g.lon_idx = c.lon_idx), "
    "m as (select a.time, case when k.mask = 1 then a.sst end as sst from a join lakemask k "
    "on a.lat_idx = k.lat_idx and a.lon_idx = k.lon_idx), "
    "d as (select time, avg(sst) as sst from m group by time) "
    "select cast(month(time) as bigint) as month, round(avg(sst), 6) as mean_anomaly from d group by 1")


def masked_anomaly_report(spark, sf_dir):
    """Scan -> fill values to NULL -> day dates -> monthly climatology -> anomalies ->
    lake mask -> monthly mean-anomaly check (S7, F1, A1, J1, J2, A20)."""
    raw, mask = fixtures(spark, sf_dir, "sst_raw", "lakemask")
    g = clean.sentinel_to_null(raw).withColumn("time", C.standardize_dates("time"))
    g = g.select("time", "lat_idx", "lon_idx", "sst")
    a = clim.anomalies(g, clim.climatology(g))
    masked = grid.apply_mask(a, mask)
    return rounded(clim.anomaly_check(masked, "sst"), ["mean_anomaly"])


query("masked_anomaly_report", _FLAGSHIP_SQL, uses=("sst_grid", "lakemask"))(masked_anomaly_report)
