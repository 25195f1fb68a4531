"""Queries: axis tables, regridding, bilinear sampling, block means, alignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fixture, fixtures
from ..functions import columns as C
from ..operators import clean, grid
from .base import query, rounded
from .q_climate import sst_grid
from .q_normalize import _ICE, ice_grid


def _nearest_sql(t_from: str, t_key: str, t_val: str, s_from: str, s_val: str,
                 prefer: str = "lower", extrapolate: bool = False, dist: str | None = None) -> str:
    """Oracle form of a nearest-label map (cross product + row_number, fine at test size)."""
    d = dist or f"abs(s.{s_val} - t.{t_val})"
    order = f"{d}, s.{s_val} {'asc' if prefer == 'lower' else 'desc'}"
    where = "" if extrapolate else (f"where t.{t_val} between (select min({s_val}) from {s_from}) "
                                    f"and (select max({s_val}) from {s_from})")
    return (f"select {t_key}, src from (select t.{t_key}, s.{s_val} as src, row_number() over "
            f"(partition by t.{t_key} order by {order}) as rn from {t_from} t, {s_from} s {where}) where rn = 1")


@query("axis_interval",
       "select lo_idx, lo, hi_idx, hi, is_last from (select lat_idx as lo_idx, lat as lo, "
       "lead(lat_idx) over (order by lat) as hi_idx, lead(lat) over (order by lat) as hi, "
       "lead(lat, 2) over (order by lat) is null as is_last "
       "from (select distinct lat_idx, lat from sst_grid)) where hi is not null", uses=("sst_grid",))
def q_axis_interval(spark, sf_dir):
    return grid.axis_intervals(sst_grid(spark, sf_dir).select("lat_idx", "lat"), "lat", "lat_idx")


@query("axis_index",
       _ICE + "select lat, cast(row_number() over (order by lat) - 1 as bigint) as lat_pos "
       "from (select distinct lat from ice)", uses=("ice_raw",))
def q_axis_index(spark, sf_dir):
    return clean.axis_index(ice_grid(spark, sf_dir).select("lat").distinct(), "lat")


@query("isel",
       "select g.* from sst_grid g join (select lon, row_number() over (order by lon) - 1 as pos "
       "from (select distinct lon from sst_grid)) a on g.lon = a.lon where a.pos between 5 and 9",
       uses=("sst_grid",))
def q_isel(spark, sf_dir):
    return clean.isel(sst_grid(spark, sf_dir), "lon", 5, 10)


_REGRID_SQL = (
    _ICE + ", tt as (select distinct time from sst_grid), st as (select distinct time from ice), "
    "tla as (select distinct lat_idx, lat from sst_grid), sla as (select distinct lat from ice), "
    "tlo as (select distinct lon_idx, lon from sst_grid), slo as (select distinct lon from ice), "
    "mt as (" + _nearest_sql("tt", "time", "time", "st", "time",
                             dist="abs(date_diff('day', s.time, t.time))") + "), "
    "mla as (" + _nearest_sql("tla", "lat_idx", "lat", "sla", "lat") + "), "
    "mlo as (" + _nearest_sql("tlo", "lon_idx", "lon", "slo", "lon") + ") ")


@query("regrid_nearest",
       _REGRID_SQL + "select g.time, g.lat_idx, g.lon_idx, i.ice_concentration from sst_grid g "
       "left join mt on g.time = mt.time left join mla on g.lat_idx = mla.lat_idx "
       "left join mlo on g.lon_idx = mlo.lon_idx "
       "left join ice i on i.time = mt.src and i.lat = mla.src and i.lon = mlo.src",
       uses=("ice_raw", "sst_grid"))
def q_regrid_nearest(spark, sf_dir):
    return grid.regrid_nearest(ice_grid(spark, sf_dir), sst_grid(spark, sf_dir), ["ice_concentration"])


_BILINEAR_CTES = (
    "with pts as (select distinct latitude as lat, longitude as lon from buoy_obs "
    "where latitude is not null and longitude is not null), "
    "la as (select * from (select lat_idx as i0, lat as a0, lead(lat_idx) over (order by lat) as i1, "
    "lead(lat) over (order by lat) as a1, lead(lat, 2) over (order by lat) is null as last "
    "from (select distinct lat_idx, lat from lakemask)) where a1 is not null), "
    "lo as (select * from (select lon_idx as j0, lon as b0, lead(lon_idx) over (order by lon) as j1, "
    "lead(lon) over (order by lon) as b1, lead(lon, 2) over (order by lon) is null as last "
    "from (select distinct lon_idx, lon from lakemask)) where b1 is not null), "
    "br as (select p.lat, p.lon, la.i0, la.i1, (p.lat - la.a0) / (la.a1 - la.a0) as t1, "
    "lo.j0, lo.j1, (p.lon - lo.b0) / (lo.b1 - lo.b0) as t2 from pts p "
    "join la on p.lat >= la.a0 and (p.lat < la.a1 or (p.lat = la.a1 and la.last)) "
    "join lo on p.lon >= lo.b0 and (p.lon < lo.b1 or (p.lon = lo.b1 and lo.last))), "
    "cr as (select lat, lon, i0 as i, j0 as j, (1 - t1) * (1 - t2) as w from br "
    "union all select lat, lon, i0, j1, (1 - t1) * t2 from br "
    "union all select lat, lon, i1, j0, t1 * (1 - t2) from br "
    "union all select lat, lon, i1, j1, t1 * t2 from br), "
    "bl as (select cr.lat, cr.lon, case when count(*) filter (cr.w > 0 and m.mask is null) = 0 "
    "then sum(case when cr.w > 0 then cr.w * m.mask else 0 end) end as value, "
    "count(*) filter (cr.w > 0 and m.mask is distinct from 1) = 0 as on_lake from cr "
    "left join lakemask m on m.lat_idx = cr.i and m.lon_idx = cr.j group by cr.lat, cr.lon) ")


@query("bilinear_points",
       _BILINEAR_CTES + "select lat, lon, round(value, 6) as value, on_lake from bl",
       uses=("buoy_obs", "lakemask"))
def q_bilinear_points(spark, sf_dir):
    obs, mask = fixtures(spark, sf_dir, "buoy_obs", "lakemask")
    sites = (obs.select(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
             .dropDuplicates().dropna())
    return rounded(grid.bilinear_points(sites, mask), ["value"])


@query("buoys_on_lake",
       _BILINEAR_CTES + ", r as (select min(lat) lo1, max(lat) hi1, min(lon) lo2, max(lon) hi2 from lakemask) "
       "select bl.lat, bl.lon, round((bl.lat - lo1) / greatest(hi1 - lo1, hi2 - lo2), 6) as x1, "
       "round((bl.lon - lo2) / greatest(hi1 - lo1, hi2 - lo2), 6) as x2 from bl, r where on_lake",
       uses=("buoy_obs", "lakemask"))
def q_buoys_on_lake(spark, sf_dir):
    obs, mask = fixtures(spark, sf_dir, "buoy_obs", "lakemask")
    return rounded(grid.buoys_on_lake(obs, mask), ["x1", "x2"])


@query("coarsen_mean",
       "with la as (select lat_idx, lat, row_number() over (order by lat) - 1 as p from "
       "(select distinct lat_idx, lat from bathymetry)), "
       "lo as (select lon_idx, lon, row_number() over (order by lon) - 1 as p from "
       "(select distinct lon_idx, lon from bathymetry)), "
       "lb as (select lat_idx, lat, floor(p / 7) as lat_block from la "
       "where p < floor((select count(*) from la) / 7) * 7), "
       "ob as (select lon_idx, lon, floor(p / 7) as lon_block from lo "
       "where p < floor((select count(*) from lo) / 7) * 7), "
       "a as (select lat_block, lon_block, avg(depth) as depth from bathymetry b "
       "join lb on b.lat_idx = lb.lat_idx join ob on b.lon_idx = ob.lon_idx group by 1, 2) "
       "select cast(a.lat_block as bigint) as lat_block, cast(a.lon_block as bigint) as lon_block, "
       "round(a.depth, 6) as depth, round(x.lat, 6) as lat, round(y.lon, 6) as lon from a "
       "join (select lat_block, avg(lat) as lat from lb group by 1) x on a.lat_block = x.lat_block "
       "join (select lon_block, avg(lon) as lon from ob group by 1) y on a.lon_block = y.lon_block",
       uses=("bathymetry",))
def q_coarsen_mean(spark, sf_dir):
    out = grid.coarsen_mean(fixture(spark, sf_dir, "bathymetry"), 7, 7, ["depth"])
    return rounded(out.withColumns({"lat_block": F.col("lat_block").cast("bigint"),
                                    "lon_block": F.col("lon_block").cast("bigint")}),
                   ["depth", "lat", "lon"])


@query("align_grids",
       "select g.time, g.lat_idx, g.lon_idx, g.sst, round(p.mean, 6) as mean from sst_grid g "
       "left join pred p on g.time = p.time and g.lat_idx = p.lat_idx and g.lon_idx = p.lon_idx",
       uses=("sst_grid", "pred"))
def q_align_grids(spark, sf_dir):
    g = sst_grid(spark, sf_dir).select("time", "lat_idx", "lon_idx", "sst")
    p = fixture(spark, sf_dir, "pred").select("time", "lat_idx", "lon_idx", "mean")
    return rounded(grid.align_grids(g, p), ["mean"])


@query("merge_aux",
       "select lat_idx, lon_idx, depth, cast(null as date) as time, cast(null as double) as cos_D, "
       "cast(null as double) as sin_D from bathymetry union all "
       "select null, null, null, time, round(cos(2 * pi() * dayofyear(time) / 365.25e0), 6), "
       "round(sin(2 * pi() * dayofyear(time) / 365.25e0), 6) from (select distinct time from sst_grid)",
       uses=("bathymetry", "sst_grid"))
def q_merge_aux(spark, sf_dir):
    b = fixture(spark, sf_dir, "bathymetry").select("lat_idx", "lon_idx", "depth")
    cos_d, sin_d = C.circ_time("time")
    t = sst_grid(spark, sf_dir).select("time").distinct().select("time", cos_d.alias("cos_D"),
                                                                  sin_d.alias("sin_D"))
    return rounded(grid.merge_aux(b, t), ["cos_D", "sin_D"])


@query("sample_at_points",
       "with pts as (select distinct latitude as lat, longitude as lon from buoy_obs "
       "where latitude is not null and longitude is not null), "
       "tla as (select distinct lat_idx, lat from sst_grid), tlo as (select distinct lon_idx, lon from sst_grid), "
       "pl as (select lat, lon, i from (select p.lat, p.lon, a.lat_idx as i, row_number() over (partition by "
       "p.lat, p.lon order by abs(a.lat - least(greatest(p.lat, (select min(lat) from tla)), "
       "(select max(lat) from tla))), a.lat desc) rn from pts p, tla a) where rn = 1), "
       "po as (select lat, lon, j from (select p.lat, p.lon, b.lon_idx as j, row_number() over (partition by "
       "p.lat, p.lon order by abs(b.lon - least(greatest(p.lon, (select min(lon) from tlo)), "
       "(select max(lon) from tlo))), b.lon desc) rn from pts p, tlo b) where rn = 1) "
       "select pl.lat, pl.lon, g.time, g.lat_idx, g.lon_idx, g.sst from pl join po on pl.lat = po.lat "
       "and pl.lon = po.lon join sst_grid g on g.lat_idx = pl.i and g.lon_idx = po.j",
       uses=("buoy_obs", "sst_grid"))
def q_sample_at_points(spark, sf_dir):
    obs = fixture(spark, sf_dir, "buoy_obs")
    pts = (obs.select(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
           .dropDuplicates().dropna())
    return grid.sample_at_points(sst_grid(spark, sf_dir), pts, value_cols=["sst"])
