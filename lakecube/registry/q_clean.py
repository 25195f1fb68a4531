"""Queries: projections, selections, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fixture
from ..functions import columns as C
from ..operators import clean, quality
from .base import query, rounded
from .q_climate import sst_grid
from .q_normalize import _ICE, ice_grid

_G = "time, lat_idx, lon_idx, lat, lon, sst"


@query("drop_vars", f"select {_G} from sst_grid", uses=("sst_grid",))
def q_drop_vars(spark, sf_dir):
    g = sst_grid(spark, sf_dir).withColumn("crs", F.lit(0).cast("bigint"))
    return clean.drop_vars(g, "crs", "not_present")


@query("rename_vars",
       "select obs, cast(time as varchar) as time, latitude as lat, longitude as lon, "
       "temperature_k as sst from buoy_obs", uses=("buoy_obs",))
def q_rename_vars(spark, sf_dir):
    o = fixture(spark, sf_dir, "buoy_obs")
    out = clean.rename_vars(o, {"latitude": "lat", "longitude": "lon", "temperature_k": "sst", "Band1": "depth"})
    return out.withColumn("time", F.col("time").cast("string"))


@query("select_var", _ICE + "select time, lat, lon, ice_concentration as ice from ice", uses=("ice_raw",))
def q_select_var(spark, sf_dir):
    return clean.select_var(ice_grid(spark, sf_dir), ["ice", "ice_concentration"],
                            keys=["time", "lat", "lon"], alias="ice")


@query("time_slice", f"select {_G} from sst_grid where time between date '1997-01-01' and date '1997-12-31'",
       uses=("sst_grid",))
def q_time_slice(spark, sf_dir):
    return clean.time_slice(sst_grid(spark, sf_dir), "1997-01-01", "1997-12-31")


@query("time_exact", f"select {_G} from sst_grid where time in (date '1996-03-01', date '1998-07-04')",
       uses=("sst_grid",))
def q_time_exact(spark, sf_dir):
    return clean.time_exact(sst_grid(spark, sf_dir), ["1996-03-01", "1998-07-04"])


@query("time_nearest",
       _ICE + "select * from ice where time = (select time from (select distinct time from ice) "
       "order by abs(date_diff('day', time, date '1997-10-25')), time desc limit 1)", uses=("ice_raw",))
def q_time_nearest(spark, sf_dir):
    return clean.time_nearest(ice_grid(spark, sf_dir), "1997-10-25")


@query("bbox", f"select {_G} from sst_grid where lat between 40e0 and 45e0 and lon between -90e0 and -85e0",
       uses=("sst_grid",))
def q_bbox(spark, sf_dir):
    return clean.bbox(sst_grid(spark, sf_dir), (40.0, 45.0), (-90.0, -85.0))


@query("cell_nearest",
       f"select {_G} from sst_grid where lat_idx = (select lat_idx from (select distinct lat_idx, lat from "
       "sst_grid) order by abs(lat - 42.125e0), lat desc limit 1) and lon_idx = (select lon_idx from "
       "(select distinct lon_idx, lon from sst_grid) order by abs(lon - (-88.1e0)), lon desc limit 1)",
       uses=("sst_grid",))
def q_cell_nearest(spark, sf_dir):
    return clean.cell_nearest(sst_grid(spark, sf_dir), 42.125, -88.1)


@query("where_positive",
       "select lat_idx, lon_idx, case when depth > 0 then depth end as depth from bathymetry",
       uses=("bathymetry",))
def q_where_positive(spark, sf_dir):
    b = fixture(spark, sf_dir, "bathymetry")
    return b.select("lat_idx", "lon_idx", C.where_positive("depth").alias("depth"))


@query("drop_null_coords", "select * from buoy_obs where latitude is not null and longitude is not null",
       uses=("buoy_obs",))
def q_drop_null_coords(spark, sf_dir):
    return clean.drop_null_coords(fixture(spark, sf_dir, "buoy_obs"))


@query("mask_filter", "select * from lakemask where mask = 1", uses=("lakemask",))
def q_mask_filter(spark, sf_dir):
    return clean.mask_filter(fixture(spark, sf_dir, "lakemask"))


@query("split_by_date",
       f"select {_G}, case when time between date '1995-01-01' and date '1998-12-31' then 'train' "
       "else 'val' end as split from sst_grid where time between date '1995-01-01' and date '1998-12-31' "
       "or time between date '1999-01-01' and date '2000-12-31'", uses=("sst_grid",))
def q_split_by_date(spark, sf_dir):
    return clean.split_by_date(sst_grid(spark, sf_dir), "custom",
                               train=("1995-01-01", "1998-12-31"), val=("1999-01-01", "2000-12-31"))


@query("limit_report",
       "with d as (select distinct cast(o_orderdate as date) as time from orders), "
       "r as (select unnest(generate_series((select min(time) from d), (select max(time) from d), "
       "interval 1 day))::date as time), m as (select time from r where time not in (select time from d)) "
       "select time, cast(greatest((select count(*) from m) - 20, 0) as bigint) as n_more "
       "from m order by time limit 20")
def q_limit_report(spark, sf_dir):
    from ..session import read_table
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("time"))
    return clean.limit_report(quality.missing_dates(o), ["time"], 20)


@query("overlap_slice",
       _ICE + "select * from ice where time between (select min(time) from sst_grid) "
       "and (select max(time) from sst_grid)", uses=("ice_raw", "sst_grid"))
def q_overlap_slice(spark, sf_dir):
    return clean.overlap_slice(ice_grid(spark, sf_dir), sst_grid(spark, sf_dir))


@query("standardize_dates", "select obs, cast(time as date) as time from buoy_obs", uses=("buoy_obs",))
def q_standardize_dates(spark, sf_dir):
    o = fixture(spark, sf_dir, "buoy_obs")
    return clean.standardize_dates(o).select("obs", "time")


@query("clip",
       _ICE + "select time, lat, lon, case when ice_concentration / 100e0 < 0 then 0e0 "
       "when ice_concentration / 100e0 > 1 then 1e0 else ice_concentration / 100e0 end as ice from ice",
       uses=("ice_raw",))
def q_clip(spark, sf_dir):
    i = ice_grid(spark, sf_dir)
    return i.select("time", "lat", "lon", C.clip(F.col("ice_concentration") / 100.0).alias("ice"))


@query("rescale_cast",
       _ICE + "select time, lat, lon, cast(ice_concentration / 100e0 as float) as ice from ice",
       uses=("ice_raw",))
def q_rescale_cast(spark, sf_dir):
    i = ice_grid(spark, sf_dir)
    return i.select("time", "lat", "lon", C.rescale_cast("ice_concentration", 100.0).alias("ice"))


@query("transform_ice",
       "select time, lat_idx, lon_idx, case when sst is null then null when sst / 100e0 > 0.2e0 then 0 "
       "else 1 end::bigint as binary_ice_indicator from sst_grid", uses=("sst_grid",))
def q_transform_ice(spark, sf_dir):
    g = sst_grid(spark, sf_dir)
    return g.select("time", "lat_idx", "lon_idx",
                    C.transform_ice(F.col("sst") / 100.0).alias("binary_ice_indicator"))


@query("water_mask",
       "select lat_idx, lon_idx, coalesce(cast(depth > 0 as bigint), 0) as mask from bathymetry",
       uses=("bathymetry",))
def q_water_mask(spark, sf_dir):
    b = fixture(spark, sf_dir, "bathymetry")
    return b.select("lat_idx", "lon_idx", C.water_mask("depth").alias("mask"))


@query("circ_time",
       "select time, round(cos(2 * pi() * dayofyear(time) / 365.25e0), 6) as cos_D, "
       "round(sin(2 * pi() * dayofyear(time) / 365.25e0), 6) as sin_D from "
       "(select unnest(generate_series((select min(time) from sst_grid), (select max(time) from sst_grid), "
       "interval 1 day))::date as time)", uses=("sst_grid",))
def q_circ_time(spark, sf_dir):
    from ..operators.dates import circ_time_table
    return rounded(circ_time_table(sst_grid(spark, sf_dir)), ["cos_D", "sin_D"])


@query("date_parts",
       "select distinct time, cast(month(time) as bigint) as month, cast(year(time) as bigint) as year "
       "from sst_grid", uses=("sst_grid",))
def q_date_parts(spark, sf_dir):
    d = quality.date_set(sst_grid(spark, sf_dir))
    return d.select("time", F.month("time").cast("bigint").alias("month"),
                    F.year("time").cast("bigint").alias("year"))


@query("date_label",
       "select distinct time, strftime(time, '%Y-%m-%d') as label, strftime(time, '%Y%m%d') as run_id "
       "from sst_grid", uses=("sst_grid",))
def q_date_label(spark, sf_dir):
    d = quality.date_set(sst_grid(spark, sf_dir))
    return d.select("time", C.date_label("time").alias("label"),
                    C.date_label("time", "yyyyMMdd").alias("run_id"))
