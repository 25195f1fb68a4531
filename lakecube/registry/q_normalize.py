"""Queries: fit/apply normalisation, coordinate maps, config documents."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..fixtures import fixture
from ..functions import columns as C
from ..operators import clean
from ..operators import normalize as N
from ..session import scratch_path
from .base import query, rounded
from .q_climate import sst_grid

_P = ["mean", "std", "min", "max"]


def ice_grid(spark, sf_dir):
    """Ice cube with its -1 land sentinel turned into NULL."""
    return clean.sentinel_to_null(fixture(spark, sf_dir, "ice_raw"), sentinel=-1.0)


_ICE = ("with ice as (select time, lat, lon, case when ice_concentration = -1e0 then null "
        "else ice_concentration end as ice_concentration from ice_raw) ")

_FIT_MS_SQL = ("select 'sst' as var, 'mean_std' as method, round(avg(sst), 6) as mean, "
               "round(stddev_pop(sst), 6) as std, cast(null as double) as min, cast(null as double) as max "
               "from sst_grid")


@query("fit_mean_std", _FIT_MS_SQL, uses=("sst_grid",))
def q_fit_mean_std(spark, sf_dir):
    return rounded(N.fit_mean_std(sst_grid(spark, sf_dir), ["sst"]), _P)


@query("fit_min_max",
       _ICE + "select 'ice_concentration' as var, 'min_max' as method, cast(null as double) as mean, "
       "cast(null as double) as std, min(ice_concentration) as min, max(ice_concentration) as max from ice "
       "union all select 'sst', 'min_max', null, null, min(sst), max(sst) from sst_grid",
       uses=("ice_raw", "sst_grid"))
def q_fit_min_max(spark, sf_dir):
    return (N.fit_min_max(ice_grid(spark, sf_dir), ["ice_concentration"])
            .unionByName(N.fit_min_max(sst_grid(spark, sf_dir), ["sst"])))


_COORD_SQL = ("with r as (select min(lat) lo1, max(lat) hi1, min(lon) lo2, max(lon) hi2 from sst_grid) "
              "select 'x1' as axis, 'lat' as name, lo1 as lo, lo1 + greatest(hi1 - lo1, hi2 - lo2) as hi from r "
              "union all select 'x2', 'lon', lo2, lo2 + greatest(hi1 - lo1, hi2 - lo2) from r")


@query("fit_coord_map", _COORD_SQL, uses=("sst_grid",))
def q_fit_coord_map(spark, sf_dir):
    return N.fit_coord_map(sst_grid(spark, sf_dir))


@query("norm_mean_std",
       "with p as (select avg(sst) m, stddev_pop(sst) s from sst_grid) "
       "select time, lat_idx, lon_idx, round((sst - p.m) / p.s, 6) as sst from sst_grid, p",
       uses=("sst_grid",))
def q_norm_mean_std(spark, sf_dir):
    g = sst_grid(spark, sf_dir).select("time", "lat_idx", "lon_idx", "sst")
    return rounded(N.apply_mean_std(g, N.fit_mean_std(g, ["sst"]), ["sst"]), ["sst"])


@query("norm_min_max",
       _ICE + ", p as (select min(ice_concentration) lo, max(ice_concentration) hi from ice) "
       "select time, lat, lon, round((ice_concentration - p.lo) / (p.hi - p.lo), 6) as ice_concentration "
       "from ice, p", uses=("ice_raw",))
def q_norm_min_max(spark, sf_dir):
    ice = ice_grid(spark, sf_dir)
    return rounded(N.apply_min_max(ice, N.fit_min_max(ice, ["ice_concentration"]), ["ice_concentration"]),
                   ["ice_concentration"])


@query("norm_coords",
       "with r as (select min(lat) lo1, max(lat) hi1, min(lon) lo2, max(lon) hi2 from sst_grid), "
       "c as (select distinct lat_idx, lon_idx, lat, lon from sst_grid) "
       "select lat_idx, lon_idx, round((lat - lo1) / greatest(hi1 - lo1, hi2 - lo2), 6) as x1, "
       "round((lon - lo2) / greatest(hi1 - lo1, hi2 - lo2), 6) as x2 from c, r", uses=("sst_grid",))
def q_norm_coords(spark, sf_dir):
    g = sst_grid(spark, sf_dir)
    cells = g.select("lat_idx", "lon_idx", "lat", "lon").distinct()
    out = N.apply_coord_map(cells, N.fit_coord_map(g)).select("lat_idx", "lon_idx", "x1", "x2")
    return rounded(out, ["x1", "x2"])


@query("numeric_strings",
       "select o_orderkey, split_part(o_orderpriority, '-', 1) as token1, "
       "case when regexp_full_match(split_part(o_orderpriority, '-', 1), '[-+]?\\d*\\.?\\d+([eE][-+]?\\d+)?') "
       "then try_cast(split_part(o_orderpriority, '-', 1) as double) end as number1, "
       "case when regexp_full_match(split_part(o_orderpriority, '-', 2), '[-+]?\\d*\\.?\\d+([eE][-+]?\\d+)?') "
       "then try_cast(split_part(o_orderpriority, '-', 2) as double) end as number2 from orders")
def q_numeric_strings(spark, sf_dir):
    from ..session import read_table
    o = read_table(spark, sf_dir, "orders")
    t1 = F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(1))
    t2 = F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(2))
    return o.select("o_orderkey", t1.alias("token1"), C.numeric_or_null(t1).alias("number1"),
                    C.numeric_or_null(t2).alias("number2"))


@query("config_entries",
       "select event_id, k.key as key, cast(json_extract_string(props, '$.' || k.key) as bigint) as value "
       "from events, (select unnest(['k']) as key) k where json_extract_string(props, '$.' || k.key) is not null")
def q_config_entries(spark, sf_dir):
    from ..session import read_table
    ev = read_table(spark, sf_dir, "events")
    return N.config_entries(ev, "props", "event_id").withColumn("value", F.col("value").cast("bigint"))


def _roundtrip(spark, sf_dir):
    g = sst_grid(spark, sf_dir)
    params = N.fit_mean_std(g, ["sst"])
    path = scratch_path(spark, f"norm-params-{uuid.uuid4().hex}")
    N.save_norm_params(params, path, N.fit_coord_map(g))
    return N.load_norm_params(spark, path)


@query("save_norm_params",
       "select 'sst' as entry, 'mean_std' as method, round(avg(sst), 6) as p1, round(stddev_pop(sst), 6) as p2 from sst_grid "
       "union all select 'x1', 'lat', round(min(lat), 6), round(min(lat) + greatest(max(lat) - min(lat), max(lon) - min(lon)), 6) from sst_grid "
       "union all select 'x2', 'lon', round(min(lon), 6), round(min(lon) + greatest(max(lat) - min(lat), max(lon) - min(lon)), 6) from sst_grid",
       uses=("sst_grid",))
def q_save_norm_params(spark, sf_dir):
    """K6: the written JSON document, parsed: each variable's parameters and each axis' map."""
    variables, coords = _roundtrip(spark, sf_dir)
    rows = variables.select(F.col("var").alias("entry"), "method", F.col("mean").alias("p1"), F.col("std").alias("p2"))
    rows = rows.unionByName(coords.select(F.col("axis").alias("entry"), F.col("name").alias("method"), F.col("lo").alias("p1"), F.col("hi").alias("p2")))
    return rounded(rows, ["p1", "p2"])


@query("load_norm_params", _FIT_MS_SQL, uses=("sst_grid",))
def q_load_norm_params(spark, sf_dir):
    variables, _ = _roundtrip(spark, sf_dir)
    return rounded(variables, _P)


@query("load_coord_params", _COORD_SQL, uses=("sst_grid",))
def q_load_coord_params(spark, sf_dir):
    _, coords = _roundtrip(spark, sf_dir)
    return coords


@query("numeric_strings_array",
       "select o_orderkey, list_transform(string_split(o_orderpriority, '-'), lambda x: case when "
       "regexp_full_match(x, '[-+]?\\d*\\.?\\d+([eE][-+]?\\d+)?') then try_cast(x as double) end) as numbers "
       "from orders")
def q_numeric_strings_array(spark, sf_dir):
    from ..session import read_table
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", C.numeric_or_null_array(F.split("o_orderpriority", "-")).alias("numbers"))
