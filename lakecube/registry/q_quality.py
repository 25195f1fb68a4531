"""Queries: date sets, data-quality reports, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fixture
from ..operators import clean, dates, quality, sets
from ..session import read_table
from .base import query, rounded
from .q_climate import sst_grid

_ORDER_DATES = "(select distinct cast(o_orderdate as date) as time from orders)"
_EXPECTED = ("(select unnest(generate_series((select min(time) from d), (select max(time) from d), "
             "interval 1 day))::date as time)")


def order_dates(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("time"))


@query("missing_dates",
       f"with d as {_ORDER_DATES}, r as {_EXPECTED} select time from r where time not in (select time from d)")
def q_missing_dates(spark, sf_dir):
    return quality.missing_dates(order_dates(spark, sf_dir))


@query("date_difference",
       f"with d as {_ORDER_DATES}, r as {_EXPECTED} select time from r except select time from d")
def q_date_difference(spark, sf_dir):
    return quality.date_difference(order_dates(spark, sf_dir))


@query("date_range_subsample",
       "select unnest(generate_series((select min(time) from sst_grid), (select max(time) from sst_grid), "
       "interval 5 day))::date as time", uses=("sst_grid",))
def q_date_range_subsample(spark, sf_dir):
    return dates.date_range_subsample(sst_grid(spark, sf_dir), 5)


@query("available_dates",
       "with r as (select unnest(generate_series(date '1995-01-01', date '2001-12-31', interval 5 day))::date "
       f"as time) select time from r where time in {_ORDER_DATES}")
def q_available_dates(spark, sf_dir):
    o = order_dates(spark, sf_dir)
    req = dates.date_range_subsample(o, 5, "1995-01-01", "2001-12-31")
    return quality.available_dates(req, o)


@query("every_kth",
       "select time from (select time, row_number() over (order by time) - 1 as rn from "
       "(select distinct time from sst_grid)) where rn % 7 = 0", uses=("sst_grid",))
def q_every_kth(spark, sf_dir):
    return dates.every_kth(quality.date_set(sst_grid(spark, sf_dir)), 7)


@query("date_set", "select distinct time from sst_grid", uses=("sst_grid",))
def q_date_set(spark, sf_dir):
    return quality.date_set(sst_grid(spark, sf_dir))


@query("distinct_dates", "select count(distinct time) as n_dates from sst_grid", uses=("sst_grid",))
def q_distinct_dates(spark, sf_dir):
    return quality.distinct_dates(sst_grid(spark, sf_dir))


@query("validate_static",
       "select min(depth) as value_min, max(depth) as value_max, count(depth) as n_values, "
       "(select count(distinct lat_idx) from bathymetry) as n_lat, "
       "(select count(distinct lon_idx) from bathymetry) as n_lon, "
       "round(100e0 * count(depth) / ((select count(distinct lat_idx) from bathymetry) * "
       "(select count(distinct lon_idx) from bathymetry)), 6) as coverage_pct from bathymetry",
       uses=("bathymetry",))
def q_validate_static(spark, sf_dir):
    return rounded(quality.validate_static(fixture(spark, sf_dir, "bathymetry"), "depth"), ["coverage_pct"])


@query("unique_values", "select distinct mask from lakemask", uses=("lakemask",))
def q_unique_values(spark, sf_dir):
    return quality.unique_values(fixture(spark, sf_dir, "lakemask"), "mask")


@query("all_null_point",
       "select lat_idx, lon_idx, count(sst) = 0 as all_null, count(*) as n_rows from sst_grid group by 1, 2",
       uses=("sst_grid",))
def q_all_null_point(spark, sf_dir):
    return quality.all_null_point(sst_grid(spark, sf_dir), "sst")


@query("histogram",
       "with s as (select min(temperature_k) lo, max(temperature_k) hi from buoy_obs), "
       "c as (select cast(least(floor((temperature_k - s.lo) / (s.hi - s.lo) * 50e0), 49) as bigint) as bin, "
       "count(*) as n from buoy_obs, s where temperature_k is not null group by 1) "
       "select b.range as bin, s.lo + b.range * ((s.hi - s.lo) / 50e0) as lo, "
       "s.lo + (b.range + 1) * ((s.hi - s.lo) / 50e0) as hi, coalesce(c.n, 0) as n "
       "from range(50) b cross join s left join c on c.bin = b.range", uses=("buoy_obs",))
def q_histogram(spark, sf_dir):
    return quality.histogram(fixture(spark, sf_dir, "buoy_obs"), "temperature_k", 50)


@query("count_by_year",
       "select cast(year(time) as bigint) as year, count(*) as n from order_obs group by 1",
       uses=("order_obs",))
def q_count_by_year(spark, sf_dir):
    return quality.count_by_year(fixture(spark, sf_dir, "order_obs"))


@query("robust_bounds",
       "select round(quantile_cont(sst, 0.02), 6) as p02, round(quantile_cont(sst, 0.98), 6) as p98 "
       "from sst_grid", uses=("sst_grid",))
def q_robust_bounds(spark, sf_dir):
    return rounded(quality.robust_bounds(sst_grid(spark, sf_dir), "sst"), ["p02", "p98"])


@query("var_list_sizes",
       "select 'dim' as kind, 'time' as name, count(distinct time) as size from sst_grid "
       "union all select 'dim', 'lat', count(distinct lat_idx) from sst_grid "
       "union all select 'dim', 'lon', count(distinct lon_idx) from sst_grid "
       "union all select 'var', 'sst', null", uses=("sst_grid",))
def q_var_list_sizes(spark, sf_dir):
    return quality.var_list_sizes(sst_grid(spark, sf_dir))


@query("concat_years",
       "select * from sst_grid union all select * from sst_grid where year(time) = 1996", uses=("sst_grid",))
def q_concat_years(spark, sf_dir):
    g = sst_grid(spark, sf_dir)
    first, last = g.agg(F.min(F.year("time")), F.max(F.year("time"))).first()
    years = [g.filter(F.year("time") == y) for y in range(first, last + 1)]
    return sets.concat_years([*years, g.filter(F.year("time") == 1996)])       # a year given twice stays twice


@query("unique_coords",
       "select distinct latitude as lat, longitude as lon from buoy_obs", uses=("buoy_obs",))
def q_unique_coords(spark, sf_dir):
    o = clean.rename_vars(fixture(spark, sf_dir, "buoy_obs"), {"latitude": "lat", "longitude": "lon"})
    return sets.unique_coords(o)


@query("sort_coords",
       "select distinct latitude as lat, longitude as lon from buoy_obs "
       "where latitude is not null and longitude is not null order by 1, 2", uses=("buoy_obs",))
def q_sort_coords(spark, sf_dir):
    o = clean.rename_vars(fixture(spark, sf_dir, "buoy_obs"), {"latitude": "lat", "longitude": "lon"})
    return sets.sort_coords(clean.drop_null_coords(sets.unique_coords(o), ["lat", "lon"]))
