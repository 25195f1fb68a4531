"""Queries: catalog, loaders, chunk stores, sinks and the two end-to-end plans.

Stores and catalogs are built from the test tables in a fresh folder under
the session's checkpoint directory, then read back through the library.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import functions as F

from ..fixtures import fixture, fixtures
from ..operators import climatology as clim
from ..operators import grid as G
from ..operators import quality
from ..plans.ice import prepare_ice
from ..plans.preprocess import default_out_dir, preprocess
from ..session import read_table, scratch_path
from ..sinks import writers as W
from ..sources import catalog as CAT
from ..sources import grid_store as GS
from .base import query, rounded
from .q_climate import sst_grid
from .q_grid import _REGRID_SQL
from .q_kernel import SERIES_SQL, daily_series



TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _scratch(spark, tag):
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex}")


def _write_catalog(spark, datasets: dict) -> str:
    path = _scratch(spark, "catalog")
    doc = {"datasets": datasets, "metadata": {"description": "catalog of the test tables"}}
    spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.text(path)
    return path


def table_catalog(spark, sf_dir, relative=False):
    """Catalog with one parquet dataset per test table (variables = its columns)."""
    ds = {}
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if not os.path.exists(p):
            continue
        ds[t] = {"description": f"test table {t}", "path": (f"{t}/" if relative else p), "format": "parquet",
                 "variables": spark.read.parquet(p).columns}
    return CAT.read_catalog(spark, _write_catalog(spark, ds))


@query("catalog_lookup",
       "select 'lineitem' as name, 'parquet' as format, string_agg(column_name, ',' order by ordinal_position) "
       "as variables from information_schema.columns where table_name = 'lineitem'")
def q_catalog_lookup(spark, sf_dir):
    row = CAT.catalog_lookup(table_catalog(spark, sf_dir), "lineitem")
    return row.select("name", "format", F.concat_ws(",", "variables").alias("variables"))


@query("load_dataset",
       "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as varchar) as o_orderdate, "
       "o_orderpriority from orders")
def q_load_dataset(spark, sf_dir):
    df = CAT.load_dataset(spark, table_catalog(spark, sf_dir), "orders")
    return df.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query("store_paths",
       "select t.table_name as name, y.range::integer as year, upper(t.table_name) || '_' || y.range || '.zarr' "
       "as store_tail from (select distinct table_name from information_schema.columns where table_name in "
       "('region','nation','customer','supplier','part','orders','lineitem','events','documents','embeddings',"
       "'pages','benchmark','labels','conversations')) t, range(1995, 1998) y")
def q_store_paths(spark, sf_dir):
    cat = table_catalog(spark, sf_dir, relative=True)
    p = CAT.store_paths(cat, 1995, 1997)
    # the path keeps the dataset folder: "<name>/<NAME>_<year>.zarr"
    return p.select("name", "year", F.substring_index("store", "/", -1).alias("store_tail"))


def _grid_store(spark, sf_dir):
    path = _scratch(spark, "sst_daily")
    W.write_grid(sst_grid(spark, sf_dir), path)
    return path


@query("write_grid", "select *, cast(year(time) as integer) as year from sst_grid", uses=("sst_grid",))
def q_write_grid(spark, sf_dir):
    return spark.read.parquet(_grid_store(spark, sf_dir))


@query("scan_year", "select *, cast(year(time) as integer) as year from sst_grid where year(time) = 1997",
       uses=("sst_grid",))
def q_scan_year(spark, sf_dir):
    path = _grid_store(spark, sf_dir)
    cat = CAT.read_catalog(spark, _write_catalog(spark, {"sst_daily": {"path": path, "format": "parquet"}}))
    return CAT.load_dataset(spark, cat, "sst_daily", year=1997, kind="grid")


@query("concat_store_years",
       "select *, cast(year(time) as integer) as year from sst_grid where year(time) in (1996, 1998)",
       uses=("sst_grid",))
def q_concat_store_years(spark, sf_dir):
    path = _grid_store(spark, sf_dir)
    cat = CAT.read_catalog(spark, _write_catalog(spark, {"sst_daily": {"path": path, "format": "parquet"}}))
    return CAT.load_years(spark, cat, "sst_daily", [1996, 1998])


@query("lazy_scan", "select time, lat_idx, lon_idx, sst from sst_grid", uses=("sst_grid",))
def q_lazy_scan(spark, sf_dir):
    return CAT.scan_lazy(spark, _grid_store(spark, sf_dir),
                         "time date, lat_idx bigint, lon_idx bigint, sst double, year int",
                         ["time", "lat_idx", "lon_idx", "sst"])


_CHUNK2 = ("select vec_id, 'embedding' as var, cast(vec_id * 8 + floor(pos / 8) as bigint) as lat_idx, "
           "cast(pos % 8 as bigint) as lon_idx, cast(null as bigint) as t_idx, cast(embedding[pos + 1] as double) "
           "as value from (select vec_id, embedding, unnest(range(len(embedding))) as pos from embeddings)")


@query("flatten_chunks", _CHUNK2)
def q_flatten_chunks(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    chunks = e.select("vec_id", F.lit("embedding").alias("var"), F.lit(None).cast("int").alias("t0"),
                      (F.col("vec_id") * 8).alias("i0"), F.lit(0).alias("j0"),
                      F.array(F.lit(8), F.lit(8)).alias("shape"), F.col("embedding").alias("payload"))
    return GS.flatten_chunks(chunks, keep=("vec_id",))


@query("positional_time",
       "select vec_id, 'embedding' as var, cast(floor(pos / 16) as bigint) as t_idx, "
       "cast(floor(vec_id / 5) * 4 + floor(pos / 4) % 4 as bigint) as lat_idx, cast(pos % 4 as bigint) as lon_idx, "
       "cast(embedding[pos + 1] as double) as value, cast(1995 + vec_id % 5 as integer) as year, "
       "cast(make_date(cast(1995 + vec_id % 5 as integer), 1, 1) + cast(floor(pos / 16) as integer) as date) as time "
       "from (select vec_id, embedding, unnest(range(len(embedding))) as pos from embeddings)")
def q_positional_time(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    chunks = e.select("vec_id", (F.lit(1995) + F.col("vec_id") % 5).cast("int").alias("year"),
                      F.lit("embedding").alias("var"), F.lit(0).alias("t0"),
                      (F.floor(F.col("vec_id") / 5) * 4).alias("i0"), F.lit(0).alias("j0"),
                      F.array(F.lit(4), F.lit(4), F.lit(4)).alias("shape"), F.col("embedding").alias("payload"))
    return GS.positional_time(GS.flatten_chunks(chunks, keep=("vec_id", "year")))


@query("attach_coords",
       "select r.time, r.lat_idx, r.lon_idx, r.sst, a.lat, o.lon from sst_raw r "
       "left join (select distinct lat_idx, lat from bathymetry) a on a.lat_idx = r.lat_idx "
       "left join (select distinct lon_idx, lon from bathymetry) o on o.lon_idx = r.lon_idx",
       uses=("sst_raw", "bathymetry"))
def q_attach_coords(spark, sf_dir):
    raw, bathy = fixtures(spark, sf_dir, "sst_raw", "bathymetry")
    idx = raw.select("time", "lat_idx", "lon_idx", "sst")
    return GS.attach_coords(idx, bathy.select("lat_idx", "lat").distinct(), bathy.select("lon_idx", "lon").distinct())


def _static_stats_sql(table, var, name):
    return (f"select '{name}' as dataset, min({var}) as value_min, max({var}) as value_max, "
            f"count({var}) as n_values, (select count(distinct lat_idx) from {table}) as n_lat, "
            f"(select count(distinct lon_idx) from {table}) as n_lon, round(100e0 * count({var}) / "
            f"((select count(distinct lat_idx) from {table}) * (select count(distinct lon_idx) from {table})), 6) "
            f"as coverage_pct from {table}")


@query("load_context",
       _static_stats_sql("bathymetry", "cast(depth as double)", "bathymetry") + " union all " +
       _static_stats_sql("lakemask", "cast(mask as double)", "lakemask"), uses=("bathymetry", "lakemask"))
def q_load_context(spark, sf_dir):
    bathy, mask = fixtures(spark, sf_dir, "bathymetry", "lakemask")
    bp, mp = _scratch(spark, "bathymetry"), _scratch(spark, "lakemask")
    bathy.withColumnRenamed("depth", CAT.UNNAMED).write.parquet(bp)
    mask.write.parquet(mp)
    cat = CAT.read_catalog(spark, _write_catalog(spark, {"bathymetry": {"path": bp, "format": "parquet"},
                                                         "lakemask": {"path": mp, "format": "parquet"}}))
    ctx = CAT.load_context(spark, cat)
    b = quality.validate_static(ctx["bathymetry"].withColumn("bathymetry", F.col("bathymetry").cast("double")),
                                "bathymetry")
    m = quality.validate_static(ctx["lakemask"].withColumn("mask", F.col("mask").cast("double")), "mask")
    out = b.select(F.lit("bathymetry").alias("dataset"), "*").unionByName(
        m.select(F.lit("lakemask").alias("dataset"), "*"))
    return rounded(out, ["coverage_pct"])


@query("scan_obs", "select obs, cast(time as varchar) as time, latitude, longitude, temperature_k from buoy_obs",
       uses=("buoy_obs",))
def q_scan_obs(spark, sf_dir):
    p = _scratch(spark, "obs")
    fixture(spark, sf_dir, "buoy_obs").write.parquet(p)
    return CAT.scan_obs(spark, p).withColumn("time", F.col("time").cast("string"))


@query("scan_static_any", "select *, 'lake_' || (lon_idx // 6) as region from lakemask where lon_idx // 6 = 2",
       uses=("lakemask",))
def q_scan_static_any(spark, sf_dir):
    p = _scratch(spark, "masks")
    m = fixture(spark, sf_dir, "lakemask")
    m.withColumn("region", F.concat(F.lit("lake_"), F.floor(F.col("lon_idx") / 6).cast("string"))).write.parquet(p)
    return CAT.scan_static(spark, p, "lake_2")


def _saved_clim(spark, sf_dir, base=None):
    g = sst_grid(spark, sf_dir)
    c = clim.climatology(g, ["sst"])
    return W.save_climatology(c, g, base or _scratch(spark, "seasonal_cycles"), ["sst"])


@query("load_climatology",
       "select cast(month(time) as bigint) as month, lat_idx, lon_idx, round(avg(sst), 6) as sst "
       "from sst_grid group by 1, 2, 3", uses=("sst_grid",))
def q_load_climatology(spark, sf_dir):
    paths = _saved_clim(spark, sf_dir)
    c, _ = W.load_climatology(spark, paths["seasonal_cycle_path"], paths["metadata_path"])
    return rounded(c, ["sst"])


@query("save_climatology",
       "select 'sst' as dataset_vars, count(distinct time) as n_time, count(distinct lat_idx) as n_lat, "
       "count(distinct lon_idx) as n_lon from sst_grid", uses=("sst_grid",))
def q_save_climatology(spark, sf_dir):
    paths = _saved_clim(spark, sf_dir)
    _, meta = W.load_climatology(spark, paths["seasonal_cycle_path"], paths["metadata_path"])
    return meta.select(F.concat_ws(",", "dataset_vars").alias("dataset_vars"),
                       F.col("dataset_dims")["time"].alias("n_time"), F.col("dataset_dims")["lat"].alias("n_lat"),
                       F.col("dataset_dims")["lon"].alias("n_lon"))


@query("list_climatologies",
       "select 'sst' as dataset_vars, count(distinct time) as n_time, count(distinct lat_idx) as n_lat, "
       "count(distinct lon_idx) as n_lon, 36 as id_length, true as has_date from sst_grid "
       "union all select 'sst', count(distinct time), count(distinct lat_idx), count(distinct lon_idx), 36, true "
       "from sst_grid", uses=("sst_grid",))
def q_list_climatologies(spark, sf_dir):
    """Two saved climatologies in one folder -> their two metadata rows
    (the ids are random, so their length is reported instead)."""
    base = _scratch(spark, "seasonal_cycles")
    _saved_clim(spark, sf_dir, base)
    _saved_clim(spark, sf_dir, base)
    m = W.list_climatologies(spark, base)
    return m.select(F.concat_ws(",", "dataset_vars").alias("dataset_vars"),
                    F.col("dataset_dims")["time"].alias("n_time"), F.col("dataset_dims")["lat"].alias("n_lat"),
                    F.col("dataset_dims")["lon"].alias("n_lon"), F.length("id").alias("id_length"),
                    F.col("calculation_date").isNotNull().alias("has_date"))


@query("write_points",
       "select p.time, p.lat_idx, p.lon_idx, round(case when m.mask = 1 then p.mean end, 6) as mean, "
       "round(case when m.mask = 1 then p.std end, 6) as std "
       "from pred p join lakemask m on p.lat_idx = m.lat_idx and p.lon_idx = m.lon_idx",
       uses=("pred", "lakemask"))
def q_write_points(spark, sf_dir):
    pred, mask = fixtures(spark, sf_dir, "pred", "lakemask")
    p = _scratch(spark, "masked_pred")
    W.write_points(G.apply_mask(pred, mask), p, ["time"])
    back = spark.read.parquet(p)
    return rounded(back.withColumn("time", F.to_date("time")).select("time", "lat_idx", "lon_idx", "mean", "std"),
                   ["mean", "std"])


@query("write_csv", "select cast(task_time as varchar) as date, mean, std from (" + SERIES_SQL + ")",
       uses=("sst_grid", "lakemask"))
def q_write_csv(spark, sf_dir):
    p = _scratch(spark, "series_csv")
    W.write_csv(daily_series(spark, sf_dir).select(F.col("task_time").cast("string").alias("date"), "mean", "std"), p)
    return spark.read.schema("date string, mean double, std double").option("header", True).csv(p)


@query("write_manifest",
       "select * from (values ('ice_concentration', 'data_processor', 0, false, false), "
       "('sst', 'data_processor', 36, true, true)) "
       "t(dataset, data_processor_path, id_length, has_cycle, has_metadata) "
       "where (select count(*) from sst_grid) >= 0", uses=("sst_grid",))
def q_write_manifest(spark, sf_dir):
    """K5: the manifest of a saved climatology and a second variable, written and read back."""
    path = _scratch(spark, "manifest")
    W.write_manifest(spark, path, {"sst": _saved_clim(spark, sf_dir), "ice_concentration": {}}, "data_processor")
    m = W.load_manifest(spark, path).filter(F.col("created").isNotNull())
    return m.select("dataset", "data_processor_path", F.coalesce(F.length("seasonal_cycle_id"), F.lit(0)).alias("id_length"),
                    F.coalesce(F.col("seasonal_cycle_path").endswith(F.concat("seasonal_cycle_id", F.lit("_seasonal_cycle.parquet"))), F.lit(False)).alias("has_cycle"),
                    F.coalesce(F.col("seasonal_cycle_metadata_path").endswith("_metadata.json"), F.lit(False)).alias("has_metadata"))


@query("write_run_log",
       "with c as (select epoch, avg(loss) as loss from training_log group by 1) "
       "select 'run0' as run_id, count(*) as n_epochs, round(max_by(loss, epoch), 6) as final_loss, "
       "round(min(loss), 6) as best_loss, min_by(epoch, loss) as best_epoch from c", uses=("training_log",))
def q_write_run_log(spark, sf_dir):
    out = W.write_run_log(fixture(spark, sf_dir, "training_log"), _scratch(spark, "training_log"), "run0",
                          _scratch(spark, "run_summary"))
    return rounded(out, ["final_loss", "best_loss"])


@query("provenance",
       "select 'Lake surface temperature' as title, 'degC' as units, min(time) as time_start, max(time) as time_end "
       "from sst_grid", uses=("sst_grid",))
def q_provenance(spark, sf_dir):
    return W.provenance(sst_grid(spark, sf_dir), "sst", "Lake surface temperature", "degC")


# --- end-to-end plans -----------------------------------------------------------------

@query("prepare_ice",
       _REGRID_SQL.replace("with ice as (select time, lat, lon, case when ice_concentration = -1e0 then null "
                           "else ice_concentration end as ice_concentration from ice_raw) ",
                           "with ice as (select time, lat, lon, case when ice_concentration = -1e0 then null "
                           "else ice_concentration end as ice_concentration from ice_raw where time between "
                           "(select min(time) from sst_grid) and (select max(time) from sst_grid)) ")
       + "select g.time, g.lat_idx, g.lon_idx, cast(case when i.ice_concentration / 100e0 < 0 then 0e0 "
       "when i.ice_concentration / 100e0 > 1 then 1e0 else i.ice_concentration / 100e0 end as float) "
       "as ice_concentration from sst_grid g "
       "left join mt on g.time = mt.time left join mla on g.lat_idx = mla.lat_idx "
       "left join mlo on g.lon_idx = mlo.lon_idx "
       "left join ice i on i.time = mt.src and i.lat = mla.src and i.lon = mlo.src",
       uses=("ice_raw", "sst_grid"))
def q_prepare_ice(spark, sf_dir):
    ice = fixture(spark, sf_dir, "ice_raw")
    return prepare_ice(ice, sst_grid(spark, sf_dir), out_path=_scratch(spark, "ice_on_sst_grid"))


_ICE_GRID = ("select time, cast(round((lat - 38.7e0) / 0.7e0) as bigint) as lat_idx, cast(round((lon + 92.4e0) / 0.8e0) as bigint) as lon_idx, "
             "case when ice_concentration = -1e0 then null else ice_concentration end as ice_concentration from {ice_raw}")


@query("preprocess",
       "with c as (select cast(month(time) as bigint) as m, lat_idx, lon_idx, avg(sst) as s, count(sst) as n, var_pop(sst) as v "
       "from sst_grid group by 1, 2, 3), "
       f"ice as ({_ICE_GRID.format(ice_raw='ice_raw')}) "
       "select 'sst_anom' as dataset, g.time, g.lat_idx, g.lon_idx, "
       "round((g.sst - c.s) / (select sqrt(sum(n * v) / sum(n)) from c), 6) as value from sst_grid g join c "
       "on cast(month(g.time) as bigint) = c.m and g.lat_idx = c.lat_idx and g.lon_idx = c.lon_idx "
       "union all select 'ice_concentration', time, lat_idx, lon_idx, round((ice_concentration - (select min(ice_concentration) from ice)) / "
       "((select max(ice_concentration) from ice) - (select min(ice_concentration) from ice)), 6) from ice", uses=("sst_grid", "ice_raw"))
def q_preprocess(spark, sf_dir):
    """Surface temperature as normalised anomalies and ice concentration scaled to 0..1, both written and read back."""
    from ..operators.clean import sentinel_to_null
    ice = spark.sql(_ICE_GRID, ice_raw=fixture(spark, sf_dir, "ice_raw"))
    norm, paths = preprocess(sentinel_to_null(fixture(spark, sf_dir, "sst_raw")), "sst", default_out_dir(spark),
                             min_max={"ice_concentration": ice})
    keys = ["time", "lat_idx", "lon_idx"]
    ice = spark.read.parquet(paths["grids"]["ice_concentration"])
    out = (norm.select(F.lit("sst_anom").alias("dataset"), *keys, F.col("sst_anom").alias("value"))
           .unionByName(ice.select(F.lit("ice_concentration").alias("dataset"), *keys, F.col("ice_concentration").alias("value"))))
    return rounded(out, ["value"])


@query("load_chunk_store",
       "select 'embedding' as var, cast(floor(pos / 16) as bigint) as t_idx, "
       "cast(floor(vec_id / 5) * 4 + floor(pos / 4) % 4 as bigint) as lat_idx, cast(pos % 4 as bigint) as lon_idx, "
       "cast(embedding[pos + 1] as double) as value, cast(1995 + vec_id % 5 as integer) as year, "
       "cast(make_date(cast(1995 + vec_id % 5 as integer), 1, 1) + cast(floor(pos / 16) as integer) as date) as time "
       "from (select vec_id, embedding, unnest(range(len(embedding))) as pos from embeddings) "
       "where 1995 + vec_id % 5 = 1997")
def q_load_chunk_store(spark, sf_dir):
    """S2 with format 'chunks': a year-partitioned chunk store loaded, flattened and dated."""
    e = read_table(spark, sf_dir, "embeddings")
    chunks = e.select((F.lit(1995) + F.col("vec_id") % 5).cast("int").alias("year"),
                      F.lit("embedding").alias("var"), F.lit(0).alias("t0"),
                      (F.floor(F.col("vec_id") / 5) * 4).cast("int").alias("i0"), F.lit(0).alias("j0"),
                      F.array(F.lit(4), F.lit(4), F.lit(4)).alias("shape"), F.col("embedding").alias("payload"))
    path = _scratch(spark, "chunk_store")
    chunks.write.partitionBy("year").parquet(path)
    cat = CAT.read_catalog(spark, _write_catalog(spark, {"sst_daily": {"path": path, "format": "chunks"}}))
    return CAT.load_dataset(spark, cat, "sst_daily", year=1997)



def _evaluate_sql():
    from .q_kernel import R2 as KR2, TWO_L2 as KTWO_L2
    from .q_tasks import _CP, _DATES5, _per_date_sql
    xy = lambda a: (f"({a}.lat - cp.lo1) / ((cp.lo1 + cp.span) - cp.lo1) as x1, "  # noqa: E731
                    f"({a}.lon - cp.lo2) / ((cp.lo2 + cp.span) - cp.lo2) as x2")
    return (
        f"with recursive {_DATES5}, ad as (select time from d5 where time in (select time from sst_grid)), {_CP}, "
        "prm as (select avg(sst) as pm, stddev_pop(sst) as ps from sst_grid "
        "where time between date '1995-01-01' and date '1999-12-31'), "
        f"{_per_date_sql(42, 200, 'ad').replace('range(200) r', '(select unnest(range(least(200, (select n from m)))) as range) r')}, "
        "gn as (select g.time, g.lat_idx, g.lon_idx, g.lat, g.lon, (g.sst - prm.pm) / prm.ps as v "
        "from sst_grid g, prm where g.time in (select time from ad)), "
        f"cx as (select pp.time as task_time, {xy('pp')}, gn.v as value from pp join gn on gn.time = pp.time "
        "and gn.lat_idx = pp.lat_idx and gn.lon_idx = pp.lon_idx, cp where gn.v is not null), "
        f"tg as (select gn.time as task_time, gn.lat_idx, gn.lon_idx, {xy('gn')} from gn join "
        "(select lat_idx, lon_idx from lakemask where mask = 1) wc on wc.lat_idx = gn.lat_idx "
        "and wc.lon_idx = gn.lon_idx, cp), "
        "px as (select t.task_time, t.lat_idx, t.lon_idx, "
        f"exp(-(pow(c.x1 - t.x1, 2) + pow(c.x2 - t.x2, 2)) / {KTWO_L2}) as w, c.value from tg t join cx c "
        f"on c.task_time = t.task_time where pow(c.x1 - t.x1, 2) + pow(c.x2 - t.x2, 2) <= {KR2}), "
        "sx as (select task_time, lat_idx, lon_idx, sum(w) as dens, sum(w * value) as swy, "
        "sum(w * value * value) as swyy from px group by 1, 2, 3), "
        "ph as (select t.task_time as time, t.lat_idx, t.lon_idx, (sx.swy / sx.dens) * prm.ps + prm.pm as mean, "
        "sqrt(greatest(coalesce(sx.swyy / sx.dens - (sx.swy / sx.dens) * (sx.swy / sx.dens), 0), 0) "
        "+ 1e0 / (1 + coalesce(sx.dens, 0))) * prm.ps as std from tg t left join sx on sx.task_time = t.task_time "
        "and sx.lat_idx = t.lat_idx and sx.lon_idx = t.lon_idx, prm), "
        "jn as (select ph.*, g.sst as truth from ph join sst_grid g on g.time = ph.time "
        "and g.lat_idx = ph.lat_idx and g.lon_idx = ph.lon_idx), "
        "wt as (select lat_idx, lon_idx, mask / (select sum(mask) from lakemask) as w from lakemask), "
        "kw as (select jn.*, wt.w, case when jn.std > 1e-6 then jn.std else 1e-6 end as ss from jn "
        "join wt on wt.lat_idx = jn.lat_idx and wt.lon_idx = jn.lon_idx), "
        "kn as (select *, 0.5 * ln(2 * pi() * ss * ss) + 0.5 * (truth - mean) * (truth - mean) / (ss * ss) as nll "
        "from kw) "
        "select round(sqrt((select avg((mean - truth) * (mean - truth)) from jn)), 6) as pooled_rmse, "
        "(select count(mean - truth) from jn) as n_scored, "
        "round(sqrt(sum(w * ((mean - truth) * (mean - truth))) / "
        "sum(case when (mean - truth) * (mean - truth) is not null then w end)), 6) as weighted_rmse, "
        "round(sum(w * std) / sum(case when std is not null then w end), 6) as mean_std, "
        "round(sum(w * nll) / sum(case when nll is not null then w end), 6) as nll from kn")



@query("evaluate_predictions", _evaluate_sql(), uses=("sst_grid", "lakemask"))
def q_evaluate_predictions(spark, sf_dir):
    """Score workflow: normalise, per-date random context, kernel
    prediction on every water cell, unnormalise, pooled and weighted scores."""
    from ..operators import dates as D
    from ..plans.evaluate import evaluate
    g = sst_grid(spark, sf_dir)
    mask = fixture(spark, sf_dir, "lakemask")
    n_context = min(200, mask.filter("mask = 1").count())            # the smallest test grid has fewer water cells
    scores, _ = evaluate(g, mask, D.date_range_subsample(g, 5), ("1995-01-01", "1999-12-31"), n_context,
                         lengthscale=0.05, noise=1.0)
    return rounded(scores, ["pooled_rmse", "weighted_rmse", "mean_std", "nll"])
