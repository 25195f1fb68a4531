"""Loader behaviour as the reference tests it, and physical-plan properties."""

import json
import uuid

from pyspark.sql import functions as F

from conftest import small_grid
from lakecube.operators import climatology as clim
from lakecube.operators import grid as G
from lakecube.operators import clean
from lakecube.session import scratch_path
from lakecube.sinks import writers as W
from lakecube.sources import catalog as CAT
from lakecube.sources import grid_store as GS


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _year_chunks(spark, year, n_t=365, n=10):
    # one rank-3 chunk per year, like a (time, lat, lon) array without a stored time axis
    payload = [float((t * 7 + i * 3 + j) % 23) for t in range(n_t) for i in range(n) for j in range(n)]
    return spark.createDataFrame([("sst", year, 0, 0, 0, [n_t, n, n], payload)],
                                 "var string, year int, t0 int, i0 int, j0 int, shape array<int>, "
                                 "payload array<float>")


def _catalog(spark, datasets):
    path = scratch_path(spark, f"cat-{uuid.uuid4().hex}")
    spark.createDataFrame([(json.dumps({"datasets": datasets}),)], "value string").write.text(path)
    return CAT.read_catalog(spark, path)


def test_three_dim_array_gets_dims_and_dates(spark):
    flat = GS.positional_time(GS.flatten_chunks(_year_chunks(spark, 1995), keep=("year",)))
    sizes = flat.agg(F.countDistinct("time"), F.countDistinct("lat_idx"), F.countDistinct("lon_idx")).first()
    assert tuple(sizes) == (365, 10, 10)
    assert flat.agg(F.min("time")).first()[0].isoformat() == "1995-01-01"


def test_two_years_concatenated(spark):
    y95 = GS.positional_time(GS.flatten_chunks(_year_chunks(spark, 1995), keep=("year",)))
    y96 = GS.positional_time(GS.flatten_chunks(_year_chunks(spark, 1996, 366), keep=("year",)))
    from lakecube.operators.sets import concat_years
    both = concat_years([y95, y96])
    assert both.select("time").distinct().count() == 731
    same_twice = concat_years([y95, y95])                    # duplicates are kept
    assert same_twice.count() == 2 * 365 * 100


def test_context_fields_returned(spark):
    cells = [(i, j, 40.0 + i, -90.0 + j) for i in range(10) for j in range(10)]
    bathy = spark.createDataFrame([(*c, float(c[0] - c[1])) for c in cells],
                                  f"lat_idx bigint, lon_idx bigint, lat double, lon double, {CAT.UNNAMED} double")
    mask = spark.createDataFrame([(*c, int(c[0] > c[1])) for c in cells],
                                 "lat_idx bigint, lon_idx bigint, lat double, lon double, mask bigint")
    bp, mp = scratch_path(spark, f"b-{uuid.uuid4().hex}"), scratch_path(spark, f"m-{uuid.uuid4().hex}")
    bathy.write.parquet(bp)
    mask.write.parquet(mp)
    cat = _catalog(spark, {"bathymetry": {"path": bp, "format": "parquet"},
                           "lakemask": {"path": mp, "format": "parquet"}})
    ctx = CAT.load_context(spark, cat)
    assert set(ctx) == {"bathymetry", "lakemask"}
    assert "bathymetry" in ctx["bathymetry"].columns
    for df in ctx.values():
        assert df.select("lat_idx").distinct().count() == 10 and df.select("lon_idx").distinct().count() == 10


def test_date_filter_pushed_to_parquet(spark):
    g = small_grid(spark, [(f"1995-0{m}-01", 0, 0, float(m)) for m in range(1, 10)])
    path = scratch_path(spark, f"g-{uuid.uuid4().hex}")
    W.write_grid(g, path)
    stored = spark.read.parquet(path)
    sliced = clean.time_slice(stored.select("time", "lat_idx", "lon_idx", "sst"), "1995-03-01", "1995-05-31")
    plan = _plan(sliced)
    assert "PushedFilters: [IsNotNull(time), GreaterThanOrEqual(time,1995-03-01), LessThanOrEqual(time,1995-05-31)]" in plan
    assert "ReadSchema: struct<time:date,lat_idx:bigint,lon_idx:bigint,sst:double>" in plan
    assert sliced.count() == 3


def test_climatology_partial_aggregation_and_mask_broadcast(spark):
    g = small_grid(spark, [(f"1995-0{m}-0{d}", i, 0, float(m + d + i)) for m in range(1, 4)
                           for d in range(1, 4) for i in range(3)])
    plan = _plan(clim.climatology(g))
    assert plan.count("HashAggregate") >= 2 and "partial_avg" in plan
    mask = spark.createDataFrame([(i, 0, 40.0 + i, -90.0, 1) for i in range(3)],
                                 "lat_idx bigint, lon_idx bigint, lat double, lon double, mask bigint")
    assert "BroadcastHashJoin" in _plan(G.apply_mask(g, mask))
