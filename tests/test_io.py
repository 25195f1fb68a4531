"""Sources and sinks: catalog errors, round trips, partition pruning."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import small_grid
from lakecube.operators import climatology as clim
from lakecube.session import scratch_path
from lakecube.sinks import writers as W
from lakecube.sources import catalog as CAT
from lakecube.sources import grid_store as GS


def _catalog(spark, datasets):
    path = scratch_path(spark, f"cat-{uuid.uuid4().hex}")
    spark.createDataFrame([(json.dumps({"datasets": datasets}),)], "value string").write.text(path)
    return CAT.read_catalog(spark, path)


def test_catalog_unknown_and_unsupported(spark):
    cat = _catalog(spark, {"sst_daily": {"path": "/nowhere", "format": "zarr"}})
    with pytest.raises(ValueError, match="no dataset"):
        CAT.catalog_lookup(cat, "missing")
    with pytest.raises(ValueError, match="no reader is registered"):
        CAT.load_dataset(spark, cat, "sst_daily")


def test_year_partition_pruned(spark):
    g = small_grid(spark, [(f"{y}-01-0{d}", 0, 0, float(y + d)) for y in (1995, 1996, 1997) for d in (1, 2)])
    path = scratch_path(spark, f"grid-{uuid.uuid4().hex}")
    W.write_grid(g, path)
    cat = _catalog(spark, {"sst_daily": {"path": path, "format": "parquet"}})
    one = CAT.load_dataset(spark, cat, "sst_daily", year=1996)
    assert one.count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "= 1996" in plan


def test_climatology_save_load_round_trip(spark):
    g = small_grid(spark, [(f"1995-{m:02d}-01", i, 0, float(m + i)) for m in range(1, 13) for i in range(2)])
    c = clim.climatology(g)
    base = scratch_path(spark, f"cycles-{uuid.uuid4().hex}")
    paths = W.save_climatology(c, g, base, ["sst"])
    back, meta = W.load_climatology(spark, paths["seasonal_cycle_path"], paths["metadata_path"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, c.collect()))
    m = meta.first()
    assert m.id == paths["id"] and m.calculation_date and m.dataset_dims["time"] == 12
    W.save_climatology(c, g, base, ["sst"])
    assert W.list_climatologies(spark, base).count() == 2


def test_flatten_ranks(spark):
    chunks = spark.createDataFrame(
        [("a", 1995, 0, 0, 0, [2, 2, 2], [float(x) for x in range(8)]),
         ("b", None, None, 3, 4, [2, 3], [float(x) for x in range(6)]),
         ("c", 1995, 5, None, None, [4], [1.0, 2.0, 3.0, 4.0]),
         ("d", None, 0, 0, 0, [1, 1, 1, 1], [9.0])],
        "var string, year int, t0 int, i0 int, j0 int, shape array<int>, payload array<float>")
    flat = GS.flatten_chunks(chunks, keep=("year",))
    rows = {(r.var, r.t_idx, r.lat_idx, r.lon_idx): r.value for r in flat.collect()}
    assert rows[("a", 1, 0, 1)] == 5.0 and rows[("b", None, 4, 6)] == 5.0 and rows[("c", 8, None, None)] == 4.0
    assert not any(k[0] == "d" for k in rows)                 # rank 4 skipped
    dated = GS.positional_time(flat.filter("var = 'a'")).select("time").distinct().collect()
    assert sorted(r.time.isoformat() for r in dated) == ["1995-01-01", "1995-01-02"]


def test_provenance_metadata(spark):
    g = small_grid(spark, [("1995-01-01", 0, 0, 1.0)])
    out = W.provenance(g, "sst", "Lake temperature", "degC").first()
    assert out.units == "degC"


def test_csv_has_no_row_bound(spark):
    path = W.write_csv(spark.range(10), scratch_path(spark, f"csv-{uuid.uuid4().hex}"))
    assert spark.read.option("header", True).csv(path).count() == 10


def test_manifest_has_an_entry_per_dataset(spark):
    path = scratch_path(spark, f"manifest-{uuid.uuid4().hex}")
    W.write_manifest(spark, path, {"sst": {"id": "x", "seasonal_cycle_path": "p", "metadata_path": "m", "grid": "g"}, "ice": {}}, "norm")
    rows = {r["dataset"]: r for r in W.load_manifest(spark, path).collect()}
    assert set(rows) == {"sst", "ice"} and rows["sst"]["grid_path"] == "g" and rows["ice"]["seasonal_cycle_id"] is None


def test_fill_value_is_removed_on_load(spark):
    path = scratch_path(spark, f"grid-{uuid.uuid4().hex}")
    spark.createDataFrame([(1, 2, -99999.0), (1, 3, 4.0)], "lat_idx long, lon_idx long, sst double").write.parquet(path)
    cat = _catalog(spark, {"cube": {"path": path, "format": "parquet"}})
    assert sorted(str(r["sst"]) for r in CAT.load_dataset(spark, cat, "cube").collect()) == ["4.0", "None"]
    assert CAT.load_dataset(spark, cat, "cube", sentinel=None).filter("sst < 0").count() == 1


def test_rank3_without_time_or_year_raises(spark):
    path = scratch_path(spark, f"chunks-{uuid.uuid4().hex}")
    spark.createDataFrame([("sst", 0, 0, 0, [2, 1, 1], [1.0, 2.0])],
                          "var string, t0 int, i0 int, j0 int, shape array<int>, payload array<float>").write.parquet(path)
    cat = _catalog(spark, {"cube": {"path": path, "format": "chunks"}})
    with pytest.raises(ValueError, match="neither a time axis nor a year"):
        CAT.load_dataset(spark, cat, "cube")


def test_schema_validation(spark):
    from lakecube import schemas
    g = small_grid(spark, [("1995-01-01", 0, 0, 1.0)])
    assert schemas.validate(g, "grid") is g
    assert schemas.problems(g.drop("lat_idx"), "grid") == ["missing column 'lat_idx'"]
    with pytest.raises(ValueError, match="not a valid mask table"):
        schemas.validate(g, "mask")
    path = scratch_path(spark, f"g-{uuid.uuid4().hex}")
    g.write.parquet(path)
    cat = _catalog(spark, {"sst_daily": {"path": path, "format": "parquet"}})
    assert CAT.load_dataset(spark, cat, "sst_daily", kind="grid").count() == 1
    with pytest.raises(ValueError):
        CAT.load_dataset(spark, cat, "sst_daily", kind="task")


def test_space_ordered_grid_filters_on_cells(spark):
    g = small_grid(spark, [(f"1995-01-0{d}", i, j, float(d + i + j)) for d in range(1, 4) for i in range(3) for j in range(3)])
    path = scratch_path(spark, f"g-{uuid.uuid4().hex}")
    W.write_grid(g, path, order="space")
    back = spark.read.parquet(path)
    cell = back.filter("lat_idx = 1 and lon_idx = 2")
    assert cell.count() == 3
    assert "PushedFilters: [IsNotNull(lat_idx), IsNotNull(lon_idx), EqualTo(lat_idx,1), EqualTo(lon_idx,2)]" in \
        cell._jdf.queryExecution().executedPlan().toString()


def test_preprocess_outputs(spark):
    import json as _json
    from lakecube.operators import normalize as N
    from lakecube.plans.preprocess import preprocess
    g = small_grid(spark, [(f"1995-{m:02d}-{d:02d}", i, 0, float(m * 3 + d + i)) for m in range(1, 13)
                           for d in (1, 9, 17) for i in range(2)])
    out_dir = scratch_path(spark, f"pre-{uuid.uuid4().hex}")
    norm, paths = preprocess(g, "sst", out_dir)
    assert {"seasonal_cycle_path", "metadata_path", "id", "grid", "data_processor", "manifest"} <= set(paths)
    doc = _json.loads(spark.read.text(paths["manifest"], wholetext=True).first().value)
    assert doc["datasets"]["sst"]["seasonal_cycle_id"] == paths["id"] and doc["data_processor_path"] == paths["data_processor"]
    params, _ = N.load_norm_params(spark, paths["data_processor"])
    p = params.first()
    assert p.var == "sst_anom" and p.method == "mean_std"
    r = norm.agg(F.avg("sst_anom").alias("m"), F.stddev_pop("sst_anom").alias("s")).first()
    assert abs(r.m) < 1e-9 and abs(r.s - 1.0) < 1e-9
    assert spark.read.parquet(paths["grid"]).select("year").distinct().count() == 1


def test_chunk_store_with_axes_is_a_labelled_grid(spark):
    from lakecube import schemas
    path = scratch_path(spark, f"chunks-{uuid.uuid4().hex}")
    rows = [(1996, "lat", 0, 0, 0, [2], [40.0, 41.0]), (1996, "lon", 0, 0, 0, [2], [-90.0, -89.0]),
            (1996, "sst", 0, 0, 0, [2, 2, 2], [1.0, 2.0, 3.0, -99999.0, 5.0, 6.0, 7.0, 8.0])]
    spark.createDataFrame(rows, "year int, var string, t0 int, i0 int, j0 int, shape array<int>, payload array<float>") \
        .write.partitionBy("year").parquet(path)
    cat = _catalog(spark, {"cube": {"path": path, "format": "chunks"}})
    g = CAT.load_dataset(spark, cat, "cube", year=1996, kind="grid")
    got = {(r.time.isoformat(), r.lat, r.lon): r.sst for r in g.collect()}
    assert len(got) == 8 and got[("1996-01-01", 41.0, -89.0)] is None and got[("1996-01-02", 40.0, -89.0)] == 6.0


def test_preprocess_with_a_min_max_variable(spark):
    from lakecube.operators import normalize as N
    from lakecube.plans.preprocess import preprocess
    g = small_grid(spark, [(f"1995-0{m}-0{d}", 0, 0, float(m + d)) for m in (1, 2) for d in (1, 5)])
    ice = g.select("time", "lat_idx", "lon_idx", (F.col("sst") / 10).alias("ice_concentration"))
    _, paths = preprocess(g, "sst", scratch_path(spark, f"pre-{uuid.uuid4().hex}"), {"ice_concentration": ice})
    v = [r[0] for r in spark.read.parquet(paths["grids"]["ice_concentration"]).select("ice_concentration").collect()]
    assert min(v) == 0 and max(v) == 1
    params, _ = N.load_norm_params(spark, paths["data_processor"])
    assert {r["var"]: r["method"] for r in params.collect()} == {"sst_anom": "mean_std", "ice_concentration": "min_max"}
    assert {r["dataset"] for r in W.load_manifest(spark, paths["manifest"]).collect()} == {"sst", "ice_concentration"}
