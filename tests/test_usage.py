"""The README workflow, end to end, on stores written from the test tables."""

import json
import uuid

from pyspark.sql import functions as F

from lakecube.fixtures import fixtures
from lakecube.operators import clean, climatology as clim, normalize as N, placement as P, quality, sampling
from lakecube.operators import tasks as T
from lakecube.session import scratch_path
from lakecube.sinks import writers as W
from lakecube.sources import catalog as CAT

SF = "/root/testdata/sf0.01"


def test_readme_workflow(spark):
    raw, bathy, mask = fixtures(spark, SF, "sst_raw", "bathymetry", "lakemask")
    base = scratch_path(spark, f"usage-{uuid.uuid4().hex}")
    W.write_grid(raw, f"{base}/sst")                               # a year-partitioned store with fill values
    bathy.write.parquet(f"{base}/bathymetry")
    mask.write.parquet(f"{base}/lakemask")
    doc = {"datasets": {"sst_daily": {"path": f"{base}/sst", "format": "parquet"},
                        "bathymetry": {"path": f"{base}/bathymetry", "format": "parquet"},
                        "lakemask": {"path": f"{base}/lakemask", "format": "parquet"}}}
    spark.createDataFrame([(json.dumps(doc),)], "value string").write.text(f"{base}/catalog.json")

    cat = CAT.read_catalog(spark, f"{base}/catalog.json")
    sst = CAT.load_years(spark, cat, "sst_daily", [1995, 1996], sentinel=-99999.0)
    ctx = CAT.load_context(spark, cat)
    assert set(ctx) == {"bathymetry", "lakemask"}
    assert sst.filter(F.col("sst") == -99999.0).count() == 0

    c = clim.climatology(sst, ["sst"])
    paths = W.save_climatology(c, sst, f"{base}/seasonal_cycles", ["sst"])
    anom = clim.anomalies(sst, W.load_climatology(spark, paths["seasonal_cycle_path"])[0], ["sst"])
    params = N.fit_mean_std(anom, ["sst"])
    norm = N.apply_mean_std(anom, params, ["sst"])
    assert abs(norm.agg(F.avg("sst")).first()[0]) < 1e-9
    assert quality.missing_dates(sst).count() >= 0

    coords = N.fit_coord_map(ctx["lakemask"])
    dates = quality.available_dates(spark.sql("select explode(sequence(date'1995-01-01', date'1996-12-31', "
                                              "interval 5 day)) as time"), sst)
    task_table = T.build_tasks(dates, [T.TaskSet("sst", norm, 10), T.TaskSet("depth", ctx["bathymetry"])],
                               [T.TaskSet("sst", norm, "all")], coords)
    report = T.task_report(task_table)
    assert report.filter("role = 'context' and set_idx = 0 and n_points > 10").count() == 0
    chosen, surface = P.greedy_place(sampling.random_points(ctx["lakemask"], 20), sst, ctx["lakemask"],
                                     dates, n_new=2, coord_params=coords, lengthscale=0.05)
    picks = chosen.collect()
    assert len(picks) == 2 and picks[0].cell_id != picks[1].cell_id
    assert clean.split_by_date(sst, "custom", train=("1995-01-01", "1995-12-31"),
                               val=("1996-01-01", "1996-12-31")).select("split").distinct().count() == 2
