"""Lazy greedy choice against the full surfaces; percentile selection; pooled moments."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecube.operators import climatology as clim
from lakecube.operators import normalize as N
from lakecube.operators import placement as P
from lakecube.operators import quality as Q


@pytest.fixture(scope="module")
def field(spark):
    rng = np.random.default_rng(11)
    mask = spark.createDataFrame([(i, j, 40.0 + i, -90.0 + j, int(rng.random() < 0.9)) for i in range(9) for j in range(14)],
                                 "lat_idx bigint, lon_idx bigint, lat double, lon double, mask bigint")
    days = ["2000-01-01", "2000-01-02", "2000-01-03"]
    rows = [(d, i, j, float(rng.normal() * (1 + (j > 9) * 8))) for d in days for i in range(9) for j in range(14) if rng.random() < 0.8]
    truth = spark.createDataFrame(rows, "t string, lat_idx bigint, lon_idx bigint, sst double").select(F.to_date("t").alias("time"), "lat_idx", "lon_idx", "sst")
    dates = truth.select("time").distinct()
    pts = spark.createDataFrame([(0, 0), (4, 5), (8, 12), (3, 11)], "lat_idx bigint, lon_idx bigint")
    return pts, truth, mask, dates, N.fit_coord_map(mask)


@pytest.mark.parametrize("repeat,west", [(False, False), (True, True)])
def test_lazy_choice_equals_the_full_one(spark, field, monkeypatch, repeat, west):
    pts, truth, mask, dates, cp = field
    target = mask.filter("lon_idx < 8") if west else None
    scored = []
    changes = P._changes

    def counted(candidates, *args):
        scored.append(candidates.count())
        return changes(candidates, *args)

    monkeypatch.setattr(P, "_changes", counted)
    args = (pts, truth, mask, dates, 3, cp, 0.04, 1.0, 0.12)
    full, surface = P.greedy_place(*args, allow_repeat=repeat, target_mask=target)
    cells, everything = scored[0], sum(scored)
    assert surface.count() == 3 * cells
    scored.clear()
    monkeypatch.setattr(P, "BLOCK_TILES", 4)
    lazy, none = P.greedy_place(*args, allow_repeat=repeat, target_mask=target, surfaces=False)
    assert none.count() == 0
    a, b = ([(r["iteration"], r["cell_id"], pytest.approx(r["acquisition"], abs=1e-9)) for r in x.orderBy("iteration").collect()] for x in (full, lazy))
    assert a == b and len(a) == 3
    assert sum(scored) < everything                            # a bound kept some candidates from being scored


def test_bounds_hold_for_every_candidate(spark, field):
    pts, truth, mask, dates, cp = field
    radius, ls = 0.12, 0.04
    cells = P._tile(P.search_cells(mask, cp), radius)
    cur = pts.join(cells, ["lat_idx", "lon_idx"])
    sums = P.date_sums(P.context_values(cur, truth, dates), cells, ls, radius)
    bounds = P.tile_bounds(sums, cells, cells, dates.count(), radius, ls, 1.0)
    v = sums.select("task_time", F.col("target_id").alias("cand"), (F.col("sum_wy") / F.col("density")).alias("v"))
    got, *_ = P._changes(cells, cells, sums, v, dates.count(), radius, ls, 1.0)
    rows = got.join(bounds, ["ti", "tj"]).select((-F.col("change")).alias("gain"), "bound").collect()
    assert len(rows) == cells.count() and all(r["gain"] <= r["bound"] + 1e-9 for r in rows)


@pytest.mark.parametrize("values", [np.random.default_rng(1).lognormal(0, 4, 5000), np.random.default_rng(2).integers(0, 5, 4000).astype(float), np.ones(3000), np.arange(7.0)])
def test_percentiles_by_selection(spark, monkeypatch, values):
    monkeypatch.setattr(Q, "FETCH_ROWS", 50)
    df = spark.createDataFrame([(float(x),) for x in values] + [(None,)], "x double")
    for q in ((0.02, 0.98), (0.0, 1.0), (0.5, 0.123)):
        got = tuple(Q.robust_bounds(df, "x", q).first())
        assert got == pytest.approx(tuple(np.percentile(values, [100 * p for p in q])), rel=1e-12)
    assert tuple(Q.robust_bounds(df.filter("x is null"), "x").first()) == (None, None)


def test_pooled_moments_equal_the_anomalies_own(spark):
    rng = np.random.default_rng(4)
    rows = [(f"200{y}-0{m}-1{d}", i, j, float(rng.normal(10 * m, 1 + i)) if rng.random() < 0.8 else None)
            for y in range(3) for m in (1, 2) for d in range(4) for i in range(3) for j in range(2)]
    rows += [("2000-05-01", 0, 0, None), ("2000-06-01", 0, 0, 5.0)]
    grid = spark.createDataFrame(rows, "t string, lat_idx bigint, lon_idx bigint, sst double").select(F.to_date("t").alias("time"), "lat_idx", "lon_idx", "sst")
    m = clim.monthly_moments(grid, ["sst"])
    got = clim.pooled_anomaly_params(m, ["sst"]).first()
    want = N.fit_mean_std(clim.anomalies(grid, clim.climatology(grid, ["sst"]), ["sst"]), ["sst"]).first()
    assert got["var"] == "sst_anom" and got["mean"] == pytest.approx(want["mean"], abs=1e-12) and got["std"] == pytest.approx(want["std"], rel=1e-12)
    empty = clim.pooled_anomaly_params(clim.monthly_moments(grid.filter("1 = 0"), ["sst"]), ["sst"]).first()
    assert empty["mean"] is None and empty["std"] is None
