"""Sampling determinism, kernel prediction and greedy placement against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecube.operators import kernel as K
from lakecube.operators import normalize as N
from lakecube.operators import placement as P
from lakecube.operators import sampling as S


def _mask(spark, n_lat=6, n_lon=7, land=((0, 0), (5, 6), (2, 3))):
    rows = [(i, j, 40.0 + 0.5 * i, -90.0 + 0.5 * j, 0 if (i, j) in land else 1)
            for i in range(n_lat) for j in range(n_lon)]
    return spark.createDataFrame(rows, "lat_idx bigint, lon_idx bigint, lat double, lon double, mask bigint")


def _dates(spark, n=4):
    return spark.createDataFrame([(f"2000-01-{d:02d}",) for d in range(1, n + 1)], "t string") \
        .select(F.to_date("t").alias("time"))


def test_random_points_independent_of_partitioning(spark):
    m = _mask(spark)
    a = sorted(tuple(r) for r in S.random_points(m.repartition(1), 10, 3).collect())
    b = sorted(tuple(r) for r in S.random_points(m.repartition(13), 10, 3).collect())
    assert a == b and len({(r[1], r[2]) for r in a}) == 10
    assert all((r[1], r[2]) not in ((0, 0), (5, 6), (2, 3)) for r in a)     # water only


def test_random_points_too_many_raises(spark):
    with pytest.raises(ValueError):
        S.random_points(_mask(spark), 1000, 1)


def test_points_per_date_distinct_and_different(spark):
    pts = S.random_points_per_date(_dates(spark), _mask(spark), 8, 11).collect()
    by_date = {}
    for r in pts:
        by_date.setdefault(r.time, set()).add((r.lat_idx, r.lon_idx))
    assert len(by_date) == 4 and all(len(s) == 8 for s in by_date.values())
    assert len({frozenset(s) for s in by_date.values()}) > 1


def test_sample_rows_exact_n_and_matches_brute_force(spark):
    df = spark.range(5000).withColumnRenamed("id", "obs")
    got = sorted(r.obs for r in S.sample_rows(df, 123, 9, "obs").collect())
    brute = sorted(r.obs for r in df.orderBy(S.seeded_hash(9, "obs"), "obs").limit(123).collect())
    assert got == brute and len(got) == 123
    assert S.sample_rows(df.limit(50), 123, 9, "obs").count() == 50


def test_sample_n_rows_plans_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("time"), F.col("id").alias("lat_idx"),
                                  F.lit(0).alias("lon_idx"), F.col("id").cast("double").alias("v"))
    out = S.sample_n_rows(df, 5, 1, by="time", value_col="v")
    assert out.groupBy("time").count().filter("count != 5").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def _brute_predict(ctx, tgt, ls, noise, radius):
    out = {}
    for (tt, tid, tx, ty) in tgt:
        ws = [(math.exp(-((cx - tx) ** 2 + (cy - ty) ** 2) / (2 * ls * ls)), v)
              for (ct, cid, cx, cy, v) in ctx if ct == tt and (cx - tx) ** 2 + (cy - ty) ** 2 <= radius * radius]
        d = sum(w for w, _ in ws)
        if d > 0:
            mean = sum(w * v for w, v in ws) / d
            var = max(sum(w * v * v for w, v in ws) / d - mean * mean, 0.0)
        else:
            mean, var = None, 0.0
        out[(tt, tid)] = (mean, math.sqrt(var + noise * noise / (1 + d)))
    return out


def test_predict_grid_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    ctx = [(1, int(k), float(rng.uniform(0, 1)), float(rng.uniform(0, 1)), float(rng.normal())) for k in range(30)]
    ctx += [(2, int(k), float(rng.uniform(0, 1)), float(rng.uniform(0, 1)), float(rng.normal())) for k in range(5)]
    tgt = [(t, int(i * 10 + j), i / 9.0, j / 9.0) for t in (1, 2) for i in range(10) for j in range(10)]
    c = spark.createDataFrame(ctx, "task_time int, point_id bigint, x1 double, x2 double, value double")
    t = spark.createDataFrame(tgt, "task_time int, target_id bigint, x1 double, x2 double")
    got = {(r.task_time, r.target_id): (r.mean, r.std)
           for r in K.predict_grid(c, t, 0.1, 0.5, 0.3).collect()}
    want = _brute_predict(ctx, tgt, 0.1, 0.5, 0.3)
    assert set(got) == set(want)
    for k, (m, s) in want.items():
        gm, gs = got[k]
        assert (gm is None) == (m is None)
        if m is not None:
            assert gm == pytest.approx(m, abs=1e-9)
        assert gs == pytest.approx(s, abs=1e-9)


def test_zero_lengthscale_returns_context_value(spark):
    c = spark.createDataFrame([(1, 0, 0.5, 0.5, 3.25)], "task_time int, point_id bigint, x1 double, x2 double, value double")
    t = spark.createDataFrame([(1, 7, 0.5, 0.5)], "task_time int, target_id bigint, x1 double, x2 double")
    r = K.predict_grid(c, t, 1e-6, 1.0, 1e-5).first()
    assert r.mean == 3.25


def _greedy_brute(ctx_rows, cells, dates, ls, noise, radius, n_new):
    """Plain-python greedy: minimise mean std over targets and dates after adding a cell."""
    chosen = []
    cur = list(ctx_rows)               # (date, cid, x, y, value)
    for _ in range(n_new):
        best = None
        base = _brute_predict(cur, [(d, cid, x, y) for d in dates for cid, x, y in cells], ls, noise, radius)
        for cid, cx, cy in cells:
            if cid in chosen or any(c[1] == cid for c in ctx_rows):
                continue
            trial = list(cur)
            for d in dates:
                m = base[(d, cid)][0]
                trial.append((d, cid, cx, cy, 0.0 if m is None else m))
            pred = _brute_predict(trial, [(d, t, x, y) for d in dates for t, x, y in cells], ls, noise, radius)
            acq = sum(s for _, s in pred.values()) / len(pred)
            key = (round(acq, 12), cx, cy)
            if best is None or key < best[0]:
                best = (key, cid, cx, cy)
        chosen.append(best[1])
    return chosen


def test_greedy_first_pick_matches_brute_force(spark):
    mask = _mask(spark, 5, 6, land=())
    cp = N.fit_coord_map(mask)
    dates = _dates(spark, 2)
    truth_rows = []
    rng = np.random.default_rng(1)
    for d in ("2000-01-01", "2000-01-02"):
        for i in range(5):
            for j in range(6):
                truth_rows.append((d, i, j, float(rng.normal())))
    truth = spark.createDataFrame(truth_rows, "t string, lat_idx bigint, lon_idx bigint, sst double") \
        .select(F.to_date("t").alias("time"), "lat_idx", "lon_idx", "sst")
    pts = spark.createDataFrame([(0, 0), (4, 5)], "lat_idx bigint, lon_idx bigint")
    ls, noise, radius = 0.1, 1.0, 0.3
    chosen, surface = P.greedy_place(pts, truth, mask, dates, 2, cp, ls, noise, radius)
    picks = [r.cell_id for r in chosen.orderBy("iteration").collect()]
    assert len(set(picks)) == 2 and not {0, (4 << 32) + 5} & set(picks)
    # brute force of the first round from the same inputs
    cells = [(r.cell_id, r.x1, r.x2) for r in P.search_cells(mask, cp).collect()]
    xy = {c[0]: (c[1], c[2]) for c in cells}
    tv = {(r.time, (r.lat_idx << 32) + r.lon_idx): r.sst for r in truth.collect()}
    ds = sorted({r.time for r in truth.collect()})
    ctx = [(d, cid, *xy[cid], tv[(d, cid)]) for d in ds for cid in (0, (4 << 32) + 5)]
    first = _greedy_brute(ctx, cells, ds, ls, noise, radius, 1)[0]
    assert picks[0] == first
    # surface value of the pick equals the brute-force acquisition
    acq0 = {r.cell_id: r.acquisition for r in surface.filter("iteration = 0").collect()}
    assert min(acq0, key=lambda c: (acq0[c], xy[c][0], xy[c][1])) == first


def test_fixed_points_any_ids(spark):
    pts = spark.createDataFrame([(17, 0, 1), (4242, 2, 3)], "point_id bigint, lat_idx bigint, lon_idx bigint")
    out = S.fixed_points(_dates(spark, 3), pts).collect()
    assert len(out) == 6 and {r.point_id for r in out} == {17, 4242}


def test_static_context_at_fixed_points(spark):
    from lakecube.operators import tasks as T
    mask = _mask(spark, 4, 4, land=())
    bathy = mask.withColumn("depth", (F.col("lat_idx") * 10 + F.col("lon_idx")).cast("double"))
    pts = spark.createDataFrame([(0, 40.1, -89.9), (1, 41.4, -88.6)], "point_id bigint, lat double, lon double")
    cp = N.fit_coord_map(mask)
    tasks = T.build_tasks(_dates(spark, 2), [T.TaskSet("depth", bathy, pts)], None, cp)
    rows = sorted((r.point_id, r.value, r.task_time) for r in tasks.collect())
    assert rows == [(0, 0.0, None), (1, 33.0, None)]          # stored once, nearest cell's depth


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_sampling_same_rows_for_any_partitioning(spark, parts):
    mask = _mask(spark).repartition(parts)
    dates = _dates(spark, 5).repartition(parts)
    per_date = sorted(tuple(r) for r in S.random_points_per_date(dates, mask, 6, 5).collect())
    ref = sorted(tuple(r) for r in S.random_points_per_date(_dates(spark, 5), _mask(spark), 6, 5).collect())
    assert per_date == ref
    grid = spark.range(2000).select((F.col("id") % 7).alias("time"), F.floor(F.col("id") / 7).alias("lat_idx"),
                                    F.lit(0).alias("lon_idx"), F.col("id").cast("double").alias("v"))
    a = sorted(tuple(r) for r in S.sample_n_rows(grid.repartition(parts), 4, 3, value_col="v").collect())
    b = sorted(tuple(r) for r in S.sample_n_rows(grid, 4, 3, value_col="v").collect())
    assert a == b and len(a) == 28


def test_join_strategies_are_equi_joins(spark):
    c = spark.createDataFrame([(1, 0, 0.1, 0.1, 1.0)], "task_time int, point_id bigint, x1 double, x2 double, value double")
    t = spark.createDataFrame([(1, 7, 0.12, 0.1)], "task_time int, target_id bigint, x1 double, x2 double")
    plan = K.kernel_neighbours(c, t, 0.3)._jdf.queryExecution().executedPlan().toString()
    assert ("HashJoin" in plan or "SortMergeJoin" in plan) and "NestedLoop" not in plan and "Cartesian" not in plan
    from lakecube.operators import grid as G
    mask = _mask(spark, 3, 3, land=())
    pts = spark.createDataFrame([(40.2, -89.7)], "lat double, lon double")
    plan = G.bilinear_points(pts, mask)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_date_surface_averages_to_choice_surface(spark):
    mask = _mask(spark, 5, 6, land=())
    cp = N.fit_coord_map(mask)
    rng = np.random.default_rng(2)
    rows = [(d, i, j, float(rng.normal())) for d in ("2000-01-01", "2000-01-02", "2000-01-03")
            for i in range(5) for j in range(6) if rng.uniform() < 0.7]
    truth = spark.createDataFrame(rows, "t string, lat_idx bigint, lon_idx bigint, sst double") \
        .select(F.to_date("t").alias("time"), "lat_idx", "lon_idx", "sst")
    pts = spark.createDataFrame([(0, 0), (4, 5), (2, 2)], "lat_idx bigint, lon_idx bigint")
    args = (pts, truth, mask, _dates(spark, 3), 1, cp, 0.1, 1.0, 0.3)
    _, mean_surf = P.greedy_place(*args)
    _, by_date = P.greedy_place(*args, surface_by_date=True)
    assert by_date.count() == 3 * 30
    avg = {r.cell_id: r.a for r in by_date.groupBy("cell_id").agg(F.avg("acquisition").alias("a")).collect()}
    for r in mean_surf.collect():
        assert avg[r.cell_id] == pytest.approx(r.acquisition, abs=1e-12)
    # one date against brute force: mean std over that date's targets after adding the cell
    cells = [(r.cell_id, r.x1, r.x2) for r in P.search_cells(mask, cp).collect()]
    xy = {c[0]: (c[1], c[2]) for c in cells}
    d0 = sorted({r.time for r in truth.collect()})[0]
    tv = {(r.lat_idx << 32) + r.lon_idx: r.sst for r in truth.collect() if r.time == d0}
    ctx = [(d0, cid, *xy[cid], tv[cid]) for cid in (0, (4 << 32) + 5, (2 << 32) + 2) if cid in tv]
    base = _brute_predict(ctx, [(d0, c, x, y) for c, x, y in cells], 0.1, 1.0, 0.3)
    got = {r.cell_id: r.acquisition for r in by_date.filter(F.col("time") == F.lit(d0)).collect()}
    for cid, cx, cy in cells[:8]:
        m = base[(d0, cid)][0]
        trial = ctx + [(d0, cid, cx, cy, 0.0 if m is None else m)]
        pred = _brute_predict(trial, [(d0, c, x, y) for c, x, y in cells], 0.1, 1.0, 0.3)
        assert got[cid] == pytest.approx(sum(s for _, s in pred.values()) / len(pred), abs=1e-9)


def test_placement_eval_matches_per_round(spark):
    mask = _mask(spark, 5, 6, land=((0, 5),))
    cp = N.fit_coord_map(mask)
    rng = np.random.default_rng(3)
    rows = [(d, i, j, float(rng.normal())) for d in ("2000-01-01", "2000-01-02") for i in range(5) for j in range(6)]
    truth = spark.createDataFrame(rows, "t string, lat_idx bigint, lon_idx bigint, sst double") \
        .select(F.to_date("t").alias("time"), "lat_idx", "lon_idx", "sst") \
        .join(mask.select("lat_idx", "lon_idx", "lat", "lon"), ["lat_idx", "lon_idx"])
    pts = spark.createDataFrame([(0, 0), (4, 4)], "lat_idx bigint, lon_idx bigint")
    dates = _dates(spark, 2)
    chosen, _ = P.greedy_place(pts, truth, mask, dates, 2, cp, 0.1, 1.0, 0.3)
    got = {r.n_added: (r.rmse, r.mean_std) for r in P.placement_eval(pts, chosen, truth, mask, dates, cp,
                                                                       0.1, 1.0, 0.3).collect()}
    cells = P.search_cells(mask, cp)
    targets = (N.apply_coord_map(truth, cp).join(cells.select("lat_idx", "lon_idx"), ["lat_idx", "lon_idx"], "left_semi")
               .select(F.col("time").alias("task_time"), T_cell().alias("target_id"), "x1", "x2",
                       "lat_idx", "lon_idx", F.col("sst").alias("truth")))
    from lakecube.operators.scoring import weighted_scores
    for r in range(3):
        cur = pts.unionByName(chosen.filter(F.col("iteration") < r).select("lat_idx", "lon_idx")) \
            .join(cells, ["lat_idx", "lon_idx"])
        ctx = P.context_values(cur, truth, dates)
        p = K.predict_grid(ctx, targets, 0.1, 1.0, 0.3)
        w = weighted_scores(p.select(F.col("task_time").alias("time"), "lat_idx", "lon_idx", "mean", "std", "truth"),
                            mask).first()
        assert got[r][0] == pytest.approx(w.rmse, abs=1e-12) and got[r][1] == pytest.approx(w.mean_std, abs=1e-12)


def T_cell():
    from lakecube.operators.tasks import cell_id
    return cell_id()


def test_greedy_with_truth_infill(spark):
    mask = _mask(spark, 5, 6, land=())
    cp = N.fit_coord_map(mask)
    rng = np.random.default_rng(4)
    rows = [(d, i, j, float(rng.normal() * 3)) for d in ("2000-01-01", "2000-01-02") for i in range(5) for j in range(6)]
    truth = spark.createDataFrame(rows, "t string, lat_idx bigint, lon_idx bigint, sst double") \
        .select(F.to_date("t").alias("time"), "lat_idx", "lon_idx", "sst")
    pts = spark.createDataFrame([(0, 0), (4, 5), (2, 3)], "lat_idx bigint, lon_idx bigint")
    infill = P.proposed_infill(mask.select("lat_idx", "lon_idx"), truth, _dates(spark, 2))
    chosen, surf = P.greedy_place(pts, truth, mask, _dates(spark, 2), 2, cp, 0.1, 1.0, 0.3, infill=infill)
    picks = [r.cell_id for r in chosen.collect()]
    assert len(set(picks)) == 2 and not {0, (4 << 32) + 5, 2_000_003} & set(picks)
    _, surf_mean = P.greedy_place(pts, truth, mask, _dates(spark, 2), 1, cp, 0.1, 1.0, 0.3)
    a = {r.cell_id: r.acquisition for r in surf.filter("iteration = 0").collect()}
    b = {r.cell_id: r.acquisition for r in surf_mean.collect()}
    assert set(a) == set(b) and any(abs(a[c] - b[c]) > 1e-9 for c in a)   # truth infill changes the values


def test_predict_grid_explode_targets_same_as_context(spark):
    rng = np.random.default_rng(5)
    ctx = [(1, int(k), float(rng.uniform(0, 1)), float(rng.uniform(0, 1)), float(rng.normal())) for k in range(40)]
    tgt = [(1, int(i * 10 + j), i / 9.0, j / 9.0) for i in range(10) for j in range(10)]
    c = spark.createDataFrame(ctx, "task_time int, point_id bigint, x1 double, x2 double, value double")
    t = spark.createDataFrame(tgt, "task_time int, target_id bigint, x1 double, x2 double")
    want = _brute_predict(ctx, tgt, 0.1, 0.5, 0.3)
    for mode, small in (("targets", False), ("targets", True), ("context", False)):
        got = {(r.task_time, r.target_id): (r.mean, r.std)
               for r in K.predict_grid(c, t, 0.1, 0.5, 0.3, small_context=small, explode=mode).collect()}
        assert set(got) == set(want)
        for k, (m, s) in want.items():
            assert (got[k][0] is None) == (m is None)
            if m is not None:
                assert got[k][0] == pytest.approx(m, abs=1e-9)
            assert got[k][1] == pytest.approx(s, abs=1e-9)


def test_greedy_zero_rounds(spark):
    mask = _mask(spark, 3, 3, land=())
    truth = spark.createDataFrame([("2000-01-01", 0, 0, 1.0)], "t string, lat_idx bigint, lon_idx bigint, sst double") \
        .select(F.to_date("t").alias("time"), "lat_idx", "lon_idx", "sst")
    pts = spark.createDataFrame([(0, 0)], "lat_idx bigint, lon_idx bigint")
    chosen, surface = P.greedy_place(pts, truth, mask, _dates(spark, 1), 0, N.fit_coord_map(mask), 0.1)
    assert chosen.count() == 0 and surface.count() == 0


def test_zero_samples(spark):
    assert S.random_points_per_date(_dates(spark, 2), _mask(spark), 0, 1).count() == 0
    assert S.random_points(_mask(spark), 0, 1).count() == 0
    assert S.sample_rows(spark.range(10).withColumnRenamed("id", "obs"), 0, 1, "obs").count() == 0


def test_evaluate_plan_outputs(spark):
    from lakecube.plans.evaluate import evaluate
    mask = _mask(spark, 4, 5, land=((0, 0), (3, 4)))
    rng = np.random.default_rng(6)
    rows = [(d, i, j, float(rng.normal() + 10)) for d in ("2000-01-01", "2000-01-02") for i in range(4) for j in range(5)]
    grid = spark.createDataFrame(rows, "t string, lat_idx bigint, lon_idx bigint, sst double") \
        .select(F.to_date("t").alias("time"), "lat_idx", "lon_idx", "sst") \
        .join(mask.select("lat_idx", "lon_idx", "lat", "lon"), ["lat_idx", "lon_idx"])
    scores, masked = evaluate(grid, mask, _dates(spark, 2), ("2000-01-01", "2000-01-02"), 5, lengthscale=0.2)
    s = scores.first()
    assert s.n_scored > 0 and s.pooled_rmse >= 0 and s.mean_std > 0
    m = masked.collect()
    assert all(r.mean is None for r in m if (r.lat_idx, r.lon_idx) in ((0, 0), (3, 4)))
    assert any(r.mean is not None for r in m)
