"""Semantics ledger checks on hand-written grids (NaN, fill values, ties, edges)."""


import pytest
from pyspark.sql import functions as F

from conftest import small_grid
from lakecube.functions import columns as C
from lakecube.operators import clean, climatology as clim, grid, kernel as K, normalize as N, quality, sets


def test_sentinel_and_nan_become_null(spark):
    g = small_grid(spark, [("1995-01-01", 0, 0, -99999.0), ("1995-01-02", 0, 0, float("nan")),
                           ("1995-01-03", 0, 0, 5.0)])
    out = clean.sentinel_to_null(g).orderBy("time").select("sst", "lat_idx").collect()
    assert [r.sst for r in out] == [None, None, 5.0]
    assert [r.lat_idx for r in out] == [0, 0, 0]          # keys untouched


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-0.5,), (0.3,), (2.0,)], "x double")
    got = [r.c for r in df.select(C.clip("x").alias("c")).collect()]
    assert got == [None, 0.0, 0.3, 1.0]


def test_std_floor_replaces_null_and_small(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1e-7,), (0.5,)], "s double")
    got = [r.f for r in df.select(C.std_floor("s").alias("f")).collect()]
    assert got == [1e-6, 1e-6, 1e-6, 0.5]


def test_transform_ice(spark):
    df = spark.createDataFrame([(None,), (0.1,), (0.2,), (0.3,)], "x double")
    assert [r.i for r in df.select(C.transform_ice("x").alias("i")).collect()] == [None, 1, 1, 0]


def test_circ_time_reference_values(spark):
    df = spark.createDataFrame([("2009-01-01",), ("2022-12-31",)], "d string").select(F.to_date("d").alias("time"))
    cos_d, sin_d = C.circ_time("time")
    r = df.select(cos_d.alias("c"), sin_d.alias("s")).collect()
    assert round(r[0].s, 4) == 0.0172 and round(r[0].c, 4) == 0.9999
    assert round(r[1].s, 6) == -0.004301


def test_climatology_twelve_months_and_anomaly_mean_zero(spark):
    rows = []
    for m in range(1, 13):
        for day in (1, 15):
            for i in range(2):
                rows.append((f"1995-{m:02d}-{day:02d}", i, 0, float(m * 10 + day + i)))
                rows.append((f"1996-{m:02d}-{day:02d}", i, 0, float(m * 10 + day + i + 3)))
    g = small_grid(spark, rows)
    c = clim.climatology(g)
    assert c.select("month").distinct().count() == 12
    a = clim.anomalies(g, c)
    chk = clim.anomaly_check(a, "sst").collect()
    assert len(chk) == 12 and all(abs(r.mean_anomaly) < 1e-9 for r in chk)
    # W4 (window) equals A1 + J1 (aggregate + join)
    w = clim.anomaly_window(g)
    key = ["time", "lat_idx", "lon_idx"]
    diff = a.alias("a").join(w.alias("w"), key).select(F.max(F.abs(F.col("a.sst") - F.col("w.sst")))).first()[0]
    assert diff < 1e-9


def test_anomaly_missing_month_is_null(spark):
    g = small_grid(spark, [("1995-01-01", 0, 0, 1.0), ("1995-02-01", 0, 0, 2.0)])
    c = clim.climatology(g).filter("month = 1")
    got = {r.time.month: r.sst for r in clim.anomalies(g, c).collect()}
    assert got == {1: 0.0, 2: None}


def test_anomalies_require_climatology(spark):
    g = small_grid(spark, [("1995-01-01", 0, 0, 1.0)])
    with pytest.raises(ValueError):
        clim.anomalies(g, None)


def test_nearest_ties_and_edges(spark):
    axis = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 3.0)], "idx bigint, v double")
    pts = spark.createDataFrame([(1.5,), (2.5,), (0.5,), (3.0,), (9.0,)], "p double")
    lower = {r.p: r.n for r in grid.nearest_on_axis(pts, "p", axis, "v", "idx", "n", "lower").collect()}
    assert lower[1.5] == 1.0 and lower[2.5] == 2.0 and lower[3.0] == 3.0
    assert lower[0.5] is None and lower[9.0] is None            # no extrapolation
    upper = {r.p: r.n for r in grid.nearest_on_axis(pts, "p", axis, "v", "idx", "n", "upper",
                                                    extrapolate=True).collect()}
    assert upper[1.5] == 2.0 and upper[2.5] == 3.0 and upper[0.5] == 1.0 and upper[9.0] == 3.0


def test_regrid_identity(spark):
    g = small_grid(spark, [("1995-01-01", i, j, float(i * 10 + j)) for i in range(3) for j in range(4)]
                   + [("1995-01-03", i, j, float(100 + i * 10 + j)) for i in range(3) for j in range(4)])
    out = grid.regrid_nearest(g.drop("lat_idx", "lon_idx"), g, ["sst"]).withColumnRenamed("sst", "r")
    j = out.join(g, ["time", "lat_idx", "lon_idx"])
    assert j.count() == 24
    assert j.filter(~F.col("r").eqNullSafe(F.col("sst"))).count() == 0      # edges included, no NULLs


def test_nearest_axis_map_edges(spark):
    src = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "s double")
    tgt = spark.createDataFrame([(0.5,), (1.0,), (3.0,), (4.0,), (4.5,)], "t double")
    got = {r.t: r.m for r in grid.nearest_axis_map(tgt, "t", src, "s", "m").collect()}
    assert got == {0.5: None, 1.0: 1.0, 3.0: 2.0, 4.0: 4.0, 4.5: None}
    up = {r.t: r.m for r in grid.nearest_axis_map(tgt, "t", src, "s", "m", prefer="upper").collect()}
    assert up[3.0] == 4.0


def test_nearest_extrapolate_keeps_null(spark):
    axis = spark.createDataFrame([(0, 1.0), (1, 2.0)], "idx bigint, v double")
    pts = spark.createDataFrame([(None,), (5.0,)], "p double")
    got = {r.p: r.n for r in grid.nearest_on_axis(pts, "p", axis, "v", "idx", "n", extrapolate=True).collect()}
    assert got == {None: None, 5.0: 2.0}


def test_bilinear_on_lake(spark):
    mask = spark.createDataFrame(
        [(i, j, 40.0 + i, -90.0 + j, 1 if (i, j) != (2, 2) else 0) for i in range(3) for j in range(3)],
        "lat_idx bigint, lon_idx bigint, lat double, lon double, mask bigint")
    pts = spark.createDataFrame([(40.5, -89.5), (41.5, -88.5), (42.0, -90.0), (39.0, -90.0)], "lat double, lon double")
    got = {(r.lat, r.lon): (r.value, r.on_lake) for r in grid.bilinear_points(pts, mask).collect()}
    assert got[(40.5, -89.5)] == (1.0, True)
    assert got[(41.5, -88.5)][1] is False and abs(got[(41.5, -88.5)][0] - 0.75) < 1e-12
    assert got[(42.0, -90.0)] == (1.0, True)          # upper edge closed
    assert (39.0, -90.0) not in got                   # outside: no value


def test_coarsen_k1_identity_and_trim(spark):
    b = spark.createDataFrame([(i, j, 40.0 + i, -90.0 + j, float(i + j)) for i in range(5) for j in range(3)],
                              "lat_idx bigint, lon_idx bigint, lat double, lon double, depth double")
    one = grid.coarsen_mean(b, 1, 1, ["depth"])
    assert one.count() == 15
    two = grid.coarsen_mean(b, 2, 2, ["depth"]).orderBy("lat_block", "lon_block").collect()
    assert len(two) == 2 * 1                          # 5//2 x 3//2 blocks, remainder trimmed
    assert two[0].depth == 1.0 and two[0].lat == 40.5


def test_normalisation_round_trips(spark):
    df = spark.createDataFrame([(float(x), 40.0 + x, -90.0 + 2 * x) for x in range(10)], "v double, lat double, lon double")
    p = N.fit_mean_std(df, ["v"])
    back = N.apply_mean_std(N.apply_mean_std(df, p, ["v"]), p, ["v"], inverse=True)
    assert back.join(df.withColumnRenamed("v", "o"), ["lat", "lon"]).filter(F.abs(F.col("v") - F.col("o")) > 1e-9).count() == 0
    mm = N.fit_min_max(df, ["v"])
    for rng in ((0.0, 1.0), (-1.0, 1.0)):
        f = N.apply_min_max(df, mm, ["v"], feature_range=rng)
        assert f.agg(F.min("v"), F.max("v")).first() == (rng[0], rng[1])
        b = N.apply_min_max(f, mm, ["v"], inverse=True, feature_range=rng)
        assert b.join(df.withColumnRenamed("v", "o"), ["lat", "lon"]).filter(F.abs(F.col("v") - F.col("o")) > 1e-9).count() == 0
    cp = N.fit_coord_map(df)
    rows = {r.axis: r for r in cp.collect()}
    assert rows["x1"].hi - rows["x1"].lo == rows["x2"].hi - rows["x2"].lo == 18.0   # one shared span
    x = N.apply_coord_map(df, cp)
    assert x.agg(F.max("x1")).first()[0] == pytest.approx(0.5)
    inv = N.apply_coord_map(x.drop("lat", "lon"), cp, x1="x1", x2="x2", inverse=True, out1="lat", out2="lon")
    got = {r.v: (r.lat, r.lon) for r in inv.collect()}
    for r in df.collect():
        assert got[r.v][0] == pytest.approx(r.lat) and got[r.v][1] == pytest.approx(r.lon)


def test_missing_dates_equal_set_difference(spark):
    g = small_grid(spark, [("2012-08-20", 0, 0, 1.0), ("2012-08-23", 0, 0, 1.0), ("2012-08-24", 0, 0, 1.0)])
    a = sorted(r.time.isoformat() for r in quality.missing_dates(g).collect())
    b = sorted(r.time.isoformat() for r in quality.date_difference(g).collect())
    assert a == b == ["2012-08-21", "2012-08-22"]


def test_concat_keeps_duplicates(spark):
    g = small_grid(spark, [(f"1995-01-{d:02d}", 0, 0, 1.0) for d in range(1, 11)])
    assert sets.concat_years([g, g]).count() == 20


def test_split_modes(spark):
    g = small_grid(spark, [("2009-06-01", 0, 0, 1.0), ("2010-06-01", 0, 0, 1.0), ("2011-06-01", 0, 0, 1.0)])
    got = {r.time.year: r.split for r in clean.split_by_date(g, "debug").collect()}
    assert got == {2009: "train", 2010: "val"}
    with pytest.raises(ValueError):
        clean.split_by_date(g, "nope")


def test_histogram_counts_everything(spark):
    df = spark.range(1000).select((F.col("id") / 7.0).alias("x"))
    h = quality.histogram(df, "x", 50)
    assert h.count() == 50 and h.agg(F.sum("n")).first()[0] == 1000


def test_robust_bounds_match_linear_percentile(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("x"))
    r = quality.robust_bounds(df, "x").first()
    assert r.p02 == pytest.approx(2.0) and r.p98 == pytest.approx(98.0)


def test_degenerate_inputs_do_not_raise(spark):
    from lakecube.operators import kernel as K
    const = spark.range(10).select(F.lit(3.0).alias("x"), F.lit(40.0).alias("lat"), F.lit(-90.0).alias("lon"))
    h = quality.histogram(const, "x", 5).collect()
    assert sum(r.n for r in h) == 10 and [r.n for r in h if r.bin == 0] == [10]
    mm = N.fit_min_max(const, ["x"])
    assert N.apply_min_max(const, mm, ["x"]).first().x is None
    ms = N.fit_mean_std(const, ["x"])
    assert N.apply_mean_std(const, ms, ["x"]).first().x is None
    c = spark.createDataFrame([(1, 0, 0.0, 0.0, 2.0)], "task_time int, point_id bigint, x1 double, x2 double, value double")
    t = spark.createDataFrame([(1, 1, 5.0, 0.0)], "task_time int, target_id bigint, x1 double, x2 double")
    r = K.predict_grid(c, t, 0.01, 1.0, radius=10.0).first()      # weight underflows to 0
    assert r.mean is None and r.std == 1.0


def test_standardize_dates_table(spark):
    df = spark.createDataFrame([("2001-02-03 17:45:00",)], "t string").select(F.to_timestamp("t").alias("time"))
    out = clean.standardize_dates(df).first().time
    assert out.isoformat() == "2001-02-03"
    static = spark.createDataFrame([(1, 2)], "lat_idx bigint, lon_idx bigint")
    assert clean.standardize_dates(static).columns == ["lat_idx", "lon_idx"]


def test_mask_keeps_or_drops_land(spark):
    g = small_grid(spark, [("1995-01-01", 0, 0, 1.0), ("1995-01-01", 1, 0, 2.0)])
    mask = spark.createDataFrame([(0, 0, 1), (1, 0, 0)], "lat_idx bigint, lon_idx bigint, mask bigint")
    kept = {r.lat_idx: r.sst for r in grid.apply_mask(g, mask).collect()}
    assert kept == {0: 1.0, 1: None}
    assert [r.lat_idx for r in grid.apply_mask(g, mask, drop_land=True).collect()] == [0]
    with pytest.raises(ValueError):
        grid.apply_mask(g, mask.withColumnRenamed("mask", "m"))


def test_unnormalised_std_is_a_scale(spark):
    from lakecube.operators import kernel as K
    pred = spark.createDataFrame([(0.5, 2.0)], "mean double, std double")
    out = K.unnormalise_pred(pred, F.lit(10.0), F.lit(3.0)).first()
    assert out.mean == 11.5 and out.std == 6.0          # std * scale, no offset


def test_safe_task_build_reports_skipped_dates(spark):
    from lakecube.operators import tasks as T
    g = small_grid(spark, [("1995-01-02", 0, 0, 1.0), ("1995-01-04", 0, 0, 2.0)])
    req = spark.createDataFrame([("1995-01-0%d" % d,) for d in (1, 2, 3, 4)], "t string") \
        .select(F.to_date("t").alias("time"))
    cp = N.fit_coord_map(g)
    tasks, dates = T.build_tasks_safe(req, g, [T.TaskSet("sst", g, "all")], None, cp)
    assert {r.time.day: r.used for r in dates.collect()} == {1: False, 2: True, 3: False, 4: True}
    assert sorted(r.task_time.isoformat() for r in tasks.collect()) == ["1995-01-02", "1995-01-04"]


def test_single_label_axis(spark):
    axis = spark.createDataFrame([(3, 7.0)], "idx bigint, v double")
    pts = spark.createDataFrame([(7.0,), (9.0,), (None,)], "p double")
    exact = {r.p: r.n for r in grid.nearest_on_axis(pts, "p", axis, "v", "idx", "n").collect()}
    assert exact == {7.0: 7.0, 9.0: None, None: None}
    snap = {r.p: (r.n, r.n_idx) for r in grid.nearest_on_axis(pts, "p", axis, "v", "idx", "n",
                                                               extrapolate=True).collect()}
    assert snap == {7.0: (7.0, 3), 9.0: (7.0, 3), None: (None, None)}


def test_parameter_validation(spark):
    from lakecube.operators import dates as D
    g = small_grid(spark, [("1995-01-01", 0, 0, 1.0)])
    for call in (lambda: D.date_range_subsample(g, 0), lambda: D.every_kth(g, 0),
                 lambda: quality.histogram(g, "sst", 0), lambda: clean.limit_report(g, ["time"], -1),
                 lambda: grid.coarsen_mean(g, 0, 1, ["sst"])):
        with pytest.raises(ValueError):
            call()


def test_label_selection_ties_prefer_larger(spark):
    g = small_grid(spark, [("1997-10-24", 0, 0, 1.0), ("1997-10-26", 0, 0, 2.0),
                           ("1997-10-24", 1, 0, 3.0), ("1997-10-24", 0, 1, 4.0)])
    assert {r.time.isoformat() for r in clean.time_nearest(g, "1997-10-25").collect()} == {"1997-10-26"}
    # lat labels 40, 41 (lat_idx 0, 1): 40.5 is a tie -> 41; lon labels -90, -89: -89.5 -> -89
    cells = {(r.lat_idx, r.lon_idx) for r in clean.cell_nearest(g, 40.5, -89.5).collect()}
    assert cells == set() or cells == {(1, 1)}
    one = {(r.lat_idx, r.lon_idx) for r in clean.cell_nearest(g, 40.5, -90.0).collect()}
    assert one == {(1, 0)}


def test_bilinear_repeated_points_and_missing_corners(spark):
    mask = spark.createDataFrame([(i, j, float(i), float(j), 1) for i in range(3) for j in range(3) if (i, j) != (2, 2)],
                                 "lat_idx long, lon_idx long, lat double, lon double, mask long")
    pts = spark.createDataFrame([(0.5, 0.5), (0.5, 0.5), (1.5, 1.5), (1.0, 1.5)], "lat double, lon double")
    got = sorted((r.lat, r.lon, r.value, r.on_lake) for r in grid.bilinear_points(pts, mask).collect())
    assert got[:2] == [(0.5, 0.5, 1.0, True)] * 2
    assert (1.0, 1.5, 1.0, True) in got                       # the missing corner has no weight
    assert [(v, on) for a, b, v, on in got if (a, b) == (1.5, 1.5)] == [(None, False)]


def test_gap_fill_keeps_repeated_rows_and_leaves_land(spark):
    rows = [("1995-01-01", 0, 0, 5.0), ("1995-01-01", 0, 1, None), ("1995-01-01", 0, 1, None), ("1995-01-01", 1, 0, None)]
    g = small_grid(spark, rows)
    out = K.gap_fill(g, "sst", 1.0, radius=3.0).collect()
    assert len(out) == 4 and [round(r.sst, 6) for r in out if r.filled] == [5.0] * 3
    mask = spark.createDataFrame([(0, 0, 1), (0, 1, 1), (1, 0, 0)], "lat_idx long, lon_idx long, mask long")
    land = [r for r in K.gap_fill(g, "sst", 1.0, radius=3.0, mask=mask).collect() if (r.lat_idx, r.lon_idx) == (1, 0)]
    assert [(r.sst, r.filled) for r in land] == [(None, False)]


def test_predict_grid_repeated_target_ids(spark):
    c = spark.createDataFrame([("d", 1, 0.0, 0.0, 2.0)], "task_time string, point_id long, x1 double, x2 double, value double")
    t = spark.createDataFrame([("d", 7, 0.1, 0.0)] * 2 + [("d", 8, 0.1, 0.0)], "task_time string, target_id long, x1 double, x2 double")
    out = K.predict_grid(c, t, 0.1, 1.0, 0.3).collect()
    assert len(out) == 3 and len({round(r.density, 12) for r in out}) == 1


def test_points_of_two_dates_overlap_as_independent_draws_do(spark):
    import datetime as dt
    from lakecube.operators import sampling as S
    mask = spark.createDataFrame([(i // 20, i % 20, 0.0, 0.0, 1) for i in range(289)], "lat_idx long, lon_idx long, lat double, lon double, mask long")
    dates = spark.createDataFrame([(dt.date(1995, 1, 1) + dt.timedelta(days=k),) for k in range(120)], "time date")
    sets = {}
    for r in S.random_points_per_date(dates, mask, 20, 3).collect():
        sets.setdefault(r.time, set()).add((r.lat_idx, r.lon_idx))
    drawn = list(sets.values())
    assert all(len(s) == 20 for s in drawn) and len({frozenset(s) for s in drawn}) == 120
    overlaps = [len(a & b) for k, a in enumerate(drawn) for b in drawn[k + 1:]]
    assert abs(sum(overlaps) / len(overlaps) - 20 * 20 / 289) < 0.1 and max(overlaps) < 10


def test_a_cluster_needs_a_shared_checkpoint_folder():
    import pytest
    from types import SimpleNamespace
    from lakecube.session import ensure_checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d)))
