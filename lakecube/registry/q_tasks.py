"""Queries: seeded sampling and context/target task tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fixture, fixtures
from ..functions import columns as C
from ..operators import dates as D
from ..operators import normalize as N
from ..operators import quality, sampling
from ..operators import tasks as T
from .base import query, rounded
from .q_climate import sst_grid

_H = "md5(concat_ws('|', '{seed}', {cols}))"


def _h(seed, cols):
    return _H.format(seed=seed, cols=cols)


_ORDER = ("select *, row_number() over (order by " + _h(42, "lat_idx, lon_idx") +
          ", lat_idx, lon_idx) - 1 as pos from lakemask where mask = 1")


def _order(seed):
    return ("select *, row_number() over (order by " + _h(seed, "lat_idx, lon_idx") +
            ", lat_idx, lon_idx) - 1 as pos from lakemask where mask = 1")


_DATES5 = ("d5 as (select unnest(generate_series((select min(time) from sst_grid), "
           "(select max(time) from sst_grid), interval 5 day))::date as time)")

def _per_date_sql(seed, n, dates="d5"):
    """Round by round evaluation of the per-date shuffle (sampling.random_points_per_date)."""
    def num(cols):
        return f"('0x' || substr({_h(seed, cols)}, 1, 12))::bigint"
    return (f"o as ({_order(seed)}), m as (select count(*) as n from lakemask where mask = 1), "
            f"sh as (select {dates}.time, r.range as point_id, r.range as x, 0 as step from {dates}, range({n}) r "
            "union all select time, point_id, case when "
            f"{num('time, step, greatest(x, y)')} % 2 = 0 then y else x end, step + 1 from ("
            f"select sh.time, point_id, x, step, ({num('sh.time, step')} % m.n - x + m.n) % m.n as y from sh, m "
            f"where step < {sampling.SHUFFLE_STEPS})), "
            "pp as (select k.time, k.point_id, o.lat_idx, o.lon_idx, o.lat, o.lon from sh k join o "
            f"on o.pos = k.x where k.step = {sampling.SHUFFLE_STEPS})")


def _dates5(spark, sf_dir):
    return D.date_range_subsample(sst_grid(spark, sf_dir), 5)


@query("random_points", f"select pos as point_id, lat_idx, lon_idx, lat, lon from ({_ORDER}) where pos < 50",
       uses=("lakemask",))
def q_random_points(spark, sf_dir):
    return sampling.random_points(fixture(spark, sf_dir, "lakemask"), 50, seed=42)


@query("random_points_per_date", f"with recursive {_DATES5}, {_per_date_sql(42, 20)} select * from pp",
       uses=("sst_grid", "lakemask"))
def q_random_points_per_date(spark, sf_dir):
    return sampling.random_points_per_date(_dates5(spark, sf_dir), fixture(spark, sf_dir, "lakemask"), 20, 42)


@query("seed_override", f"with recursive {_DATES5}, {_per_date_sql(7, 10)} select * from pp",
       uses=("sst_grid", "lakemask"))
def q_seed_override(spark, sf_dir):
    return sampling.random_points_per_date(_dates5(spark, sf_dir), fixture(spark, sf_dir, "lakemask"), 10, 7)


@query("per_date_points",
       f"with recursive {_DATES5}, {_per_date_sql(42, 20)} select pp.time, pp.point_id, pp.lat_idx, pp.lon_idx, g.sst "
       "from pp join sst_grid g on g.time = pp.time and g.lat_idx = pp.lat_idx and g.lon_idx = pp.lon_idx",
       uses=("sst_grid", "lakemask"))
def q_per_date_points(spark, sf_dir):
    g = sst_grid(spark, sf_dir)
    pts = sampling.random_points_per_date(_dates5(spark, sf_dir), fixture(spark, sf_dir, "lakemask"), 20, 42)
    return pts.join(g.select("time", "lat_idx", "lon_idx", "sst"), ["time", "lat_idx", "lon_idx"]).select(
        "time", "point_id", "lat_idx", "lon_idx", "sst")


@query("fixed_points",
       f"with {_DATES5}, p as (select pos as point_id, lat_idx, lon_idx, lat, lon from ({_ORDER}) where pos < 50) "
       "select d5.time, p.* from d5 cross join p", uses=("sst_grid", "lakemask"))
def q_fixed_points(spark, sf_dir):
    pts = sampling.random_points(fixture(spark, sf_dir, "lakemask"), 50, seed=42)
    return sampling.fixed_points(D.date_range_subsample(sst_grid(spark, sf_dir), 5), pts)


@query("sample_n_context",
       "select time, lat_idx, lon_idx, sst from (select *, row_number() over (partition by time order by "
       + _h(42, "time, lat_idx, lon_idx") + ", lat_idx, lon_idx) as rn from sst_grid where sst is not null) "
       "where rn <= 5", uses=("sst_grid",))
def q_sample_n_context(spark, sf_dir):
    g = sst_grid(spark, sf_dir).select("time", "lat_idx", "lon_idx", "sst")
    return sampling.sample_n_rows(g, 5, 42, by="time", value_col="sst")


@query("sample_all", f"with {_DATES5} select * from sst_grid where time in (select time from d5)",
       uses=("sst_grid",))
def q_sample_all(spark, sf_dir):
    g = sst_grid(spark, sf_dir)
    return g.join(_dates5(spark, sf_dir), "time", "left_semi")


@query("sample_obs",
       "select obs, cast(time as varchar) as time, latitude, longitude, temperature_k from buoy_obs "
       "order by " + _h(42, "obs") + ", obs limit 2000", uses=("buoy_obs",))
def q_sample_obs(spark, sf_dir):
    o = fixture(spark, sf_dir, "buoy_obs")
    return sampling.sample_rows(o, 2000, 42, "obs").withColumn("time", F.col("time").cast("string"))


# --- task tables ---------------------------------------------------------------------------

_CP = ("cp as (select min(lat) as lo1, min(lon) as lo2, greatest(max(lat) - min(lat), max(lon) - min(lon)) as span "
       "from lakemask)")
_X = ("round((lat - cp.lo1) / ((cp.lo1 + cp.span) - cp.lo1), 6) as x1, "
      "round((lon - cp.lo2) / ((cp.lo2 + cp.span) - cp.lo2), 6) as x2")

_TASK_CTES = (
    f"with {_DATES5}, ad as (select time from d5 where time in (select time from sst_grid)), {_CP}, "
    "c0 as (select time as task_time, 'context' as role, 0::bigint as set_idx, 'sst' as var, "
    f"lat_idx * 4294967296 + lon_idx as point_id, {_X}, round(sst, 6) as value from "
    "(select g.*, row_number() over (partition by time order by " + _h(42, "time, lat_idx, lon_idx") +
    ", lat_idx, lon_idx) as rn from sst_grid g where sst is not null and time in (select time from ad)) s, cp "
    "where rn <= 20), "
    "c1 as (select cast(null as date) as task_time, 'context' as role, 1::bigint as set_idx, 'depth' as var, "
    f"lat_idx * 4294967296 + lon_idx as point_id, {_X}, round(depth, 6) as value from bathymetry, cp), "
    "c2 as (select time as task_time, 'context' as role, 2::bigint as set_idx, 'cos_D' as var, "
    "cast(null as bigint) as point_id, cast(null as double) as x1, cast(null as double) as x2, "
    "round(cos(2 * pi() * dayofyear(time) / 365.25e0), 6) as value from ad), "
    "t0 as (select time as task_time, 'target' as role, 0::bigint as set_idx, 'sst' as var, "
    f"lat_idx * 4294967296 + lon_idx as point_id, {_X}, round(sst, 6) as value from sst_grid, cp "
    "where time in (select time from ad)), "
    "tasks as (select * from c0 union all select * from c1 union all select * from c2 union all select * from t0) ")


def _tasks(spark, sf_dir):
    g = sst_grid(spark, sf_dir)
    bathy, mask = fixtures(spark, sf_dir, "bathymetry", "lakemask")
    cp = N.fit_coord_map(mask)
    used = quality.available_dates(_dates5(spark, sf_dir), g)
    cos_d, _ = C.circ_time("time")
    circ = quality.date_set(g).select("time", cos_d.alias("cos_D"))
    context = [T.TaskSet("sst", g, 20, seed=42), T.TaskSet("depth", bathy, "all"), T.TaskSet("cos_D", circ)]
    target = [T.TaskSet("sst", g, "all")]
    return T.build_tasks(used, context, target, cp)


def _r(df):
    return rounded(df, ["x1", "x2", "value"])


@query("build_tasks", _TASK_CTES + "select * from tasks", uses=("sst_grid", "lakemask", "bathymetry"))
def q_build_tasks(spark, sf_dir):
    return _r(_tasks(spark, sf_dir))


@query("task_report",
       _TASK_CTES + "select task_time, role, set_idx, var, count(*) as n_points, "
       "count(*) filter (where value is null) as n_missing from tasks group by 1, 2, 3, 4",
       uses=("sst_grid", "lakemask", "bathymetry"))
def q_task_report(spark, sf_dir):
    return T.task_report(_tasks(spark, sf_dir))


@query("remove_nans",
       _TASK_CTES + "select * from tasks where value is not null or role <> 'target'",
       uses=("sst_grid", "lakemask", "bathymetry"))
def q_remove_nans(spark, sf_dir):
    return _r(T.remove_nans(_tasks(spark, sf_dir), "target"))


@query("build_tasks_safe",
       "with r as (select unnest(generate_series(date '1994-12-02', (select max(time) from sst_grid), "
       "interval 5 day))::date as time), n as (select time, least(count(sst), 20) as n_rows from sst_grid group by 1) "
       "select r.time, n.time is not null as used, coalesce(n.n_rows, 0) as n_rows from r left join n on n.time = r.time",
       uses=("sst_grid",))
def q_build_tasks_safe(spark, sf_dir):
    """Every requested date, whether it was used, and the task rows it got."""
    g = sst_grid(spark, sf_dir)
    mask = fixture(spark, sf_dir, "lakemask")
    last = g.select(F.max("time")).scalar()
    req = g.sparkSession.range(1).select(F.explode(F.sequence(
        F.lit("1994-12-02").cast("date"), last, F.expr("INTERVAL 5 DAY"))).alias("time"))
    tasks, dates = T.build_tasks_safe(req, g, [T.TaskSet("sst", g, 20)], None, N.fit_coord_map(mask))
    made = tasks.groupBy(F.col("task_time").alias("time")).agg(F.count(F.lit(1)).alias("n_rows"))
    return dates.join(made, "time", "left").select("time", "used", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@query("target_none",
       f"with {_DATES5}, ad as (select time from d5 where time in (select time from sst_grid)), {_CP} "
       "select time as task_time, 'context' as role, 0::bigint as set_idx, 'sst' as var, "
       f"lat_idx * 4294967296 + lon_idx as point_id, {_X}, round(sst, 6) as value from "
       "(select g.*, row_number() over (partition by time order by " + _h(42, "time, lat_idx, lon_idx") +
       ", lat_idx, lon_idx) as rn from sst_grid g where sst is not null and time in (select time from ad)) s, cp "
       "where rn <= 20 union all select time, 'target', 0, 'sst', 0, "
       "round((45e0 - cp.lo1) / ((cp.lo1 + cp.span) - cp.lo1), 6), "
       "round((-85e0 - cp.lo2) / ((cp.lo2 + cp.span) - cp.lo2), 6), null from ad, cp",
       uses=("sst_grid", "lakemask"))
def q_target_none(spark, sf_dir):
    g = sst_grid(spark, sf_dir)
    mask = fixture(spark, sf_dir, "lakemask")
    used = quality.available_dates(D.date_range_subsample(g, 5), g)
    out = T.target_none(used, [T.TaskSet("sst", g, 20, seed=42)], N.fit_coord_map(mask), 45.0, -85.0, "sst")
    return _r(out)


@query("remove_target_nans",
       _TASK_CTES + "select * from tasks where value is not null or role <> 'target'",
       uses=("sst_grid", "lakemask", "bathymetry"))
def q_remove_target_nans(spark, sf_dir):
    return _r(T.remove_nans(_tasks(spark, sf_dir), "target"))


@query("remove_context_nans",
       _TASK_CTES + "select * from tasks where value is not null or role <> 'context'",
       uses=("sst_grid", "lakemask", "bathymetry"))
def q_remove_context_nans(spark, sf_dir):
    return _r(T.remove_nans(_tasks(spark, sf_dir), "context"))


@query("append_points",
       f"select pos as point_id, lat_idx, lon_idx, lat, lon from ({_order(42)}) where pos < 10 "
       f"union all select 10 + pos, lat_idx, lon_idx, lat, lon from ({_order(7)}) where pos < 1",
       uses=("lakemask",))
def q_append_points(spark, sf_dir):
    from ..operators import sets
    mask = fixture(spark, sf_dir, "lakemask")
    base = sampling.random_points(mask, 10, seed=42)
    new = sampling.random_points(mask, 1, seed=7).withColumn("point_id", F.col("point_id") + 10)
    return sets.append_points(base, new)


@query("predict_with_model",
       _TASK_CTES + ", c as (select task_time, x1, x2, value from c0 where value is not null), "
       "r as (select t.task_time, t.point_id, c.value as mean, "
       "sqrt(pow(t.x1 - c.x1, 2) + pow(t.x2 - c.x2, 2)) as std, row_number() over (partition by t.task_time, "
       "t.point_id order by pow(t.x1 - c.x1, 2) + pow(t.x2 - c.x2, 2), c.x1, c.x2) as rn from t0 t "
       "left join c on c.task_time = t.task_time) "
       "select task_time, point_id, mean, round(std, 6) as std from r where rn = 1",
       uses=("sst_grid", "lakemask", "bathymetry"))
def q_predict_with_model(spark, sf_dir):
    """V2: a user model (nearest context point) called once per task on the task table."""
    from ..functions.udf import nearest_context_model, predict_with_model
    out = predict_with_model(_r(_tasks(spark, sf_dir)), nearest_context_model)
    return rounded(out, ["std"])
