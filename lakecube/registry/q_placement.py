"""Queries: acquisition surfaces, greedy placement, placement scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fixture
from ..operators import dates as D
from ..operators import normalize as N
from ..operators import placement as P
from ..operators import quality, sampling
from .base import query, rounded
from .q_climate import sst_grid
from .q_tasks import _CP, _DATES5, _ORDER

LS = 0.05
RADIUS = 3 * LS
NOISE = 1.0
R2 = repr(RADIUS * RADIUS)
TWO_L2 = repr(2.0 * LS * LS)

# The starting network: 100 random water cells, or half of a mask that has fewer than 200.
START = 100
_START_SQL = f"least({START}, (select count(*) from lakemask where mask = 1) // 2)"


def start_points(mask):
    return sampling.random_points(mask, min(START, mask.filter("mask = 1").count() // 2), seed=42)


_ACQ_CTES = (
    f"with {_DATES5}, ad as (select time from d5 where time in (select time from sst_grid)), {_CP}, "
    "cells as (select lat_idx, lon_idx, lat, lon, lat_idx * 4294967296 + lon_idx as cell_id, "
    "(lat - cp.lo1) / ((cp.lo1 + cp.span) - cp.lo1) as x1, (lon - cp.lo2) / ((cp.lo2 + cp.span) - cp.lo2) as x2 "
    "from lakemask, cp where mask = 1), "
    f"pts as (select lat_idx, lon_idx from ({_ORDER}) where pos < {_START_SQL}), "
    "ctx as (select g.time as task_time, c.cell_id as point_id, c.x1, c.x2, g.sst as value from sst_grid g "
    "join pts p on p.lat_idx = g.lat_idx and p.lon_idx = g.lon_idx "
    "join cells c on c.lat_idx = g.lat_idx and c.lon_idx = g.lon_idx "
    "where g.time in (select time from ad) and g.sst is not null), "
    "pr as (select x.task_time, c.cell_id as target_id, pow(x.x1 - c.x1, 2) + pow(x.x2 - c.x2, 2) as d2, x.value "
    f"from ctx x, cells c where pow(x.x1 - c.x1, 2) + pow(x.x2 - c.x2, 2) <= {R2}), "
    f"s as (select task_time, target_id, sum(exp(-d2 / {TWO_L2})) as dens, "
    f"sum(exp(-d2 / {TWO_L2}) * value) as swy, sum(exp(-d2 / {TWO_L2}) * value * value) as swyy "
    "from pr group by 1, 2), "
    "st as (select target_id, sum(sqrt(greatest(swyy / dens - (swy / dens) * (swy / dens), 0) "
    f"+ {NOISE * NOISE!r} / (1 + dens))) as ss, count(*) as n from s group by 1), "
    "acq as (select c.cell_id, c.lat_idx, c.lon_idx, c.lat, c.lon, "
    f"(coalesce(st.ss, 0) + ((select count(*) from ad) - coalesce(st.n, 0)) * {NOISE!r}) / "
    "(select count(*) from ad) as acquisition from cells c left join st on st.target_id = c.cell_id) ")


#: Targets of their own: the western water cells.
_WEST = 15


def _greedy_sql(n_rounds: int, infill: bool = False, target: str = "cells") -> str:
    """Direct SQL evaluation of ``n_rounds`` greedy rounds (round r's context is the
    initial points plus the picks of rounds < r, with their truth values).  With
    ``infill`` a candidate carries the truth of its cell instead of the predicted mean."""
    vv = "coalesce(iv.sst, 0)" if infill else "coalesce(c.swy / c.dens, 0)"
    iv_join = (" left join sst_grid iv on iv.time = d.time and iv.lat_idx * 4294967296 + iv.lon_idx = p.cand"
               if infill else "")
    head = _ACQ_CTES[:_ACQ_CTES.index("pr as (")]          # d5, ad, cp, cells, pts, ctx
    parts = [head.rstrip().rstrip(",") + ", ",
             "truthw as (select g.time as task_time, c.cell_id, c.x1, c.x2, g.sst as value from sst_grid g "
             "join cells c on c.lat_idx = g.lat_idx and c.lon_idx = g.lon_idx "
             "where g.time in (select time from ad) and g.sst is not null), "
             f"west as (select * from cells where lon_idx < {_WEST}), "
             "ctx0 as (select task_time, point_id, x1, x2, value from ctx), "
             "ex0 as (select lat_idx * 4294967296 + lon_idx as cell_id from pts), "
             f"pairs as (select a.cell_id as cand, b.cell_id as tgt, "
             f"exp(-(pow(a.x1 - b.x1, 2) + pow(a.x2 - b.x2, 2)) / {TWO_L2}) as w from cells a, " + target + " b "
             f"where pow(a.x1 - b.x1, 2) + pow(a.x2 - b.x2, 2) <= {R2}), "
             f"nd as (select count(*) as n from ad), nc as (select count(*) as n from {target}), "]
    for r in range(n_rounds):
        parts.append(
            f"s{r} as (select x.task_time, c.cell_id as target_id, "
            f"sum(exp(-(pow(x.x1 - c.x1, 2) + pow(x.x2 - c.x2, 2)) / {TWO_L2})) as dens, "
            f"sum(exp(-(pow(x.x1 - c.x1, 2) + pow(x.x2 - c.x2, 2)) / {TWO_L2}) * x.value) as swy, "
            f"sum(exp(-(pow(x.x1 - c.x1, 2) + pow(x.x2 - c.x2, 2)) / {TWO_L2}) * x.value * x.value) as swyy "
            f"from ctx{r} x, cells c where pow(x.x1 - c.x1, 2) + pow(x.x2 - c.x2, 2) <= {R2} group by 1, 2), "
            f"so{r} as (select *, sqrt(greatest(swyy / dens - (swy / dens) * (swy / dens), 0) "
            f"+ {NOISE * NOISE!r} / (1 + dens)) as std0 from s{r}), "
            f"b{r} as (select coalesce(sum(std0), 0) + ((select n from nd) * (select n from nc) - count(*)) * {NOISE!r} as v "
            f"from so{r} where target_id in (select cell_id from {target})), "
            f"x{r} as (select p.cand, d.time as task_time, case when t.dens is null then "
            f"{NOISE!r} / sqrt(1 + p.w) - {NOISE!r} else "
            f"sqrt(greatest((t.swyy + p.w * {vv} * {vv}) / (t.dens + p.w) "
            f"- pow((t.swy + p.w * {vv}) / (t.dens + p.w), 2), 0) "
            f"+ {NOISE * NOISE!r} / (1 + t.dens + p.w)) - t.std0 end as delta from pairs p cross join ad d "
            f"left join so{r} t on t.task_time = d.time and t.target_id = p.tgt "
            f"left join so{r} c on c.task_time = d.time and c.target_id = p.cand{iv_join}), "
            f"a{r} as (select c.cell_id, c.lat_idx, c.lon_idx, c.lat, c.lon, "
            f"((select v from b{r}) + coalesce(x.sd, 0)) / ((select n from nd) * (select n from nc)) as acquisition "
            f"from cells c left join (select cand, sum(delta) as sd from x{r} group by cand) x on x.cand = c.cell_id), "
            f"pk{r} as (select {r}::bigint as iteration, * from a{r} where cell_id not in (select cell_id from ex{r}) "
            "order by acquisition, lat, lon limit 1), "
            f"ctx{r + 1} as (select * from ctx{r} union all select t.task_time, t.cell_id as point_id, t.x1, t.x2, "
            f"t.value from truthw t where t.cell_id in (select cell_id from pk{r})), "
            f"ex{r + 1} as (select cell_id from ex{r} union all select cell_id from pk{r}), ")
    sql = "".join(parts).rstrip().rstrip(",")
    picks = " union all ".join(f"select iteration, cell_id, lat_idx, lon_idx, lat, lon, "
                               f"round(acquisition, 6) as acquisition from pk{r}" for r in range(n_rounds))
    return sql + " " + picks


def _surfaces_sql(n_rounds: int) -> str:
    """Every round's acquisition surface from the same round-by-round evaluation."""
    chain = _greedy_sql(n_rounds)
    chain = chain[:chain.rindex(" select iteration, cell_id, lat_idx")] if n_rounds == 1 else \
        chain[:chain.index(" select iteration, cell_id, lat_idx, lon_idx, lat, lon, round(acquisition, 6) "
                           "as acquisition from pk0")]
    return chain + " " + " union all ".join(
        f"select {r}::bigint as iteration, cell_id, round(acquisition, 6) as acquisition from a{r}"
        for r in range(n_rounds))


def _date_surfaces_sql(n_rounds: int) -> str:
    """Per-round, per-date acquisition of every cell: (B_d + sum of that date's deltas) / T."""
    chain = _greedy_sql(n_rounds)
    chain = chain[:chain.index(" select iteration, cell_id, lat_idx, lon_idx, lat, lon, round(acquisition, 6) "
                               "as acquisition from pk0")]
    selects = []
    for r in range(n_rounds):
        selects.append(
            f"select {r}::bigint as iteration, d.time, c.cell_id, round((coalesce(bd.v, (select n from nc) * "
            f"{NOISE!r}) + coalesce(xd.sd, 0)) / (select n from nc), 6) as acquisition from cells c cross join ad d "
            f"left join (select task_time, sum(std0) + ((select n from nc) - count(*)) * {NOISE!r} as v "
            f"from so{r} group by task_time) bd on bd.task_time = d.time "
            f"left join (select cand, task_time, sum(delta) as sd from x{r} group by cand, task_time) xd "
            "on xd.cand = c.cell_id and xd.task_time = d.time")
    return chain + " " + " union all ".join(selects)


def _eval_rounds_sql(n_rounds: int) -> str:
    """Placement scores with 0..n_rounds added sensors from the same context chain."""
    chain = _greedy_sql(n_rounds)
    chain = chain[:chain.index(" select iteration, cell_id, lat_idx, lon_idx, lat, lon, round(acquisition, 6) "
                               "as acquisition from pk0")]
    extra = [", tg as (select g.time as task_time, c.cell_id as target_id, c.x1, c.x2, g.lat_idx, g.lon_idx, "
             "g.sst as truth from sst_grid g join cells c on c.lat_idx = g.lat_idx and c.lon_idx = g.lon_idx "
             "where g.time in (select time from ad)), "
             "wt as (select lat_idx, lon_idx, mask / (select sum(mask) from lakemask) as w from lakemask)"]
    selects = []
    for r in range(n_rounds + 1):
        extra.append(
            f", e{r} as (select tg.lat_idx, tg.lon_idx, tg.truth, s.swy / s.dens as mean, "
            "sqrt(greatest(coalesce(s.swyy / s.dens - (s.swy / s.dens) * (s.swy / s.dens), 0), 0) "
            f"+ {NOISE * NOISE!r} / (1 + coalesce(s.dens, 0))) as std from tg left join "
            f"(select x.task_time, c.cell_id as target_id, "
            f"sum(exp(-(pow(x.x1 - c.x1, 2) + pow(x.x2 - c.x2, 2)) / {TWO_L2})) as dens, "
            f"sum(exp(-(pow(x.x1 - c.x1, 2) + pow(x.x2 - c.x2, 2)) / {TWO_L2}) * x.value) as swy, "
            f"sum(exp(-(pow(x.x1 - c.x1, 2) + pow(x.x2 - c.x2, 2)) / {TWO_L2}) * x.value * x.value) as swyy "
            f"from ctx{r} x, cells c where pow(x.x1 - c.x1, 2) + pow(x.x2 - c.x2, 2) <= {R2} group by 1, 2) s "
            "on s.task_time = tg.task_time and s.target_id = tg.target_id), "
            f"k{r} as (select e.*, wt.w, case when e.std > 1e-6 then e.std else 1e-6 end as ss from e{r} e "
            "join wt on wt.lat_idx = e.lat_idx and wt.lon_idx = e.lon_idx), "
            f"n{r} as (select *, 0.5 * ln(2 * pi() * ss * ss) + 0.5 * (truth - mean) * (truth - mean) / (ss * ss) "
            f"as nll from k{r})")
        selects.append(
            f"select {r}::bigint as n_added, round(sqrt(sum(w * ((mean - truth) * (mean - truth))) / "
            "sum(case when (mean - truth) * (mean - truth) is not null then w end)), 6) as rmse, "
            "round(sum(w * std) / sum(case when std is not null then w end), 6) as mean_std, "
            f"round(sum(w * nll) / sum(case when nll is not null then w end), 6) as nll from n{r}")
    return chain + "".join(extra) + " " + " union all ".join(selects)


def _setup(spark, sf_dir):
    g = sst_grid(spark, sf_dir)
    mask = fixture(spark, sf_dir, "lakemask")
    cp = N.fit_coord_map(mask)
    dates = quality.available_dates(D.date_range_subsample(g, 5), g)
    pts = start_points(mask)
    return g, mask, cp, dates, pts


def _acq(spark, sf_dir):
    g, mask, cp, dates, pts = _setup(spark, sf_dir)
    cells = P.search_cells(mask, cp)
    cur = pts.select("lat_idx", "lon_idx").join(cells, ["lat_idx", "lon_idx"])
    ctx = P.context_values(cur, g, dates)
    return P.acquisition_mean(ctx, cells, dates.count(), LS, NOISE, RADIUS)


@query("acquisition_mean", _ACQ_CTES + "select cell_id, lat_idx, lon_idx, lat, lon, "
       "round(acquisition, 6) as acquisition from acq", uses=("sst_grid", "lakemask"))
def q_acquisition_mean(spark, sf_dir):
    return rounded(_acq(spark, sf_dir), ["acquisition"])


@query("argmax_cell", _ACQ_CTES + "select cell_id, lat_idx, lon_idx, lat, lon, round(acquisition, 6) as acquisition "
       "from acq order by acquisition desc, lat, lon limit 1", uses=("sst_grid", "lakemask"))
def q_argmax_cell(spark, sf_dir):
    return rounded(P.argmax_cell(_acq(spark, sf_dir)), ["acquisition"])


def greedy(spark, sf_dir, n_new=3, surfaces=True):
    g, mask, cp, dates, pts = _setup(spark, sf_dir)
    return P.greedy_place(pts, g, mask, dates, n_new, cp, LS, NOISE, RADIUS, surfaces=surfaces)


@query("greedy_place", _greedy_sql(3), uses=("sst_grid", "lakemask"))
def q_greedy_place(spark, sf_dir):
    """M5: three greedy rounds; one chosen cell per round (checked against a
    round-by-round SQL evaluation of the same acquisition)."""
    chosen, _ = greedy(spark, sf_dir, surfaces=False)
    return rounded(chosen.select("iteration", "cell_id", "lat_idx", "lon_idx", "lat", "lon", "acquisition"),
                   ["acquisition"])


@query("greedy_place_targets", _greedy_sql(3, target="west"), uses=("sst_grid", "lakemask"))
def q_greedy_place_targets(spark, sf_dir):
    """M5 with masks of their own: candidates are all water cells, targets those of the western half."""
    g, mask, cp, dates, pts = _setup(spark, sf_dir)
    chosen, _ = P.greedy_place(pts, g, mask, dates, 3, cp, LS, NOISE, RADIUS, target_mask=mask.filter(F.col("lon_idx") < _WEST), surfaces=False)
    return rounded(chosen.select("iteration", "cell_id", "lat_idx", "lon_idx", "lat", "lon", "acquisition"), ["acquisition"])


@query("acquisition_surface", _surfaces_sql(3), uses=("sst_grid", "lakemask"))
def q_acquisition_surface(spark, sf_dir):
    """M5 surfaces: acquisition of every water cell in every round."""
    _, surface = greedy(spark, sf_dir)
    return rounded(surface.select("iteration", "cell_id", "acquisition"), ["acquisition"])


@query("placement_eval", _eval_rounds_sql(3), uses=("sst_grid", "lakemask"))
def q_placement_eval(spark, sf_dir):
    """M6: weighted RMSE / mean std / NLL after 0..3 added sensors."""
    g, mask, cp, dates, pts = _setup(spark, sf_dir)
    chosen, _ = P.greedy_place(pts, g, mask, dates, 3, cp, LS, NOISE, RADIUS, surfaces=False)
    return rounded(P.placement_eval(pts, chosen, g, mask, dates, cp, LS, NOISE, RADIUS),
                   ["rmse", "mean_std", "nll"])


@query("proposed_infill",
       f"with {_DATES5}, pts as (select lat_idx, lon_idx from ({_ORDER}) where pos < {_START_SQL}) "
       "select g.time, g.lat_idx, g.lon_idx, g.sst as value from sst_grid g join pts p "
       "on p.lat_idx = g.lat_idx and p.lon_idx = g.lon_idx where g.time in (select time from d5)",
       uses=("sst_grid", "lakemask"))
def q_proposed_infill(spark, sf_dir):
    g = sst_grid(spark, sf_dir)
    pts = start_points(fixture(spark, sf_dir, "lakemask"))
    return P.proposed_infill(pts, g, D.date_range_subsample(g, 5))


@query("first_occurrence",
       "with b as (select time, lat, lon from (select time, lat, lon, row_number() over (partition by time "
       "order by sst desc, lat, lon) as rn from sst_grid where sst is not null) where rn = 1) "
       "select time as iteration, lat, lon from (select *, row_number() over (partition by lat, lon "
       "order by time) as k from b) where k = 1", uses=("sst_grid",))
def q_first_occurrence(spark, sf_dir):
    g = sst_grid(spark, sf_dir).filter(F.col("sst").isNotNull())
    best = g.groupBy("time").agg(F.max_by(F.struct("lat", "lon"), F.struct("sst", -F.col("lat"), -F.col("lon")))
                                 .alias("b")).select(F.col("time").alias("iteration"), "b.lat", "b.lon")
    return P.first_occurrence(best)


@query("acquisition_surface_by_date", _date_surfaces_sql(3), uses=("sst_grid", "lakemask"))
def q_acquisition_surface_by_date(spark, sf_dir):
    """M5 + K3: per-round, per-date acquisition of every water cell, written
    partitioned by iteration and read back."""
    import uuid
    from ..session import scratch_path
    from ..sinks.writers import write_points
    g, mask, cp, dates, pts = _setup(spark, sf_dir)
    _, surface = P.greedy_place(pts, g, mask, dates, 3, cp, LS, NOISE, RADIUS, surface_by_date=True)
    path = scratch_path(spark, f"acquisition-{uuid.uuid4().hex}")
    write_points(surface, path, ["iteration"])
    back = spark.read.parquet(path)
    return rounded(back.select("iteration", "time", "cell_id", "acquisition"), ["acquisition"])


@query("greedy_place_infill", _greedy_sql(3, infill=True), uses=("sst_grid", "lakemask"))
def q_greedy_place_infill(spark, sf_dir):
    """M5 with M7: candidates carry the truth value of their cell on
    each task date (proposed infill) instead of the predicted mean."""
    g, mask, cp, dates, pts = _setup(spark, sf_dir)
    water = mask.filter(F.col("mask") == 1).select("lat_idx", "lon_idx")
    infill = P.proposed_infill(water, g, dates)
    chosen, _ = P.greedy_place(pts, g, mask, dates, 3, cp, LS, NOISE, RADIUS, infill=infill, surfaces=False)
    return rounded(chosen.select("iteration", "cell_id", "lat_idx", "lon_idx", "lat", "lon", "acquisition"),
                   ["acquisition"])


# --- first greedy round against a direct SQL evaluation --------------------------------
_S_END = _ACQ_CTES.index("st as (")
_ROUND0 = (
    _ACQ_CTES[:_S_END]
    + "so as (select task_time, target_id, dens, swy, swyy, "
    f"sqrt(greatest(swyy / dens - (swy / dens) * (swy / dens), 0) + {NOISE * NOISE!r} / (1 + dens)) as std0 "
    "from s), "
    f"pairs as (select a.cell_id as cand, b.cell_id as tgt, exp(-(pow(a.x1 - b.x1, 2) + pow(a.x2 - b.x2, 2)) / {TWO_L2}) "
    f"as w from cells a, cells b where pow(a.x1 - b.x1, 2) + pow(a.x2 - b.x2, 2) <= {R2}), "
    "nd as (select count(*) as n from ad), nc as (select count(*) as n from cells), "
    "b as (select coalesce((select sum(std0) from so), 0) + "
    f"((select n from nd) * (select n from nc) - (select count(*) from so)) * {NOISE!r} as v), "
    "x as (select p.cand, case when t.dens is null then "
    f"{NOISE!r} / sqrt(1 + p.w) - {NOISE!r} else "
    "sqrt(greatest((t.swyy + p.w * coalesce(c.swy / c.dens, 0) * coalesce(c.swy / c.dens, 0)) / (t.dens + p.w) "
    "- pow((t.swy + p.w * coalesce(c.swy / c.dens, 0)) / (t.dens + p.w), 2), 0) "
    f"+ {NOISE * NOISE!r} / (1 + t.dens + p.w)) - t.std0 end as delta "
    "from pairs p cross join ad d left join so t on t.task_time = d.time and t.target_id = p.tgt "
    "left join so c on c.task_time = d.time and c.target_id = p.cand), "
    "acq0 as (select c.cell_id, c.lat_idx, c.lon_idx, c.lat, c.lon, "
    "((select v from b) + coalesce(x.sd, 0)) / ((select n from nd) * (select n from nc)) as acquisition "
    "from cells c left join (select cand, sum(delta) as sd from x group by cand) x on x.cand = c.cell_id) ")


def _round0(spark, sf_dir):
    g, mask, cp, dates, pts = _setup(spark, sf_dir)
    return P.greedy_place(pts, g, mask, dates, 1, cp, LS, NOISE, RADIUS)


@query("acquisition_round0",
       _ROUND0 + "select cell_id, lat_idx, lon_idx, lat, lon, round(acquisition, 6) as acquisition from acq0",
       uses=("sst_grid", "lakemask"))
def q_acquisition_round0(spark, sf_dir):
    """M5 first round: acquisition of every water cell (mean predicted std over
    targets and dates after adding the cell with its infilled value)."""
    _, surface = _round0(spark, sf_dir)
    return rounded(surface.select("cell_id", "lat_idx", "lon_idx", "lat", "lon", "acquisition"), ["acquisition"])


@query("greedy_first_pick",
       _ROUND0 + "select cell_id, lat_idx, lon_idx, lat, lon, round(acquisition, 6) as acquisition from acq0 "
       "where cell_id not in (select lat_idx * 4294967296 + lon_idx from pts) "
       "order by acquisition, lat, lon limit 1", uses=("sst_grid", "lakemask"))
def q_greedy_first_pick(spark, sf_dir):
    """M5 first round: the chosen cell (lowest acquisition, ties -> lat, lon; initial points excluded)."""
    chosen, _ = _round0(spark, sf_dir)
    return rounded(chosen.select("cell_id", "lat_idx", "lon_idx", "lat", "lon", "acquisition"), ["acquisition"])


_EVAL0 = (
    _ACQ_CTES[:_S_END]
    + "tg as (select g.time as task_time, g.lat_idx * 4294967296 + g.lon_idx as target_id, g.lat_idx, g.lon_idx, "
    "g.sst as truth from sst_grid g join cells c on c.lat_idx = g.lat_idx and c.lon_idx = g.lon_idx "
    "where g.time in (select time from ad)), "
    "pd as (select tg.lat_idx, tg.lon_idx, tg.truth, s.swy / s.dens as mean, "
    "sqrt(greatest(coalesce(s.swyy / s.dens - (s.swy / s.dens) * (s.swy / s.dens), 0), 0) "
    f"+ {NOISE * NOISE!r} / (1 + coalesce(s.dens, 0))) as std from tg "
    "left join s on s.task_time = tg.task_time and s.target_id = tg.target_id), "
    "wt as (select lat_idx, lon_idx, mask / (select sum(mask) from lakemask) as w from lakemask), "
    "k as (select pd.*, wt.w, case when pd.std > 1e-6 then pd.std else 1e-6 end as ss from pd "
    "join wt on wt.lat_idx = pd.lat_idx and wt.lon_idx = pd.lon_idx), "
    "kn as (select *, 0.5 * ln(2 * pi() * ss * ss) + 0.5 * (truth - mean) * (truth - mean) / (ss * ss) as nll "
    "from k) ")


@query("placement_eval_round0",
       _EVAL0 + "select 0::bigint as n_added, "
       "round(sqrt(sum(w * ((mean - truth) * (mean - truth))) / "
       "sum(case when (mean - truth) * (mean - truth) is not null then w end)), 6) as rmse, "
       "round(sum(w * std) / sum(case when std is not null then w end), 6) as mean_std, "
       "round(sum(w * nll) / sum(case when nll is not null then w end), 6) as nll from kn",
       uses=("sst_grid", "lakemask"))
def q_placement_eval_round0(spark, sf_dir):
    """M6 before any sensor is added: mask-weighted RMSE, mean std and NLL of the
    kernel prediction from the initial points, against truth on the task dates."""
    g, mask, cp, dates, pts = _setup(spark, sf_dir)
    none = spark.createDataFrame([], "lat_idx bigint, lon_idx bigint, x1 double, x2 double, cell_id bigint, "
                                     "iteration bigint")
    return rounded(P.placement_eval(pts, none, g, mask, dates, cp, LS, NOISE, RADIUS), ["rmse", "mean_std", "nll"])
