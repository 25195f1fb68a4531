"""Acquisition surfaces and greedy sensor placement.

The model is the kernel smoother of ``kernel.py``.  For a context set C and a
target cell t on date d it gives sums (rho, S1, S2) and

    std(rho, S1, S2) = sqrt(max(S2/rho - (S1/rho)^2, 0) + noise^2 / (1 + rho))

(std = noise where rho = 0).  Greedy placement follows the reference's
"Stddev" acquisition: the chosen cell c minimises the mean predicted std over
all target cells and task dates after c is added to the context with its
infilled value v(d, c) (the current predicted mean, or a supplied truth).  Adding
c only changes targets within the kernel radius, so

    acq(c) = (sum_{d,t} std_dt + sum_{(c,t) within radius} sum_d [std'_dt(c) - std_dt]) / (D * T)

is computed from the (candidate, target) pairs of the candidates being scored, joined to the sparse
per-date sums; targets with no context on a date contribute the closed form
noise * (1/sqrt(1 + w) - 1).  No candidate x target x date product is built.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import broadcast_if_small, ensure_checkpoint_dir, materialize_small
from .clean import CELL
from .kernel import kernel_neighbours, kernel_sums
from .normalize import apply_coord_map
from .tasks import cell_id


def _std(rho, s1, s2, noise: float):
    mean = F.try_divide(s1, rho)
    var = F.coalesce(F.try_divide(s2, rho) - mean * mean, F.lit(0.0))
    return F.sqrt(F.when(var > 0, var).otherwise(F.lit(0.0)) + F.lit(noise * noise) / (F.lit(1.0) + rho))


def search_cells(mask: DataFrame, coord_params: DataFrame) -> DataFrame:
    """Water cells (mask = 1) with an id and normalised coordinates."""
    w = mask.filter(F.col("mask") == 1).select(*CELL, "lat", "lon")
    return apply_coord_map(w, coord_params).withColumn("cell_id", cell_id())


def context_values(points: DataFrame, truth: DataFrame, dates: DataFrame, var: str = "sst") -> DataFrame:
    """Values of the truth grid at the context cells on every task date (missing dropped)."""
    t = truth.join(dates.select("time"), "time", "left_semi").select("time", *CELL, var)
    pts = broadcast_if_small(points.select(*CELL, "x1", "x2", F.col("cell_id").alias("point_id")))
    return (t.join(pts, list(CELL)).filter(F.col(var).isNotNull())
            .select(F.col("time").alias("task_time"), "point_id", "x1", "x2", F.col(var).alias("value")))


def date_sums(ctx: DataFrame, cells: DataFrame, lengthscale: float, radius: float) -> DataFrame:
    """(task_time, target_id, density, sum_wy, sum_wyy) of a per-date context on static cells."""
    targets = cells.select(F.col("cell_id").alias("target_id"), "x1", "x2")
    return kernel_sums(ctx, targets, lengthscale, radius, keys=(), carry=("task_time",))


def acquisition_mean(ctx: DataFrame, cells: DataFrame, n_dates: int, lengthscale: float, noise: float,
                     radius: float) -> DataFrame:
    """Predicted std at each cell averaged over the task dates
    (dates where the cell has no context contribute ``noise``)."""
    s = date_sums(ctx, cells, lengthscale, radius)
    per = s.groupBy("target_id").agg(
        F.sum(_std(F.col("density"), F.col("sum_wy"), F.col("sum_wyy"), noise)).alias("__s"),
        F.count(F.lit(1)).alias("__n"))
    out = cells.join(per, cells["cell_id"] == per["target_id"], "left")
    acq = (F.coalesce(F.col("__s"), F.lit(0.0)) + (F.lit(n_dates) - F.coalesce(F.col("__n"), F.lit(0)))
           * F.lit(noise)) / F.lit(max(n_dates, 1))
    return out.select("cell_id", *CELL, "lat", "lon", acq.alias("acquisition"))


def argmax_cell(surface: DataFrame, col: str = "acquisition", largest: bool = True) -> DataFrame:
    """The cell with the highest (or lowest) acquisition; ties -> smallest lat, then lon.

    A single partial aggregate (max_by / min_by), no sort of the surface.
    """
    key = F.struct(F.col(col) if largest else -F.col(col), -F.col("lat"), -F.col("lon"))
    best = surface.select(F.max_by(F.struct(*surface.columns), key).alias("b"))
    return best.select("b.*")


def _pairs(candidates: DataFrame, targets: DataFrame, radius: float, lengthscale: float) -> DataFrame:
    c = candidates.select(F.col("cell_id").alias("point_id"), "x1", "x2")
    t = targets.select(F.col("cell_id").alias("target_id"), "x1", "x2")
    p = kernel_neighbours(c, t, radius, keys=())
    return p.select(F.col("point_id").alias("cand"), "target_id",
                    F.exp(-F.col("d2") / F.lit(2.0 * lengthscale * lengthscale)).alias("w"))


SIDE = 2                 # tiles of candidates and targets have the side radius / SIDE
BLOCK_TILES = 256        # tiles scored together at first; every further block of a round has twice as many


def _tile(df: DataFrame, radius: float) -> DataFrame:
    side = radius / SIDE
    return df.withColumns({"ti": F.floor(F.col("x1") / side), "tj": F.floor(F.col("x2") / side)})


def _steps(di: int, dj: int) -> int:
    """Squared distance of the nearest points of two tiles, in tile sides."""
    return max(abs(di) - 1, 0) ** 2 + max(abs(dj) - 1, 0) ** 2


def tile_bounds(sums: DataFrame, targets: DataFrame, candidates: DataFrame, n_dates: int, radius: float,
                lengthscale: float, noise: float) -> DataFrame:
    """(ti, tj, bound): no candidate of the tile lowers the summed std by more than ``bound``.

    With weight w a target's variance falls from q to no less than rho * q / (rho + w), whatever value the candidate
    has, and that is least for the largest w.  So each target tile is summed once per distance of tiles, at the
    weight of its nearest point, and a candidate tile adds what the tiles around it could lose.  No pair of cells is formed.
    """
    reach = SIDE + 1
    offsets = [(i, j) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1) if _steps(i, j) <= SIDE * SIDE]
    levels = sorted({_steps(i, j) for i, j in offsets})
    weight = {k: math.exp(-k * (radius / SIDE) ** 2 / (2.0 * lengthscale * lengthscale)) for k in levels}
    rho, n2 = F.col("density"), noise * noise
    mean = F.try_divide("sum_wy", "density")
    var = F.greatest(F.coalesce(F.try_divide("sum_wyy", "density") - mean * mean, F.lit(0.0)), F.lit(0.0))
    old = F.sqrt(var + n2 / (1 + rho))
    seen = (sums.join(targets.select(F.col("cell_id").alias("target_id"), "ti", "tj"), "target_id").groupBy("ti", "tj")
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(old - F.sqrt(rho * var / (rho + weight[k]) + n2 / (1 + rho + weight[k]))).alias(f"b{k}") for k in levels]))
    tiles = targets.groupBy("ti", "tj").agg(F.count(F.lit(1)).alias("cells")).join(seen, ["ti", "tj"], "left")
    blank = F.col("cells") * F.lit(n_dates) - F.coalesce("n", F.lit(0))             # targets without context on a date
    near = F.array(*[F.struct(F.lit(-i).alias("i"), F.lit(-j).alias("j"), F.lit(levels.index(_steps(i, j))).alias("k")) for i, j in offsets])
    loss = F.array(*[F.coalesce(f"b{k}", F.lit(0.0)) + blank * (noise - noise / math.sqrt(1 + weight[k])) for k in levels])
    around = (tiles.select("ti", "tj", loss.alias("loss"), F.explode(near).alias("o"))
              .select((F.col("ti") + F.col("o.i")).alias("ti"), (F.col("tj") + F.col("o.j")).alias("tj"), F.element_at("loss", F.col("o.k") + 1).alias("b"))
              .groupBy("ti", "tj").agg(F.sum("b").alias("bound")))
    return candidates.select("ti", "tj").distinct().join(around, ["ti", "tj"], "left").withColumn("bound", F.coalesce("bound", F.lit(0.0)))


def _changes(candidates: DataFrame, targets: DataFrame, sums: DataFrame, values: DataFrame, n_dates: int,
             radius: float, lengthscale: float, noise: float) -> tuple[DataFrame, DataFrame, tuple]:
    """Each candidate with ``change``, what adding it changes in the summed std; the pairs are formed here and not kept.

    F0(c) = sum over c's neighbours of noise * (1/sqrt(1 + w) - 1) is the change that targets without context see on
    each date, G(c) corrects it for (neighbour, date) rows with context: change = D * F0(c) + G(c).
    """
    pairs = _pairs(candidates, targets, radius, lengthscale)
    f0 = F.lit(noise) * (F.lit(1.0) / F.sqrt(1 + F.col("w")) - 1)
    std_old = _std(F.col("density"), F.col("sum_wy"), F.col("sum_wyy"), noise)
    j = (pairs.join(sums, "target_id").join(values, ["task_time", "cand"], "left")
         .withColumn("v", F.coalesce("v", F.lit(0.0))))
    rho2 = F.col("density") + F.col("w")
    s1 = F.col("sum_wy") + F.col("w") * F.col("v")
    s2 = F.col("sum_wyy") + F.col("w") * F.col("v") * F.col("v")
    delta = _std(rho2, s1, s2, noise) - std_old - f0
    both = (pairs.groupBy("cand").agg((F.lit(float(n_dates)) * F.sum(f0)).alias("__c"))
            .unionByName(j.groupBy("cand").agg(F.sum(delta).alias("__c"))).groupBy("cand").agg(F.sum("__c").alias("__c")))
    out = (candidates.join(both, F.col("cell_id") == F.col("cand"), "left").drop("cand")
           .withColumn("change", F.coalesce("__c", F.lit(0.0))).drop("__c"))
    return out, j, (delta, f0, pairs)


def _lead(scored: DataFrame | None, bounds: DataFrame, score, n_tiles: int) -> DataFrame:
    """Lazy greedy step: ``scored`` plus the tiles whose bound leads, until no open tile can hold the best cell."""
    block, tiles = BLOCK_TILES, n_tiles
    while tiles:
        open_ = bounds if scored is None else bounds.join(scored.select("ti", "tj").distinct(), ["ti", "tj"], "left_anti")
        if scored is not None:
            best = scored.filter("open").agg(F.min("change")).first()[0]
            if best is not None:        # a bound that ties may hold a cell that ties
                open_ = open_.filter(F.col("bound") >= F.lit(-best - 1e-9 * max(1.0, abs(best))))
        leading = materialize_small(open_.orderBy(F.desc("bound"), "ti", "tj").limit(block).select("ti", "tj"), "leading")
        tiles = leading.count()
        if tiles:
            new = materialize_small(score(leading), "scored")
            scored = new if scored is None else materialize_small(scored.unionByName(new), "scored")
        if tiles < block:
            return scored
        block *= 2
    return scored


def greedy_place(points: DataFrame, truth: DataFrame, mask: DataFrame, dates: DataFrame, n_new: int,
                 coord_params: DataFrame, lengthscale: float, noise: float = 1.0, radius: float | None = None,
                 var: str = "sst", infill: DataFrame | None = None,
                 allow_repeat: bool = False, surface_by_date: bool = False,
                 target_mask: DataFrame | None = None, surfaces: bool = True) -> tuple[DataFrame, DataFrame]:
    """M5: add ``n_new`` sensors one at a time; returns (chosen points, acquisition surfaces).

    Candidates are the water cells of ``mask``; the std that a choice lowers is averaged over the water cells
    of ``target_mask`` (the same mask when not given).

    With ``surfaces`` the surface holds, per round, the date-mean acquisition of every candidate
    (the value the choice minimises).  With ``surface_by_date`` it holds
    one value per round, task date and cell instead (the reference's surface
    layout): acq_d(c) = (B_d + F0(c) + G_d(c)) / T, with B_d the summed std of
    date d, F0(c) the no-context change over c's neighbours and G_d(c) the
    correction for neighbours that have context on d.  The date x cell rows
    come from exploding the task-date list into each cell row (no join).

    Without ``surfaces`` the choice is lazy, with the same result: candidates lie in tiles, a tile has an upper bound of what
    any of its cells can gain (``tile_bounds``), and only tiles whose bound leads are scored.
    Scores stay valid in later rounds for tiles farther than two radii from every later pick: nothing they
    depend on has changed.  The surface is then empty.

    ``points``: the initial context cells (lat_idx, lon_idx, ...).  ``infill``
    optionally gives the value assumed at a new sensor (time, lat_idx, lon_idx,
    value); otherwise the current predicted mean is used (0 where undefined).
    Each round is a few distributed jobs; scores and the winner are
    written under the shared checkpoint folder and the context set is the
    union of written tables (initial points + winners), so the lineage stays
    one round long and survives executor loss.  (Candidate, target) pairs are formed
    for the candidates being scored and never written.
    Chosen cells are excluded from later rounds unless ``allow_repeat``.
    """
    ensure_checkpoint_dir(points.sparkSession)
    radius = radius if radius is not None else 3.0 * lengthscale
    lazy = not surfaces and not surface_by_date
    cells = materialize_small(_tile(search_cells(mask, coord_params), radius), "cells")
    targets = cells if target_mask is None else materialize_small(_tile(search_cells(target_mask, coord_params), radius), "targets")
    d = materialize_small(dates.select("time").distinct(), "dates")
    # truth on the task dates and water cells only, written once and reused by every round
    truth = materialize_small(truth.join(d, "time", "left_semi")
                              .join(cells.select(*CELL), list(CELL), "left_semi")
                              .select("time", *CELL, var), "truth")
    n_dates = d.count()
    n_cells = targets.count()
    total = float(n_dates * n_cells)
    cols = [*CELL, "x1", "x2", "cell_id", "lat", "lon"]
    cur = materialize_small(points.select(*CELL).join(cells, list(CELL)).select(*cols), "context")
    if lazy:
        n_tiles = cells.select("ti", "tj").distinct().count()
    rounds, shown, scored, tables = [], [], None, {}
    for it in range(n_new):
        # kernel sums add up: a round adds the last pick's share alone
        ctx = context_values(pick if it else cur, truth, d, var)
        for name, where in {"sums": targets, "at": cells}.items() if target_mask is not None else {"sums": targets}.items():
            own = date_sums(ctx, where, lengthscale, radius)
            if it:
                own = tables[name].unionByName(own).groupBy("task_time", "target_id").agg(
                    *[F.sum(c).alias(c) for c in ("density", "sum_wy", "sum_wyy")])
            tables[name] = materialize_small(own, name)
        sums = tables["sums"]
        std_old = _std(F.col("density"), F.col("sum_wy"), F.col("sum_wyy"), noise)
        base = sums.select(F.coalesce(F.sum(std_old), F.lit(0.0)) + (F.lit(total) - F.count(F.lit(1))) * F.lit(noise)).first()[0]
        if infill is not None:
            v = infill.select(F.col("time").alias("task_time"), cell_id().alias("cand"), F.col("value").alias("v"))
        else:
            v = tables.get("at", sums).select("task_time", F.col("target_id").alias("cand"),
                                              F.try_divide(F.col("sum_wy"), F.col("density")).alias("v"))
        taken = cur.select(F.col("cell_id").alias("__t")).distinct()

        def score(candidates):
            out, *rest = _changes(candidates, targets, sums, v, n_dates, radius, lengthscale, noise)
            if not allow_repeat:
                out = out.join(F.broadcast(taken), F.col("cell_id") == F.col("__t"), "left")
                return out.withColumn("open", F.col("__t").isNull()).drop("__t"), *rest
            return out.withColumn("open", F.lit(True)), *rest

        if lazy:
            bounds = materialize_small(tile_bounds(sums, targets, cells, n_dates, radius, lengthscale, noise), "bounds")
            scored = _lead(scored, bounds, lambda tiles: score(cells.join(F.broadcast(tiles), ["ti", "tj"], "left_semi"))[0], n_tiles)
        else:
            full, j, (delta, f0, pairs) = score(cells)
            scored = materialize_small(full, "surface")
        surf = scored.select(F.lit(it).cast("bigint").alias("iteration"), "cell_id", *CELL, "lat", "lon", "x1", "x2",
                             ((F.lit(base) + F.col("change")) / F.lit(max(total, 1.0))).alias("acquisition"), "open")
        if surface_by_date:
            shown.append(materialize_small(_date_surface(it, j, sums, pairs, cells, d, n_cells, noise, delta, f0, std_old), "date-surface"))
        elif not lazy:
            shown.append(surf.drop("open"))
        best = materialize_small(argmax_cell(surf.filter("open").drop("open"), largest=False).filter("cell_id is not null"), "chosen")
        rounds.append(best)
        # a union of written tables: the lineage stays short without another write
        pick = best.select(*cols)
        cur = cur.unionByName(pick)
        if lazy and it + 1 < n_new:     # scores within two radii of the pick are out of date
            at = best.select("x1", "x2").first()
            if at is None:
                continue
            side = radius / SIDE
            gap = [F.greatest(F.abs((F.col(t) + 0.5) * side - F.lit(at[x])) - side / 2, F.lit(0.0)) for t, x in (("ti", "x1"), ("tj", "x2"))]
            scored = scored.filter(gap[0] ** 2 + gap[1] ** 2 > F.lit((2 * radius * (1 + 1e-9)) ** 2))
            if not allow_repeat:
                scored = scored.filter(F.col("cell_id") != best.select("cell_id").scalar())
    empty = cells.select(F.lit(0).cast("bigint").alias("iteration"), "cell_id", *CELL, "lat", "lon",
                         "x1", "x2", F.lit(0.0).alias("acquisition")).limit(0)
    return functools.reduce(DataFrame.unionByName, rounds, empty) if rounds else empty, functools.reduce(DataFrame.unionByName, shown) if shown else empty


def _date_surface(it, j, sums, pairs, cells, dates, n_cells, noise, delta, f0, std_old) -> DataFrame:
    """Per-date acquisition of every cell for one round (see ``greedy_place``)."""
    g = j.groupBy("task_time", "cand").agg(F.sum(delta).alias("__g"))
    f0_c = pairs.groupBy("cand").agg(F.sum(f0).alias("__f0"))
    b_d = sums.groupBy("task_time").agg(
        (F.sum(std_old) + (F.lit(n_cells) - F.count(F.lit(1))) * F.lit(noise)).alias("__b"))
    day_list = dates.select(F.sort_array(F.collect_set("time"))).scalar()     # bounded by the task dates
    grid_dc = cells.select(F.explode(day_list).alias("task_time"), "cell_id", *CELL, "lat", "lon")
    g = g.select(F.col("task_time").alias("__gd"), F.col("cand").alias("__gc"), "__g")
    f0_c = f0_c.select(F.col("cand").alias("__fc"), "__f0")
    out = (grid_dc.join(b_d, "task_time", "left")
           .join(f0_c, F.col("cell_id") == F.col("__fc"), "left")
           .join(g, (F.col("task_time") == F.col("__gd")) & (F.col("cell_id") == F.col("__gc")), "left"))
    acq = (F.coalesce("__b", F.lit(n_cells * noise)) + F.coalesce("__f0", F.lit(0.0))
           + F.coalesce("__g", F.lit(0.0))) / F.lit(max(n_cells, 1))
    return out.select(F.lit(it).cast("bigint").alias("iteration"), F.col("task_time").alias("time"), "cell_id",
                      *CELL, "lat", "lon", acq.alias("acquisition"))


def placement_eval(points: DataFrame, chosen: DataFrame, truth: DataFrame, mask: DataFrame, dates: DataFrame,
                   coord_params: DataFrame, lengthscale: float, noise: float = 1.0,
                   radius: float | None = None, var: str = "sst") -> DataFrame:
    """M6: after 0..N added sensors, mask-weighted RMSE, mean std and NLL of the
    prediction against truth on the task dates (one row per round).

    Kernel sums are tagged by the round that adds them.  A target has one row for the start and one per
    round that reaches it, with what that round changes; changes add up over the rounds, so
    targets that a round leaves alone are carried over and not evaluated again."""
    radius = radius if radius is not None else 3.0 * lengthscale
    cells = materialize_small(search_cells(mask, coord_params), "cells")
    d = materialize_small(dates.select("time").distinct(), "dates")
    truth = materialize_small(truth.join(d, "time", "left_semi").select("time", *CELL, "lat", "lon", var), "truth")
    targets = (apply_coord_map(truth, coord_params)
               .join(cells.select(*CELL), list(CELL), "left_semi")
               .select(F.col("time").alias("task_time"), cell_id().alias("target_id"), "x1", "x2",
                       *CELL, F.col(var).alias("truth")))
    base = points.select(*CELL).join(cells, list(CELL)).select(*CELL, "x1", "x2", "cell_id")
    last = chosen.select(F.max("iteration")).first()[0]                  # one scalar
    n_rounds = 0 if last is None else int(last) + 1
    # a context point is counted once, in the round that adds it (0: from the start)
    members = (base.withColumn("n_added", F.lit(0).cast("bigint"))
               .unionByName(chosen.select(*CELL, "x1", "x2", "cell_id", (F.col("iteration").cast("bigint") + 1).alias("n_added"))))
    ctx = (truth.select("time", *CELL, var).join(broadcast_if_small(members), list(CELL))
           .filter(F.col(var).isNotNull())
           .select("n_added", F.col("time").alias("task_time"), F.col("cell_id").alias("point_id"), "x1", "x2",
                   F.col(var).alias("value")))
    places = targets.select("task_time", "target_id", "x1", "x2").dropDuplicates(["task_time", "target_id"])
    own = kernel_sums(ctx, places, lengthscale, radius, carry=("n_added",))
    # at most N + 1 entries per target: the rounds that reach it
    own = own.groupBy("task_time", "target_id").agg(F.collect_list(F.struct("n_added", "density", "sum_wy", "sum_wyy")).alias("__own"))
    total = mask.select(F.sum("mask")).scalar()
    wt = broadcast_if_small(mask.select(*CELL, F.try_divide(F.col("mask"), total).alias("__w")))
    rows = (targets.select("task_time", "target_id", *CELL, "truth").join(own, ["task_time", "target_id"], "left").join(wt, list(CELL))
            .withColumn("__own", F.coalesce("__own", F.array().cast("array<struct<n_added:bigint,density:double,sum_wy:double,sum_wyy:double>>")))
            .withColumn("n_added", F.explode(F.array_union(F.array(F.lit(0).cast("bigint")), F.col("__own.n_added")))))

    def parts(upto):
        """Weighted terms of the scores with the rounds that ``upto`` keeps: what a round changes is their difference."""
        def total(c):
            return F.aggregate(F.filter("__own", upto), F.lit(0.0), lambda acc, x: acc + x.getField(c))
        rho = total("density")
        mean = F.try_divide(total("sum_wy"), rho)
        std = _std(rho, total("sum_wy"), total("sum_wyy"), noise)
        e, nll, w = C.error(mean, "truth"), C.gaussian_nll("truth", mean, std), F.col("__w")
        def present(x):
            return F.when(x.isNotNull(), w).otherwise(F.lit(0.0))
        return [F.coalesce(w * e * e, F.lit(0.0)), present(e), w * std, w, F.coalesce(w * nll, F.lit(0.0)), present(nll)]

    now, before = parts(lambda x: x.getField("n_added") <= F.col("n_added")), parts(lambda x: x.getField("n_added") < F.col("n_added"))
    names = [f"__p{i}" for i in range(len(now))]
    first = F.col("n_added") == 0
    per = rows.groupBy("n_added").agg(*[F.sum(F.when(first, x).otherwise(x - y)).alias(n) for n, x, y in zip(names, now, before)])
    every = points.sparkSession.range(n_rounds + 1).select(F.col("id").alias("n_added")).join(F.broadcast(per), "n_added", "left")
    upto = Window.orderBy("n_added").rowsBetween(Window.unboundedPreceding, 0)          # one row per round
    sums = every.select("n_added", *[F.sum(F.coalesce(n, F.lit(0.0))).over(upto).alias(n) for n in names])
    return sums.select("n_added", F.sqrt(F.try_divide("__p0", "__p1")).alias("rmse"), F.try_divide("__p2", "__p3").alias("mean_std"),
                       F.try_divide("__p4", "__p5").alias("nll"))


def proposed_infill(points: DataFrame, truth: DataFrame, dates: DataFrame, var: str = "sst") -> DataFrame:
    """M7: truth values at newly placed cells on the task dates (value assumed there)."""
    t = truth.join(dates.select("time"), "time", "left_semi")
    return (t.join(broadcast_if_small(points.select(*CELL)), list(CELL))
            .select("time", *CELL, F.col(var).alias("value")))


def first_occurrence(chosen: DataFrame, keys=("lat", "lon"), order: str = "iteration") -> DataFrame:
    """Keep the first time each location was chosen (ordered de-duplication).

    A ``min_by`` aggregate per location: partial aggregation runs before the
    shuffle, so a location chosen very often is reduced map-side.
    """
    rest = [c for c in chosen.columns if c not in keys]
    first = chosen.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("__f"))
    return first.select(*keys, *[F.col(f"__f.{c}").alias(c) for c in rest]).select(*chosen.columns)
