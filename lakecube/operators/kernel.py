"""Kernel gap filling and prediction.

The reference predicts with a neural process that is not rebuilt here.  The
predictor is a documented kernel smoother with compact support: a context
point (x, y, value) influences a target within ``radius`` with weight
``w = exp(-d^2 / (2 l^2))``.  Per target:

    density = sum(w)
    mean    = sum(w * y) / density                          (NULL when density = 0)
    std     = sqrt(max(sum(w * y^2) / density - mean^2, 0) + noise^2 / (1 + density))

so a target with no context gets mean NULL and std = noise.  Results are not
comparable with the neural model's numbers.

Pairs are found with a tiled range join: one side (the smaller one: the
context by default, the missing cells when gap filling) is copied into the
3 x 3 tiles of side ``radius`` around each point and equi-joined to the other
side's tile (plus the task key), with the exact distance test as the join
condition.  Only points in neighbouring tiles are ever compared, and only
pairs within the radius are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import broadcast_if_small, materialize_small

_OFFSETS = [(di, dj) for di in (-1, 0, 1) for dj in (-1, 0, 1)]




def kernel_neighbours(context: DataFrame, targets: DataFrame, radius: float,
                      keys: Sequence[str] = ("task_time",), x: str = "x1", y: str = "x2",
                      ctx_id: str = "point_id", tgt_id: str = "target_id",
                      carry: Sequence[str] = (), small_context: bool = False) -> DataFrame:
    """(keys, carry, ctx_id, tgt_id, d2) for every context/target pair closer than ``radius``.

    ``keys`` must match on both sides (e.g. the task date); ``carry`` columns
    come from the context only (e.g. the date of a context set joined to a
    static target grid).  With ``small_context`` the context is written once,
    and its exploded tiles are broadcast if their written size allows, so the
    (large) target side is streamed without a shuffle.
    """
    r = float(radius)
    ctx = context.select(*keys, *carry, F.col(ctx_id).alias("__cid"), F.col(x).alias("__cx"),
                         F.col(y).alias("__cy"), *[c for c in context.columns if c == "value"])
    if small_context:
        ctx = materialize_small(ctx, "context")
    offs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in _OFFSETS])
    ctx = (ctx.withColumn("__o", F.explode(offs))
           .withColumn("__ti", F.floor(F.col("__cx") / r) + F.col("__o.a"))
           .withColumn("__tj", F.floor(F.col("__cy") / r) + F.col("__o.b")).drop("__o"))
    if small_context:
        ctx = broadcast_if_small(ctx)
    tgt = targets.select(*keys, F.col(tgt_id).alias("__tid"), F.col(x).alias("__tx"), F.col(y).alias("__ty"),
                         F.floor(F.col(x) / r).alias("__ti"), F.floor(F.col(y) / r).alias("__tj"))
    pairs = ctx.join(tgt, [*keys, "__ti", "__tj"])
    d2 = (F.col("__cx") - F.col("__tx")) ** 2 + (F.col("__cy") - F.col("__ty")) ** 2
    out = pairs.withColumn("d2", d2).filter(F.col("d2") <= F.lit(r * r))
    return out.select(*keys, *carry, F.col("__cid").alias(ctx_id), F.col("__tid").alias(tgt_id), "d2",
                      *[c for c in ctx.columns if c == "value"])


def kernel_sums(context: DataFrame, targets: DataFrame, lengthscale: float, radius: float | None = None,
                keys: Sequence[str] = ("task_time",), x: str = "x1", y: str = "x2",
                ctx_id: str = "point_id", tgt_id: str = "target_id", carry: Sequence[str] = (),
                small_context: bool = True) -> DataFrame:
    """M1: set-convolution encoding per target: density sum(w), sum(w*y), sum(w*y^2).

    Context rows with a missing value are ignored.  Aggregation is partial
    (map-side) before the shuffle on (keys, target).
    """
    radius = radius if radius is not None else 3.0 * lengthscale
    ctx = context.filter(F.col("value").isNotNull())
    pairs = kernel_neighbours(ctx, targets, radius, keys, x, y, ctx_id, tgt_id, carry, small_context)
    w = F.exp(-F.col("d2") / F.lit(2.0 * lengthscale * lengthscale))
    return pairs.groupBy(*keys, *carry, tgt_id).agg(
        F.sum(w).alias("density"), F.sum(w * F.col("value")).alias("sum_wy"),
        F.sum(w * F.col("value") * F.col("value")).alias("sum_wyy"))


def kernel_encode(context: DataFrame, targets: DataFrame, lengthscale: float, radius: float | None = None,
                  keys: Sequence[str] = ("task_time",), x: str = "x1", y: str = "x2",
                  ctx_id: str = "point_id", tgt_id: str = "target_id") -> DataFrame:
    """M1: density and signal (sum(w*y)/sum(w)) on the given internal grid points."""
    s = kernel_sums(context, targets, lengthscale, radius, keys, x, y, ctx_id, tgt_id)
    return s.select(*keys, tgt_id, "density", C.div("sum_wy", "density").alias("signal"))


def predict_grid(context: DataFrame, targets: DataFrame, lengthscale: float, noise: float = 1.0,
                 radius: float | None = None, keys: Sequence[str] = ("task_time",), x: str = "x1",
                 y: str = "x2", ctx_id: str = "point_id", tgt_id: str = "target_id",
                 small_context: bool = True, explode: str = "context") -> DataFrame:
    """M2: mean and std at every target row (targets without context keep mean NULL).

    ``explode`` picks the side copied into the 3 x 3 neighbouring tiles: the
    smaller one ("context" for sparse sensors, "targets" when filling a few
    gaps from a dense grid); the pairs found are the same either way.

    ``targets`` lists the target points of each task (e.g. the target rows of
    a task table), so the dense output comes from data rather than from a
    (date x cell) product.  Targets are left-joined to the context tiles (the
    distance test is the join condition; a sparse context is broadcast, so the
    targets stream through without a shuffle) and reduced by one aggregation
    per (keys, target).
    """
    radius = radius if radius is not None else 3.0 * lengthscale
    r = float(radius)
    columns = targets.columns
    targets = targets.withColumn("__row", F.monotonically_increasing_id())      # repeated target ids stay rows of their own
    ctx = context.filter(F.col("value").isNotNull()).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col(x).alias("__cx"), F.col(y).alias("__cy"),
        F.col("value").alias("__v"))
    if small_context:
        ctx = materialize_small(ctx, "context")
    offs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in _OFFSETS])
    if explode == "context":
        ctx = (ctx.withColumn("__o", F.explode(offs))
               .withColumn("__cti", F.floor(F.col("__cx") / r) + F.col("__o.a"))
               .withColumn("__ctj", F.floor(F.col("__cy") / r) + F.col("__o.b")).drop("__o"))
        tgt = targets.withColumns({"__ti": F.floor(F.col(x) / r), "__tj": F.floor(F.col(y) / r)})
    elif explode == "targets":
        ctx = ctx.withColumns({"__cti": F.floor(F.col("__cx") / r), "__ctj": F.floor(F.col("__cy") / r)})
        tgt = (targets.withColumn("__o", F.explode(offs))
               .withColumn("__ti", F.floor(F.col(x) / r) + F.col("__o.a"))
               .withColumn("__tj", F.floor(F.col(y) / r) + F.col("__o.b")).drop("__o"))
    else:
        raise ValueError("explode must be 'context' or 'targets'")
    if small_context:
        ctx = broadcast_if_small(ctx)
    d2 = (F.col("__cx") - F.col(x)) ** 2 + (F.col("__cy") - F.col(y)) ** 2
    cond = [F.col(k) == F.col(f"__k_{k}") for k in keys]
    cond += [F.col("__ti") == F.col("__cti"), F.col("__tj") == F.col("__ctj"), d2 <= F.lit(r * r)]
    joined = tgt.join(ctx, cond, "left")
    w = F.exp(-d2 / F.lit(2.0 * lengthscale * lengthscale))
    rest = [c for c in columns if c not in (*keys, tgt_id)]
    agg = joined.groupBy(*keys, tgt_id, "__row").agg(
        *[F.first(c).alias(c) for c in rest],
        F.sum(w).alias("__d"), F.sum(w * F.col("__v")).alias("__s1"),
        F.sum(w * F.col("__v") * F.col("__v")).alias("__s2"))
    dens = F.coalesce(F.col("__d"), F.lit(0.0))
    mean = C.div("__s1", "__d")                     # NULL without context (or when weights underflow)
    var_w = F.coalesce(C.div("__s2", "__d") - mean * mean, F.lit(0.0))
    std = F.sqrt(F.when(var_w > 0, var_w).otherwise(F.lit(0.0)) + F.lit(noise * noise) / (F.lit(1.0) + dens))
    return agg.select(*columns, mean.alias("mean"), std.alias("std"), dens.alias("density"))


def predict_series(context: DataFrame, targets: DataFrame, lengthscale: float, noise: float = 1.0,
                   radius: float | None = None, x: str = "x1", y: str = "x2") -> DataFrame:
    """M3: one target location per date -> (task_time, mean, std) time series."""
    p = predict_grid(context, targets, lengthscale, noise, radius, ("task_time",), x, y)
    return p.select("task_time", "mean", "std")


def unnormalise_pred(pred: DataFrame, mean_param, std_param) -> DataFrame:
    """M4: back to physical units; the std is a scale (no offset)."""
    return pred.withColumns({
        "mean": C.mean_std_inverse("mean", mean_param, std_param, add_offset=True),
        "std": C.mean_std_inverse("std", mean_param, std_param, add_offset=False)})


def gap_fill(grid: DataFrame, var: str, lengthscale: float, noise: float = 1.0,
             radius: float | None = None, x: str = "lat", y: str = "lon",
             time_col: str = "time", mask: DataFrame | None = None, mask_col: str = "mask") -> DataFrame:
    """Fill missing values of each date from the non-missing cells of that date.

    With ``mask`` (lat_idx, lon_idx, mask) only gaps on water (mask 1) are filled; land stays missing.
    Returns every grid row, repeated ones too: rows with a value unchanged (``filled`` false), and
    rows without one carrying the kernel mean where the kernel had context
    (``filled`` true) and its std in ``fill_std``.  The result is a union of
    the untouched rows and the predicted rows, so the full grid is never
    re-joined or shuffled.
    """
    cid = (F.col("lat_idx") * F.lit(1 << 32) + F.col("lon_idx")).cast("bigint")
    ctx = grid.filter(F.col(var).isNotNull()).select(
        F.col(time_col).alias("task_time"), cid.alias("point_id"), x, y, F.col(var).alias("value"))
    gaps = grid.filter(F.col(var).isNull())
    land = None
    if mask is not None:
        water = mask.filter(F.col(mask_col) == 1).select("lat_idx", "lon_idx").distinct()
        land = gaps.join(water, ["lat_idx", "lon_idx"], "left_anti")
        gaps = gaps.join(water, ["lat_idx", "lon_idx"], "left_semi")
    tgt = gaps.withColumns({"task_time": F.col(time_col), "target_id": cid})
    # the context here is every observed cell: a large side, joined by shuffle
    pred = predict_grid(ctx, tgt, lengthscale, noise, radius, ("task_time",), x, y, small_context=False,
                        explode="targets")                         # the missing cells are the smaller side
    filled = pred.withColumns({var: F.col("mean"), "filled": F.col("mean").isNotNull(),
                               "fill_std": F.col("std")})
    kept = grid.filter(F.col(var).isNotNull())
    if land is not None:
        kept = kept.unionByName(land.select(*kept.columns))
    kept = kept.withColumns({"filled": F.lit(False), "fill_std": F.lit(None).cast("double")})
    cols = [*grid.columns, "filled", "fill_std"]
    return kept.select(*cols).unionByName(filled.select(*cols))
