"""Score/predict workflow.

fit mean/std on the training dates (A4) -> normalise (F12) -> per-date random
context cells (X2) with their values (J7) -> targets = every water cell of the
grid on the task dates that exist (J8) -> kernel prediction (M2) -> back to
physical units (M4) -> prediction vs truth (J10) -> pooled RMSE (A10) and
mask-weighted scores (A11) -> masked prediction (J2) for writing (K3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import grid as G
from ..operators import kernel as K
from ..operators import normalize as N
from ..operators import sampling as S
from ..operators import scoring as SC
from ..operators.clean import CELL
from ..operators.quality import available_dates
from ..operators.tasks import cell_id
from ..session import materialize_small


def evaluate(grid: DataFrame, mask: DataFrame, dates: DataFrame, train: tuple[str, str], n_context: int,
             lengthscale: float, noise: float = 1.0, var: str = "sst", seed: int = 42,
             radius: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns (scores: one row of pooled and weighted scores, masked prediction rows)."""
    cp = N.fit_coord_map(mask)
    params = materialize_small(
        N.fit_mean_std(grid.filter(F.col("time").between(F.lit(train[0]).cast("date"),
                                                         F.lit(train[1]).cast("date"))), [var]), "norm")
    used = available_dates(dates.select("time").distinct(), grid)
    g = N.apply_mean_std(grid.join(used, "time", "left_semi"), params, [var])
    pts = S.random_points_per_date(used, mask, n_context, seed)
    ctx = (N.apply_coord_map(pts.join(g.select("time", *CELL, var), ["time", *CELL]), cp)
           .select(F.col("time").alias("task_time"), cell_id().alias("point_id"), "x1", "x2",
                   F.col(var).alias("value")))
    water = mask.filter(F.col("mask") == 1).select(*CELL)
    tgt = (N.apply_coord_map(g.join(water, list(CELL), "left_semi"), cp)
           .select(F.col("time").alias("task_time"), cell_id().alias("target_id"), *CELL, "x1", "x2"))
    pred = K.predict_grid(ctx, tgt, lengthscale, noise, radius)
    p = params.filter(F.col("var") == var).select(F.struct("mean", "std")).scalar()
    phys = K.unnormalise_pred(pred, p.getField("mean"), p.getField("std"))
    phys = phys.select(F.col("task_time").alias("time"), *CELL, "mean", "std")
    scored = SC.pred_vs_truth(phys, grid, var)
    pooled = SC.pooled_rmse(scored)
    weighted = SC.weighted_scores(scored, mask)
    scores = pooled.select(F.col("rmse").alias("pooled_rmse"), F.col("n").alias("n_scored"),
                           weighted.select(F.struct("rmse", "mean_std", "nll")).scalar().alias("w")) \
        .select("pooled_rmse", "n_scored", F.col("w.rmse").alias("weighted_rmse"),
                F.col("w.mean_std").alias("mean_std"), F.col("w.nll").alias("nll"))
    return scores, G.apply_mask(phys, mask)
