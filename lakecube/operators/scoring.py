"""Scores of predictions against truth."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import broadcast_if_small
from .clean import CELL


def pred_vs_truth(pred: DataFrame, truth: DataFrame, truth_col: str = "sst",
                  keys: Sequence[str] = ("time", *CELL)) -> DataFrame:
    """Prediction and truth aligned on date and cell (inner equi-join)."""
    t = truth.select(*keys, F.col(truth_col).alias("truth"))
    return pred.join(t, list(keys))


def pointwise(scored: DataFrame) -> DataFrame:
    """Error, squared and absolute error, floored std, Gaussian NLL, band."""
    lo, hi = C.band("mean", "std")
    return scored.withColumns({
        "error": C.error("mean", "truth"),
        "sq_error": C.error("mean", "truth") * C.error("mean", "truth"),
        "abs_error": F.abs(C.error("mean", "truth")),
        "std_safe": C.std_floor("std"),
        "nll": C.gaussian_nll("truth", "mean", "std"),
        "lower": lo, "upper": hi})


def pooled_rmse(scored: DataFrame) -> DataFrame:
    """A10: sqrt of the mean squared error over every task and cell (one row)."""
    e = C.error("mean", "truth")
    return scored.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.count(e).alias("n"))


def pool_errors(parts: Sequence[DataFrame]) -> DataFrame:
    """Errors of several task frames in one table, then A10."""
    return pooled_rmse(reduce(DataFrame.unionByName, parts))


def weighted_mean(x, w):
    """sum(w*x) / sum(w over non-missing x)  (missing x do not count)."""
    return F.try_divide(F.sum(w * x), F.sum(F.when(x.isNotNull(), w)))


def weighted_scores(scored: DataFrame, mask: DataFrame, by: Sequence[str] = (),
                    mask_col: str = "mask") -> DataFrame:
    """Mask-weighted RMSE, mean std and NLL.

    Weights are mask / sum(mask) per cell; the static weight table is
    size-checked and broadcast.  ``by`` (e.g. an iteration column) groups.
    """
    total = mask.select(F.sum(mask_col)).scalar()
    wt = broadcast_if_small(mask.select(*CELL, F.try_divide(F.col(mask_col), total).alias("__w")))
    j = scored.join(wt, list(CELL))
    w = F.col("__w")
    e = C.error("mean", "truth")
    return j.groupBy(*by).agg(
        F.sqrt(weighted_mean(e * e, w)).alias("rmse"),
        weighted_mean(F.col("std"), w).alias("mean_std"),
        weighted_mean(C.gaussian_nll("truth", "mean", "std"), w).alias("nll"))


def epoch_loss(log: DataFrame) -> DataFrame:
    """Mean batch loss per epoch."""
    return log.groupBy("epoch").agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("n_batches"))


def best_checkpoint(curve: DataFrame, metric: str = "val_rmse", order: str = "epoch") -> DataFrame:
    """Epochs whose metric beats every earlier epoch (the first always counts).

    The window runs over the epoch curve (one row per epoch), not over batches.
    """
    prev_best = F.min(metric).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return (curve.withColumn("__best", prev_best)
            .filter(F.col("__best").isNull() | (F.col(metric) < F.col("__best"))).drop("__best"))
