"""User functions on the Python side.

Built-in expressions come first (``functions.columns``).  These wrappers are
for user-supplied code only: an element-wise function as an Arrow-batched
pandas UDF, and a per-task model call as ``applyInPandas``.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_elementwise(fn: Callable[[pd.Series], pd.Series], return_type: str) -> Callable[..., Column]:
    """V1: wrap a vectorised pandas function as a column function (Arrow batches)."""
    return F.pandas_udf(fn, return_type)


def score_partitions(df: DataFrame, by: str | list[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
                     schema: str) -> DataFrame:
    """V2: call a user model once per task (group), e.g. per task date.

    Each group is one task: for gridded data at most one row per cell and
    date, so its size is bounded by the grid, not by the table.
    """
    keys = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*keys).applyInPandas(fn, schema)


def ice_indicator_pandas(s: pd.Series) -> pd.Series:
    """Example element-wise function: the ice indicator written in pandas."""
    out = pd.Series(1, index=s.index, dtype="Int64")
    out[s > 0.2] = 0
    out[s.isna()] = pd.NA
    return out


def rmse_per_task(pdf: pd.DataFrame) -> pd.DataFrame:
    """Example per-task scorer: RMSE of mean vs truth for one task date."""
    err = (pdf["mean"] - pdf["truth"]).dropna()
    rmse = float((err ** 2).mean() ** 0.5) if len(err) else float("nan")
    return pd.DataFrame({"time": [pdf["time"].iloc[0]], "rmse": [rmse], "n": [len(err)]})


PRED_SCHEMA = "task_time date, point_id long, mean double, std double"


def predict_with_model(tasks: DataFrame, model_fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
                       context_set: int = 0, target_set: int = 0) -> DataFrame:
    """V2 for inference: call a user model once per task (task date).

    ``model_fn(context, targets)`` gets the task's context rows (x1, x2, value;
    missing values removed) and target rows (point_id, x1, x2) as pandas frames
    and returns one row per target with ``point_id, mean, std``.  Each call
    sees one task: for gridded targets at most one row per cell, so the group
    is bounded by the grid, not by the table.
    """
    def per_task(pdf: pd.DataFrame) -> pd.DataFrame:
        ctx = pdf[(pdf["role"] == "context") & (pdf["set_idx"] == context_set) & pdf["value"].notna()]
        tgt = pdf[(pdf["role"] == "target") & (pdf["set_idx"] == target_set)]
        out = model_fn(ctx[["x1", "x2", "value"]].reset_index(drop=True),
                       tgt[["point_id", "x1", "x2"]].reset_index(drop=True))
        out.insert(0, "task_time", pdf["task_time"].iloc[0])
        return out[["task_time", "point_id", "mean", "std"]]

    rows = tasks.filter(F.col("task_time").isNotNull()
                        & (((F.col("role") == "context") & (F.col("set_idx") == context_set))
                           | ((F.col("role") == "target") & (F.col("set_idx") == target_set))))
    return rows.groupBy("task_time").applyInPandas(per_task, PRED_SCHEMA)


def nearest_context_model(context: pd.DataFrame, targets: pd.DataFrame) -> pd.DataFrame:
    """Example user model: each target takes the value of its nearest context
    point (ties -> first context row in (x1, x2) order); std is that distance.

    It builds a (targets x context) distance matrix inside one task: context
    sets are small (tens to hundreds of points per date), so this stays
    bounded per call.
    """
    import numpy as np
    if context.empty:
        return pd.DataFrame({"point_id": targets["point_id"], "mean": np.nan, "std": np.nan})
    ctx = context.sort_values(["x1", "x2"], kind="mergesort").reset_index(drop=True)
    d2 = ((targets["x1"].to_numpy()[:, None] - ctx["x1"].to_numpy()[None, :]) ** 2
          + (targets["x2"].to_numpy()[:, None] - ctx["x2"].to_numpy()[None, :]) ** 2)
    k = d2.argmin(axis=1)
    return pd.DataFrame({"point_id": targets["point_id"].to_numpy(), "mean": ctx["value"].to_numpy()[k],
                         "std": np.sqrt(d2[np.arange(len(k)), k])})
