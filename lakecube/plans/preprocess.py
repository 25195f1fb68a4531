"""The preprocessing job.

day dates (F1) -> monthly moments, whose means are the climatology (A1, saved with metadata: K2)
and whose pooled variance is the anomalies' normaliser (A4) -> anomalies (J1) named ``<var>_anom`` (P2) -> z-score (F12) -> partitioned write (K1) -> normaliser config (K6) and a
manifest (K5).  Returns the normalised anomaly grid and the written paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import columns as C
from ..operators import climatology as clim
from ..operators import normalize as N
from ..operators.clean import rename_vars
from ..session import materialize_small, scratch_path
from ..sinks import writers as W


def preprocess(grid: DataFrame, var: str = "sst", out_dir: str | None = None,
               min_max: dict[str, DataFrame] | None = None) -> tuple[DataFrame, dict]:
    """Run the job; with ``out_dir`` every intermediate is written and reused.

    The cube is scanned twice: for the moments, and for the anomalies that are written.  The written moments feed the
    anomaly join (file statistics let Catalyst broadcast them when small) and the saved normaliser feeds the z-score.

    ``min_max`` names further variables with their grids (ice concentration):
    they are scaled to 0..1 instead, share the normaliser file and get a grid
    (``paths["grids"]``) and a manifest entry of their own.
    """
    spark = grid.sparkSession
    g = grid.withColumn("time", C.standardize_dates("time")).select("time", "lat_idx", "lon_idx", var)
    moments = clim.monthly_moments(g, [var])
    paths: dict = {}
    if out_dir is not None:
        base = out_dir.rstrip("/")
        moments = materialize_small(moments, "moments")             # the first of two scans of the cube
    c = moments.select("month", "lat_idx", "lon_idx", var)
    anom = rename_vars(clim.anomalies(g, c, [var]), {var: f"{var}_anom"})
    min_max = min_max or {}
    params = clim.pooled_anomaly_params(moments, [var])
    for name, other in min_max.items():
        params = params.unionByName(N.fit_min_max(other, [name]))
    if out_dir is not None:
        N.save_norm_params(params, f"{base}/data_processor")
        params, _ = N.load_norm_params(spark, f"{base}/data_processor")
    norm = N.apply_mean_std(anom, params, [f"{var}_anom"])
    if out_dir is not None:
        W.write_grid(norm, f"{base}/{var}_anom_norm")               # the second
        norm = spark.read.parquet(f"{base}/{var}_anom_norm").drop("year")
        # the dates are counted in the written grid, one narrow column of it
        paths.update(W.save_climatology(c, norm, f"{base}/seasonal_cycles", [var]))
        paths.update({"grid": f"{base}/{var}_anom_norm", "data_processor": f"{base}/data_processor",
                      "manifest": f"{base}/manifest"})
        entries = {var: dict(paths)}
        for name, other in min_max.items():
            path = f"{base}/{name}_norm"
            W.write_grid(N.apply_min_max(other, params, [name]), path)
            entries[name] = {"grid": path}
        paths["grids"] = {name: e["grid"] for name, e in entries.items()}
        W.write_manifest(spark, f"{base}/manifest", entries, f"{base}/data_processor")
    return norm, paths


def default_out_dir(spark) -> str:
    import uuid
    return scratch_path(spark, f"preprocess-{uuid.uuid4().hex}")

