"""Sinks and the climatology store.

Writes are plain DataFrame writers: partitioned Parquet for grids and
surfaces, dynamic partition overwrite so rewriting one year leaves the others,
JSON documents for small metadata rows.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


MAX_RECORDS_PER_FILE = 20_000_000


def write_grid(df: DataFrame, path: str, partition_by: Sequence[str] = ("year",), time_col: str = "time",
               mode: str = "overwrite", order: str = "time") -> str:
    """K1: write a grid partitioned by year (derived from ``time`` if absent).

    Dynamic partition overwrite replaces only the years present in ``df``.
    Rows are rebalanced on the partition columns (``REBALANCE`` hint): AQE
    splits every year into pieces of the advisory partition size, so each
    writer handles a bounded slice of a single year folder however large
    that year is.  Files are capped at ``MAX_RECORDS_PER_FILE`` rows and
    sorted, which keeps Parquet min/max statistics tight: ``order="time"``
    (maps of one day together; date filters prune) or ``order="space"``
    (each cell's series together; point and box filters prune).
    """
    out = df if "year" in df.columns else df.withColumn("year", F.year(time_col))
    keys = {"time": (time_col, "lat_idx", "lon_idx"), "space": ("lat_idx", "lon_idx", time_col)}[order]
    sort = [*partition_by, *[c for c in keys if c in out.columns]]
    (out.hint("rebalance", *partition_by).sortWithinPartitions(*sort).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy(*partition_by).parquet(path))
    return path


def write_points(df: DataFrame, path: str, partition_by: Sequence[str] = ("iteration",)) -> str:
    """K3: write points / masked predictions / acquisition surfaces as partitioned Parquet
    (rebalanced on the partition columns: advisory-size writers, one folder each)."""
    df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """K4: CSV with a header, as part files; any number of rows."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def _write_json_doc(spark: SparkSession, doc: dict, path: str) -> str:
    spark.createDataFrame([(json.dumps(doc, indent=4),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
    return path


def save_climatology(clim: DataFrame, source: DataFrame, base_dir: str, value_cols: Sequence[str],
                     time_col: str = "time") -> dict:
    """K2: write the climatology (Parquet) and its metadata (JSON) under one id.

    Metadata: id (uuid4), calculation_date, dataset_vars, dataset_dims (sizes
    of time/lat/lon from one aggregate over the source grid).
    """
    spark = clim.sparkSession
    cid = str(uuid.uuid4())
    cycle_path = f"{base_dir.rstrip('/')}/{cid}_seasonal_cycle.parquet"
    meta_path = f"{base_dir.rstrip('/')}/{cid}_metadata.json"
    clim.write.mode("overwrite").parquet(cycle_path)
    # sizes: dates from one narrow pass over the source, cells from the written climatology
    n_time = source.select(time_col).distinct().count()
    written = spark.read.parquet(cycle_path)
    n_lat = written.select("lat_idx").distinct().count()
    n_lon = written.select("lon_idx").distinct().count()
    meta = {"id": cid, "calculation_date": str(dt.datetime.now()), "dataset_vars": list(value_cols),
            "dataset_dims": {"time": int(n_time), "lat": int(n_lat), "lon": int(n_lon)}}
    _write_json_doc(spark, meta, meta_path)
    return {"seasonal_cycle_path": cycle_path, "metadata_path": meta_path, "id": cid}


META_SCHEMA = ("id string, calculation_date string, dataset_vars array<string>, "
               "dataset_dims map<string, bigint>")


def load_climatology(spark: SparkSession, cycle_path: str, metadata_path: str | None = None):
    """The saved climatology and (optionally) its one-row metadata frame."""
    clim = spark.read.parquet(cycle_path)
    meta = None
    if metadata_path:
        meta = spark.read.text(metadata_path, wholetext=True).select(
            F.from_json("value", META_SCHEMA).alias("m")).select("m.*")
    return clim, meta


def list_climatologies(spark: SparkSession, base_dir: str) -> DataFrame:
    """Metadata of every saved climatology (only ``*_metadata.json`` entries)."""
    return (spark.read.text(f"{base_dir.rstrip('/')}/*_metadata.json", wholetext=True)
            .select(F.from_json("value", META_SCHEMA).alias("m")).select("m.*"))


def write_manifest(spark: SparkSession, path: str, datasets: dict[str, dict], norm_path: str) -> DataFrame:
    """K5: the manifest document: when it was made, the normaliser's path and one entry per dataset.

    ``datasets`` maps a dataset's name to its written paths; an entry has the climatology's id and paths
    (null for a dataset without one) and, if given, the grid's path.
    """
    keys = {"seasonal_cycle_id": "id", "seasonal_cycle_path": "seasonal_cycle_path",
            "seasonal_cycle_metadata_path": "metadata_path", "grid_path": "grid"}
    doc = {"created": dt.datetime.now(dt.timezone.utc).isoformat(), "data_processor_path": norm_path,
           "datasets": {name: {k: d.get(v) for k, v in keys.items()} for name, d in datasets.items()}}
    _write_json_doc(spark, doc, path)
    return spark.read.text(path, wholetext=True)


MANIFEST = "created string, data_processor_path string, datasets map<string, map<string, string>>"


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest as rows: one per dataset."""
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", MANIFEST).alias("m"))
    return (doc.select("m.created", "m.data_processor_path", F.explode("m.datasets").alias("dataset", "d"))
            .select("dataset", "created", "data_processor_path", F.col("d")["seasonal_cycle_id"].alias("seasonal_cycle_id"),
                    F.col("d")["seasonal_cycle_path"].alias("seasonal_cycle_path"),
                    F.col("d")["seasonal_cycle_metadata_path"].alias("seasonal_cycle_metadata_path"),
                    F.col("d")["grid_path"].alias("grid_path")))


def write_run_log(log: DataFrame, path: str, run_id: str, summary_path: str | None = None) -> DataFrame:
    """K7: append per-batch losses to the run log table and return the run summary
    (epochs, final and best epoch loss) from one aggregate; the one-row summary
    is also written as JSON when ``summary_path`` is given."""
    log.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)
    stored = log.sparkSession.read.parquet(path).filter(F.col("run_id") == run_id)
    per_epoch = stored.groupBy("epoch").agg(F.avg("loss").alias("loss"))
    summary = per_epoch.agg(F.lit(run_id).alias("run_id"), F.count(F.lit(1)).alias("n_epochs"),
                            F.max_by("loss", "epoch").alias("final_loss"), F.min("loss").alias("best_loss"),
                            F.min_by("epoch", "loss").alias("best_epoch"))
    if summary_path:
        summary.coalesce(1).write.mode("overwrite").json(summary_path)   # one row
    return summary


def provenance(df: DataFrame, col: str, title: str, units: str, time_col: str = "time") -> DataFrame:
    """K8: attach title/units as column metadata and return a one-row summary
    (title, units, time range)."""
    tagged = df.withColumn(col, F.col(col).alias(col, metadata={"title": title, "units": units}))
    return tagged.agg(F.lit(title).alias("title"), F.lit(units).alias("units"),
                      F.min(time_col).alias("time_start"), F.max(time_col).alias("time_end"))
