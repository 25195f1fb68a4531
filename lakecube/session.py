"""Session helpers: local/test session, checkpoint folder, size-checked broadcast."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of a written side table (compressed files) up to which it is broadcast.  Static grids (mask,
# bathymetry, axis tables, point maps) sit far below; anything larger takes a
# shuffled join chosen by Catalyst/AQE.
BROADCAST_MAX_BYTES = 32 << 20


# Session defaults for large inputs.  Each is applied only when the deployment
# (spark-defaults, spark-submit --conf, builder) did not set the key itself.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # shuffle partitions are sized by AQE towards this many bytes each
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # parquet splits: one task reads at most this much of a file
    "spark.sql.files.maxPartitionBytes": "256MB",
    # static broadcast threshold (Catalyst statistics: file sizes of written tables)
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "lakecube",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    On a cluster the deployment owns master, memory and any key it sets;
    ``SCALE_DEFAULTS`` only fill keys it left unset.  ``shuffle_partitions``
    is for local runs (tests, bench).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    spark = builder.getOrCreate()
    conf = spark.sparkContext.getConf()
    for key, value in SCALE_DEFAULTS.items():
        if not conf.contains(key):
            spark.conf.set(key, value)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  When it is unset, local mode (tests, a
    laptop) gets a fresh scratch folder; any other master raises, since a
    folder of one machine is not shared.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="lakecube-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Write ``df`` once and broadcast it only if its files have at most ``max_bytes``.

    The size is that of the written table, so it is known and not estimated, and
    the plan behind ``df`` runs once.  Above the bound the table is returned
    unhinted and the join shuffles (AQE may still convert it from real shuffle sizes).
    """
    table = materialize_small(df, "side")
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(table) if size <= max_bytes else table


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")   # works for URIs as well


def materialize_small(df: DataFrame, tag: str = "small") -> DataFrame:
    """Write a derived table once as Parquet under the shared checkpoint folder
    and read it back.

    Later scalar subqueries, size checks and joins read the written files
    instead of re-running the plan over the big table it came from; the
    lineage is cut (survives executor loss), and the file size gives Catalyst
    real statistics for its own broadcast threshold.
    """
    import uuid
    path = scratch_path(df.sparkSession, f"{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
