"""Array chunks to tidy rows.

An array store is held as a chunk table, one row per chunk::

    var STRING, year INT, t0 INT, i0 INT, j0 INT, shape ARRAY<INT>, payload ARRAY<FLOAT>

(``shape`` of rank 1, 2 or 3; row-major payload).  Flattening is a
``posexplode`` plus integer arithmetic on the position, so every chunk is
expanded inside the task that reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small


def flatten_chunks(chunks: DataFrame, keep=()) -> DataFrame:
    """Chunk rows -> (var, t_idx, lat_idx, lon_idx, value) by rank of ``shape``.

    Rank 3 -> (time, lat, lon); rank 2 -> (lat, lon); rank 1 -> (time); other
    ranks are skipped.  Missing origins count as 0.
    """
    rank = F.size("shape")
    ex = chunks.filter(rank.between(1, 3)).select(
        *keep, "var", F.coalesce("t0", F.lit(0)).alias("t0"), F.coalesce("i0", F.lit(0)).alias("i0"),
        F.coalesce("j0", F.lit(0)).alias("j0"), "shape", F.posexplode("payload").alias("pos", "value"))
    r = F.size("shape")
    s0, s1, s2 = F.col("shape")[0], F.col("shape")[1], F.col("shape")[2]
    pos = F.col("pos")
    t = (F.when(r == 3, F.floor(pos / (s1 * s2))).when(r == 1, pos))
    i = (F.when(r == 3, F.floor(pos / s2) % s1).when(r == 2, F.floor(pos / s1)))
    j = (F.when(r == 3, pos % s2).when(r == 2, pos % s1))
    return ex.select(*keep, "var",
                     (F.col("t0") + t).cast("bigint").alias("t_idx"),
                     (F.col("i0") + i).cast("bigint").alias("lat_idx"),
                     (F.col("j0") + j).cast("bigint").alias("lon_idx"),
                     F.col("value").cast("double").alias("value"))


def positional_time(df: DataFrame, year_col: str = "year", idx_col: str = "t_idx") -> DataFrame:
    """Daily dates by position from 1 January of the chunk's year.

    Only for stores without a stored time axis: a missing day shifts every
    later date of that year, so a stored ``time`` column should be preferred.
    """
    return df.withColumn("time", F.date_add(F.make_date(F.col(year_col), F.lit(1), F.lit(1)),
                                            F.col(idx_col).cast("int")))


def attach_coords(df: DataFrame, lat_axis: DataFrame, lon_axis: DataFrame) -> DataFrame:
    """Label columns ``lat``/``lon`` for integer indices via the axis tables
    (one row per grid line, size-checked and broadcast)."""
    return (df.join(broadcast_if_small(lat_axis.select("lat_idx", "lat")), "lat_idx", "left")
            .join(broadcast_if_small(lon_axis.select("lon_idx", "lon")), "lon_idx", "left"))


def labelled_grid(flat: DataFrame, names) -> DataFrame:
    """Flattened rows of a store with ``lat`` and ``lon`` axis arrays -> one labelled grid.

    ``names`` are the store's variables.  Every other variable becomes a column
    of (year,) time, lat_idx, lon_idx, lat, lon; an axis that several chunks repeat counts once.
    """
    def axis(name):
        return (flat.filter(F.col("var") == name).groupBy(F.col("t_idx").alias(f"{name}_idx"))
                .agg(F.first("value").alias(name)))

    variables = sorted(set(names) - {"lat", "lon", "time"})
    cube = flat.filter(F.col("var").isin(variables) & F.col("lat_idx").isNotNull())
    keys = [c for c in flat.columns if c not in ("var", "value", "t_idx")]
    if len(variables) == 1:
        wide = cube.select(*keys, F.col("value").alias(variables[0]))
    else:
        wide = cube.groupBy(*keys).agg(*[F.max(F.when(F.col("var") == v, F.col("value"))).alias(v) for v in variables])
    out = attach_coords(wide, axis("lat"), axis("lon"))
    return out.select(*keys, "lat", "lon", *variables)
