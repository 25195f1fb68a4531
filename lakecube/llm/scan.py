"""Globally sorted tables in numbered parts, for running sums and neighbours that no single task can hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from pyspark.sql import functions as F

from .base import written

PART_ROWS = 1 << 19


def ranged(df: DataFrame, keys: list[Column | str], tag: str, rows: int | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """``df`` range-sorted on ``keys`` and written, with the column ``part``.

    Parts ascend with the keys and hold about ``part_rows`` rows each, however many rows one
    leading key has: rows of one ``conv_id`` may lie in several parts.  ``df`` should be a written table (its keys
    are sampled first).
    """
    if rows is None:
        rows = df.count()
    parts = max(1, -(-rows // part_rows))
    out = df.repartitionByRange(parts, *keys) if parts > 1 else df.coalesce(1)
    return written(out.withColumn("part", F.spark_partition_id()), tag)


def next_in_order(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The ``keys`` of the following row of a ``ranged`` table as the struct ``name`` (null at the end).

    Within a part it is a window; a part's last row takes the first row of the next part that has rows.
    """
    from pyspark.sql import Window
    here = F.struct(*keys)
    inside = F.lead(here).over(Window.partitionBy("part").orderBy(*keys))
    firsts = df.groupBy("part").agg(F.min(here).alias("__first"))
    # one row per part
    firsts = firsts.select("part", F.lead("__first").over(Window.partitionBy(F.lit(0)).orderBy("part")).alias("__after"))
    firsts = written(firsts, "firsts")
    return (df.withColumn(name, inside).join(F.broadcast(firsts), "part", "left")
            .withColumn(name, F.coalesce(name, "__after")).drop("__after"))
