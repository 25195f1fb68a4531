"""Shared helpers: input tables, written intermediate tables, heavy-key joins."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table, scratch_path

__all__ = ["read_table", "new_path", "written", "lower_ascii", "strip_ascii", "skew_join", "hash128", "parts_for"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"          # [\x20\x09-\x0D]


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names."""
    return scratch_path(spark, f"llm-{tag}-{uuid.uuid4().hex}")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of re-running the plan.
    """
    path = new_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def strip_ascii(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def hash128(c: Column) -> list[Column]:
    """Two independent 64-bit hashes of a value, as two long columns."""
    return [F.xxhash64(c), F.xxhash64(F.lit("second"), c)]


def parts_for(spark: SparkSession, nbytes: int, each: int = 16 << 20) -> int:
    """Partitions of about ``each`` bytes, at least the session's shuffle width."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(nbytes) // each))


HEAVY_SHARE = 2000


def skew_join(rows: DataFrame, lookup: DataFrame, keys: list[str], count: str, total: int, share: int = HEAVY_SHARE) -> DataFrame:
    """Inner join of ``rows`` with ``lookup`` (one row per key) that no hot key can overload.

    ``count`` is a column of ``lookup``: how many of the ``total`` rows have the
    key.  Keys with more than ``total / share`` of them are fewer than
    ``share``, so their lookup rows are broadcast under a proven bound; every
    other key's rows are shuffled, and none of those has more than 1 / share.
    """
    floor = max(1, total // share) + 1
    heavy = lookup.filter(F.col(count) >= floor)
    light = lookup.filter(F.col(count) < floor)
    few = F.broadcast(heavy)
    return (rows.join(few, keys, "inner")
            .unionByName(rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(light, keys, "inner")))
