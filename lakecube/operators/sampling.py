"""Seeded, partition-independent sampling of cells and rows.

Randomness comes from ``md5(seed|key)``: the same seed gives the same rows
for any number of partitions or executors, and the SQL oracle can reproduce it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .clean import CELL

# Hash-prefix buckets used to rank cells without a global single-task sort.
_BUCKET_HEX = 3  # 16**3 = 4096 buckets


def seeded_hash(seed: int, *cols: Column | str) -> Column:
    """md5 hex of ``seed|c1|c2...`` (all parts as text)."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hash_int(seed: int, *cols: Column | str) -> Column:
    """A 48-bit non-negative integer from the seeded md5."""
    return F.conv(F.substring(seeded_hash(seed, *cols), 1, 12), 16, 10).cast("bigint")


def cell_order(cells: DataFrame, seed: int, keys: Sequence[str] = CELL) -> DataFrame:
    """Dense rank ``pos`` (0..M-1) of ``cells`` in seeded hash order.

    Cells are split into 4096 buckets by hash prefix; bucket sizes (a table of
    at most 4096 rows) give each bucket's offset, and the rank inside a bucket
    is a window partitioned by bucket.  No task ever sees more than one bucket.
    """
    h = seeded_hash(seed, *keys)
    keyed = cells.withColumns({"__h": h, "__bk": F.substring(h, 1, _BUCKET_HEX)})
    sizes = keyed.groupBy("__bk").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.withColumn(
        "__off", F.sum("__n").over(Window.orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = F.broadcast(offsets.select("__bk", F.coalesce("__off", F.lit(0)).alias("__off")))  # <= 4096 rows
    rn = F.row_number().over(Window.partitionBy("__bk").orderBy("__h", *keys)) - 1
    return (keyed.withColumn("__rn", rn).join(offsets, "__bk")
            .withColumn("pos", (F.col("__off") + F.col("__rn")).cast("bigint"))
            .drop("__h", "__bk", "__rn", "__off"))


def water_cells(mask: DataFrame, mask_col: str = "mask") -> DataFrame:
    return mask.filter(F.col(mask_col) == 1).select(*CELL, "lat", "lon")


def _population(df: DataFrame, n: int) -> int:
    m = df.count()
    if n > m:
        raise ValueError(f"Cannot take a larger sample than population: {n} > {m}")
    return m


def random_points(mask: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` distinct water cells (mask = 1) in seeded random order.

    Raises ``ValueError`` when fewer than ``n`` cells are water (sampling is
    without replacement).  ``point_id`` is the draw order 0..n-1.
    """
    water = water_cells(mask)
    _population(water, n)
    return (cell_order(water, seed).filter(F.col("pos") < n)
            .select(F.col("pos").alias("point_id"), *CELL, "lat", "lon"))


SHUFFLE_STEPS = 16


def random_points_per_date(dates: DataFrame, mask: DataFrame, n: int, seed: int = 42,
                           time_col: str = "time") -> DataFrame:
    """A fresh set of ``n`` distinct water cells for every date.

    Cells are ranked once in seeded hash order.  Every date has a permutation
    of its own of the ranks 0..M-1, and takes what it maps 0..n-1 to.  The
    permutation is a swap-or-not shuffle: in each of SHUFFLE_STEPS steps a rank
    x pairs with (K - x) mod M, K drawn per date and step, and a seeded bit of the pair
    says whether the two swap.  Each set is computed from its date alone, so the
    work is O(dates x n + cells): the (date x cell) product is never formed.
    """
    water = water_cells(mask)
    m = _population(water, n)
    if n <= 0:
        return dates.select(time_col, F.lit(0).cast("bigint").alias("point_id"),
                            *[F.lit(None).cast(water.schema[c].dataType).alias(c)
                              for c in (*CELL, "lat", "lon")]).limit(0)
    ordered = broadcast_if_small(cell_order(water, seed))

    def step(x, k):
        y = (hash_int(seed, F.col(time_col), k) % F.lit(m) - x + F.lit(m)) % F.lit(m)
        return F.when(hash_int(seed, F.col(time_col), k, F.greatest(x, y)) % 2 == 0, y).otherwise(x)

    picks = (dates.select(time_col).distinct()
             .select(time_col, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("point_id"))
             .withColumn("pos", F.aggregate(F.sequence(F.lit(0), F.lit(SHUFFLE_STEPS - 1)), F.col("point_id").cast("bigint"), step)))
    return (picks.join(ordered, "pos")
            .select(time_col, F.col("point_id").cast("bigint").alias("point_id"), *CELL, "lat", "lon"))


def fixed_points(dates: DataFrame, points: DataFrame, time_col: str = "time") -> DataFrame:
    """The same point set on every date.

    The task-date list (one scalar subquery, bounded by the number of days in
    the record) is exploded into each point row, so the output is exactly
    dates x points for any point ids, with no join at all.
    """
    day_list = dates.select(F.sort_array(F.collect_set(time_col))).scalar()
    return points.select(F.explode(day_list).alias(time_col), *points.columns)


def sample_n_rows(df: DataFrame, n: int, seed: int = 42, by: str = "time",
                  keys: Sequence[str] = CELL, value_col: str | None = None) -> DataFrame:
    """Up to ``n`` rows per ``by`` group (non-missing ``value_col`` only), chosen
    by seeded hash order.  The ``row_number() <= n`` filter plans a partial
    group limit before the shuffle, so a large group is cut down map-side."""
    src = df.filter(F.col(value_col).isNotNull()) if value_col else df
    w = Window.partitionBy(by).orderBy(seeded_hash(seed, by, *keys), *keys)
    return src.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def sample_rows(df: DataFrame, n: int, seed: int = 42, key: str = "obs") -> DataFrame:
    """Exactly ``n`` rows (all, if fewer) with the smallest seeded hash of ``key``.

    Exact and distributed: rows are bucketed by hash prefix, bucket sizes (at
    most 4096 numbers) locate the bucket where the n-th row falls, and every earlier
    bucket is kept by a plain filter.  The cut bucket is split the same way, so
    only one part in 16 million of the rows is ranked.
    """
    h = seeded_hash(seed, key)
    keyed = df.withColumn("__h", h)
    left, kept = n, []
    rest = keyed
    for depth in (_BUCKET_HEX, 2 * _BUCKET_HEX):        # the cut bucket of the first level is split once more
        bucket = F.substring("__h", 1, depth)
        sizes = {r[0]: r[1] for r in rest.groupBy(bucket.alias("b")).agg(F.count(F.lit(1))).collect()}  # <= 4096 rows
        cut = None
        for b in sorted(sizes):
            if sizes[b] > left:
                cut = b
                break
            left -= sizes[b]
        whole = rest if cut is None else rest.filter(bucket < cut)
        kept.append(whole)
        if cut is None:
            rest = None
            break
        rest = rest.filter(bucket == cut)
    if rest is not None and left > 0:
        w = Window.partitionBy(F.substring("__h", 1, 2 * _BUCKET_HEX)).orderBy("__h", key)
        kept.append(rest.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= left).drop("__rn"))
    out = kept[0]
    for k in kept[1:]:
        out = out.unionByName(k)
    return out.drop("__h")
