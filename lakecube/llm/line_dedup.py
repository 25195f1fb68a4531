"""Line dedup (operator 10): levelled sorted runs of line hashes.  DataFrame operations only.

A run is a bucketed, sorted table ``(h1, h2, n_docs, top_doc)``: for a set of
documents, how many hold a line key and the largest doc_id among them.  Batches
of documents arrive in descending doc_id order.  Each batch's keys are
merge-anti-joined with the keys that the runs have already settled (found in
``min_docs`` documents: their largest holder and their fate are known), and
what is left is added as the batch's own run.  When ``fanout`` runs of a level
have gathered, they are merged into one run of the next level, so a key is
rewritten once per level and a batch joins O(log batches) runs.  All runs share
one bucketing on the hash, so joining and merging them shuffles nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import hash128, lower_ascii, new_path, strip_ascii, written

MIN_CHARS = 20      # code points of a key that takes part
MIN_DOCS = 3        # documents that must hold it
BATCHES = 4
FANOUT = 2


def line_key(line: Column) -> Column:
    return lower_ascii(strip_ascii(line))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def document_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, h1, h2) of each line long enough, once per row of ``docs``."""
    key = F.explode(F.array_distinct(F.transform(_lines(F.col(text_col)), line_key))).alias("key")
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), key)
    h1, h2 = hash128(F.col("key"))
    return rows.filter(F.length("key") >= min_chars).select("doc", h1.alias("h1"), h2.alias("h2"))


@dataclass
class LineRuns:
    """The levelled runs.  ``add`` takes batches in descending doc_id order."""

    spark: SparkSession
    min_docs: int = MIN_DOCS
    fanout: int = FANOUT
    buckets: int = 0
    levels: list[list[DataFrame]] = field(default_factory=list)
    names: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _run(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
         .option("path", new_path(self.spark, name)).saveAsTable(name))
        self.names.append(name)
        return self.spark.table(name)

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        """Merge sorted runs key by key.  All have one bucketing, so the merge join moves nothing."""
        out = runs[0]
        for other in runs[1:]:
            r = other.select("h1", "h2", F.col("n_docs").alias("__n"), F.col("top_doc").alias("__top"))
            out = out.join(r, ["h1", "h2"], "full").select(
                "h1", "h2", (F.coalesce("n_docs", F.lit(0)) + F.coalesce("__n", F.lit(0))).alias("n_docs"),
                F.greatest("top_doc", "__top").alias("top_doc"))
        return out

    def all_runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def add(self, keys: DataFrame) -> None:
        """Add a batch of (doc, h1, h2).  Documents of later batches have smaller ids."""
        fresh = keys.groupBy("h1", "h2").agg(F.countDistinct("doc").alias("n_docs"), F.max("doc").alias("top_doc"))
        for run in self.all_runs():
            fresh = fresh.join(run.filter(F.col("n_docs") >= self.min_docs), ["h1", "h2"], "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._run(fresh))
        for k in range(len(self.levels)):
            if len(self.levels[k]) >= self.fanout:
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(self._run(self._merged(self.levels[k])))
                self.levels[k] = []

    def index(self) -> DataFrame:
        """(h1, h2, n_docs, top_doc) over all runs.  n_docs is exact up to min_docs and a
        lower bound beyond it: settled keys are not counted on."""
        runs = self.all_runs()
        return runs[0] if len(runs) == 1 else self._merged(runs)

    def close(self) -> None:
        """Take the runs' names out of the session catalog."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def batch_bounds(docs: DataFrame, id_col: str, batches: int) -> list[int]:
    """Ids that cut the documents into about equal batches; any cuts give the same result."""
    cuts = [k / batches for k in range(1, batches)]
    got = docs.agg(F.percentile_approx(F.col(id_col), cuts, 1000)).first()[0] if cuts else []
    return sorted(set(got or []))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """Drop repeated lines; returns the rows of ``docs`` with the text changed, ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of ASCII blanks and lower-cased in A-Z.
    Keys of at least ``min_chars`` code points that at least ``min_docs``
    different doc_ids hold lose all their lines except in the largest doc_id.

    Defined cases: a null or empty text is one empty line (a null stays null);
    rows that share a doc_id are one document for counting, and each row is
    filtered by itself; rows with a null doc_id neither count nor lose lines; an
    empty table gives an empty table; further columns pass through, except that
    columns named ``n_lines`` or ``n_dropped`` are replaced.
    """
    spark = docs.sparkSession
    runs = LineRuns(spark, min_docs)
    cuts = batch_bounds(docs, id_col, batches)
    edges = [None, *cuts, None]
    for low, high in reversed(list(zip(edges, edges[1:]))):
        part = docs
        if low is not None:
            part = part.filter(F.col(id_col) > low)
        if high is not None:
            part = part.filter(F.col(id_col) <= high)
        runs.add(document_keys(part, id_col, text_col, min_chars))

    repeated = written(runs.index().filter(F.col("n_docs") >= min_docs).drop("n_docs"), "lines")
    runs.close()
    # Both sides shuffle on the hash, so adaptive execution can split a key that holds much of the rows.
    rows = document_keys(docs, id_col, text_col, min_chars)
    hits = rows.join(repeated, ["h1", "h2"]).filter(F.col("doc") < F.col("top_doc"))
    drops = hits.groupBy("doc").agg(F.collect_set(F.struct("h1", "h2")).alias("__ld_drops"))

    lines = _lines(F.col(text_col))
    drops = drops.withColumnRenamed("doc", "__ld_doc")
    joined = docs.join(drops, docs[id_col] == F.col("__ld_doc"), "left").drop("__ld_doc")

    def stays(line):
        key = line_key(line)
        h1, h2 = hash128(key)
        return (F.length(key) < min_chars) | ~F.array_contains(F.col("__ld_drops"), F.struct(h1.alias("h1"), h2.alias("h2")))

    kept = F.when(F.col("__ld_drops").isNull(), lines).otherwise(F.filter(lines, stays))
    out = joined.withColumn("__ld_kept", kept)
    out = out.withColumn("n_lines", F.size(lines).cast("long"))
    out = out.withColumn("n_dropped", F.col("n_lines") - F.size("__ld_kept"))
    out = out.withColumn(text_col, F.when(F.col("n_dropped") > 0, F.array_join("__ld_kept", "\n")).otherwise(F.col(text_col)))
    return out.drop("__ld_kept", "__ld_drops")
