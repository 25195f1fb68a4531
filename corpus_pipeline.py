"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

1. ``toxicity``: documents scored 0.5 or more go.
2. ``line_dedup``: lines repeated in three or more documents stay only in the largest doc_id.
3. ``jaccard_join``: of documents that shingle similarity links, the smallest doc_id stays.
4. ``decontaminate``: documents that hold a benchmark item go.
5. ``packing``: what is left becomes token sequences of 1024.

Every stage but the last takes and returns the columns of ``documents``.  A
document whose lines were dropped gets the ``n_chars`` of its new text.  Null
texts and ids, empty texts, rows that share an id and further columns are
treated as the operators' docstrings say; documents without words are linked
with nothing and stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecube.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity
from lakecube.llm.base import read_table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is below one half (operator 5)."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model, score_col="__toxicity").filter(F.col("__toxicity") < 0.5).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without lines that three or more documents hold (operator 10)."""
    # The operator adds n_lines and n_dropped; columns of these names come through under others.
    mine = {c: f"__kept_{i}" for i, c in enumerate(docs.columns) if c.lower() in ("n_lines", "n_dropped")}
    out = line_dedup.dedup_lines(docs.withColumnsRenamed(mine))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(mine.get(c, c)).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, the smallest doc_id (operator 2); null ids stay."""
    found = jaccard_join.jaccard_components(docs)
    gone = written(found.filter(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == F.col("__gone"), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item (operator 8)."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents that are left, packed into sequences (operator 9)."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: The first stage is a trained network and the last a packing heuristic: SQL expresses neither.
ORACLE_SQL = None
