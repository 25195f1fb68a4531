"""Benchmark decontamination (operator 8): size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle set (powers of two).  An
item's sketch is the bottom of its MinHash order: the ``s`` shingles of smallest
hash, ``s`` being fixed per size class so that a document holding the asked
share of any item of the class must hold a sketch shingle.  So the search
misses nothing, however long the document.  Every document's shingles (whole
texts) probe the sketches; for pairs that meet, the item's full shingle set is
counted in the document exactly.

Items go out in blocks of about ``BLOCK_SHINGLES`` shingles, each small enough
to broadcast; further blocks mean further passes, not fewer items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .base import written

WORDS = 5
NUM, DEN = 3, 4                   # share of an item's shingles found in a document
BLOCK_SHINGLES = 1 << 19
VERIFY = 1 << 12                  # pairs verified together


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = W.text_buffer(batch.column(1))
        for a, b in W.slices(offsets):
            d, h, _ = W.distinct_shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], k)
            edges = np.searchsorted(d, np.arange(b - a + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a),
                 pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(h.view(np.int64)))], names=["item", "shingles"])


def sketch_size(n: np.ndarray) -> np.ndarray:
    """Sketch shingles of an item of n shingles: what the largest item of its size class needs."""
    top = (1 << (size_class(n) + 1)) - 1
    return np.minimum(top - -(-NUM * top // DEN) + 1, n)


def size_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)


class SketchIndex:
    """The sketches of one size class's items, sorted for probing.  Other shingles are not in it."""

    def __init__(self, items: np.ndarray, sketches: list[np.ndarray], least: int):
        self.least = least                                          # shingles of the class's smallest item
        h = np.concatenate(sketches)
        order = np.argsort(h, kind="stable")
        self.owner = np.repeat(items, [len(s) for s in sketches])[order]
        self.hash, self.first = np.unique(h[order], return_index=True)
        self.last = np.append(self.first[1:], len(h))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.hash & np.uint64(0xFFFFF)).astype(np.int64)] = True

    @classmethod
    def of(cls, state: dict) -> SketchIndex:
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def probe(self, d: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        some = self.maybe[(h & np.uint64(0xFFFFF)).astype(np.int64)]
        d, h = d[some], h[some]
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        some = (self.hash[at] == h) & (DEN * n[d] >= NUM * self.least) if len(d) else np.zeros(0, bool)
        d, at = d[some], at[some]
        reps = self.last[at] - self.first[at]
        flat = np.repeat(self.first[at] - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())
        width = int(self.owner.max()) + 1
        return np.divmod(np.unique(np.repeat(d, reps).astype(np.int64) * width + self.owner[flat]), width)


class Block:
    """Items' shingles: sketches to find pairs with, whole sets to verify them."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)          # the full sets, to verify with
        self.edges = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.size)])
        sketches = [s[np.argsort(W.mix(s))[:k]] for s, k in zip(sets, sketch_size(self.size))]
        self.classes = []
        for c in np.unique(size_class(self.size)):
            items = np.flatnonzero(size_class(self.size) == c)
            self.classes.append(SketchIndex(items, [sketches[i] for i in items], int(self.size[items].min())).__dict__)

    def candidates(self, d: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, item) that share a sketch shingle, class by class; ``n``: shingles per document.

        A document with fewer shingles than NUM / DEN of a class's smallest item is not probed against that class.
        """
        found = [SketchIndex.of(c).probe(d, h, n) for c in self.classes]
        return tuple(np.concatenate([f[j] for f in found]) if found else np.zeros(0, np.int64) for j in range(2))

    def search(self, d: np.ndarray, h: np.ndarray):
        """(document, item, shared) for documents that hold enough of an item; (d, h) are distinct."""
        n = np.bincount(d) if len(d) else np.zeros(0, np.int64)
        doc, item = self.candidates(d, h, n)
        shared = np.zeros(len(doc), np.int64)
        edges = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
        for lo in range(0, len(doc), VERIFY):                       # whole sets of the pairs that met
            some = slice(lo, lo + VERIFY)
            reps = self.size[item[some]]
            pair = np.repeat(np.arange(len(reps)), reps)
            wanted = self.flat[np.repeat(self.edges[item[some]] - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())]
            left, right = edges[doc[some]][pair], edges[doc[some] + 1][pair]
            while True:                                             # bisection within each document's sorted shingles
                open_ = left < right
                if not open_.any():
                    break
                mid = (left + right) >> 1
                less = open_ & (h[np.minimum(mid, len(h) - 1)] < wanted)
                left, right = np.where(less, mid + 1, left), np.where(open_ & ~less, mid, right)
            inside = left < edges[doc[some] + 1][pair]
            hit = inside & (h[np.minimum(left, len(h) - 1)] == wanted)
            shared[some] = np.bincount(pair[hit], minlength=len(reps))
        enough = DEN * shared >= NUM * self.size[item]
        return doc[enough], item[enough], shared[enough]


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = WORDS):
    """Items with equal shingle sets as one class; yields (class keys, Block) and gives the classes' members."""
    kind = items.schema[id_col].dataType
    schema = T.StructType([T.StructField("item", kind), T.StructField("shingles", T.ArrayType(T.LongType()))])
    sets = (items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text")).filter("item is not null")
            .groupBy("item").agg(F.max("text").alias("text"))
            .mapInArrow(lambda it: _sets(it, k), schema).filter(F.size("shingles") > 0))
    sets = written(sets.withColumn("class", F.xxhash64("shingles")), "items")
    classes = sets.groupBy("class").agg(F.first("shingles").alias("shingles"))
    total = classes.agg(F.sum(F.size("shingles"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_SHINGLES))
    for i in range(n if total else 0):
        rows = classes.filter(F.pmod(F.col("class"), F.lit(n)) == i).toArrow()      # about BLOCK_SHINGLES numbers
        flat = rows.column("shingles").combine_chunks()
        edges = flat.offsets.to_numpy()
        h = flat.values.to_numpy().view(np.uint64)
        yield rows.column("class").to_numpy(), Block([h[a:b] for a, b in zip(edges, edges[1:])]), sets


def contaminated_pairs(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text: str = "text", k: int = WORDS) -> DataFrame:
    """(id, item, n_item, n_shared): documents that hold NUM / DEN or more of an item's distinct shingles.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; an item of fewer than ``k``
    words is one shingle, its whole sequence, and matches documents that are that sequence.

    Defined cases: null, empty and blank texts hold nothing and items without words match nothing;
    of items that share an id the largest text counts; rows of ``docs`` that share an
    id, or whose id is null, are searched each on their own; empty tables give
    no pairs; further columns are not looked at.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("class", T.LongType()),
                           T.StructField("n_item", T.LongType()), T.StructField("n_shared", T.LongType())])
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out, sets = None, None
    for keys, block, sets in item_blocks(items, item_col, item_text, k):
        sent = spark.sparkContext.broadcast((keys, block.__dict__))

        def search(batches, sent=sent):
            keys, state = sent.value
            block = Block.__new__(Block)
            block.__dict__.update(state)
            for batch in batches:
                data, offsets = W.text_buffer(batch.column(1))
                for a, b in W.slices(offsets):
                    d, h, _ = W.distinct_shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], k)
                    doc, item, shared = block.search(d, h)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(a + doc)), pa.array(keys[item], pa.int64()),
                         pa.array(block.size[item]), pa.array(shared.astype(np.int64))], names=["id", "class", "n_item", "n_shared"])

        found = plain.mapInArrow(lambda it, search=search: W.tidy(search(it)), schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        item_kind = items.schema[item_col].dataType
        return spark.createDataFrame([], T.StructType([T.StructField(id_col, kind), T.StructField(item_col, item_kind),
                                                       *schema.fields[2:]]))
    return out.join(sets.select("class", "item"), "class").select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "n_item", "n_shared")


def clean_documents(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                    item_text: str = "text", k: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns unchanged; nothing is shuffled."""
    spark = docs.sparkSession
    at = docs.columns.index(text_col)
    for keys, block, _ in item_blocks(items, item_col, item_text, k):
        sent = spark.sparkContext.broadcast(block.__dict__)

        def keep(batches, sent=sent):
            block = Block.__new__(Block)
            block.__dict__.update(sent.value)
            for batch in batches:
                data, offsets = W.text_buffer(batch.column(at))
                clean = np.ones(batch.num_rows, bool)
                for a, b in W.slices(offsets):
                    d, h, _ = W.distinct_shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], k)
                    clean[a + block.search(d, h)[0]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(lambda it, keep=keep: W.tidy(keep(it)), docs.schema)
    return docs
