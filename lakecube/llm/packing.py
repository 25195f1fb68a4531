"""Best-fit packing (operator 9): sum-of-squares packing of token pieces into sequences.

Documents are tokenized where they lie; only piece lengths travel.  Pieces that
fill a sequence need no packing.  The others are dealt by hash to parts of a
bounded number of pieces, and each part is packed by the sum-of-squares
rule: with N(g) open sequences of residual gap g, a piece goes where the sum of
N(g)**2 is smallest afterwards.  Pieces longer than a third of a sequence come
first, longest first; the others follow in hash order, so that the rule meets
all lengths mixed until the end.
"""

from __future__ import annotations

import json
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import written
from .words import mix, tidy

CAPACITY = 1024
END_ID = 2
PART_PIECES = 10_000, 100_000     # pieces packed together: 40 times the square root of all, between these
END_TEXT = "<|endoftext|>"
# The split before byte-level merges that the vocabulary file's "ByteLevel" step stands for (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with: printable bytes as themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TextEncoder:
    """The ids that ``tokenizers`` gives with the vocabulary file, without added special tokens.

    The file's merges are applied by tiktoken, whose results are the same and
    come about four times faster; texts that spell a special token out, and files
    that are not plain byte-level merges in id order, go through ``tokenizers``.
    """

    def __init__(self, path: str):
        self.path, self.fast, self.kept = path, None, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        model, pre = spec.get("model", {}), spec.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        vocab = model.get("vocab", {})
        ids = [vocab.get("".join(m), -1) for m in merges]
        plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                 and pre.get("use_regex", True) and not spec.get("normalizer") and ids == sorted(ids) and -1 not in ids
                 and not model.get("ignore_merges"))
        if plain:
            import tiktoken
            letters = byte_letters()
            ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in self.special}
            self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    @property
    def slow(self):
        """The file's own tokenizer, read when a text first needs it."""
        if self.kept is None:
            from tokenizers import Tokenizer
            self.kept = Tokenizer.from_file(self.path)
        return self.kept

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(s in text for s in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def encoder(path: str) -> TextEncoder:
    """One encoder per task and file (``tidy`` drops it)."""
    kept = sys.__dict__.setdefault("_text_encoders", {})
    if path not in kept:
        kept[path] = TextEncoder(path)
    return kept[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all full but the first, which may be shorter."""
    first = n - (-(-n // capacity) - 1) * capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for batch in batches:
        at, rows = [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            ids = np.append(enc.ids(text or ""), np.uint32(end_id)).astype("<u4")
            for k, (start, length) in enumerate(cut(len(ids), capacity)):
                at.append(i)
                rows.append((k, start, length, zlib.crc32(ids[start:start + length].tobytes())))
        cols = np.array(rows, dtype=np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(at, pa.int32())), pa.array(cols[:, 0], pa.int32()),
             *[pa.array(np.ascontiguousarray(cols[:, j])) for j in (1, 2, 3)]],
            names=["id", "piece", "start", "length", "ids_crc32"])


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) per length, placed in the given order.

    Moving a sequence from gap g to g - s changes the sum of squares by
    2 * (N(g - s) - N(g) + 1); opening one adds 2 * N(capacity - s) + 1; closing
    one (g = s) subtracts 2 * N(s) - 1.  Ties go to the smallest gap.
    """
    count = np.zeros(capacity + 1, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    n_bins = 0
    for i, s in enumerate(lengths.tolist()):
        before = count[s:capacity]                      # N(g) for g = s .. capacity - 1
        change = np.where(before > 0, 2 * (count[:capacity - s] - before + 1), np.iinfo(np.int64).max)
        if len(change) and before[0]:
            change[0] = 1 - 2 * before[0]               # a closed sequence is no open one: no term for gap 0
        best = int(np.argmin(change)) if len(change) else -1
        fresh = 2 * int(count[capacity - s]) + 1 if s < capacity else 0
        if best >= 0 and change[best] <= fresh:
            g = best + s
            b = open_bins[g].pop()
            count[g] -= 1
        else:
            g, b = capacity, n_bins
            n_bins += 1
        where[i], offset[i] = b, capacity - g
        if g > s:
            open_bins[g - s].append(b)
            count[g - s] += 1
    return where, offset


def packing_order(lengths: np.ndarray, number: np.ndarray, capacity: int) -> np.ndarray:
    mixed = mix(number.astype(np.int64).view(np.uint64))
    return np.lexsort((mixed, -np.where(3 * lengths > capacity, lengths, 0)))


def _pack(key, table: pa.Table, capacity: int) -> pa.Table:
    part = key[0].as_py()
    order = packing_order(table.column("length").to_numpy(), table.column("rid").to_numpy(), capacity)
    table = table.take(pa.array(order))
    where, offset = sum_of_squares(table.column("length").to_numpy(), capacity)
    return pa.table({"rid": table.column("rid"), "sequence_id": pa.array((part << 40) | where), "offset": pa.array(offset)})


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                   capacity: int = CAPACITY, end_id: int = END_ID, part_pieces: tuple[int, int] = PART_PIECES) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row of ``docs``.

    A document is its text's token ids and then ``end_id``.  Only documents longer than ``capacity`` are
    cut.  ``path`` names a vocabulary file that every executor can read.

    Defined cases: a null or empty text is the end id alone; rows that share an
    id, and rows with a null id, are packed each on their own; an empty table
    gives an empty one; further columns of ``docs`` are not looked at.
    """
    path = path or default_tokenizer()
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("piece", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]])
    pieces = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        lambda it: tidy(_pieces(it, path, capacity, end_id)), schema)
    # Written with its row numbers: numbers given while reading could differ when a task runs again.
    pieces = written(pieces.withColumn("rid", F.monotonically_increasing_id()), "pieces")
    short = pieces.filter(F.col("length") < capacity)
    n = short.count()
    parts = max(1, -(-n // min(part_pieces[1], max(part_pieces[0], int(40 * n ** 0.5)))))
    placed = (short.select("rid", "length", F.pmod(F.xxhash64("rid"), F.lit(parts)).alias("part"))
              .groupBy("part").applyInArrow(lambda key, t: _pack(key, t, capacity), "rid long, sequence_id long, offset long"))
    full = pieces.filter(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("rid")).withColumn("offset", F.lit(0).cast("long"))
    out = short.join(placed, "rid").unionByName(full.select(*short.columns, "sequence_id", "offset"))
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
