"""Suffix-array dedup (operator 1): repeated byte strings of a fixed length, found by difference covers.

To be removed is every byte covered by a ``length``-byte string that also
starts earlier.  Only equality to that depth matters, so a suffix is its first
``length`` bytes, and sorting suffixes means bringing equal ones together in
order of document and place.  Memory and traffic are bounded in three steps,
each of which sorts one bucket of entries at a time:

1. Stretches.  Texts are cut at content-defined places.  A stretch with the
   bytes that its suffixes reach into is one entry; of equal ones the earliest
   stays, and the others' suffixes are settled without being sorted one by one.
2. Cover samples.  Offsets ``p`` with ``p mod v`` in a difference cover of ``v``
   are sampled among the suffixes that are left; a sample's rank is the class of its
   ``length - v + 1`` bytes.  Two equal suffixes, wherever they start, hold samples at one common
   distance below ``v``, of equal rank.  So a suffix none of whose samples shares its rank ties with nothing.
3. Suffixes.  Those that can tie are dealt to buckets by their bytes, and each bucket is sorted by itself.

A chunk of documents sends each distinct entry once, with the smallest document that
holds it, and gets a bit back for each: whether it holds the earliest one.  The
chunks are a written table bucketed on the chunk number, so texts are not
shuffled; entries are packed to a few bytes.  Entries carry 64-bit hashes beside the
bucket, which is chosen by other bits of the text and has a bounded number of entries: different strings
are taken for equal with a chance of about 1e-14 an entry at any size.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .base import new_path, written
from .packed import pack, unpack

LENGTH = 100
CHUNK_BYTES = 2 << 20
STRETCH_BITS = 5                     # stretches of 2**5 suffixes on average
BUCKET_ENTRIES = 1 << 20
RANK_BITS = 32                       # kept of a sample's hash: equal bits only keep a suffix in the sort

# Perfect difference sets (fixed values): every distance modulo v is a difference of two members.
COVERS = {1: (0,), 7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52)}


def cover_for(length: int) -> tuple[int, np.ndarray]:
    """(v, cover) of the largest v that leaves samples at least 0.4 of the length."""
    v = max(v for v in COVERS if v == 1 or length - v + 1 >= 0.4 * length)
    return v, np.array(COVERS[v])


class Chunk:
    """One chunk's texts and the suffixes that are still open."""

    def __init__(self, ids, lens, blob, length):
        import zstandard
        self.length = length
        self.ids = ids
        self.offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
        raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=max(1, int(self.offsets[-1]))) if self.offsets[-1] else b""
        self.data = np.frombuffer(raw, dtype=np.uint8)
        n = len(self.data)
        starts = np.ones(n, bool)                            # a suffix starts here: length bytes of its document follow
        ends = np.maximum(self.offsets[1:] - length + 1, self.offsets[:-1])
        edge = np.zeros(n + 1, np.int8)
        lens = np.diff(self.offsets)
        np.add.at(edge, ends[lens > 0], -1)
        np.add.at(edge, self.offsets[1:][lens > 0], 1)
        starts &= np.cumsum(edge[:-1], dtype=np.int8) == 0
        self.starts = starts
        self.prefix = W.prefix_hash(self.data)
        self.inverse = W.powers("inverse", W.INVERSE, n + 1)

    def hash(self, start, end):
        return W.mix((self.prefix[end] - self.prefix[start]) * self.inverse[start])

    def gram(self, at):
        """Eight bytes from ``at`` on as a number (short of the end: fewer)."""
        out = np.zeros(len(at), np.uint64)
        n = len(self.data)
        for j in range(8):
            out |= self.data[np.minimum(at + j, n - 1)].astype(np.uint64) << np.uint64(8 * j)
        return out

    def docs(self, at):
        return self.ids[np.searchsorted(self.offsets, at, side="right") - 1]

    def stretches(self):
        """(first start, end of starts) of every stretch of suffixes."""
        n = len(self.data)
        if not self.starts.any():
            none = np.zeros(0, np.int64)
            return none, none
        # a place is a cut by the eight bytes before it and itself: equal text, equal cuts
        g = self.data.astype(np.uint32)
        roll = np.zeros(n, np.uint32)
        for j in range(8):
            roll[:n - j] = roll[:n - j] * np.uint32(0x01000193) + g[j:]
        cut = ((roll * np.uint32(0x9E3779B1)) >> np.uint32(32 - STRETCH_BITS)) == 0
        cut[self.offsets[:-1][np.diff(self.offsets) > 0]] = True
        first = np.flatnonzero(cut & self.starts)
        # suffixes of a document are consecutive: a stretch ends at the next cut or after its document's last suffix
        bound = np.append(first[1:], n)
        last = np.maximum(self.offsets[1:] - self.length + 1, self.offsets[:-1])[np.searchsorted(self.offsets, first, side="right") - 1]
        return first, np.minimum(bound, last)

    def spread(self, first, end):
        """Mask of the places in [first, end) of each stretch."""
        edge = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edge, first, 1)
        np.add.at(edge, end, -1)
        return np.cumsum(edge[:-1]) > 0

    def samples(self, open_):
        """Cover sample places that an open suffix holds."""
        v, cover = cover_for(self.length)
        n = len(self.data)
        edge = np.zeros(n + v + 1, np.int32)
        at = np.flatnonzero(open_)
        if not len(at):
            return at
        runs = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        first, last = at[runs], at[np.append(runs[1:] - 1, len(at) - 1)]
        np.add.at(edge, first, 1)
        np.add.at(edge, last + v, -1)                        # a suffix at i holds samples at i .. i + v - 1
        near = np.flatnonzero(np.cumsum(edge[:n]) > 0)
        place = near - self.offsets[np.searchsorted(self.offsets, near, side="right") - 1]
        return near[np.isin(np.arange(v), cover)[place % v]]

    def candidates(self, open_, shared):
        """Open suffixes that hold one of the ``shared`` sample places."""
        v, _ = cover_for(self.length)
        edge = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edge, np.maximum(shared - v + 1, 0), 1)
        np.add.at(edge, shared + 1, -1)
        return np.flatnonzero(open_ & (np.cumsum(edge[:-1]) > 0))


def bucketed(h: np.ndarray, gram: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of entries, from bits of the text that the hash does not determine."""
    return (((W.mix(gram ^ np.uint64(0xA5A5A5A5)) >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)).astype(np.int64)


class Entries:
    """A chunk's entries of one step, distinct and in the order in which they are sent."""

    def __init__(self, h, bucket, doc, buckets):
        order = np.lexsort((h, bucket))                      # stable: the first place of equal entries comes first
        hs, bs = h[order], bucket[order]
        new = np.ones(len(order), bool)
        new[1:] = (hs[1:] != hs[:-1]) | (bs[1:] != bs[:-1])
        self.order, self.new = order, new
        self.h, self.bucket = hs[new], bs[new]
        self.doc = doc[order][new] if doc is not None else None
        self.count = np.diff(np.append(np.flatnonzero(new), len(order)))
        self.edges = np.searchsorted(self.bucket, np.arange(buckets + 1))

    def rows(self, chunk, step):
        """Rows (chunk, bucket, hashes, docs, twice) to send."""
        for k in np.flatnonzero(np.diff(self.edges)):
            a, b = self.edges[k], self.edges[k + 1]
            if step == "samples":
                yield chunk, int(k), pack(self.h[a:b], ascending=True), b"", np.packbits(self.count[a:b] > 1).tobytes()
            else:
                yield chunk, int(k), pack(self.h[a:b], ascending=True), pack(self.doc[a:b].astype(np.int64).view(np.uint64)), b""

    def answered(self, reply: dict[int, bytes]) -> np.ndarray:
        """The reply's bit for each distinct entry."""
        out = np.zeros(len(self.h), bool)
        for k, bits in reply.items():
            a, b = self.edges[k], self.edges[k + 1]
            out[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
        return out

    def repeats(self, first: np.ndarray) -> np.ndarray:
        """Indices of the entries that are not the earliest of their kind."""
        keep = np.zeros(len(self.order), bool)
        keep[np.flatnonzero(self.new)] = first
        return self.order[~keep]

    def of(self, flag: np.ndarray) -> np.ndarray:
        """Indices of all entries whose distinct entry is flagged."""
        return self.order[np.repeat(flag, self.count)]


def _stretch_entries(c: Chunk, buckets):
    first, end = c.stretches()
    reach = end + c.length - 1
    h = c.hash(first, reach)
    return first, end, Entries(h, bucketed(h, c.gram(first) ^ (c.gram(reach - 8) * np.uint64(3)), buckets), c.docs(first), buckets)


def _open(c: Chunk, buckets, reply):
    first, end, e = _stretch_entries(c, buckets)
    gone = e.repeats(e.answered(reply))
    settled = c.spread(first[gone], end[gone])
    return settled, c.starts & ~settled


def _sample_entries(c: Chunk, open_, buckets):
    at = c.samples(open_)
    v, _ = cover_for(c.length)
    h = c.hash(at, at + c.length - v + 1)
    return at, Entries(h >> np.uint64(64 - RANK_BITS), bucketed(h, c.gram(at), buckets), None, buckets)


def _suffix_entries(c: Chunk, open_, buckets, reply, sample_buckets):
    at, e = _sample_entries(c, open_, sample_buckets)
    shared = e.of(e.answered(reply))
    i = c.candidates(open_, at[shared])
    h = c.hash(i, i + c.length)
    return i, Entries(h, bucketed(h, c.gram(i) ^ (c.gram(i + c.length - 8) * np.uint64(3)), buckets), c.docs(i), buckets)


SENT = "chunk long, bucket int, hashes binary, docs binary, twice binary"
REPLY = "chunk long, step int, bucket int, bits binary"
_SENT = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
_NAMES = ["chunk", "bucket", "hashes", "docs", "twice"]


def _sent_table(rows) -> pa.Table:
    cols = list(zip(*rows)) or [[]] * 5
    return pa.table([pa.array(list(c), t) for c, t in zip(cols, _SENT)], names=_NAMES)


def _chunk_rows(t: pa.Table):
    for i in range(t.num_rows):
        yield (t.column("chunk")[i].as_py(), t.column("ids")[i].values.to_numpy(), t.column("lens")[i].values.to_numpy(), t.column("data")[i].as_py())


def _by_chunk(t: pa.Table):
    """A chunk's replies by step and bucket."""
    out = defaultdict(lambda: [{}, {}, {}])
    for chunk, step, bucket, bits in zip(*(t.column(c).to_pylist() for c in ("chunk", "step", "bucket", "bits"))):
        out[chunk][step][bucket] = bits
    return out


def _first_bits(step):
    def run(key, t: pa.Table) -> pa.Table:
        """One bucket: which entries are the earliest of their kind, in the order of each chunk's entries."""
        h = [unpack(b.as_py()) for b in t.column("hashes")]
        size = np.array([len(x) for x in h])
        chunk = np.repeat(t.column("chunk").to_numpy(), size)
        doc = np.concatenate([unpack(b.as_py()) for b in t.column("docs")]).view(np.int64)
        h = np.concatenate(h)
        order = np.lexsort((chunk, doc, h))
        first = np.zeros(len(h), bool)
        hs = h[order]
        first[order[np.append(True, hs[1:] != hs[:-1])[:len(hs)]]] = True
        return _reply(t, key, step, first, size)
    return run


def _shared_bits(key, t: pa.Table) -> pa.Table:
    """One bucket: which samples share their rank with another."""
    h = [unpack(b.as_py()) for b in t.column("hashes")]
    size = np.array([len(x) for x in h])
    twice = np.concatenate([np.unpackbits(np.frombuffer(b.as_py(), np.uint8), count=n) for b, n in zip(t.column("twice"), size)]).astype(bool)
    h = np.concatenate(h)
    order = np.argsort(h)
    hs = h[order]
    same = hs[1:] == hs[:-1]
    some = twice[order]
    some[1:] |= same
    some[:-1] |= same
    shared = np.zeros(len(h), bool)
    shared[order] = some
    return _reply(t, key, 1, shared, size)


def _reply(t, key, step, flags, size):
    edges = np.concatenate([[0], np.cumsum(size)])
    n = t.num_rows
    return pa.table({"chunk": t.column("chunk"), "step": pa.array([step] * n, pa.int32()), "bucket": pa.array([key[0].as_py()] * n, pa.int32()),
                     "bits": pa.array([np.packbits(flags[a:b]).tobytes() for a, b in zip(edges, edges[1:])], pa.binary())})


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents gathered to chunks; a chunk's documents are in order of their ids."""
    import zstandard
    from pyspark import TaskContext
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        data, offsets = W.text_buffer(batch.column(1))
        for a, b in W.slices(offsets, CHUNK_BYTES):
            order = a + np.argsort(ids[a:b], kind="stable")
            blob = b"".join(data[offsets[i]:offsets[i + 1]].tobytes() for i in order)
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) | number], pa.int64()), pa.array([ids[order]], pa.list_(pa.int64())),
                 pa.array([np.diff(offsets)[order]], pa.list_(pa.int64())),
                 pa.array([zstandard.ZstdCompressor(level=3).compress(blob)], pa.binary())], names=["chunk", "ids", "lens", "data"])
            number += 1


def _result(c: Chunk, gone: np.ndarray):
    """(id, n_bytes, starts and lengths of removed runs, kept bytes) of each document."""
    n = len(c.data)
    edge = np.zeros(n + c.length + 1, np.int32)
    np.add.at(edge, gone, 1)
    np.add.at(edge, gone + c.length, -1)
    removed = np.cumsum(edge[:n]) > 0
    before = np.zeros(n, bool)
    before[1:] = removed[:-1]
    heads = c.offsets[:-1][np.diff(c.offsets) > 0]
    before[heads] = False
    run = np.flatnonzero(removed & ~before)
    after = np.zeros(n, bool)
    after[:-1] = removed[1:]
    after[c.offsets[1:][np.diff(c.offsets) > 0] - 1] = False
    stop = np.flatnonzero(removed & ~after) + 1
    run_edges = np.searchsorted(run, c.offsets)
    kept = c.data[~removed]
    kept_edges = np.concatenate([[0], np.cumsum(~removed)])[c.offsets]
    base = np.repeat(c.offsets[:-1], np.diff(run_edges))
    return (pa.array(c.ids), pa.array(np.diff(c.offsets)),
            pa.ListArray.from_arrays(pa.array(run_edges, pa.int32()), pa.array(run - base)),
            pa.ListArray.from_arrays(pa.array(run_edges, pa.int32()), pa.array(stop - run)),
            pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(c.ids), [None, pa.py_buffer(kept_edges.astype(np.int64).tobytes()), pa.py_buffer(kept.tobytes())]).cast(pa.binary()))


RESULT = "id long, n_bytes long, starts array<long>, lengths array<long>, kept binary"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_bytes, starts, lengths, kept) for every row of ``docs``.

    ``starts`` and ``lengths`` are the maximal removed runs of the text's UTF-8 bytes, ``kept`` the bytes that are
    left.  Matches never cross documents; earlier means a smaller id, or an earlier start in the same document.

    Defined cases: a null text is empty, and texts shorter than ``length`` keep
    all bytes; equal texts keep those of the smallest id; rows that share an id are
    documents one after the other, in the order in which the chunk table holds them; rows with a null id keep
    all bytes and repeat nothing; an empty table gives an empty one; further
    columns are not looked at.  Ids are integers.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"suffix_chunks_{uuid.uuid4().hex}"
    (plain.filter("id is not null").mapInArrow(_chunks, "chunk long, ids array<long>, lens array<long>, data binary")
     .write.format("parquet").option("compression", "none").bucketBy(width, "chunk").sortBy("chunk").option("path", new_path(spark, "chunks")).saveAsTable(name))
    chunks = spark.table(name)
    total = chunks.select(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).agg(F.sum("n")).first()[0] or 0
    v, cover = cover_for(length)
    buckets = [max(width, -(-total // (d * BUCKET_ENTRIES))) for d in (1 << STRETCH_BITS, max(1, v // len(cover)), 8)]
    buckets = [min(b, 1 << 22) for b in buckets]

    def texts(t):
        for chunk, ids, lens, blob in _chunk_rows(t):
            yield chunk, Chunk(ids, lens, blob, length)

    def send_stretches(batches):
        for batch in batches:
            for chunk, c in texts(pa.Table.from_batches([batch])):
                yield from _sent_table(_stretch_entries(c, buckets[0])[2].rows(chunk, "stretches")).to_batches()

    def send_samples(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, reply = [], _by_chunk(right)
        for chunk, c in texts(left):
            open_ = _open(c, buckets[0], reply[chunk][0])[1]
            rows += _sample_entries(c, open_, buckets[1])[1].rows(chunk, "samples")
        return _sent_table(rows)

    def send_suffixes(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, reply = [], _by_chunk(right)
        for chunk, c in texts(left):
            open_ = _open(c, buckets[0], reply[chunk][0])[1]
            rows += _suffix_entries(c, open_, buckets[2], reply[chunk][1], buckets[1])[1].rows(chunk, "suffixes")
        return _sent_table(rows)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        out, reply = [], _by_chunk(right)
        for chunk, c in texts(left):
            settled, open_ = _open(c, buckets[0], reply[chunk][0])
            i, e = _suffix_entries(c, open_, buckets[2], reply[chunk][1], buckets[1])
            gone = np.concatenate([np.flatnonzero(settled), i[e.repeats(e.answered(reply[chunk][2]))]])
            out.append(pa.RecordBatch.from_arrays(list(_result(c, gone)), names=["id", "n_bytes", "starts", "lengths", "kept"]))
        return pa.Table.from_batches(out) if out else pa.table({"id": pa.array([], pa.int64()), "n_bytes": pa.array([], pa.int64()),
                                                               "starts": pa.array([], pa.list_(pa.int64())), "lengths": pa.array([], pa.list_(pa.int64())),
                                                               "kept": pa.array([], pa.binary())})

    def replies(sent: DataFrame, run) -> DataFrame:
        return written(sent.groupBy("bucket").applyInArrow(lambda key, t: run(key, t), REPLY), "replies")

    def joined(answers: list[DataFrame], run, schema) -> DataFrame:
        every = answers[0]
        for a in answers[1:]:
            every = every.unionByName(a)
        return chunks.groupBy("chunk").cogroup(every.groupBy("chunk")).applyInArrow(lambda left, right: run(left, right), schema)

    got = [replies(chunks.mapInArrow(send_stretches, SENT), _first_bits(0))]
    got.append(replies(joined(got, send_samples, SENT), _shared_bits))
    got.append(replies(joined(got, send_suffixes, SENT), _first_bits(2)))
    out = joined(got, finish, RESULT)
    alone = plain.filter("id is null").select("id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                                             F.array().cast("array<long>").alias("starts"), F.array().cast("array<long>").alias("lengths"),
                                             F.coalesce("text", F.lit("")).cast("binary").alias("kept"))
    return out.unionByName(alone).withColumnRenamed("id", id_col)
