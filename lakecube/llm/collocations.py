"""Phrase collocation mining (operator 13) with counting quotient filters.

1. Every task turns its texts into chunks: the distinct words of a chunk and,
   for every word place, which of them stands there.  The words go to hash buckets,
   once per chunk.  Words found ``min_count`` times or more in their language get
   ids; each chunk gets those of its own words back, so no task holds the
   whole vocabulary.
2. A phrase of n words is frequent only if its first and its last n - 1 words
   are.  So a phrase is a pair of ids of the length before, and lengths 2 to 5 are
   counted one after the other over the places that are left.  A chunk counts
   its pairs in quotient filters, one per bucket; a bucket's filters are
   merged, and what reaches ``min_count`` gets ids of its own.  A frequent
   pair is one counter per chunk, however often it occurs.
3. The scores need counts of frequent phrases only: a phrase's first k words
   and its last words are as frequent as the phrase itself, or more.

Counts and scores are exact: filters lose nothing, products are 38-digit decimals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import quotient_filter as Q
from . import words as W
from .base import written
from .packed import pack, unpack

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20           # of text, for each bucket of words
BUCKET_SLOTS = 1 << 20
NO_LANG = "und"

BREAK = np.zeros(256, dtype=bool)
BREAK[[ord(c) for c in ".,;:!?"] + list(range(10, 14))] = True


def _dictionary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, solid: np.ndarray):
    """(index into the distinct words of each word, the distinct words).  Words are compared, not hashes of them."""
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(ends - starts)])
    body = np.ascontiguousarray(data[solid])
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()
    return found.indices.to_numpy(), found.dictionary.cast(pa.binary())


def chunk_words(data: np.ndarray, offsets: np.ndarray):
    """(place, document, index, words): places of words that follow each other in a piece are consecutive numbers."""
    data = W.LOWER[data]
    cut = BREAK[data]
    solid = ~cut & (data != 32) & (data != 9)
    if not solid.any():
        none = np.zeros(0, np.int64)
        return none, none, none, pa.array([], pa.binary())
    left, right = np.empty_like(solid), np.empty_like(solid)
    left[0], left[1:] = False, solid[:-1]
    right[-1], right[:-1] = False, solid[1:]
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    left[inner] = False
    right[inner - 1] = False
    starts, ends = np.flatnonzero(solid & ~left), np.flatnonzero(solid & ~right) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    breaks = np.cumsum(cut)[starts]                       # breaks before the word
    new = np.zeros(len(starts), np.int64)
    new[1:] = (breaks[1:] != breaks[:-1]) | (doc[1:] != doc[:-1])
    index, words = _dictionary(data, starts, ends, solid)
    return np.arange(len(starts)) + np.cumsum(new), doc, index, words


def _pack_words(keys: pa.BinaryArray) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([keys], names=["w"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack_words(blob: bytes) -> pa.Array:
    with pa.ipc.open_stream(blob) as r:
        return r.read_next_batch().column(0)


CHUNK = "chunk long, places binary, ids binary, buckets array<int>, starts array<long>, words array<binary>, counts array<binary>"


def _chunks(batches: Iterator[pa.RecordBatch], size: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """A row per chunk: its word places, and its distinct words by hash bucket.

    A word is the key ``lang \\n word``.  Words are numbered in the order in which the buckets list them.
    """
    from pyspark import TaskContext
    chunk = TaskContext.get().partitionId() << 36
    for batch in batches:
        data, offsets = W.text_buffer(batch.column(1))
        lang = batch.column(0).fill_null(NO_LANG).dictionary_encode()
        names, of_row = lang.dictionary.cast(pa.binary()), lang.indices.to_numpy()
        for a, b in W.slices(offsets, size):
            place, doc, index, words = chunk_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            if not len(place):
                continue
            pair = of_row[a:b][doc].astype(np.int64) * len(words) + index
            distinct, local, n = np.unique(pair, return_inverse=True, return_counts=True)
            keys = pc.binary_join_element_wise(names.take(pa.array(distinct // len(words))), words.take(pa.array(distinct % len(words))), b"\n")
            text, at = W.text_buffer(keys)
            h = W.span_hash(W.prefix_hash(text), at[:-1], at[1:])
            bucket = (((h >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)).astype(np.int64)
            order = np.lexsort((h, bucket))
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            full, starts = np.unique(bucket[order], return_index=True)
            keys, n = keys.take(pa.array(order)), n[order]
            cuts = list(zip(starts, np.append(starts[1:], len(order))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([pack(place.astype(np.uint64), ascending=True)], pa.binary()),
                 pa.array([pack(number[local].astype(np.uint64))], pa.binary()), pa.array([full.astype(np.int32)], pa.list_(pa.int32())),
                 pa.array([starts], pa.list_(pa.int64())), pa.array([[_pack_words(keys[lo:hi]) for lo, hi in cuts]], pa.list_(pa.binary())),
                 pa.array([[pack(n[lo:hi].astype(np.uint64)) for lo, hi in cuts]], pa.list_(pa.binary()))],
                names=["chunk", "places", "ids", "buckets", "starts", "words", "counts"])
            chunk += 1


VOCABULARY = "chunk long, bucket long, at binary, ids binary, lang string, id long, word string, f long"


def _vocabulary(key, table: pa.Table, buckets: int, min_count: int) -> pa.Table:
    """A bucket's frequent words (``id`` set), its words per language (neither), and a reply per chunk (``chunk`` set)."""
    bucket = key[0].as_py()
    lists = [_unpack_words(b) for b in table.column("words").to_pylist()]
    counts = np.concatenate([unpack(b) for b in table.column("counts").to_pylist()]).astype(np.int64)
    coded = pa.chunked_array([pa.concat_arrays(lists).cast(pa.large_binary())]).combine_chunks().dictionary_encode()
    index, keys = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, index, counts)
    langs, words = zip(*(k.decode("utf-8", "replace").rsplit("\n", 1) for k in keys))
    names, of = np.unique(np.array(langs, dtype=object), return_inverse=True)
    per_lang = np.zeros(len(names), np.int64)
    np.add.at(per_lang, of, total)
    kept = np.flatnonzero(total >= min_count)
    id_of = np.full(len(keys), -1, np.int64)
    id_of[kept] = np.arange(len(kept)) * buckets + bucket
    rows = [(None, None, None, None, langs[i], int(id_of[i]), words[i], int(total[i])) for i in kept]
    rows += [(None, None, None, None, str(name), None, None, int(n)) for name, n in zip(names, per_lang)]
    lo = 0
    for chunk, mine in zip(table.column("chunk").to_pylist(), lists):
        ids = id_of[index[lo:lo + len(mine)]]
        lo += len(mine)
        at = np.flatnonzero(ids >= 0)
        if len(at):
            rows.append((chunk, bucket, pack(at.astype(np.uint64), ascending=True), pack(ids[at].astype(np.uint64)), None, None, None, None))
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.table([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], names=[c.split()[0] for c in VOCABULARY.split(", ")])


def _take(chunk: pa.Table, reply: pa.Table) -> pa.Table:
    """A chunk's places of frequent words, with the words' ids."""
    if not chunk.num_rows or not reply.num_rows:
        return _no_state()
    place, local = unpack(chunk.column("places")[0].as_py()), unpack(chunk.column("ids")[0].as_py()).astype(np.int64)
    start = dict(zip(chunk.column("buckets")[0].as_py(), chunk.column("starts")[0].as_py()))
    ids = np.full(int(local.max()) + 1, -1, np.int64)
    for b, at, new in zip(*(reply.column(c).to_pylist() for c in ("bucket", "at", "ids"))):
        ids[start[b] + unpack(at).astype(np.int64)] = unpack(new).astype(np.int64)
    ids = ids[local]
    return _state(chunk.column("chunk"), place[ids >= 0], ids[ids >= 0])


def _state(chunk, place: np.ndarray, ids: np.ndarray) -> pa.Table:
    return pa.table({"chunk": chunk, "places": pa.array([pack(place.astype(np.uint64), ascending=True)], pa.binary()),
                     "ids": pa.array([pack(ids.astype(np.uint64))], pa.binary()), "n": pa.array([len(place)], pa.int64())})


def _no_state() -> pa.Table:
    return pa.table({"chunk": pa.array([], pa.int64()), "places": pa.array([], pa.binary()), "ids": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})


STATE = "chunk long, places binary, ids binary, n long"


def _pairs(places: bytes, ids: bytes):
    """(place, left, right): phrases of one more word, as the two phrases at this place and at the next."""
    place, ids = unpack(places), unpack(ids)
    at = np.flatnonzero(place[1:] == place[:-1] + np.uint64(1)) if len(place) else np.zeros(0, np.int64)
    return place[at], ids[at], ids[at + 1]


def _send(batches: Iterator[pa.RecordBatch], bits: int, bucket_bits: int) -> Iterator[pa.RecordBatch]:
    """A quotient filter per chunk and bucket."""
    width = 2 * bits - bucket_bits
    for batch in batches:
        for chunk, places, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
            _, left, right = _pairs(places, ids)
            if not len(left):
                continue
            bucket, rest = Q.split(left, right, bits, bucket_bits)
            order = np.lexsort((rest, bucket))
            bucket, rest = bucket[order], rest[order]
            new = np.ones(len(rest), bool)
            new[1:] = (rest[1:] != rest[:-1]) | (bucket[1:] != bucket[:-1])
            first = np.flatnonzero(new)
            counts = np.diff(np.append(first, len(rest)))
            bucket, rest = bucket[first], rest[first]
            edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            rows = [(int(bucket[lo]), *Q.encode(rest[lo:hi], counts[lo:hi], width)) for lo, hi in zip(edges, np.append(edges[1:], len(rest)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([chunk] * len(rows), pa.int64()),
                 *[pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2, 3)], pa.array([r[4] for r in rows], pa.int32())],
                names=["bucket", "chunk", "runs", "remainders", "counts", "q"])


COUNTED = "chunk long, bucket long, rests binary, ids binary, id long, pre long, suf long, f long"


def _count(key, table: pa.Table, bits: int, bucket_bits: int, min_count: int) -> pa.Table:
    """Merge a bucket's filters.  Phrase rows (chunk null), and a reply per chunk: which of its pairs are phrases."""
    bucket, width = key[0].as_py(), 2 * bits - bucket_bits
    filters = [Q.decode(*(table.column(c)[i].as_py() for c in ("runs", "remainders", "counts", "q")), width) for i in range(table.num_rows)]
    rest, f = Q.merge(filters)
    rest, f = rest[f >= min_count], f[f >= min_count]
    pre, suf = Q.join(bucket, rest, bits, bucket_bits)
    ids = np.arange(len(rest)) * (1 << bucket_bits) + bucket
    n = len(rest)
    out = [pa.table({"chunk": pa.nulls(n, pa.int64()), "bucket": pa.nulls(n, pa.int64()), "rests": pa.nulls(n, pa.binary()), "ids": pa.nulls(n, pa.binary()),
                     "id": pa.array(ids, pa.int64()), "pre": pa.array(pre.astype(np.int64)), "suf": pa.array(suf.astype(np.int64)), "f": pa.array(f, pa.int64())})]
    replies = []
    for chunk, (mine, _) in zip(table.column("chunk").to_pylist(), filters):
        at = np.searchsorted(rest, mine)
        hit = np.flatnonzero(rest[np.minimum(at, max(0, n - 1))] == mine) if n else []
        if len(hit):
            replies.append((chunk, pack(mine[hit], ascending=True), pack(ids[at[hit]].astype(np.uint64))))
    m, none = len(replies), pa.nulls(len(replies), pa.int64())
    out.append(pa.table({"chunk": pa.array([r[0] for r in replies], pa.int64()), "bucket": pa.array([bucket] * m, pa.int64()),
                         "rests": pa.array([r[1] for r in replies], pa.binary()), "ids": pa.array([r[2] for r in replies], pa.binary()),
                         "id": none, "pre": none, "suf": none, "f": none}))
    return pa.concat_tables(out)


def _advance(state: pa.Table, reply: pa.Table, bits: int, bucket_bits: int) -> pa.Table:
    """A chunk's places of frequent phrases of one more word."""
    if not state.num_rows or not reply.num_rows:
        return _no_state()
    place, left, right = _pairs(state.column("places")[0].as_py(), state.column("ids")[0].as_py())
    bucket, rest = Q.split(left, right, bits, bucket_bits)
    order = np.argsort(bucket, kind="stable")
    edges = bucket[order]
    ids = np.full(len(place), -1, np.int64)
    for b, rests, new in zip(*(reply.column(c).to_pylist() for c in ("bucket", "rests", "ids"))):
        mine = order[np.searchsorted(edges, np.uint64(b)):np.searchsorted(edges, np.uint64(b), side="right")]
        known, number = unpack(rests), unpack(new).astype(np.int64)
        at = np.minimum(np.searchsorted(known, rest[mine]), len(known) - 1)
        ids[mine] = np.where(known[at] == rest[mine], number[at], -1)
    return _state(state.column("chunk"), place[ids >= 0], ids[ids >= 0])


def _bits(largest: int | None, least: int) -> int:
    return max(1, least, int(largest or 0).bit_length())


def frequent_phrases(docs: DataFrame, text_col: str, lang_col: str, min_count: int, max_words: int, chunk_bytes: int):
    """(words, phrases by length, words per language).

    Words: id, lang, phrase, f.  Phrases: id, pre and suf (ids of the first and last n - 1 words), f.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(1 << 24, max(width, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES)))
    chunks = written(rows.mapInArrow(lambda it: _chunks(it, chunk_bytes, buckets), CHUNK), "chunks")
    sent = (chunks.select("chunk", F.explode(F.arrays_zip("buckets", "words", "counts")).alias("w"))
            .select("chunk", F.col("w.buckets").alias("bucket"), F.col("w.words").alias("words"), F.col("w.counts").alias("counts")))
    counted = written(sent.groupBy("bucket").applyInArrow(lambda key, t: _vocabulary(key, t, buckets, min_count), VOCABULARY), "vocabulary")
    totals = written(counted.filter("chunk is null and id is null").groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    words = counted.filter("id is not null").select("id", "lang", "word", "f")
    reply = counted.filter("chunk is not null").select(F.col("chunk").alias("of"), "bucket", "at", "ids")
    state = written(chunks.select("chunk", "places", "ids", "buckets", "starts").groupBy("chunk").cogroup(reply.groupBy("of"))
                    .applyInArrow(_take, STATE), "state")
    phrases, last = [], words
    for _ in range(2, max_words + 1):
        slots, largest = state.agg(F.sum("n")).first()[0] or 0, last.agg(F.max("id")).first()[0]
        if not slots:
            break
        bucket_bits = max(width, -(-slots // BUCKET_SLOTS)).bit_length()
        bits = _bits(largest, bucket_bits)
        bucket_bits = max(bucket_bits, 2 * bits - 64)
        found, state = _longer(state, bits, bucket_bits, min_count)
        phrases.append(found)
        last = found
    return words.select("id", "lang", F.col("word").alias("phrase"), "f"), phrases, totals


def _longer(state: DataFrame, bits: int, bucket_bits: int, min_count: int) -> tuple[DataFrame, DataFrame]:
    sent = state.select("chunk", "places", "ids").mapInArrow(
        lambda it: _send(it, bits, bucket_bits), "bucket long, chunk long, runs binary, remainders binary, counts binary, q int")
    counted = written(sent.groupBy("bucket").applyInArrow(lambda key, t: _count(key, t, bits, bucket_bits, min_count), COUNTED), "counted")
    reply = counted.filter("chunk is not null").select("chunk", "bucket", "rests", "ids")
    after = state.groupBy("chunk").cogroup(reply.groupBy("chunk")).applyInArrow(lambda s, r: _advance(s, r, bits, bucket_bits), STATE)
    return counted.filter("chunk is null").select("id", "pre", "suf", "f"), written(after, "state")


def phrase_table(words: DataFrame, phrases: list[DataFrame]) -> list[DataFrame]:
    """Per length: id, lang, phrase, last word, f, and the counts of its first and its last 1, 2, .. words."""
    none = F.array().cast("array<long>")
    tables = [words.select("id", "lang", "phrase", F.col("phrase").alias("last"), "f", none.alias("heads"), none.alias("tails"))]
    for found in phrases:
        pre = tables[-1].select(F.col("id").alias("pre"), "lang", "phrase", F.concat("heads", F.array("f")).alias("heads"))
        suf = tables[-1].select(F.col("id").alias("suf"), "last", F.concat("tails", F.array("f")).alias("tails"))
        tables.append(written(found.join(pre, "pre").join(suf, "suf").select(
            "id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f", "heads", "tails", "pre", "suf"), "phrases"))
    return tables


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 top: int = TOP, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased in A-Z and cut into pieces at ``[.,;:!?\\x0A-\\x0D]``,
    pieces into words ``[^\\x20\\x09]+``.  A candidate is a phrase of 2 to
    ``max_words`` words found a >= ``min_count`` times in its language.

    Defined cases: a null text is empty; a null language is ``und``, the same
    as that name; repeated rows count as often as they are there; an empty
    table, or one without candidates, gives an empty one; further columns are
    not looked at.  A text longer than a chunk is a chunk of its own, so memory per task
    grows with the longest text (about 40 bytes a byte).
    """
    words, phrases, totals = frequent_phrases(docs, text_col, lang_col, min_count, max_words, chunk_bytes)
    tables = phrase_table(words, phrases)[1:]
    kept = None
    for i, t in enumerate(tables):
        if i + 1 < len(tables):     # a longer phrase as frequent holds one of one more word that is
            longer = tables[i + 1]
            cover = (longer.select(F.col("pre").alias("id"), "f").unionByName(longer.select(F.col("suf").alias("id"), "f"))
                     .groupBy("id").agg(F.max("f").alias("__cover")))
            t = t.join(cover, "id", "left").filter(F.col("__cover").isNull() | (100 * F.col("__cover") < 100 * F.col("f")))
        t = t.select("lang", "phrase", "f", "heads", "tails")
        kept = t if kept is None else kept.unionByName(t)
    if kept is None:
        return docs.sparkSession.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    big = "decimal(19,0)"
    cuts = F.transform(F.sequence(F.lit(1), F.size("heads")), lambda k: F.struct(
        k.alias("k"), F.element_at("heads", k).alias("l"), F.element_at("tails", F.size("tails") - k + 1).alias("r")))
    rows = kept.join(F.broadcast(totals), "lang") if totals.count() <= 10_000 else kept.join(totals, "lang")
    rows = rows.withColumn("cut", F.explode(cuts)).select("lang", "phrase", F.col("f").alias("a"), "n", "cut.k", "cut.l", "cut.r")
    top_, below = 1000 * F.col("a").cast(big) * F.col("n").cast(big), F.col("l").cast(big) * F.col("r").cast(big)
    rows = rows.withColumn("__t", top_).withColumn("__b", below).withColumn("score", F.expr("__t div __b"))
    best = rows.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    best = best.select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (best.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
