"""N-gram Jaccard join (operator 2): prefix filters under several global token orders.

A document is its set of distinct word shingles.  Two sets of n and m tokens
with Jaccard similarity t or more share at least ``ceil(t * n)`` tokens of
each, so under any order of all tokens the first ``n - ceil(t * n) + 1`` tokens
of both must meet.  Three orders are used, all of which put tokens of a single
document first: by document frequency, by one random key, and by frequency
class with another random key.  A candidate pair meets in all three.

1. Every task hashes its texts' shingles and sends them, sorted and packed, to
   hash buckets; a bucket counts the documents of each token and answers with
   the tokens that two or more documents hold.  Single-document tokens match
   nothing and are never written out.
2. A document whose single-document tokens exceed its prefix is out.  The rest
   ("survivors") get their three prefixes.
3. Candidates are not all pairs of a posting list: members are paired with a
   pivot of their list, filtered by the other orders and sizes, verified
   exactly, and merged into components.  Members already in one component need
   no further pair.  While many places would have to be looked at, rounds try
   each list's open members against ``PIVOTS`` members drawn for that list: rows
   in proportion to the postings.  At the end every pair of members that still
   are in different components is verified, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .base import skew_join, written
from .components import components
from .packed import pack, unpack

WORDS = 5
NUM, DEN = 3, 4                  # similarity of at least NUM / DEN
TOKEN_BITS = 40                  # kept of a hash beside its bucket
BUCKET_TOKENS = 1 << 20
CHUNK_BYTES = 8 << 20
STAR_ROUNDS = 3
PIVOTS = 16                       # members of a list that the others are tried against in a round
LOOKS = 8                         # list places looked at per posting before another round with pivots is the cheaper way


def _info(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = W.text_buffer(batch.column(1))
        for a, b in W.slices(offsets):
            d, h, _ = W.distinct_shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], k)
            n = np.bincount(d, minlength=b - a)
            s = [np.zeros(b - a, dtype=np.uint64) for _ in range(2)]
            for j, seed in enumerate((0x1234567, 0x89ABCDEF)):
                np.add.at(s[j], d, W.mix(h ^ np.uint64(seed)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(s[0].view(np.int64)), pa.array(s[1].view(np.int64))],
                names=["id", "n", "s1", "s2"])


def shingle_info(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, n, s1, s2) per row: the set's size and a 128-bit signature of the set."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("n", T.LongType()),
                           T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType())])
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(lambda it: W.tidy(_info(it, k)), schema))


def _send(batches: Iterator[pa.RecordBatch], k: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed (token, document) entries, one row per chunk of texts and bucket."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        data, offsets = W.text_buffer(batch.column(1))
        for lo, hi in W.slices(offsets, CHUNK_BYTES):
            hs, ds = [], []
            for a, b in W.slices(offsets[lo:hi + 1]):
                a, b = lo + a, lo + b
                d, h, _ = W.distinct_shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], k)
                hs.append(h)
                ds.append(ids[a + d])
            h, d = np.concatenate(hs), np.concatenate(ds).astype(np.int64)
            bucket = ((h & np.uint64(0xFFFFFF)) * np.uint64(buckets)) >> np.uint64(24)
            token = (bucket << np.uint64(TOKEN_BITS)) | (h >> np.uint64(64 - TOKEN_BITS))
            order = np.argsort(token)
            token, d = token[order], d[order]
            edges = np.searchsorted(token >> np.uint64(TOKEN_BITS), np.arange(buckets + 1, dtype=np.uint64))
            full = np.flatnonzero(np.diff(edges))
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()),
                 pa.array([pack(token[edges[i]:edges[i + 1]], ascending=True) for i in full], pa.binary()),
                 pa.array([pack(d[edges[i]:edges[i + 1]].view(np.uint64)) for i in full], pa.binary())],
                names=["bucket", "tokens", "docs"])


def _count(key, table: pa.Table, parts: int) -> pa.Table:
    """A bucket's tokens that two or more documents hold, packed by part of the documents."""
    token = np.concatenate([unpack(b.as_py()) for b in table.column("tokens")])
    doc = np.concatenate([unpack(b.as_py()) for b in table.column("docs")]).view(np.int64)
    order = np.lexsort((doc, token))
    token, doc = token[order], doc[order]
    same = np.zeros(len(token), bool)
    same[1:] = token[1:] == token[:-1]
    again = same.copy()
    again[1:] &= doc[1:] == doc[:-1]
    token, doc = token[~again], doc[~again]
    new = np.ones(len(token), bool)
    new[1:] = token[1:] != token[:-1]
    run = np.cumsum(new) - 1
    df = np.bincount(run)[run] if len(run) else run
    shared = df >= 2
    token, doc, df = token[shared], doc[shared], df[shared]
    part = (W.mix(doc.view(np.uint64)) >> np.uint64(33)).astype(np.int64) % parts
    order = np.argsort(part, kind="stable")
    token, doc, df, part = token[order], doc[order], df[order], part[order]
    edges = np.searchsorted(part, np.arange(parts + 1))
    full = np.flatnonzero(np.diff(edges))
    cut = [(edges[i], edges[i + 1]) for i in full]
    return pa.table({"part": pa.array(full, pa.int32()),
                     "tokens": pa.array([pack(token[a:b], ascending=True) for a, b in cut], pa.binary()),
                     "docs": pa.array([pack(doc[a:b].view(np.uint64)) for a, b in cut], pa.binary()),
                     "df": pa.array([pack(df[a:b].astype(np.uint64)) for a, b in cut], pa.binary())})


def _survive(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents that can have a link, with their shared tokens and the prefixes under three orders."""
    out = {c: [] for c in ("doc", "n", "tokens", "first", "second", "third")}
    if right.num_rows and left.num_rows:
        token = np.concatenate([unpack(b.as_py()) for b in right.column("tokens")])
        doc = np.concatenate([unpack(b.as_py()) for b in right.column("docs")]).view(np.int64)
        df = np.concatenate([unpack(b.as_py()) for b in right.column("df")]).astype(np.int64)
        order = np.lexsort((token, doc))
        token, doc, df = token[order], doc[order], df[order]
        ids, size = left.column("id").to_numpy(), left.column("n").to_numpy()
        lo, hi = np.searchsorted(doc, ids), np.searchsorted(doc, ids, side="right")
        need = -(-NUM * size // DEN)
        for i in np.flatnonzero((hi - lo >= need) & (size > 0)):
            t, f = token[lo[i]:hi[i]], df[lo[i]:hi[i]]
            p = int(len(t) - need[i] + 1)
            second, third = W.mix(t ^ np.uint64(0x5EED)), W.mix(t ^ np.uint64(0xFACADE))
            orders = (np.lexsort((t, f)), np.argsort(second), np.lexsort((third, np.log2(f).astype(int))))
            out["doc"].append(int(ids[i]))
            out["n"].append(int(size[i]))
            out["tokens"].append(t.view(np.int64))
            for name, o in zip(("first", "second", "third"), orders):
                out[name].append(t[o[:p]].view(np.int64))
    longs = pa.list_(pa.int64())
    return pa.table({"doc": pa.array(out["doc"], pa.int64()), "n": pa.array(out["n"], pa.int64()),
                     **{c: pa.array(out[c], longs) for c in ("tokens", "first", "second", "third")}})


SURVIVOR = "doc long, n long, tokens array<long>, first array<long>, second array<long>, third array<long>"


def survivors(docs: DataFrame, info: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """One row per representative that may have a link (see ``_survive``)."""
    spark = docs.sparkSession
    tokens = info.agg(F.sum("n")).first()[0] or 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(1 << 22, max(width, -(-tokens // BUCKET_TOKENS)))
    parts = buckets
    sent = (docs.filter(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(lambda it: W.tidy(_send(it, k, buckets)), "bucket int, tokens binary, docs binary"))
    shared = sent.groupBy("bucket").applyInArrow(lambda key, t: _count(key, t, parts),
                                                 "part int, tokens binary, docs binary, df binary")
    reps = info.groupBy("s1", "s2", "n").agg(F.min("id").cast("long").alias("id")).filter("n > 0 and id is not null")
    reps = reps.mapInArrow(lambda it: _with_part(it, parts), "part int, id long, n long")
    return reps.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(_survive, SURVIVOR)


def _with_part(batches, parts):
    for b in batches:
        ids = b.column(b.schema.get_field_index("id"))
        part = (W.mix(ids.to_numpy().astype(np.int64).view(np.uint64)) >> np.uint64(33)).astype(np.int64) % parts
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), ids, b.column(b.schema.get_field_index("n"))],
                                         names=["part", "id", "n"])


def _least(n, m):
    """Tokens that sets of n and m tokens must share: ceil(t / (1 + t) * (n + m))."""
    return F.ceil(F.lit(NUM) * (n + m) / F.lit(NUM + DEN)).cast("long")


def _meets(n, pos, m, other):
    """The pair's first common token can be this one, at ``pos`` of n and at ``other`` of m tokens.

    All common tokens come at or after the first one, so enough places must be left in both sets.
    """
    need = _least(F.col(n), F.col(m))
    return (F.col(n) - F.col(pos) >= need) & (F.col(m) - F.col(other) >= need)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that meet under the second and third order and whose similarity is high enough.

    A document may be in very many pairs (a pivot of a large group): those few are broadcast.
    """
    total = max(1, pairs.count())

    def fetch(rows, cols, side, of):
        per = of.groupBy(side).agg(F.count(F.lit(1)).alias("__n"))
        table = sets.select(F.col("doc").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in cols], F.size("tokens").alias(f"{side}_c")).join(per, side)
        return skew_join(rows, table, [side], "__n", total, share=100).drop("__n")

    def prefix(side, order):        # what the order puts first in this pair's prefix, after the single-document tokens
        return F.slice(f"{side}_{order}", F.lit(1), F.greatest(F.col(f"{side}_c") - F.col("__need") + 1, F.lit(0)).cast("int"))

    met = pairs
    for side in "ab":
        met = fetch(met, ["n", "second", "third"], side, pairs)
    met = met.withColumn("__need", _least(F.col("a_n"), F.col("b_n")))
    met = written(met.filter(F.arrays_overlap(prefix("a", "second"), prefix("b", "second"))
                             & F.arrays_overlap(prefix("a", "third"), prefix("b", "third"))).select("a", "b"), "met")
    total = max(1, met.count())
    full = met
    for side in "ab":
        full = fetch(full, ["n", "tokens"], side, met)
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return full.filter(common >= _least(F.col("a_n"), F.col("b_n"))).select("a", "b")


def _pair(x, y):
    return [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]


def links_to_components(sets: DataFrame) -> DataFrame:
    """(node, component) of the linked documents."""
    posts = sets.select("doc", "n", F.size("tokens").alias("c"), F.posexplode("first").alias("at", "token"))
    posts = written(posts.select("token", "doc", "n", (F.col("n") - F.col("c") + F.col("at")).alias("pos")), "posts")
    # In every pair the token is early enough in one of the two (the smaller set) for a partner of its own size.
    early = F.col("n") - F.col("pos") >= _least(F.col("n"), F.col("n"))
    lists = (posts.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min(F.when(early, F.struct("doc", "n", "pos"))).alias("p"))
             .filter("size > 1 and p is not null").select("token", "size", F.col("p.doc").alias("by"), F.col("p.n").alias("by_n"), F.col("p.pos").alias("by_pos")))
    total = max(1, posts.count())
    posts = written(skew_join(posts, lists, ["token"], "size", total), "posts")
    total = max(1, posts.count())
    tried = written(posts.filter(F.col("doc") != F.col("by")).filter(_meets("n", "pos", "by_n", "by_pos")).select(*_pair("doc", "by")).distinct(), "tried")
    links = written(_verified(tried, sets), "links")
    comps = written(components(links), "comps")
    for r in range(1, STAR_ROUNDS + 1):
        label = posts.join(comps, posts["doc"] == comps["node"], "left").select(
            "token", "doc", "n", "pos", F.coalesce("component", "doc").alias("comp"))
        mixed = (label.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
                 .groupBy("token").agg(F.max("c").alias("most"), F.max_by("comp", F.struct("c", "comp")).alias("base"),
                                       F.count(F.lit(1)).alias("comps"), F.sum("c").alias("size")).filter("comps > 1")
                 .select("token", "base", "size", (F.col("size") - F.col("most")).alias("outside")))
        drawn = (label.withColumn("key", F.xxhash64(F.lit(r), "token", "doc"))
                 .groupBy("token", F.pmod("key", F.lit(PIVOTS)).alias("slot"))
                 .agg(F.min_by(F.struct(F.col("doc").alias("by"), F.col("n").alias("by_n"), F.col("pos").alias("by_pos"), F.col("comp").alias("by_comp")), "key").alias("by"))
                 .groupBy("token").agg(F.collect_list("by").alias("pivots")))     # PIVOTS at most
        mixed = mixed.join(drawn, "token")
        mixed = written(mixed, "mixed")
        sums = mixed.agg(F.sum("size"), F.sum(F.col("size") * F.col("outside"))).first()
        if not sums[0]:
            break
        last = r == STAR_ROUNDS or sums[1] <= LOOKS * total       # few enough places to look at them all
        open_ = written(skew_join(label, mixed, ["token"], "size", sums[0]), "open")
        out = open_.filter("comp <> base")
        if last:    # every pair that is still in two components; one of the two is outside the list's largest
            left = out.select("token", F.col("doc").alias("x"), F.col("comp").alias("xc"), F.col("n").alias("xn"), F.col("pos").alias("xp"))
            right = open_.select("token", F.col("doc").alias("y"), F.col("comp").alias("yc"), F.col("n").alias("yn"), F.col("pos").alias("yp"))
            new = left.join(right, (left["token"] == right["token"]) & (F.col("xc") != F.col("yc")) & _meets("xn", "xp", "yn", "yp")).select(*_pair("x", "y"))
        else:
            new = (open_.select("doc", "n", "pos", "comp", F.inline("pivots")).filter("by_comp <> comp")
                   .filter(_meets("n", "pos", "by_n", "by_pos")).select(*_pair("doc", "by")))
        new = written(new.distinct().join(tried, ["a", "b"], "left_anti"), "tried")
        found = written(_verified(new, sets), "links")
        if found.take(1):
            links = links.unionByName(found)
            comps = written(components(links), "comps")
        if last:
            break
        tried = tried.unionByName(new)
    return comps


def one_per_id(docs: DataFrame, info: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with one row per id: of rows that share an id the largest text.  ``info`` has a row per row."""
    again = written(info.groupBy("id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1 and id is not null").select("id"), "again")
    if not again.take(1):
        return docs
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    merged = plain.join(again, "id", "left_semi").groupBy("id").agg(F.max("text").alias("text"))
    return (plain.join(again, "id", "left_anti").unionByName(merged)
            .select(F.col("id").alias(id_col), F.col("text").alias(text_col)))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text with A-Z lower-cased.  Documents link
    when their shingle sets have a Jaccard similarity of NUM / DEN or more; component_id is the smallest
    id reachable by links.

    Defined cases: a null, empty or blank text has no shingles and links with
    nothing; texts of fewer than ``k`` words have their whole sequence as one
    shingle; rows that share an id are one document with the largest of their
    texts; a null id is in no component (null); an empty table gives an empty
    one; further columns of ``docs`` are not looked at.  Ids are integers.
    """
    rows = info = written(shingle_info(docs, id_col, text_col, k), "info")
    single = one_per_id(docs, rows, id_col, text_col)
    if single is not docs:
        docs = single
        info = written(shingle_info(docs, id_col, text_col, k).unionByName(rows.filter("id is null")), "info")
    sets = written(survivors(docs, info, id_col, text_col, k), "sets")
    comps = links_to_components(sets)
    classes = info.filter("n > 0 and id is not null").groupBy("s1", "s2", "n").agg(F.min("id").cast("long").alias("rep"))
    named = classes.join(comps, classes["rep"] == comps["node"], "left").select(
        "s1", "s2", "n", F.coalesce("component", "rep").alias("component_id"))
    return _attach(rows, info, named, id_col)


def _attach(rows: DataFrame, info: DataFrame, named: DataFrame, id_col: str) -> DataFrame:
    """Give each row the component of its document's shingle set."""
    total = max(1, info.count())
    sizes = info.filter("n > 0 and id is not null").groupBy("s1", "s2", "n").agg(F.count(F.lit(1)).alias("copies"))
    lookup = named.join(sizes, ["s1", "s2", "n"])
    full = info.filter("n > 0 and id is not null")
    member = skew_join(full, lookup, ["s1", "s2", "n"], "copies", total).select("id", "n", "component_id")
    alone = info.filter("n = 0 or id is null").select("id", "n", F.col("id").cast("long").alias("component_id"))
    found = member.unionByName(alone)
    if rows is not info:
        found = rows.select("id").join(found.filter("id is not null"), "id").unionByName(found.filter("id is null"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
