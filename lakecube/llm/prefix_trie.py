"""Conversation prefix trie (operator 11): subtree leaves and savings by an Euler tour.

1. Turns are numbered within their conversation and the rebuilt conversations
   formed.  A prefix's fingerprint is a running sum over its turns' MD5 halves (two
   polynomials modulo 2**64), so one conversation may lie in many parts.
2. A node is a distinct (depth, fingerprint).  Its smallest member and its
   depth name it from then on: nodes of one depth share no member.
3. Every node has an enter and an exit arc.  The tour enters a node, then its
   children in the order of their ``conv_id``, and exits it.  Arcs are ranked
   as a linked list (``list_ranking``) with the weights 1, leaf and saved
   tokens; a subtree's sums are the difference between its node's exit and enter arc.
   The first round works on whole nodes: where both arcs fall into one run, the
   subtree lies in one part and is settled there.
4. The members that end at a node are sorted and streamed into its SHA-256, one id
   at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .base import skew_join, written
from .list_ranking import KEY, NEXT, ROW, RUN, WEIGHTS, _ints, _longs, find, link, rank
from .scan import PART_ROWS, next_in_order, ranged

GROUP = 20              # conversations c - c % GROUP .. share their first turns
TURNS = 4               # the first h turns, h = crc32(c) % TURNS
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
NODE = 2


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, turn, tag, words): a turn's MD5 and how many words its text has."""
    for batch in batches:
        roles, texts = (batch.column(i).fill_null("") for i in (2, 3))
        tags = []
        for role, text in zip(roles.to_pylist(), texts.to_pylist()):
            tags.append(hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest())
        n_words = []
        data, offsets = W.text_buffer(texts)
        for a, b in W.slices(offsets):
            _, _, doc = W.words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            n_words.append(np.bincount(doc, minlength=b - a))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(tags, pa.binary()),
             pa.array(np.concatenate(n_words) if n_words else np.zeros(0, np.int64), pa.int64())], names=["conv", "turn", "tag", "words"])


def numbered_turns(conversations: DataFrame, part_rows: int) -> DataFrame:
    """(part, conv, pos, tag, words, n_own): every turn's place in its conversation, and how many it has."""
    rows = (conversations.filter(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                    F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_turns, "conv long, turn long, tag binary, words long"))
    rows = ranged(written(rows, "turns"), ["conv", "turn", "tag"], "turns", part_rows=part_rows)
    # A conversation has one row here for each part that holds some of it.
    held = written(rows.groupBy("part", "conv").agg(F.count(F.lit(1)).alias("n")), "held")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("part", "conv", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                       F.sum("n").over(Window.partitionBy("conv")).alias("n_own"))
    at = F.row_number().over(Window.partitionBy("part", "conv").orderBy("turn", "tag")) - 1
    return written(rows.withColumn("at", at).join(held, ["part", "conv"])
                   .select("part", "conv", (F.col("at") + F.col("before")).alias("pos"), "tag", "words", "n_own"), "numbered")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, pos, tag, words, last) of the rebuilt conversations, and (conv, n_turns) of each."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % TURNS
    convs = turns.filter("pos = 0").select("conv", "n_own", h.alias("h"), (F.col("conv") - F.col("conv") % GROUP).alias("base"))
    bases = convs.filter("conv = base").select("base", F.col("n_own").alias("n_base"))
    convs = (convs.join(bases, "base", "left")
             .withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
             .withColumn("n_turns", F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))))
    convs = written(convs.select("conv", "base", "h", "taken", "n_turns"), "convs")
    first = turns.filter((F.col("conv") % GROUP == 0) & (F.col("pos") < TURNS - 1)).select(F.col("conv").alias("base"), "pos", "tag", "words")
    shared = (convs.join(first, "base").filter(F.col("pos") < F.col("taken"))
              .select("conv", "pos", "tag", "words", (F.col("pos") + 1 == F.col("n_turns")).alias("last")))
    # Joined on (part, conv): no key has more rows than a part.
    places = turns.select("part", "conv").distinct().join(convs, "conv")
    own = (turns.join(places, ["part", "conv"]).filter(F.col("pos") >= F.col("h"))
           .withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
           .select("conv", "pos", "tag", "words", (F.col("pos") + 1 == F.col("n_turns")).alias("last")))
    return shared.unionByName(own), convs.select("conv", "n_turns")


def _powers(base: np.uint64, e: np.ndarray) -> np.ndarray:
    out, square, e = np.ones(len(e), np.uint64), base, e.astype(np.uint64)
    while e.any():
        out = np.where(e & np.uint64(1), out * square, out)
        with np.errstate(over="ignore"):
            square = square * square
        e = e >> np.uint64(1)
    return out


def _sums(table: pa.Table) -> pa.Table:
    """Running fingerprints within the part; ``carry`` marks a conversation's last row in it."""
    conv, pos = table.column("conv").to_numpy(), table.column("pos").to_numpy()
    order = np.lexsort((pos, conv))
    table = table.take(pa.array(order))
    conv, pos = conv[order], pos[order]
    new = np.ones(len(conv), bool)
    new[1:] = conv[1:] != conv[:-1]
    start = np.flatnonzero(new)[np.cumsum(new) - 1]
    tag = np.frombuffer(b"".join(table.column("tag").to_pylist()), dtype="<u8").reshape(-1, 2)
    cols = {}
    for j, name in enumerate("ab"):
        term = W.mix(tag[:, j].copy()) * _powers(BASES[j], pos)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)])
        cols["f" + name] = (total[1:] - total[start]).view(np.int64)
        cols["t" + name] = term.view(np.int64)
    end = np.ones(len(conv), bool)
    end[:-1] = new[1:]
    return pa.table({"part": table.column("part"), "conv": _longs(conv), "depth": _longs(pos + 1), "words": table.column("words"),
                     "last": table.column("last"), "carry": pa.array(end), **{n: _longs(x) for n, x in cols.items()}})


def _carried(table: pa.Table) -> pa.Table:
    """A conversation's sums from all parts before each part that holds some of it."""
    table = table.sort_by("part")
    cols = {}
    for name in ("fa", "fb"):
        x = np.cumsum(table.column(name).to_numpy().view(np.uint64), dtype=np.uint64)
        cols["c" + name[1]] = _longs(np.concatenate([np.zeros(1, np.uint64), x[:-1]]).view(np.int64))
    return pa.table({"part": table.column("part"), "conv": table.column("conv"), **cols})


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        col = {n: b.column(b.schema.get_field_index(n)) for n in b.schema.names}
        out = {}
        for j in "ab":
            f, t, c = (col[p + j].fill_null(0).to_numpy().view(np.uint64) for p in "ftc")
            out["f" + j] = _longs((f + c).view(np.int64))
            out["p" + j] = _longs((f + c - t).view(np.int64))
        yield pa.RecordBatch.from_arrays([col["conv"], col["depth"], col["words"], col["last"], out["fa"], out["fb"], out["pa"], out["pb"]],
                                         names=["conv", "depth", "words", "last", "fa", "fb", "pa", "pb"])


def prefixes(turns: DataFrame, part_rows: int) -> DataFrame:
    """(conv, depth, words, last, fa, fb, pa, pb): fingerprints of each prefix and of the one before it."""
    rows = ranged(written(turns, "rebuilt"), ["conv", "pos"], "rebuilt", part_rows=part_rows)
    sums = "part int, conv long, depth long, words long, last boolean, carry boolean, fa long, fb long, ta long, tb long"
    rows = written(rows.groupBy("part").applyInArrow(_sums, sums), "sums")
    ends = rows.filter("carry").select("part", "conv", "fa", "fb")
    # Only a part's first conversation can have begun before it: one row per part at most, or none.
    starts = rows.groupBy("part").agg(F.min("conv").alias("conv"))
    spread = ends.join(F.broadcast(ends.join(starts, ["part", "conv"], "left_semi").select("conv").distinct()), "conv", "left_semi")
    carry = spread.groupBy("conv").applyInArrow(_carried, "part int, conv long, ca long, cb long")
    carry = written(carry.filter("ca <> 0 or cb <> 0"), "carry")
    return written(rows.join(F.broadcast(carry), ["part", "conv"], "left").mapInArrow(
        _add, "conv long, depth long, words long, last boolean, fa long, fb long, pa long, pb long"), "prefixes")


def nodes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, fa, fb, conv, parent, n_convs, n_children, first_child, saved) of every node, the root included."""
    zero = F.lit(0).cast("long")
    plain = rows.groupBy("depth", "fa", "fb").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("depth"), zero.alias("fa"), zero.alias("fb"), "conv", "n_convs", zero.alias("words"), zero.alias("pa"), zero.alias("pb"))
    found = written(plain.unionByName(root), "nodes")
    kids = (found.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("fa"), F.col("pb").alias("fb"))
            .agg(F.count(F.lit(1)).alias("n_children"), F.min("conv").alias("first_child")))
    found = written(found.join(kids, ["depth", "fa", "fb"], "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes")
    above = found.filter("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("fa").alias("pa"), F.col("fb").alias("pb"),
                                                  F.col("conv").alias("parent"), F.col("n_children").alias("__n"))
    below = found.filter("depth > 0")
    named = skew_join(below, above, ["depth", "pa", "pb"], "__n", max(1, below.count())).drop("__n")
    named = named.unionByName(found.filter("depth = 0").withColumn("parent", F.lit(None).cast("long")))
    return written(named.select("depth", "fa", "fb", "conv", "parent", "n_convs", "n_children", "first_child",
                                ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "nodes")


TOUR = ROW + ", xc long, xd long, xk int, x_pos long, x_leaves long, x_saved long"


def _tour(table: pa.Table) -> pa.Table:
    """Both arcs of a part's nodes, linked into runs.

    NODE rows: the head of the enter arc's run and the offset from it (h.., weights), and the same of the exit arc (x..).
    RUN rows: the shorter list.
    """
    col = {n: table.column(n).combine_chunks().fill_null(0).to_numpy().astype(np.int64)
           for n in ("conv", "depth", "parent", "first_child", "n_children", "saved", "next")}
    has_next, has_parent = (~np.asarray(table.column(n).is_null()) for n in ("next", "parent"))
    n = len(col["conv"])
    leaf = col["n_children"] == 0
    # arc 2i enters node i, arc 2i + 1 leaves it
    c, d, k = np.repeat(col["conv"], 2), np.repeat(col["depth"], 2), np.tile([0, 1], n)
    nc, nd, nk, none = np.empty(2 * n, np.int64), np.empty(2 * n, np.int64), np.empty(2 * n, np.int64), np.zeros(2 * n, bool)
    nc[0::2] = np.where(leaf, col["conv"], col["first_child"])
    nd[0::2] = np.where(leaf, col["depth"], col["depth"] + 1)
    nk[0::2] = leaf
    nc[1::2] = np.where(has_next, col["next"], col["parent"])
    nd[1::2] = np.where(has_next, col["depth"], col["depth"] - 1)
    nk[1::2] = ~has_next
    none[1::2] = ~has_next & ~has_parent
    w = [np.ones(2 * n, np.int64), np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int64)]
    w[1][0::2], w[2][0::2] = leaf, col["saved"]
    at = find(col["conv"], col["depth"], nc, nd)
    head, off, tail = link(np.where(none | (at < 0), -1, 2 * at + nk), w)
    heads = np.flatnonzero(head == np.arange(2 * n))
    end = tail[heads]
    e, x = np.arange(0, 2 * n, 2), np.arange(1, 2 * n, 2)
    node = pa.table({
        "kind": _ints(np.full(n, NODE)), "c": _longs(col["conv"]), "d": _longs(col["depth"]), "k": pa.nulls(n, pa.int32()),
        "nc": pa.nulls(n, pa.int64()), "nd": pa.nulls(n, pa.int64()), "nk": pa.nulls(n, pa.int32()),
        "hc": _longs(c[head[e]]), "hd": _longs(d[head[e]]), "hk": _ints(k[head[e]]), **{m: _longs(o[e]) for m, o in zip(WEIGHTS, off)},
        "xc": _longs(c[head[x]]), "xd": _longs(d[head[x]]), "xk": _ints(k[head[x]]), **{"x_" + m: _longs(o[x]) for m, o in zip(WEIGHTS, off)}})
    m = len(heads)
    run = pa.table({
        "kind": _ints(np.full(m, RUN)), "c": _longs(c[heads]), "d": _longs(d[heads]), "k": _ints(k[heads]),
        "nc": _longs(nc[end], none[end]), "nd": _longs(nd[end], none[end]), "nk": _ints(nk[end], none[end]),
        "hc": pa.nulls(m, pa.int64()), "hd": pa.nulls(m, pa.int64()), "hk": pa.nulls(m, pa.int32()),
        **{name: _longs(off[j][end] + w[j][end]) for j, name in enumerate(WEIGHTS)},
        "xc": pa.nulls(m, pa.int64()), "xd": pa.nulls(m, pa.int64()), "xk": pa.nulls(m, pa.int32()),
        **{"x_" + name: pa.nulls(m, pa.int64()) for name in WEIGHTS}})
    return pa.concat_tables([node, run])


def euler_tour(found: DataFrame, part_rows: int) -> DataFrame:
    """(conv, depth, enter, exit, n_leaves, saved_tokens) of every node: arc positions and subtree sums."""
    order = ["depth", "parent", "conv"]
    kept = ["parent", "conv", "depth", "first_child", "n_children", "saved"]
    sorted_ = ranged(found.select(*kept), order, "siblings", part_rows=part_rows)
    after = next_in_order(sorted_, order, "after")
    same = (F.col("after.depth") == F.col("depth")) & F.col("after.parent").eqNullSafe(F.col("parent"))
    arcs = written(after.select(*kept, F.when(same, F.col("after.conv")).alias("next")), "arcs")
    out = written(ranged(arcs, ["conv", "depth"], "tour", part_rows=part_rows).groupBy("part").applyInArrow(_tour, TOUR), "tour")
    ranks = rank(out.filter(F.col("kind") == RUN).select(*KEY, *NEXT, *WEIGHTS), part_rows)
    node = out.filter(F.col("kind") == NODE)
    within = (F.col("hc") == F.col("xc")) & (F.col("hd") == F.col("xd")) & (F.col("hk") == F.col("xk"))
    for side, cols in (("e", ["hc", "hd", "hk"]), ("x", ["xc", "xd", "xk"])):
        node = node.join(ranks.select(*[F.col(a).alias(b) for a, b in zip(KEY, cols)], *[F.col(m).alias(f"{side}r_{m}") for m in WEIGHTS]), cols)
    def sums(m):
        inside = F.col(f"x_{m}") - F.col(m)
        return F.when(within, inside).otherwise(inside + F.col(f"xr_{m}") - F.col(f"er_{m}"))
    return node.select(F.col("c").alias("conv"), F.col("d").alias("depth"), (F.col("pos") + F.col("er_pos")).alias("enter"),
                       (F.col("x_pos") + F.col("xr_pos")).alias("exit"), sums("leaves").alias("n_leaves"), sums("saved").alias("saved_tokens"))


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per run of equal nodes; only the running hash is held."""
    now, digest, out = None, None, []

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], pa.int64()) for i in range(3)] + [pa.array([r[3] for r in out], pa.string())],
            names=["depth", "fa", "fb", "sha"])

    for b in batches:
        key = np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)
        ids = b.column(3).to_pylist()
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(key)]):
            if lo == hi:
                continue
            k = tuple(key[lo].tolist())
            text = ",".join(map(str, ids[lo:hi])).encode()
            if k == now:
                digest.update(b"," + text)
                continue
            if now is not None:
                out.append((*now, digest.hexdigest()))
            now, digest = k, hashlib.sha256(text)
        if len(out) >= 10_000:
            yield flush()
            out.clear()
    if now is not None:
        out.append((*now, digest.hexdigest()))
    if out:
        yield flush()


def conversation_trie(conversations: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per node of the trie of the rebuilt ``conversations`` (conv_id, turn, role, text).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, and the tour's ``enter`` and ``exit`` positions.

    Defined cases: a null role or text is empty; null turns come first, turns
    of equal number are ordered by the MD5 of role and text, and repeated rows
    are turns of their own; rows with a null conv_id are left out; an empty
    table gives an empty one; further columns are not looked at.  A very long
    text costs memory in proportion to it in one task, a very long
    conversation does not: its turns are spread over parts.  Prefixes are
    equal when their 128-bit fingerprints are.
    """
    rebuilt_turns, convs = rebuilt(numbered_turns(conversations, part_rows))
    rows = prefixes(rebuilt_turns, part_rows)
    found = nodes(rows, convs)
    zero = F.lit(0).cast("long")
    ends = (rows.filter("last").select("depth", "fa", "fb", "conv")
            .unionByName(convs.filter("n_turns = 0").select(zero.alias("depth"), zero.alias("fa"), zero.alias("fb"), "conv")))
    width = max(int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-convs.count() // part_rows))
    ends = (ends.repartition(width, "depth", "fa", "fb").sortWithinPartitions("depth", "fa", "fb", "conv")
            .mapInArrow(_hash_ends, "depth long, fa long, fb long, sha string"))
    out = found.join(ends, ["depth", "fa", "fb"], "left").join(euler_tour(found, part_rows), ["conv", "depth"])
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                      "saved_tokens", F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), "enter", "exit")
