"""Weighted list ranking of a linked list that lies in a distributed table.

An element has a key ``(c, d, k)``, the key of its successor (null at the end)
and weights.  Ranking gives every element the sum of the weights before it.

1. Elements are range-sorted on their keys into bounded parts.  A task links
   the elements of its part that follow each other into runs (pointer jumping
   in numpy), and every element learns its run's head and its offset from it.
   A run goes on as one element of a shorter list.
2. Where keys say little about the order, runs stay short.  Then a round of random mates follows: an element
   that draws heads swallows a successor that draws tails, a quarter of all on average.
3. Once one part holds the list, its only run has the offset 0, and the rounds
   are undone in reverse: position of the head plus offset.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import written
from .scan import PART_ROWS, ranged

KEY, NEXT, HEAD = ["c", "d", "k"], ["nc", "nd", "nk"], ["hc", "hd", "hk"]
WEIGHTS = ["pos", "leaves", "saved"]
ROW = ("kind int, c long, d long, k int, nc long, nd long, nk int, hc long, hd long, hk int, "
       "pos long, leaves long, saved long")
RUN, MEMBER = 0, 1


def find(c: np.ndarray, d: np.ndarray, qc: np.ndarray, qd: np.ndarray) -> np.ndarray:
    """Row of each (qc, qd) among the distinct pairs (c, d), -1 where there is none."""
    us, ds = np.unique(c), np.unique(d)
    if not len(us):
        return np.full(len(qc), -1)
    code = np.searchsorted(us, c) * len(ds) + np.searchsorted(ds, d)
    ic, id_ = np.minimum(np.searchsorted(us, qc), len(us) - 1), np.minimum(np.searchsorted(ds, qd), len(ds) - 1)
    wanted = ic * len(ds) + id_
    order = np.argsort(code)
    at = np.minimum(np.searchsorted(code[order], wanted), len(code) - 1)
    row = order[at]
    return np.where((us[ic] == qc) & (ds[id_] == qd) & (code[row] == wanted), row, -1)


def link(succ: np.ndarray, weights: list[np.ndarray]):
    """(head, offsets, tail) of every element of the runs that ``succ`` (-1: none here) makes up."""
    n = len(succ)
    ptr = np.arange(n)
    has = np.flatnonzero(succ >= 0)
    ptr[succ[has]] = has                                   # predecessors; heads point at themselves
    off = [np.where(ptr != np.arange(n), w[ptr], 0) for w in weights]
    while True:
        far = ptr[ptr]
        if np.array_equal(far, ptr):
            break
        off = [o + o[ptr] for o in off]
        ptr = far
    tail = np.full(n, -1)
    ends = np.flatnonzero(succ < 0)
    tail[ptr[ends]] = ends
    return ptr, off, tail


def _longs(x, empty=None):
    return pa.array(x, pa.int64(), mask=empty)


def _ints(x, empty=None):
    return pa.array(np.asarray(x).astype(np.int32), pa.int32(), mask=empty)


def _contract(table: pa.Table) -> pa.Table:
    col = {n: table.column(n).combine_chunks() for n in KEY + WEIGHTS}
    c, d, k = (col[n].to_numpy().astype(np.int64) for n in KEY)
    w = [col[n].to_numpy() for n in WEIGHTS]
    none = np.asarray(table.column("nc").is_null())
    nc, nd, nk = (table.column(n).combine_chunks().fill_null(0).to_numpy().astype(np.int64) for n in NEXT)
    succ = np.where(none, -1, find(c, d * 2 + k, nc, nd * 2 + nk))
    head, off, tail = link(succ, w)
    heads = np.flatnonzero(head == np.arange(len(head)))
    end = tail[heads]
    members = pa.table({
        "kind": _ints(np.full(len(c), MEMBER)), "c": _longs(c), "d": _longs(d), "k": _ints(k),
        "nc": pa.nulls(len(c), pa.int64()), "nd": pa.nulls(len(c), pa.int64()), "nk": pa.nulls(len(c), pa.int32()),
        "hc": _longs(c[head]), "hd": _longs(d[head]), "hk": _ints(k[head]), **{n: _longs(o) for n, o in zip(WEIGHTS, off)}})
    runs = pa.table({
        "kind": _ints(np.full(len(heads), RUN)), "c": _longs(c[heads]), "d": _longs(d[heads]), "k": _ints(k[heads]),
        "nc": _longs(nc[end], none[end]), "nd": _longs(nd[end], none[end]), "nk": _ints(nk[end], none[end]),
        "hc": pa.nulls(len(heads), pa.int64()), "hd": pa.nulls(len(heads), pa.int64()), "hk": pa.nulls(len(heads), pa.int32()),
        **{n: _longs(off[j][end] + w[j][end]) for j, n in enumerate(WEIGHTS)}})
    return pa.concat_tables([members, runs])


def contract(elements: DataFrame, rows: int, part_rows: int) -> tuple[DataFrame, DataFrame]:
    """(members, runs): each element's head and offset from it, and the shorter list of runs."""
    parts = ranged(elements, KEY, "list", rows, part_rows)
    out = written(parts.groupBy("part").applyInArrow(_contract, ROW), "runs")
    return out.filter(F.col("kind") == MEMBER).select(*KEY, *HEAD, *WEIGHTS), out.filter(F.col("kind") == RUN).select(*KEY, *NEXT, *WEIGHTS)


def splice(elements: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(members, runs) as ``contract``, by random mates."""
    def heads(cols):
        return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(2)) == 0
    tails = elements.filter(~heads(KEY)).select(
        *[F.col(a).alias(b) for a, b in zip(KEY, NEXT)], *[F.col(n).alias(f"t_{n}") for n in NEXT + WEIGHTS])
    p = elements.filter(heads(KEY))
    pairs = written(p.join(tails, NEXT), "pairs")
    gone = pairs.select(*[F.col(b).alias(a) for a, b in zip(KEY, NEXT)], *[F.col(a).alias(b) for a, b in zip(KEY, HEAD)], *WEIGHTS)
    stay = elements.join(gone.select(*KEY), KEY, "left_anti")
    members = stay.select(*KEY, *[F.col(a).alias(b) for a, b in zip(KEY, HEAD)], *[F.lit(0).cast("long").alias(n) for n in WEIGHTS])
    grown = pairs.select(*KEY, *[F.col(f"t_{n}").alias(n) for n in NEXT], *[(F.col(n) + F.col(f"t_{n}")).alias(n) for n in WEIGHTS])
    alone = stay.join(pairs.select(*KEY), KEY, "left_anti").select(*KEY, *NEXT, *WEIGHTS)
    return members.unionByName(gone), written(grown.unionByName(alone), "runs")


def rank(elements: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(c, d, k, pos, leaves, saved): sums of the weights before every element of the written list."""
    rounds, seed, n = [], 0, elements.count()
    while n > 1:
        members, runs = contract(elements, n, part_rows)
        rounds.append(members)
        left = runs.count()
        if left > part_rows and 4 * left > 3 * n:
            seed += 1
            members, runs = splice(runs, seed)
            rounds.append(members)
            left = runs.count()
        elements, n = runs, left
    at = elements.select(*KEY, *[F.lit(0).cast("long").alias(w) for w in WEIGHTS])
    for members in reversed(rounds):
        head = at.select(*[F.col(a).alias(b) for a, b in zip(KEY, HEAD)], *[F.col(w).alias(f"h_{w}") for w in WEIGHTS])
        at = written(members.join(head, HEAD).select(*KEY, *[(F.col(w) + F.col(f"h_{w}")).alias(w) for w in WEIGHTS]), "ranks")
    return at
