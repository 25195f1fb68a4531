"""The conversation prefix trie against a trie of nested dictionaries, in many small parts."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from lakecube.llm import list_ranking, prefix_trie

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType()), T.StructField("part", T.StringType()), T.StructField("depth", T.StringType())])


def tag(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, tag(t[1], t[2])))
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        seqs[c] = [t[1:] for t in own.get(base, [])[:h] + turns[h:]]
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def saved(p):
        return (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids.get(p, [])]
        sums[p] = (sum(x[0] for x in below) or 1, saved(p) + sum(x[1] for x in below))
    out = set()
    for p, who in members.items():
        ends = sorted(c for c in who if len(seqs[c]) == len(p))
        out.add((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(kids.get(p, [])), *sums[p],
                 hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def run(spark, rows, part_rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = prefix_trie.conversation_trie(df, part_rows).collect()
    places = sorted([r["enter"] for r in got] + [r["exit"] for r in got])
    assert places == list(range(2 * len(got)))               # the arcs' positions in one tour
    return {tuple(r)[:8] for r in got}, len(got)


@pytest.mark.parametrize("part_rows", [9, 1 << 19])
def test_trie_matches_brute_force(spark, part_rows):
    rng = random.Random(3)
    rows = []
    for c in rng.sample(range(-30, 130), 60):
        for t in range(rng.randint(1, 5)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "", None, "long \n text here"])))
    rows += [(200, t, "user", "w " * (t % 3)) for t in range(80)]                       # many parts of one conversation
    rows += [(c, t, "user", "same opening") for c in range(301, 320) for t in range(2)]      # a large group of copies
    rows += [(7, None, "user", "null turn"), (7, None, "user", "null turn"), (9, 1, "user", "tie"), (9, 1, "user", "tie 2"),
             (None, 0, "user", "no id"), (400, 0, "user", "word " * 20_000), (421, 0, "user", "only turn")]
    got, n = run(spark, rows, part_rows)
    assert got == brute(rows)
    assert n == len(got)


def test_empty_table(spark):
    assert run(spark, [], 10) == (set(), 0)


def test_ranks_of_a_list_in_no_order_of_its_keys(spark):
    """Keys say nothing about the order, so runs stay short and random mates must shorten the list."""
    rng = random.Random(5)
    keys = [(rng.randrange(10 ** 9), i, rng.randrange(2)) for i in range(120)]
    w = [(1, rng.randrange(3), rng.randrange(100)) for _ in keys]
    rows = [(*k, *(n if n else (None, None, None)), *x) for k, n, x in zip(keys, keys[1:] + [None], w)]
    df = spark.createDataFrame(rows, "c long, d long, k int, nc long, nd long, nk int, pos long, leaves long, saved long")
    got = {(r["c"], r["d"], r["k"]): (r["pos"], r["leaves"], r["saved"]) for r in list_ranking.rank(df, 25).collect()}
    for i, k in enumerate(keys):
        assert got[k] == tuple(sum(x[j] for x in w[:i]) for j in range(3))
