"""Collocations against a plain count over all phrases; the quotient filter by itself."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakecube.llm import collocations as C
from lakecube.llm import quotient_filter as Q

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i:i + k])] += 1
    out = set()
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for i, (score, a, p, left, right) in enumerate(sorted(rows_)[:top]):
            out.add((lang, i + 1, p.decode(), -a, left, right, n[lang], -score))
    return out


def texts(seed, n):
    rng = random.Random(seed)
    vocab = ["New", "york", "city", "ä", "of", "the", "é", "x", "漢字", "a-b", "over"]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 30)):
            words += rng.choice([["new", "York", "city", "hall"], ["the", "end", "of", "the", "world"], [rng.choice(vocab)], [rng.choice(vocab)]])
            words[-1] += rng.choice(["", "", "", "", ",", ".\n", "!", "\x0b"])
        rows.append((rng.choice(["en", "en", "de", None, "und"]), rng.choice([" ", "  ", "\t"]).join(words)))
    return rows


@pytest.mark.parametrize("chunk_bytes", [300, 4 << 20])
def test_matches_a_plain_count(spark, chunk_bytes):
    rows = texts(1, 120) + [("en", None), ("en", ""), (None, " .\n, "), ("xx", "one one one one one one one one one one one one one"), ("en", "new york city hall " * 3000)]
    df = spark.createDataFrame([(i, lang, t, "x", 1) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string, score string, rank int").repartition(5)
    got = {tuple(r) for r in C.collocations(df, min_count=8, chunk_bytes=chunk_bytes).collect()}
    assert got == brute(rows, 8)
    assert len(got) > 20


def test_only_the_first_of_a_language_and_ties_by_bytes(spark):
    rows = texts(2, 80)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert {tuple(r) for r in C.collocations(df, min_count=5, top=3).collect()} == brute(rows, 5, 3)


def test_nothing_frequent_and_an_empty_table(spark):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    for rows in ([], [("en", "a b c")], [("en", "a a a a a a. b b b b b b.")]):
        out = C.collocations(spark.createDataFrame(rows, "lang string, text string"), min_count=6)
        assert out.columns == names and out.collect() == []


@pytest.mark.parametrize("bits,bucket_bits", [(1, 1), (5, 2), (20, 6), (32, 1), (38, 12)])
def test_filters_lose_nothing(bits, bucket_bits):
    rng = np.random.default_rng(bits)
    left, right = (rng.integers(0, 1 << bits, 500, dtype=np.uint64) for _ in range(2))
    bucket, rest = Q.split(left, right, bits, bucket_bits)
    assert bucket.max() < 1 << bucket_bits
    want = Counter(zip(left.tolist(), right.tolist()))
    got, width = Counter(), 2 * bits - bucket_bits
    for b in np.unique(bucket):
        mine = rest[bucket == b]
        halves = []
        for half in (mine[::2], mine[1::2]):         # two shards
            r, c = np.unique(half, return_counts=True)
            halves.append(Q.decode(*Q.encode(r, c, width), width))
            assert np.array_equal(halves[-1][0], r) and np.array_equal(halves[-1][1], c)
        r, c = Q.merge(halves)
        x, y = Q.join(int(b), r, bits, bucket_bits)
        got.update(dict(zip(zip(x.tolist(), y.tolist()), c.tolist())))
    assert got == want


def test_too_many_ids_raise():
    with pytest.raises(OverflowError):
        Q.split(np.zeros(1, np.uint64), np.zeros(1, np.uint64), 40, 4)
