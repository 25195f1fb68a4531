"""Suffix dedup, n-gram join and line dedup on small fixtures against plain Python."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecube.llm import components, jaccard_join, line_dedup, packed, suffix_dedup, words
from tests.llm.conftest import ODD

BLANKS = " \t\n\x0b\x0c\r"


def split_words(text):
    out, now = [], ""
    for ch in text or "":
        if ch in BLANKS:
            if now:
                out.append(now)
            now = ""
        else:
            now += ch
    return out + [now] if now else out


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# ---- packed arrays and word hashes

def test_pack_round_trip():
    rng = np.random.default_rng(1)
    for x in (np.zeros(0, np.uint64), np.array([7], np.uint64), rng.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2)):
        assert (packed.unpack(packed.pack(x)) == x).all()
        assert (packed.unpack(packed.pack(np.sort(x), ascending=True)) == np.sort(x)).all()
    signed = np.array([-5, 3, -(1 << 40)], dtype=np.int64)
    assert (packed.unpack(packed.pack(signed.view(np.uint64))).view(np.int64) == signed).all()


def test_words_are_those_of_the_definition():
    import pyarrow as pa
    texts = [t for _, t in ODD] + ["a\x0bb\x1cc\xa0d e\x85f", "  lead and trail  "]
    data, offsets = words.text_buffer(pa.array(texts))
    start, end, doc = words.words(data, offsets)
    got = [[] for _ in texts]
    for s, e, d in zip(start, end, doc):
        got[d].append(bytes(data[s:e]).decode())
    assert got == [split_words(t) for t in texts]


# ---- operator 1

def brute_suffix(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first, out = {}, []
    for i, b in sorted((x for x in texts if x[0] is not None), key=lambda x: x[0]):
        for p in range(len(b) - length + 1):
            first.setdefault(b[p:p + length], (i, p))
    for i, b in texts:
        gone = bytearray(len(b))
        if i is not None:
            for p in range(len(b) - length + 1):
                if first[b[p:p + length]] != (i, p):
                    gone[p:p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len([1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1])]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def suffix_rows(df):
    df = df.select("doc_id", "n_bytes", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x), F.size("starts"), F.sha2("kept", 256))
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("length", [100, 20])
def test_suffix_dedup_against_brute_force(spark, make_docs, length):
    rng = random.Random(length)
    word = lambda: "".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(40)) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a:a + rng.randint(10, len(p))], word()]
        rows.append((rng.choice([i, i + 1000]), "".join(parts)))
    rows += [(500, rows[0][1]), (501, "ab" * 300), (502, "x" * 500), (503, None), (504, ""), (None, passages[0] * 2), (505, "short"),
             (506, passages[1] + passages[1])]
    df = make_docs(rows).repartition(5)
    assert suffix_rows(suffix_dedup.remove_repeats(df, length=length)) == brute_suffix(rows, length)


def test_suffix_dedup_spans_give_the_kept_bytes(spark, make_docs):
    p = "all the same words in the same order, again and again, for more than a hundred bytes of text in this passage. " * 2
    rows = [(1, "head " + p), (2, "other " + p + " tail"), (3, p)]
    for r in suffix_dedup.remove_repeats(make_docs(rows)).collect():
        b = dict(rows)[r["doc_id"]].encode()
        for s, n in reversed(list(zip(r["starts"], r["lengths"]))):
            b = b[:s] + b[s + n:]
        assert b == bytes(r["kept"])


def test_covers_have_every_distance():
    for v, cover in suffix_dedup.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


def test_suffix_dedup_odd_cases(spark, make_docs):
    odd = [r for r in ODD if r[0] not in (7, 8, 9)] + [(7, "word " * 100), (8, "word " * 100), (9, "x" * 300)]
    assert suffix_rows(suffix_dedup.remove_repeats(make_docs(odd))) == brute_suffix(odd, 100)
    big = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(make_docs(ODD)).collect() if r["doc_id"] in (7, 8, 9)}
    assert len(big[8]["kept"]) == 0 and len(big[7]["kept"]) == 5 and len(big[9]["kept"]) == 1
    assert suffix_dedup.remove_repeats(make_docs([])).count() == 0


# ---- operator 2

def brute_components(rows):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets[i] = max(sets.get(i, ""), t or "")
    for i, t in sets.items():
        w = split_words(lower(t))
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_jaccard_components_against_brute_force(spark, make_docs):
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(400)]
    rows, at = [], 0
    passage = [rng.choice(vocab) for _ in range(30)]
    for size in (1, 2, 3, 30, 12):
        base = [rng.choice(vocab) for _ in range(rng.randint(20, 120))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                k = rng.randrange(len(w))
                w[k:k + rng.choice([0, 1, 1])] = [rng.choice(vocab).upper()]
            rows.append((at, " ".join(w)))
            at += 1
            base = w if rng.random() < 0.3 else base          # chains
    for _ in range(40):                                       # a passage that many share, in texts of their own
        rows.append((at, " ".join(passage + [rng.choice(vocab) for _ in range(rng.randint(0, 14))])))
        at += 1
    rows += [(at + 1, "one two"), (at + 2, "One  TWO"), (at + 3, ""), (at + 4, None), (at + 5, "  "), (at + 6, "one"), (at + 6, "one")]
    want = brute_components(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(make_docs(rows)).collect()}
    assert got == want


def test_jaccard_components_when_pivots_are_not_enough(spark, make_docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LOOKS", 0)             # rounds with pivots before the last one
    test_jaccard_components_against_brute_force(spark, make_docs)


def test_jaccard_odd_cases(spark, make_docs):
    rows = [r for r in ODD if r[0] is not None]
    want = brute_components(rows)
    got = jaccard_join.jaccard_components(make_docs(ODD)).collect()
    assert len(got) == len(ODD)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None, None]
    different = [(1, "a b c d e f"), (1, "z y x w v u"), (2, "z y x w v u")]      # one document: its largest text
    assert {tuple(r) for r in jaccard_join.jaccard_components(make_docs(different)).collect()} == {(1, 2, 1), (2, 2, 1)}
    assert jaccard_join.jaccard_components(make_docs([])).count() == 0


@pytest.mark.parametrize("part_links", [3, 16, components.PART_LINKS])       # many parts, some, one
def test_components(spark, part_links):
    chain = [(i, i + 1) for i in range(30)] + [(100, 50), (50, 70), (7, 7)] + [(200, 200 + k) for k in range(1, 40)]
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(chain, "a long, b long"), part_links).collect())
    assert got == {**{i: 0 for i in range(31)}, 50: 50, 70: 50, 100: 50, **{200 + k: 200 for k in range(40)}}
    assert components.components(spark.createDataFrame([], "a long, b long"), part_links).count() == 0


def test_contract_is_a_forest_of_stars():
    rng = np.random.default_rng(5)
    for n in (2, 50, 3000):
        a, b = rng.integers(0, n, n // 2 + 1), rng.integers(0, n, n // 2 + 1)
        low = list(range(n))
        for _ in range(n):
            before = list(low)
            for x, y in zip(a.tolist(), b.tolist()):
                low[x] = low[y] = min(low[x], low[y])
            if low == before:
                break
        got = components._contract(a, b).to_pydict()
        assert dict(zip(got["a"], got["b"])) == {i: low[i] for i in range(n) if low[i] != i}


# ---- operator 10

def brute_lines(rows, least=20, docs=3):
    key = lambda x: lower(x.strip(BLANKS))
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= least:
                holders.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < docs or i >= max(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup_against_brute_force(spark, make_docs):
    rng = random.Random(3)
    pool = ["  A line that is Long enough %d\t" % k for k in range(8)] + ["short", "", "ünïcödé line with twenty", "exactly nineteen ch."]
    rows = [(rng.randint(0, 60), "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for _ in range(70)] + ODD
    rows += [(i, "the line that a third of all hold") for i in range(100, 140)]
    out = line_dedup.dedup_lines(make_docs(rows))
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in out.collect()), key=str)
    assert got == brute_lines(rows)
    assert set(make_docs([]).columns) <= set(out.columns) and out.columns.count("n_lines") == 1
    assert line_dedup.dedup_lines(make_docs([])).count() == 0


def test_runs_are_levelled_and_settled_keys_are_not_added_again(spark):
    runs = line_dedup.LineRuns(spark, min_docs=2, fanout=2)
    for top in (30, 20, 10):
        runs.add(spark.createDataFrame([(top + d, 1, 1) for d in range(3)] + [(top, top, top)], "doc long, h1 long, h2 long"))
    assert [len(x) for x in runs.levels] == [1, 1]
    assert {tuple(r) for r in runs.index().collect()} == {(1, 1, 3, 32), (30, 30, 1, 30), (20, 20, 1, 20), (10, 10, 1, 10)}
    runs.close()
