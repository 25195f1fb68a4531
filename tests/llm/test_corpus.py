"""WARC, decontamination, packing and the pipeline."""

import gzip
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakecube.llm import decontaminate, packing, warc
from tests.llm.conftest import ODD
from tests.llm.test_dedup import lower, split_words

PAGES = "page_id long, url string, html string, file string, kind int, id string"


def brute_warc(rows):
    first, out = {}, []
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    for i, _, h in rows:
        b = (h or "").encode()
        to = first.get(b) if i is not None else None
        revisit = to is not None and i > to
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def some_pages():
    rng = random.Random(1)
    bodies = ["<p>" + "päge " * rng.randint(20, 400) + str(k) for k in range(5)] + ["short", "", None]
    rows = [(rng.randint(-5, 400), f"http://h/{k}", rng.choice(bodies) if k % 2 else f"<b>{k}</b>" * 40) for k in range(120)]
    return rows + [(None, None, bodies[0]), (7, "http://x/\r\nWARC-Type: fake", bodies[1]), (7, None, bodies[1])]


def test_warc_round_trip_and_brute_force(spark, tmp_path):
    rows = some_pages()
    pages = spark.createDataFrame([(*r, "f", 1, "x") for r in rows], PAGES).repartition(6)
    folder, manifest = warc.write_archive(pages, str(tmp_path / "a"), roll=2000)
    out = warc.read_archive(spark, folder, payload=True).collect()
    num = lambda x: None if x is None else int(x)
    assert sorted(((num(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], num(r["refers_to"])) for r in out), key=str) == brute_warc(rows)
    want = sorted((str(i), (h or "").encode()) for i, _, h in rows)
    by_id = {(r["payload_digest"]): bytes(r["payload"]) for r in out if r["record_type"] == "response"}
    assert sorted((str(num(r["page_id"])), bytes(r["payload"]) if r["record_type"] == "response" else by_id[r["payload_digest"]]) for r in out) == want
    for r in manifest.collect():
        data = (tmp_path / "a" / r["file"]).read_bytes()
        assert len(data) == r["bytes"] and hashlib.sha256(data).hexdigest() == r["sha256"]
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == r["records"] + 1
    assert manifest.count() > 6


def test_warc_is_deterministic(spark, tmp_path):
    pages = spark.createDataFrame([(*r, "f", 1, "x") for r in some_pages() if r[0] is not None], PAGES)
    sums = []
    for k, parts in enumerate((3, 7)):
        _, m = warc.write_archive(pages.orderBy(F.rand(k)).repartition(parts), str(tmp_path / str(k)))
        sums.append(sorted((r["records"], r["sha256"]) for r in m.collect()))
    assert sum(n for n, _ in sums[0]) == sum(n for n, _ in sums[1]) == pages.count()


def test_warc_finds_damage_and_takes_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], PAGES)
    folder, manifest = warc.write_archive(empty, str(tmp_path / "e"))
    assert manifest.count() == 0 and warc.read_archive(spark, folder).count() == 0
    folder, manifest = warc.write_archive(spark.createDataFrame([(1, "u", "<p>" * 100, "f", 1, "x")], PAGES), str(tmp_path / "d"))
    path = tmp_path / "d" / manifest.first()["file"]
    parts = list(warc.members(open(path, "rb")))
    path.write_bytes(warc.member(parts[0]) + warc.member(parts[1].replace(b"<p><p>", b"<q><q>")))
    with pytest.raises(Exception, match="digest"):
        warc.read_archive(spark, folder).collect()


# ---- operator 8

def brute_pairs(docs, items):
    def sh(t):
        w = split_words(lower(t))
        return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    best = {}
    for i, t in items:
        if i is not None:
            best[i] = max(best.get(i, ""), t or "")
    out = []
    for d, t in docs:
        s = sh(t)
        for i, x in best.items():
            q = sh(x)
            if q and 4 * len(q & s) >= 3 * len(q):
                out.append((d, i, len(q), len(q & s)))
    return sorted(out, key=str)


def test_decontamination_against_brute_force(spark, make_docs, monkeypatch):
    rng = random.Random(2)
    vocab = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 60)))) for k in range(40)]
    items += [(50, None), (51, ""), (52, "only four words here"), (53, items[3][1]), (None, "x y z a b c"), (3, "a")]
    docs = []
    for d in range(80):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 400))]
        for _ in range(rng.randint(0, 3)):
            x = rng.choice(items)[1] or ""
            x = x.split()
            for _ in range(rng.randint(0, 3)):
                if x:
                    x[rng.randrange(len(x))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = x
        docs.append((d, " ".join(w).upper() if d % 3 else " ".join(w)))
    docs += [(90, "only four words here"), (91, "Only  four words HERE\n"), (None, items[5][1])] + ODD
    frame = spark.createDataFrame([(*x, "t") for x in items], "item_id long, text string, doc_id string")
    for size in (decontaminate.BLOCK_SHINGLES, 200):                    # one block, several blocks
        monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", size)
        got = sorted((tuple(r) for r in decontaminate.contaminated_pairs(make_docs(docs), frame).collect()), key=str)
        assert got == brute_pairs(docs, items) and got
        clean = decontaminate.clean_documents(make_docs(docs), frame)
        assert clean.columns == make_docs([]).columns
        assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == sorted((x for x in docs if not brute_pairs([x], items)), key=str)
    assert decontaminate.contaminated_pairs(make_docs([]), frame).count() == 0
    assert decontaminate.contaminated_pairs(make_docs(docs), frame.limit(0)).count() == 0


def test_search_goes_through_the_sketches():
    """Without sketches nothing is found; with them few of an item's shingles are looked up."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(1, 1 << 62, n, dtype=np.uint64)) for n in (3, 40, 41, 600)]
    block = decontaminate.Block(sets)
    indexed = sum(len(c["hash"]) for c in block.classes)
    assert [c["least"] for c in block.classes] == [3, 40, 600] and indexed < 0.5 * sum(map(len, sets))
    docs = [sets[0], sets[1][:30], sets[2][:30], np.sort(np.concatenate([sets[3][100:], sets[1]])), sets[3][:400]]
    d, h = np.repeat(np.arange(5), [len(x) for x in docs]), np.concatenate(docs)
    got = [x.tolist() for x in block.search(d, h)]
    assert sorted(zip(*got)) == [(0, 0, 3), (1, 1, 30), (3, 1, 40), (3, 3, 500)]        # 30 of 41 and 400 of 600 are too few
    met = set(zip(*(x.tolist() for x in block.candidates(d, h, np.bincount(d)))))
    assert (4, 3) not in met                                                          # too short for that class: never probed
    block.classes = []
    assert not len(block.search(d, h)[0])


def test_sketches_are_large_enough():
    n = np.arange(1, 3000)
    s = decontaminate.sketch_size(n)
    assert ((s >= n - -(-3 * n // 4) + 1) & (s <= n)).all()


# ---- operator 9

def check_packing(rows, out, enc, capacity):
    import zlib
    seqs, docs = {}, {}
    for r in out:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs.setdefault(r["doc_id"], []).append(r)
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    want = []
    for i, t in rows:
        ids = np.array(enc.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
        n = len(ids)
        first = n if n <= capacity else (n - 1) % capacity + 1
        cuts = [(0, first), *[(s, capacity) for s in range(first, n, capacity)]]
        want += [(i, k, s, m, zlib.crc32(ids[s:s + m].tobytes())) for k, (s, m) in enumerate(cuts)]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out), key=str) == sorted(want, key=str)
    return len(seqs), -(-sum(r["length"] for r in out) // capacity)


def test_packing_against_the_tokenizer(spark, make_docs, rows_of):
    from tokenizers import Tokenizer
    enc = Tokenizer.from_file(packing.default_tokenizer())
    rows = [(r["doc_id"], r["text"]) for r in rows_of("documents")] + [x for x in ODD if x[0] != 8]
    rows += [(800, "a <|endoftext|> inside"), (801, " \u00a0\u2028x'll I'M 1234567 \t\t end  "), (802, "\U0001f600 e\u0301 \ufffd")]
    used, least = check_packing(rows, packing.pack_documents(make_docs(rows)).collect(), enc, 1024)
    assert used <= 1.1 * least
    assert packing.pack_documents(make_docs([])).count() == 0


def test_sum_of_squares_is_the_smallest_each_time():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 30, 400)
    where, offset = packing.sum_of_squares(lengths, 32)
    fill, squares = {}, lambda f: sum(v * v for v in np.bincount([32 - x for x in f.values() if x < 32], minlength=33))
    for s, b, o in zip(lengths.tolist(), where.tolist(), offset.tolist()):
        options = []
        for g in {32 - x for x in fill.values() if 32 - x >= s} | {32}:
            trial = dict(fill)
            bin_ = next((k for k, x in fill.items() if 32 - x == g), "new") if g < 32 else "new"
            trial[bin_] = trial.get(bin_, 0) + s
            options.append(squares(trial))
        assert o == fill.get(b, 0)
        fill[b] = fill.get(b, 0) + s
        assert squares(fill) == min(options)
    assert max(fill.values()) <= 32


def test_pack_many_lengths_close_to_the_least(spark):
    rng = np.random.default_rng(4)
    lengths = np.clip(rng.lognormal(6, 1, 20_000).astype(int), 1, 1023)
    lengths = lengths[packing.packing_order(lengths, np.arange(20_000), 1024)]
    where, _ = packing.sum_of_squares(lengths, 1024)
    assert len(np.unique(where)) <= 1.01 * lengths.sum() / 1024 + 1


# ---- the pipeline

def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    from tests.llm.test_dedup import brute_components, brute_lines
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontaminate", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = corpus_pipeline.written(stage(spark, docs, sf), "test")
        if name != "packing":
            assert out.columns == docs.columns and out.schema == docs.schema
            after = sorted((r["doc_id"], r["text"]) for r in out.collect())
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        if name == "toxicity":
            model = corpus_pipeline.toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
            assert set(after) <= set(before) and model
        elif name == "line_dedup":
            assert after == sorted((i, t) for i, _, _, t in brute_lines(before))
        elif name == "jaccard_join":
            comps = brute_components(before)
            assert after == sorted((i, t) for i, t in before if comps[i][1] == i)
        elif name == "decontaminate":
            dirty = {x[0] for x in brute_pairs(before, items)}
            assert after == sorted((i, t) for i, t in before if i not in dirty)
        else:
            from tokenizers import Tokenizer
            used, least = check_packing(before, out.collect(), Tokenizer.from_file(packing.default_tokenizer()), 1024)
            assert used <= 1.2 * least
        docs = out


def test_pipeline_keeps_odd_rows_in_shape(spark, make_docs, tmp_path):
    sf = str(tmp_path)
    make_docs([r for r in ODD]).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "one")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in out} >= {1, 2, 3, 5, -3, None} and 4 not in {r["doc_id"] for r in out}


def test_line_dedup_stage_keeps_columns_of_the_operator_s_names(spark, make_docs):
    docs = make_docs([(i, f"one line that is long enough to count\nand {i}") for i in range(4)])
    out = corpus_pipeline.drop_repeated_lines(spark, docs, "")
    assert out.schema == docs.schema
    assert {(r["n_lines"], r["text"]) for r in out.collect()} == {("x", f"and {i}") for i in range(3)} | {("x", "one line that is long enough to count\nand 3")}
