"""Toxicity, LM scoring, URL filters and quality rules."""

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakecube.llm import lm_scoring, quality_rules, toxicity, url_filter, words
from tests.llm.conftest import ODD
from tests.llm.test_dedup import BLANKS, split_words


# ---- operator 7

def brute_counts(text):
    text = text or ""
    w = split_words(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": text.count("\n") + 1,
            "n_unique": len(set(w))}


def test_text_counts_against_brute_force(spark, make_docs, rows_of):
    rows = [(r["doc_id"], r["text"]) for r in rows_of("documents")] + ODD
    rows += [(900, "a b c d e f g h i j a b c d e f g h"), (901, "x\n\nx\ny\n x\nx"), (902, "#|a| <b>\n%%% é")]
    got = sorted((tuple(r[c] for c in ("doc_id", *brute_counts(""))) for r in quality_rules.text_counts(make_docs(rows)).collect()), key=str)
    assert got == sorted(((i, *brute_counts(t).values()) for i, t in rows), key=str)


def test_rules_are_learned_and_become_one_expression(spark):
    rng = np.random.default_rng(2)
    x = rng.random((3000, len(quality_rules.RATIOS)))
    y = (x[:, 2] >= 0.8) | ((x[:, 3] >= 0.7) & (x[:, 8] < 0.3))
    rules = quality_rules.learn_rules(x, y)
    hit = np.zeros(len(x), bool)
    for r in rules:
        hit |= quality_rules._covers(r, x)
    assert 2 <= len(rules) <= 8 and (hit == y).mean() > 0.97
    assert quality_rules.learn_rules(x, np.zeros(3000, bool)) == [] and quality_rules.learn_rules(x[:0], y[:0]) == []
    rows = spark.createDataFrame([(40 + i, 200, i, 0, 0, 4, 0, 0, 0, 30, 0) for i in range(60)], ", ".join(f"{c} long" for c in quality_rules.COUNTS))
    rule = [[quality_rules.Condition("symbols_per_word", True, 0.25), quality_rules.Condition("n_words", False, 80.0)]]
    got = [r[0] for r in rows.select(quality_rules.rejected(rule)).collect()]
    assert got == [i / (40 + i) >= 0.25 and 40 + i < 80 for i in range(60)]


def test_quality_on_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    seen = labels.filter(F.pmod("doc_id", F.lit(3)) != 0)
    out, rules = quality_rules.judge_quality(docs, seen)
    held = out.join(labels.join(seen, "doc_id", "left_anti"), "doc_id").filter(~F.col("base_failed")).select("kept", "quality").collect()
    assert rules and np.mean([r["kept"] == (r["quality"] == 1) for r in held]) > 0.95


def test_quality_odd_cases(spark, make_docs):
    labels = spark.createDataFrame([(1, 0), (2, None), (4, 1), (4, 0), (None, 1)], "doc_id long, quality int")
    out, rules = quality_rules.judge_quality(make_docs(ODD), labels)
    assert rules == [] and out.count() == len(ODD)
    assert all(not r["kept"] for r in out.filter("n_words < 20").collect())
    assert quality_rules.judge_quality(make_docs([]), labels.limit(0))[0].count() == 0


# ---- operator 5

def test_toxicity_gradients():
    rng = np.random.default_rng(0)
    texts = ["one two three four", "five six", "seven one nine ten eleven"]
    data, offsets = words.text_buffer(pa.array(texts))
    e = toxicity.encode(data, offsets)
    doc, start, size = toxicity.windows(np.bincount(e["doc"]))
    m = {k: v.astype(np.float64) for k, v in toxicity.new_model().items()}
    d = rng.normal(size=3)
    word, mask = toxicity._grid(e, start, size)

    def run(m):
        x = toxicity._inputs({k: v for k, v in m.items()}, e)
        return toxicity.forward(m, x.astype(np.float64), word, mask, keep=True), x.astype(np.float64)
    (logit, kept), x = run(m)
    g = toxicity.backward(m, e, x, word, mask, kept, d)
    for k in ("w", "c", "a", "A", "Wf", "Ub", "bf", "Uf", "Wb"):
        i = np.unravel_index(np.argmax(np.abs(g[k])), m[k].shape)
        old, eps = m[k][i], 1e-3
        m[k][i] = old + eps
        up = run(m)[0][0] @ d
        m[k][i] = old - eps
        down = run(m)[0][0] @ d
        m[k][i] = old
        assert g[k][i] == pytest.approx((up - down) / (2 * eps), rel=2e-2, abs=1e-4), k


def test_windows_cover_whole_texts_and_overlap():
    n = np.array([0, 1, 47, 48, 49, 84, 85, 1000])
    doc, start, size = toxicity.windows(n)
    base = np.cumsum(n) - n
    for i, k in enumerate(n):
        spans = [(s - base[i], s - base[i] + z) for s, z, d in zip(start, size, doc) if d == i]
        assert spans[0][0] == 0 and spans[-1][1] == k and all(b[0] < a[1] for a, b in zip(spans, spans[1:]))


def test_toxicity_learns_words_and_stems():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeioutnrs") for _ in range(rng.randint(2, 7)))
    texts, y = [], []
    for i in range(700):
        w = [word() for _ in range(rng.randint(20, 160))]
        y.append(i % 3 == 0)
        if y[-1]:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["blork", "zumpf" + word(), "Grix!"]))
        texts.append(" ".join(w))
    m = toxicity.train(texts[:500], np.array(y[:500]))
    data, offsets = words.text_buffer(pa.array(texts[500:]))
    score = toxicity.score_batch(m, data, offsets)
    assert ((score >= 0.5) == np.array(y[500:])).mean() > 0.9 and (0 <= score).all() and (score <= 1).all()


def test_toxicity_odd_cases(spark, make_docs):
    labels = spark.createDataFrame([(1, 0), (2, None), (4, 1), (4, 0), (None, 1)], "doc_id long, toxic int")
    out = toxicity.toxicity(make_docs(ODD), labels)
    rows = out.collect()
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and len(rows) == len(ODD)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert toxicity.toxicity(make_docs([]), labels.limit(0)).count() == 0
    assert {round(r["score"], 6) for r in toxicity.toxicity(make_docs(ODD), labels.limit(0)).collect()} == {0.5}


def test_held_out_labels_are_not_learned(spark, make_docs):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(held)], "doc_id long, toxic int")
    assert {round(r["score"], 6) for r in toxicity.toxicity(make_docs([(i, "some words") for i in range(200)]), labels).collect()} == {0.5}


def test_toxicity_cut_stays_when_the_sample_is_capped(spark, make_docs):
    rng = np.random.default_rng(7)
    y = np.arange(60_000) % 10 == 0
    logit = rng.normal(np.where(y, 1.0, -1.0))
    toxic, clean = np.flatnonzero(y), np.flatnonzero(~y)
    some = np.concatenate([toxic, clean[:len(toxic)]])
    cost = (len(clean) * len(toxic), len(toxic) * len(toxic))
    all_of_them = toxicity._calibrate(logit, y)["shift"][0]
    assert toxicity._calibrate(logit[some], y[some], cost)["shift"][0] == pytest.approx(all_of_them, abs=0.3)
    assert abs(toxicity._calibrate(logit[some], y[some])["shift"][0] - all_of_them) > 0.7
    # Texts that tell nothing, mostly clean: no cap makes them toxic.
    docs = make_docs([(i, "some words") for i in range(500)])
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(500)], "doc_id long, toxic int")
    for most in (1000, 30):
        model = toxicity.fit(docs, labels, max_toxic=2 * most, max_clean=most)
        assert toxicity.score_documents(docs, model, score_col="toxicity").filter("toxicity >= 0.5").count() == 0


# ---- operator 3

def test_lm_gradients_and_normalisation():
    rng = np.random.default_rng(1)
    m = {k: v.astype(np.float64) for k, v in lm_scoring.new_network(rng.integers(0, 100, lm_scoring.CLASSES)).items()}
    word, ctx = rng.integers(0, lm_scoring.CLASSES, 30), rng.integers(0, lm_scoring.CLASSES + 1, (30, 2 * lm_scoring.SIDE))
    g = lm_scoring._gradients(m, word, ctx)
    for k in lm_scoring.SHAPES:
        i = np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape)
        old, eps = m[k][i], 1e-5
        m[k][i] = old + eps
        up = -lm_scoring.log_probability(m, word, ctx).mean()
        m[k][i] = old - eps
        down = -lm_scoring.log_probability(m, word, ctx).mean()
        m[k][i] = old
        assert g[k][i] == pytest.approx((up - down) / (2 * eps), rel=1e-3, abs=1e-8), k
    every = np.arange(lm_scoring.CLASSES)
    assert np.exp(lm_scoring.log_probability(m, every, np.repeat(ctx[:1], len(every), axis=0))).sum() == pytest.approx(1)
    assert (lm_scoring.flat(lm_scoring.unflat(lm_scoring.flat(m))) == lm_scoring.flat(m)).all()


def test_lm_scoring_and_gradients_hold_a_piece_at_a_time():
    rng = np.random.default_rng(6)
    side, n = 96, 20000
    m = lm_scoring.new_network(rng.integers(0, 100, side * side))
    word, ctx = rng.zipf(1.3, n) % (side * side), rng.integers(0, side * side + 1, (n, 2 * lm_scoring.SIDE))
    peaks = []
    for run in (lm_scoring.log_probability, lm_scoring._gradients):
        tracemalloc.start()
        run(m, word, ctx)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    logits = 4 * side * n                             # bytes of one softmax, were it held whole
    assert peaks[0] < 1.2 * logits and peaks[1] < 3 * logits, [p / logits for p in peaks]
    h = np.tanh(m["b"] + sum(m["E"][ctx[:, j]] @ m["W"][j] for j in range(2 * lm_scoring.SIDE))).astype(float)
    outer, inner = h @ m["G"] + m["g"], np.einsum("nh,nhk->nk", h, m["V"][word // side].astype(float)) + m["v"][word // side]
    plain = sum(x[np.arange(n), i] - np.log(np.exp(x).sum(axis=1)) for x, i in ((outer, word // side), (inner, word % side)))
    assert np.allclose(lm_scoring.log_probability(m, word, ctx), plain, atol=1e-4)


def test_lm_contexts_stay_in_their_document():
    e = lm_scoring.CLASSES
    got = lm_scoring.contexts(np.array([1, 2, 3, 4, 5]), np.array([0, 0, 0, 1, 1]))
    assert got.tolist() == [[e, e, 2, 3], [e, 1, 3, e], [1, 2, e, e], [e, e, 5, e], [e, 4, e, e]]


def test_lm_prefers_what_it_was_trained_on(spark, make_docs):
    rng = random.Random(5)
    names, verbs = [f"name{k}" for k in range(20)], [f"verb{k}" for k in range(20)]
    sentence = lambda: f"the {rng.choice(names)} will {rng.choice(verbs)} a {rng.choice(names)} today"
    rows = [(i, " ".join(sentence() for _ in range(60))) for i in range(400)]
    test = [(1000, " ".join(sentence() for _ in range(40)))]
    mixed = test[0][1].split()
    rng.shuffle(mixed)
    model = lm_scoring.train(make_docs(rows))
    out = {r["doc_id"]: r for r in lm_scoring.score_documents(make_docs(test + [(1001, " ".join(mixed))] + ODD), model).collect()}
    assert out[1000]["n_tokens"] == out[1001]["n_tokens"] == 280
    assert out[1000]["mean_log_prob"] > out[1001]["mean_log_prob"] + 1
    assert out[1000]["log_prob"] == pytest.approx(280 * out[1000]["mean_log_prob"])


def test_lm_every_word_is_a_target_once(spark, make_docs):
    rows = [(i, f"a{i} b c d " * (i % 7)) for i in range(60)] + ODD
    vocab = lm_scoring.vocabulary(make_docs(rows).select("text"))
    state = spark.sparkContext.broadcast((lm_scoring.flat(lm_scoring.new_network(vocab.counts)), vocab.hashes, vocab.number, vocab.side))
    copies = make_docs(rows).select("text").mapInArrow(lambda it: lm_scoring._train(it, state), lm_scoring.COPY)
    assert copies.agg(F.sum("words")).first()[0] == sum(len(split_words(t)) for _, t in rows)


def test_lm_copies_are_averaged_by_words(spark):
    n = sum(int(np.prod(s)) for s in lm_scoring.SHAPES.values())
    rows = [(i, i + 1, np.full(n, float(i), np.float32).tobytes()) for i in range(70)]
    got = lm_scoring.average(spark.createDataFrame([(a, b, bytearray(c)) for a, b, c in rows], lm_scoring.COPY))
    assert got == pytest.approx(np.full(n, sum(i * (i + 1) for i in range(70)) / sum(range(1, 71))), rel=1e-5)
    assert lm_scoring.average(spark.createDataFrame([], lm_scoring.COPY)) is None


def test_lm_odd_cases(spark, make_docs):
    rows = lm_scoring.score_documents(make_docs(ODD)).collect()
    assert len(rows) == len(ODD)
    assert all((r["log_prob"] == 0 and r["mean_log_prob"] is None) if r["n_tokens"] == 0 else r["mean_log_prob"] < 0 for r in rows)
    assert lm_scoring.score_documents(make_docs([])).count() == 0


def test_lm_vocabulary_grows_with_the_corpus(spark, make_docs):
    text = " ".join(f"w{k}" for k in range(1050))
    vocab = lm_scoring.vocabulary(make_docs([(i, text) for i in range(1100)]).select("text"))
    assert len(vocab.hashes) == 1050 and vocab.side ** 2 >= 1050 + lm_scoring.RARE and vocab.rare.count() == 0


def test_lm_words_of_a_class_share_it_by_their_counts(spark, make_docs):
    rng = random.Random(6)
    often = [f"often{k}" for k in range(300)]
    rows = [(i, " ".join([*rng.choices(often, k=60), *(f"rare{(20 * i + k) % 1500}" for k in range(20))])) for i in range(300)]
    weights, vocab = lm_scoring.train(make_docs(rows))
    seen = {r["word"]: r["lp"] for r in lm_scoring.in_class(vocab).collect()}
    assert len(seen) == 1500 and len(vocab.hashes) == 300
    left = np.exp(lm_scoring.unseen(vocab) - lm_scoring.UNSEEN)
    for c in range(lm_scoring.RARE):
        assert sum(math.exp(x) for h, x in seen.items() if h & (lm_scoring.RARE - 1) == c) + left[c] == pytest.approx(1)
    test = [(1, "often1 rare7 often2"), (2, "often1 gibberish7 often2"), (2, "often1 gibberish7 often2"), (3, "often1 often2")]
    out = sorted(tuple(r) for r in lm_scoring.score_documents(make_docs(test), (weights, vocab)).collect())
    assert [r[:2] for r in out] == [(1, 3), (2, 3), (2, 3), (3, 2)] and out[1] == out[2]
    assert out[0][2] > out[1][2] + 20 and out[0][2] < out[3][2] - 5


def test_lm_known_words_score_as_joined_ones(spark, make_docs, monkeypatch):
    monkeypatch.setattr(lm_scoring, "KNOWN", 2)
    line = [f"{name}{k}" for name, most, times in (("often", 300, 20), ("some", 800, 8), ("seldom", 1000, 4)) for k in range(most) for _ in range(times)]
    random.Random(8).shuffle(line)
    rows = [(i, " ".join(line[82 * i:82 * i + 82])) for i in range(200)]
    docs = make_docs(rows + [(300, "gibberish7 some1 some1 seldom3 often2")] + ODD)
    vocab = lm_scoring.vocabulary(make_docs(rows).select("text"))
    assert len(vocab.hashes) == 300 and len(vocab.known) == 800
    joined = {r["word"]: r["lp"] for r in lm_scoring.in_class(vocab).collect()}
    assert [joined[h] for h in vocab.known.view(np.int64).tolist()] == pytest.approx(vocab.share.tolist())
    weights = lm_scoring.flat(lm_scoring.new_network(vocab.counts))
    none = vocab._replace(known=vocab.known[:0], share=vocab.share[:0])
    with_known, without = (sorted(((r["doc_id"] or 0, r["n_tokens"], r["log_prob"]) for r in lm_scoring.score_documents(docs, (weights, v)).collect())) for v in (vocab, none))
    assert [r[:2] for r in with_known] == [r[:2] for r in without]
    assert [r[2] for r in with_known] == pytest.approx([r[2] for r in without])


def test_lm_counts_leave_a_task_added_up():
    texts = [pa.record_batch({"text": ["b a A", None, "c a"]}), pa.record_batch({"text": ["a", "c"]}), pa.record_batch({"text": pa.array([], pa.string())})]
    got = list(lm_scoring._count(iter(texts)))
    assert len(got) == 1 and sorted(got[0].column("n").to_pylist()) == [1, 2, 4] and len(set(got[0].column("word").to_pylist())) == 3
    assert list(lm_scoring._count(iter(texts[2:]))) == []


# ---- operator 6

def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


ODD_URLS = [None, "", "no scheme", "http://", "http://A.ORG", "http://A.ORG/", "x://org/x", "x://notorg/x", "a://b.com/fr/1?q=/de/", "a://com/de/x#y",
            "a://example.org/es/", "a://www.example.org/en/12", "a://example.org/en/2", "a://b://c.org/d", "a://é.com/fr/ü\nz", "a://h?x/fr/", "a://h#x"]


def test_url_parts_and_rules_against_brute_force(spark, rows_of):
    urls = [r["url"] for r in rows_of("pages", "/root/testdata/sf0.01")] + ODD_URLS
    pages = spark.createDataFrame([(i, u, "h", "s", 1) for i, u in enumerate(urls)] + [(0, urls[0], "h", "s", 1), (None, urls[1], "h", "s", 1)],
                                  "page_id long, url string, host string, s string, n int")
    out = url_filter.judge_urls(pages)
    rows = out.collect()
    assert len(rows) == len(urls) + 2 and {r["verdict"] for r in rows} == {"allow", "block"}
    for r in rows:
        host, path, rule, verdict = brute_url(urls[r["page_id"]] if r["page_id"] is not None else urls[1])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert verdict is None or r["verdict"] == verdict
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_likelihood_ratio_against_brute_force(spark):
    rng = random.Random(6)
    grams = {"".join(rng.choice("abc^") for _ in range(url_filter.ORDER + 1)): (rng.randint(0, 5), rng.randint(0, 5)) for _ in range(60)}

    def probability(g, which):
        p = 1 / url_filter.LETTERS
        for k in range(url_filter.ORDER + 1):
            ctx, tails = g[url_filter.ORDER - k:url_filter.ORDER], Counter()
            for x, n in grams.items():
                if x[url_filter.ORDER - k:url_filter.ORDER] == ctx:
                    tails[x[-1]] += n[which]
            seen, kinds = sum(tails.values()), sum(v > 0 for v in tails.values())
            if seen:
                p = (tails[g[-1]] + kinds * p) / (seen + kinds)
        return p
    got = dict(tuple(r) for r in url_filter.likelihood_ratios(
        spark.createDataFrame([(g, a, b) for g, (a, b) in grams.items()], "g string, n_allow long, n_block long")).collect())
    assert got == pytest.approx({g: math.log(probability(g, 0)) - math.log(probability(g, 1)) for g in grams})


def test_url_models_tell_the_kinds_apart(spark):
    rng = random.Random(8)
    good = [f"http://news{rng.randint(0, 99)}.org/story/{rng.randint(0, 999)}" for _ in range(150)]
    bad = [f"http://win-pills{rng.randint(0, 99)}.com/de/casino/{rng.randint(0, 999)}" for _ in range(150)]
    new = ["http://news7.net/story/12", "http://win-pills3.net/en/casino/5"]
    pages = spark.createDataFrame(list(enumerate(good + bad + new)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages).collect()}
    assert (got[300], got[301]) == ("allow", "block")


def test_texts_encoded_in_slices_are_those_encoded_at_once():
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 30))) for _ in range(50)]
    data, offsets = words.text_buffer(pa.array(texts, pa.large_string()))
    once, sliced = toxicity.encode(data, offsets), toxicity.encode_texts(texts, 500)
    assert once["doc"].tolist() == sliced["doc"].tolist() and once["one"][once["index"]].tolist() == sliced["one"][sliced["index"]].tolist()
    for e in (once, sliced):
        e["grams"] = [e["tri"][a:a + n].tolist() + e["five"][a:a + n].tolist() for a, n in zip(e["tri_at"], e["tri_n"])]
    assert [once["grams"][i] for i in once["index"]] == [sliced["grams"][i] for i in sliced["index"]]
