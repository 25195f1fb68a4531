"""The patterns against the contract's plain reading, the random field against enumeration, and what the two find."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from lakecube.llm import crf, secret_scan as S, words as W
from lakecube.llm.queries import QUERIES

from .conftest import ODD, SF


def plain_base(text):
    out = []
    for f in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(f.group(2)) >= 6:
            out.append((f.start(), 0, f.end()))
    out += [(f.start(), 1, f.end()) for f in re.finditer(r"AKIA[A-Z0-9]+", text) if len(f.group()) >= 20]
    out += [(f.start(), 2, f.end()) for f in re.finditer(r"[0-9a-f]+", text) if len(f.group()) >= 24]
    return sorted(out)


def test_patterns_match_a_plain_reading():
    rng = random.Random(4)
    parts = ["password", "PassWD", "secret", "toKen", "token", "api_key", "APIKEY", '"', "'", " ", ":", "=", "abc", "AKIA", "A1B2C3D4E5F6G7H8", "deadbeef01234567", "é漢", "\n", "+/=.", "x"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert [f[:3] for f in S.pattern_spans(text)] == plain_base(text), text


def _random_model(rng, n=40):
    m = crf.start_model(n)
    m["w"] = rng.normal(size=(n, 3)).astype(np.float32)
    m["move"] += rng.normal(size=(3, 3))
    m["start"] += rng.normal(size=3)
    return m


def _score(m, e, tags):
    return m["start"][tags[0]] + sum(e[t, k] for t, k in enumerate(tags)) + sum(m["move"][a, b] for a, b in zip(tags, tags[1:]))


def test_viterbi_and_likelihood_match_enumeration():
    rng = np.random.default_rng(1)
    for _ in range(20):
        m = _random_model(rng)
        sizes = rng.integers(1, 7, 30)
        first = np.zeros(sizes.sum(), bool)
        first[np.cumsum(sizes) - sizes] = True
        e = rng.normal(size=(sizes.sum(), 3)) * 2
        got, at = crf.viterbi(m, e, first), 0
        assert len(got) == len(e)
        for n in sizes:
            part = e[at:at + n]
            scores = {t: _score(m, part, t) for t in itertools.product(range(3), repeat=n)}
            assert _score(m, part, tuple(got[at:at + n])) == pytest.approx(max(scores.values()))
            at += n
        tags, width = rng.integers(0, 2, (1, 6)), int(sizes[0])
        ll = crf.likelihood(m, np.pad(e[:width], ((0, 6 - width), (0, 0)))[None], tags, np.array([width]))[0]
        scores = [_score(m, e[:width], t) for t in itertools.product(range(3), repeat=width)]
        assert ll == pytest.approx(_score(m, e[:width], tuple(tags[0, :width])) - np.logaddexp.reduce(scores))


def test_one_long_sequence_over_many_blocks():
    rng = np.random.default_rng(2)
    m, e = _random_model(rng), rng.normal(size=(1000, 3))
    first = np.zeros(1000, bool)
    first[0] = True
    v, back = m["start"] + e[0], []
    for t in range(1, 1000):
        c = v[:, None] + m["move"]
        back.append(c.argmax(0))
        v = c.max(0) + e[t]
    tags = [int(v.argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    assert crf.viterbi(m, e, first).tolist() == tags[::-1]


def test_decoding_costs_no_more_than_a_few_emissions():
    rng = np.random.default_rng(4)
    m = _random_model(rng, 2000)
    idx = rng.integers(0, 2000, (200_000, 10)).astype(np.int32)
    first = rng.random(len(idx)) < 0.05
    e = crf.emissions(m, idx)
    took = {}
    for name, run in (("emissions", lambda: crf.emissions(m, idx)), ("viterbi", lambda: crf.viterbi(m, e, first))):
        times = []
        for _ in range(3):
            t = time.process_time()
            run()
            times.append(time.process_time() - t)
        took[name] = min(times)
    assert took["viterbi"] < 3 * took["emissions"], took          # 4.6 times with the tags as last axis


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    m, e = _random_model(rng), rng.normal(size=(3, 6, 3))
    tags, size = np.where(rng.random((3, 6)) < 0.3, 1, 0), np.array([6, 1, 4])
    _, ge, gm, gs = crf.likelihood(m, e, tags, size)
    h = 1e-5

    def at(**change):
        return crf.likelihood(m | change.get("m", {}), change.get("e", e), tags, size)[0]
    for i in itertools.product(range(3), range(6), range(3)):
        d = np.zeros_like(e)
        d[i] = h
        assert (at(e=e + d) - at(e=e - d)) / (2 * h) == pytest.approx(ge[i], abs=1e-6)
    for i in itertools.product(range(3), range(3)):
        if i != (0, 2):
            d = np.zeros((3, 3))
            d[i] = h
            assert (at(m={"move": m["move"] + d}) - at(m={"move": m["move"] - d})) / (2 * h) == pytest.approx(gm[i], abs=1e-6)
    for i in range(2):
        d = np.zeros(3)
        d[i] = h
        assert (at(m={"start": m["start"] + d}) - at(m={"start": m["start"] - d})) / (2 * h) == pytest.approx(gs[i], abs=1e-6)


def test_tokens_are_runs_and_single_signs():
    texts = ["a=b-c  \"x\"é1", "", "\n z\n", "漢字,q"]
    data, offsets = W.text_buffer(pa.array(texts))
    starts, ends, doc, first = S.tokens(data, offsets)
    got = [(d, bytes(data[a:b]).decode(), bool(f)) for a, b, d, f in zip(starts, ends, doc, first)]
    assert got == [(0, "a", True), (0, "=", False), (0, "b-c", False), (0, '"', False), (0, "x", False), (0, '"', False), (0, "é1", False),
                   (2, "z", True), (3, "漢字", True), (3, ",", False), (3, "q", False)]


def _prose(rng, n):
    return " ".join("".join(rng.choice(["an", "the", "re", "er", "ti", "on", "és"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def learned():
    rng = random.Random(9)
    texts = []
    for i in range(300):
        key = "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(24, 40)))
        word = rng.choice(["token = ", "secret: ", "password=", 'api_key = "'])
        texts.append(f"{_prose(rng, 30)} {word}{key} {_prose(rng, 30)}" if i % 2 else _prose(rng, 60))
    return S.train(texts)


def _found(model, text):
    data, offsets = W.text_buffer(pa.array([text]))
    return [text[a:b] for a, b in S.added_spans(model, data, offsets)[0]]


def test_the_field_finds_what_patterns_do_not(learned):
    rng = random.Random(10)
    hit = 0
    for _ in range(50):
        key = "".join(rng.choice("0123456789abcdef") for _ in range(20))            # too short for the hexadecimal pattern
        text = f"{_prose(rng, 20)} key: {key} {_prose(rng, 20)}"
        assert not S.pattern_spans(text)
        hit += key in _found(learned, text)
    assert hit >= 40
    assert not any(_found(learned, _prose(rng, 80)) for _ in range(100))               # and leaves prose alone


def test_query_over_every_row(spark, rows_of):
    rows = {r["doc_id"]: r["text"] or "" for r in rows_of("documents")}
    got = QUERIES["op12_secret_scan"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(rows)
    for r in got:
        base = plain_base(rows[r["doc_id"]])
        joined = [f"{S.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == j for _, k, _ in base) for j in range(3)]
        assert r["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("crf")] == joined


def test_odd_rows(spark, make_docs):
    docs = make_docs(ODD + [(50, "é token = abcdef123456"), (50, "é token = abcdef123456")])
    got = S.scan_secrets(docs)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    got = got.collect()
    assert len(got) == len(ODD) + 2
    assert [r["spans"] for r in got if r["doc_id"] == 50] == ["assign:2:22"] * 2
    assert all(r["spans"] == "" for r in got if r["doc_id"] in (1, 2, 3))
    assert S.scan_secrets(docs.filter("1 = 0")).collect() == []
