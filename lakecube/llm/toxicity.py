"""Toxicity (operator 5): a bidirectional gated recurrent network with attention pooling, in numpy.

Words enter twice: as a word (two hashed embedding tables) and as characters
(hashed embeddings of its byte trigrams and five-byte strings).  A forward and a backward
gated recurrent layer read a window of words; attention weights its states into
one vector, which gives the window's logit.  A text is cut into overlapping
windows that cover it whole, all are scored, and its score is a calibrated
sigmoid of the largest window logit.

Training is by document: labels say nothing about windows, so a toxic
document's windows are pooled by noisy-or and every window of a clean one is clean.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

WINDOW, STRIDE = 48, 36
HIDDEN, WORD_DIM, CHAR_DIM, ATTENTION = 8, 6, 8, 8
WORD_BITS, CHAR_BITS = 15, 14
MAX_TOXIC, MAX_CLEAN = 2000, 3000        # labelled documents the network is fitted on, at most
EPOCHS, BATCH, CLEAN_WINDOWS, WORD_DROP = 8, 512, 6, 0.5
STATE_WINDOWS = 4096                      # windows scored together

_PUNCT = np.isin(np.arange(256), np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", dtype=np.uint8))


def encode(data: np.ndarray, offsets: np.ndarray) -> dict:
    """Words of the texts: index into the distinct words, document of each, and the distinct words' features."""
    data = W.LOWER[data]
    start, end, doc = W.words(data, offsets)
    for _ in range(3):                    # punctuation around a word is not the word
        long = end - start > 1
        end = end - (long & _PUNCT[data[np.maximum(end - 1, 0)]] if len(end) else 0)
        long = end - start > 1
        start = start + (long & _PUNCT[data[start]] if len(start) else 0)
    h = W.span_hash(W.prefix_hash(data), start, end)
    distinct, first, index = np.unique(h, return_index=True, return_inverse=True)
    s, e = start[first], end[first]
    size = e - s
    owner = np.repeat(np.arange(len(s)), size)
    at = np.repeat(s - np.cumsum(size) + size, size) + np.arange(size.sum())
    mid = data[at].astype(np.uint64) if len(at) else np.zeros(0, np.uint64)
    edge_l, edge_r = at == s[owner], at == e[owner] - 1
    left = np.where(edge_l, 1, data[np.maximum(at - 1, 0)]).astype(np.uint64) if len(at) else mid
    right = np.where(edge_r, 2, data[np.minimum(at + 1, len(data) - 1)]).astype(np.uint64) if len(at) else mid
    tri = W.mix((left << np.uint64(16)) | (mid << np.uint64(8)) | right)
    # five bytes from here on: the trigrams here and two bytes later
    later = np.minimum(np.arange(len(at)) + 2, np.maximum(np.cumsum(size) - 1, 0)[owner]) if len(at) else owner
    five = (W.mix(tri * np.uint64(3) ^ tri[later]) >> np.uint64(64 - CHAR_BITS)) + np.uint64(1 << CHAR_BITS)
    tri = tri >> np.uint64(64 - CHAR_BITS)
    return {"key": distinct, "index": index.astype(np.int32), "doc": doc,
            "one": (distinct >> np.uint64(64 - WORD_BITS)).astype(np.int64),
            "two": (W.mix(distinct ^ np.uint64(0xBEEF)) >> np.uint64(64 - WORD_BITS)).astype(np.int64),
            "tri": tri.astype(np.int32), "five": five.astype(np.int32), "tri_at": np.cumsum(size) - size, "tri_n": size}


def encode_texts(texts: list[str], size: int = 1 << 18) -> dict:
    """encode() of many texts, a slice at a time."""
    data, offsets = W.text_buffer(pa.array(texts, pa.large_string()))
    parts = [(a, encode(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])) for a, b in W.slices(offsets, size)]
    if not parts:
        return encode(data, offsets)
    all_ = {k: np.concatenate([e[k] for _, e in parts]) for k in ("key", "one", "two", "tri", "five", "tri_n")}
    all_["tri_at"] = np.cumsum(all_["tri_n"]) - all_["tri_n"]
    _, first, of = np.unique(all_["key"], return_index=True, return_inverse=True)
    base = np.cumsum([0] + [len(e["key"]) for _, e in parts])
    return _subset(all_, first) | {"index": np.concatenate([of[b + e["index"]].astype(np.int32) for b, (_, e) in zip(base, parts)]),
                                   "doc": np.concatenate([a + e["doc"] for a, e in parts])}


def windows(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, words) of the windows; at least one a document, together all of its words."""
    n_words = n_words.astype(np.int64)
    many = 1 + np.maximum(0, -(-(n_words - WINDOW) // STRIDE))
    doc = np.repeat(np.arange(len(n_words)), many)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    base = np.cumsum(n_words) - n_words
    return doc, base[doc] + k * STRIDE, np.minimum(WINDOW, n_words[doc] - k * STRIDE)


def new_model(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    x = 2 * WORD_DIM + CHAR_DIM

    def draw(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)
    m = {"one": draw(1 << WORD_BITS, WORD_DIM, scale=0.1), "two": draw(1 << WORD_BITS, WORD_DIM, scale=0.1),
         "tri": draw(2 << CHAR_BITS, CHAR_DIM, scale=0.3)}
    for d in "fb":
        m[f"W{d}"] = draw(x, 3 * HIDDEN, scale=0.4)
        m[f"U{d}"] = draw(HIDDEN, 3 * HIDDEN, scale=0.3)
        m[f"b{d}"] = np.zeros(3 * HIDDEN, np.float32)
    m |= {"A": draw(2 * HIDDEN, ATTENTION, scale=0.4), "a": draw(ATTENTION, scale=0.5),
          "w": draw(2 * HIDDEN, scale=0.3), "c": np.full(1, -2.0, np.float32)}
    return m


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _inputs(m, e):
    if not len(e["one"]):
        return np.zeros((1, 2 * WORD_DIM + CHAR_DIM), np.float32)
    n = len(e["one"])
    out = np.empty((n, 2 * WORD_DIM + CHAR_DIM), np.float32)
    out[:, :WORD_DIM], out[:, WORD_DIM:2 * WORD_DIM] = m["one"][e["one"]], m["two"][e["two"]]
    for a in range(0, n, 1 << 14):
        b = min(n, a + (1 << 14))
        lo, hi = e["tri_at"][a], e["tri_at"][b - 1] + e["tri_n"][b - 1]
        grams = m["tri"][e["tri"][lo:hi]] + m["tri"][e["five"][lo:hi]]
        out[a:b, 2 * WORD_DIM:] = np.add.reduceat(grams, e["tri_at"][a:b] - lo, axis=0) / np.sqrt(e["tri_n"][a:b, None])
    return out


def _grid(e, start, size):
    """(steps, windows) word numbers and their mask."""
    steps = np.arange(max(1, int(size.max()) if len(size) else 1))[:, None]
    mask = steps < size
    at = np.minimum(start + steps, max(len(e["index"]) - 1, 0))
    return (e["index"][at] if len(e["index"]) else np.zeros(at.shape, np.int64)), mask


def _layer(proj, u, word, mask, backward, keep):
    steps, width = word.shape
    h = np.zeros((width, HIDDEN), np.float32)
    states, cache = np.empty((steps, width, HIDDEN), np.float32), []
    for t in (range(steps - 1, -1, -1) if backward else range(steps)):
        g = proj[word[t]]
        r = h @ u
        zr = _sigmoid(g[:, :2 * HIDDEN] + r[:, :2 * HIDDEN])
        z, q = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(g[:, 2 * HIDDEN:] + q * r[:, 2 * HIDDEN:])
        new = n + z * (h - n)
        live = mask[t][:, None]
        if keep:
            cache.append((t, h, z, q, n, r[:, 2 * HIDDEN:]))
        h = np.where(live, new, h)
        states[t] = h
    return states, cache


def forward(m, x, word, mask, keep=False):
    """Logits of windows given distinct words' inputs ``x``."""
    sf, cf = _layer(x @ m["Wf"] + m["bf"], m["Uf"], word, mask, False, keep)
    sb, cb = _layer(x @ m["Wb"] + m["bb"], m["Ub"], word, mask, True, keep)
    s = np.concatenate([sf, sb], axis=2)
    k = np.tanh(s @ m["A"])
    score = np.where(mask, k @ m["a"], np.float32(-30))
    score = np.exp(score - score.max(axis=0))
    score = score * mask
    weight = score / np.maximum(score.sum(axis=0), 1e-9)
    pooled = np.einsum("tb,tbh->bh", weight, s)
    logit = pooled @ m["w"] + m["c"][0]
    return logit, (s, k, weight, pooled, cf, cb) if keep else None


def backward(m, e, x, word, mask, kept, dlogit, hidden=None):
    """Gradients of every parameter; ``hidden`` marks distinct words whose word part was left out of ``x``."""
    s, k, weight, pooled, cf, cb = kept
    g = {"w": pooled.T @ dlogit, "c": np.array([dlogit.sum()], np.float32)}
    dpool = dlogit[:, None] * m["w"]
    ds = weight[:, :, None] * dpool
    dweight = np.einsum("bh,tbh->tb", dpool, s)
    dscore = weight * (dweight - (weight * dweight).sum(axis=0))
    g["a"] = np.einsum("tb,tbh->h", dscore, k)
    dk = dscore[:, :, None] * m["a"] * (1 - k * k)
    g["A"] = np.einsum("tbi,tbj->ij", s, dk)
    ds += dk @ m["A"].T
    dx = np.zeros_like(x)
    for name, cache, part in (("f", cf, ds[:, :, :HIDDEN]), ("b", cb, ds[:, :, HIDDEN:])):
        u = m[f"U{name}"]
        du, dproj = np.zeros_like(u), np.zeros((len(x), 3 * HIDDEN), np.float32)
        dh = np.zeros((word.shape[1], HIDDEN), np.float32)
        all_d = np.zeros((*word.shape, 3 * HIDDEN), np.float32)
        for t, h0, z, q, n, rn in reversed(cache):
            live = mask[t][:, None]
            dh = dh + part[t]
            d = np.where(live, dh, 0)
            dn = d * (1 - z) * (1 - n * n)
            dz = d * (h0 - n) * z * (1 - z)
            dq = dn * rn * q * (1 - q)
            dr = np.concatenate([dz, dq, dn * q], axis=1)
            du += h0.T @ dr
            all_d[t] = np.concatenate([dz, dq, dn], axis=1)
            dh = np.where(live, d * z + dr @ u.T, dh)
        flat, ids = all_d.reshape(-1, 3 * HIDDEN), word.reshape(-1)
        for j in range(3 * HIDDEN):
            dproj[:, j] = np.bincount(ids, weights=flat[:, j], minlength=len(x))
        g[f"U{name}"], g[f"W{name}"], g[f"b{name}"] = du, x.T @ dproj, dproj.sum(axis=0)
        dx += dproj @ m[f"W{name}"].T
    if hidden is not None:
        dx[hidden, :2 * WORD_DIM] = 0
    if len(e["one"]):
        for name, lo in (("one", 0), ("two", WORD_DIM)):
            g[name] = np.stack([np.bincount(e[name], weights=dx[:, lo + j], minlength=1 << WORD_BITS) for j in range(WORD_DIM)], axis=1)
        dc = dx[:, 2 * WORD_DIM:] / np.sqrt(e["tri_n"][:, None])
        owner = np.repeat(np.arange(len(e["tri_n"])), e["tri_n"])
        grams = np.concatenate([e["tri"], e["five"]])
        g["tri"] = np.stack([np.bincount(grams, weights=np.tile(dc[owner, j], 2), minlength=2 << CHAR_BITS) for j in range(CHAR_DIM)], axis=1)
    return g


def _doc_logits(m, e, n_words):
    """Largest window logit of each document."""
    doc, start, size = windows(n_words)
    x = _inputs(m, e)
    out = np.full(len(n_words), -np.inf, np.float32)
    for a in range(0, len(doc), STATE_WINDOWS):
        cut = slice(a, a + STATE_WINDOWS)
        word, mask = _grid(e, start[cut], size[cut])
        np.maximum.at(out, doc[cut], forward(m, x, word, mask)[0])
    return out


def train(texts: list[str], y: np.ndarray, seed: int = 5, epochs: int | None = None, cost: tuple[int, int] = (1, 1)) -> dict[str, np.ndarray]:
    """Fit the network and its calibration.  Without both labels the score is the labels' smoothed share.

    ``cost`` is what a clean and a toxic document stand for: all labelled ones of the kind for each in the sample.
    """
    m = new_model(seed)
    share = (y.sum() + 1) / (len(y) + 2)
    if not y.any() or y.all():
        m["w"][:] = 0
        m["c"][:] = np.log(share / (1 - share))
        return m | {"scale": np.array([1.0]), "shift": np.array([0.0])}
    e = encode_texts(texts)
    n_words = np.bincount(e["doc"], minlength=len(texts))
    doc, start, size = windows(n_words)
    stands = np.where(y, float(cost[1]), float(cost[0]))
    stands /= stands.mean()
    rng = np.random.default_rng(seed)
    spare = np.arange(len(y)) % 5 == 4                     # kept from fitting, for the calibration
    by_doc = np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1)
    epochs = epochs or min(3 * EPOCHS, max(EPOCHS, EPOCHS * 4500 // len(y)))      # fewer documents, more rounds
    batch_size = min(BATCH, max(64, len(doc) // 40))                              # and smaller steps
    first, second, step = {k: np.zeros_like(v) for k, v in m.items()}, {k: np.zeros_like(v) for k, v in m.items()}, 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - 0.8 * epoch / max(1, epochs - 1))
        batch: list[np.ndarray] = []
        order = rng.permutation(np.flatnonzero(~spare))
        for at, i in enumerate(order):
            own = by_doc[i]
            batch.append(own if y[i] or len(own) <= CLEAN_WINDOWS else rng.choice(own, CLEAN_WINDOWS, replace=False))
            if sum(map(len, batch)) < batch_size and at + 1 < len(order):
                continue
            rows = np.concatenate(batch)
            batch = []
            word, mask = _grid(e, start[rows], size[rows])
            used, local = np.unique(word, return_inverse=True)
            sub = _subset(e, used)
            x = _inputs(m, sub)
            hidden = rng.random(len(x)) < WORD_DROP            # then only its characters tell
            x[hidden, :2 * WORD_DIM] = 0
            local = local.reshape(word.shape)
            logit, kept = forward(m, x, local, mask, keep=True)
            p = np.clip(_sigmoid(logit), 1e-6, 1 - 1e-6)
            d = doc[rows]
            if not len(d):
                continue
            here, inv = np.unique(d, return_inverse=True)
            none = np.exp(np.bincount(inv, weights=np.log1p(-p)))          # no window of the document is toxic
            any_ = np.clip(1 - none, 1e-6, 1)
            grad = (np.where(y[d], -(none / any_)[inv] * p, p) * stands[d]).astype(np.float32) / len(here)
            g = backward(m, sub, x, local, mask, kept, grad, hidden)
            step += 1
            for k, v in g.items():
                first[k] = 0.9 * first[k] + 0.1 * v.astype(np.float32)
                second[k] = 0.999 * second[k] + 0.001 * np.square(v).astype(np.float32)
                m[k] = m[k] - (rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    use = spare if y[spare].any() and not y[spare].all() else np.ones(len(y), bool)
    return m | _calibrate(_doc_logits(m, e, n_words)[use], y[use], cost)


def _subset(e, used):
    if not len(e["one"]):
        return e
    n = e["tri_n"][used]
    at = np.repeat(e["tri_at"][used] - np.cumsum(n) + n, n) + np.arange(n.sum())
    return {"one": e["one"][used], "two": e["two"][used], "tri": e["tri"][at], "five": e["five"][at], "tri_n": n, "tri_at": np.cumsum(n) - n}


def _calibrate(logit, y, cost=(1, 1)):
    """The threshold whose errors cost least (the middle of the best range) becomes a score of one half."""
    order = np.argsort(logit, kind="stable")
    v, t = logit[order].astype(float), y[order]
    missed, clean = np.where(t, cost[1], 0), np.where(t, 0, cost[0])
    errors = np.concatenate([[0], np.cumsum(missed)]) + np.concatenate([[clean.sum()], clean.sum() - np.cumsum(clean)])
    best = np.flatnonzero(errors == errors.min())
    edge = np.concatenate([[v[0] - 1], (v[1:] + v[:-1]) / 2, [v[-1] + 1]])
    return {"scale": np.array([1.0]), "shift": np.array([-float(np.median(edge[best]))])}


def score_batch(m, data, offsets) -> np.ndarray:
    e = encode(data, offsets)
    n_words = np.bincount(e["doc"], minlength=len(offsets) - 1)
    return _sigmoid(m["scale"][0] * (_doc_logits(m, e, n_words).astype(float) + m["shift"][0]))


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> dict[str, np.ndarray]:
    """Fit on at most ``max_toxic`` and ``max_clean`` labelled documents, chosen by hash among those not held out."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).dropna().filter(~held_out(F.col("id")))
             .groupBy("id").agg(F.max("y").alias("y")))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for y, most in ((1, max_toxic), (0, max_clean)):
        if n.get(y):
            share = min(1_000_000, -(-most * 1_200_000 // n[y]))
            part = known.filter((F.col("y") == y) & (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share))
            part = part.orderBy(F.xxhash64("id"), "id").limit(most)
            chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return train([], np.zeros(0, bool))
    taken = {r["y"]: r["n"] for r in chosen.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    # n / taken of either kind, both times the two samples' sizes: whole numbers, so equal errors stay equal.
    cost = (n.get(0, 0) * taken.get(1, 0), n.get(1, 0) * taken.get(0, 0)) if taken.get(0) and taken.get(1) else (1, 1)
    # The broadcast side, and what the one training task reads, has max_toxic + max_clean rows at most.
    got = (docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
           .join(F.broadcast(chosen.withColumn("id", F.col("id").cast("string"))), "id").select("id", "text", F.col("y").cast("int").alias("y"))
           .groupBy("id").agg(F.max("text").alias("text"), F.max("y").alias("y")))          # of rows that share an id the largest text
    rows = got.repartition(1).mapInArrow(lambda it: W.tidy(_fit_task(it, cost)), "model binary").collect()
    if not rows:
        return train([], np.zeros(0, bool))
    with np.load(io.BytesIO(bytes(rows[0]["model"]))) as m:
        return {k: m[k] for k in m.files}


def _fit_task(batches: Iterator[pa.RecordBatch], cost: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Train in a task: the driver only gets the network."""
    rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
    rows.sort(key=lambda r: (hash_text(r[0]), r[1] or ""))
    out = io.BytesIO()
    np.savez(out, **train([r[1] or "" for r in rows], np.array([r[2] == 1 for r in rows], dtype=bool), cost=cost))
    yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["model"])


def hash_text(s: str) -> int:
    out = 1469598103934665603
    for b in s.encode():
        out = ((out ^ b) * 1099511628211) % (1 << 64)
    return int(W.mix(np.array([out], dtype=np.uint64))[0])


def score_documents(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score`` between 0 and 1 for every row (a column of that name is replaced)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*[c for c in docs.columns if c.lower() != score_col.lower()])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            data, offsets = W.text_buffer(batch.column(at))
            out = [score_batch(m, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in W.slices(offsets, 1 << 20)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out) if out else np.zeros(0))],
                                             names=[*batch.schema.names, score_col])

    return docs.mapInArrow(lambda it: W.tidy(run(it)), T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``.

    Defined cases: a null, empty or blank text is scored as a window without
    words; rows that share an id, and rows with a null id (not held out, never
    learned from), are scored each on their own; of several labels the largest counts, null
    labels do not; without labels of both kinds every score is the labels' smoothed
    share; an empty table gives an empty one; further columns are not looked at.
    """
    model = fit(docs, labels, id_col, text_col)
    out = score_documents(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text")), model, "__text")
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
