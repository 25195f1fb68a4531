"""Secret scans (operator 12): fixed patterns, and a linear-chain conditional random field beside them.

The patterns find assignments, access keys and long hexadecimal strings.  The
field tags tokens as begin, inside or outside of a secret from their shape, the words around
them and features of the file, and adds the spans that no pattern covers.
No table marks secrets, so it learns from what the patterns find in a bounded
sample: a part of its training sequences goes without the words around, another without the token's own shape,
so that either is enough.  Lines are its sequences; every line of every text is decoded.
"""

from __future__ import annotations

import hashlib
import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import crf
from . import words as W

MAX_SECRET, MAX_CLEAN = 1500, 1500      # documents of the training sample, with and without a pattern's find
WINDOW = 48                             # tokens of a training sequence
OTHERS = 3                              # of a document's training sequences, how many have no find
MIN_CHARS = 6                           # code points of a span that the field adds

# Fixed values of the contract.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")        # 20 and more of AKIA[A-Z0-9]+: a run's first match takes the rest of it
HEX = re.compile(r"[0-9a-f]{24,}")               # whole runs of [0-9a-f]+
ANY = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}|(?-i)AKIA[A-Z0-9]{16}|[0-9a-f]{24}""")


def pattern_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of every find, in code points."""
    out = []
    low = text.lower()
    if "pass" in low or "secret" in low or "token" in low or "api" in low:
        out += [(f.start(), 0, f.end(), f.start(2)) for f in ASSIGN.finditer(text) if f.end(2) - f.start(2) >= 6]
    if "AKIA" in text:
        out += [(f.start(), 1, f.end(), f.start()) for f in ACCESS.finditer(text)]
    out += [(f.start(), 2, f.end(), f.start()) for f in HEX.finditer(text)]
    return sorted(out)


# --- tokens and their features ---------------------------------------------------------
UPPER, LOWER_, DIGIT, HEXA, JOIN, HIGH = (np.zeros(256, dtype=bool) for _ in range(6))
UPPER[65:91] = LOWER_[97:123] = DIGIT[48:58] = HIGH[128:] = True
HEXA[48:58] = HEXA[97:103] = HEXA[65:71] = True
JOIN[[ord(c) for c in "_-+/"]] = True
WORDY = UPPER | LOWER_ | DIGIT | JOIN | HIGH
CLASS = np.select([DIGIT, UPPER, LOWER_, HIGH], [1, 2, 3, 4], 0).astype(np.int8)

SIZES = {"shape": 512, "mix": 128, "own": 4096, "head": 1024, "file": 32, "before": 2048, "before2": 2048, "after": 2048, "shape_before": 512, "shape_after": 512}
AT = dict(zip(SIZES, np.concatenate([[0], np.cumsum(list(SIZES.values()))[:-1]]).tolist()))
N_FEATURES = sum(SIZES.values()) + 1          # the last one is neutral
GROUPS = [[0, 1, 2, 3, 4], [5, 6, 7, 8, 9], [0, 3], [1], [5, 6, 7]]   # the token itself, what is around it, and parts of either


def tokens(data: np.ndarray, offsets: np.ndarray):
    """(start, end, document, first of its line): runs of letters, digits and ``_-+/``, and every other solid byte by itself."""
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, none, none, none.astype(bool)
    wordy = WORDY[data]
    cut = np.zeros(len(data), bool)
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True           # a document's first byte
    left = np.empty_like(wordy)
    left[0], left[1:] = False, wordy[:-1]
    start = (wordy & (~left | cut)) | (~wordy & ~W.is_blank(data))
    starts = np.flatnonzero(start)
    stop = start.copy()
    stop |= ~wordy | cut                          # a token ends before the next place that is one of these
    stops = np.append(np.flatnonzero(stop), len(data))
    ends = stops[np.searchsorted(stops, starts, side="right")]
    doc = np.searchsorted(offsets, starts, side="right") - 1
    line = np.cumsum(data == 10)[starts]
    first = np.ones(len(starts), bool)
    first[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    return starts, ends, doc, first


def features(data: np.ndarray, offsets: np.ndarray, starts, ends, doc, first) -> np.ndarray:
    """Ten active features of each token."""
    size = ends - starts

    def share(flags):
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(flags)])
        return total[ends] - total[starts], total

    n_digit, digits = share(DIGIT[data])
    n_upper, _ = share(UPPER[data])
    n_lower, _ = share(LOWER_[data])
    n_join, _ = share(JOIN[data])
    n_high, _ = share(HIGH[data])
    n_hex, _ = share(HEXA[data])
    kind = CLASS[data]
    changed = np.zeros(len(data), bool)
    changed[1:] = kind[1:] != kind[:-1]
    changes = np.concatenate([np.zeros(1, np.int64), np.cumsum(changed)])
    n_changes = changes[ends] - changes[np.minimum(starts + 1, ends)]
    length = np.searchsorted([1, 2, 5, 9, 15, 23, 39], size)
    shape = length + 8 * ((n_digit > 0) + 2 * (n_upper > 0) + 4 * (n_lower > 0) + 8 * (n_join > 0) + 16 * (n_high > 0))
    single = ~WORDY[data[starts]]
    shape = np.where(single, 384 + (data[starts].astype(np.int64) & 127), shape)
    mix = np.searchsorted([0, 0.2, 0.4, 0.7], n_digit / size) + 5 * (n_hex == size) + 10 * np.searchsorted([0, 2, 6], n_changes) + 40 * np.searchsorted([7, 19], size)
    low = W.LOWER[data]
    h = W.prefix_hash(low)
    word = W.span_hash(h, starts, ends)
    head = W.span_hash(h, starts, np.minimum(ends, starts + 4))
    neutral = N_FEATURES - 1
    own = np.where(size <= 16, AT["own"] + (word >> np.uint64(52)).astype(np.int64), neutral)
    heads = np.where(size >= 8, AT["head"] + (head >> np.uint64(54)).astype(np.int64), neutral)
    lo, hi = offsets[doc], offsets[doc + 1]
    odd = np.concatenate([np.zeros(1, np.int64), np.cumsum(~WORDY[data] & ~W.is_blank(data))])
    n = np.maximum(hi - lo, 1)
    file = (np.searchsorted([0.01, 0.05, 0.2], (digits[hi] - digits[lo]) / n) + 4 * np.searchsorted([0.02, 0.06, 0.15], (odd[hi] - odd[lo]) / n)
            + 16 * ((n_digit > 0) & (size >= 10)))
    near = (word >> np.uint64(53)).astype(np.int64)
    m = len(starts)

    def back(x, by, name):
        out = np.full(m, neutral)
        if m > by:
            out[by:] = AT[name] + x[:-by]
            seq = np.cumsum(first)
            out[by:][seq[by:] != seq[:-by]] = neutral
        return out

    def ahead(x, name):
        out = np.full(m, neutral)
        if m > 1:
            out[:-1] = AT[name] + x[1:]
            out[:-1][first[1:]] = neutral
        return out

    return np.stack([AT["shape"] + shape, AT["mix"] + mix, own, heads, AT["file"] + file, back(near, 1, "before"), back(near, 2, "before2"),
                     ahead(near, "after"), back(shape, 1, "shape_before"), ahead(shape, "shape_after")], axis=1).astype(np.int32)


# --- training --------------------------------------------------------------------------

def training_windows(texts: list[str], others: int = OTHERS):
    """(features, tags, sizes) of windows: those with a find, and up to ``others`` more of each document."""
    xs, ys, sizes = [], [], []
    for text in texts:
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        offsets = np.array([0, len(data)])
        starts, ends, doc, first = tokens(data, offsets)
        if not len(starts):
            continue
        x = features(data, offsets, starts, ends, doc, first)
        y = np.zeros(len(starts), np.int64)
        for _, _, end, value in pattern_spans(text):
            a, b = (len(text[:p].encode("utf-8", "replace")) for p in (value, end))
            inside = np.flatnonzero((starts < b) & (ends > a))
            if len(inside):
                y[inside] = 2
                y[inside[0]] = 1
        edges = np.flatnonzero(first)
        cuts = np.unique(np.concatenate([edges, np.concatenate([np.arange(a, b, WINDOW) for a, b in zip(edges, np.append(edges[1:], len(y)))])]))
        spare = 0
        order = W.mix(cuts.astype(np.uint64) + np.uint64(len(data))).argsort()
        for i in order:
            lo, hi = cuts[i], cuts[i + 1] if i + 1 < len(cuts) else len(y)
            tags = y[lo:hi].copy()
            if not tags.any():
                spare += 1
                if spare > others:
                    continue
            if tags[0] == 2:
                tags[0] = 1
            pad = WINDOW - (hi - lo)
            xs.append(np.pad(x[lo:hi], ((0, pad), (0, 0)), constant_values=N_FEATURES - 1))
            ys.append(np.pad(tags, (0, pad)))
            sizes.append(hi - lo)
    if not xs:
        return np.zeros((0, WINDOW, len(SIZES)), np.int32), np.zeros((0, WINDOW), np.int64), np.zeros(0, np.int64)
    return np.stack(xs), np.stack(ys), np.array(sizes)


def train(texts: list[str]) -> dict[str, np.ndarray]:
    x, y, size = training_windows(texts)
    return crf.train(x, y, size, N_FEATURES, GROUPS) if y.any() else crf.start_model(N_FEATURES) | {"off": np.ones(1)}


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts = sorted({t or "" for b in batches for t in b.column(0).to_pylist()}, key=lambda t: (hashlib.md5(t.encode("utf-8", "replace")).digest(), t))
    out = io.BytesIO()
    np.savez(out, **train(texts))
    yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["model"])


def fit(docs: DataFrame, text_col: str = "text", max_secret: int = MAX_SECRET, max_clean: int = MAX_CLEAN) -> dict[str, np.ndarray]:
    """Fit on at most ``max_secret`` distinct texts with a find and ``max_clean`` without, the first by hash.

    Copies are one text.  The fit runs in one task on that sample; the driver gets the network of
    weights alone (about 0.2 MB).
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter(F.length("text") > 0)
    keyed = texts.select(F.xxhash64("text").alias("h"), F.xxhash64(F.lit("2"), "text").alias("h2"), F.col("text").rlike(ANY).alias("y"))
    keys = None
    for y, most in ((True, max_secret), (False, max_clean)):
        part = keyed.filter(F.col("y") == y).groupBy("h", "h2").agg(F.max("y").alias("y")).orderBy("h", "h2").limit(most).select("h", "h2")
        keys = part if keys is None else keys.unionByName(part)
    from .base import written
    keys = written(keys, "sample")                       # max_secret + max_clean rows at most
    chosen = (texts.withColumn("h", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit("2"), "text"))
              .join(F.broadcast(keys), ["h", "h2"], "left_semi").groupBy("h", "h2").agg(F.min("text").alias("text")))
    rows = chosen.select("text").repartition(1).mapInArrow(_fit_task, "model binary").collect()
    if not rows:
        return train([])
    with np.load(io.BytesIO(bytes(rows[0]["model"]))) as m:
        return {k: m[k] for k in m.files}


# --- the scan --------------------------------------------------------------------------

def added_spans(m, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int]]]:
    """(start, end) in code points of the spans that the field tags, per document."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(offsets) - 1)]
    if "off" in m or not len(data):
        return out
    starts, ends, doc, first = tokens(data, offsets)
    if not len(starts):
        return out
    emit = crf.emissions(m, features(data, offsets, starts, ends, doc, first))
    tag = crf.viterbi(m, emit, first)
    begin = np.flatnonzero(tag == 1)
    if not len(begin):
        return out
    other = np.append(np.flatnonzero((tag != 2) | first), len(tag))
    stop = other[np.searchsorted(other, begin, side="right")] - 1
    chars = np.concatenate([np.zeros(1, np.int64), np.cumsum((data & 0xC0) != 0x80)])
    for d, a, b in zip(doc[begin], starts[begin], ends[stop]):
        base = chars[offsets[d]]
        out[d].append((int(chars[a] - base), int(chars[b] - base)))
    return out


def _scan(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    m = model.value
    for batch in batches:
        texts = batch.column(1).fill_null("")
        data, offsets = W.text_buffer(texts)
        for a, b in W.slices(offsets):
            extra = added_spans(m, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            counts, digests, spans = [], [], []
            for text, more in zip(texts.slice(a, b - a).to_pylist(), extra):
                found = pattern_spans(text)
                counts.append([sum(f[1] == k for f in found) for k in range(3)])
                base = [(f[0], f[1], f[2]) for f in found]
                more = [(s, 3, e) for s, e in more if e - s >= MIN_CHARS and not any(s < z and e > x for x, _, z in base)]
                joined = [",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in part) for part in (base, sorted(base + more))]
                digests.append(hashlib.sha256(joined[0].encode()).hexdigest())
                spans.append(joined[1])
            counts = np.array(counts, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), *[pa.array(np.ascontiguousarray(counts[:, k])) for k in range(3)],
                 pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: dict | None = None) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) for every row of ``docs``.

    Spans are ``kind:start:end`` in code points; ``base_sha256`` covers the
    patterns' alone.  A span of kind ``crf`` overlaps none of those and has
    MIN_CHARS code points at least.

    Defined cases: a null or empty text has no spans; rows that share an id,
    and rows with a null id, are scanned each on their own; without any find
    the field adds nothing; an empty table gives an empty one; further columns
    are not looked at.  A text longer than a slice (2 MB) is tagged in one
    piece: memory per task grows with the longest text (about 150 bytes a byte).
    """
    model = fit(docs, text_col) if model is None else model
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *[T.StructField(c, T.LongType()) for c in ("n_assign", "n_access", "n_hex")],
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])
    out = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lambda it: _scan(it, sent), schema))
    return out.withColumnRenamed("id", id_col)
