"""LM scoring (operator 3): masked pseudo-likelihood of a bidirectional window network, in numpy.

The network predicts every word from the two words on either side: their
embeddings meet in one hidden layer, and the output is factored into a group of
classes and the class within its group.  A document's score is the sum of
log P(word | both sides) over all its words.

Classes come from word counts over all documents: the words above a count, about
the square root of the corpus's words (960 at least), have a class each, and all
others share hashed classes.  Within those a word has its own share of the
class: log P(word | class) comes from the counts of all words.  The most frequent
of these words, ``KNOWN`` times as many as the classes at most, go to the tasks
with the network; the others are joined in Spark.
Training predicts every word of every document once: documents fall into
``ROUNDS`` folds by hash; in a round every task trains a copy of the network on
its share of the fold, and the copies are averaged, weighted by their words.
The average is taken in groups of ``FAN_IN``, so no task and not the driver
holds more copies than that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .base import written

SIDE = 2                                # words looked at on either side
GROUPS, PER_GROUP = 32, 32              # at least; as many more as the vocabulary needs
CLASSES = GROUPS * PER_GROUP
RARE = 64                               # hashed classes for words outside the vocabulary
KNOWN = 16                              # words outside the vocabulary that tasks know, for each one that may be in it
MERGED = 1 << 20                        # counts added up in a task before they leave it
EMBED, HIDDEN = 16, 24
ROUNDS, BATCH, RATE = 3, 8192, 0.006
PIECE, MOVED = 4096, 1 << 14            # words and weights in hand at once, few enough for the cache
FAN_IN = 32
UNSEEN = -58 * math.log(2)              # a hashed class has 2**64 / RARE word hashes, which share what unseen words get


def shapes(side: int) -> dict[str, tuple[int, ...]]:
    """Shapes of a network with ``side`` groups of ``side`` classes."""
    return {"E": (side * side + 1, EMBED), "W": (2 * SIDE, EMBED, HIDDEN), "b": (HIDDEN,),
            "G": (HIDDEN, side), "g": (side,), "V": (side, HIDDEN, side), "v": (side, side)}


SHAPES = shapes(GROUPS)


class Vocabulary(NamedTuple):
    """Words with a class of their own (sorted hashes and their classes), and what is known of all others."""
    hashes: np.ndarray
    number: np.ndarray
    side: int                           # groups, and classes in a group
    counts: np.ndarray                  # words of each class
    kinds: np.ndarray                   # distinct words of each hashed class
    rare: DataFrame                     # (word, n) of every word without a class of its own
    known: np.ndarray                   # hashes of the most frequent ones of these
    share: np.ndarray                   # and their log P(word | class)


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    data = W.LOWER[data]
    start, end, doc = W.words(data, offsets)
    return W.span_hash(W.prefix_hash(data), start, end), doc


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        data, offsets = W.text_buffer(batch.column(0))
        for a, b in W.slices(offsets):
            held.append(np.unique(word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])[0], return_counts=True))
            size += len(held[-1][0])
            if size >= MERGED:
                yield _merged(held)
                held, size = [], 0
    if size:
        yield _merged(held)


def _merged(held) -> pa.RecordBatch:
    """One row per word of several (words, counts)."""
    h, n = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(h)
    h, n = h[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(np.add.reduceat(n, first), pa.int64())], names=["word", "n"])


def _top(each, most: int) -> tuple[int | None, int]:
    """The least count that leaves at most ``most`` words (None: no count does), and how many; ``each``: (count, words), falling."""
    least, have = None, 0                # all words that occur as often, or none
    for n, words in each:
        if have + words > most:
            break
        least, have = n, have + words
    return least, have


def vocabulary(texts: DataFrame) -> Vocabulary:
    """Classes and counts from all documents' words."""
    counts = written(texts.mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    each = sorted(((r["n"], r["words"]) for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    most = max(CLASSES - RARE, math.isqrt(sum(n * words for n, words in each)))
    least, have = _top(each, most)
    own = counts.filter(F.col("n") >= least).collect() if have else []
    rare = counts if not have else counts.filter(F.col("n") < least)
    own.sort(key=lambda r: (-r["n"], r["word"]))
    h = np.array([r["word"] for r in own], dtype=np.int64).view(np.uint64)
    order = np.argsort(h)
    side = max(GROUPS, math.isqrt(have + RARE - 1) + 1)
    n, kinds = np.zeros(side * side), np.zeros(RARE)
    n[:have] = [r["n"] for r in own]
    for r in rare.groupBy(F.col("word").bitwiseAND(RARE - 1).alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect():
        n[side * side - RARE + r["c"]], kinds[r["c"]] = r["n"], r["kinds"]
    near, words = _top(each, KNOWN * most)
    known = (rare.filter(F.col("n") >= near) if words > have else rare.limit(0)).toArrow()
    word = known.column("word").to_numpy()
    share = np.log(known.column("n").to_numpy().astype(float)) - _of_class(n, kinds)[word & (RARE - 1)]
    return Vocabulary(h[order], order.astype(np.int64), side, n, kinds, rare, word.view(np.uint64), share)


def classes(h: np.ndarray, vocab: np.ndarray, number: np.ndarray, total: int = CLASSES) -> np.ndarray:
    rare = total - RARE + (h % np.uint64(RARE)).astype(np.int64)
    at = _find(h, vocab)
    own = np.flatnonzero(at >= 0)
    rare[own] = np.take(number, at[own])
    return rare


def _find(h: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Place of each hash in ``among``, or -1."""
    return pc.fill_null(pc.index_in(pa.array(h), value_set=pa.array(among)), -1).to_numpy(zero_copy_only=False)


def _of_class(counts: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """log of what the words of each hashed class share (Witten-Bell: a class's unseen words count once for each distinct one)."""
    return np.log(np.maximum(counts[-RARE:] + kinds, 1))


def in_class(vocab: Vocabulary) -> DataFrame:
    """(word, lp): log P(word | class) of every word seen without a class of its own."""
    size = F.element_at(F.array(*[F.lit(float(x)) for x in _of_class(vocab.counts, vocab.kinds)]), (F.col("word").bitwiseAND(RARE - 1) + 1).cast("int"))
    return vocab.rare.select("word", (F.log(F.col("n").cast("double")) - size).alias("lp"))


def unseen(vocab: Vocabulary) -> np.ndarray:
    """log P(word | class) of any word not seen, by hashed class."""
    return UNSEEN + np.log(np.maximum(vocab.kinds, 1)) - _of_class(vocab.counts, vocab.kinds)


def contexts(word: np.ndarray, doc: np.ndarray, edge: int = CLASSES) -> np.ndarray:
    """(words, 2 * SIDE) classes around each word; beyond the document's ends the edge class."""
    n = len(word)
    before = SIDE * np.cumsum(np.diff(doc, prepend=-1) != 0)          # edges up to each word: SIDE before every document
    line = np.full(n + (before[-1] if n else 0) + SIDE, edge, dtype=np.int64)
    at = np.arange(n) + before
    line[at] = word
    out = np.empty((n, 2 * SIDE), dtype=np.int64)
    for j, shift in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        out[:, j] = np.take(line, at + shift)
    return out


def new_network(counts: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """Small random weights; the output biases start as the classes' frequencies."""
    rng = np.random.default_rng(seed)
    side = math.isqrt(len(counts))
    m = {k: (rng.normal(0, 0.1 if k == "E" else 0.2, s) if k in "EWGV" else np.zeros(s)).astype(np.float32) for k, s in shapes(side).items()}
    share = ((counts + 1) / (counts + 1).sum()).reshape(side, side)
    m["g"] = np.log(share.sum(axis=1)).astype(np.float32)
    m["v"] = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
    return m


def _total(x):
    """Sum of each row, as a product, which is faster on short rows."""
    return x @ np.ones(x.shape[1], x.dtype)


def _picked(x, i):
    """log softmax of each row of ``x`` at ``i``; logits are sums of HIDDEN bounded terms, far below exp's range.  ``x`` is used up."""
    at = x[np.arange(len(i)), i]
    return at - np.log(_total(np.exp(x, out=x)))


def _error(x, i, n: int):
    """Gradient of the mean of -log softmax at ``i`` over ``n`` rows, in place of ``x``; each row still to be scaled by the second result."""
    d = np.exp(x, out=x)
    total = _total(d)
    d[np.arange(len(i)), i] -= total
    return d, (x.dtype.type(1 / n) / total)[:, None]


def _sorted(i, most: int):
    """Stable order of numbers up to ``most``; short integers sort fastest."""
    return np.argsort(i.astype(np.int16 if most < 1 << 15 else np.int32), kind="stable")


def _hidden(m, ctx):
    """Embeddings around each word side by side, the hidden layer, and that with a last column of ones, which takes the bias."""
    x = np.take(m["E"], ctx, axis=0).reshape(len(ctx), -1)
    t = x @ m["W"].reshape(x.shape[1], -1)
    t += m["b"]
    np.tanh(t, out=t)
    h = np.empty((len(t), t.shape[1] + 1), t.dtype)
    h[:, :-1], h[:, -1] = t, 1
    return x, t, h


def _output(m):
    """Output weights of the groups, and of the classes within each, with the biases as their last input."""
    return np.vstack([m["G"], m["g"]]), np.concatenate([m["V"], m["v"][:, None]], axis=1)


def _runs(group):
    """(group, from, to) of each run in ascending ``group``."""
    first = np.flatnonzero(np.diff(group, prepend=-1))
    return zip(group[first].tolist(), first.tolist(), [*first[1:].tolist(), len(group)])


def _inner_logits(h, inner, runs, room):
    for k, a, b in runs:
        np.matmul(h[a:b], inner[k], out=room[a:b])
    return room[:len(h)]


def log_probability(m, word: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    """log P(word | context) of each word."""
    out = np.empty(len(word))
    groups, _, per_group = m["V"].shape
    outer, inner = _output(m)
    order = _sorted(word // per_group, groups)        # words of a group side by side
    room = np.empty((min(PIECE, len(word)), groups), outer.dtype)          # there are as many groups as classes in each
    for a in range(0, len(word), PIECE):
        at = order[a:a + PIECE]
        group, within = np.divmod(word[at], per_group)
        h = _hidden(m, np.take(ctx, at, axis=0))[-1]
        lp = _picked(np.matmul(h, outer, out=room[:len(h)]), group).astype(float)
        out[at] = lp + _picked(_inner_logits(h, inner, _runs(group), room), within)
    return out


def _gradients(m, word, ctx):
    """Gradient of the mean of -log P(word | context)."""
    groups, _, per_group = m["V"].shape
    outer, inner = _output(m)
    back = m["W"].transpose(1, 0, 2).reshape(-1, len(m["b"]))            # by number in the embedding, then place around the word
    order = _sorted(word // per_group, groups)        # words of a group side by side
    ctx = np.take(ctx, order, axis=0)
    groups_of, within = np.divmod(word[order], per_group)
    room = np.empty((min(PIECE, len(word)), groups), outer.dtype)
    g_outer, g_inner = np.zeros_like(outer), np.zeros_like(inner)
    g = {"W": np.zeros_like(m["W"]), "b": np.zeros_like(m["b"])}
    dx = np.empty((len(back), len(word)), outer.dtype)
    for lo in range(0, len(word), PIECE):
        piece = slice(lo, lo + PIECE)
        group = groups_of[piece]
        runs = list(_runs(group))
        x, t, h = _hidden(m, ctx[piece])
        d, scale = _error(np.matmul(h, outer, out=room[:len(h)]), group, len(word))
        g_outer += (h * scale).T @ d
        dh = d @ m["G"].T
        dh *= scale
        d, scale = _error(_inner_logits(h, inner, runs, room), within[piece], len(word))
        scaled, dpre = h * scale, np.empty_like(dh)
        for k, a, b in runs:
            g_inner[k] += scaled[a:b].T @ d[a:b]
            np.matmul(d[a:b], m["V"][k].T, out=dpre[a:b])
        dpre *= scale
        dpre += dh
        t *= t
        dpre *= np.subtract(1, t, out=t)
        g["b"] += _total(dpre.T)
        g["W"] += (x.T @ dpre).reshape(m["W"].shape)
        np.matmul(back, dpre.T, out=dx[:, piece])
    at = ctx.T.ravel()
    dx = np.stack([np.bincount(at, d, len(m["E"])) for d in dx.reshape(-1, len(at))], axis=1, dtype=outer.dtype, casting="same_kind")
    return g | {"G": g_outer[:-1], "g": g_outer[-1], "V": g_inner[:, :-1], "v": g_inner[:, -1], "E": dx}


class Trainer:
    """Adam on batches of words."""

    def __init__(self, m):
        self.m = {k: v.copy() for k, v in m.items()}
        self.first = {k: np.zeros_like(v) for k, v in m.items()}
        self.second = {k: np.zeros_like(v) for k, v in m.items()}
        self.step = self.words = 0

    def batch(self, word, ctx, rate=RATE):
        self.step += 1
        self.words += len(word)
        a, b = (1 - 0.9 ** self.step) / 0.1, np.sqrt((1 - 0.995 ** self.step) / 0.005)      # the means are kept as sums
        for k, g in _gradients(self.m, word, ctx).items():
            whole = [x.reshape(-1) for x in (self.m[k], self.first[k], self.second[k], g)]
            for i in range(0, g.size, MOVED):
                m, first, second, d = (x[i:i + MOVED] for x in whole)
                first *= 0.9
                first += d
                d *= d
                second *= 0.995
                second += d
                np.sqrt(second, out=d)
                d += float(1e-7 * b)
                np.divide(first, d, out=d)
                d *= float(rate * b / a)
                m -= d


def flat(m) -> np.ndarray:
    return np.concatenate([m[k].ravel() for k in SHAPES]).astype(np.float32)


def unflat(x: np.ndarray, side: int = GROUPS) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in shapes(side).items():
        n = int(np.prod(s))
        out[k] = x[at:at + n].reshape(s).astype(np.float32)
        at += n
    return out


def _train(batches, state) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    weights, vocab, number, side = state.value
    t = Trainer(unflat(weights, side))
    for batch in batches:
        data, offsets = W.text_buffer(batch.column(0))
        for a, b in W.slices(offsets):
            h, doc = word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            word = classes(h, vocab, number, side * side)
            ctx = contexts(word, doc, side * side)
            rng = np.random.default_rng(len(word))
            order = rng.permutation(len(word))            # every word is a target once, masked from its own window
            size = min(BATCH, max(256, len(order) // 16))
            for i in range(0, len(order), size):
                t.batch(np.take(word, order[i:i + size]), np.take(ctx, order[i:i + size], axis=0))
    if t.words:
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([t.words], pa.int64()),
                                          pa.array([flat(t.m).tobytes()], pa.binary())], names=["part", "words", "weights"])


COPY = "part long, words long, weights binary"


def _mean(words: list[int], weights: list[bytes]) -> np.ndarray:
    share = np.array(words, dtype=float) / sum(words)
    return sum(s * np.frombuffer(w, dtype=np.float32).astype(float) for s, w in zip(share, weights))


def _merge(key, t: pa.Table) -> pa.Table:
    words = t.column("words").to_pylist()
    mean = _mean(words, t.column("weights").to_pylist()).astype(np.float32)
    return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "words": pa.array([sum(words)], pa.int64()),
                     "weights": pa.array([mean.tobytes()], pa.binary())})


def average(copies: DataFrame) -> np.ndarray | None:
    """The words-weighted mean of all copies, FAN_IN at a time."""
    copies = written(copies, "copies")
    while copies.count() > FAN_IN:
        by = F.floor(F.col("part") / FAN_IN).alias("part")
        copies = written(copies.select(by, "words", "weights").groupBy("part").applyInArrow(lambda key, t: _merge(key, t), COPY), "copies")
    rows = sorted(copies.collect(), key=lambda r: r["part"])
    return _mean([r["words"] for r in rows], [bytes(r["weights"]) for r in rows]) if rows else None


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> tuple[np.ndarray, Vocabulary]:
    """(weights, vocabulary) learned from all documents."""
    sc = docs.sparkSession.sparkContext
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    vocab = vocabulary(texts)
    weights = flat(new_network(vocab.counts))
    for r in range(rounds):
        state = sc.broadcast((weights, vocab.hashes, vocab.number, vocab.side))          # grows as the square root of the corpus
        fold = texts.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == r)
        got = average(fold.mapInArrow(lambda it, state=state: _train(it, state), COPY))
        weights = weights if got is None else got.astype(np.float32)
    return weights, vocab


def score_documents(docs: DataFrame, model=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, log_prob, mean_log_prob) for every row of ``docs``; log_prob is the masked pseudo-log-likelihood.

    A word without a class of its own counts with the probability of its hashed
    class times its share of that class; one that training has not seen gets an
    even part of what is left to unseen words.

    Defined cases: a null, empty or blank text has no tokens, a log_prob of 0 and
    no mean (null); rows that share an id, and rows with a null id, are scored
    each on their own; an empty table gives an empty one; further columns
    are not looked at.
    """
    weights, vocab = model or train(docs, text_col)
    state = docs.sparkSession.sparkContext.broadcast((weights, vocab.hashes, vocab.number, vocab.side, vocab.known, vocab.share))
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        weights, vocab, number, side, known, share = state.value
        m, row = unflat(weights, side), TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = W.text_buffer(batch.column(1))
            for a, b in W.slices(offsets):
                h, doc = word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                word = classes(h, vocab, number, side * side)
                lp = log_probability(m, word, contexts(word, doc, side * side))
                rare = np.flatnonzero(word >= side * side - RARE)
                at = _find(h[rare], known)
                here = at >= 0
                lp[rare[here]] += share[at[here]]
                rare = rare[~here]                    # the others' shares are joined
                rare = rare[np.lexsort((h[rare], doc[rare]))]
                rh, rd = h[rare], doc[rare]
                first = np.flatnonzero(np.concatenate([[True], (rh[1:] != rh[:-1]) | (rd[1:] != rd[:-1])])) if len(rare) else rare
                at = pa.array(np.searchsorted(rd[first], np.arange(b - a + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(b - a)), batch.column(0).slice(a, b - a), pa.array(np.bincount(doc, minlength=b - a), pa.int64()),
                     pa.array(np.bincount(doc, weights=lp, minlength=b - a).astype(float)),
                     pa.ListArray.from_arrays(at, pa.array(rh[first].view(np.int64))),
                     pa.ListArray.from_arrays(at, pa.array(np.diff(first, append=len(rare)), pa.int32()))],
                    names=["row", "id", "n_tokens", "log_prob", "rare", "times"])
                row += b - a

    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", kind), T.StructField("n_tokens", T.LongType()), T.StructField("log_prob", T.DoubleType()),
                           T.StructField("rare", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))])
    out = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema), "scores")
    rare = out.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    # No word of ``rare`` is frequent: those have classes of their own, or their shares are known in the tasks.
    never = F.element_at(F.array(*[F.lit(float(x)) for x in unseen(vocab)]), (F.col("word").bitwiseAND(RARE - 1) + 1).cast("int"))
    share = rare.join(in_class(vocab), "word", "left").groupBy("row").agg(F.sum(F.col("times") * F.coalesce("lp", never)).alias("share"))
    out = out.drop("rare", "times").join(share, "row", "left")
    out = out.select("id", "n_tokens", (F.col("log_prob") + F.coalesce("share", F.lit(0.0))).alias("log_prob"))
    return out.select(F.col("id").alias(id_col), "n_tokens", "log_prob",
                      F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")).alias("mean_log_prob"))
