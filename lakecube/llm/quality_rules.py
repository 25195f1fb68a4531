"""Quality rules (operator 7): a decision list learned by sequential covering.

Each document gets plain counts (one pass over whole texts, numpy inside Arrow
batches).  From labelled counts, rules are learned one after the other: a rule
is grown condition by condition (a statistic against a threshold, best FOIL
gain on the growing part), pruned from its end on the other part, and what it
covers is set aside before the next one.  The ordered rules become one Spark
``CASE WHEN`` over the statistics; the last branch keeps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .base import written

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_digits", "n_marks", "n_unique", "n_bare"]
SYMBOLS = b"#*$%&|<>"
MARKS = b".,;:!?"
REPEAT_WINDOW = 8
MAX_LABELLED = 20_000       # labelled rows the rules are fitted on, at most about so many

_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, dtype=np.uint8))
_MARK = np.isin(np.arange(256), np.frombuffer(MARKS, dtype=np.uint8))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_LETTER = _UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122)) | (np.arange(256) >= 128)


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _seen_before(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags: equal to an earlier (doc, hash); one of two or more equal ones."""
    order = np.lexsort((h, doc))
    same = np.zeros(len(order), bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    later = np.zeros(len(order), bool)
    later[order] = same
    either = same.copy()
    either[:-1] |= same[1:]
    twice = np.zeros(len(order), bool)
    twice[order] = either
    return later, twice


def count_slice(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS of the documents that ``offsets`` bound within ``data``."""
    n = len(offsets) - 1
    start, end, doc = W.words(data, offsets)
    prefix = W.prefix_hash(data)
    word = W.span_hash(prefix, start, end)
    head = (data & 0xC0) != 0x80
    heads = np.concatenate([[0], np.cumsum(head & ~W.is_blank(data))])
    letters = np.concatenate([[0], np.cumsum(_LETTER[data] | _DIGIT[data])])
    out = {"n_words": np.bincount(doc, minlength=n),
           "word_chars": np.bincount(doc, weights=heads[end] - heads[start], minlength=n).astype(np.int64),
           "n_symbols": _per_doc(_SYMBOL[data], offsets), "n_upper": _per_doc(_UPPER[data], offsets),
           "n_digits": _per_doc(_DIGIT[data], offsets), "n_marks": _per_doc(_MARK[data], offsets),
           "n_bare": np.bincount(doc, weights=letters[end] == letters[start], minlength=n).astype(np.int64)}
    later, _ = _seen_before(doc, word)
    out["n_unique"] = out["n_words"] - np.bincount(doc[later], minlength=n)

    # words that lie in a window of eight words found at least twice in the document
    w = W.window_hash(word, REPEAT_WINDOW)
    inside = doc[:len(w)] == doc[REPEAT_WINDOW - 1:REPEAT_WINDOW - 1 + len(w)] if len(w) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    _, twice = _seen_before(doc[at], w[at])
    edge = np.zeros(len(word) + 1, dtype=np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + REPEAT_WINDOW, -1)
    covered = np.cumsum(edge)[:-1] > 0
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=n)

    # lines: cut at \n and at document ends
    cuts = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([offsets[:-1], cuts + 1]), kind="stable")
    owner_cut = np.searchsorted(offsets, cuts, side="right") - 1
    line_doc = np.sort(np.concatenate([np.arange(n), owner_cut]), kind="stable")
    line_end = np.sort(np.concatenate([offsets[1:], cuts]), kind="stable")
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    solid = heads[line_end] > heads[line_start]
    later, _ = _seen_before(line_doc[solid], W.span_hash(prefix, line_start[solid], line_end[solid]))
    out["n_dup_lines"] = np.bincount(line_doc[solid][later], minlength=n)
    return out


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = W.text_buffer(batch.column(1))
        for a, b in W.slices(offsets):
            got = count_slice(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a)] + [pa.array(got[c], pa.int64()) for c in COUNTS],
                                             names=["id", *COUNTS])


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and COUNTS.  A null text counts as empty."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind)] + [T.StructField(c, T.LongType()) for c in COUNTS])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_count_batches, schema).withColumnRenamed("id", id_col)


#: What rules look at: name -> expression over COUNTS.
RATIOS = {
    "n_words": "double(n_words)",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "unique_share": "n_unique / greatest(n_words, 1)",
    "bare_share": "n_bare / greatest(n_words, 1)",
}


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool             # value >= threshold, else value < threshold
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, list(RATIOS).index(self.name)]
        return v >= self.threshold if self.above else v < self.threshold

    def column(self) -> Column:
        v = F.expr(RATIOS[self.name])
        return v >= F.lit(self.threshold) if self.above else v < F.lit(self.threshold)


def _covers(rule, x):
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _thresholds(v: np.ndarray, n: int = 40) -> np.ndarray:
    return np.unique(np.quantile(v, np.linspace(0.01, 0.99, n))) if len(v) else np.zeros(0)


def _grow(x, y, max_conditions):
    rule, now = [], np.ones(len(x), bool)
    while len(rule) < max_conditions:
        p0, n0 = int((y & now).sum()), int((~y & now).sum())
        if not p0 or not n0:
            break
        best = (1e-9, None)
        base = np.log2(p0 / (p0 + n0))
        for j, name in enumerate(RATIOS):
            v, yy = x[now, j], y[now]
            for t in np.union1d(_thresholds(v), _thresholds(v[yy])):
                high = v >= t
                for above, side in ((True, high), (False, ~high)):
                    p = int((yy & side).sum())
                    if p:
                        gain = p * (np.log2(p / int(side.sum())) - base)
                        if gain > best[0]:
                            best = (gain, Condition(name, above, float(t)))
        if best[1] is None:
            break
        rule.append(best[1])
        now &= best[1].holds(x)
    return rule


def _prune(rule, x, y):
    def value(r):
        c = _covers(r, x)
        p, n = int((y & c).sum()), int((~y & c).sum())
        return (p - n) / (p + n) if p + n else -1.0
    return max((rule[:k] for k in range(len(rule), 0, -1)), key=value, default=[])


def learn_rules(x: np.ndarray, y: np.ndarray, max_rules: int = 16, max_conditions: int = 4,
                least_precision: float = 0.9) -> list[list[Condition]]:
    """Ordered rules for the rows with ``y`` true (the ones to reject).  Empty without both classes."""
    rules: list[list[Condition]] = []
    part = np.arange(len(x)) % 3 == 2              # the pruning third; rows come in hash order
    left = np.ones(len(x), bool)
    while len(rules) < max_rules and y[left].any():
        grow, prune = left & ~part, left & part
        rule = _prune(_grow(x[grow], y[grow], max_conditions), x[prune], y[prune])
        hit = _covers(rule, x) & left
        good = int((y & hit & part).sum())
        if not rule or not good or good < least_precision * int((hit & part).sum()):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def rejected(rules: list[list[Condition]]) -> Column:
    """The decision list as one ordered conditional expression: true where a rule rejects."""
    out = None
    for rule in rules:
        c = rule[0].column()
        for more in rule[1:]:
            c = c & more.column()
        out = F.when(c, F.lit(True)) if out is None else out.when(c, F.lit(True))
    return F.lit(False) if out is None else out.otherwise(F.lit(False))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> tuple[DataFrame, list[list[Condition]]]:
    """(id, COUNTS, base_failed, kept) per row of ``docs``, and the learned rules.

    Rules are fitted on at most about ``max_labelled`` labelled rows that pass the
    base test (a hash-chosen share when there are more); they apply to all rows.

    Defined cases: a null or empty text has zero counts and fails the base test;
    without labels of both kinds there are no rules and only the base test
    decides; labels that are null or repeated count once, the smallest first;
    rows that share an id are judged one by one; an empty table gives an empty one.
    """
    stats = written(text_counts(docs, id_col, text_col).withColumn("base_failed", base_failed()), "counts")
    known = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__y")).dropna()
             .groupBy("__id").agg(F.min("__y").alias("__y")))
    total = known.count()
    ppm = 1_000_000 if total <= max_labelled else max(1, max_labelled * 1_000_000 // total)
    known = known.filter(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < ppm)
    rows = (stats.filter(~F.col("base_failed")).join(known, stats[id_col] == known["__id"])
            .select(F.xxhash64("__id").alias("__h"), "__y", *[F.expr(e).cast("double").alias(f"__x{i}") for i, e in enumerate(RATIOS.values())]))
    rows = rows.groupBy("__h").agg(F.min(F.struct(*[c for c in rows.columns if c != "__h"])).alias("r")).select("__h", "r.*")     # one row per id
    got = rows.toPandas().sort_values("__h", kind="stable")
    x = got[[f"__x{i}" for i in range(len(RATIOS))]].to_numpy(dtype=float)
    rules = learn_rules(x, got["__y"].to_numpy() == 0)
    return stats.withColumn("kept", ~F.col("base_failed") & ~rejected(rules)), rules
