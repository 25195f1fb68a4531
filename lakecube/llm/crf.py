"""A linear-chain conditional random field over three tags, in numpy.

Tags: 0 outside, 1 begin, 2 inside.  A token's score for a tag is the sum of the weights of its
active features; a sequence's score adds a transition per pair of neighbours and a
start score.  Training follows the gradient of the log-likelihood (forward
and backward sums); decoding is Viterbi, in blocks of tokens so that one long
sequence costs no more Python steps than many short ones.
"""

from __future__ import annotations

import functools

import numpy as np

TAGS = 3
NEVER = -1e4            # outside -> inside, and inside as a first tag
BLOCK = 64


def start_model(n_features: int) -> dict[str, np.ndarray]:
    move, start = np.zeros((TAGS, TAGS)), np.zeros(TAGS)
    move[0, 2] = start[2] = NEVER
    return {"w": np.zeros((n_features, TAGS), np.float32), "move": move, "start": start}


def emissions(m: dict[str, np.ndarray], idx: np.ndarray) -> np.ndarray:
    """Scores of each tag for tokens whose active features are the rows of ``idx``."""
    out = np.zeros((len(idx), TAGS), np.float32)
    for j in range(idx.shape[1]):
        out += m["w"][idx[:, j]]
    return out


def _lse(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def likelihood(m, emit: np.ndarray, tags: np.ndarray, size: np.ndarray):
    """Log-likelihood of ``tags`` (sequences x places, padded) and its gradients (emit, move, start)."""
    n, width, _ = emit.shape
    emit = emit.astype(float)
    inside = np.arange(width) < size[:, None]
    alpha, beta = np.zeros((n, width, TAGS)), np.zeros((n, width, TAGS))
    alpha[:, 0] = m["start"] + emit[:, 0]
    for t in range(1, width):
        new = _lse(alpha[:, t - 1, :, None] + m["move"], 1) + emit[:, t]
        alpha[:, t] = np.where(inside[:, t, None], new, alpha[:, t - 1])
    for t in range(width - 2, -1, -1):
        new = _lse(m["move"] + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where(inside[:, t + 1, None], new, 0)
    z = _lse(alpha[:, -1], 1)
    p = np.exp(alpha + beta - z[:, None, None]) * inside[:, :, None]
    hot = np.eye(TAGS)[tags] * inside[:, :, None]
    pair = np.exp(alpha[:, :-1, :, None] + m["move"] + (emit[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None])
    pair *= inside[:, 1:, None, None]
    seen = np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:])
    rows = np.arange(n)
    score = (hot * emit).sum() + (seen * m["move"]).sum() + m["start"][tags[rows, 0]].sum()
    return score - z.sum(), hot - p, seen - pair.sum(axis=(0, 1)), hot[:, 0].sum(0) - p[:, 0].sum(0)


def viterbi(m, emit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best tags of the sequences laid end to end in ``emit``; ``first`` marks where one begins.

    All blocks go forward together, a place at a time, with the blocks as the last axis: each step
    is a few operations on long rows of numbers.
    """
    n = len(emit)
    if not n:
        return np.zeros(0, np.int64)
    rows, tags = -(-n // BLOCK), range(TAGS)
    e = np.zeros((rows * BLOCK, TAGS))
    e[:n] = emit
    begin = np.zeros(rows * BLOCK, bool)
    begin[:n], begin[0] = first, True
    begin[n:] = True                                # what fills the last block stands alone
    e = np.ascontiguousarray(e.reshape(rows, BLOCK, TAGS).transpose(1, 2, 0))
    begin = np.ascontiguousarray(begin.reshape(rows, BLOCK).T)

    def step(v, t):                                # [j][i]: best score with tag i at t - 1, and j next
        # any tag before a beginning, at no cost
        return [[v[i] + np.where(begin[t], m["start"][j], m["move"][i, j]) for i in tags] for j in tags]

    whole = np.where(np.eye(TAGS, dtype=bool), 0.0, -np.inf)[:, :, None] + np.zeros(rows)
    for t in range(BLOCK):
        whole = [functools.reduce(np.maximum, c) + e[t, j] for j, c in enumerate(step(whole, t))]
    into, v = [], [0.0] * TAGS
    for block in np.stack(whole).transpose(2, 0, 1).tolist():           # one step per block
        into.append(v)
        v = [max(x + y for x, y in zip(v, c)) for c in block]
        top = max(v)
        v = [x - top for x in v]
    back = np.empty((BLOCK, TAGS, rows), np.int8)
    v = np.array(into).T
    for t in range(BLOCK):
        new = []
        for j, c in enumerate(step(v, t)):
            best, at = c[0], back[t, j]
            at[:] = 0
            for i in tags[1:]:
                at[c[i] > best] = i
                best = np.maximum(best, c[i])
            new.append(best + e[t, j])
        v = new
    source = np.repeat(np.arange(TAGS, dtype=np.int8)[:, None], rows, axis=1)
    for t in range(BLOCK - 1, -1, -1):
        source = np.choose(source, back[t])
    tag, last = int(np.argmax([x[-1] for x in v])), []
    for before in reversed(source.T.tolist()):
        last.append(tag)
        tag = before[tag]
    last = np.array(last[::-1], np.int8)
    out = np.empty((BLOCK, rows), np.int8)
    for t in range(BLOCK - 1, -1, -1):
        out[t] = last
        last = np.choose(last, back[t])
    return out.T.reshape(-1)[:n].astype(np.int64)


def train(idx: np.ndarray, tags: np.ndarray, size: np.ndarray, n_features: int, groups: list[list[int]], epochs: int = 12,
          steps: int = 300, batch: int = 256, rate: float = 0.05, drop: float = 0.25, decay: float = 1e-4, seed: int = 1) -> dict[str, np.ndarray]:
    """Fit by Adam, in ``epochs`` rounds or as many as make ``steps`` steps.  ``idx`` is sequences x places x features; the last feature number is a neutral one.

    In each batch a part of the sequences goes without one of the feature ``groups``, so that no single
    clue, such as the word before, is needed.
    """
    m = start_model(n_features)
    if not len(idx):
        return m
    rng = np.random.default_rng(seed)
    names = ("w", "move", "start")
    first, second = ({k: np.zeros_like(m[k], dtype=float) for k in names} for _ in range(2))
    step = 0
    for _ in range(max(epochs, -(-steps * batch // len(idx)))):
        order = rng.permutation(len(idx))
        for lo in range(0, len(order), batch):
            rows = order[lo:lo + batch]
            x = idx[rows].copy()
            for g in groups:
                off = rng.random(len(rows)) < drop
                x[np.ix_(off, np.arange(x.shape[1]), g)] = n_features - 1
            emit = emissions(m, x.reshape(-1, x.shape[2])).reshape(*x.shape[:2], TAGS)
            _, ge, gm, gs = likelihood(m, emit, tags[rows], size[rows])
            flat, ge = x.reshape(-1, x.shape[2]), ge.reshape(-1, TAGS)
            keep = np.abs(ge).sum(1) > 1e-6
            flat, ge = flat[keep], ge[keep]
            gw = np.stack([np.bincount(flat.ravel(), weights=np.repeat(ge[:, j], flat.shape[1]), minlength=n_features) for j in range(TAGS)], axis=1)
            gw[-1] = 0
            step += 1
            for k, g in zip(names, (gw / len(rows) - decay * m["w"], gm / len(rows), gs / len(rows))):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                m[k] = (m[k] + rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(m[k].dtype)
            m["move"][0, 2] = m["start"][2] = NEVER
    return m
