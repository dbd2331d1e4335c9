"""Linear-chain conditional random field over the words of texts.

A word's score for each label is the sum of learned weights of its
features: the word itself, prefixes and suffixes of two to five bytes,
byte trigrams, and membership in learned lexicons.  Learned transitions
tie neighbouring labels; marginals come from the forward-backward
recurrences.

Texts of a batch form one chain in which the first word of a text resets
the state.  The chain is cut into equal blocks that advance side by
side: a first pass gives each block's transfer matrix, a short scan over
blocks the state at each border, a second pass the states inside.  The
result is exact for texts of any length, and the Python loop runs over
the positions of one block only.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa

from tessera.llm.bytetext import U, Words, mix, text_buffer

BUCKETS = 1 << 16
AFFIXES = (2, 3, 4, 5)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def lower(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin-1 letters in UTF-8."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    second = np.flatnonzero(data == 0xC3) + 1
    second = second[second < len(data)]
    second = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    out[second] += 32
    return out


def tokens(column: pa.Array) -> Words:
    """Runs of letters and digits, in lower case."""
    data, offsets = text_buffer(column)
    return Words(lower(data), offsets, ~_LETTER)


def joined(w: Words, a: int, b: int) -> str:
    """Words a to b as text."""
    return b" ".join(w.data[s:e].tobytes() for s, e in zip(w.start[a:b], w.end[a:b])).decode(errors="replace")


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def word_features(w: Words, at: np.ndarray, lexicons: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids, n + 1 offsets) of the words at positions ``at``."""
    s, e = w.start[at], w.end[at]
    cut = w.slices()
    whole = cut.hash(s, e)
    columns = [whole]
    valid = [np.ones(len(at), bool)]
    for n in AFFIXES:
        fits = e - s >= n
        columns += [cut.hash(s, np.minimum(s + n, e)) + U(2 * n), cut.hash(np.maximum(e - n, s), e) + U(2 * n + 1)]
        valid += [fits, fits]
    ids = [(mix(c) % U(BUCKETS)).astype(np.int64) for c in columns]
    for k, words in enumerate(lexicons):
        place = np.minimum(np.searchsorted(words, whole), max(len(words) - 1, 0))
        ids.append(np.full(len(at), BUCKETS + k))
        valid.append(words[place] == whole if len(words) else np.zeros(len(at), bool))
    size = np.maximum(e - s - 2, 0)
    byte = ranges(s, size)
    three = w.data[byte].astype(U) << U(16) | w.data[byte + 1].astype(U) << U(8) | w.data[byte + 2].astype(U) if len(byte) else np.zeros(0, U)
    fixed_ids, fixed_ok = np.stack(ids, 1), np.stack(valid, 1)
    row = np.concatenate([np.repeat(np.arange(len(at)), fixed_ok.sum(1)), np.repeat(np.arange(len(at)), size)])
    flat = np.concatenate([fixed_ids[fixed_ok], (mix(three + U(77)) % U(BUCKETS)).astype(np.int64)])
    order = np.argsort(row, kind="stable")
    return flat[order], np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(at)))])


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of rows [first[i], first[i + 1]); every span has a row."""
    return np.add.reduceat(values, first[:-1], axis=0) if len(first) > 1 else values[:0]


def forward_backward(emit: np.ndarray, step: np.ndarray, start: np.ndarray, reset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward and backward states of each position.

    emit (n, k), step (k, k) and start (k) are positive factors; where
    ``reset`` holds, the chain begins anew."""
    n, k = emit.shape
    length = max(1, int(np.sqrt(n)))
    blocks = -(-n // length)
    e = np.ones((blocks * length, k))
    e[:n] = emit
    r = np.ones(blocks * length, bool)
    r[:n] = reset
    e, r = e.reshape(blocks, length, k), r.reshape(blocks, length)

    def scaled(x: np.ndarray, t: int) -> np.ndarray:
        if t % 4:  # four steps stay far above the smallest double
            return x
        return x / x.reshape(len(x), -1).max(1).reshape(-1, *[1] * (x.ndim - 1))

    any_begun = r.any(0)

    transfer = np.broadcast_to(np.eye(k), (blocks, k, k))
    for t in range(length):
        moved = (transfer.reshape(-1, k) @ step).reshape(blocks, k, k)
        if any_begun[t]:
            begun = r[:, t]
            moved[begun] = transfer[begun].sum(2, keepdims=True) * start
        moved *= e[:, t, None, :]
        transfer = scaled(moved, t)
    transfer = scaled(transfer, 0)
    into, out = np.ones((blocks, k)), np.ones((blocks, k))
    for b in range(1, blocks):
        v = into[b - 1] @ transfer[b - 1]
        into[b] = v / v.max()
    for b in range(blocks - 1, 0, -1):
        v = transfer[b] @ out[b]
        out[b - 1] = v / v.max()
    alpha, beta, back = np.empty_like(e), np.empty_like(e), np.ascontiguousarray(step.T)
    v = into
    for t in range(length):
        moved = v @ step
        if any_begun[t]:
            moved = np.where(r[:, t, None], v.sum(1, keepdims=True) * start, moved)
        v = scaled(moved * e[:, t], t)
        alpha[:, t] = v
    v = out
    for t in range(length - 1, -1, -1):
        beta[:, t] = v
        u = v * e[:, t]
        moved = u @ back
        if any_begun[t]:
            moved = np.where(r[:, t, None], (u @ start)[:, None], moved)
        v = scaled(moved, t)
    return alpha.reshape(-1, k)[:n], beta.reshape(-1, k)[:n]


def normalised(x: np.ndarray) -> np.ndarray:
    return x / x.sum(1, keepdims=True)


@dataclasses.dataclass
class Field:
    """weights (features, labels), transitions, start scores, lexicons of
    sorted word hashes."""

    weights: np.ndarray
    step: np.ndarray
    start: np.ndarray
    lexicons: list[np.ndarray]

    def marginals(self, w: Words) -> np.ndarray:
        """Probability of each label at each word."""
        if not len(w):
            return np.zeros((0, len(self.start)))
        _, at, word = np.unique(w.hashes(), return_index=True, return_inverse=True)
        ids, first = word_features(w, at, self.lexicons)
        emit = np.exp(limited(segment_sums(self.weights[ids], first)))[word]
        reset = np.zeros(len(w), bool)
        reset[w.first[:-1][np.diff(w.first) > 0]] = True
        alpha, beta = forward_backward(emit, np.exp(self.step), np.exp(self.start), reset)
        return normalised(alpha * beta)


def limited(scores: np.ndarray) -> np.ndarray:
    """Scores relative to the word's best, no lower than -30: positive
    factors stay in range and marginals unchanged to 1e-13."""
    return np.maximum(scores - scores.max(1, keepdims=True), -30)


def fit(w: Words, at: np.ndarray, reset: np.ndarray, labels: np.ndarray, k: int, lexicons: list[np.ndarray],
        steps: int = 60, rate: float = 0.15, l2: float = 2e-4) -> Field:
    """Maximise the penalised likelihood of ``labels`` for the chain of
    words ``at`` (positions in ``w``), with Adam on the whole chain."""
    field = Field(np.zeros((BUCKETS + len(lexicons), k)), np.zeros((k, k)), np.zeros(k), lexicons)
    if not len(at):
        return field
    _, one, word = np.unique(w.hashes()[at], return_index=True, return_inverse=True)
    ids, first = word_features(w, at[one], lexicons)
    used, ids = np.unique(ids, return_inverse=True)
    span = np.repeat(np.arange(len(one)), np.diff(first))
    params = [np.zeros((len(used), k)), np.zeros((k, k)), np.zeros(k)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    n, inner = len(at), np.flatnonzero(~reset)
    truth = np.zeros((n, k))
    truth[np.arange(n), labels] = 1
    seen = np.zeros((k, k))
    np.add.at(seen, (labels[inner - 1], labels[inner]), 1)
    for i in range(1, steps + 1):
        emit = np.exp(limited(segment_sums(params[0][ids], first)))[word]
        step = np.exp(params[1])
        alpha, beta = forward_backward(emit, step, np.exp(params[2]), reset)
        miss = truth - normalised(alpha * beta)
        per_word = np.stack([np.bincount(word, miss[:, c], len(one)) for c in range(k)], 1)
        pull = np.stack([np.bincount(ids, per_word[span, c], len(used)) for c in range(k)], 1)
        ahead = (emit * beta)[inner]
        mass = ((alpha[inner - 1] @ step) * ahead).sum(1, keepdims=True)
        expected = step * (alpha[inner - 1].T @ (ahead / mass))
        grads = [pull / n - l2 * params[0] / 10, (seen - expected) / n - l2 * params[1], miss[reset].sum(0) / n - l2 * params[2]]
        for p, (m, v), g in zip(params, moments, grads):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.99 ** i)) + 1e-8)
    field.weights[used] = params[0]
    field.step, field.start = params[1], params[2]
    return field
