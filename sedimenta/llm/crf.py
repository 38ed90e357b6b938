"""Linear-chain conditional random field with dense features, in numpy.

Used inside tasks on batches of short sequences; training takes a bounded
sample on the driver.  Sequences are consecutive rows of ``x``; sequence ``s``
has rows ``first[s]`` to ``first[s + 1]``.
"""

from __future__ import annotations

import numpy as np


def _steps(first: np.ndarray) -> list[np.ndarray]:
    """Rows at position 0, 1, 2 ... of all sequences, longest sequence first."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    start, size = first[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), side="left")
    return [start[:n] + t for t, n in enumerate(active)]


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis=axis)) + np.squeeze(top, axis)


class Chain:
    """Weights ``w`` (features x labels), ``t`` (label to label), ``s`` (first label)."""

    def __init__(self, w: np.ndarray, t: np.ndarray, s: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.w, self.t, self.s, self.mean, self.scale = w, t, s, mean, scale

    def emit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1]

    def _forward(self, e: np.ndarray, steps: list[np.ndarray]):
        a, b = e.copy(), np.zeros_like(e)
        if not steps:
            return a, b
        a[steps[0]] += self.s
        for before, now in zip(steps, steps[1:]):
            a[now] += _logsum(a[before[:len(now)]][:, :, None] + self.t, 1)
        for before, now in reversed(list(zip(steps, steps[1:]))):
            b[before[:len(now)]] = _logsum((e[now] + b[now])[:, None, :] + self.t, 2)
        return a, b

    def marginals(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of every label of every row (forward-backward)."""
        a, b = self._forward(self.emit(x), _steps(first))
        p = a + b
        return np.exp(p - _logsum(p, 1)[:, None])

    def decode(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Best label sequence (Viterbi); of equal ones the lower label."""
        best, steps = self.emit(x), _steps(first)
        back = np.zeros(best.shape, dtype=np.int64)
        out = np.zeros(len(best), dtype=np.int64)
        if not steps:
            return out
        best[steps[0]] += self.s
        for before, now in zip(steps, steps[1:]):
            options = best[before[:len(now)]][:, :, None] + self.t
            back[now] = options.argmax(1)
            best[now] += options.max(1)
        for i in range(len(steps) - 1, -1, -1):
            now = steps[i]
            ended = len(steps[i + 1]) if i + 1 < len(steps) else 0
            out[now[ended:]] = best[now[ended:]].argmax(1)
            if ended:
                out[now[:ended]] = back[steps[i + 1], out[steps[i + 1]]]
        return out


def train(x: np.ndarray, y: np.ndarray, first: np.ndarray, labels: int = 2, rounds: int = 150,
          rate: float = 0.1, penalty: float = 1e-3) -> Chain:
    """Maximum likelihood by full-batch Adam; the same data give the same weights."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    chain = Chain(np.zeros((x.shape[1] + 1, labels)), np.zeros((labels, labels)), np.zeros(labels), mean, scale)
    steps = _steps(first)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    target = np.eye(labels)[y]
    pairs = list(zip(steps, steps[1:]))
    inner_to = np.concatenate([now for _, now in pairs]) if pairs else np.zeros(0, np.int64)
    inner_from = np.concatenate([a[:len(b)] for a, b in pairs]) if pairs else inner_to
    seen = np.zeros((labels, labels))
    np.add.at(seen, (y[inner_from], y[inner_to]), 1)
    params = [chain.w, chain.t, chain.s]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    n = max(1, len(x))
    for i in range(1, rounds + 1):
        e = z @ chain.w
        a, b = chain._forward(e, steps)
        log_p = a + b
        norm = _logsum(log_p, 1)
        p = np.exp(log_p - norm[:, None])
        grad_w = z.T @ (target - p)
        both = a[inner_from][:, :, None] + chain.t + (e[inner_to] + b[inner_to])[:, None, :] - norm[inner_to][:, None, None]
        grad_t = seen - np.exp(both).sum(0)
        heads = steps[0] if steps else np.zeros(0, np.int64)
        grad_s = (target[heads] - p[heads]).sum(0)
        for k, g in enumerate((grad_w, grad_t, grad_s)):
            g = g / n - penalty * params[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            params[k] += rate * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.999**i)) + 1e-8)
    return chain
