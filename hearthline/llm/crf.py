"""Linear-chain conditional random field in numpy: training on padded sequences, Viterbi over batches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class LinearChainCRF:
    """Emission weights [features, states], transitions [from, to], and scores of the first state."""

    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return x @ self.emission

    def viterbi(self, scores: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Best states of many sequences that lie one after another in `scores` [items, states].

        begins: where each sequence starts (ascending, none empty). All sequences advance together, and
        those that have ended drop out, so the work is that of the items plus one step per item of the
        longest sequence. Ties go to the smaller state.
        """
        total, k = scores.shape
        if not len(begins):
            return np.empty(0, np.int8)
        lengths = np.diff(np.append(begins, total))
        order = np.argsort(-lengths, kind="stable")
        begins, lengths = begins[order], lengths[order]
        back = np.zeros((total, k), np.int8)
        best = np.empty((total, k))
        best[begins] = self.start + scores[begins]
        live = len(begins)
        for t in range(1, int(lengths[0])):
            live = int(np.searchsorted(-lengths[:live], -t, "left"))
            at = begins[:live] + t
            ways = best[at - 1][:, :, None] + self.transition[None]
            back[at] = ways.argmax(axis=1)
            best[at] = ways.max(axis=1) + scores[at]
        states = np.empty(total, np.int8)
        ends = begins + lengths - 1
        states[ends] = best[ends].argmax(axis=1)
        for t in range(int(lengths[0]) - 1, 0, -1):
            live = int(np.searchsorted(-lengths, -t, "left"))
            at = begins[:live] + t
            states[at - 1] = back[at, states[at]]
        return states

    @staticmethod
    def train(x: np.ndarray, y: np.ndarray, lengths: np.ndarray, states: int, steps: int = 150, rate: float = 0.2, l2: float = 1e-3, weight: np.ndarray | None = None) -> LinearChainCRF:
        """Maximum likelihood with a quadratic penalty, by Adam on all sequences at once.

        x: [sequences, longest, features], y: [sequences, longest] states, lengths: items per sequence (1 at least),
        weight: what each sequence counts (default 1).
        """
        n, longest, d = x.shape
        mask = np.arange(longest)[None] < lengths[:, None]
        counts = mask if weight is None else mask * weight[:, None]
        one = np.eye(states)[y] * counts[..., None]
        flat = x[mask].astype(np.float32)
        seen_e = flat.T @ one[mask].astype(np.float32)
        seen_t = (np.eye(states)[y] * mask[..., None])[:, :-1].reshape(-1, states).T @ one[:, 1:].reshape(-1, states)
        seen_s = one[:, 0].sum(axis=0)
        params = [np.zeros((d, states)), np.zeros((states, states)), np.zeros(states)]
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
        count = counts.sum()
        for step in range(1, steps + 1):
            e, tr, st = params
            s = np.zeros((n, longest, states))
            s[mask] = flat @ e.astype(np.float32)
            alpha = np.empty((n, longest, states))
            alpha[:, 0] = st + s[:, 0]
            for t in range(1, longest):
                alpha[:, t] = np.where(mask[:, t, None], _lse(alpha[:, t - 1][:, :, None] + tr[None], 1) + s[:, t], alpha[:, t - 1])
            log_z = _lse(alpha[:, -1], 1)
            beta = np.zeros((n, longest, states))
            pair = np.zeros((states, states))
            for t in range(longest - 2, -1, -1):
                onward = tr[None] + (s[:, t + 1] + beta[:, t + 1])[:, None, :]
                beta[:, t] = np.where(mask[:, t + 1, None], _lse(onward, 2), 0)
                joint = np.exp(alpha[:, t][:, :, None] + onward - log_z[:, None, None])
                pair += (joint * counts[:, t + 1, None, None]).sum(axis=0)
            node = np.exp(alpha + beta - log_z[:, None, None]) * counts[..., None]
            grads = [seen_e - flat.T @ node[mask].astype(np.float32), seen_t - pair, seen_s - node[:, 0].sum(axis=0)]
            for p, g, m in zip(params, grads, moments):
                g = g / count - l2 * p
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.99 * m[1] + 0.01 * g * g
                p += rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
        return LinearChainCRF(*params)
