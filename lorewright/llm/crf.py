"""A small linear-chain conditional random field over hashed features, in numpy."""

from __future__ import annotations

import zlib

import numpy as np


def hashed(names: list[str], bits: int) -> list[int]:
    mask = (1 << bits) - 1
    return [zlib.crc32(x.encode()) & mask for x in names]


class CRF:
    def __init__(self, tags: list[str], bits: int = 16) -> None:
        self.tags, self.bits = tags, bits
        k = len(tags)
        self.w = np.zeros((1 << bits, k), dtype=np.float32)
        self.trans = np.zeros((k, k))
        self.start = np.zeros(k)

    def fit(self, seqs: list[list[list[int]]], labels: list[list[int]], epochs: int = 12, rate: float = 0.15,
            l2: float = 1e-4, batch: int = 256) -> CRF:
        """Maximise the penalised likelihood by AdaGrad; sequences of one length are handled together."""
        by_len: dict[int, list[int]] = {}
        for i, s in enumerate(seqs):
            by_len.setdefault(len(s), []).append(i)
        k = len(self.tags)
        gw = np.full_like(self.w, 1e-3)
        gt, gs = np.full_like(self.trans, 1e-3), np.full_like(self.start, 1e-3)
        groups = []
        for _, same in sorted(by_len.items()):
            for a in range(0, len(same), batch):
                idx = same[a : a + batch]
                flat = np.array([f for i in idx for clause in seqs[i] for f in clause])
                many = np.array([len(c) for i in idx for c in seqs[i]])
                uniq, inv = np.unique(flat, return_inverse=True)
                groups.append((len(idx), len(seqs[idx[0]]), flat, many, uniq, inv, np.array([labels[i] for i in idx])))
        rng = np.random.default_rng(11)
        for _ in range(epochs):
            for g in rng.permutation(len(groups)):
                n, t_len, flat, many, uniq, inv, y = groups[g]
                em = _sums(self.w, flat, many).astype(np.float64).reshape(n, t_len, k)
                alpha, beta = np.zeros_like(em), np.zeros_like(em)
                alpha[:, 0] = em[:, 0] + self.start
                for t in range(1, t_len):
                    alpha[:, t] = em[:, t] + _lse(alpha[:, t - 1, :, None] + self.trans[None], 1)
                for t in range(t_len - 2, -1, -1):
                    beta[:, t] = _lse(self.trans[None] + (em[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
                z = _lse(alpha[:, -1], 1)
                post = np.exp(alpha + beta - z[:, None, None])
                grad = -post
                np.put_along_axis(grad, y[:, :, None], np.take_along_axis(grad, y[:, :, None], 2) + 1, 2)
                gtr = np.zeros_like(self.trans)
                for t in range(1, t_len):
                    pair = np.exp(
                        alpha[:, t - 1, :, None] + self.trans[None] + (em[:, t] + beta[:, t])[:, None, :]
                        - z[:, None, None]
                    )
                    gtr -= pair.sum(0)
                    np.add.at(gtr, (y[:, t - 1], y[:, t]), 1)
                step = np.repeat(grad.reshape(-1, k), many, axis=0)
                gsum = np.stack([np.bincount(inv, step[:, j], len(uniq)) for j in range(k)], 1)
                gsum = gsum / n - l2 * self.w[uniq]
                gw[uniq] += gsum**2
                self.w[uniq] += (rate * gsum / np.sqrt(gw[uniq])).astype(np.float32)
                gtr = gtr / n - l2 * self.trans
                gt += gtr**2
                self.trans += rate * gtr / np.sqrt(gt)
                gst = grad[:, 0].sum(0) / n - l2 * self.start
                gs += gst**2
                self.start += rate * gst / np.sqrt(gs)
        return self

    def decode_all(self, seqs: list[list[list[int]]]) -> list[list[int]]:
        """The likeliest tags of many sequences, those of one length together."""
        by_len: dict[int, list[int]] = {}
        for i, s in enumerate(seqs):
            by_len.setdefault(len(s), []).append(i)
        out: list[list[int]] = [[] for _ in seqs]
        for t_len, idx in by_len.items():
            flat = np.array([f for i in idx for c in seqs[i] for f in c])
            em = _sums(self.w, flat, np.array([len(c) for i in idx for c in seqs[i]])).astype(np.float64).reshape(len(idx), t_len, -1)
            score, back = em[:, 0] + self.start, []
            for t in range(1, t_len):
                s = score[:, :, None] + self.trans
                back.append(s.argmax(1))
                score = s.max(1) + em[:, t]
            path = [score.argmax(1)]
            for b in reversed(back):
                path.append(b[np.arange(len(idx)), path[-1]])
            for i, tags in zip(idx, np.stack(path[::-1], 1).tolist(), strict=True):
                out[i] = tags
        return out

    def decode(self, seq: list[list[int]]) -> list[int]:
        """The likeliest tags, by Viterbi."""
        em = [self.w[f].sum(0) for f in seq]
        score, back = em[0] + self.start, []
        for e in em[1:]:
            s = score[:, None] + self.trans
            back.append(s.argmax(0))
            score = s.max(0) + e
        path = [int(score.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


def _sums(w: np.ndarray, flat: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Summed weights of each clause's features; every clause has at least one."""
    return np.add.reduceat(w[flat], np.r_[0, np.cumsum(many)[:-1]])


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)
