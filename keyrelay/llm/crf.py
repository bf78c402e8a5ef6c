"""A small linear-chain conditional random field: training on a labelled table, Viterbi decoding in numpy batches."""

from __future__ import annotations

import numpy as np


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


class Chain:
    """Weights: ``emit`` (features x labels) and ``move`` (label to next label). Label 0 is "outside"."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    @staticmethod
    def train(sentences: list[tuple[np.ndarray, np.ndarray]], n_labels: int, steps: int = 400, rate: float = 0.5,
              decay: float = 1e-4) -> "Chain":
        """Sentences are (words x features 0/1 matrix, labels). Full-batch gradient ascent (Adagrad) on the likelihood."""
        longest, n_features = max(len(y) for _, y in sentences), sentences[0][0].shape[1]
        x = np.zeros((len(sentences), longest, n_features))
        y = np.zeros((len(sentences), longest), np.int64)
        size = np.array([len(labels) for _, labels in sentences])
        for k, (features, labels) in enumerate(sentences):
            x[k, :len(labels)], y[k, :len(labels)] = features, labels
        real = np.arange(longest) < size[:, None]
        one = np.eye(n_labels)[y] * real[:, :, None]
        inner = (real[:, 1:] & real[:, :-1])[:, :, None, None]
        seen_moves = (one[:, :-1, :, None] * one[:, 1:, None, :] * inner).sum((0, 1))
        emit, move = np.zeros((n_features, n_labels)), np.zeros((n_labels, n_labels))
        sums = [np.full(emit.shape, 1e-6), np.full(move.shape, 1e-6)]
        rows = np.arange(len(sentences))
        for _ in range(steps):
            e = x @ emit
            ahead, back = np.empty_like(e), np.zeros_like(e)
            ahead[:, 0] = e[:, 0]
            for t in range(1, longest):
                ahead[:, t] = e[:, t] + _logsum(ahead[:, t - 1, :, None] + move, 1)
            for t in range(longest - 2, -1, -1):
                step = _logsum(move + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
                back[:, t] = np.where(real[:, t + 1, None], step, 0)
            total = _logsum(ahead[rows, size - 1], 1)[:, None]
            node = np.exp(ahead + back - total[:, :, None]) * real[:, :, None]
            edge = np.exp(ahead[:, :-1, :, None] + move + (e[:, 1:] + back[:, 1:])[:, :, None, :]
                          - total[:, :, None, None]) * inner
            for w, s, g in zip((emit, move), sums, (np.einsum("stf,stl->fl", x, one - node),
                                                    seen_moves - edge.sum((0, 1)))):
                g = g / len(sentences) - decay * w
                s += g * g
                w += rate * g / np.sqrt(s)
        return Chain(emit, move)

    def decode(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """Best label sequence of each sequence of emission scores (words x labels), all sequences side by side.

        Sequences are taken longest first, so that at every word the live ones are a prefix of the batch.
        """
        order = sorted(range(len(scores)), key=lambda k: -len(scores[k]))
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(scores)
        sizes = np.array([len(scores[k]) for k in order])
        live = [int((sizes > t).sum()) for t in range(sizes[0] if len(sizes) else 0)]
        if not live or not live[0]:
            return out
        flat = np.concatenate([scores[k] for k in order])
        first = np.cumsum(sizes) - sizes
        best, links = flat[first[:live[0]]], []
        ends = np.empty(len(order), np.int64)
        for t in range(1, len(live)):
            ends[live[t]:live[t - 1]] = best[live[t]:].argmax(1)
            ways = best[:live[t], :, None] + self.move
            links.append(ways.argmax(1).astype(np.int8))
            best = ways.max(1) + flat[first[:live[t]] + t]
        ends[:live[-1]] = best.argmax(1)
        labels = np.empty(len(flat), np.int64)
        now = ends[:live[-1]]
        for t in range(len(live) - 1, -1, -1):
            now = np.concatenate([now, ends[len(now):live[t]]])
            labels[first[:live[t]] + t] = now
            if t:
                now = links[t - 1][np.arange(len(now)), now].astype(np.int64)
        for k, a, n in zip(order, first, sizes):
            out[k] = labels[a:a + n]
        return out

    def outside_wins(self, gain: float) -> bool:
        """Whether the best sequence is outside throughout if no word gains more than ``gain`` by another label.

        A run of k other labels gains at most k times ``gain``, k - 1 inner moves and the two moves around it.
        """
        stay = self.move[0, 0]
        inner = float(self.move[1:, 1:].max() - stay)
        around = float(self.move[0, 1:].max() + self.move[1:, 0].max() - 2 * stay)
        return gain + max(0.0, self.move[0, 1:].max() - stay, self.move[1:, 0].max() - stay, around) < 0 and gain + inner < 0
