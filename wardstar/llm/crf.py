"""Linear-chain conditional random fields on hashed features, in numpy.

A sequence is a list of positions, a position a set of feature numbers.  Its
score under labels y is the sum of a weight per (feature, label), of a weight
per pair of neighbouring labels and of one per label at the start.  Sequences
of a batch are run side by side, longest first, one step per position.
"""

from __future__ import annotations

import numpy as np


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class Ragged:
    """Rows of sequences laid out step by step: sequences in falling length, so each step is a prefix of them."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        begins = np.concatenate([[0], np.cumsum(lengths)])[:-1][self.order]
        steps = int(self.lengths[0]) if len(lengths) else 0
        self.alive = np.searchsorted(-self.lengths, -np.arange(steps), side="left")  # sequences longer than the step
        self.begins = begins

    def rows(self, step: int) -> np.ndarray:
        return self.begins[: self.alive[step]] + step


def marginals(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label probabilities per row, expected transition counts and log partition per sequence (forward-backward).

    Rescaled probabilities are used; emissions are shifted per row, so that no exponential overflows.
    """
    n, k = emissions.shape
    shift = emissions.max(1, keepdims=True) if n else np.zeros((0, 1))
    e = np.exp(emissions - shift)
    move, first = np.exp(transitions), np.exp(start)
    layout = Ragged(lengths)
    forward, scale = np.zeros((n, k)), np.ones(n)
    state = None
    for t in range(len(layout.alive)):
        rows = layout.rows(t)
        state = (first if t == 0 else state[: len(rows)] @ move) * e[rows]
        total = state.sum(1)
        state = state / total[:, None]
        forward[rows], scale[rows] = state, total
    backward = np.ones((n, k))
    expected = np.zeros((k, k))
    for t in range(len(layout.alive) - 2, -1, -1):
        after = layout.rows(t + 1)
        here = after - 1
        pull = e[after] * backward[after] / scale[after][:, None]
        expected += forward[here].T @ pull * move
        backward[here] = pull @ move.T
    logs = np.add.reduceat(np.log(scale) + shift[:, 0], np.concatenate([[0], np.cumsum(lengths)])[:-1]) if n else np.zeros(0)
    return forward * backward, expected, logs


def viterbi(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The most probable label of each row given its whole sequence."""
    n, k = emissions.shape
    layout = Ragged(lengths)
    best, came = np.zeros((n, k)), np.zeros((n, k), np.int8)
    for t in range(len(layout.alive)):
        rows = layout.rows(t)
        if t == 0:
            best[rows] = start + emissions[rows]
        else:
            through = best[rows - 1][:, :, None] + transitions
            came[rows] = through.argmax(1)
            best[rows] = through.max(1) + emissions[rows]
    out = np.zeros(n, np.int64)
    for t in range(len(layout.alive) - 1, -1, -1):
        rows = layout.rows(t)
        last = layout.lengths[: len(rows)] == t + 1
        out[rows[last]] = best[rows[last]].argmax(1)
        on = rows[~last]
        out[on] = came[on + 1, out[on + 1]]
    return out


class Crf:
    def __init__(self, weights: np.ndarray, transitions: np.ndarray, start: np.ndarray):
        self.weights, self.transitions, self.start = weights, transitions, start

    def emissions(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Scores per position from its features (all positions' features in a row, and how many each has)."""
        sums = np.concatenate([np.zeros((1, self.weights.shape[1])), np.cumsum(self.weights[features], 0, dtype=np.float64)])
        ends = np.cumsum(counts)
        return sums[ends] - sums[ends - counts]


def fit(features: np.ndarray, counts: np.ndarray, lengths: np.ndarray, labels: np.ndarray, k: int, dims: int,
        epochs: int = 12, batch: int = 64, rate: float = 0.1, decay: float = 1e-4, seed: int = 11) -> Crf:
    """Maximum conditional likelihood by AdaGrad over mini-batches of sequences, with shrinkage.

    ``features``/``counts`` as in ``Crf.emissions``; ``lengths`` positions per
    sequence (each at least one); ``labels`` per position.
    """
    rnd = np.random.default_rng(seed)
    model = Crf(np.zeros((dims, k)), np.zeros((k, k)), np.zeros(k))
    squares = [np.full(x.shape, 1e-3) for x in (model.weights, model.transitions, model.start)]
    of_feature = np.concatenate([[0], np.cumsum(counts)])
    of_position = np.concatenate([[0], np.cumsum(lengths)])

    def ranges(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = ends - begins
        return np.repeat(begins - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())

    for _ in range(epochs):
        order = rnd.permutation(len(lengths))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            positions = ranges(of_position[some], of_position[some + 1])
            own = features[ranges(of_feature[positions], of_feature[positions + 1])]
            number, size, gold = counts[positions], lengths[some], labels[positions]
            probability, expected, _ = marginals(model.emissions(own, number), size, model.transitions, model.start)
            error = probability.copy()
            error[np.arange(len(gold)), gold] -= 1
            first = np.concatenate([[0], np.cumsum(size)[:-1]])
            inner = np.ones(len(gold), bool)
            inner[first] = False
            after = np.flatnonzero(inner)
            np.subtract.at(expected, (gold[after - 1], gold[after]), 1)
            row = np.repeat(np.arange(len(gold)), number)
            used, place = np.unique(own, return_inverse=True)
            gradient = np.stack([np.bincount(place, error[row, y], len(used)) for y in range(k)], 1) / len(some)
            gradient += decay * model.weights[used]
            squares[0][used] += gradient**2
            model.weights[used] -= rate * gradient / np.sqrt(squares[0][used])
            for x, s, g in ((model.transitions, squares[1], expected / len(some)), (model.start, squares[2], error[first].sum(0) / len(some))):
                s += g**2
                x -= rate * g / np.sqrt(s)
    return model
