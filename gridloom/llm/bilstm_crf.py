"""Character-level bidirectional LSTM with a CRF on top, in numpy.

Both directions run as one batched product. The squashing function is a quotient of
polynomials, in training as in use: numpy computes it several times as fast as ``tanh``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def squash(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x (27 + x^2) / (27 + 9 x^2) within [-3, 3], close to tanh, and its slope."""
    x = np.clip(x, -3, 3)
    xx = x * x
    low = 27 + 9 * xx
    y = x * (27 + xx) / low
    return y, np.where(np.abs(x) < 3, (27 + 3 * xx - 18 * x * y) / low, 0)


def _squash_in_place(x: np.ndarray, work: np.ndarray) -> None:
    np.clip(x, -3, 3, out=x)
    np.multiply(x, x, out=work)
    work += 27
    x *= work
    work *= 9
    work -= 216
    x /= work


@dataclass
class BiLstmCrf:
    """``table`` (2, classes, 4H): input part of the gates; ``inner`` (2, H, 4H); ``out`` (2H, K),
    ``bias`` (K); ``moves`` (K, K), ``first`` (K), ``last`` (K). Gates stand as input, forget,
    output, candidate; the first three are sigmoids, 0.5 + 0.5 squash."""

    table: np.ndarray
    inner: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    moves: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @classmethod
    def new(cls, classes: int, hidden: int, states: int, seed: int = 0) -> BiLstmCrf:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.3, shape)
        table = draw(2, classes, 4 * hidden)
        table[:, :, hidden : 2 * hidden] += 0.5  # remember at first
        return cls(table, draw(2, hidden, 4 * hidden), draw(2 * hidden, states), np.zeros(states),
                   np.zeros((states, states)), np.zeros(states), np.zeros(states))

    def parts(self) -> dict[str, np.ndarray]:
        return self.__dict__

    def emissions(self, windows: np.ndarray) -> np.ndarray:
        """Scores (rows, length, states) for windows of classes (rows, length)."""
        n, length = windows.shape
        h = self.inner.shape[1]
        # Features stand before rows, so that each gate is one stretch of memory.
        table = np.ascontiguousarray(self.table.transpose(0, 2, 1), np.float32)
        inner = np.ascontiguousarray(self.inner.transpose(0, 2, 1), np.float32)
        both = np.stack([windows.T, windows.T[::-1]], 1).astype(np.intp)  # length, direction, row
        state, cell = np.zeros((2, h, n), np.float32), np.zeros((2, h, n), np.float32)
        seen = np.empty((length, 2, h, n), np.float32)
        gates, work = np.empty((2, 4 * h, n), np.float32), np.empty((2, 4 * h, n), np.float32)
        squashed, spare = np.empty((2, h, n), np.float32), np.empty((2, h, n), np.float32)
        for t in range(length):
            np.matmul(inner, state, out=gates)
            for d in (0, 1):
                np.take(table[d], both[t, d], axis=1, out=work[d], mode="clip")
            gates += work
            _squash_in_place(gates, work)
            sigmoids = gates[:, : 3 * h]
            sigmoids *= 0.5
            sigmoids += 0.5
            cell *= gates[:, h : 2 * h]
            np.multiply(gates[:, :h], gates[:, 3 * h :], out=spare)
            cell += spare
            squashed[:] = cell
            _squash_in_place(squashed, spare)
            state = np.multiply(gates[:, 2 * h : 3 * h], squashed, out=seen[t])
        out = self.out.T.astype(np.float32)
        scores = np.matmul(out[:, :h], seen[:, 0]) + np.matmul(out[:, h:], seen[::-1, 1])  # length, state, row
        scores += self.bias.astype(np.float32)[:, None]
        return np.ascontiguousarray(scores.transpose(2, 0, 1))

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Best states (rows, length) under the transitions."""
        n, length, k = scores.shape
        best = scores[:, 0] + self.first
        came = np.zeros((length, n, k), np.int8)
        for t in range(1, length):
            paths = best[:, :, None] + self.moves
            came[t] = paths.argmax(1)
            best = np.take_along_axis(paths, came[t][:, None].astype(np.int64), 1)[:, 0] + scores[:, t]
        states = np.zeros((n, length), np.int8)
        states[:, -1] = (best + self.last).argmax(1)
        for t in range(length - 1, 0, -1):
            states[:, t - 1] = came[t][np.arange(n), states[:, t]]
        return states

    def may_leave(self, scores: np.ndarray) -> np.ndarray:
        """Rows whose best path may hold a state other than 0; the rest need no decoding."""
        gain = max(0.0, float((self.moves - self.moves[0, 0]).max()))
        ends = max(0.0, float((self.first - self.first[0]).max()), float((self.last - self.last[0]).max()))
        return (scores[:, :, 1:].max(2) - scores[:, :, 0]).max(1) + 2 * gain + 2 * ends >= 0

    # Training

    def loss(self, windows: np.ndarray, states: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of ``states`` and its gradient by part."""
        n, length = windows.shape
        h = self.inner.shape[1]
        both = np.stack([windows.T, windows.T[::-1]], 1)
        state, cell = np.zeros((2, n, h)), np.zeros((2, n, h))
        kept = []
        seen = np.empty((length, 2, n, h))
        for t in range(length):
            before = self.table[np.arange(2)[:, None], both[t]] + state @ self.inner
            y, slope = squash(before)
            gate, gate_slope = y[..., : 3 * h] * 0.5 + 0.5, slope * np.r_[np.full(3 * h, 0.5), np.ones(h)]
            old = cell
            cell = gate[..., h : 2 * h] * old + gate[..., :h] * y[..., 3 * h :]
            top, top_slope = squash(cell)
            kept.append((state, old, gate, y[..., 3 * h :], gate_slope, top, top_slope))
            state = seen[t] = gate[..., 2 * h :] * top
        joined = np.concatenate([seen[:, 0], seen[::-1, 1]], -1)  # length, row, 2H
        value, d_scores, grads = self._crf(joined @ self.out + self.bias, states.T)
        grads["out"] = np.einsum("tnh,tnk->hk", joined, d_scores)
        grads["bias"] = d_scores.sum((0, 1))
        d_joined = d_scores @ self.out.T
        d_seen = np.stack([d_joined[..., :h], d_joined[::-1, :, h:]], 1)
        grads["inner"] = np.zeros_like(self.inner)
        d_gates = np.empty((2, length, n, 4 * h))
        d_state, d_cell = np.zeros((2, n, h)), np.zeros((2, n, h))
        for t in range(length - 1, -1, -1):
            prior, old, gate, candidate, gate_slope, top, top_slope = kept[t]
            d_state = d_state + d_seen[t]
            d_cell = d_cell + d_state * gate[..., 2 * h :] * top_slope
            d_before = d_gates[:, t] = gate_slope * np.concatenate(
                [d_cell * candidate, d_cell * old, d_state * top, d_cell * gate[..., :h]], -1
            )
            grads["inner"] += prior.transpose(0, 2, 1) @ d_before
            d_state = d_before @ self.inner.transpose(0, 2, 1)
            d_cell = d_cell * gate[..., h : 2 * h]
        grads["table"] = np.stack([
            (np.arange(self.table.shape[1])[:, None] == both[:, d].reshape(1, -1)).astype(float)
            @ d_gates[d].reshape(length * n, 4 * h)
            for d in (0, 1)
        ])
        return value, grads

    def _crf(self, scores: np.ndarray, states: np.ndarray) -> tuple[float, np.ndarray, dict[str, np.ndarray]]:
        """(loss, gradient by score, gradients of the transitions); ``scores`` (length, row, state)."""
        length, n, k = scores.shape
        rows = np.arange(n)
        ahead, back = np.empty_like(scores), np.empty_like(scores)
        ahead[0], back[-1] = scores[0] + self.first, self.last
        for t in range(1, length):
            ahead[t] = _log_sum(ahead[t - 1][:, :, None] + self.moves, 1) + scores[t]
        for t in range(length - 2, -1, -1):
            back[t] = _log_sum(self.moves + (scores[t + 1] + back[t + 1])[:, None, :], 2)
        whole = _log_sum(ahead[-1] + self.last, 1)
        share = np.exp(ahead + back - whole[None, :, None])
        true = np.zeros_like(scores)
        np.put_along_axis(true, states[:, :, None].astype(np.int64), 1.0, 2)
        pairs = np.exp(
            ahead[:-1, :, :, None] + self.moves + (scores[1:] + back[1:])[:, :, None, :] - whole[None, :, None, None]
        ).sum((0, 1))
        np.add.at(pairs, (states[:-1].ravel(), states[1:].ravel()), -1.0)
        path = (scores * true).sum((0, 2)) + self.first[states[0]] + self.last[states[-1]]
        path = path + self.moves[states[:-1], states[1:]].sum(0)
        grads = {"moves": pairs / n, "first": (share[0] - true[0]).sum(0) / n, "last": (share[-1] - true[-1]).sum(0) / n}
        return float((whole - path).mean()), (share - true) / n, grads

    def train(self, windows: np.ndarray, states: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.02, seed: int = 0) -> list[float]:
        """Adam over shuffled batches with a falling rate; the loss of each epoch."""
        rng, parts = np.random.default_rng(seed), self.parts()
        first, second = ({k: np.zeros_like(v) for k, v in parts.items()} for _ in range(2))
        step, losses, total = 0, [], epochs * -(-len(windows) // batch)
        for _ in range(epochs):
            order, found = rng.permutation(len(windows)), []
            for at in range(0, len(order), batch):
                step += 1
                value, grads = self.loss(windows[order[at : at + batch]], states[order[at : at + batch]])
                found.append(value)
                norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-12))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    mean, spread = first[k] / (1 - 0.9**step), second[k] / (1 - 0.999**step)
                    parts[k] -= rate * (1 - 0.95 * step / total) * mean / (np.sqrt(spread) + 1e-8)
            losses.append(float(np.mean(found)))
        return losses


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)
