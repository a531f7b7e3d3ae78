"""A character-level bidirectional LSTM with a CRF on top, in numpy.

Labels are O and, for each kind, begin and inside. Training minimises the CRF's negative log
likelihood with Adam, from a fixed seed. Everything is batched over windows of one length.
"""

from __future__ import annotations

import numpy as np

# Symbols: 0 padding, 1 other, 2 white space, 3 letters beyond ASCII, then printable ASCII.
SYMBOLS = 4 + 95


def encode(points: np.ndarray) -> np.ndarray:
    """Code points as symbols."""
    out = np.ones(len(points), np.int64)
    out[(points >= 0xC0) & (points < 0x2000)] = 3
    printable = (points >= 32) & (points < 127)
    out[printable] = points[printable].astype(np.int64) - 32 + 4
    out[(points <= 32) & (points > 0)] = 2
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Tagger:
    def __init__(self, kinds: int, hidden: int = 12, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.hidden, self.labels = hidden, 1 + 2 * kinds
        h, n = hidden, self.labels
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 0.3, (SYMBOLS, 4 * h))
            self.p["h" + d] = rng.normal(0, 0.3 / np.sqrt(h), (h, 4 * h))
            self.p["c" + d] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])
        self.p["out"] = rng.normal(0, 0.3, (2 * h, n))
        self.p["bias"] = np.zeros(n)
        self.p["step"] = np.zeros((n, n))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        # Inside follows only begin or inside of its kind.
        self.allowed = np.zeros((n, n), np.float32)
        for kind in range(kinds):
            inside = 2 + 2 * kind
            self.allowed[:, inside] = -1e4
            self.allowed[[inside - 1, inside], inside] = 0
        self.first = np.zeros(n, np.float32)

    def _direction(self, x: np.ndarray, d: str, trace: list | None) -> np.ndarray:
        """States at each step for symbols ``x`` of shape (steps, windows)."""
        h = self.hidden
        wx, wh, c0 = self.p["x" + d], self.p["h" + d], self.p["c" + d]
        state = np.zeros((x.shape[1], h), np.float32)
        cell = np.zeros_like(state)
        states = np.empty((x.shape[0], x.shape[1], h), np.float32)
        inputs = wx + c0
        steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        for t in steps:
            gates = inputs[x[t]]
            gates += state @ wh
            act = _sigmoid(gates[:, : 3 * h])
            new = np.tanh(gates[:, 3 * h :])
            before, last = cell, state
            cell = act[:, h : 2 * h] * cell + act[:, :h] * new
            squashed = np.tanh(cell)
            state = act[:, 2 * h :] * squashed
            states[t] = state
            if trace is not None:
                trace.append((t, act, new, before, squashed, last))
        return states

    def emissions(self, x: np.ndarray, traces: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Scores (steps, windows, labels) and the states they come from."""
        both = []
        for d in "fb":
            trace = None if traces is None else traces.setdefault(d, [])
            both.append(self._direction(x, d, trace))
        states = np.concatenate(both, axis=2)
        return states @ self.p["out"] + self.p["bias"], states

    def _loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        traces: dict = {}
        scores, states = self.emissions(x, traces)
        steps, windows, n = scores.shape
        move = self.p["step"] + self.allowed
        forward = np.empty_like(scores)
        forward[0] = scores[0] + self.first
        for t in range(1, steps):
            z = forward[t - 1][:, :, None] + move
            top = z.max(axis=1)
            forward[t] = top + np.log(np.exp(z - top[:, None]).sum(axis=1)) + scores[t]
        backward = np.zeros_like(scores)
        for t in range(steps - 2, -1, -1):
            z = move + (scores[t + 1] + backward[t + 1])[:, None, :]
            top = z.max(axis=2)
            backward[t] = top + np.log(np.exp(z - top[:, :, None]).sum(axis=2))
        top = forward[-1].max(axis=1)
        total = top + np.log(np.exp(forward[-1] - top[:, None]).sum(axis=1))
        column = np.arange(windows)
        gold = sum(scores[t, column, y[t]] for t in range(steps))
        gold = gold + sum(move[y[t - 1], y[t]] for t in range(1, steps))
        d_scores = np.exp(forward + backward - total[None, :, None])
        d_move = np.zeros((n, n), np.float32)
        for t in range(1, steps):
            pair = forward[t - 1][:, :, None] + move + (scores[t] + backward[t])[:, None, :]
            d_move += np.exp(pair - total[:, None, None]).sum(axis=0)
            np.add.at(d_move, (y[t - 1], y[t]), -1)
        for t in range(steps):
            d_scores[t, column, y[t]] -= 1
        d_scores /= windows
        grads = {
            "step": d_move / windows,
            "out": states.reshape(-1, states.shape[2]).T @ d_scores.reshape(-1, n),
            "bias": d_scores.sum(axis=(0, 1)),
        }
        d_states = d_scores @ self.p["out"].T
        h = self.hidden
        for d, part in (("f", d_states[:, :, :h]), ("b", d_states[:, :, h:])):
            wh = self.p["h" + d]
            gx, gh = np.zeros_like(self.p["x" + d]), np.zeros_like(wh)
            carry_s = np.zeros((windows, h), np.float32)
            carry_c = np.zeros((windows, h), np.float32)
            for t, act, new, before, squashed, last in reversed(traces[d]):
                ds = part[t] + carry_s
                i, f, o = act[:, :h], act[:, h : 2 * h], act[:, 2 * h :]
                dc = carry_c + ds * o * (1 - squashed**2)
                dg = np.concatenate(
                    [
                        dc * new * i * (1 - i),
                        dc * before * f * (1 - f),
                        ds * squashed * o * (1 - o),
                        dc * i * (1 - new**2),
                    ],
                    axis=1,
                )
                np.add.at(gx, x[t], dg)
                gh += last.T @ dg
                carry_s, carry_c = dg @ wh.T, dc * f
            grads["x" + d], grads["h" + d], grads["c" + d] = gx, gh, gx.sum(axis=0)
        return float((total - gold).mean()), grads

    def train(self, x: np.ndarray, y: np.ndarray, *, steps: int = 160, batch: int = 64, rate: float = 0.03, seed: int = 11) -> list[float]:
        """Fit windows ``x`` with labels ``y``, both (windows, steps); returns the losses."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses = []
        for step in range(1, steps + 1):
            chosen = rng.integers(0, len(x), batch)
            loss, grads = self._loss(x[chosen].T, y[chosen].T)
            losses.append(loss)
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            scale = min(1.0, 5.0 / max(norm, 1e-6))
            now = rate * (1 - 0.9 * step / steps)
            for k, g in grads.items():
                g = (g * scale).astype(np.float32)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                unbiased = mean[k] / (1 - 0.9**step)
                self.p[k] = self.p[k] - now * unbiased / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
        return losses

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best labels and, for each position, by how much its step beats one from O to O."""
        scores, _ = self.emissions(x.T)
        steps, windows, n = scores.shape
        move = self.p["step"] + self.allowed
        best = scores[0] + self.first
        back = np.empty((steps, windows, n), np.int8)
        for t in range(1, steps):
            z = best[:, :, None] + move
            back[t] = z.argmax(axis=1)
            best = z.max(axis=1) + scores[t]
        labels = np.empty((steps, windows), np.int8)
        labels[-1] = best.argmax(axis=1)
        column = np.arange(windows)
        for t in range(steps - 1, 0, -1):
            labels[t - 1] = back[t, column, labels[t]]
        margin = np.take_along_axis(scores, labels[:, :, None].astype(np.int64), axis=2)[:, :, 0]
        margin -= scores[:, :, 0]
        margin[1:] += move[labels[:-1], labels[1:]] - move[0, 0]
        return labels.T, margin.T
