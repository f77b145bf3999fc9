"""A character-level bidirectional LSTM with a CRF on top, in numpy: training, decoding and marginals."""

from __future__ import annotations

import numpy as np

PAD, LETTER, OTHER = 0, 128, 129
CLASSES = 130


def char_classes(text: str) -> np.ndarray:
    """ASCII characters are their own classes; other letters are one, everything else another."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    if len(codes) and codes.max() >= 128:
        high = np.flatnonzero(codes >= 128)
        codes[high] = [LETTER if text[k].isalpha() else OTHER for k in high]
    return codes


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class Tagger:
    def __init__(self, tags: int, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        h, scale = hidden, 0.2
        self.hidden, self.tags = hidden, tags
        self.p = {
            **{f"{d}w": rng.normal(0, scale, (CLASSES, 4 * h)) for d in "fb"},
            **{f"{d}u": rng.normal(0, scale, (h, 4 * h)) for d in "fb"},
            "e": rng.normal(0, scale, (2 * h, tags)),
            "c": np.zeros(tags),
            "t": np.zeros((tags, tags)),
        }
        for d in "fb":
            self.p[f"{d}w"][:, h : 2 * h] += 1.0  # remember by default
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _pass(self, x: np.ndarray, d: str) -> dict[str, np.ndarray]:
        """One direction over x [time, row]; keeps what the backward pass needs."""
        steps, rows = x.shape
        h, w, u = self.hidden, self.p[f"{d}w"], self.p[f"{d}u"]
        gates = np.empty((steps, rows, 4 * h), np.float32)
        cell, out = np.zeros((steps + 1, rows, h), np.float32), np.zeros((steps + 1, rows, h), np.float32)
        for t in range(steps):
            z = w[x[t]] + out[t] @ u
            z[:, : 3 * h] = _sigmoid(z[:, : 3 * h])
            z[:, 3 * h :] = np.tanh(z[:, 3 * h :])
            gates[t] = z
            cell[t + 1] = z[:, h : 2 * h] * cell[t] + z[:, :h] * z[:, 3 * h :]
            out[t + 1] = z[:, 2 * h : 3 * h] * np.tanh(cell[t + 1])
        return {"x": x, "gates": gates, "cell": cell, "out": out}

    def _back(self, kept: dict[str, np.ndarray], grad_out: np.ndarray, d: str) -> dict[str, np.ndarray]:
        h, u = self.hidden, self.p[f"{d}u"]
        gates, cell, out = kept["gates"], kept["cell"], kept["out"]
        steps, rows, _ = gates.shape
        dz = np.empty_like(gates)
        dh, dc = np.zeros((rows, h), np.float32), np.zeros((rows, h), np.float32)
        for t in reversed(range(steps)):
            i, f, o, g = (gates[t][:, k * h : (k + 1) * h] for k in range(4))
            tc = np.tanh(cell[t + 1])
            dh = dh + grad_out[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz[t][:, :h] = dc * g * i * (1 - i)
            dz[t][:, h : 2 * h] = dc * cell[t] * f * (1 - f)
            dz[t][:, 2 * h : 3 * h] = dh * tc * o * (1 - o)
            dz[t][:, 3 * h :] = dc * i * (1 - g * g)
            dc = dc * f
            dh = dz[t] @ u.T
        flat = dz.reshape(-1, 4 * h)
        own = np.eye(CLASSES, dtype=flat.dtype)[kept["x"].ravel()]
        return {f"{d}w": own.T @ flat, f"{d}u": out[:-1].reshape(-1, h).T @ flat}

    def emissions(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        """x [time, row] -> scores [time, row, tag]."""
        fore, back = self._pass(x, "f"), self._pass(x[::-1], "b")
        both = np.concatenate((fore["out"][1:], back["out"][1:][::-1]), 2)
        return both @ self.p["e"] + self.p["c"], (fore, back, both)

    def marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-partition [row], tag marginals [time, row, tag], summed transition marginals [tag, tag]."""
        steps, trans = len(e), self.p["t"]
        a, b = np.empty_like(e), np.zeros_like(e)
        a[0] = e[0]
        for t in range(1, steps):
            a[t] = e[t] + _logsum(a[t - 1][:, :, None] + trans, 1)
        for t in reversed(range(steps - 1)):
            b[t] = _logsum(trans + (e[t + 1] + b[t + 1])[:, None, :], 2)
        total = _logsum(a[-1], 1)
        pair = np.exp(a[:-1, :, :, None] + trans + (e[1:] + b[1:])[:, :, None, :] - total[None, :, None, None]).sum((0, 1))
        return total, np.exp(a + b - total[None, :, None]), pair

    def decode(self, e: np.ndarray) -> np.ndarray:
        """Best tags [time, row]."""
        steps, rows, tags = e.shape
        best, back = e[0], np.zeros((steps, rows, tags), np.int8)
        for t in range(1, steps):
            s = best[:, :, None] + self.p["t"]
            back[t] = s.argmax(1)
            best = s.max(1) + e[t]
        out = np.zeros((steps, rows), np.int64)
        out[-1] = best.argmax(1)
        for t in reversed(range(1, steps)):
            out[t - 1] = back[t][np.arange(rows), out[t]]
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of tags y [time, row], and its gradients."""
        rows = x.shape[1]
        e, (fore, back, both) = self.emissions(x)
        total, tag, pair = self.marginals(e)
        own = np.eye(self.tags, dtype=np.float32)[y]
        score = (e * own).sum((0, 2)) + self.p["t"][y[:-1], y[1:]].sum(0)
        de = ((tag - own) / rows).astype(np.float32)
        seen = np.zeros_like(self.p["t"])
        np.add.at(seen, (y[:-1].ravel(), y[1:].ravel()), 1)
        h = self.hidden
        dboth = de @ self.p["e"].T
        grads = {
            "e": both.reshape(-1, 2 * h).T @ de.reshape(-1, self.tags),
            "c": de.sum((0, 1)),
            "t": ((pair - seen) / rows).astype(np.float32),
            **self._back(fore, dboth[:, :, :h], "f"),
            **self._back(back, dboth[::-1, :, h:], "b"),
        }
        return float((total - score).mean()), grads

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int, batch: int = 48, rate: float = 0.05, seed: int = 11) -> list[float]:
        """Adam over random batches of the windows x, y [row, time]; returns the losses."""
        rng, losses = np.random.default_rng(seed), []
        m, v = ({k: np.zeros_like(w) for k, w in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            at = rng.integers(0, len(x), batch)
            loss, grads = self.gradients(x[at].T, y[at].T)
            losses.append(loss)
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.98 * v[k] + 0.02 * g * g
                now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
                self.p[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.98**step)) + 1e-6)
        return losses
