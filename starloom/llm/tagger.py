"""A character-level bidirectional LSTM with a CRF layer, trained and run in numpy."""

from __future__ import annotations

import numpy as np


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lstm(x: np.ndarray, w: np.ndarray, b: np.ndarray, keep: bool = False):
    """Hidden states (n, length, h) of inputs (n, length, d); ``keep``: with what the backward pass needs."""
    n, length, d = x.shape
    h = b.shape[0] // 4
    out = np.zeros((n, length, h), np.float32)
    hidden, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
    inputs = x.reshape(-1, d) @ w[:d] + b
    inputs = inputs.reshape(n, length, 4 * h)
    cache = []
    for t in range(length):
        z = inputs[:, t] + hidden @ w[d:]
        gates = _sigmoid(z[:, : 3 * h])
        i, f, o = gates[:, :h], gates[:, h: 2 * h], gates[:, 2 * h:]
        g = np.tanh(z[:, 3 * h:])
        before, cell_before = hidden, cell
        cell = f * cell_before + i * g
        squashed = np.tanh(cell)
        hidden = o * squashed
        out[:, t] = hidden
        if keep:
            cache.append((before, cell_before, i, f, o, g, squashed))
    return out, cache


def lstm_back(grad: np.ndarray, x: np.ndarray, w: np.ndarray, cache):
    """Gradients of inputs, weights and bias from those of the hidden states."""
    n, length, d = x.shape
    h = grad.shape[2]
    dw, db, dx = np.zeros_like(w), np.zeros(4 * h, np.float32), np.zeros_like(x)
    dh, dc = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
    for t in range(length - 1, -1, -1):
        before, cell_before, i, f, o, g, squashed = cache[t]
        dh = dh + grad[:, t]
        dc = dc + dh * o * (1 - squashed ** 2)
        dz = np.concatenate((dc * g * i * (1 - i), dc * cell_before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g ** 2)), axis=1)
        dw[:d] += x[:, t].T @ dz
        dw[d:] += before.T @ dz
        db += dz.sum(axis=0)
        dx[:, t] = dz @ w[:d].T
        dh = dz @ w[d:].T
        dc = dc * f
    return dx, dw, db


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    def __init__(self, symbols: int, tags: int, width: int = 12, hidden: int = 24, seed: int = 4):
        rng = np.random.default_rng(seed)
        r = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        bias = np.zeros(4 * hidden, np.float32)
        bias[hidden: 2 * hidden] = 1  # remember at first
        self.p = {"E": r(symbols, width) * np.float32(np.sqrt(symbols) * 0.3), "F": r(width + hidden, 4 * hidden), "f": bias.copy(),
                  "B": r(width + hidden, 4 * hidden), "b": bias.copy(), "U": r(2 * hidden, tags), "u": np.zeros(tags, np.float32),
                  "T": np.zeros((tags, tags), np.float32), "s": np.zeros(tags, np.float32)}

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """Tag scores (n, length, tags) of windows of symbol codes."""
        p = self.p
        x = p["E"][codes]
        ahead, _ = lstm(x, p["F"], p["f"])
        back, _ = lstm(x[:, ::-1], p["B"], p["b"])
        return np.concatenate((ahead, back[:, ::-1]), axis=2) @ p["U"] + p["u"]

    def gradients(self, codes: np.ndarray, tags: np.ndarray):
        """Loss (mean negative log likelihood of a window) and gradients."""
        p = self.p
        n, length = codes.shape
        x = p["E"][codes]
        rev = np.ascontiguousarray(x[:, ::-1])
        ahead, ca = lstm(x, p["F"], p["f"], True)
        back, cb = lstm(rev, p["B"], p["b"], True)
        both = np.concatenate((ahead, back[:, ::-1]), axis=2)
        e = (both @ p["U"] + p["u"]).astype(np.float64)
        k, trans = e.shape[2], p["T"].astype(np.float64)
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + p["s"]
        for t in range(1, length):
            alpha[:, t] = e[:, t] + _log_sum(alpha[:, t - 1, :, None] + trans, 1)
        for t in range(length - 2, -1, -1):
            beta[:, t] = _log_sum(trans + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        total = _log_sum(alpha[:, -1], 1)
        rows = np.arange(n)
        own = p["s"][tags[:, 0]] + e[rows, 0, tags[:, 0]]
        de = np.exp(alpha + beta - total[:, None, None])
        ds = de[:, 0].sum(axis=0)
        dt = np.zeros_like(trans)
        for t in range(1, length):
            own = own + trans[tags[:, t - 1], tags[:, t]] + e[rows, t, tags[:, t]]
            pair = alpha[:, t - 1, :, None] + trans + (e[:, t] + beta[:, t])[:, None, :] - total[:, None, None]
            dt += np.exp(pair).sum(axis=0)
            np.add.at(dt, (tags[:, t - 1], tags[:, t]), -1)
        np.add.at(ds, tags[:, 0], -1)
        de[rows[:, None], np.arange(length)[None], tags] -= 1
        de = (de / n).astype(np.float32)
        g = {"U": both.reshape(-1, both.shape[2]).T @ de.reshape(-1, k), "u": de.sum(axis=(0, 1)), "T": (dt / n).astype(np.float32), "s": (ds / n).astype(np.float32)}
        dboth = de @ p["U"].T
        h = ahead.shape[2]
        dxa, g["F"], g["f"] = lstm_back(dboth[:, :, :h], x, p["F"], ca)
        dxb, g["B"], g["b"] = lstm_back(np.ascontiguousarray(dboth[:, ::-1, h:]), rev, p["B"], cb)
        g["E"] = np.zeros_like(p["E"])
        np.add.at(g["E"], codes, dxa + dxb[:, ::-1])
        return float((total - own).mean()), g

    def train(self, codes: np.ndarray, tags: np.ndarray, epochs: int = 10, batch: int = 48, rate: float = 0.01, seed: int = 4) -> float:
        """Adam over shuffled batches; the last epoch's mean loss."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, loss = 0, 0.0
        for epoch in range(epochs):
            order, losses = rng.permutation(len(codes)), []
            for a in range(0, len(order), batch):
                part = order[a:a + batch]
                loss, g = self.gradients(codes[part], tags[part])
                losses.append(loss)
                step += 1
                size = np.sqrt(sum(float((x ** 2).sum()) for x in g.values()))
                scale = min(1.0, 5 / max(size, 1e-9))
                now = rate * (0.1 ** (epoch / max(epochs, 1)))
                for key, x in g.items():
                    x = x * scale
                    m[key] = 0.9 * m[key] + 0.1 * x
                    v2[key] = 0.999 * v2[key] + 0.001 * x ** 2
                    self.p[key] -= (now * (m[key] / (1 - 0.9 ** step)) / (np.sqrt(v2[key] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
            loss = float(np.mean(losses))
        return loss

    def decode(self, e: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Best tag sequences (Viterbi) of several stretches of scores, padded to one length."""
        n, length, k = e.shape
        best = e[:, 0] + self.p["s"]
        came = np.zeros((n, length, k), np.int8)
        at_end = np.where((lengths == 1)[:, None], best, 0)
        for t in range(1, length):
            both = best[:, :, None] + self.p["T"]
            came[:, t] = both.argmax(axis=1)
            best = both.max(axis=1) + e[:, t]
            at_end = np.where((lengths == t + 1)[:, None], best, at_end)
        tag = at_end.argmax(axis=1)
        out = np.zeros((n, length), np.int8)
        for t in range(length - 1, -1, -1):
            out[:, t] = tag
            tag = np.where(t < lengths, came[np.arange(n), t, tag], tag) if t else tag
        return [out[i, : lengths[i]] for i in range(n)]
