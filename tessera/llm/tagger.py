"""Character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

#: Character classes: 0 pads, 1 is any character outside printable ASCII, line end included as a blank.
CHARS = 97


def codes(window: str, width: int) -> np.ndarray:
    a = np.frombuffer(window.encode("utf-32-le"), dtype="<u4")[:width].astype(np.int64)
    out = np.zeros(width, dtype=np.int64)
    out[: len(a)] = np.where((a >= 32) & (a < 127), a - 30, np.where((a == 10) | (a == 9), 2, 1))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


class Tagger:
    def __init__(self, tags: int, allowed: np.ndarray, dim: int = 16, hidden: int = 24, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {"emb": rng.normal(0, 0.3, (CHARS, dim)), "out": rng.normal(0, 0.2, (2 * hidden, tags)), "bias": np.zeros(tags), "move": np.zeros((tags, tags)), "first": np.zeros(tags)}
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 1 / np.sqrt(dim), (dim, 4 * hidden))
            self.p["h" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            self.p["g" + d] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        #: Moves that no labelling can have count as this much less.
        self.barred = np.where(allowed, 0.0, -1e4).astype(np.float32)

    def _lstm(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """x: steps, rows, dim -> steps, rows, hidden, in the order of x."""
        hid, p = self.hidden, self.p
        pre = x @ p["x" + d] + p["g" + d]
        h = c = np.zeros((x.shape[1], hid), dtype=np.float32)
        out = np.empty((*x.shape[:2], hid), dtype=np.float32)
        for t in range(len(x)):
            z = pre[t] + h @ p["h" + d]
            s = _sigmoid(np.concatenate([z[:, : 2 * hid], z[:, 3 * hid :]], axis=1))
            i, f, o, g = s[:, :hid], s[:, hid : 2 * hid], s[:, 2 * hid :], np.tanh(z[:, 2 * hid : 3 * hid])
            before = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep is not None:
                keep.append((i, f, g, o, tc, *before))
        return out

    def emissions(self, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """x: rows, steps of codes -> steps, rows, tags."""
        e = self.p["emb"][x.T]
        kf, kb = ([], []) if keep is not None else (None, None)
        h = np.concatenate([self._lstm(e, "f", kf), self._lstm(e[::-1], "b", kb)[::-1]], axis=2)
        if keep is not None:
            keep.update(e=e, h=h, f=kf, b=kb)
        return h @ self.p["out"] + self.p["bias"]

    def loss_and_grads(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        keep: dict = {}
        em = self.emissions(x, keep)
        steps, rows, tags = em.shape
        move = self.p["move"] + self.barred
        y = y.T
        at = np.arange(rows)
        alpha, beta = np.empty_like(em), np.zeros_like(em)
        alpha[0] = em[0] + self.p["first"]
        for t in range(1, steps):
            alpha[t] = em[t] + _logsumexp(alpha[t - 1][:, :, None] + move, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsumexp(move + (em[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _logsumexp(alpha[-1], 1)
        gold = self.p["first"][y[0]] + sum(em[t, at, y[t]] for t in range(steps)) + sum(move[y[t - 1], y[t]] for t in range(1, steps))
        de = np.exp(alpha + beta - z[:, None])
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        for t in range(1, steps):
            pair = np.exp(alpha[t - 1][:, :, None] + move + (em[t] + beta[t])[:, None, :] - z[:, None, None])
            g["move"] += pair.sum(axis=0)
            np.add.at(g["move"], (y[t - 1], y[t]), -1)
        de[np.arange(steps)[:, None], at, y] -= 1
        g["first"] = de[0].sum(axis=0)
        g["bias"] = de.sum(axis=(0, 1))
        g["out"] = np.einsum("trh,trk->hk", keep["h"], de)
        dh = de @ self.p["out"].T
        dx = self._back(keep["e"], dh[:, :, : self.hidden], "f", keep["f"], g) + self._back(keep["e"][::-1], dh[::-1, :, self.hidden :], "b", keep["b"], g)[::-1]
        np.add.at(g["emb"], x.T, dx)
        return float((z - gold).mean()), {k: v / rows for k, v in g.items()}

    def _back(self, x: np.ndarray, dh: np.ndarray, d: str, keep: list, g: dict) -> np.ndarray:
        hid = self.hidden
        dz = np.empty((*x.shape[:2], 4 * hid), dtype=np.float32)
        h_next = c_next = np.zeros((x.shape[1], hid), dtype=np.float32)
        for t in range(len(x) - 1, -1, -1):
            i, f, gg, o, tc, c0, h0 = keep[t]
            dht = dh[t] + h_next
            dc = c_next + dht * o * (1 - tc * tc)
            dz[t] = np.concatenate([dc * gg * i * (1 - i), dc * c0 * f * (1 - f), dc * i * (1 - gg * gg), dht * tc * o * (1 - o)], axis=1)
            g["h" + d] += h0.T @ dz[t]
            h_next, c_next = dz[t] @ self.p["h" + d].T, dc * f
        g["x" + d] += np.einsum("trd,trk->dk", x, dz)
        g["g" + d] += dz.sum(axis=(0, 1))
        return dz @ self.p["x" + d].T

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.01, seed: int = 1) -> list[float]:
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(p) for k, p in self.p.items()} for _ in range(2))
        losses, n = [], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at : at + batch]
                loss, g = self.loss_and_grads(x[rows], y[rows])
                norm = np.sqrt(sum(float((q * q).sum()) for q in g.values()))
                n += 1
                for k, q in g.items():
                    q = q * min(1.0, 5.0 / (norm + 1e-9))
                    m[k] += 0.1 * (q - m[k])
                    v[k] += 0.01 * (q * q - v[k])
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**n)) / (np.sqrt(v[k] / (1 - 0.99**n)) + 1e-8)).astype(np.float32)
                losses.append(loss)
        return losses

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tags of each row: Viterbi."""
        em, move = self.emissions(x), self.p["move"] + self.barred
        steps, rows, _ = em.shape
        best, back = em[0] + self.p["first"], []
        for t in range(1, steps):
            s = best[:, :, None] + move
            back.append(s.argmax(axis=1))
            best = em[t] + s.max(axis=1)
        tag = best.argmax(axis=1)
        out = [tag]
        for b in reversed(back):
            tag = b[np.arange(rows), tag]
            out.append(tag)
        return np.stack(out[::-1], axis=1)
