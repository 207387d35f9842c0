"""A small causal self-attention model in numpy: one attention block, one hidden layer, trained with Adam."""

from __future__ import annotations

import numpy as np

#: Positions a window holds, and how far the next one starts behind it.
WINDOW = 32
STRIDE = 16

#: Positions whose scores are worked out together, so that they stay in the cache.
ROWS = 2048


#: Exponents up to which powers and their sums are far from the ends of the numbers.
SAFE = 60.0


def _times(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``x @ w`` as one product of two matrices, not one for each window."""
    return (x.reshape(-1, x.shape[-1]) @ w).reshape(*x.shape[:-1], w.shape[-1])


def _totals(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis."""
    return (x.reshape(-1, x.shape[-1]) @ np.ones(x.shape[-1], x.dtype)).reshape(x.shape[:-1])


def _wide(x: np.ndarray) -> bool:
    """Whether exponents must be shifted before powers are taken."""
    return x.size > 0 and not (x.max() <= SAFE and x.min() >= -SAFE)


class Attention:
    """Next-id probabilities over ``size`` ids from at most ``window`` ids before."""

    def __init__(self, size: int, width: int = 16, hidden: int = 32, window: int = WINDOW, seed: int = 1, weights: dict | None = None):
        self.size, self.window = size, window
        r = np.random.default_rng(seed)
        shape = {
            "embed": (size, width), "place": (window, width), "ask": (width, width), "key": (width, width),
            "value": (width, width), "mix": (width, width), "up": (width, hidden), "up_bias": (hidden,),
            "down": (hidden, width), "out": (width, size), "bias": (size,),
        }
        self.weights = weights or {
            k: (r.normal(0, 1, s) / np.sqrt(s[0] if len(s) > 1 and k not in ("embed", "place") else 10)).astype(np.float32)
            if k not in ("bias", "up_bias")
            else np.zeros(s, np.float32)
            for k, s in shape.items()
        }
        self.mask = np.triu(np.full((window, window), -1e9, np.float32), 1)
        self.scale = np.float32(1 / np.sqrt(width))
        self._held = np.empty((0, size), np.float32)

    def _states(self, ids: np.ndarray, first: int = 0) -> dict:
        """All inner values for windows of ids (rows), from the position ``first`` on."""
        w, n = self.weights, ids.shape[1]
        x = np.take(w["embed"], ids, axis=0)
        x += w["place"][:n]
        s = {"x": x[:, first:], "k": x @ w["key"], "v": x @ w["value"]}
        s["q"] = s["x"] @ w["ask"]
        a = (s["q"] * self.scale) @ s["k"].transpose(0, 2, 1)
        a += self.mask[first:n, :n]
        a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
        a /= a.sum(axis=2, keepdims=True)
        s["a"], s["c"] = a, a @ s["v"]
        s["h"] = s["x"] + s["c"] @ w["mix"]
        s["u"] = np.maximum(s["h"] @ w["up"] + w["up_bias"], 0)
        s["z"] = s["h"] + s["u"] @ w["down"]
        return s

    def _last(self, ids: np.ndarray, first: int) -> np.ndarray:
        """The last of the inner values of :meth:`_states`, but for rounding; nothing is kept for gradients."""
        w, n = self.weights, ids.shape[1]
        x = np.take(w["embed"], ids, axis=0)
        x += w["place"][:n]
        k, v = _times(x, w["key"]), _times(x, w["value"])
        h = np.ascontiguousarray(x[:, first:])
        a = _times(h, w["ask"] * self.scale) @ k.transpose(0, 2, 1)
        wide = _wide(a)
        a += self.mask[first:n, :n]
        if wide:
            a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
        a /= _totals(a)[:, :, None]
        h += _times(a @ v, w["mix"])
        u = _times(h, w["up"])
        u += w["up_bias"]
        h += _times(np.maximum(u, 0, out=u), w["down"])
        return h

    def log_probabilities(self, ids: np.ndarray, rows: np.ndarray, columns: np.ndarray, targets: np.ndarray, first: int = 0) -> np.ndarray:
        """Natural logarithm of the probability of ``targets`` after the given positions of the windows, none before ``first``."""
        z = self._last(ids, first)[rows, columns - first]
        out = np.empty(len(targets), z.dtype)
        for a in range(0, len(targets), ROWS):
            part = slice(a, a + ROWS)
            scores = self._raw_scores(z[part])
            if _wide(scores):
                scores -= scores.max(axis=1, keepdims=True)
            own = scores[np.arange(len(scores)), targets[part]]
            np.exp(scores, out=scores)
            out[part] = own - np.log(_totals(scores))
        return out

    def _raw_scores(self, z: np.ndarray) -> np.ndarray:
        """Scores of all ids, in a table that the next call takes again."""
        if len(self._held) < len(z) or self._held.dtype != z.dtype:
            self._held = np.empty((len(z), self.size), z.dtype)
        scores = np.matmul(z, self.weights["out"], out=self._held[: len(z)])
        scores += self.weights["bias"]
        return scores

    def _scores(self, z: np.ndarray) -> np.ndarray:
        """The same, shifted to at most 0."""
        scores = self._raw_scores(z)
        scores -= scores.max(axis=1, keepdims=True)
        return scores

    def loss(self, ids: np.ndarray, targets: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over positions of weight 1, and its gradients."""
        w, s = self.weights, self._states(ids)
        n, t, d = s["z"].shape
        flat = s["z"].reshape(-1, d)
        p = self._scores(flat)
        at, goal, count = np.arange(n * t), targets.ravel(), max(1.0, weight.sum())
        own, share = p[at, goal], (weight.ravel() / count).astype(flat.dtype)
        np.exp(p, out=p)
        total = p.sum(axis=1)
        mean = float(((np.log(total) - own) * share).sum())
        p *= (share / total)[:, None]
        p[at, goal] -= share
        g = {"out": flat.T @ p, "bias": np.ones(len(p), p.dtype) @ p}
        dz = (p @ w["out"].T).reshape(n, t, d)
        sum_of = lambda a, b: np.tensordot(a, b, axes=((0, 1), (0, 1)))
        g["down"] = sum_of(s["u"], dz)
        du = dz @ w["down"].T
        du *= s["u"] > 0
        g["up"], g["up_bias"] = sum_of(s["h"], du), du.sum(axis=(0, 1))
        dh = dz + du @ w["up"].T
        g["mix"] = sum_of(s["c"], dh)
        dc = dh @ w["mix"].T
        da = dc @ s["v"].transpose(0, 2, 1)
        da = s["a"] * (da - (da * s["a"]).sum(axis=2, keepdims=True))
        parts = {
            "ask": da @ s["k"] * self.scale,
            "key": da.transpose(0, 2, 1) @ s["q"] * self.scale,
            "value": s["a"].transpose(0, 2, 1) @ dc,
        }
        dx = dh.copy()
        for k, part in parts.items():
            g[k] = sum_of(s["x"], part)
            dx += part @ w[k].T
        g["place"] = np.zeros_like(w["place"])
        g["place"][:t] = dx.sum(axis=0)
        # sums by id: rows of one id side by side
        order = np.argsort(ids.ravel(), kind="stable")
        present, first = np.unique(ids.ravel()[order], return_index=True)
        g["embed"] = np.zeros_like(w["embed"])
        g["embed"][present] = np.add.reduceat(dx.reshape(-1, d)[order], first, axis=0)
        return mean, g

    def train(self, ids: np.ndarray, targets: np.ndarray, weight: np.ndarray, steps: int, rate: float, batch: int = 64, seed: int = 0):
        """``steps`` of Adam; all windows are taken, in random order, before one is taken again."""
        if not len(ids):
            return
        r = np.random.default_rng(seed)
        order = np.concatenate([r.permutation(len(ids)) for _ in range(-(-steps * batch // len(ids)))] or [np.zeros(0, np.int64)])
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            pick = order[(step - 1) * batch : step * batch]
            _, gradients = self.loss(ids[pick], targets[pick], weight[pick])
            for k, g in gradients.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                self.weights[k] -= (rate * move).astype(np.float32)


def windows(sizes: np.ndarray, window: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For sequences laid end to end: each window's start, length, first scored position, and sequence.

    A sequence's first window scores all its positions; each later one starts ``stride`` further and scores only what
    lies behind the window before, so every position is scored once and has ``window - stride`` before it at least.
    """
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    per = 1 + np.maximum(0, -(-(sizes - window) // stride))
    owner = np.repeat(np.arange(len(sizes)), per)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    at = number * stride
    length = np.minimum(window, sizes[owner] - at)
    scored = np.where(number == 0, 0, window - stride)
    return starts[owner] + at, length, scored, owner
