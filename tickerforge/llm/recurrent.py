"""The numpy core of the recurrent language model: a gated recurrent unit with a class-factored softmax.

Symbols are 0 (the end of a text), the ``words`` - 1 most frequent words, and one symbol for each class of
rarer words. Output classes are runs of symbols: the words are cut into runs of about equal sums of the square
root of their counts, and each symbol of rarer words is a class of its own. A symbol's probability is that
of its class times that within its class; both depend on the state.
"""

from __future__ import annotations

import numpy as np

#: Size of the state.
HIDDEN = 16
#: Steps that the gradient goes back, and lanes that are trained together.
STEPS, LANES = 32, 512
RATE = 0.15
#: Lanes of texts that are scored together.
WIDE = 512


class Vocabulary:
    """Class and place in it of every symbol, from the counts of the frequent words and the mass of the rarer classes."""

    def __init__(self, counts: np.ndarray, rare: np.ndarray, classes: int) -> None:
        """``counts`` of symbol 0 and the words in descending order of count; ``rare`` the mass of each class of rarer words."""
        mass = np.sqrt(counts + 0.5)
        run = np.minimum((np.cumsum(mass) - mass) / mass.sum() * classes, classes - 1).astype(int)
        starts = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
        self.words = len(counts)
        self.starts = np.concatenate((starts, np.arange(self.words, self.words + len(rare) + 1)))
        self.symbols, self.classes = self.words + len(rare), len(starts) + len(rare)
        self.class_of = np.repeat(np.arange(self.classes), np.diff(self.starts))
        weight = np.concatenate((counts + 0.5, rare))
        total = np.add.reduceat(weight, self.starts[:-1])
        self.class_bias = np.log(total / total.sum())
        self.bias = np.log(weight / total[self.class_of])

    def start(self) -> dict[str, np.ndarray]:
        """The first parameters: outputs that follow the counts alone, and small random inputs."""
        rng, h = np.random.default_rng(7), HIDDEN
        first = {
            "x": rng.normal(0, 0.1, (self.symbols, 3 * h)), "u": rng.normal(0, h**-0.5, (h, 3 * h)), "bn": np.zeros(h),
            "wc": np.zeros((h, self.classes)), "bc": self.class_bias, "wo": np.zeros((self.words, h)), "bo": self.bias[: self.words],
        }
        return {k: v.astype(np.float32) for k, v in first.items()}


def run_states(p: dict[str, np.ndarray], inputs: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: list | None = None) -> np.ndarray:
    """The states after each step of the inputs (steps, lanes); where ``fresh``, a text begins from the zero state."""
    n = HIDDEN
    drive, out = p["x"][inputs], np.empty((*inputs.shape, n), np.float32)
    u, bn, half, begun = p["u"], p["bn"], np.float32(0.5), fresh.any(axis=1).tolist()
    for t in range(len(inputs)):
        if begun[t]:
            h = np.where(fresh[t][:, None], np.float32(0), h)
        a = h @ u
        gate = a[:, : 2 * n] + drive[t, :, : 2 * n]
        gate *= half
        np.tanh(gate, out=gate)
        gate *= half
        gate += half
        z, r, inner = gate[:, :n], gate[:, n:], a[:, 2 * n :] + bn
        new = np.tanh(drive[t, :, 2 * n :] + r * inner)
        if keep is not None:
            keep.append((h, z, r, inner, new))
        h = new + z * (h - new)
        out[t] = h
    return out


def _by_class(v: Vocabulary, targets: np.ndarray):
    """(class, its first symbol, one past its last, the rows whose targets it holds) of the classes with several symbols."""
    classes = v.class_of[targets]
    order = np.argsort(classes, kind="stable")
    edges = np.flatnonzero(np.diff(classes[order], prepend=-1, append=v.classes))
    for a, b in zip(edges, edges[1:]):
        c = classes[order[a]]
        low, high = v.starts[c], v.starts[c + 1]
        if high - low > 1:
            yield low, high, order[a:b]


def _logits(states: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The logits less a constant, so that no exponential overflows and each row has one that doesn't vanish.

    States are within -1 and 1, so weights bound the logits; where that bound is too wide, a row's own maximum is taken.
    """
    reach = np.abs(weights).sum(axis=0)
    high = (bias + reach).max()
    logits = states @ weights
    logits += bias - high
    if high - (bias - reach).max() > 60:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def log_likelihoods(v: Vocabulary, p: dict[str, np.ndarray], states: np.ndarray, targets: np.ndarray, grads: dict | None = None) -> np.ndarray:
    """The natural logarithm of each target's probability in its state; ``grads`` gains the gradients of their negative sum."""
    rows, classes = np.arange(len(targets)), v.class_of[targets]
    shares = _logits(states, p["wc"], p["bc"])
    out = shares[rows, classes]
    np.exp(shares, out=shares)
    total = shares @ np.ones(v.classes, shares.dtype)
    out -= np.log(total)
    if grads is not None:
        shares /= total[:, None]
        shares[rows, classes] -= 1
        grads["wc"], grads["bc"], grads["state"] = states.T @ shares, shares.sum(axis=0), shares @ p["wc"].T
        grads["wo"] = []
    for low, high, at in _by_class(v, targets):
        own, spots = states[at], (np.arange(len(at)), targets[at] - low)
        shares = _logits(own, p["wo"][low:high].T, p["bo"][low:high])
        found = shares[spots]
        np.exp(shares, out=shares)
        total = shares @ np.ones(high - low, shares.dtype)
        out[at] += found - np.log(total)
        if grads is not None:
            shares /= total[:, None]
            shares[spots] -= 1
            grads["wo"].append((low, high, shares.T @ own, shares.sum(axis=0)))
            grads["state"][at] += shares @ p["wo"][low:high]
    return out


def _back(p: dict[str, np.ndarray], inputs: np.ndarray, fresh: np.ndarray, kept: list, onto: np.ndarray, grads: dict) -> None:
    """Gradients of the recurrence from those of the states (steps, lanes, hidden), back through the window."""
    n = HIDDEN
    drive, du, dbn, carried = np.empty((*inputs.shape, 3 * n), np.float32), np.zeros_like(p["u"]), np.zeros_like(p["bn"]), np.zeros_like(onto[0])
    for t in range(len(inputs) - 1, -1, -1):
        h, z, r, inner, new = kept[t]
        d = onto[t] + carried
        dn = d * (1 - z) * (1 - new * new)
        d_inner = dn * r
        drive[t, :, :n], drive[t, :, n : 2 * n], drive[t, :, 2 * n :] = d * (h - new) * z * (1 - z), dn * inner * r * (1 - r), dn
        da = np.concatenate((drive[t, :, : 2 * n], d_inner), axis=1)
        du += h.T @ da
        dbn += d_inner.sum(axis=0)
        carried = d * z + da @ p["u"].T
        if fresh[t].any():
            carried = np.where(fresh[t][:, None], np.float32(0), carried)
    flat, rows = inputs.ravel(), drive.reshape(-1, 3 * n)
    order = np.argsort(flat, kind="stable")
    edges = np.flatnonzero(np.diff(flat[order], prepend=-1))
    grads |= {"u": du, "bn": dbn, "x": (flat[order[edges]], np.add.reduceat(rows[order], edges, axis=0))}


class Learner:
    """Adaptive gradient steps (Duchi et al., 2011) on windows of the lanes."""

    def __init__(self, v: Vocabulary, p: dict[str, np.ndarray], squares: dict[str, np.ndarray]) -> None:
        self.v, self.p, self.squares, self.tokens, self.gained = v, p, squares, 0, 0.0

    def _move(self, name: str, at, g: np.ndarray) -> None:
        self.squares[name][at] += g * g
        self.p[name][at] -= np.float32(RATE) * g / np.sqrt(self.squares[name][at] + np.float32(1e-6))

    def learn(self, stream: np.ndarray, begins: np.ndarray) -> None:
        """One pass over texts laid end to end; ``begins`` marks their first symbols. Lanes are equal stretches of the stream.

        The state is carried from window to window; the gradient ends at a window's start.
        """
        lanes = max(1, min(LANES, len(stream) // STEPS))
        length = -(-len(stream) // lanes)
        spare = lanes * length - len(stream)
        targets = np.concatenate((stream, np.zeros(spare, stream.dtype))).reshape(lanes, length).T.astype(np.int64)
        fresh = np.concatenate((begins, np.ones(spare, bool))).reshape(lanes, length).T
        inputs = np.concatenate((np.zeros((1, lanes), np.int64), targets[:-1]))
        counted = (np.arange(lanes * length) < len(stream)).reshape(lanes, length).T
        h = np.zeros((lanes, HIDDEN), np.float32)
        for a in range(0, length, STEPS):
            x, f, y, c = inputs[a : a + STEPS], fresh[a : a + STEPS], targets[a : a + STEPS].ravel(), counted[a : a + STEPS].ravel()
            kept: list = []
            states = run_states(self.p, x, f, h, kept)
            h, flat = states[-1], states.reshape(-1, HIDDEN)
            grads: dict = {}
            if c.all():
                self.gained += float(log_likelihoods(self.v, self.p, flat, y, grads).sum())
                onto = grads["state"]
            else:
                self.gained += float(log_likelihoods(self.v, self.p, flat[c], y[c], grads).sum())
                onto = np.zeros_like(flat)
                onto[c] = grads["state"]
            _back(self.p, x, f, kept, onto.reshape(states.shape), grads)
            for name in ("wc", "bc", "u", "bn"):
                self._move(name, slice(None), grads[name])
            self._move("x", *grads["x"])
            for low, high, dw, db in grads["wo"]:
                self._move("wo", slice(low, high), dw)
                self._move("bo", slice(low, high), db)
        self.tokens += len(stream)


def score_texts(v: Vocabulary, p: dict[str, np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """The natural logarithm of each whole text's probability, the state carried from its first symbol to its last.

    Texts are dealt to lanes, the longest first; lanes of the longest are first, so those still running are the first ones.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    lanes: list[list[int]] = [[] for _ in range(max(1, min(WIDE, len(texts))))]
    filled = np.zeros(len(lanes), np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        k = int(filled.argmin())
        lanes[k].append(int(i))
        filled[k] += sizes[i]
    order = np.argsort(-filled, kind="stable")
    lanes, filled = [lanes[k] for k in order], filled[order]
    streams = [np.concatenate([texts[i] for i in lane]) if lane else np.zeros(0, np.uint16) for lane in lanes]
    owners = [np.repeat(np.array(lane, np.int32), sizes[lane]) if lane else np.zeros(0, np.int32) for lane in lanes]
    out, h = np.zeros(len(texts)), np.zeros((len(lanes), HIDDEN), np.float32)
    last = np.full(len(lanes), -1, np.int64)
    for a in range(0, int(filled[0]) if len(filled) else 0, STEPS):
        live = int((filled > a).sum())
        y = np.zeros((STEPS, live), np.int64)
        who = np.full((STEPS, live), -1, np.int64)
        for k in range(live):
            part = streams[k][a : a + STEPS]
            y[: len(part), k], who[: len(part), k] = part, owners[k][a : a + STEPS]
        x = np.concatenate((np.zeros((1, live), np.int64), y[:-1]))
        fresh = who != np.concatenate((last[None, :live], who[:-1]))
        if a:
            x[0] = previous[:live]
        x[fresh] = 0
        states = run_states(p, x, fresh, h[:live])
        h, last, previous = states[-1], who[-1], y[-1]
        real = who.ravel() >= 0
        found = log_likelihoods(v, p, states.reshape(-1, HIDDEN)[real], y.ravel()[real])
        out += np.bincount(who.ravel()[real], found, len(texts))
    return out
