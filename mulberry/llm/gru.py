"""A gated recurrent language model in numpy, with class-factored output and truncated backpropagation through time.

Token 0 is the end (and, as an input, the start) of a document, the next ones stand for words out of the vocabulary, the others are
words by falling frequency. Tokens are cut into classes of about equal sums of square roots of counts; the probability of a token
is that of its class times its own within the class. Output biases start at the unigram frequencies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

EMBED, HIDDEN, CLASSES = 16, 24, 64
#: Streams trained side by side, and steps that gradients are carried back.
LANES, STEPS = 128, 32
#: Documents whose states are made at once in scoring: what fits a core's cache.
AT_ONCE = 2048


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place; where the exponential overflows to infinity, the reciprocal is the right 0."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def exponentials(e: np.ndarray) -> np.ndarray:
    """exp(e) in place and its sums over rows."""
    np.exp(e, out=e)
    return e @ np.ones(e.shape[1], e.dtype)


def steep(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether logits of states, which lie between -1 and 1, may pass what single precision's exponential can give (weights: one row an output)."""
    return bool((np.abs(weights).sum(1) + bias).max() > 80)


def class_bounds(counts: np.ndarray) -> np.ndarray:
    """First token of each class, and the end."""
    weight = np.cumsum(np.sqrt(counts + 1.0))
    cut = np.searchsorted(weight, weight[-1] * np.arange(1, CLASSES) / CLASSES) + 1
    return np.unique(np.concatenate([[0], np.minimum(cut, len(counts)), [len(counts)]]))


class Gru:
    """Parameters by name; ``counts`` are the training counts of the model's tokens."""

    def __init__(self, counts: np.ndarray, seed: int = 3):
        rng, n = np.random.default_rng(seed), len(counts)
        self.bounds = class_bounds(counts)
        self.class_of = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds)).astype(np.int32)
        share = counts + 0.5
        of_class = np.add.reduceat(share, self.bounds[:-1])
        some = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        self.p = {
            "embed": some(n, EMBED), "wx": some(EMBED, 3 * HIDDEN), "wh": some(HIDDEN, 3 * HIDDEN), "bx": np.zeros(3 * HIDDEN, np.float32),
            "wc": some(HIDDEN, len(of_class)) * 0.1, "bc": np.log(of_class / of_class.sum()).astype(np.float32),
            "wo": some(n, HIDDEN) * 0.1, "bo": np.log(share / of_class[self.class_of]).astype(np.float32)}

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.p.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for name, x in self.p.items():
            self.p[name] = flat[at : at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size

    def step(self, gates_x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        gates_h = h @ self.p["wh"]
        zr = sigmoid(gates_x[:, : 2 * HIDDEN] + gates_h[:, : 2 * HIDDEN])
        z, r, hn = zr[:, :HIDDEN], zr[:, HIDDEN:], gates_h[:, 2 * HIDDEN :]
        n = r * hn
        n += gates_x[:, 2 * HIDDEN :]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        return new, z, r, n, hn

    def output(self, h: np.ndarray, target: np.ndarray, back: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probabilities of the targets; with ``back``, adds gradients there and returns that of ``h``."""
        p, rows = self.p, np.arange(len(target))
        own = self.class_of[target]
        # rows of one class stand together, so that classes are slices
        order = np.argsort(own.astype(np.int16), kind="stable")
        own, h = own[order], h.take(order, axis=0)
        cuts, place = np.searchsorted(own, np.arange(len(self.bounds))), target[order] - self.bounds[own]
        e = h @ p["wc"]
        e += p["bc"]
        if steep(p["wc"].T, p["bc"]):
            np.minimum(e, 80, out=e)
        chosen = e[rows, own]
        total = exponentials(e)
        logs = chosen - np.log(total)
        dh = None
        if back is not None:
            e *= (1 / total)[:, None]
            e[rows, own] -= 1
            back["wc"] += h.T @ e
            back["bc"] += np.ones(len(e), e.dtype) @ e
            dh = e @ p["wc"].T
        totals, capped = np.empty_like(logs), steep(p["wo"], p["bo"])
        for c in np.flatnonzero(np.diff(cuts)).tolist():
            low, high, a, b = cuts[c], cuts[c + 1], self.bounds[c], self.bounds[c + 1]
            hs, words = h[low:high], p["wo"][a:b]
            e = hs @ words.T
            e += p["bo"][a:b]
            if capped:
                np.minimum(e, 80, out=e)
            k, at = rows[: high - low], place[low:high]
            chosen[low:high] = e[k, at]
            totals[low:high] = total = exponentials(e)
            if back is not None:
                e *= (1 / total)[:, None]
                e[k, at] -= 1
                back["wo"][a:b] += e.T @ hs
                back["bo"][a:b] += np.ones(high - low, e.dtype) @ e
                dh[low:high] += e @ words
        out = np.empty_like(logs)
        out[order] = logs + (chosen - np.log(totals))
        if back is None:
            return out, None
        d_h = np.empty_like(dh)
        d_h[order] = dh
        return out, d_h

    def score(self, documents: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each whole document (tokens without the end, which is scored too)."""
        length = np.array([len(x) + 1 for x in documents])
        order = np.argsort(-length, kind="stable")
        length = length[order]
        gates, out = self.p["embed"] @ self.p["wx"] + self.p["bx"], np.zeros(len(documents))
        h, at = np.zeros((len(documents), HIDDEN), np.float32), 0
        while at < length[0]:
            active = int(np.searchsorted(-length, -at, side="left"))
            steps = int(min(max(32, 40_000 // active), 512, length[0] - at))
            tokens = np.zeros((steps + 1, active), np.int32)
            for k in range(active):
                x = documents[order[k]]
                a, b = max(at - 1, 0), min(at + steps, len(x))
                if b > a:
                    tokens[a - at + 1 : b - at + 1, k] = x[a:b]
            alive = (at + np.arange(steps))[:, None] < length[None, :active]
            states = np.empty((steps, active, HIDDEN), np.float32)
            h = h[:active]
            for t, k in enumerate(alive.sum(1).tolist()):
                for low in range(0, k, AT_ONCE):
                    high = min(low + AT_ONCE, k)
                    h[low:high] = self.step(gates.take(tokens[t, low:high], axis=0), h[low:high])[0]
                states[t] = h
            where = np.flatnonzero(alive)
            logs, _ = self.output(states.reshape(-1, HIDDEN).take(where, axis=0), tokens[1:].ravel().take(where))
            out[:active] += np.bincount(where % active, weights=logs, minlength=active)
            at += steps
        result = np.empty(len(documents))
        result[order] = out
        return result


class Trainer:
    """Adam over truncated backpropagation; states are carried from window to window within each stream."""

    def __init__(self, model: Gru, rate: float = 0.01):
        self.model, self.rate, self.t = model, rate, 0
        # parameters, gradients and moments are one array each, of which the named ones are views
        self.flat = np.concatenate([x.ravel() for x in model.p.values()])
        self.grad, self.m, self.v, self.spare = (np.zeros_like(self.flat) for _ in range(4))
        self.grads, at = {}, 0
        for k, x in model.p.items():
            model.p[k] = self.flat[at : at + x.size].reshape(x.shape)
            self.grads[k] = self.grad[at : at + x.size].reshape(x.shape)
            at += x.size

    def train(self, documents: list[np.ndarray]) -> int:
        """One pass over whole documents, strung together and cut into streams; a start token clears the state. Gives the number of tokens."""
        if not documents:
            return 0
        start = np.zeros(1, np.int32)
        string = np.concatenate([np.concatenate([start, x]) for x in documents])
        target = np.append(string[1:], 0)
        lanes = max(1, min(LANES, len(string) // STEPS))
        long = -(-len(string) // lanes)
        fill = lanes * long - len(string)
        used = np.concatenate([np.ones(len(string), bool), np.zeros(fill, bool)]).reshape(lanes, long).T
        string = np.concatenate([string, np.zeros(fill, np.int32)]).reshape(lanes, long).T
        target = np.concatenate([target, np.zeros(fill, np.int32)]).reshape(lanes, long).T
        h = np.zeros((lanes, HIDDEN), np.float32)
        for low in range(0, long, STEPS):
            h = self.window(string[low : low + STEPS], target[low : low + STEPS], used[low : low + STEPS], h)
        return int(used.sum())

    def window(self, tokens: np.ndarray, target: np.ndarray, used: np.ndarray, h: np.ndarray) -> np.ndarray:
        p, steps = self.model.p, len(tokens)
        gates = (p["embed"] @ p["wx"] + p["bx"])[tokens] if tokens.size * 3 > len(p["embed"]) else p["embed"][tokens] @ p["wx"] + p["bx"]
        shape, kind = (*tokens.shape, HIDDEN), h.dtype
        states, before, z, r, c, hn = (np.empty(shape, kind) for _ in range(6))
        goes_on = (tokens != 0).astype(kind)[:, :, None]
        for t in range(steps):
            np.multiply(h, goes_on[t], out=before[t])
            h, z[t], r[t], c[t], hn[t] = self.model.step(gates[t], before[t])
            states[t] = h
        grads, n = self.grads, int(used.sum())
        self.grad[:] = 0
        if not n:
            return h
        d_states = np.zeros_like(states)
        if n == used.size:
            d_states = self.model.output(states.reshape(-1, HIDDEN), target.ravel(), grads)[1].reshape(shape)
        else:
            _, d_states[used] = self.model.output(states[used], target[used], grads)
        # what the gates' gradients are multiples of, for all steps at once
        of_c = (1 - z) * (1 - c * c)
        of_z = (before - c) * z * (1 - z)
        of_r = hn * r * (1 - r)
        d_gates, dc_all, dh = np.empty((*tokens.shape, 3 * HIDDEN), kind), np.empty(shape, kind), np.zeros_like(h)
        back = p["wh"].T.copy()
        for t in range(steps - 1, -1, -1):
            dh += d_states[t]
            dc, own = np.multiply(dh, of_c[t], out=dc_all[t]), d_gates[t]
            np.multiply(dh, of_z[t], out=own[:, :HIDDEN])
            np.multiply(dc, of_r[t], out=own[:, HIDDEN : 2 * HIDDEN])
            np.multiply(dc, r[t], out=own[:, 2 * HIDDEN :])
            dh *= z[t]
            dh += own @ back
            dh *= goes_on[t]
        grads["wh"] += before.reshape(-1, HIDDEN).T @ d_gates.reshape(-1, 3 * HIDDEN)
        d_gates[:, :, 2 * HIDDEN :] = dc_all
        flat, ids = d_gates.reshape(-1, 3 * HIDDEN), tokens.ravel()
        grads["bx"] += flat.sum(0)
        grads["wx"] += p["embed"][ids].T @ flat
        order = np.argsort(ids.astype(np.uint16) if len(p["embed"]) < 1 << 16 else ids, kind="stable")
        first = np.flatnonzero(np.diff(ids[order], prepend=-1))
        grads["embed"][ids[order][first]] = np.add.reduceat((flat @ p["wx"].T)[order], first, axis=0)
        self._adam(grads, n)
        return h

    def _adam(self, grads: dict[str, np.ndarray], n: int) -> None:
        self.t += 1
        g, spare = self.grad, self.spare
        scale = 1.0 / n
        norm = np.sqrt(float(np.dot(g, g))) * scale
        if norm > 1:
            scale /= norm
        rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        g *= scale
        self.m *= 0.9
        self.m += np.multiply(g, 0.1, out=spare)
        self.v *= 0.999
        self.v += np.multiply(np.multiply(g, g, out=spare), 0.001, out=spare)
        np.sqrt(self.v, out=spare)
        spare += 1e-8
        np.divide(self.m, spare, out=spare)
        spare *= rate
        self.flat -= spare


def groups(documents: Iterator[np.ndarray], most: int = 400_000) -> Iterator[list[np.ndarray]]:
    """Runs of documents of about ``most`` tokens."""
    held, n = [], 0
    for x in documents:
        held.append(x)
        n += len(x) + 1
        if n >= most:
            yield held
            held, n = [], 0
    if held:
        yield held
