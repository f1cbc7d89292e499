"""A small gated recurrent language model in numpy, with a class-factored softmax."""

from __future__ import annotations

import heapq

import numpy as np

WINDOW = 64


def lanes(docs: list[np.ndarray], width: int) -> np.ndarray:
    """Documents laid end to end in at most ``width`` lanes: [step, lane] = place in the concatenated documents, or -1.

    The longest document goes first, each to the shortest lane, so lanes end nearly together.
    """
    starts = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    heap = [(0, k) for k in range(width)]
    own: list[list[int]] = [[] for _ in range(width)]
    for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        size, k = heapq.heappop(heap)
        own[k].append(i)
        heapq.heappush(heap, (size + len(docs[i]), k))
    steps = max(size for size, _ in heap)
    out = np.full((steps, width), -1, np.int64)
    for k, ids in enumerate(own):
        at = 0
        for i in ids:
            n = len(docs[i])
            out[at:at + n, k] = np.arange(starts[i], starts[i] + n)
            at += n
    return out


def in_order(x: np.ndarray, kinds: int) -> np.ndarray:
    """Stable order of numbers below ``kinds``; numbers of two bytes are sorted by radix."""
    return np.argsort(x.astype(np.min_scalar_type(max(0, kinds - 1))), kind="stable")


class Gru:
    """p(token | text so far) = p(class | state) p(token | class, state).

    Tokens are 0 .. classes*size-1, and a token's class is token // size.  The
    state is zero where a document starts, and is carried from window to window.
    """

    def __init__(self, classes: int, size: int, hidden: int = 32, seed: int = 2):
        r = np.random.Generator(np.random.PCG64(seed))
        f = lambda *s: (r.standard_normal(s) / np.sqrt(s[-2] if len(s) > 1 else 1)).astype(np.float32)
        self.classes, self.size, self.hidden = classes, size, hidden
        tokens = classes * size
        self.p = {
            "table": f(tokens + 1, 3 * hidden) * np.float32(np.sqrt(tokens + 1) * 0.1),  # input to the gates; the last row starts a document
            "u": f(hidden, 3 * hidden) * np.float32(0.5),
            "cw": f(hidden, classes) * np.float32(0.1), "cb": np.zeros(classes, np.float32),
            "ww": f(classes, hidden, size) * np.float32(0.1), "wb": np.zeros((classes, size), np.float32),
        }

    def start_from(self, shares: np.ndarray) -> None:
        """Output biases of the unigram model with these token shares."""
        s = np.maximum(shares.reshape(self.classes, self.size), 1e-9)
        self.p["cb"] = np.log(s.sum(1)).astype(np.float32)
        self.p["wb"] = np.log(s / s.sum(1, keepdims=True)).astype(np.float32)

    def step(self, x: np.ndarray, h: np.ndarray):
        n = self.hidden
        g = h @ self.p["u"]
        a = x[:, :2 * n] + g[:, :2 * n]
        a *= 0.5
        np.tanh(a, out=a)
        a += 1
        a *= 0.5
        z, r = a[:, :n], a[:, n:]
        m = g[:, 2 * n:]
        c = np.tanh(x[:, 2 * n:] + r * m)
        return c + z * (h - c), (z, r, m, c)

    def output(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural-log probability of each target."""
        kind, inner = target // self.size, target % self.size
        order = in_order(kind, self.classes)
        h, kind = h[order], kind[order]  # the tokens of a class stand together
        out = np.empty(len(h), h.dtype)
        out[order] = self._log_p(self._class_scores(h), kind) + self._log_p(self._word_scores(h, kind)[0], inner[order])
        return out

    @staticmethod
    def _bounded(x: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
        if np.abs(w).sum(-2).max() + np.abs(b).max() > 60:  # states lie in [-1, 1], so below that exp() cannot overflow
            x -= x.max(1, keepdims=True)
        return x

    def _class_scores(self, h: np.ndarray) -> np.ndarray:
        return self._bounded(h @ self.p["cw"] + self.p["cb"], self.p["cw"], self.p["cb"])

    def _word_scores(self, h: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
        """Scores of the words of each row's class, and the rows of each class; rows are sorted by class."""
        x, w, b = np.empty((len(h), self.size), h.dtype), self.p["ww"], self.p["wb"]
        ends = np.searchsorted(kind, np.arange(self.classes + 1)).tolist()
        spans = [(k, slice(ends[k], ends[k + 1])) for k in range(self.classes) if ends[k] < ends[k + 1]]
        for k, own in spans:
            np.matmul(h[own], w[k], out=x[own])
            x[own] += b[k]
        return self._bounded(x, w, b), spans

    @staticmethod
    def _log_p(x: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log probabilities of the targets; ``x`` is used up."""
        picked = x[np.arange(len(x)), target]
        return picked - np.log(np.exp(x, out=x) @ np.ones(x.shape[1], x.dtype))

    @staticmethod
    def _softmax(x: np.ndarray, target: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities of the targets, and the gradient of their mean loss over ``total`` tokens; ``x`` is used up."""
        at = np.arange(len(x))
        picked = x[at, target]
        d = np.exp(x, out=x)
        mass = d @ np.ones(d.shape[1], d.dtype)
        d *= (1 / (mass * total))[:, None].astype(d.dtype)
        d[at, target] -= d.dtype.type(1 / total)
        return picked - np.log(mass), d

    def _inputs(self, docs: list[np.ndarray]):
        flat = np.concatenate(docs).astype(np.int32)
        previous = np.empty_like(flat)
        previous[1:] = flat[:-1]
        starts = np.cumsum([0, *[len(d) for d in docs[:-1]]])
        previous[starts] = self.classes * self.size
        return flat, previous, starts

    def score(self, docs: list[np.ndarray], width: int | None = None) -> np.ndarray:
        """Natural-log probability of each whole document; every one has a token at least."""
        total, longest = sum(map(len, docs)), max(map(len, docs))
        plan = lanes(docs, width or min(512, max(16, total // longest), len(docs)))
        flat, previous, _ = self._inputs(docs)
        of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        h = np.zeros((plan.shape[1], self.hidden), np.float32)
        out = np.zeros(len(docs))
        begin = self.classes * self.size
        table = self.p["table"]
        for t in range(0, len(plan), WINDOW):
            at = plan[t:t + WINDOW]
            used = at >= 0
            token = np.where(used, previous[at], begin)
            fresh = (token == begin).any(1)
            states = np.empty((len(at), *h.shape), np.float32)
            for s in range(len(at)):
                if fresh[s]:
                    h = np.where((token[s] == begin)[:, None], np.float32(0), h)
                h, _ = self.step(table[token[s]], h)
                states[s] = h
            place = at[used]
            out += np.bincount(of[place], self.output(states[used], flat[place]).astype(float), len(docs))
        return out

    def gradients(self, token: np.ndarray, target: np.ndarray, used: np.ndarray, h: np.ndarray):
        """Loss per token of one window, its gradients (truncated at the window's start), and the last state."""
        begin, n, p = self.classes * self.size, self.hidden, self.p
        steps, width = token.shape
        fresh = token == begin
        starts = fresh.any(1)
        x = p["table"][token]
        before, states = (np.empty((steps, width, n), h.dtype) for _ in range(2))
        z, r, m, c = (np.empty((steps, width, n), h.dtype) for _ in range(4))
        for s in range(steps):
            if starts[s]:
                h = np.where(fresh[s][:, None], h.dtype.type(0), h)
            before[s] = h
            h, (z[s], r[s], m[s], c[s]) = self.step(x[s], h)
            states[s] = h
        g = {k: np.zeros_like(v) for k, v in p.items()}
        hs, want = states[used], target[used]
        total = max(1, len(want))
        kind, word = want // self.size, want % self.size
        order = in_order(kind, self.classes)
        hs, kind, word = hs[order], kind[order], word[order]  # the tokens of a class stand together
        logp, d = self._softmax(self._class_scores(hs), kind, total)
        loss = -logp.sum(dtype=float)
        g["cw"], g["cb"] = hs.T @ d, np.ones(len(d), d.dtype) @ d
        dh = d @ p["cw"].T
        x, spans = self._word_scores(hs, kind)
        logp, d = self._softmax(x, word, total)
        loss -= logp.sum(dtype=float)
        for k, own in spans:
            part = d[own]
            g["ww"][k], g["wb"][k] = hs[own].T @ part, np.ones(len(part), d.dtype) @ part
            dh[own] += part @ p["ww"][k].T
        unsorted = np.empty_like(dh)
        unsorted[order] = dh
        back = np.zeros_like(states)
        back[used] = unsorted
        into = (1 - z) * (1 - c * c)  # what a state's gradient is to each gate's, for all steps at once
        factor = np.stack(((before - c) * z * (1 - z), into * m * r * (1 - r), into * r), 2)
        gates = np.empty((steps, width, 3 * n), h.dtype)
        later, turned = np.zeros_like(h), np.ascontiguousarray(p["u"].T)
        for s in range(steps - 1, -1, -1):
            d = back[s]
            d += later
            np.multiply(d[:, None, :], factor[s], out=gates[s].reshape(width, 3, n))
            later = gates[s] @ turned
            later += d * z[s]
            if starts[s]:
                later[fresh[s]] = 0
        g["u"] = before.reshape(-1, n).T @ gates.reshape(-1, 3 * n)
        grads = gates
        grads[:, :, 2 * n:] = back * into
        order = in_order(token.ravel(), begin + 1)
        rows = token.ravel()[order]
        first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        g["table"][rows[first]] = np.add.reduceat(grads.reshape(-1, 3 * n)[order], first)
        return loss / total, g, h

    def weights(self) -> np.ndarray:
        """All parameters end to end."""
        return np.concatenate([x.ravel() for x in self.p.values()])

    def set_weights(self, flat: np.ndarray) -> None:
        at = 0
        for k, x in self.p.items():
            self.p[k] = np.array(flat[at:at + x.size], x.dtype).reshape(x.shape)
            at += x.size

    def train(self, docs: list[np.ndarray], epochs: int = 3, width: int = 64, window: int = 32, rate: float = 4e-3,
              span: tuple[float, float] = (0.0, 1.0)) -> list[float]:
        """Truncated backpropagation through time with Adam; returns the loss of each epoch.

        The rate falls over a whole training, of which this call is the part from span[0] to span[1].
        """
        docs = [d for d in docs if len(d)]
        if not docs:
            return []
        flat, previous, _ = self._inputs(docs)
        plan = lanes(docs, min(width, len(docs)))
        begin = self.classes * self.size
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        t, losses, all_windows = 0, [], -(-len(plan) // window) * epochs
        for _ in range(epochs):
            h, seen, total = np.zeros((plan.shape[1], self.hidden), np.float32), 0, 0.0
            for s in range(0, len(plan), window):
                at = plan[s:s + window]
                used = at >= 0
                loss, g, h = self.gradients(np.where(used, previous[at], begin), flat[at], used, h)
                seen, total, t = seen + used.sum(), total + loss * used.sum(), t + 1
                norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
                scale = np.float32(min(1, 1 / max(norm, 1e-9)))
                now = np.float32(rate * (1 - 0.9 * (span[0] + (span[1] - span[0]) * t / all_windows)) * np.sqrt(1 - 0.99**t) / (1 - 0.9**t))
                for k, x in g.items():
                    x *= scale
                    m[k] += np.float32(0.1) * (x - m[k])
                    v2[k] += np.float32(0.01) * (x * x - v2[k])
                    self.p[k] -= now * m[k] / (np.sqrt(v2[k]) + np.float32(1e-8))
            losses.append(total / max(1, seen))
        return losses
