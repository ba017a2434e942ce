"""A small gated recurrent language model in numpy with a class-factored output softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Shape:
    """Symbols 0..head-1 are words in classes of ``per_class`` (class = symbol // per_class); symbols
    head..head+tails-1 are tail classes, which have one symbol each."""

    head: int
    tails: int
    hidden: int = 16
    per_class: int = 32

    @property
    def head_classes(self) -> int:
        return -(-self.head // self.per_class)

    @property
    def classes(self) -> int:
        return self.head_classes + self.tails

    def class_of(self, symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < self.head, symbols // self.per_class, symbols - self.head + self.head_classes)

    def parts(self) -> list[tuple[str, tuple[int, ...]]]:
        h, words = self.hidden, self.head_classes * self.per_class
        return [
            ("x", (self.head + self.tails, 3 * h)),
            ("u", (h, 3 * h)),
            ("wc", (h, self.classes)),
            ("bc", (self.classes,)),
            ("wo", (words, h)),
            ("bo", (words,)),
        ]

    def size(self) -> int:
        return sum(int(np.prod(s)) for _, s in self.parts())


class Gru:
    """Parameters as views of one float32 vector ``theta``."""

    def __init__(self, shape: Shape, theta: np.ndarray):
        self.shape, self.theta = shape, theta
        self.p, self.rooms, at = {}, {}, 0
        for name, s in shape.parts():
            n = int(np.prod(s))
            self.p[name] = theta[at : at + n].reshape(s)
            at += n
        pad = shape.head_classes * shape.per_class - shape.head
        if pad:
            self.p["bo"][-pad:] = -1e4  # no words there

    @staticmethod
    def fresh(shape: Shape, frequency: np.ndarray) -> Gru:
        """Random weights; the output biases start at the log frequencies of the symbols."""
        rng = np.random.default_rng(3)
        m = Gru(shape, np.zeros(shape.size(), np.float32))
        for name in ("x", "u", "wc", "wo"):
            m.p[name][:] = rng.normal(0, 0.1, m.p[name].shape)
        f = np.maximum(frequency, 0.1)
        m.p["bo"][: shape.head] = np.log(f[: shape.head])
        m.p["bc"][:] = np.log(np.bincount(shape.class_of(np.arange(len(f))), f, minlength=shape.classes))
        return m

    def step(self, h: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state and what the backward step needs. x: the input's rows of the table. All come and
        go in column order, in which the gates' parts lie in one piece."""
        n = self.shape.hidden
        x = np.asfortranarray(x)
        g = (self.p["u"].T @ h.T).T
        zr = x[:, : 2 * n] + g[:, : 2 * n]
        zr *= np.float32(0.5)
        np.tanh(zr, out=zr)
        zr *= np.float32(0.5)
        zr += np.float32(0.5)
        z, r = zr[:, :n], zr[:, n:]
        c = r * g[:, 2 * n :]
        c += x[:, 2 * n :]
        np.tanh(c, out=c)
        nxt = h - c
        nxt *= z
        nxt += c
        return nxt, z, r, c, g[:, 2 * n :]

    def room(self, name: str, rows: int, n: int, dtype: np.dtype) -> np.ndarray:
        """An array kept from window to window: fresh ones of this size cost more than what is done in them."""
        held = self.rooms.get(name)
        if held is None or held.size < rows * n or held.dtype != dtype:
            held = self.rooms[name] = np.empty(rows * n, dtype)
        return held[: rows * n].reshape(rows, n)

    def logp(self, h: np.ndarray, target: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each target symbol's class times its word within the class; with
        ``grads`` also adds the output layer's gradients and returns that of the states."""
        s, p = self.shape, self.p
        k = s.class_of(target)
        row = np.arange(len(target))
        # classes x tokens: the sums run along the rows
        e = np.matmul(p["wc"].T, h.T, out=self.room("classes", s.classes, len(row), h.dtype))
        e += p["bc"][:, None]
        e -= e.max(axis=0)
        out = e[k, row]
        np.exp(e, out=e)
        total = e.sum(axis=0)
        out -= np.log(total)
        dh = None
        if grads is not None:
            e /= -total
            e[k, row] += 1
            grads["wc"] += (e @ h).T
            grads["bc"] += e.sum(axis=1)
            dh = e.T @ p["wc"].T
        # the words of the head by class, side by side: only the products are made class by class
        order = np.argsort(k.astype(np.uint16), kind="stable")
        ends = np.searchsorted(k[order], np.arange(s.head_classes + 1))
        order = order[: ends[-1]]
        if not len(order):
            return out, dh
        r, w, hs = row[: len(order)], target[order] % s.per_class, h.take(order, axis=0)
        e = self.room("words", s.per_class, len(order), h.dtype)
        classes = [
            (slice(c * s.per_class, (c + 1) * s.per_class), slice(ends[c], ends[c + 1]))
            for c in range(s.head_classes)
            if ends[c] < ends[c + 1]
        ]
        for words, at in classes:
            np.matmul(p["wo"][words], hs[at].T, out=e[:, at])
            e[:, at] += p["bo"][words][:, None]
        e -= e.max(axis=0)
        own = e[w, r]
        np.exp(e, out=e)
        total = e.sum(axis=0)
        out[order] += own - np.log(total)
        if grads is not None:
            e /= -total
            e[w, r] += 1
            d = np.empty_like(hs)
            for words, at in classes:
                grads["wo"][words] += e[:, at] @ hs[at]
                grads["bo"][words] += e[:, at].sum(axis=1)
                np.matmul(e[:, at].T, p["wo"][words], out=d[at])
            dh[order] += d
        return out, dh


def lanes(docs: list[np.ndarray], width: int) -> tuple[np.ndarray, ...]:
    """Documents laid end to end in at most ``width`` lanes, the longest first into the emptiest lane:
    symbols and document numbers lane after lane, and the lanes' starts and (falling) lengths."""
    import heapq

    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    heap = [(0, i, []) for i in range(min(width, len(docs)))]
    for i in order:
        n, lane, held = heapq.heappop(heap)
        held.append(i)
        heapq.heappush(heap, (n + len(docs[i]), lane, held))
    heap.sort(key=lambda x: -x[0])
    sequence = [i for _, _, held in heap for i in held]
    empty = np.zeros(0, np.int32)
    symbols = np.concatenate([empty, *[docs[i] for i in sequence]])
    owner = np.repeat(np.array(sequence, np.int32), [len(docs[i]) for i in sequence])
    length = np.array([x[0] for x in heap], np.int64)
    return symbols, owner, np.concatenate([[0], np.cumsum(length)])[: len(length)], length


def windows(model: Gru, docs: list[np.ndarray], width: int, steps: int, end: int, grads: bool) -> Iterator[tuple]:
    """Run the documents (each ending in symbol ``end``) window by window, the state carried from
    window to window and cleared where a document starts. Yields (document numbers, log
    probabilities, gradients) with truncated backpropagation within the window."""
    symbols, owner, start, length = lanes(docs, width)
    n = model.shape.hidden
    state = np.zeros((len(length), n), np.float32, order="F")
    before = np.full(len(length), end, np.int32)  # input symbol of the next step, and whose it is
    whose = np.full(len(length), -1, np.int32)
    longest = int(length[0]) if len(length) else 0
    for t0 in range(0, longest, steps):
        states, inputs, caches, places = [], [], [], []
        h = state
        for t in range(t0, min(t0 + steps, longest)):
            live = int(np.searchsorted(-length, -t, side="left"))
            h = h[:live]
            place = start[:live] + t
            fresh = owner[place] != whose[:live]
            inp = before[:live]
            if fresh.any():
                h = h.copy(order="F")
                h[fresh] = 0
                inp = np.where(fresh, np.int32(end), inp)
            nxt, *cache = model.step(h, model.p["x"].take(inp, axis=0))
            inputs.append(inp)
            caches.append((h, fresh, *cache))
            states.append(nxt)
            places.append(place)
            before, whose, h = symbols[place], owner[place], nxt
        state = h
        hs = np.ascontiguousarray(np.concatenate(states))
        place = np.concatenate(places)
        target, docs_here = symbols[place], owner[place]
        g = {k: np.zeros_like(v) for k, v in model.p.items()} if grads else None
        out, dh = model.logp(hs, target, g)
        if grads:
            _backward(model, g, caches, inputs, dh)
        yield docs_here, out, g


def _backward(model: Gru, g: dict, caches: list, inputs: list, dh: np.ndarray) -> None:
    n, u = model.shape.hidden, model.p["u"]
    ends = np.cumsum([0, *[len(x) for x in inputs]])
    carry = np.zeros((0, n), np.float32)
    dx_all = np.empty((ends[-1], 3 * n), np.float32)
    for i in range(len(caches) - 1, -1, -1):
        h, fresh, z, r, c, gn = caches[i]
        d = dh[ends[i] : ends[i + 1]].copy(order="F")  # column order, as in step
        d[: len(carry)] += carry
        dx = np.empty((len(d), 3 * n), d.dtype, order="F")
        dz, dr, dc = dx[:, :n], dx[:, n : 2 * n], dx[:, 2 * n :]
        less = 1 - z
        np.multiply(d, less, out=dc)
        dc *= 1 - c * c
        np.multiply(d, h - c, out=dz)
        dz *= z
        dz *= less
        np.multiply(dc, gn, out=dr)
        dr *= r
        dr *= 1 - r
        dx_all[ends[i] : ends[i + 1]] = dx
        dc *= r
        g["u"] += np.ascontiguousarray(h).T @ np.ascontiguousarray(dx)
        d *= z
        d += (u @ dx.T).T
        if fresh.any():
            d[fresh] = 0
        carry = d
    ids = np.concatenate(inputs)
    order = np.argsort(ids.astype(np.uint16 if model.shape.head + model.shape.tails < 65536 else np.int32), kind="stable")
    u_ids, first = np.unique(ids[order], return_index=True)
    g["x"][u_ids] += np.add.reduceat(dx_all.take(order, axis=0), first, axis=0)


class Adam:
    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size, np.float32), np.zeros(size, np.float32), 0, rate

    def ascend(self, theta: np.ndarray, g: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.01 * (g * g - self.v)
        theta += self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-6)


def train(model: Gru, docs: list[np.ndarray], width: int, steps: int, end: int, adam: Adam) -> None:
    """One pass of truncated backpropagation over the whole documents, an Adam step per window; the state
    is carried through a document of any length."""
    for _, out, g in windows(model, docs, width, steps, end, True):
        flat = np.concatenate([g[name].ravel() for name, _ in model.shape.parts()])
        flat /= width * steps
        norm = float(np.sqrt(flat @ flat))
        adam.ascend(model.theta, flat if norm <= 1 else flat / norm)


def score(model: Gru, docs: list[np.ndarray], width: int, steps: int, end: int) -> np.ndarray:
    """Natural log probability of each whole document."""
    total = np.zeros(len(docs))
    for who, out, _ in windows(model, docs, width, steps, end, False):
        total += np.bincount(who, out, minlength=len(docs))
    return total
