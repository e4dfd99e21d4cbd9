"""A small causal self-attention model over subword ids, in numpy: one head, one hidden layer, a class softmax.

A subword's probability is that of its class, which the attention predicts, times its share of the class in the corpus.
Classes come from a mixture of unigrams over all training texts: each subword belongs to the component that makes most of it,
as a rule a language or a kind of text, and within a component classes are runs of subwords by falling frequency with
about equal mass. So the attention tells from the context which words are likely, not only how frequent they are.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import glob
import io
import os
from dataclasses import dataclass, fields

import numpy as np

WIDTH, HIDDEN, CLASSES = 16, 32, 128
#: Subwords with an embedding of their own; rarer ones share that of their class.
OWN_EMBEDDINGS = 6000
WINDOW, STRIDE = 32, 16
#: Components of the mixture that classes come from, rounds of its fit, and subwords that it knows.
COMPONENTS, FIT_ROUNDS, FIT_SUBWORDS = 8, 12, 8192
#: Learning rates of the first and of the later rounds over all training documents, their batch, and the steps that a group makes at least.
RATE, ROUND_RATE, ROUND_BATCH, STEPS = 6e-3, 2e-3, 128, 500
#: Windows that are scored at a time: their class logits stay in a core's cache.
SCORED = 64
#: Windows whose gradient is taken at a time, for the same reason.
STEPPED = 32
#: Rows of a product with all classes that are multiplied at a time.
ROWS = 256
SEED = 3


@functools.lru_cache(maxsize=64)
def _room(name: str, kind: np.dtype, *shape: int) -> np.ndarray:
    """An array to write to, of which a process has one for each name and shape: fresh ones cost more than what fills them."""
    return np.empty(shape, kind)


def _by_rows(a: np.ndarray, w: np.ndarray, out: np.ndarray) -> None:
    """``a @ w``, in stacks of ROWS rows: OpenBLAS multiplies matrices of under a million steps without copies of them."""
    cut = len(a) // ROWS * ROWS
    np.matmul(a[:cut].reshape(-1, ROWS, a.shape[1]), w, out=out[:cut].reshape(-1, ROWS, w.shape[1]))
    np.matmul(a[cut:], w, out=out[cut:])


@functools.lru_cache(maxsize=64)
def _causal(length: int, kind: np.dtype) -> np.ndarray:
    """1 where a position sees another, itself included."""
    return np.tri(length, dtype=kind)


def bags_of(texts: list[np.ndarray], known: np.ndarray, n: int) -> np.ndarray:
    """How often each ``known`` subword, of ``n``, stands in each text that has at least 20 of them."""
    place = np.full(n, -1, np.int64)
    place[known] = np.arange(len(known))
    x = np.zeros((len(texts), len(known)), np.float32)
    for i, ids in enumerate(texts):
        own = place[ids]
        x[i] = np.bincount(own[own >= 0], minlength=len(known))
    return x[x.sum(1) >= 20]


def shared_out(x: np.ndarray, phi: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An expectation step over bags: (texts, subwords of each component), sums over texts that may be added up."""
    score = x @ np.log(phi / phi.sum(1, keepdims=True)).T.astype(np.float32) + np.log(weight)
    r = np.exp(score - score.max(1, keepdims=True))
    r /= r.sum(1, keepdims=True)
    return r.sum(0), r.T @ x


def updated(texts: np.ndarray, subwords: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A maximisation step: (each component's subwords, its weight)."""
    return subwords + 0.01, (texts + 1) / (texts.sum() + COMPONENTS)


def known_of(counts: np.ndarray) -> np.ndarray:
    return np.argsort(-counts, kind="stable")[:FIT_SUBWORDS]


def seeded(counts: np.ndarray, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray] | None:
    """(phi, weight) from which a mixture of unigrams over all texts starts: one fitted to some texts' ids; None if they are too few."""
    known = known_of(counts)
    x = bags_of(texts, known, len(counts))
    if len(x) < COMPONENTS:
        return None
    share = x / x.sum(1, keepdims=True)
    # the first centres lie far apart, each the text least like those before it
    centre, like = [0], share @ share[0] / np.linalg.norm(share, axis=1)
    for _ in range(COMPONENTS - 1):
        centre.append(int(like.argmin()))
        like = np.maximum(like, share @ share[centre[-1]] / np.linalg.norm(share, axis=1))
    phi = share[centre] + (counts[known] + 1) / (counts[known] + 1).sum()
    weight = np.full(COMPONENTS, 1 / COMPONENTS)
    for _ in range(FIT_ROUNDS):
        phi, weight = updated(*shared_out(x, phi, weight))
    return phi, weight


def components_of(counts: np.ndarray, phi: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The component of each subword: that which makes most of it."""
    out = np.zeros(len(counts), np.int64)
    out[known_of(counts)] = (weight[:, None] * phi / phi.sum(1, keepdims=True)).argmax(0)
    return out


def classes_of(counts: np.ndarray, component: np.ndarray | None = None, n: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """(class of each subword, log share of each in its class) from corpus counts; unseen ones count a half."""
    mass = np.asarray(counts, float) + 0.5
    component = np.zeros(len(mass), np.int64) if component is None else component
    whole = np.bincount(component, mass)
    used = np.flatnonzero(whole)
    # every component has classes in proportion to its mass's root, at least one
    root = np.sqrt(whole[used])
    size = 1 + np.floor((n - len(used)) * root / root.sum()).astype(np.int64)
    cls, first = np.empty(len(mass), np.int64), 0
    for c, m in zip(used, size):
        own = np.flatnonzero(component == c)
        order = own[np.argsort(-mass[own], kind="stable")]
        at = np.minimum(m - 1, np.maximum((np.cumsum(mass[order]) / whole[c] * m).astype(int) - 1, 0))
        at = np.minimum(np.cumsum(np.r_[0, np.diff(at) > 0]), m - 1)
        cls[order] = first + at
        first += m
    return cls, np.log(mass) - np.log(np.maximum(np.bincount(cls, mass, minlength=n), 1e-300))[cls]


@dataclass
class Attention:
    row: np.ndarray  # the embedding's row of each subword
    cls: np.ndarray
    log_share: np.ndarray
    e: np.ndarray
    p: np.ndarray
    q: np.ndarray
    k: np.ndarray
    v: np.ndarray
    o: np.ndarray
    w1: np.ndarray
    w2: np.ndarray
    u: np.ndarray
    b: np.ndarray

    @classmethod
    def new(cls_, counts: np.ndarray, rng: np.random.Generator, component: np.ndarray | None = None) -> Attention:
        cls, log_share = classes_of(counts, component)
        order = np.argsort(-counts, kind="stable")
        row = OWN_EMBEDDINGS + cls
        row[order[:OWN_EMBEDDINGS]] = np.arange(min(OWN_EMBEDDINGS, len(counts)))
        f = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        d = WIDTH
        e = (rng.normal(size=(OWN_EMBEDDINGS + CLASSES, d)) * 0.3).astype(np.float32)
        prior = np.log(np.bincount(cls, counts + 0.5, minlength=CLASSES) + 1e-9)
        return cls_(row, cls, log_share, e, (rng.normal(size=(WINDOW, d)) * 0.1).astype(np.float32), f(d, d), f(d, d), f(d, d), f(d, d), f(d, HIDDEN), f(HIDDEN, d) * 0.5, f(d, CLASSES) * 0.1, (prior - prior.max()).astype(np.float32))

    def forward(self, ids: np.ndarray, first: int = 0) -> dict[str, np.ndarray]:
        """Class logits for the positions from ``first`` on of windows (rows of ids)."""
        n, length = ids.shape
        x = self.e[self.row[ids]] + self.p[:length]
        own = np.ascontiguousarray(x[:, first:])
        # matrices of two dimensions: numpy multiplies stacks of small ones many times slower
        flat = lambda a, w: (a.reshape(-1, a.shape[-1]) @ w).reshape(*a.shape[:-1], -1)
        q, k, v = flat(own, self.q * np.float32(WIDTH**-0.5)), flat(x, self.k), flat(x, self.v)
        s = np.matmul(q, k.transpose(0, 2, 1))
        np.minimum(s, np.float32(60), out=s)
        np.exp(s, out=s)
        s *= np.tri(length, dtype=np.float32)[first:]
        s /= s.sum(-1, keepdims=True)
        c = np.matmul(s, v)
        y = own + flat(c, self.o)
        h = np.maximum(flat(y, self.w1), 0)
        z = y + flat(h, self.w2)
        logits = flat(z, self.u)
        logits += self.b
        return {"x": x, "q": q, "k": k, "v": v, "a": s, "c": c, "y": y, "h": h, "z": z, "logits": logits}

    def exponentials(self, z: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(t, w, own, low): class c has the probability t[i, c] * w[c] / (t @ w)[i] after state i; own[i] is the logit of class
        ``cls[i]``, less low[i], by which the row's exponents were lowered.

        Rows are lowered only where their exponentials would leave the range of 32 bits; else w holds what biases make of them.
        """
        t = _room("t", self.u.dtype, len(z), CLASSES)
        _by_rows(z, self.u, t)
        at = np.arange(len(cls)) * CLASSES + cls
        if len(z) and t.max() < 60 and abs(self.b).max() < 60:
            own = t.reshape(-1)[at] + self.b[cls]
            np.exp(t, out=t)
            w = np.exp(self.b)
            total = t @ w
            if total.min() > 1e-25:
                return t, w, own, total
            _by_rows(z, self.u, t)
        t += self.b
        if len(z):
            t -= t.max(-1, keepdims=True)
        own = t.reshape(-1)[at]
        np.exp(t, out=t)
        w = np.ones(CLASSES, t.dtype)
        return t, w, own, t @ w

    def states(self, row: np.ndarray, first: int = 0) -> dict[str, np.ndarray]:
        """What ``forward`` makes before the logits, for rows of the embedding, as matrices of a row for each position from ``first`` on.

        The attention's weights are ``s`` times ``r``.
        """
        n, length = row.shape
        kind, m = self.e.dtype, length - first
        x = np.take(self.e, row, axis=0, out=_room("x", kind, n, length, WIDTH), mode="clip")
        x += self.p[:length]
        flat = x.reshape(-1, WIDTH)
        own = flat if not first else np.ascontiguousarray(x[:, first:]).reshape(-1, WIDTH)
        k, v = (np.matmul(flat, w, out=_room(name, kind, len(flat), WIDTH)).reshape(x.shape) for name, w in (("k", self.k), ("v", self.v)))
        q = np.matmul(own, self.q * kind.type(WIDTH**-0.5), out=_room("q", kind, len(own), WIDTH)).reshape(n, m, WIDTH)
        s = np.matmul(q, k.transpose(0, 2, 1), out=_room("s", kind, n, m, length))
        if s.size and s.max() > 60:
            np.minimum(s, kind.type(60), out=s)
        np.exp(s, out=s)
        s *= _causal(length, kind)[first:]
        r = s.reshape(-1, length) @ np.ones(length, kind)
        np.divide(1, r, out=r)
        c = np.matmul(s, v, out=_room("c", kind, n, m, WIDTH)).reshape(-1, WIDTH)
        c *= r[:, None]
        y = np.matmul(c, self.o, out=_room("y", kind, len(c), WIDTH))
        y += own
        h = np.matmul(y, self.w1, out=_room("h", kind, len(y), HIDDEN))
        np.maximum(h, 0, out=h)
        z = np.matmul(h, self.w2, out=_room("z", kind, len(y), WIDTH))
        z += y
        return {"x": flat, "q": q, "k": k, "v": v, "s": s, "r": r, "c": c, "y": y, "h": h, "z": z}

    def log_prob(self, ids: np.ndarray, target: np.ndarray, start: np.ndarray, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Natural log-probabilities of the classes of the targets from ``first`` on, and of any word's begin in their place.

        ``start``: the share of each class that begins a word.
        """
        return self._log_prob(self.row[ids], self.cls[target], start, first)

    def _log_prob(self, row: np.ndarray, cls: np.ndarray, start: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        t, w, own, total = self.exponentials(self.states(row, first)["z"], cls.ravel())
        log = np.log(total)
        return own - log, np.log(t @ (w * start.astype(w.dtype))) - log

    def score(self, ids: np.ndarray, starts: np.ndarray, begin: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every id of several texts, given the ids before it in its window: natural log-probabilities of its class and
        of a word's begin in its place. The windows are those of ``windows``."""
        size = np.diff(starts)
        n = np.where(size > 0, 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE)), 0)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at, end = starts[:-1].repeat(n) + k * STRIDE, starts[1:].repeat(n)
        # places behind a text's end are read and written too: its own places don't see them, and those of the next text
        # that they fall on lie in first windows, which are written last
        row, cls = (np.r_[a[begin], a[ids], np.full(WINDOW, a[begin])] for a in (self.row, self.cls))
        out, begins = np.zeros(len(row), np.float32), np.zeros(len(row), np.float32)
        view = lambda a, n: np.lib.stride_tricks.sliding_window_view(a, n, writeable=True)
        for first, chosen in ((WINDOW - STRIDE, np.flatnonzero(k > 0)), (0, np.flatnonzero(k == 0))):
            inputs, targets = view(row, WINDOW), view(cls, WINDOW - first)
            into = [view(x, WINDOW - first) for x in (out, begins)]
            for lo in range(0, len(chosen), SCORED):
                r = chosen[lo : lo + SCORED]
                x, new = inputs[at[r]], at[r] + first
                if not first:
                    x[:, 0] = row[0]
                for a, found in zip(into, self._log_prob(x, targets[new + 1], start, first)):
                    found = found.reshape(len(r), -1)
                    a[new] = found if first else np.where(new[:, None] + np.arange(WINDOW) < end[r][:, None], found, a[new])
        return out[: len(ids)], begins[: len(ids)]

    def step(self, ids: np.ndarray, target: np.ndarray, weight: np.ndarray, grad: dict[str, np.ndarray] | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over weighted positions, and its gradient (in ``grad``, if given): the sums over portions of the windows."""
        grad = grad or {x: np.empty_like(getattr(self, x)) for x in TRAINED}
        for d in grad.values():
            d[...] = 0
        row, cls = self.row[ids], self.cls[target]
        weight = (weight / max(1.0, weight.sum())).astype(self.u.dtype)
        loss = sum(self._step(row[lo : lo + STEPPED], cls[lo : lo + STEPPED].ravel(), weight[lo : lo + STEPPED].ravel(), grad) for lo in range(0, len(ids), STEPPED))
        return loss, grad

    def _step(self, row: np.ndarray, cls: np.ndarray, weight: np.ndarray, grad: dict[str, np.ndarray]) -> float:
        n, length = row.shape
        kind, scale = self.u.dtype, self.q.dtype.type(WIDTH**-0.5)
        f = self.states(row)
        z, h, y, s = f["z"], f["h"], f["y"], f["s"]
        t, w, own, total = self.exponentials(z, cls)
        loss = float(-(np.log(np.exp(own) / total + 1e-12) * weight).sum())
        # the gradient of the logits is t w, less the total at the target's class, times the weight over the total: the columns'
        # factor and the rows' go to the other side of the products
        t.reshape(-1)[np.arange(len(cls)) * CLASSES + cls] -= total / w[cls]
        factor = weight / total
        dz = np.empty_like(z)
        _by_rows(t, (self.u * w).T, dz)
        dz *= factor[:, None]
        grad["b"] += (factor @ t) * w
        z *= factor[:, None]
        cut = len(z) // ROWS * ROWS
        shape = (-1, ROWS, WIDTH), (-1, ROWS, CLASSES)
        grad["u"] += (np.matmul(z[:cut].reshape(shape[0]).transpose(0, 2, 1), t[:cut].reshape(shape[1])).sum(0) + z[cut:].T @ t[cut:]) * w
        grad["w2"] += h.T @ dz
        dh = np.matmul(dz, self.w2.T, out=_room("dh", kind, len(z), HIDDEN))
        dh *= h > 0
        grad["w1"] += y.T @ dh
        dz += dh @ self.w1.T  # now y's
        grad["o"] += f["c"].T @ dz
        # the attention's weights are s r: the gradient of their logits is s (r dc v - r dc c)
        dc = dz @ self.o.T
        dc *= f["r"][:, None]
        less = (dc * f["c"]) @ np.ones(WIDTH, kind)
        dc = dc.reshape(n, length, WIDTH)
        ds = np.matmul(dc, f["v"].transpose(0, 2, 1), out=_room("ds", kind, n, length, length))
        ds -= less.reshape(n, length, 1)
        ds *= s
        dq = np.matmul(ds, f["k"], out=_room("dq", kind, n, length, WIDTH))
        dk = np.matmul(ds.transpose(0, 2, 1), f["q"], out=_room("dk", kind, n, length, WIDTH))
        dv = np.matmul(s.transpose(0, 2, 1), dc, out=_room("dv", kind, n, length, WIDTH))
        # the queries are kept scaled
        for name, part, by in (("q", dq, scale), ("k", dk, 1), ("v", dv, 1)):
            part = part.reshape(-1, WIDTH)
            grad[name] += (f["x"].T @ part) * by
            dz += part @ (getattr(self, name) * by).T  # in the end x's
        grad["p"][:length] += dz.reshape(n, -1).sum(0).reshape(length, WIDTH)
        # two numbers at a time, as complex ones
        pair = np.complex64 if kind == np.float32 else np.complex128
        into, half = grad["e"].reshape(-1).view(pair), WIDTH // 2
        np.add.at(into, (row.reshape(-1, 1) * half + np.arange(half)).ravel(), dz.reshape(-1).view(pair))
        return loss

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f.name: getattr(self, f.name) for f in fields(self)})
        return out.getvalue()

    @classmethod
    def loads(cls_, data: bytes) -> Attention:
        with np.load(io.BytesIO(data)) as z:
            return cls_(**{k: z[k] for k in z.files})


def one_blas_thread() -> None:
    """Keeps numpy's OpenBLAS to one thread in this process: its matrices here are too small to share out."""
    with contextlib.suppress(OSError, AttributeError):
        for path in glob.glob(os.path.join(os.path.dirname(np.__file__), os.pardir, "numpy.libs", "*openblas*")):
            ctypes.CDLL(path).scipy_openblas_set_num_threads64_(1)


def windows(ids: np.ndarray, starts: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over texts' ids: (inputs, targets, which positions a window scores).

    A text's first window scores all its positions, each later one those after the overlap: every id once.
    ``begin`` stands before each text's first id.
    """
    size = np.diff(starts)
    n = np.where(size > 0, 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(size)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = (k * STRIDE)[:, None] + np.arange(WINDOW)
    inside = at < size[text][:, None]
    target = np.where(inside, ids[np.minimum(starts[text][:, None] + at, max(0, len(ids) - 1))], begin) if len(ids) else np.zeros((0, WINDOW), ids.dtype)
    before = np.empty_like(target)
    before[:, 1:] = target[:, :-1]
    before[:, 0] = np.where(k > 0, ids[np.maximum(starts[text] + k * STRIDE - 1, 0)], begin) if len(ids) else 0
    return before, target, inside & ((k == 0)[:, None] | (np.arange(WINDOW) >= WINDOW - STRIDE))


TRAINED = ("e", "p", "q", "k", "v", "o", "w1", "w2", "u", "b")


class Adam:
    """Adam over all trained arrays at once: they become views of one."""

    def __init__(self, model: Attention):
        self.model, self.steps = model, 0
        self.flat = np.concatenate([getattr(model, x).ravel() for x in TRAINED])
        self.m, self.v, self.grad, self.spare = (np.zeros_like(self.flat) for _ in range(4))
        self.parts, at = {}, 0
        for x in TRAINED:
            shape, size = getattr(model, x).shape, getattr(model, x).size
            setattr(model, x, self.flat[at : at + size].reshape(shape))
            self.parts[x] = self.grad[at : at + size].reshape(shape)
            at += size

    def step(self, inputs: np.ndarray, targets: np.ndarray, weight: np.ndarray, rate: float) -> None:
        self.model.step(inputs, targets, weight, self.parts)
        self.steps += 1
        kind, g, t = self.flat.dtype.type, self.grad, self.spare
        for held, share in ((self.m, 0.1), (self.v, 0.01)):
            held *= kind(1 - share)
            held += np.multiply(g, kind(share), out=t)
            g *= g
        # rate * (m / (1 - 0.9^n)) / (sqrt(v / (1 - 0.99^n)) + 1e-8)
        root = (1 - 0.99**self.steps) ** 0.5
        np.sqrt(self.v, out=t)
        t += kind(1e-8 * root)
        np.divide(self.m, t, out=t)
        t *= kind(rate * root / (1 - 0.9**self.steps))
        self.flat -= t


def whole_windows(ids: np.ndarray, starts: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of WINDOW + 1 ids, the text of each): every id of every text is in one row a target; the first of a row is its
    context, ``begin`` at a text's start, and short rows are filled with -1."""
    size = np.diff(starts)
    n = -(-size // WINDOW)
    text = np.repeat(np.arange(len(size)), n)
    at = ((np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * WINDOW)[:, None] + np.arange(-1, WINDOW)
    rows = np.where((at >= 0) & (at < size[text][:, None]), ids[np.clip(starts[text][:, None] + at, 0, max(0, len(ids) - 1))] if len(ids) else 0, -1).astype(np.int32)
    rows[at[:, 0] < 0, 0] = begin
    return rows, text


def trained_on(model: Attention, rows: np.ndarray, weight: np.ndarray, seed: int, rate: float = ROUND_RATE, least: int = 1) -> None:
    """A pass over windows (rows of WINDOW + 1 ids, of which the first is context; below 0: none) with weights; where one has fewer
    than ``least`` steps, as many whole passes as make them."""
    one_blas_thread()
    rng = np.random.default_rng(seed)
    passes = -(-least * ROUND_BATCH // max(1, len(rows)))
    order = np.concatenate([rng.permutation(len(rows)) for _ in range(max(1, passes))])
    adam, steps = Adam(model), -(-len(order) // ROUND_BATCH)
    for i in range(steps):
        r = rows[order[i * ROUND_BATCH : (i + 1) * ROUND_BATCH]]
        w = weight[order[i * ROUND_BATCH : (i + 1) * ROUND_BATCH]]
        real = (r[:, 1:] >= 0) * w[:, None]
        r = np.maximum(r, 0)
        adam.step(r[:, :-1], r[:, 1:], real, rate * min(1.0, (i + 1) / 10) * (1 - 0.9 * i / steps))
