"""A small causal self-attention model of subword ids, in numpy.

The next id's class is predicted by one attention layer over the ids before it; within a class an id
has its share of the corpus counts, or what the caller knows of it. Classes are the most frequent ids, one each, and stretches of
equal count of the others. Windows of ``WINDOW`` ids overlap by ``WINDOW - STRIDE``: what they share
is context only, so every id is scored once. All windows of a stretch of texts are scored together,
with a mask that hides later ids.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np

WINDOW, STRIDE = 16, 12
WIDTH, CLASSES, SINGLE = 16, 32, 12
BATCH, STEPS, RATE = 256, 500, 0.01
# Windows of a step, and its rate, when start weights are fitted to whole texts.
WIDE_BATCH, WIDE_RATE = 1_024, 0.01
# After as many steps the rate begins to fall, with the root of their number.
STEADY = 500
SLAB = 1_024


@dataclass(frozen=True)
class Model:
    """Weights, the class of each id, and each id's log10 share of its class. ``edge``: begin and end."""

    embed: np.ndarray
    place: np.ndarray
    look: np.ndarray
    head: np.ndarray
    bias: np.ndarray
    of_class: np.ndarray
    share: np.ndarray
    edge: int


_MASK = np.tril(np.ones((WINDOW, WINDOW), np.float32))
_PLACES, _KINDS = np.ones((WINDOW, 1), np.float32), np.ones(CLASSES, np.float32)
# The weights but for ``embed``, in the order in which ``rows_of`` lines them up.
_SHARED = ("place", "look", "head", "bias")


def classes_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each id and log10 of its share within, from corpus counts (one is added to each)."""
    smooth = counts + 1.0
    order = np.argsort(-smooth, kind="stable")
    of_class = np.empty(len(counts), np.int64)
    of_class[order[:SINGLE]] = np.arange(SINGLE)
    rest = order[SINGLE:]
    mass = np.cumsum(smooth[rest])
    of_class[rest] = SINGLE + np.minimum((mass / mass[-1] * (CLASSES - SINGLE)).astype(np.int64), CLASSES - SINGLE - 1)
    total = np.bincount(of_class, smooth, CLASSES)
    return of_class, np.log10(smooth / total[of_class]).astype(np.float32)


def windows(lengths: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid end to end: first place, number of places and number of context places of each window."""
    n = 1 + np.maximum(0, -(-(lengths - WINDOW) // stride))
    text = np.repeat(np.arange(len(lengths)), n)
    number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    begin = number * stride
    size = np.minimum(WINDOW, lengths[text] - begin)
    return (np.cumsum(lengths) - lengths)[text] + begin, size, np.where(number, WINDOW - stride, 0)


def _forward(model: Model, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    x = model.embed.take(ids, axis=0)
    x += model.place
    q, k, v = np.split(x.reshape(-1, WIDTH) @ model.look, 3, axis=1)
    q, k, v = (a.reshape(x.shape) for a in (q, k, v))
    a = np.matmul(q, k.transpose(0, 2, 1))
    np.clip(a, -30, 30, out=a)
    np.exp(a, out=a)
    a *= _MASK
    a /= (a.reshape(-1, WINDOW) @ _PLACES).reshape(*a.shape[:2], 1)
    h = np.matmul(a, v)
    h += x
    np.tanh(h, out=h)
    z = h.reshape(-1, WIDTH) @ model.head
    z += model.bias
    np.clip(z, -30, 30, out=z)
    return x, q, k, v, a, h, z


def log10_scores(model: Model, texts: list[np.ndarray], shares: bool = True) -> np.ndarray:
    """The log10 probability of each text's ids and its end; without ``shares``, of their classes."""
    lengths = np.array([len(t) + 1 for t in texts])
    edge = np.array([model.edge])
    goal = np.concatenate([x for t in texts for x in (t, edge)])
    seen = np.empty_like(goal)
    seen[1:] = goal[:-1]
    seen[np.cumsum(lengths) - lengths] = model.edge
    kinds = model.of_class[goal]
    out = model.share[goal].astype(np.float64) if shares else np.zeros(len(goal))
    first, size, context = windows(lengths)
    steps = np.arange(WINDOW)
    for low in range(0, len(first), SLAB):
        f, s, c = first[low : low + SLAB, None], size[low : low + SLAB, None], context[low : low + SLAB, None]
        at = f + np.minimum(steps, s - 1)
        z = _forward(model, seen[at])[-1]
        own = z[np.arange(len(z)), kinds[at].ravel()]
        np.exp(z, out=z)
        log_p = (own - np.log(z @ _KINDS)).reshape(at.shape)
        new = (steps >= c) & (steps < s)
        out[at[new]] += log_p[new] / np.log(10)
    return np.add.reduceat(out, np.cumsum(lengths) - lengths)


def train(
    texts: list[np.ndarray], counts: np.ndarray, edge: int, seed: int = 0, ends: list[tuple[bool, bool]] | None = None
) -> Model:
    """Fit by Adam on the windows of these texts; classes and shares come from the corpus ``counts``.

    ``ends`` says of each whether it begins and whether it ends its text; all do both if not given.
    """
    rng = np.random.default_rng(seed)
    of_class, share = classes_of(counts)
    draw = lambda *shape, by=0.1: rng.normal(0, by, shape).astype(np.float32)
    p = {
        "embed": draw(len(counts), WIDTH, by=0.3),
        "place": draw(WINDOW, WIDTH),
        "look": draw(WIDTH, 3 * WIDTH, by=0.25),
        "head": draw(WIDTH, CLASSES),
        # A class may have no id, where few ids hold all the mass.
        "bias": np.log(np.maximum(np.bincount(of_class, counts + 1.0, CLASSES), 1e-9) / (counts + 1.0).sum()).astype(np.float32),
    }
    stretches = []
    for text, (begins, closes) in zip(texts, ends or [(True, True)] * len(texts), strict=True):
        ids = np.concatenate([[edge] if begins else [], text, [edge] if closes else []]).astype(np.int64)
        if len(ids) > 1:
            stretches.append(ids)
    if stretches:
        seen, goal = (np.concatenate(x) for x in zip(*((s[:-1], s[1:]) for s in stretches), strict=True))
        first, size, _ = windows(np.array([len(s) - 1 for s in stretches]))
        _descend(p, seen, of_class[goal], first, size, rng, of_class, share, edge)
    return Model(**p, of_class=of_class, share=share, edge=edge)


def _descend(p: dict, seen, kinds, first, size, rng, of_class, share, edge) -> None:
    descent = Descent(p, of_class, share, edge)
    for step in range(1, STEPS + 1):
        some = rng.choice(len(first), min(BATCH, len(first)))
        descent.step(seen, kinds, first[some], size[some], RATE * min(1.0, 2 * (1 - step / (STEPS + 1))))


class Descent:
    """Adam on weights ``p``, which it changes in place. Rows of ``embed`` move where their ids occur."""

    def __init__(self, p: dict[str, np.ndarray], of_class: np.ndarray, share: np.ndarray, edge: int):
        self.p, self.model = p, Model(**p, of_class=of_class, share=share, edge=edge)
        self.mean = {k: np.zeros_like(v) for k, v in p.items()}
        self.square = {k: np.zeros_like(v) for k, v in p.items()}
        self.steps = 0

    def step(self, seen, kinds, first, size, rate: float) -> None:
        """One step on the windows that begin at ``first``."""
        self.steps += 1
        p = self.p
        # Places past the end of a short window repeat its last and do not count.
        at = first[:, None] + np.minimum(np.arange(WINDOW), size[:, None] - 1)
        real = (np.arange(WINDOW) < size[:, None]).ravel()
        ids, want = seen[at], kinds[at].ravel()
        x, q, k, v, a, h, z = _forward(self.model, ids)
        chance = np.exp(z, out=z)
        chance /= (chance @ _KINDS)[:, None]
        dz = chance
        dz[np.arange(len(dz)), want] -= 1
        dz *= real[:, None] / np.float32(real.sum())
        g = {"head": h.reshape(-1, WIDTH).T @ dz, "bias": dz.sum(0)}
        dh = h * h
        np.subtract(1, dh, out=dh)
        dh *= (dz @ p["head"].T).reshape(h.shape)
        da = np.matmul(dh, v.transpose(0, 2, 1))
        ds = da
        ds -= (da * a) @ _PLACES
        ds *= a
        d = np.empty((*x.shape[:2], 3 * WIDTH), x.dtype)
        np.matmul(ds, k, out=d[..., :WIDTH])
        np.matmul(ds.transpose(0, 2, 1), q, out=d[..., WIDTH : 2 * WIDTH])
        np.matmul(a.transpose(0, 2, 1), dh, out=d[..., 2 * WIDTH :])
        d = d.reshape(-1, 3 * WIDTH)
        g["look"] = x.reshape(-1, WIDTH).T @ d
        dx = (d @ p["look"].T).reshape(x.shape)
        dx += dh
        g["place"] = dx.sum(0)
        flat = ids.ravel()
        order = np.argsort(flat)
        flat = flat[order]
        start = np.flatnonzero(np.diff(flat, prepend=-1))
        rows, g["embed"] = flat[start], np.add.reduceat(dx.reshape(-1, WIDTH).take(order, axis=0), start)
        for name in (*_SHARED, "embed"):
            part = rows if name == "embed" else slice(None)
            m = self.mean[name][part] = 0.9 * self.mean[name][part] + 0.1 * g[name]
            s = self.square[name][part] = 0.99 * self.square[name][part] + 0.01 * g[name] ** 2
            m, s = m / (1 - 0.9**self.steps), s / (1 - 0.99**self.steps)
            p[name][part] -= rate * m / (np.sqrt(s) + 1e-8)


def weights_of(model: Model) -> dict[str, np.ndarray]:
    """A copy of the weights, to be changed."""
    return {k: getattr(model, k).copy() for k in ("embed", *_SHARED)}


class WholePass:
    """Fits a copy of a model's weights to every window of the texts it is given, once each.

    A text's windows follow each other without overlap, so every id and every end is a target once.
    """

    def __init__(self, model: Model):
        self.weights = weights_of(model)
        self.descent = Descent(self.weights, model.of_class, model.share, model.edge)
        self.rng = np.random.default_rng(0)
        self.visits = np.zeros(len(model.of_class), np.int64)
        self.n = 0

    def take(self, texts: list[np.ndarray]) -> None:
        model, edge = self.descent.model, np.array([self.descent.model.edge])
        seen = np.concatenate([x for t in texts for x in (edge, t)])
        goal = np.concatenate([x for t in texts for x in (t, edge)])
        kinds = model.of_class[goal]
        first, size, _ = windows(np.array([len(t) + 1 for t in texts]), WINDOW)
        order = self.rng.permutation(len(first))
        for some in np.array_split(order, -(-len(order) // WIDE_BATCH)):
            rate = WIDE_RATE / np.sqrt(1 + self.descent.steps / STEADY)
            self.descent.step(seen, kinds, first[some], size[some], rate)
        self.visits += np.bincount(seen, minlength=len(self.visits))
        self.n += len(first)


def rows_of(weights: dict[str, np.ndarray]) -> np.ndarray:
    """All weights as rows of ``WIDTH`` numbers: a row per id first, then the others."""
    return np.concatenate([weights["embed"], *(weights[k].reshape(-1, WIDTH) for k in _SHARED)])


def with_rows(model: Model, rows: np.ndarray) -> Model:
    """The model with weights as ``rows_of`` gives them."""
    parts, at = {}, 0
    for name in ("embed", *_SHARED):
        old = getattr(model, name)
        parts[name] = rows[at : at + old.size // WIDTH].reshape(old.shape).astype(np.float32)
        at += old.size // WIDTH
    return replace(model, **parts)
