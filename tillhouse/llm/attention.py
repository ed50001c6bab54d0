"""A small causal self-attention model over token classes, trained in numpy.

Inputs are token buckets, outputs are token classes, told by kind and then within the kind; what a token's share
of its class is, the caller knows. A window holds ``CONTEXT`` positions that are only attended to and ``SCORED`` ones that are
scored, each from what stands before it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

CONTEXT, SCORED = 16, 32
WIDTH, HEAD = 16, 16
#: Bucket of positions before the text's start; nothing attends to them.
PAD = 0

_MAY_ATTEND = (np.arange(CONTEXT + SCORED)[None, :] <= CONTEXT + np.arange(SCORED)[:, None]).astype(np.float32)
_ONES = np.ones(CONTEXT + SCORED, np.float32)
#: Windows whose attention is worked on at a time, and windows whose classes are: what is at hand stays in the cache.
_BATCH, _BLOCK = 64, 256


@cache
def _settle() -> None:
    """Once a process: a large block is freed, so that malloc keeps blocks of that size instead of giving them back after
    each use; and a product too large for OpenBLAS's small kernels is taken, which run three times as fast after it."""
    np.empty(2**21)
    some = np.ones((128, 128), np.float32)
    some @ some


def _attention(q: np.ndarray, k: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each scored position gives to those it may see, not divided by the sums yet; and the sums."""
    attended = q @ k.transpose(0, 2, 1)
    if max(attended.max(), -attended.min()) > 30:
        np.clip(attended, -30, 30, out=attended)
    np.exp(attended, out=attended)
    attended *= _MAY_ATTEND
    padded = np.flatnonzero((some == PAD).any(axis=1))
    if len(padded):
        attended[padded] *= (some[padded] != PAD)[:, None, :]
    sums = attended.reshape(-1, CONTEXT + SCORED) @ _ONES.astype(attended.dtype, copy=False)
    sums += np.float32(1e-20)
    return attended, sums


def _exp_shares(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In place: the exponentials of the rows, up to a factor where they are large; and their sums."""
    if max(logits.max(), -logits.min()) > 60:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    return logits, logits @ np.ones(logits.shape[1], logits.dtype)


@dataclass
class Model:
    """Weights by name: embedding, position, query, key, value, mix, kind, kind_bias, output, bias.

    Classes are told in two steps: their kind first, then which of its kind; ``kinds`` is how many classes each kind has.
    Classes of a kind have neighbouring numbers.
    """

    weights: dict[str, np.ndarray]
    kinds: tuple[int, ...]

    def copy(self) -> Model:
        return Model({name: x.copy() for name, x in self.weights.items()}, self.kinds)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.reshape(-1) for x in self.weights.values()])

    def with_flat(self, values: np.ndarray) -> Model:
        """A model of the same shape with the weights in ``values``, in the order of ``flat``."""
        parts = np.split(values, np.cumsum([x.size for x in self.weights.values()])[:-1])
        pairs = zip(self.weights.items(), parts, strict=True)
        return Model({name: part.reshape(x.shape).astype(x.dtype) for (name, x), part in pairs}, self.kinds)

    def _tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What an input gives as key and as what its value adds to the output, and as query and itself, by its bucket
        and by its place."""
        w = self.weights
        early, late = np.hstack([w["key"], w["value"] @ w["mix"]]), w["query"] * np.float32(HEAD**-0.5)
        embedding, position = w["embedding"], w["position"][CONTEXT:]
        return embedding @ early, w["position"] @ early, np.hstack([embedding @ late, embedding]), np.hstack([position @ late, position])

    @staticmethod
    def _out(some: np.ndarray, tables: tuple[np.ndarray, ...]) -> np.ndarray:
        """What goes on to the classes from the windows of a batch."""
        early_of, early_at, late_of, late_at = tables
        k_and_v = np.take(early_of, some, axis=0)
        k_and_v += early_at
        q_and_own = np.take(late_of, some[:, CONTEXT:], axis=0)
        q_and_own += late_at
        attended, sums = _attention(q_and_own[:, :, :HEAD], k_and_v[:, :, :HEAD], some)
        out = attended @ k_and_v[:, :, HEAD:]
        out /= sums.reshape(-1, SCORED, 1)
        out += q_and_own[:, :, HEAD:]
        return out.reshape(-1, WIDTH)

    def _forward(self, buckets: np.ndarray) -> dict[str, np.ndarray]:
        """The log chances of all classes, as ``logits``."""
        w, out = self.weights, self._out(buckets, self._tables())
        chances, sums = _exp_shares(out @ w["kind"] + w["kind_bias"])
        by_kind, logits = np.log(chances / sums[:, None]), out @ w["output"] + w["bias"]
        for kind, (first, past) in enumerate(self._bounds()):
            own, sums = _exp_shares(logits[:, first:past].copy())
            logits[:, first:past] = np.log(own / sums[:, None]) + by_kind[:, kind, None]
        return {"logits": logits}

    def _bounds(self) -> list[tuple[int, int]]:
        ends = np.cumsum(self.kinds).tolist()
        return list(zip([0, *ends[:-1]], ends, strict=True))

    def _by_kind(self, classes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, int, int]]]:
        """An order of positions by class; and the kinds met: number, first and past class, first and past place in the order."""
        order = np.argsort(classes.astype(np.int16, copy=False), kind="stable")
        places = np.searchsorted(classes[order], [0, *np.cumsum(self.kinds)]).tolist()
        met = zip(range(len(self.kinds)), self._bounds(), zip(places, places[1:], strict=False), strict=True)
        return order, [(kind, *own, *place) for kind, own, place in met if place[0] < place[1]]

    def log_chance(self, buckets: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Natural log of the chance of each scored position's class; any number of windows, in batches."""
        return self.log_chances(buckets, classes, np.zeros(len(self.weights["bias"]), np.float32))[0]

    def log_chances(self, buckets: np.ndarray, classes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural logs of the chances of each scored position's class, and of the classes marked in ``group`` together,
        which marks all classes of a kind or none."""
        _settle()
        w = self.weights
        tables = self._tables()
        found, grouped = np.empty(classes.shape, np.float32), np.empty(classes.shape, np.float32)
        marked = group.astype(np.float32)[[first for first, _ in self._bounds()]]
        for start in range(0, len(buckets), _BLOCK):
            block = buckets[start : start + _BLOCK]
            out = np.concatenate([self._out(block[i : i + _BATCH], tables) for i in range(0, len(block), _BATCH)])
            kinds, every = _exp_shares(out @ w["kind"] + w["kind_bias"])
            grouped[start : start + _BLOCK] = np.log((kinds @ marked + np.float32(1e-30)) / every).reshape(-1, SCORED)
            target = classes[start : start + _BLOCK].reshape(-1)
            order, met = self._by_kind(target)
            out, sorted_target = np.take(out, order, axis=0), target[order]
            chances = np.empty(len(order), out.dtype)
            for kind, first, past, begin, end in met:
                own, sums = _exp_shares(out[begin:end] @ w["output"][:, first:past] + w["bias"][first:past])
                chances[begin:end] = own[np.arange(end - begin), sorted_target[begin:end] - first] / sums * (kinds[order[begin:end], kind] / every[order[begin:end]])
            placed = np.empty(len(order), out.dtype)
            placed[order] = chances
            found[start : start + _BLOCK] = np.log(placed).reshape(-1, SCORED)
        return found, grouped

    def _gradients(self, buckets: np.ndarray, classes: np.ndarray, counted: np.ndarray) -> dict[str, np.ndarray]:
        w, dtype = self.weights, self.weights["output"].dtype
        both, scaled = np.hstack([w["key"], w["value"]]), w["query"] * np.float32(HEAD**-0.5)
        parts, out = [], np.empty((classes.size, WIDTH), dtype)
        for start in range(0, len(buckets), _BATCH):
            some = buckets[start : start + _BATCH]
            h = np.take(w["embedding"], some, axis=0)
            h += w["position"]
            late = np.ascontiguousarray(h[:, CONTEXT:]).reshape(-1, WIDTH)
            k_and_v, q = (h.reshape(-1, WIDTH) @ both).reshape(*some.shape, 2 * HEAD), (late @ scaled).reshape(-1, SCORED, HEAD)
            attention, sums = _attention(q, k_and_v[:, :, :HEAD], some)
            seen = (attention @ k_and_v[:, :, HEAD:]).reshape(-1, HEAD)
            seen /= sums[:, None]
            np.add(late, seen @ w["mix"], out=out[start * SCORED : (start + len(some)) * SCORED])
            parts.append((h.reshape(-1, WIDTH), late, q, k_and_v, attention, sums, seen))
        target, weight = classes.reshape(-1), (counted.reshape(-1) / max(counted.sum(), 1)).astype(dtype)
        order, met = self._by_kind(target)
        out, target, weight = np.take(out, order, axis=0), target[order], weight[order]
        error, sums = _exp_shares(out @ w["kind"] + w["kind_bias"])
        error *= (weight / sums)[:, None]
        found = {"output": np.zeros_like(w["output"]), "bias": np.zeros_like(w["bias"])}
        for kind, first, past, begin, end in met:
            error[begin:end, kind] -= weight[begin:end]
        d_sorted = error @ w["kind"].T
        found |= {"kind": out.T @ error, "kind_bias": error.sum(axis=0)}
        for _, first, past, begin, end in met:
            own, sums = _exp_shares(out[begin:end] @ w["output"][:, first:past] + w["bias"][first:past])
            own *= (weight[begin:end] / sums)[:, None]
            own[np.arange(end - begin), target[begin:end] - first] -= weight[begin:end]
            found["output"][:, first:past], found["bias"][first:past] = out[begin:end].T @ own, own.sum(axis=0)
            d_sorted[begin:end] += own @ w["output"][:, first:past].T
        d_out = np.empty_like(d_sorted)
        d_out[order] = d_sorted
        d_both, d_scaled, found["mix"] = np.zeros_like(both), np.zeros_like(scaled), np.zeros_like(w["mix"])
        d_all = np.empty((*buckets.shape, WIDTH), dtype)
        for start, (h, late, q, k_and_v, attention, sums, seen) in zip(range(0, len(buckets), _BATCH), parts, strict=True):
            d_late = d_out[start * SCORED : (start + len(q)) * SCORED]
            found["mix"] += seen.T @ d_late
            d_seen = d_late @ w["mix"].T
            d_seen /= sums[:, None]
            # Of each query, the sum over keys of attention times its gradient is what it saw times the gradient of that.
            common = np.einsum("ij,ij->i", d_seen, seen).reshape(-1, SCORED, 1)
            d_seen = d_seen.reshape(-1, SCORED, HEAD)
            d_k_and_v = np.empty_like(k_and_v)
            d_k_and_v[:, :, HEAD:] = attention.transpose(0, 2, 1) @ d_seen
            d_scores = d_seen @ k_and_v[:, :, HEAD:].transpose(0, 2, 1)
            d_scores -= common
            d_scores *= attention
            d_q = (d_scores @ k_and_v[:, :, :HEAD]).reshape(-1, HEAD)
            d_k_and_v[:, :, :HEAD] = d_scores.transpose(0, 2, 1) @ q
            d_k_and_v = d_k_and_v.reshape(-1, 2 * HEAD)
            d_both += h.T @ d_k_and_v
            d_scaled += late.T @ d_q
            d_h = d_all[start : start + len(q)]
            np.matmul(d_k_and_v, both.T, out=d_h.reshape(-1, WIDTH))
            d_late = d_late + d_q @ scaled.T
            d_h[:, CONTEXT:] += d_late.reshape(-1, SCORED, WIDTH)
        found |= {"query": d_scaled * np.float32(HEAD**-0.5), "key": d_both[:, :HEAD], "value": d_both[:, HEAD:], "position": d_all.sum(axis=0)}
        found["embedding"] = _by_bucket(buckets, d_all, len(w["embedding"]))
        return found


def _by_bucket(buckets: np.ndarray, values: np.ndarray, total: int) -> np.ndarray:
    """Sums of the values at each bucket."""
    flat, width = buckets.reshape(-1), values.shape[-1]
    order = np.argsort(flat.astype(np.int16, copy=False), kind="stable")
    used = flat[order]
    starts = np.flatnonzero(np.concatenate([[True], used[1:] != used[:-1]]))
    sums = np.zeros((total, width), values.dtype)
    sums[used[starts]] = np.add.reduceat(np.take(values.reshape(-1, width), order, axis=0), starts)
    return sums


def fresh(buckets: int, classes: int, kinds: tuple[int, ...] | None = None) -> Model:
    """``kinds``: how many classes each kind has; about as many kinds as classes in each, if not given."""
    random = np.random.default_rng(11)
    each = round(classes**0.5)
    kinds = kinds or tuple(min(each, classes - first) for first in range(0, classes, each))
    shapes = {"embedding": (buckets, WIDTH), "position": (CONTEXT + SCORED, WIDTH), "query": (WIDTH, HEAD), "key": (WIDTH, HEAD)}
    shapes |= {"value": (WIDTH, HEAD), "mix": (HEAD, WIDTH), "output": (WIDTH, classes), "kind": (WIDTH, len(kinds))}
    weights = {name: random.normal(0, 0.2, shape).astype(np.float32) for name, shape in shapes.items()}
    return Model(weights | {"bias": np.zeros(classes, np.float32), "kind_bias": np.zeros(len(kinds), np.float32)}, kinds)


class Trainer:
    """Adam on a model's own weights, a batch of windows at a time."""

    def __init__(self, model: Model):
        _settle()
        self.model, self.steps = model, 0
        self.first = {name: np.zeros_like(x) for name, x in model.weights.items()}
        self.second = {name: np.zeros_like(x) for name, x in model.weights.items()}

    def step(self, buckets: np.ndarray, classes: np.ndarray, counted: np.ndarray, rate: float) -> None:
        """``counted`` marks the scored positions that hold a token; the rate rises over the first 20 steps."""
        self.steps += 1
        rate *= min(self.steps / 20, 1)
        steady, size = np.float32((1 - 0.99**self.steps) ** -0.5), np.float32(rate / (1 - 0.9**self.steps))
        for name, gradient in self.model._gradients(buckets, classes, counted).items():
            first, second = self.first[name], self.second[name]
            change = gradient - first
            change *= np.float32(0.1)
            first += change
            np.multiply(gradient, gradient, out=change)
            change -= second
            change *= np.float32(0.01)
            second += change
            np.sqrt(second, out=change)
            change *= steady
            change += np.float32(1e-8)
            np.divide(first, change, out=change)
            change *= size
            self.model.weights[name] -= change


def train(model: Model, buckets: np.ndarray, classes: np.ndarray, counted: np.ndarray, epochs: int, batch: int = 128) -> Model:
    """Adam over shuffled batches of windows, with a falling rate."""
    random = np.random.default_rng(13)
    trainer, total, step = Trainer(model), epochs * -(-len(buckets) // batch), 0
    for _ in range(epochs):
        order = random.permutation(len(buckets))
        for start in range(0, len(order), batch):
            some, step = order[start : start + batch], step + 1
            trainer.step(buckets[some], classes[some], counted[some], 0.01 * (1 - 0.95 * step / total))
    return model
