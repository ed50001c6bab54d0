"""A bidirectional LSTM over characters with CRF transitions between tags, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Tag 0 is outside; kind k begins with 1 + 2 k and goes on with 2 + 2 k.
TAGS = 1 + 2 * len(KINDS)
#: Character classes: padding, line ends, other white space, the printable ASCII characters one by one, Latin letters, all others.
_FIRST, _LAST = 0x21, 0x7E
CLASSES = 3 + (_LAST - _FIRST + 1) + 2
_IMPOSSIBLE = -1e4


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.full(len(points), CLASSES - 1, np.uint8)
    found[(points >= 0xC0) & (points < 0x250)] = CLASSES - 2
    printable = (points >= _FIRST) & (points <= _LAST)
    found[printable] = points[printable] - _FIRST + 3
    found[(points <= 0x20) | (points == 0xA0)] = 2
    found[(points == 10) | (points == 13)] = 1
    return found


def _allowed() -> np.ndarray:
    allowed = np.ones((TAGS, TAGS), bool)
    for going_on in range(2, TAGS, 2):
        allowed[:, going_on] = False
        allowed[[going_on - 1, going_on], going_on] = True
    return allowed


ALLOWED = _allowed()
_STARTS = np.array([tag == 0 or tag % 2 == 1 for tag in range(TAGS)])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Chain:
    """Forward and backward sums of a batch, in logarithms; rows are windows, then places, then tags."""

    scores: np.ndarray
    transitions: np.ndarray
    lengths: np.ndarray
    forward: np.ndarray
    backward: np.ndarray
    total: np.ndarray

    def span(self, row: int, begin: int, end: int, kind: int) -> float:
        """Probability that a span of this kind stands exactly here."""
        tag, going_on = 1 + 2 * kind, 2 + 2 * kind
        found = self.forward[row, begin, tag]
        if end > begin + 1:
            found = found + self.transitions[tag, going_on] + (end - begin - 2) * self.transitions[going_on, going_on]
            found = found + self.scores[row, begin + 1 : end, going_on].sum()
            tag = going_on
        if end < self.lengths[row]:
            after = self.transitions[tag] + self.scores[row, end] + self.backward[row, end]
            found = found + _log_sum(np.delete(after, going_on), 0)
        return float(np.exp(min(found - self.total[row], 0.0)))


class Tagger:
    """Weights by name, and what they say of batches of windows (classes by row, padded with 0)."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @classmethod
    def fresh(cls, seed: int = 5, width: int = 16, hidden: int = 20) -> Tagger:
        random = np.random.default_rng(seed)

        def matrix(rows: int, columns: int) -> np.ndarray:
            return (random.standard_normal((rows, columns)) / np.sqrt(rows)).astype(np.float32)

        weights = {"letters": matrix(CLASSES, width) * 2, "out": matrix(2 * hidden, TAGS), "out_bias": np.zeros(TAGS, np.float32)}
        # Read forwards and backwards; gates: in, keep, out and the new value.
        weights["in"] = np.stack([matrix(width, 4 * hidden) for _ in range(2)])
        weights["own"] = np.stack([matrix(hidden, 4 * hidden) for _ in range(2)])
        weights["bias"] = np.zeros((2, 1, 4 * hidden), np.float32)
        weights["bias"][:, :, hidden : 2 * hidden] = 1  # states are kept at first
        weights["transitions"], weights["starts"] = np.zeros((TAGS, TAGS), np.float32), np.zeros(TAGS, np.float32)
        return cls(weights)

    def _lstm(self, inputs: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, list]:
        """States after each place, by place, direction and window. Padding leaves the state at zero."""
        own = self.weights["own"]
        hidden = own.shape[1]
        given = inputs @ self.weights["in"] + self.weights["bias"]
        state = np.zeros((2, inputs.shape[2], hidden), inputs.dtype)
        cell, states, kept = state, np.empty((*inputs.shape[:3], hidden), inputs.dtype), []
        for place in range(len(inputs)):
            gates = given[place] + state @ own
            opened = _sigmoid(gates[..., : 3 * hidden])
            new = np.tanh(gates[..., 3 * hidden :])
            before, past = cell, state
            cell = (opened[..., hidden : 2 * hidden] * cell + opened[..., :hidden] * new) * real[place]
            bent = np.tanh(cell)
            state = opened[..., 2 * hidden :] * bent
            states[place] = state
            kept.append((opened, new, before, past, bent))
        return states, kept

    def _lstm_gradients(self, inputs: np.ndarray, real: np.ndarray, kept: list, of_states: np.ndarray, out: dict) -> np.ndarray:
        own = self.weights["own"]
        hidden = own.shape[1]
        back = own.transpose(0, 2, 1)
        of_given = np.empty((*inputs.shape[:3], 4 * hidden), inputs.dtype)
        of_own = np.zeros_like(own)
        of_state = np.zeros((2, inputs.shape[2], hidden), inputs.dtype)
        of_cell = np.zeros_like(of_state)
        for place in range(len(inputs) - 1, -1, -1):
            opened, new, before, past, bent = kept[place]
            let_in, keep, let_out = opened[..., :hidden], opened[..., hidden : 2 * hidden], opened[..., 2 * hidden :]
            of_state = of_state + of_states[place]
            of_cell = (of_cell + of_state * let_out * (1 - bent * bent)) * real[place]
            of_opened = np.concatenate([of_cell * new, of_cell * before, of_state * bent], axis=2)
            of_gates = np.concatenate([of_opened * opened * (1 - opened), of_cell * let_in * (1 - new * new)], axis=2)
            of_given[place] = of_gates
            of_own += past.transpose(0, 2, 1) @ of_gates
            of_state, of_cell = of_gates @ back, of_cell * keep
        by_side = of_given.transpose(1, 0, 2, 3).reshape(2, -1, 4 * hidden)
        out["own"], out["bias"] = of_own, by_side.sum(axis=1, keepdims=True)
        out["in"] = inputs.transpose(1, 3, 0, 2).reshape(2, inputs.shape[3], -1) @ by_side
        return of_given @ self.weights["in"].transpose(0, 2, 1)

    def _read(self, windows: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Scores of tags by window, place and tag, and what their gradients need."""
        real = (windows.T != 0).astype(self.weights["out"].dtype)[:, :, None]
        inputs = self.weights["letters"][windows.T] * real
        sides = np.stack([inputs, inputs[::-1]], axis=1)
        real_sides = np.stack([real, real[::-1]], axis=1)
        found, kept = self._lstm(sides, real_sides)
        states = np.concatenate([found[:, 0], found[::-1, 1]], axis=2)
        scores = states @ self.weights["out"] + self.weights["out_bias"]
        return scores.transpose(1, 0, 2), (real, sides, real_sides, kept, states)

    def _chain(self, scores: np.ndarray, lengths: np.ndarray) -> Chain:
        scores = scores.astype(np.float64)
        moves = np.where(ALLOWED, self.weights["transitions"], _IMPOSSIBLE).astype(np.float64)
        starts = np.where(_STARTS, self.weights["starts"], _IMPOSSIBLE)
        forward, backward = np.empty_like(scores), np.zeros_like(scores)
        ahead = np.exp(moves)
        back = ahead.T

        def through(logs: np.ndarray, ways: np.ndarray) -> np.ndarray:
            top = logs.max(axis=1, keepdims=True)
            return np.log(np.exp(logs - top) @ ways + 1e-300) + top

        for place in range(scores.shape[1]):
            new = through(forward[:, place - 1], ahead) if place else starts
            here = (place < lengths)[:, None]
            forward[:, place] = np.where(here, new + scores[:, place], forward[:, place - 1]) if place else new + scores[:, 0]
        for place in range(scores.shape[1] - 2, -1, -1):
            new = through(scores[:, place + 1] + backward[:, place + 1], back)
            backward[:, place] = np.where((place + 1 < lengths)[:, None], new, 0)
        return Chain(scores, moves, lengths, forward, backward, _log_sum(forward[:, -1], 1))

    def gradients(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean of the negative log-probabilities of the tags, and its gradients."""
        scores, (real, sides, real_sides, kept, states) = self._read(windows)
        chain = self._chain(scores, (windows != 0).sum(axis=1))
        rows, places, count = np.arange(len(windows)), np.arange(windows.shape[1]), len(windows)
        moves, inside = chain.transitions, real[:, :, 0].T > 0
        starts = self.weights["starts"]

        of_scores = np.exp(chain.forward + chain.backward - chain.total[:, None, None]) * inside[:, :, None]
        of_starts = of_scores[:, 0].sum(axis=0) - np.bincount(tags[:, 0], minlength=TAGS)
        before, after = chain.forward[:, :-1], (chain.scores + chain.backward)[:, 1:]
        top, second = before.max(axis=2, keepdims=True), after.max(axis=2, keepdims=True)
        weight = np.exp(top + second - chain.total[:, None, None]) * inside[:, 1:, None]
        pairs = (np.exp(before - top) * weight).reshape(-1, TAGS).T @ np.exp(after - second).reshape(-1, TAGS)
        of_moves = pairs * np.exp(moves)
        was, now = tags[:, :-1][inside[:, 1:]], tags[:, 1:][inside[:, 1:]]
        np.subtract.at(of_moves, (was, now), 1)
        right = starts[tags[:, 0]] + (chain.scores[rows[:, None], places, tags] * inside).sum(axis=1)
        right = right + (moves[tags[:, :-1], tags[:, 1:]] * inside[:, 1:]).sum(axis=1)
        of_scores[rows[:, None], places, tags] -= inside
        loss = float((chain.total - right).mean())

        kind = self.weights["out"].dtype
        of_scores = (of_scores / count).astype(kind).transpose(1, 0, 2)
        out = {"transitions": (of_moves * ALLOWED / count).astype(kind), "starts": (of_starts * _STARTS / count).astype(kind)}
        out["out"] = states.reshape(-1, states.shape[2]).T @ of_scores.reshape(-1, TAGS)
        out["out_bias"] = of_scores.sum(axis=(0, 1))
        of_states = of_scores @ self.weights["out"].T
        hidden = states.shape[2] // 2
        by_side = np.stack([of_states[:, :, :hidden], of_states[::-1, :, hidden:]], axis=1)
        of_sides = self._lstm_gradients(sides, real_sides, kept, by_side, out)
        of_inputs = (of_sides[:, 0] + of_sides[::-1, 1]) * real
        out["letters"] = np.zeros_like(self.weights["letters"])
        np.add.at(out["letters"], windows.T.reshape(-1), of_inputs.reshape(-1, of_inputs.shape[2]))
        return loss, out

    def train(self, windows: np.ndarray, tags: np.ndarray, steps: int = 600, batch: int = 64, rate: float = 0.02, seed: int = 9) -> list[float]:
        """Adam over all windows in turn, again and again, with a rate that falls to nothing; returns the loss of each step."""
        random, losses, order = np.random.default_rng(seed), [], np.zeros(0, np.int64)
        means = {name: np.zeros_like(w) for name, w in self.weights.items()}
        squares = {name: np.zeros_like(w) for name, w in self.weights.items()}
        for step in range(1, steps + 1):
            if len(order) < min(batch, len(windows)):
                order = np.append(order, random.permutation(len(windows)))
            some, order = order[:batch], order[batch:]
            longest = int((windows[some] != 0).sum(axis=1).max())
            loss, found = self.gradients(windows[some, :longest], tags[some, :longest])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in found.values()))
            now, bound = rate * (1 - (step - 1) / steps), min(1.0, 5.0 / max(norm, 1e-9))
            for name, gradient in found.items():
                gradient = gradient * np.float32(bound)
                means[name] += 0.1 * (gradient - means[name])
                squares[name] += 0.01 * (gradient * gradient - squares[name])
                bend = np.sqrt(squares[name] / (1 - 0.99**step)) + 1e-6
                self.weights[name] -= (now / (1 - 0.9**step) * means[name] / bend).astype(self.weights[name].dtype)
        return losses

    def best_tags(self, chain: Chain) -> np.ndarray:
        """The most probable tags of each window, by dynamic programming."""
        count, places, _ = chain.scores.shape
        best = np.where(_STARTS, self.weights["starts"], _IMPOSSIBLE) + chain.scores[:, 0]
        came = np.zeros(chain.scores.shape, np.int8)
        for place in range(1, places):
            ways = best[:, :, None] + chain.transitions
            came[:, place] = ways.argmax(axis=1)
            here = (place < chain.lengths)[:, None]
            best = np.where(here, ways.max(axis=1) + chain.scores[:, place], best)
            came[:, place] = np.where(here, came[:, place], np.arange(TAGS))
        tags = np.zeros((count, places), np.int8)
        tags[:, -1] = best.argmax(axis=1)
        for place in range(places - 1, 0, -1):
            tags[:, place - 1] = came[np.arange(count), place, tags[:, place]]
        return tags

    def spans(self, windows: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
        """Per window the decoded spans: begin, end, kind and probability."""
        scores, _ = self._read(windows)
        chain = self._chain(scores, (windows != 0).sum(axis=1))
        found = []
        for row, tags in enumerate(self.best_tags(chain)):
            own = []
            for begin in np.flatnonzero(tags % 2 == 1).tolist():
                kind, end = (int(tags[begin]) - 1) // 2, begin + 1
                while end < chain.lengths[row] and tags[end] == 2 + 2 * kind:
                    end += 1
                if begin < chain.lengths[row]:
                    own.append((begin, end, kind, chain.span(row, begin, end, kind)))
            found.append(own)
        return found
