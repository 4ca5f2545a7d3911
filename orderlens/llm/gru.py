"""A gated recurrent language model in numpy, with an output factored in three levels.

A word is predicted from the state before it: first a bundle of classes, then the class within its bundle, then the word
within its class. The last class holds one word alone. Texts run side by side in lanes; the state is carried from window
to window and set to zero where a text begins, so that a whole text is scored however long it is. Gradients go back to
the start of a window (truncated backpropagation through time).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

STATE = 16
WINDOW = 32
LANES = 512
LEAST_LANES, LEAST_STEPS = 32, 160
MOST_DEEPER = 16
SIDE_BY_SIDE = 6
STEP_ROWS = 1 << 9  # rows of weights changed at once, so that they stay in the cache


def pieces(counts: np.ndarray, wanted: int) -> np.ndarray:
    """Where consecutive entries begin that have about equal mass of root frequencies; ``wanted`` of them at most."""
    share = np.cumsum(np.sqrt(counts)) / np.sqrt(counts).sum()
    return np.flatnonzero(np.diff(np.minimum((share * wanted).astype(int), wanted - 1), prepend=-1))


@dataclass
class Classes:
    """Words 0 to n - 1 by falling frequency, cut into classes of about equal mass of root frequencies; then one more
    class, whose only member is number n. Classes are cut into bundles in the same way."""

    cuts: np.ndarray  # class k holds the words cuts[k] to cuts[k + 1] - 1
    bundles: np.ndarray  # bundle j holds the classes bundles[j] to bundles[j + 1] - 1

    @staticmethod
    def of(counts: np.ndarray) -> Classes:
        n = len(counts)
        if n == 0:
            return Classes(np.array([0, 1]), np.array([0, 1]))
        starts = pieces(counts, max(1, int(1.5 * np.sqrt(n))))
        mass = np.append(np.add.reduceat(counts, starts), counts[-1])
        bundles = np.append(pieces(mass, int(np.sqrt(len(mass)))), len(mass))
        return Classes(np.concatenate([starts, [n, n + 1]]), bundles)

    @property
    def words(self) -> int:
        return int(self.cuts[-1])

    def of_words(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, words, "right") - 1


Weights = dict[str, np.ndarray]


def initial(classes: Classes, counts: np.ndarray, other: float, size: int = STATE) -> Weights:
    """Small random weights; output offsets start at the log frequencies, so that training starts from unigrams.

    The last column of an output is its offset.
    """
    draw, n = np.random.default_rng(7), classes.words
    mass = np.concatenate([counts, [other]]).astype(np.float64) + 0.5
    by_class = np.add.reduceat(mass, classes.cuts[:-1])
    by_bundle = np.add.reduceat(by_class, classes.bundles[:-1])
    given = {
        "inputs": draw.normal(0, 0.1, (n, 3 * size)),
        "recurrent": draw.normal(0, 0.2, (size, 3 * size)),
    }
    levels = {
        "bundle_out": (by_bundle, by_bundle.sum()),
        "class_out": (by_class, np.repeat(by_bundle, np.diff(classes.bundles))),
        "word_out": (mass, np.repeat(by_class, np.diff(classes.cuts))),
    }
    for name, (part, whole) in levels.items():
        given[name] = np.column_stack([draw.normal(0, 0.05, (len(part), size)), np.log(part / whole)])
    given["inputs"][:, :size] += 1.0  # the update gate starts out keeping most of the state
    return {name: value.astype(np.float32) for name, value in given.items()}


def sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += np.float32(1)
    return np.reciprocal(x, out=x)


def hyperbolic(x: np.ndarray) -> np.ndarray:
    """tanh by the faster exponential."""
    x *= np.float32(2)
    x = sigmoid(x)
    x *= np.float32(2)
    x -= np.float32(1)
    return x


def lanes_of(lengths: np.ndarray, lanes: int) -> list[np.ndarray]:
    """Texts dealt to lanes, longest first to the shortest lane; lanes by falling length, the texts of each in any order,
    so that windows hold long and short texts from the first to the last."""
    queue = [(0, i) for i in range(min(lanes, len(lengths)))]
    dealt: list[list[int]] = [[] for _ in queue]
    for text in np.argsort(-lengths, kind="stable"):
        size, lane = queue[0]
        dealt[lane].append(int(text))
        heapq.heapreplace(queue, (size + int(lengths[text]), lane))
    draw = np.random.default_rng(7)
    return sorted(map(draw.permutation, dealt), key=lambda texts: -int(lengths[texts].sum()))


def windows(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, lanes: int, steps: int) -> Iterator[tuple]:
    """(words, text begins here, place in ``words``, valid) of each window, as arrays of steps by lanes still running.

    Where fewer lanes run, as at the end, windows are deeper, so that they hold about as many words.
    """
    dealt = lanes_of(lengths, lanes)
    sizes = np.array([lengths[texts].sum() for texts in dealt], np.int64)
    if not len(sizes):
        return
    order, offsets = np.concatenate(dealt), np.cumsum(sizes) - sizes
    ends = np.cumsum(lengths[order])
    begin = np.zeros(ends[-1], bool)
    begin[ends - lengths[order]] = True
    kind = np.int32 if max(len(words), len(begin)) < 1 << 31 else np.int64
    place = np.arange(len(begin), dtype=kind)
    place += np.repeat((starts[order] + lengths[order] - ends).astype(kind), lengths[order])
    del dealt, order, ends
    at = 0
    while at < sizes[0]:
        running = int((sizes > at).sum())
        step = np.arange(at, min(at + steps * min(lanes // running, MOST_DEEPER), int(sizes[0])))[:, None]
        at += len(step)
        valid = step < sizes[:running]
        here = np.where(valid, offsets[:running] + step, 0)
        where = place[here]
        yield words[where], begin[here] & valid, where, valid


def sums(rows: np.ndarray, order: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of ``rows[order]`` from each of ``begins`` to the next. Most stretches are short: they are summed side by side."""
    sizes = np.diff(begins, append=len(order))
    out = rows.take(order[begins], axis=0)
    for i in range(1, SIDE_BY_SIDE):
        at = np.flatnonzero(sizes > i)
        out[at] += rows.take(order[begins[at] + i], axis=0)
    more = np.flatnonzero(sizes > SIDE_BY_SIDE)
    if len(more):
        left = np.arange(len(order)) - np.repeat(begins, sizes) >= SIDE_BY_SIDE
        ends = np.cumsum(sizes[more] - SIDE_BY_SIDE)
        out[more] += np.add.reduceat(rows.take(order[left], axis=0), np.concatenate([[0], ends[:-1]]), axis=0)
    return out


class Network:
    """Forward and backward passes over windows."""

    def __init__(self, weights: Weights, classes: Classes):
        self.w, self.classes = weights, classes
        self.size = weights["recurrent"].shape[0]
        self.state = np.zeros((0, self.size), np.float32)
        self.class_of = classes.of_words(np.arange(classes.words))
        self.bundle_of = np.repeat(np.arange(len(classes.bundles) - 1), np.diff(classes.bundles))
        self.kind = np.uint16 if classes.words < 1 << 16 else np.int64  # short numbers are sorted faster
        self.measure()

    def measure(self) -> None:
        """Bound the logits: states lie between -1 and 1."""
        self.reach = max(float(np.abs(self.w[name]).sum(axis=1).max()) for name in ("bundle_out", "class_out", "word_out"))

    def start(self, lanes: int) -> None:
        self.state = np.zeros((lanes, self.size), np.float32)

    def gates(self) -> np.ndarray:
        """The recurrent weights as one square for each gate, so that what they give lies gate by gate."""
        return np.ascontiguousarray(self.w["recurrent"].reshape(self.size, 3, self.size).swapaxes(0, 1))

    def forward(self, words: np.ndarray, first: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States before each word of a window, and what the backward pass needs."""
        n, u = self.size, self.gates()
        steps, lanes = words.shape
        state, trace = self.state[:lanes], []
        given = np.ascontiguousarray(np.moveaxis(self.w["inputs"].take(words, axis=0).reshape(steps, lanes, 3, n), 2, 1))
        before = np.empty((steps, lanes, n), np.float32)
        fresh = first.any(axis=1)
        for t in range(steps):
            if fresh[t]:
                state = state * ~first[t][:, None]
            before[t] = state
            hidden = state @ u
            gates = given[t, :2]
            gates += hidden[:2]
            z, r = sigmoid(gates)
            new = given[t, 2]
            new += r * hidden[2]
            new = hyperbolic(new)
            if keep:
                trace.append((state, gates, new, hidden[2]))
            state = state - new
            state *= z
            state += new
        self.state = state
        return before, trace

    def choose(self, name: str, cuts: np.ndarray, labels: np.ndarray, states: np.ndarray, back=None, grads=None) -> np.ndarray:
        """Natural log probabilities of labels, which are in order, within their pieces by ``cuts``, given states.

        With ``grads``, gradients of the log sums of odds are added to these, and the gradients of the negative sum of
        what is returned to ``back``. Odds are not divided by their sums: where they meet states, the states are.
        """
        w, bounds = self.w[name], np.searchsorted(labels, cuts)
        chosen = w.take(labels, axis=0)
        out = np.einsum("ij,ij->i", states, chosen)
        plain = np.ones_like(w)  # a one for the offset: odds times this are the pull of all labels and the sum of odds
        if grads is not None:
            plain[:, :-1] = w[:, :-1]
            pull = chosen.copy()
            pull[:, -1] = 1
        else:
            plain = plain[:, :1].copy()
            pull = np.ones((len(labels), 1), w.dtype)
        for k in np.flatnonzero((np.diff(cuts) > 1) & (np.diff(bounds) > 0)).tolist():
            a, b, own = cuts[k], cuts[k + 1], slice(bounds[k], bounds[k + 1])
            state = states[own]
            odds = np.dot(state, w[a:b].T)
            if self.reach > 60:
                top = odds.max(axis=1)
                odds -= top[:, None]
                np.maximum(odds, np.float32(-80), out=odds)
                out[own] -= top
            np.exp(odds, out=odds)
            part = np.dot(odds, plain[a:b], out=pull[own])
            if grads is not None:
                gradient = grads[name][a:b]
                gradient += np.dot(odds.T, state / part[:, -1:])
        out -= np.log(pull[:, -1])
        for k in np.flatnonzero((np.diff(cuts) == 1) & (np.diff(bounds) > 0)).tolist():
            out[bounds[k] : bounds[k + 1]] = 0  # a label alone in its piece is certain
        if grads is not None:
            pull /= pull[:, -1:].copy()
            pull -= chosen
            back += pull
        return out

    def scores(self, before: np.ndarray, words: np.ndarray, grads: Weights | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probabilities of words given states, both flat; and gradients of their negative sum by state."""
        order = np.argsort(words.astype(self.kind), kind="stable")
        labels = words[order]
        states = np.ones((len(labels), self.size + 1), before.dtype)  # the offset is the weight of a one
        states[:, :-1] = before[order]
        back = None
        if grads is not None:
            back = np.zeros_like(states)
            begins = np.flatnonzero(np.diff(labels, prepend=-1))
            names, by_name = labels[begins], sums(states, np.arange(len(labels)), begins)
        found = np.zeros(len(labels), states.dtype)
        levels = ("word_out", self.classes.cuts, self.class_of), ("class_out", self.classes.bundles, self.bundle_of)
        top = ("bundle_out", np.array([0, len(self.w["bundle_out"])]), np.zeros(len(self.w["bundle_out"]), np.int64))
        for name, cuts, piece_of in (*levels, top):
            found += self.choose(name, cuts, labels, states, back, grads)
            labels = piece_of[labels]
            if grads is not None:
                pieces_of = piece_of[names]
                several = (np.diff(cuts) > 1)[pieces_of]
                grads[name][names[several]] -= by_name[several]
                begins = np.flatnonzero(np.diff(pieces_of, prepend=-1))
                names, by_name = pieces_of[begins], np.add.reduceat(by_name, begins, axis=0)
        out = np.empty(len(words), np.float32)
        out[order] = found
        if back is not None:
            sorted_back, back = back, np.empty_like(before)
            back[order] = sorted_back[:, :-1]
        return out, back

    def backward(self, words: np.ndarray, first: np.ndarray, trace: list, back: np.ndarray, grads: Weights) -> tuple:
        """Adds the gradients of a window. Returns the words read and the gradients of their input vectors, which are
        added too if ``grads`` has a table of them."""
        n, u = self.size, self.gates().swapaxes(1, 2)
        steps, lanes = words.shape
        ahead = np.zeros((lanes, n), np.float32)
        given = np.empty((steps, lanes, 3, n), np.float32)
        inner = np.empty((3, steps, lanes, n), np.float32)
        fresh = first.any(axis=1)
        for t in range(steps - 1, -1, -1):
            state, gates, new, hidden = trace[t]
            z, r = gates
            here = inner[:, t]
            d_new = new * new
            np.subtract(np.float32(1), d_new, out=d_new)
            d_new *= ahead
            rest = ahead * z
            d_new *= np.float32(1) - z
            np.subtract(state, new, out=here[0])
            here[0] *= ahead
            np.multiply(d_new, hidden, out=here[1])
            slope = np.float32(1) - gates
            slope *= gates
            here[:2] *= slope
            np.multiply(d_new, r, out=here[2])
            given[t, :, 0], given[t, :, 1], given[t, :, 2] = here[0], here[1], d_new
            gone = here @ u
            ahead = gone[0]
            ahead += gone[1]
            ahead += gone[2]
            ahead += rest
            ahead += back[t]
            if fresh[t]:
                ahead *= ~first[t][:, None]
        states = np.concatenate([one[0] for one in trace])
        for i in range(3):
            grads["recurrent"][:, i * n : (i + 1) * n] += states.T @ inner[i].reshape(-1, n)
        flat = words.ravel()
        order = np.argsort(flat.astype(self.kind), kind="stable")
        flat = flat[order]
        begins = np.flatnonzero(np.diff(flat, prepend=-1))
        read, gradient = flat[begins], sums(given.reshape(-1, 3 * n), order, begins)
        if "inputs" in grads:
            grads["inputs"][read] += gradient
        return read, gradient


class Trainer:
    """Adam steps, one per window. Input vectors take part in the steps of windows that hold their words."""

    def __init__(self, network: Network, rate: float):
        self.network, self.rate, self.steps = network, rate, 0
        self.first = {name: np.zeros_like(value) for name, value in network.w.items()}
        self.second = {name: np.zeros_like(value) for name, value in network.w.items()}
        self.grads = {name: np.zeros_like(value) for name, value in network.w.items() if name != "inputs"}

    def learn(self, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> int:
        """One pass over texts; the number of words learned from. Few words run in fewer lanes, for as many steps."""
        network, learned = self.network, 0
        lanes = int(np.clip(lengths.sum() // (WINDOW * LEAST_STEPS), LEAST_LANES, LANES))
        network.start(lanes)
        for part, first, _, valid in windows(words, starts, lengths, lanes, WINDOW):
            grads = self.grads
            before, trace = network.forward(part, first, True)
            flat = valid.ravel()
            count = int(flat.sum())
            states, back = before.reshape(-1, network.size), np.zeros((len(flat), network.size), np.float32)
            if count == len(flat):
                _, back = network.scores(states, part.ravel(), grads)
            else:
                _, back[flat] = network.scores(states[flat], part.ravel()[flat], grads)
            read = network.backward(part, first, trace, back.reshape(*part.shape, -1), grads)
            self.step(grads, count, *read)
            learned += count
        return learned

    def step(self, grads: Weights, count: int, read: np.ndarray, gradient: np.ndarray) -> None:
        """A step by the gradients, which are set to zero, and by those of the input vectors of the words read."""
        self.steps += 1
        if self.steps % 16 == 0:
            self.network.measure()
        rate = self.rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        for name, whole in grads.items():
            first, second, weights = self.first[name], self.second[name], self.network.w[name]
            for at in range(0, len(whole), STEP_ROWS):
                rows = slice(at, at + STEP_ROWS)
                weights[rows] -= adapted(whole[rows], first[rows], second[rows], count, rate)
                whole[rows] = 0
        first, second, weights = self.first["inputs"], self.second["inputs"], self.network.w["inputs"]
        for at in range(0, len(read), STEP_ROWS):
            rows = read[at : at + STEP_ROWS]
            one, two, value = (table.take(rows, axis=0) for table in (first, second, weights))
            value -= adapted(gradient[at : at + STEP_ROWS], one, two, count, rate)
            first[rows], second[rows], weights[rows] = one, two, value


def adapted(gradient: np.ndarray, first: np.ndarray, second: np.ndarray, count: int, rate: float) -> np.ndarray:
    """Adam's change by a sum of ``count`` gradients, in their place; the sums of falling weights are brought up to date."""
    gradient *= np.float32(1 / count)
    first *= np.float32(0.9)
    first += gradient
    gradient *= gradient
    second *= np.float32(0.99)
    second += gradient
    np.sqrt(second, out=gradient)  # the sums are 10 and 100 times the means, and so the ratio is the same
    gradient += np.float32(1e-5)
    np.divide(first, gradient, out=gradient)
    gradient *= np.float32(rate)
    return gradient


def log_probabilities(weights: Weights, classes: Classes, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log probability of every word of the texts, at its place."""
    network, out = Network(weights, classes), np.zeros(len(words))
    network.start(LANES)
    for part, first, where, valid in windows(words, starts, lengths, LANES, 2 * WINDOW):
        before, _ = network.forward(part, first, False)
        flat = valid.ravel()
        scored, _ = network.scores(before.reshape(-1, network.size)[flat], part.ravel()[flat])
        out[where.ravel()[flat]] = scored
    return out
