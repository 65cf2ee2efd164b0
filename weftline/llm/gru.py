"""A gated recurrent language model over word classes, in numpy.

The output is factored: the class of the next word given the state, then the word given its class, each a softmax over the
state. Training is backpropagation through windows of fixed length; the state is carried from window to window, in training
as in scoring, and starts anew with each document (in training also every PIECE words of a very long one, whose next word
then still sees the word before). Many documents run side by side in lanes, which are the columns of a step's matrices, so every
gate is a block of whole rows. The tokens of a window are sorted by class, so each class is one matrix product over a slice of
the word vectors. Word vectors, a third of a row's cost each, follow a rule with one number a row; the small dense matrices
follow Adam.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

HIDDEN = 16
WINDOW = 24
#: Lanes in training at most, and the words a lane should have at least; fewer words mean fewer lanes, never under LEAST_LANES.
LANES, LANE_WORDS, LEAST_LANES = 512, 2_000, 32
PIECE = 2_048
EPOCHS = 2
RATE, ROW_RATE = 0.02, 0.3
#: Rows of a softmax worked on at a time, so that they stay in the cache of a core.
ROWS = 512
#: States gathered in scoring before the words they predict are looked at, class by class.
GATHERED = 1 << 15
#: Steps times lanes of a window in scoring, at most, where few long documents are left in the lanes.
WIDE = 2_048
#: Logits that float32 can exponentiate without taking the largest off first.
TAME = 60.0


@dataclass
class Output:
    """The output side of a vocabulary: class of each word id, and the place inside it."""

    classes: np.ndarray  # class of each word id
    place: np.ndarray  # place inside the class, -1 where the class is one id
    sizes: dict[int, int]  # words of each class with a softmax of its own

    def __post_init__(self) -> None:
        self.first: dict[int, int] = {}  # first row of each class in the word vectors
        self.rows = 0
        for c, n in self.sizes.items():
            self.first[c] = self.rows
            self.rows += n
        # row of each word id in the word vectors, -1 without one; ids in order of class and place
        self.row = np.array([self.first[c] + p if c in self.sizes else -1
                             for c, p in zip(self.classes.tolist(), self.place.tolist(), strict=True)], np.int64)
        self.rank = np.empty(len(self.classes), np.uint16 if len(self.classes) < 65_536 else np.int64)
        self.rank[np.lexsort((self.place, self.classes))] = np.arange(len(self.classes))


@dataclass
class Gru:
    inputs: np.ndarray  # input id x hidden
    into: np.ndarray  # hidden x 3 hidden: update gate, reset gate, candidate
    bias: np.ndarray
    recur: np.ndarray  # hidden x 3 hidden
    to_class: np.ndarray
    class_bias: np.ndarray
    words: np.ndarray  # word x hidden, class by class
    word_bias: np.ndarray

    def params(self) -> list[np.ndarray]:
        return [self.inputs, self.into, self.bias, self.recur, self.to_class, self.class_bias, self.words, self.word_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.params()])

    def filled(self, flat: np.ndarray) -> Gru:
        """The same model with other weights."""
        parts = np.split(flat, np.cumsum([p.size for p in self.params()])[:-1])
        return Gru(*[x.reshape(p.shape).astype(np.float32) for x, p in zip(parts, self.params(), strict=True)])

    def tame(self) -> bool:
        """Whether no state, whose parts lie between -1 and 1, can give a logit above TAME."""
        most = lambda w: float(max(w.max(initial=0), -w.min(initial=0)))
        return all(HIDDEN * most(w) + float(b.max(initial=0)) < TAME or float((np.abs(w).sum(axis=axis) + b).max(initial=0)) < TAME
                   for w, axis, b in ((self.to_class, 0, self.class_bias), (self.words, 1, self.word_bias)))


def fresh(n_inputs: int, output: Output, class_counts: np.ndarray, word_counts: dict[int, np.ndarray], seed: int = 11) -> Gru:
    """A model that starts as the class and word frequencies themselves."""
    rng = np.random.default_rng(seed)
    small = lambda *shape: (rng.normal(size=shape) * 0.1).astype(np.float32)
    start = lambda c: np.log((c + 0.5) / (c + 0.5).sum()).astype(np.float32)
    return Gru(small(n_inputs, HIDDEN), small(HIDDEN, 3 * HIDDEN) * np.float32(4), np.zeros(3 * HIDDEN, np.float32),
               small(HIDDEN, 3 * HIDDEN), small(HIDDEN, len(class_counts)), start(class_counts),
               small(output.rows, HIDDEN) * np.float32(0.1),
               np.concatenate([np.zeros(0, np.float32), *[start(word_counts[c]) for c in output.sizes]]))


def stacked(model: Gru) -> np.ndarray:
    """The weights of a step as one matrix. Times (state, input, one) it gives the recurrent side of the candidate, the two
    gates' logits, both negated, and the entering side of the candidate: all but the last depend on the state, all but the
    first on the input."""
    H = HIDDEN
    out = np.zeros((4 * H, 2 * H + 1), np.float32)
    out[:H, :H] = model.recur[:, 2 * H:].T
    out[H:3 * H, :H], out[H:3 * H, H:2 * H], out[H:3 * H, 2 * H] = -model.recur[:, :2 * H].T, -model.into[:, :2 * H].T, -model.bias[:2 * H]
    out[3 * H:, H:2 * H], out[3 * H:, 2 * H] = model.into[:, 2 * H:].T, model.bias[2 * H:]
    return out


def step(weights: np.ndarray, given: np.ndarray, sums: np.ndarray, n: np.ndarray, new: np.ndarray) -> None:
    """One time step from ``given`` (state, input and one, a column a lane) to the state ``new``, which may be that in ``given``;
    leaves the candidate in ``n``, the gates and the sides of the candidate in ``sums``."""
    H = HIDDEN
    np.matmul(weights, given, out=sums)
    gates = sums[H:3 * H]
    np.exp(gates, out=gates)
    np.add(gates, 1, out=gates)
    np.reciprocal(gates, out=gates)
    np.multiply(gates[H:], sums[:H], out=n)
    np.add(n, sums[3 * H:], out=n)
    np.tanh(n, out=n)
    np.subtract(given[:H], n, out=new)
    np.multiply(new, gates[:H], out=new)
    np.add(new, n, out=new)


class Lanes:
    """Documents dealt to lanes of about equal length; in each lane one after the other.

    ``firsts`` are the input ids that the documents begin with. Lanes are ordered by length, so those still running at any time
    are the first ones.
    """

    def __init__(self, docs: list[np.ndarray], firsts: np.ndarray, as_input: np.ndarray, count: int):
        lengths = [len(d) for d in docs]
        dealt: list[list[int]] = [[] for _ in range(max(1, min(count, len(docs))))]
        load = [(0, k) for k in range(len(dealt))]
        for i in sorted(range(len(docs)), key=lambda i: (-lengths[i], i)):
            used, at = load[0]
            dealt[at].append(i)
            heapq.heapreplace(load, (used + lengths[i], at))
        loads = dict((k, used) for used, k in load)
        order = [i for k in sorted(loads, key=lambda k: -loads[k]) for i in dealt[k]]
        self.length = np.array(sorted(loads.values(), reverse=True))
        self.offset = np.append(0, np.cumsum(self.length)[:-1])
        self.ids = np.concatenate([docs[i] for i in order])
        own = np.array([lengths[i] for i in order])
        begins = np.append(0, np.cumsum(own)[:-1])[own > 0]
        self.owner = np.repeat(np.array(order, np.int32), own)
        self.starts = np.zeros(len(self.ids), bool)
        self.starts[begins] = True
        self.before = np.empty(len(self.ids), np.int32)
        self.before[1:] = as_input[self.ids[:-1]]
        self.before[begins] = firsts[np.array(order)[own > 0]]

    def windows(self, size: int, most: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each window the places (time x running lane) in the stream and which of them are not past a lane's end. A window
        of few lanes has more than ``size`` times, up to ``most`` places in all."""
        at, end = 0, int(self.length[0]) if len(self.ids) else 0
        while at < end:
            running = int(np.searchsorted(-self.length, -at, side="left"))
            upto = min(at + max(size, most // running), end)
            times = np.arange(at, upto)[:, None]
            live, places = times < self.length[:running], self.offset[:running] + times
            yield (places if self.length[running - 1] >= upto else np.where(live, places, self.offset[:running])), live
            at = upto


ONES = np.ones(1 << 17, np.float32)
FIRST = np.arange(ROWS)


def table(vectors: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Vectors (hidden x words), bias and ones in rows: rows (state, one) times the first two are logits, exponentials times the
    transpose give the sums of vectors and, last, of themselves. Rows lie a little apart, or they share a place in the cache."""
    out = np.ones((HIDDEN + 2, vectors.shape[1] + 16), np.float32)[:, :vectors.shape[1]]
    out[:HIDDEN], out[HIDDEN] = vectors, bias
    return out


def logits(hidden: np.ndarray, rows: np.ndarray, tame: bool) -> np.ndarray:
    """Logits of ``hidden`` (state, one) over the columns of a `table`, up to a number for each row."""
    out = hidden @ rows[:HIDDEN + 1]
    if not tame:
        out -= out.max(axis=1, keepdims=True)
    return out


def totals(shares: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """The sum of each row."""
    width = shares.shape[1]
    return np.matmul(shares, ONES[:width], out=out) if width <= len(ONES) else shares.sum(axis=1, out=out)


def with_one(states: np.ndarray) -> np.ndarray:
    out = np.ones((len(states), HIDDEN + 1), np.float32)
    out[:, :HIDDEN] = states
    return out


def class_runs(classes: np.ndarray, sizes: dict[int, int]) -> Iterator[tuple[int, int, int]]:
    """(class, from, to) of the runs in sorted ``classes`` that have a softmax of their own, cut to ROWS rows."""
    edges = met_first(classes).tolist()
    for a, b in zip(edges, [*edges[1:], len(classes)], strict=True):
        c = int(classes[a])
        if c in sizes:
            for at in range(a, b, ROWS):
                yield c, at, min(at + ROWS, b)


def by_class(output: Output, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts ``words`` by class and place, and classes and rows of the word vectors in that order."""
    order = np.argsort(output.rank.take(words), kind="stable")
    words = words.take(order)
    return order, output.classes.take(words), output.row.take(words)


def met_first(found: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.zeros(0, np.int64)


def score(model: Gru, output: Output, as_input: np.ndarray, start_id: int, docs: list[np.ndarray], count: int = 1_024,
          window: int = 32) -> np.ndarray:
    """Natural log probability of each document's classes and of the words in them.

    The states of many windows are gathered before the output, so a class is one product over many rows also where only a
    few long documents are left in the lanes.
    """
    scores = np.zeros(len(docs))
    if not docs:
        return scores
    stream, tame = Lanes(docs, np.full(len(docs), start_id), as_input, count), model.tame()
    weights, to_class, words = stacked(model), table(model.to_class, model.class_bias), table(model.words.T, model.word_bias)
    given = np.ones((2 * HIDDEN + 1, len(stream.length)), np.float32)
    given[:HIDDEN] = 0
    gathered, held = [], 0

    def log_shares(hidden: np.ndarray, runs: Iterable[tuple[int, int, np.ndarray]], targets: np.ndarray) -> np.ndarray:
        """Natural log of the targets' probabilities: for each run (from, to, columns of a `table`) one product."""
        found, sums = np.zeros(len(hidden), np.float32), np.ones(len(hidden), np.float32)
        for a, b, columns in runs:
            out = logits(hidden[a:b], columns, tame)
            width = out.shape[1]
            out.ravel().take(FIRST[:b - a] * width + targets[a:b], out=found[a:b], mode="clip")
            np.exp(out, out=out)
            totals(out, sums[a:b])
        return found - np.log(sums)

    def outputs() -> None:
        here, states = (np.concatenate(x) for x in zip(*gathered, strict=True))
        order, classes, row = by_class(output, stream.ids.take(here))
        hidden = with_one(states.take(order, axis=0))
        part = log_shares(hidden, ((a, min(a + ROWS, len(here)), to_class) for a in range(0, len(here), ROWS)), classes)
        part += log_shares(hidden, ((a, b, words[:, output.first[c]:output.first[c] + output.sizes[c]])
                                    for c, a, b in class_runs(classes, output.sizes)), output.place.take(stream.ids.take(here)).take(order))
        scores[:] += np.bincount(stream.owner.take(here).take(order), part, len(docs))

    for places, live in stream.windows(window, WIDE):
        times, lanes = places.shape
        if lanes < given.shape[1]:
            given = np.ascontiguousarray(given[:, :lanes])
        vectors, starts = model.inputs.take(stream.before.take(places), axis=0), stream.starts.take(places)
        vectors, begins = np.ascontiguousarray(vectors.transpose(0, 2, 1)), starts.any(axis=1).tolist()
        states, sums = np.empty((times, HIDDEN, lanes), np.float32), np.empty((4 * HIDDEN, lanes), np.float32)
        now, entering, n = given[:HIDDEN], given[HIDDEN:2 * HIDDEN], np.empty((HIDDEN, lanes), np.float32)
        for t in range(times):
            if begins[t]:
                now[:, starts[t]] = 0
            entering[...] = vectors[t]
            step(weights, given, sums, n, now)
            states[t] = now
        where = np.flatnonzero(live)
        gathered.append((places.ravel().take(where), states.transpose(0, 2, 1).reshape(-1, HIDDEN).take(where, axis=0)))
        held += len(where)
        if held >= GATHERED:
            outputs()
            gathered, held = [], 0
    if held:
        outputs()
    return scores


class Trainer:
    """Truncated windows, block of documents by block. The order is fixed, so a rerun gives the same model."""

    DENSE = ("into", "bias", "recur", "to_class", "class_bias")

    def __init__(self, model: Gru, output: Output, as_input: np.ndarray, start_id: int):
        self.model, self.output, self.as_input, self.start_id = model, output, as_input, start_id
        self.words = table(model.words.T, model.word_bias)
        model.words, model.word_bias = self.words[:HIDDEN].T, self.words[HIDDEN]  # the same numbers
        self.first = {k: np.zeros_like(getattr(model, k)) for k in self.DENSE}
        self.second = {k: np.zeros_like(getattr(model, k)) for k in self.DENSE}
        self.seen = {k: np.ones(len(getattr(model, k)), np.float32) for k in ("inputs", "words", "word_bias")}
        self.turn = 0

    def update(self, grads: dict[str, np.ndarray], rate: float) -> None:
        """Adam for the dense matrices."""
        self.turn += 1
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in grads.values()))
        scale = np.float32(min(1.0, 1.0 / (norm + 1e-9)))
        near, far = 1 - 0.9**self.turn, 1 - 0.99**self.turn
        for k, g in grads.items():
            g = g * scale
            m, s = self.first[k], self.second[k]
            m += np.float32(0.1) * (g - m)
            s += np.float32(0.01) * (g * g - s)
            getattr(self.model, k)[...] -= np.float32(rate / near) * m / (np.sqrt(s * np.float32(1 / far)) + np.float32(1e-8))

    def met(self, name: str, rows: slice | np.ndarray, size: np.ndarray, rate: float) -> np.ndarray:
        """Adagrad with one number a row, which ``size`` is added to: the rate of each row."""
        seen = self.seen[name]
        seen[rows] = now = seen[rows] + size
        return np.float32(rate) / np.sqrt(now)

    def learn(self, docs: list[np.ndarray], rates: tuple[float, float]) -> None:
        """One pass over ``docs``; the rate falls from the first of ``rates`` to the second."""
        pieces = [(d[at:at + PIECE], self.start_id if at == 0 else int(self.as_input[d[at - 1]]))
                  for d in docs for at in range(0, len(d), PIECE)]
        if not pieces:
            return
        words = sum(len(d) for d, _ in pieces)
        stream = Lanes([d for d, _ in pieces], np.array([f for _, f in pieces]), self.as_input,
                       min(LANES, max(LEAST_LANES, words // LANE_WORDS)))
        h = np.zeros((HIDDEN, len(stream.length)), np.float32)
        done = 0
        for places, live in stream.windows(WINDOW):
            rate = rates[0] + (rates[1] - rates[0]) * done / words
            done += int(np.count_nonzero(live))
            h = self.window(stream, places, live, np.ascontiguousarray(h[:, :places.shape[1]]), rate)

    def window(self, stream: Lanes, places: np.ndarray, live: np.ndarray, h: np.ndarray, rate: float) -> np.ndarray:
        model, H, (times, lanes) = self.model, HIDDEN, places.shape
        met, starts, weights = stream.before.take(places), stream.starts.take(places), stacked(model)
        vectors = model.inputs.take(met, axis=0)
        given, sums = np.empty((times, 2 * H + 1, lanes), np.float32), np.empty((times, 4 * H, lanes), np.float32)
        cand, states = np.empty((times, H, lanes), np.float32), np.ones((times, lanes, H + 1), np.float32)
        given[:, H:2 * H], given[:, 2 * H] = vectors.transpose(0, 2, 1), 1
        begins = starts.any(axis=1).tolist()
        for t in range(times):
            given[t, :H] = h
            if begins[t]:
                given[t, :H, starts[t]] = 0
            step(weights, given[t], sums[t], cand[t], h)
            states[t, :, :H] = h.T

        where = np.flatnonzero(live)
        order, classes, row = by_class(self.output, stream.ids.take(places.ravel().take(where)))
        where = where.take(order)
        grads, d_sorted = self.outputs(states.reshape(-1, H + 1).take(where, axis=0), classes, row, rate)
        spread = np.zeros((times * lanes, H), np.float32)
        spread[where] = d_sorted
        spread = spread.reshape(times, lanes, H)

        d_vectors, dh, d_sums = np.empty_like(vectors), np.zeros((H, lanes), np.float32), np.empty((4 * H, lanes), np.float32)
        d_side, d_z, d_r, d_cand = (d_sums[k * H:(k + 1) * H] for k in range(4))
        of_state, of_input = d_sums[:3 * H], d_sums[H:]
        to_state, to_input = np.ascontiguousarray(weights[:3 * H, :H].T), np.ascontiguousarray(weights[H:, H:2 * H])
        d_recur, d_into, d_bias = np.zeros((3 * H, H), np.float32), np.zeros((3 * H, H), np.float32), np.zeros(3 * H, np.float32)
        one = given[0, 2 * H]
        for t in range(times - 1, -1, -1):  # the gates' logits are negated
            side, z, r, n = sums[t, :H], sums[t, H:2 * H], sums[t, 2 * H:3 * H], cand[t]
            dh += spread[t].T
            fresh = 1 - z
            fresh *= dh
            np.subtract(n, given[t, :H], out=d_z)
            d_z *= z
            d_z *= fresh
            np.multiply(n, n, out=d_cand)
            np.subtract(1, d_cand, out=d_cand)
            d_cand *= fresh
            np.multiply(d_cand, r, out=d_side)
            np.subtract(r, 1, out=d_r)
            d_r *= side
            d_r *= d_side
            d_recur += of_state @ given[t, :H].T
            d_into += of_input @ given[t, H:2 * H].T
            d_bias += of_input @ one
            np.matmul(of_input.T, to_input, out=d_vectors[t])
            dh *= z
            dh += to_state @ of_state
            if begins[t]:
                dh[:, starts[t]] = 0

        by = np.argsort(met.astype(np.uint16) if len(model.inputs) < 65_536 else met, axis=None, kind="stable")
        sorted_ids = met.ravel().take(by)
        edges = met_first(sorted_ids)
        by_word = np.add.reduceat(d_vectors.reshape(-1, H).take(by, axis=0), edges, axis=0)
        d_into[:2 * H] *= -1
        d_bias[:2 * H] *= -1
        grads |= {"into": d_into.T, "bias": d_bias, "recur": np.hstack([-d_recur[H:].T, d_recur[:H].T])}
        rows, row_rate, part = sorted_ids[edges], rate * ROW_RATE / RATE, np.float32(1 / len(where))
        size = np.einsum("ij,ij->i", by_word, by_word) * np.float32(4 / H)
        model.inputs[rows] -= by_word * self.met("inputs", rows, size, row_rate)[:, None]
        self.update({k: g * part for k, g in grads.items()}, rate)
        return h

    def outputs(self, hidden: np.ndarray, classes: np.ndarray, row: np.ndarray, rate: float) -> tuple[dict, np.ndarray]:
        """Moves the word vectors; returns the gradients, summed over tokens, of the class side and of the states.

        A target's share less one is what its logit is moved by, so vectors and states take their gradients from one matrix.
        """
        model, output, H, tame = self.model, self.output, HIDDEN, self.model.tame()
        to_class, words = table(model.to_class, model.class_bias), self.words
        class_rows, word_rows = np.ascontiguousarray(to_class[:H].T), np.ascontiguousarray(words[:H].T)
        d_class, d_words = np.zeros((len(class_rows), H + 1), np.float32), np.zeros((len(word_rows), H + 1), np.float32)
        d_hidden, moved = np.empty((len(hidden), H), np.float32), np.zeros((len(hidden), H), np.float32)

        def errors(a: int, b: int, columns: np.ndarray, targets: np.ndarray) -> np.ndarray:
            e = logits(hidden[a:b], columns, tame)
            np.exp(e, out=e)
            e *= (1 / totals(e))[:, None]
            e.ravel()[targets[a:b]] -= 1
            return e

        targets = np.arange(len(hidden)) % ROWS * len(class_rows) + classes
        for a in range(0, len(hidden), ROWS):
            b = min(a + ROWS, len(hidden))
            e = errors(a, b, to_class, targets)
            np.matmul(e, class_rows, out=d_hidden[a:b])
            d_class += e.T @ hidden[a:b]
        runs = [*class_runs(classes, output.sizes)]
        for c, a, b in runs:
            targets[a:b] = row[a:b] - output.first[c] + FIRST[:b - a] * output.sizes[c]
        for c, a, b in runs:
            mine = slice(output.first[c], output.first[c] + output.sizes[c])
            e = errors(a, b, words[:, mine], targets)
            np.matmul(e, word_rows[mine], out=moved[a:b])
            d_words[mine] += e.T @ hidden[a:b]
        d_hidden += moved
        if runs:
            d_words, row_rate = np.ascontiguousarray(d_words.T), rate * ROW_RATE / RATE
            size = np.einsum("ij,ij->j", d_words[:H], d_words[:H]) * np.float32(4 / H)
            for part, name, grown in ((slice(H), "words", size), (H, "word_bias", d_words[H] * d_words[H])):
                d_words[part] *= self.met(name, slice(None), grown, row_rate)
                words[part] -= d_words[part]
        return {"to_class": d_class[:, :H].T, "class_bias": d_class[:, H]}, d_hidden


def train(model: Gru, output: Output, as_input: np.ndarray, start_id: int, docs: list[np.ndarray], epochs: int = EPOCHS) -> Gru:
    trainer = Trainer(model, output, as_input, start_id)
    fall = lambda done: RATE * (1 - 0.9 * done / epochs)
    for epoch in range(epochs):
        trainer.learn(docs, (fall(epoch), fall(epoch + 1)))
    return model
