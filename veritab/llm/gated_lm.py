"""Language-model scoring by a gated recurrent network (operator 1).

Word counts of the whole training corpus give the vocabulary, the base score and the distribution of rare words.  On
top stands a gated recurrent network in numpy, trained by truncated backpropagation: tokens run in lanes of documents,
windows of WINDOW steps are trained on, and the state is carried from window to window.  Every word of the head of the
vocabulary (the HEAD most frequent, or all if there are fewer) has a vector, by which the network takes it in and
predicts it.  The output is factored: first a group of classes, then a class, then a leaf of LEAF words within the
class, then a word of the leaf, each by a softmax.  Classes are runs of leaves by falling count, longer where words are
rarer, so that a token costs least; their number grows with the vocabulary.  All words beyond the head are one class and
share it by their smoothed corpus counts.  So every token has a probability, also one never seen.

Training is data-parallel: in every round each partition trains a replica on its share of the documents, and replicas
are averaged: a leaf's words by how often each replica met the leaf, all else by tokens.  Rounds grow, so that replicas
start from a common model; each training document is used in one round, none is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm.frames import held, in_batches, remainder, written

#: Stands for the end of a document; no word is empty.
END = b""
#: How many words are broadcast, each with a vector and an output of its own.
HEAD = 131072
HIDDEN, WINDOW, LANES = 16, 32, 512
#: Tokens of a leaf in a window from which on its words are a matrix product of their own.
MANY = 48
#: Lanes that are scored side by side; no step depends on how many.
WIDE = 768
#: How many training windows' steps are scored at once, so that more tokens share a leaf.
STRETCH = 4
#: Words of a leaf, the lowest level of the factored output.
LEAF = 16
#: Percent of training documents at which rounds end.
ROUNDS = (3, 15, 45, 100)
LEARNING_RATE = 4e-3
#: That of the vectors of words and leaves, by sums of gradients over the root of their squares so far.
WORD_RATE = 0.3
#: Training tokens for each replica in a round.
REPLICA = 4_000_000
#: Leaves whose words are averaged together.
PIECE = 256
SMOOTHING = 0.1
#: Steps that all lanes wait for before they are trained on, and tokens that are scored together.
AHEAD, SCORED = 8 * WINDOW, 1_500_000
#: Bytes of text that are read and that are counted together.
READ, COUNTED = 1 << 22, 1 << 23


@dataclass
class Vocabulary:
    """The head of the corpus's words by falling count, and the totals."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int
    distinct: int
    rank: dict[bytes, int] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.rank = {w: i for i, w in enumerate(self.words)}
        self.lookup = pc.SetLookupOptions(value_set=pa.array(self.words, pa.binary()))
        self.own = len(self.words)
        self.rest_count = self.tokens - int(self.counts.sum())
        self.rest_distinct = self.distinct - self.own
        leaves = -(-self.own // LEAF)
        #: the symbol of all words beyond the head, the only one of the last leaf; a word of the head is its rank
        self.rest = leaves * LEAF
        by_leaf = np.add.reduceat(self.counts, np.arange(0, self.own, LEAF)) if self.own else np.zeros(0, np.int64)
        #: leaves at which classes begin, and classes at which groups begin; the last class and its leaf are the rest's
        first = self.runs(by_leaf)
        self.class_starts = np.append(first, [leaves, leaves + 1]).astype(np.int64)
        self.class_by_leaf = np.repeat(np.arange(len(first) + 1), np.diff(self.class_starts))
        self.leaf_counts = np.append(by_leaf, self.rest_count)
        self.class_counts = np.add.reduceat(self.leaf_counts, self.class_starts[:-1])
        first = self.runs(self.class_counts)
        self.group_starts = np.append(first, len(self.class_counts))
        self.group_counts = np.add.reduceat(self.class_counts, first)
        self.base_all = float(np.log10(self.tokens + SMOOTHING * (self.distinct + 1)))
        self.rest_all = float(np.log10(self.rest_count + SMOOTHING * (self.rest_distinct + 1)))
        self.base = np.log10(self.counts + SMOOTHING) - self.base_all

    def runs(self, counts: np.ndarray) -> np.ndarray:
        """Where runs begin of which one with a share p of the tokens has about 1 / sqrt(p) members."""
        return np.flatnonzero(np.diff(np.floor(np.cumsum(np.sqrt(counts / max(1, self.tokens)))), prepend=-1.0))

    def read(self, text: bytes) -> tuple[np.ndarray, list[bytes]]:
        """Ranks of a text's tokens, -1 beyond the head, and the words beyond it."""
        ranks, _, beyond = self.read_all(pa.chunked_array([pa.array([text], pa.binary())]))
        return ranks, beyond.to_pylist()

    def read_all(self, texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, pa.ChunkedArray]:
        """Ranks of the tokens of all texts, one text after another, -1 beyond the head; how many each text has; and the
        words beyond the head."""
        words, sizes = tokens_of(texts)
        ranks = pc.index_in(words, options=self.lookup)
        return ranks.fill_null(-1).to_numpy(), sizes, words.filter(ranks.is_null())

    def symbols(self, ranks: np.ndarray) -> np.ndarray:
        return np.where(ranks < 0, np.int32(self.rest), ranks)


class Network:
    """The recurrent network's parameters as one flat array, its forward and its backward pass.

    States and gates are arrays of (feature, lane).
    """

    def __init__(self, vocabulary: Vocabulary, flat: np.ndarray | None = None):
        v = self.v = vocabulary
        n_group, n_class, n_leaf = len(v.group_counts), len(v.class_counts), len(v.leaf_counts)
        core = {"i": (3 * HIDDEN, HIDDEN), "ib": (3 * HIDDEN, 1), "u": (3 * HIDDEN, HIDDEN), "g": (n_group, HIDDEN), "gb": (n_group, 1), "c": (n_class, HIDDEN), "cb": (n_class, 1)}
        # the leaves' vectors and biases and, last, those of words stand behind the core
        self.shapes = core | {"l": (n_leaf, HIDDEN), "lb": (n_leaf, 1), "w": (n_leaf, LEAF, HIDDEN), "wb": (n_leaf, LEAF)}
        self.core = sum(int(np.prod(s)) for s in core.values())
        self.dense = self.core + n_leaf * (HIDDEN + 1)
        self.size = sum(int(np.prod(s)) for s in self.shapes.values())
        self.flat = self.start() if flat is None else flat.astype(np.float32)
        self.p = self.views(self.flat)
        self.begin = v.rank.get(END, v.rest)
        #: leaves whose words the last window's gradient is about
        self.touched = np.zeros(0, np.int64)

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            n = int(np.prod(shape))
            out[name] = flat[at : at + n].reshape(shape)
            at += n
        return out

    def start(self) -> np.ndarray:
        """Small weights, and biases that make the outputs the corpus's frequencies."""
        v, rng = self.v, np.random.default_rng(5)
        flat = np.zeros(self.size, np.float32)
        p = self.views(flat)
        p["i"][:] = rng.normal(0, 0.5, p["i"].shape)
        p["u"][:] = rng.normal(0, HIDDEN**-0.5, p["u"].shape)
        for name in ("g", "c", "l"):
            p[name][:] = rng.normal(0, 0.02, p[name].shape)
        p["w"][:] = rng.normal(0, 0.1, p["w"].shape)
        for name, counts in (("gb", v.group_counts), ("cb", v.class_counts), ("lb", v.leaf_counts)):
            bias = np.log(counts + SMOOTHING)
            p[name][:, 0] = bias - bias.max()
        # places in leaves that no word has are never chosen
        biases = np.full(p["wb"].size, -1e4)
        biases[: v.own] = np.log(v.counts / max(1, v.counts.max(initial=1)))
        biases[v.rest] = 0
        p["wb"][:] = biases.reshape(-1, LEAF)
        return flat

    def inputs(self, symbols: np.ndarray) -> np.ndarray:
        """What the symbols of (step, lane) add to the gates, as (step, 3 * HIDDEN, lane)."""
        gx = self.p["i"] @ self.p["w"].reshape(-1, HIDDEN)[symbols].transpose(0, 2, 1)
        gx += self.p["ib"]
        return gx

    def step(self, gx: np.ndarray, h: np.ndarray, gh: np.ndarray | None = None, gates: np.ndarray | None = None) -> np.ndarray:
        """The next state; with gates of (3 * HIDDEN, lane), they are left there, and what the state adds to them in gh."""
        gh = np.matmul(self.p["u"], h, out=gh)
        gates = np.empty_like(gh) if gates is None else gates
        zr, n = gates[: 2 * HIDDEN], gates[2 * HIDDEN :]
        np.add(gx[: 2 * HIDDEN], gh[: 2 * HIDDEN], out=zr)
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        np.multiply(zr[HIDDEN:], gh[2 * HIDDEN :], out=n)
        n += gx[2 * HIDDEN :]
        # the hyperbolic tangent by the exponential
        n *= -2
        np.exp(n, out=n)
        n += 1
        np.divide(2, n, out=n)
        n -= 1
        new = h - n
        new *= zr[:HIDDEN]
        new += n
        return new

    def outputs(self, h: np.ndarray, target: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probability of each target symbol after its state in (HIDDEN, tokens); with grads, also the gradient of
        minus their sum.  Of the words' gradient only leaves of targets are set, to this one."""
        p, v = self.p, self.v
        # tokens of a leaf, and so of a class and of a group, stand side by side; short numbers are sorted by radix
        leaf = target // LEAF
        place = target - leaf * LEAF
        order = np.argsort(leaf.astype(np.uint16) if len(v.leaf_counts) <= 1 << 16 else leaf, kind="stable")
        leaf, place = leaf[order], place[order]
        kind = v.class_by_leaf[leaf]
        h = np.take(h, order, 1)
        value, back = np.zeros(len(target), h.dtype), None if grads is None else np.zeros_like(h)
        numbers = np.arange(len(target))

        def choose(name: str, which: slice | int, rows: slice, inside: np.ndarray) -> None:
            """A softmax over the rows of weights that which names, of the leaf's words if it is a number."""
            weights, bias, mine = p[name][which], p[name + "b"][which], h[:, rows]
            logits = weights @ mine
            logits += bias.reshape(-1, 1)
            logits -= logits.max(0)
            flat, at = logits.reshape(-1), inside * len(inside)
            at += numbers[: len(inside)]
            own = flat[at]
            np.exp(logits, out=logits)
            total = logits.sum(0)
            value[rows] += own - np.log(total)
            if grads is not None:
                # the gradient times the total; products with it are divided instead, as they have fewer rows
                flat[at] -= total
                share = np.reciprocal(total, out=total)
                by_state = weights.T @ logits
                by_state *= share
                back[:, rows] += by_state
                # both are views; which is a slice or a number
                of_weights, of_bias = grads[name][which], grads[name + "b"][which]
                of_weights += logits @ (mine * share).T
                of_bias += (logits @ share).reshape(bias.shape)

        edges = np.searchsorted(kind, np.arange(len(v.class_counts) + 1))
        group_edges = edges[v.group_starts]
        choose("g", slice(None), slice(None), np.repeat(np.arange(len(v.group_counts)), np.diff(group_edges)))
        for name, starts, at, members in (("c", v.group_starts, group_edges, kind), ("l", v.class_starts, edges, leaf)):
            for k in np.flatnonzero((np.diff(at) > 0) & (np.diff(starts) > 1)).tolist():
                rows = slice(at[k], at[k + 1])
                choose(name, slice(starts[k], starts[k + 1]), rows, members[rows] - starts[k])
        # words: leaves of many tokens one by one, those of as many tokens as each other side by side
        first = np.flatnonzero(np.diff(leaf, prepend=-1))
        size = np.diff(np.append(first, len(leaf)))
        for k in np.flatnonzero(size >= MANY).tolist():
            rows = slice(first[k], first[k] + size[k])
            choose("w", int(leaf[first[k]]), rows, place[rows])
        few = np.flatnonzero(size < MANY)
        if len(few):
            few = few[np.argsort(size[few], kind="stable")]
            size, leaves = size[few], leaf[first[few]]
            starts = np.cumsum(size) - size
            token = numbers[: size.sum()] + np.repeat(first[few] - starts, size)
            states, words = np.ascontiguousarray(np.take(h, token, 1).T), p["w"][leaves]
            # runs of leaves of n tokens each, and their tokens
            sizes, begins = np.unique(size, return_index=True)
            runs = [(n, slice(i, j), slice(i_token, j_token)) for n, i, j, i_token, j_token in zip(sizes.tolist(), begins.tolist(), [*begins[1:].tolist(), len(few)], starts[begins].tolist(), [*starts[begins[1:]].tolist(), len(token)], strict=True)]
            by_token = np.repeat(p["wb"][leaves], size, 0)
            for n, which, rows in runs:
                by_token[rows] += (states[rows].reshape(-1, n, HIDDEN) @ words[which].transpose(0, 2, 1)).reshape(-1, LEAF)
            e = np.ascontiguousarray(by_token.T)
            e -= e.max(0)
            flat, at = e.reshape(-1), place[token] * len(token)
            at += numbers[: len(token)]
            own = flat[at]
            np.exp(e, out=e)
            total = e.sum(0)
            value[token] += own - np.log(total)
            if grads is not None:
                flat[at] -= total
                e /= total
                by_token = np.ascontiguousarray(e.T)
                by_state, by_word = np.empty_like(states), np.empty_like(words)
                for n, which, rows in runs:
                    here = by_token[rows].reshape(-1, n, LEAF)
                    np.matmul(here, words[which], out=by_state[rows].reshape(-1, n, HIDDEN))
                    if n == 1:
                        np.einsum("tnk,tnh->tkh", here, states[rows].reshape(-1, n, HIDDEN), out=by_word[which])
                    else:
                        np.matmul(here.transpose(0, 2, 1), states[rows].reshape(-1, n, HIDDEN), out=by_word[which])
                back[:, token] += by_state.T
                grads["w"][leaves] = by_word
                grads["wb"][leaves] = np.add.reduceat(by_token, starts)
        out = np.empty_like(value)
        out[order] = value
        if grads is None:
            return out, None
        dh = np.empty_like(h)
        dh[:, order] = back
        return out, dh

    @staticmethod
    def cleared(h: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """States with those of lanes that begin a document set to zero."""
        if fresh.any():
            h = h.copy()
            h[:, fresh] = 0
        return h

    def train_window(self, inputs: np.ndarray, targets: np.ndarray, fresh: np.ndarray, real: np.ndarray, h: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        """Backpropagation through one window of (step, lane) arrays; returns the state to carry on with.

        fresh marks first tokens of documents, which start from a zero state; real marks tokens that are no padding.
        Of the words' gradient only touched leaves are filled in.
        """
        gradient[: self.dense] = 0
        g = self.views(gradient)
        steps, lanes = inputs.shape
        gx = self.inputs(inputs)
        gates, gh, states, before = (np.empty((steps, n * HIDDEN, lanes), gx.dtype) for n in (3, 3, 1, 1))
        for t in range(steps):
            before[t] = h
            if fresh[t].any():
                before[t, :, fresh[t]] = 0
            h = states[t] = self.step(gx[t], before[t], gh[t], gates[t])
        states = states.transpose(1, 0, 2).reshape(HIDDEN, -1)
        used = real.ravel()
        met = np.zeros(len(self.v.leaf_counts), bool)
        met[targets[real] // LEAF] = met[inputs // LEAF] = True
        self.touched = np.flatnonzero(met)
        g["w"][self.touched], g["wb"][self.touched] = 0, 0
        if used.all():
            _, dh_out = self.outputs(states, targets.ravel(), g)
        else:
            dh_out = np.zeros_like(states)
            _, dh_out[:, used] = self.outputs(np.ascontiguousarray(states[:, used]), targets[real], g)
        # how each gate, before its function, answers to a state's gradient: all but the product with that gradient
        z, r, n = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        dh_out = np.ascontiguousarray(dh_out.reshape(HIDDEN, steps, lanes).transpose(1, 0, 2))
        by_n, rest = n * n, 1 - z
        np.subtract(1, by_n, out=by_n)
        by_n *= rest
        by_z = before - n
        by_z *= z
        by_z *= rest
        by_r = np.subtract(1, r, out=rest)
        by_r *= r
        by_r *= gh[:, 2 * HIDDEN :]
        # from here gx holds the gradient of what it held, and gh that of what the state added
        back = np.zeros((HIDDEN, lanes), gx.dtype)
        u_t = np.ascontiguousarray(self.p["u"].T)
        for t in range(steps - 1, -1, -1):
            back += dh_out[t]
            dn = np.multiply(by_n[t], back, out=gx[t, 2 * HIDDEN :])
            np.multiply(by_z[t], back, out=gh[t, :HIDDEN])
            np.multiply(by_r[t], dn, out=gh[t, HIDDEN : 2 * HIDDEN])
            np.multiply(dn, r[t], out=gh[t, 2 * HIDDEN :])
            back *= z[t]
            back += u_t @ gh[t]
            if fresh[t].any():
                back[:, fresh[t]] = 0
        gx[:, : 2 * HIDDEN] = gh[:, : 2 * HIDDEN]
        g["u"] += (gh @ before.transpose(0, 2, 1)).sum(0)
        vectors = self.p["w"].reshape(-1, HIDDEN)[inputs]
        g["i"] += (gx @ vectors).sum(0)
        g["ib"] += gx.sum((0, 2))[:, None]
        by_input = (self.p["i"].T @ gx).transpose(0, 2, 1).reshape(-1, HIDDEN)
        # a symbol's inputs side by side
        symbols = inputs.ravel()
        order = np.argsort(symbols)
        symbols = symbols[order]
        first = np.flatnonzero(np.diff(symbols, prepend=-1))
        g["w"].reshape(-1, HIDDEN)[symbols[first]] += np.add.reduceat(by_input[order], first)
        return h

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural-log probability that the network gives each sequence of symbols, from its start to its end.

        Sequences stand one after another in lanes of near equal lengths; the state runs through all of a sequence.
        """
        out = np.zeros(len(texts))
        lanes: list[list[int]] = []
        free: list[tuple[int, int]] = []
        for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
            if len(lanes) < WIDE:
                heappush(free, (len(texts[i]), len(lanes)))
                lanes.append([i])
            else:
                length, lane = heappop(free)
                lanes[lane].append(i)
                heappush(free, (length + len(texts[i]), lane))
        free.sort(reverse=True)
        size = np.array([n for n, _ in free])
        lanes = [lanes[lane] for _, lane in free]
        whole = [np.concatenate([texts[i] for i in lane]) for lane in lanes]
        owner = [np.repeat(np.array(lane, np.int32), [len(texts[i]) for i in lane]) for lane in lanes]
        h = np.zeros((HIDDEN, len(lanes)), np.float32)
        last, before = np.full(len(lanes), self.begin), np.full(len(lanes), -1)
        start, longest = 0, int(size.max(initial=0))
        while start < longest:
            live = int((size > start).sum())
            h, last, before = h[:, :live], last[:live], before[:live]
            # few lanes, those of the longest documents, go in longer windows, so that one looks at as many tokens
            length = min(STRETCH * WINDOW * max(1, WIDE // live), longest - start)
            targets, owners = np.zeros((length, live), np.int64), np.full((length, live), -1)
            for lane in range(live):
                part = whole[lane][start : start + length]
                targets[: len(part), lane] = part
                owners[: len(part), lane] = owner[lane][start : start + length]
            start += length
            fresh = owners != np.vstack([before, owners[:-1]])
            gx = self.inputs(np.where(fresh, self.begin, np.vstack([last, targets[:-1]])))
            states = np.empty((HIDDEN, length, live), np.float32)
            for t in range(length):
                h = states[:, t] = self.step(gx[t], self.cleared(h, fresh[t]))
            states = states.reshape(HIDDEN, -1)
            last, before = targets[-1], owners[-1]
            used = owners.ravel() >= 0
            if used.all():
                logp, _ = self.outputs(states, targets.ravel())
            else:
                logp, _ = self.outputs(np.ascontiguousarray(states[:, used]), targets.ravel()[used])
            out += np.bincount(owners.ravel()[used], logp, len(texts))
        return out


class Trainer:
    """One replica: truncated backpropagation with Adam, and for vectors of words and leaves, of which a window is about
    some, Adagrad.

    Each of LANES lanes holds whole documents, one after another; the next goes to the lane with least to do.  Windows
    run through all lanes side by side, and every lane's state is carried from one to the next.
    """

    def __init__(self, network: Network):
        self.network = network
        self.gradient = np.zeros(network.size, np.float32)
        self.views = network.views(self.gradient)
        self.mean, self.square = (np.zeros(network.core, np.float32) for _ in range(2))
        #: mean squares of gradients so far, by leaf and by word, of vector and bias; a first one, so that small ones move little
        self.leaves = np.ones((2, len(network.v.leaf_counts)), np.float32)
        self.words = np.ones((2, len(network.v.leaf_counts), LEAF), np.float32)
        #: how many targets each leaf has had
        self.met = np.zeros(len(network.v.leaf_counts), np.int64)
        self.steps = self.tokens = 0
        #: documents that wait, and whether they have begun
        self.lanes: list[list[tuple[np.ndarray, bool]]] = [[] for _ in range(LANES)]
        self.free = [(0, lane) for lane in range(LANES)]
        self.done = 0
        self.h = np.zeros((HIDDEN, LANES), np.float32)
        self.last = np.full(LANES, network.begin)

    def add(self, symbols: np.ndarray) -> None:
        length, lane = heappop(self.free)
        self.lanes[lane].append((symbols, False))
        heappush(self.free, (length + len(symbols), lane))
        if self.free[0][0] - self.done >= AHEAD:
            self.run(AHEAD)

    def finish(self) -> None:
        """Train on what is left in the lanes."""
        left = max(n for n, _ in self.free) - self.done
        if left > 0:
            self.run(left)

    def run(self, steps: int) -> None:
        """The next steps of all lanes; lanes that end before take no part in windows that they don't reach."""
        network = self.network
        targets, fresh = np.zeros((LANES, steps), np.int64), np.zeros((LANES, steps), bool)
        size = np.zeros(LANES, np.int64)
        for lane, documents in enumerate(self.lanes):
            at = 0
            while documents and at < steps:
                text, begun = documents[0]
                n = min(len(text), steps - at)
                targets[lane, at : at + n] = text[:n]
                fresh[lane, at] = not begun
                documents[:1] = [(text[n:], True)] if n < len(text) else []
                at += n
            size[lane] = at
        inputs = np.concatenate([self.last[:, None], targets[:, :-1]], 1)
        inputs[fresh] = network.begin
        full = np.arange(LANES)[size > 0]
        self.last[full] = targets[full, size[full] - 1]
        start = 0
        while (live := np.flatnonzero(size > start)).size:
            # few lanes, those of the longest documents, go in longer windows
            length = WINDOW * min(8, LANES // len(live))
            part = slice(start, start + length)
            start += length
            real = (np.arange(steps)[part] < size[live, None]).T
            self.h[:, live] = network.train_window(inputs[live, part].T, targets[live, part].T, fresh[live, part].T, real, self.h[:, live], self.gradient)
            self.met += np.bincount(targets[live, part].T[real] // LEAF, minlength=len(self.met))
            self.update(int(real.sum()))
        self.done += steps

    def update(self, tokens: int) -> None:
        self.steps += 1
        self.tokens += tokens
        network, views, rate = self.network, self.views, np.float32(WORD_RATE)
        touched = network.touched
        for names, squares, which in ((("l", "lb"), self.leaves, slice(None)), (("w", "wb"), self.words, touched)):
            g = views[names[0]][which]
            n = np.einsum("...h,...h->...", g, g)
            n /= HIDDEN
            n += squares[0][which]
            squares[0][which] = n
            g *= (rate / np.sqrt(n))[..., None]
            network.p[names[0]][which] -= g
            g = views[names[1]][which]
            n = squares[1][which] + (g * g).reshape(n.shape)
            squares[1][which] = n
            g *= (rate / np.sqrt(n)).reshape(g.shape)
            network.p[names[1]][which] -= g
        g = self.gradient[: network.core]
        g /= tokens
        np.clip(g, -0.5, 0.5, out=g)
        self.mean += 0.1 * (g - self.mean)
        self.square += 0.01 * (g * g - self.square)
        # a window of few tokens moves the weights less
        pace = LEARNING_RATE * min(1.0, tokens / (WINDOW * LANES)) * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        network.flat[: network.core] -= np.float32(pace) * self.mean / (np.sqrt(self.square) + np.float32(1e-7))


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Batches put together until their texts have size bytes."""
    waiting, held = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        held += batch.column("text").nbytes
        if held >= size:
            yield pa.Table.from_batches(waiting)
            waiting, held = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def tokens_of(texts: pa.ChunkedArray) -> tuple[pa.ChunkedArray, np.ndarray]:
    """Tokens of all texts, one text after another, as binary: words with A-Z in lower case, and END; and how many each text
    has.  Null is an empty text."""
    # Arrow's white space is that which separates words; at the end of a text it leaves an empty word, which is END
    texts = pa.chunked_array([t.view(pa.string()) for t in texts.chunks], pa.string())
    texts = pc.binary_join_element_wise(pc.ascii_lower(texts.fill_null("")), " ", "")
    words = pc.ascii_split_whitespace(pc.ascii_ltrim_whitespace(texts))
    return pc.list_flatten(words).cast(pa.binary()), pc.list_value_length(words).to_numpy().astype(np.int64)


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts: words with A-Z in lower case, and one END for each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, COUNTED):
            counts = tokens_of(part["text"])[0].value_counts()
            yield pa.RecordBatch.from_arrays([counts.field(0), counts.field(1)], ["word", "n"])

    return in_batches(texts.select("text"), work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def head_of(counts: DataFrame) -> Vocabulary:
    """The HEAD most frequent words, which is all that is collected, and the totals."""
    totals = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()
    head = counts.orderBy(F.col("n").desc(), "word").limit(HEAD).toArrow()
    return Vocabulary(head["word"].to_pylist(), head["n"].to_numpy().astype(np.int64), totals["tokens"] or 0, totals["distinct"])


def parts_of(trainer: Trainer) -> Iterator[pa.RecordBatch]:
    """A replica as (piece, weights, parameters): piece -1 is all but the words, weighted by tokens; the others are PIECE
    leaves of words and biases, weighted leaf by leaf by the targets met, and left out where there are none."""
    p, dense = trainer.network.p, trainer.network.dense

    def row(piece: int, weights: np.ndarray, parameters: np.ndarray) -> pa.RecordBatch:
        values = [pa.array([piece], pa.int32()), pa.array([weights.astype(np.float64).tobytes()], pa.binary()), pa.array([parameters.astype(np.float32).tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(values, ["piece", "weights", "parameters"])

    yield row(-1, np.array([trainer.tokens]), trainer.network.flat[:dense])
    for at in range(0, len(trainer.met), PIECE):
        which = slice(at, at + PIECE)
        if trainer.met[which].any():
            words = np.concatenate([p["w"][which].reshape(-1, LEAF * HIDDEN), p["wb"][which]], 1)
            yield row(at // PIECE, trainer.met[which], words)


def averaged(replicas: DataFrame, network: Network) -> bool:
    """Put the weighted averages of replicas' (piece, weights, parameters) into the network; False if there are none.

    A task adds up its pieces as they come, so that it holds one sum for each, and only averages are collected.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for piece, weights, parameters in zip(*(batch.column(c).to_pylist() for c in ("piece", "weights", "parameters")), strict=True):
                w = np.frombuffer(weights)
                x = np.frombuffer(parameters, np.float32).reshape(len(w), -1) * w[:, None]
                if piece in sums:
                    sums[piece][0] += w
                    sums[piece][1] += x
                else:
                    sums[piece] = [w.copy(), x]
        for piece, (w, x) in sums.items():
            x /= np.maximum(w, 1)[:, None]
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([w.tobytes()], pa.binary()), pa.array([x.astype(np.float32).tobytes()], pa.binary())], ["piece", "weights", "parameters"])

    pieces = 1 + -(-len(network.v.leaf_counts) // PIECE)
    rows = in_batches(replicas.repartition(min(pieces, 16), "piece"), work, "piece int, weights binary, parameters binary").collect()
    for piece, weights, parameters in rows:
        w = np.frombuffer(weights)
        x = np.frombuffer(parameters, np.float32).reshape(len(w), -1)
        if piece < 0:
            network.flat[: network.dense] = x[0]
        else:
            met = np.flatnonzero(w)
            network.p["w"][piece * PIECE + met] = x[met, : LEAF * HIDDEN].reshape(-1, LEAF, HIDDEN)
            network.p["wb"][piece * PIECE + met] = x[met, LEAF * HIDDEN :]
    return bool(rows)


def train(training: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """The network's parameters after all rounds over (doc_id, text)."""
    spark = training.sparkSession
    shared = broadcast_words(spark, vocabulary)
    network = Network(vocabulary)
    begin = 0
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(100))
    for end in ROUNDS:
        start_at = spark.sparkContext.broadcast(network.flat)

        def work(batches: Iterator[pa.RecordBatch], start_at=start_at) -> Iterator[pa.RecordBatch]:
            v = worker_vocabulary(shared)
            trainer = Trainer(Network(v, start_at.value.copy()))
            for part in gathered(batches, READ):
                ranks, sizes, _ = v.read_all(part["text"])
                for symbols in np.split(v.symbols(ranks), np.cumsum(sizes)[:-1]):
                    trainer.add(symbols)
            trainer.finish()
            if trainer.tokens:
                yield from parts_of(trainer)

        part = training.filter((turn >= begin) & (turn < end)).select("text")
        # each replica has parameters to pass on, so small partitions share one
        wanted = -(-vocabulary.tokens * (end - begin) // (100 * REPLICA))
        part = part.coalesce(max(1, min(part.rdd.getNumPartitions(), wanted)))
        averaged(in_batches(part, work, "piece int, weights binary, parameters binary"), network)
        start_at.unpersist()
        begin = end
    return network.flat


def broadcast_words(spark: SparkSession, v: Vocabulary) -> Broadcast:
    """The vocabulary under a name of its own, by which workers keep it."""
    return spark.sparkContext.broadcast((uuid4().hex, v.words, v.counts, v.tokens, v.distinct))


def worker_vocabulary(shared: Broadcast) -> Vocabulary:
    """One per Python worker."""
    name, *values = shared.value
    return held(f"vocabulary {name}", lambda: Vocabulary(*values))


def score_texts(docs: DataFrame, counts: DataFrame, vocabulary: Vocabulary, flat: np.ndarray, parts: int = 10, held_out: int = 0) -> DataFrame:
    """Scores of all docs in one pass: what the head of the vocabulary and the network give is summed where the text is
    read; only words beyond the head are shuffled, to meet their counts, and their sums return to their document."""
    spark = docs.sparkSession
    shared = broadcast_words(spark, vocabulary)
    weights = spark.sparkContext.broadcast(flat)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = worker_vocabulary(shared)
        network = Network(v, weights.value)
        place = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []
        size = 0

        names = ["place", "word", "times", "doc_id", "held_out", "n_tokens", "known", "base", "model"]
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

        def own() -> pa.RecordBatch:
            """The documents' own rows: their words begin with a space, as no word does."""
            natural = network.score([w[-1] for w in waiting])
            rows = [(at, b" %d" % at, 0, doc_id, held, len(symbols), known, base, logp / np.log(10)) for (at, doc_id, held, known, base, symbols), logp in zip(waiting, natural, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for part in gathered(batches, READ):
            ranks, sizes, beyond = v.read_all(part["text"])
            ends, inside = np.cumsum(sizes), ranks >= 0
            starts = ends - sizes
            known = np.add.reduceat(inside.astype(np.int64), starts)
            # the last of base stands for no word of the head
            base = np.add.reduceat(np.append(v.base, 0.0)[ranks], starts)
            # each document's words beyond the head and how often it has them
            words = beyond.combine_chunks().dictionary_encode()
            key = np.repeat(np.arange(len(sizes)), sizes - known) << 32 | words.indices.to_numpy()
            key, times = np.unique(key, return_counts=True)
            columns = [pa.array(place + (key >> 32)), words.dictionary.take(pa.array(key & 0xFFFFFFFF)), pa.array(times, kinds[2])]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.nulls(len(key), k) for k in kinds[3:]]], names)
            symbols = np.split(v.symbols(ranks), ends[:-1])
            for row in zip(range(place, place + len(sizes)), part["doc_id"].to_pylist(), part["held_out"].to_pylist(), known.tolist(), base.tolist(), symbols, strict=True):
                waiting.append(row)
                size += len(row[-1])
                if size >= SCORED:
                    yield own()
                    waiting, size = [], 0
            place += len(sizes)
        if waiting:
            yield own()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(F.col("doc_id"), parts) == held_out).alias("held_out"), "text")
    rows = in_batches(source, work, "place long, word binary, times long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double")
    met = rows.join(counts.select("word", "n"), "word", "left")
    seen = F.coalesce("n", F.lit(0))
    per_doc = met.groupBy("place").agg(
        *[F.max(c).alias(c) for c in ("doc_id", "held_out", "n_tokens", "known", "base", "model")],
        F.sum("times").alias("beyond"),
        F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("known_beyond"),
        F.sum(F.col("times") * F.log10(seen + SMOOTHING)).alias("logs"),
    )
    return per_doc.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.col("known_beyond")).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("logs") - F.col("beyond") * vocabulary.base_all).alias("base_score"),
        (F.col("model") + F.col("logs") - F.col("beyond") * vocabulary.rest_all).alias("score"),
    )


def score_documents(docs: DataFrame, parts: int = 10, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of (doc_id, text).

    Rows whose crc32(doc_id) modulo parts is held_out are scored but not learnt from; null ids are learnt from.  A null
    text is an empty one: a single END.  Repeated rows count and are scored each.  Without training rows every token
    falls to smoothing alone.
    """
    training = docs.select("doc_id", "text").filter(remainder(F.col("doc_id"), parts) != held_out)
    counts = written(count_words(training), "word-counts")
    vocabulary = head_of(counts)
    return score_texts(docs, counts, vocabulary, train(training, vocabulary), parts, held_out)
