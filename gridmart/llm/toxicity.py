"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text has a window of ``WINDOW`` words at each of its words that has so many from there on (stride 1); a shorter text is one
window. So what stands within a window's length is seen together, wherever in the text it is. Each word has a word input, how much likelier the word is in toxic texts, and character inputs, the same for its runs of four,
six and eight bytes, of which the strongest and the mean count; so a word that was never seen is judged by its stem. Two
recurrent layers read a window from either end, attention weighs the steps, and a document's score is that of its
highest window.

The counts behind the odds of words and runs are those of the labelled rows that are not held out, one text for each id, of
which about ``MAX_COUNTED`` are drawn where there are more. Their keys go to the tasks that read the texts, which count in
buckets of a fixed number, so no text is shuffled. The network learns from a sample of these rows that is bounded by
``MAX_TOXIC``, ``MAX_OTHER`` and ``MAX_CHARS``, in one task. The inputs of a training text come from the counts of the
others, so that its own label is not among them. In each round the highest window of each text is learnt, with its text's label. The score is calibrated on
the sample's highest windows at the end. Scoring runs on all windows of all texts in the tasks, with a model of fixed size.

Null and empty texts have one empty window. Labels that are null, and rows without an id, are not used. Where the sample
lacks one of the two labels every score is the share of toxic labels, or zero without labels.
"""

from __future__ import annotations

import os
import pickle
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.llm.tables import in_tasks, written
from gridmart.llm.words import Words, ranges, span_hashes, words_of

MAX_COUNTED, MAX_TOXIC, MAX_OTHER, MAX_CHARS = 500_000, 2000, 4000, 10_000
WINDOW = 16
UNITS, ATTENTION, INPUTS = 6, 8, 6
WORD_BITS, GRAM_BITS, GRAMS = 17, 18, (4, 6, 8)
ROUNDS, BATCH, RATE = 6, 256, 0.02
THRESHOLD = 0.7
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
#: Distinct values for the bytes of a run of characters; a run is told by their polynomial.
_LETTERS = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64)


@dataclass
class Vocabulary:
    """The distinct words of a slice: buckets of the words and of their runs of characters."""

    word: np.ndarray
    grams: list[np.ndarray]
    begin: list[np.ndarray]  # per length, where each word's runs begin
    inverse: np.ndarray  # of all words of the slice


def vocabulary(words: Words) -> Vocabulary:
    hashes = span_hashes(words.data, words.starts, words.ends, lower=True)
    keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    starts, lengths = words.starts[first], words.ends[first] - words.starts[first]
    # Every word with a blank before and after it, one after the other.
    begin = np.concatenate(([0], np.cumsum(lengths + 2)))
    total = int(begin[-1])
    letters = np.full(total, 32, np.uint8)
    inner = np.ones(total, bool)
    inner[begin[:-1]] = False
    inner[begin[1:] - 1] = False
    at = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(int(lengths.sum()))
    letters[inner] = _FOLD[words.data[at]]
    values = _LETTERS[letters]
    grams, bounds = [], []
    for n in GRAMS:
        # A word that is shorter has one run, itself.
        count = np.maximum(lengths + 3 - n, 1)
        edge = np.concatenate(([0], np.cumsum(count)))
        place = np.arange(int(edge[-1])) + np.repeat(begin[:-1] - edge[:-1], count)
        size = np.repeat(np.minimum(lengths + 2, n), count)
        found = ranges(values, place, size)
        grams.append((found >> np.uint64(64 - GRAM_BITS)).astype(np.int32))
        bounds.append(edge[:-1])
    return Vocabulary((keys >> np.uint64(64 - WORD_BITS)).astype(np.int32), grams, bounds, inverse.astype(np.int32))


def odds(toxic: np.ndarray, other: np.ndarray, n_toxic: float, n_other: float) -> np.ndarray:
    """How much likelier something is in toxic texts, as a logarithm, smaller for what is rare."""
    ratio = np.log((toxic + 0.5) / (n_toxic + 1.0)) - np.log((other + 0.5) / (n_other + 1.0))
    seen = toxic + other
    return (ratio * (seen / (seen + 3.0))).astype(np.float32)


def inputs(words: Vocabulary, word_odds: np.ndarray, gram_odds: list[np.ndarray]) -> np.ndarray:
    """The inputs of each distinct word; ``word_odds`` by word, ``gram_odds`` by run of characters."""
    out = np.ones((len(words.word), INPUTS), np.float32)
    if not len(words.word):
        return out
    out[:, 0] = word_odds
    for j, (values, begin) in enumerate(zip(gram_odds, words.begin, strict=True)):
        out[:, 1 + j] = np.maximum.reduceat(values, begin)
        if j == 1:
            out[:, 4] = np.add.reduceat(values, begin) / np.diff(np.append(begin, len(values)))
    out[:, :5] /= 3.0
    return out


def cut(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of texts with so many words: text, first word (of all words) and number of words."""
    per_text = np.maximum(1, counts - (WINDOW - 1))
    text = np.repeat(np.arange(len(counts), dtype=np.int32), per_text)
    first = np.arange(len(text), dtype=np.int32)
    first += np.repeat((np.cumsum(counts) - counts - np.cumsum(per_text) + per_text).astype(np.int32), per_text)
    return text, first, np.minimum(WINDOW, counts).astype(np.int8)[text]


class Network:
    """Two gated recurrent layers of ``UNITS`` units each, attention over the steps, one output."""

    def __init__(self, seed: int = 11):
        r = np.random.Generator(np.random.PCG64(seed))
        shape = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p[f"x{d}"], self.p[f"h{d}"] = shape(INPUTS, 3 * UNITS), shape(UNITS, 3 * UNITS)
            self.p[f"c{d}"] = np.zeros(3 * UNITS, np.float32)
        self.p |= {"a": shape(2 * UNITS, ATTENTION), "ab": np.zeros(ATTENTION, np.float32), "v": shape(ATTENTION)}
        self.p |= {"o": shape(2 * UNITS), "ob": np.zeros(1, np.float32)}

    def layer(self, d: str, projected: np.ndarray, place: np.ndarray, alive: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States of a layer, ``(steps, windows, units)``; ``place`` has the row of ``projected`` of each step."""
        steps, n = place.shape
        h = np.zeros((n, UNITS), np.float32)
        out = np.empty((steps, n, UNITS), np.float32)
        weights = self.p[f"h{d}"]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            x = projected[place[t]]
            own = h @ weights
            gates = 1.0 / (1.0 + np.exp(-(x[:, : 2 * UNITS] + own[:, : 2 * UNITS])))
            r, z = gates[:, :UNITS], gates[:, UNITS:]
            new = np.tanh(x[:, 2 * UNITS :] + r * own[:, 2 * UNITS :])
            after = new + z * (h - new)
            after = np.where(alive[t][:, None], after, h)
            if keep is not None:
                keep.append((t, h, r, z, new, own[:, 2 * UNITS :]))
            h = after
            out[t] = h
        return out

    def forward(self, features: np.ndarray, place: np.ndarray, alive: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """The output of each window before the logistic function."""
        states = []
        for d in "fb":
            log: list | None = None if keep is None else keep.setdefault(d, [])
            states.append(self.layer(d, features @ self.p[f"x{d}"] + self.p[f"c{d}"], place, alive, log))
        both = np.concatenate(states, axis=2)
        u = np.tanh(both @ self.p["a"] + self.p["ab"])
        score = np.where(alive, u @ self.p["v"], -1e9)
        weight = np.exp(score - score.max(axis=0))
        weight *= alive
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = (weight[:, :, None] * both).sum(axis=0)
        if keep is not None:
            keep |= {"both": both, "u": u, "weight": weight, "pooled": pooled}
        return pooled @ self.p["o"] + self.p["ob"][0]

    def sliding(self, features: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The output of the window at each of ``words`` that has ``WINDOW`` words from there on, as :meth:`forward`.

        Every word is projected once, a step reads a slice and writes in place. Units come first; states are kept plus one,
        so that ``tanh(x) + 1 = 2 / (1 + exp(-2x))`` is one, and each layer has a last unit of one for what is constant.
        """
        n = len(words) - WINDOW + 1
        both = np.ones((WINDOW, 2, UNITS + 1, n), np.float32)
        own, spare, far = np.empty((3 * UNITS, n), np.float32), np.empty((UNITS, n), np.float32), np.empty((UNITS, n), np.float32)
        scale = np.repeat(np.array([-1, -1, -2], np.float32), UNITS)
        shifted = lambda w: np.ascontiguousarray(np.hstack((w, -w.sum(axis=1, keepdims=True))))
        told = np.vstack((self.p["a"].T * np.float32(-2), self.p["o"][None, :]))
        told = np.hstack((shifted(told[:, :UNITS]), shifted(told[:, UNITS:])))
        told[:-1, -1] -= 2 * self.p["ab"]
        score, worth = np.empty((WINDOW, n), np.float32), np.empty((WINDOW, n), np.float32)
        with np.errstate(over="ignore"):  # the inverse of infinity is zero
            for d in range(2):
                projected = np.ascontiguousarray(((features @ self.p["x" + "fb"[d]] + self.p["c" + "fb"[d]]) * scale)[words].T)
                weights = shifted((self.p["h" + "fb"[d]] * scale).T)
                h = np.ones((UNITS + 1, n), np.float32)
                for t in range(WINDOW) if d == 0 else range(WINDOW - 1, -1, -1):
                    x = projected[:, t : t + n]
                    np.matmul(weights, h, out=own)
                    gates = own[: 2 * UNITS]
                    gates += x[: 2 * UNITS]
                    np.exp(gates, out=gates)
                    gates += 1
                    np.reciprocal(gates, out=gates)
                    np.multiply(gates[:UNITS], own[2 * UNITS :], out=spare)
                    spare += x[2 * UNITS :]
                    np.exp(spare, out=spare)
                    spare += 1
                    np.divide(2, spare, out=spare)
                    np.subtract(h[:UNITS], spare, out=far)
                    far *= gates[UNITS:]
                    h = both[t, d]
                    np.add(spare, far, out=h[:UNITS])
            for t in range(WINDOW):
                found = told @ both[t].reshape(2 * UNITS + 2, n)
                worth[t] = found[-1]
                u = found[:-1]
                np.exp(u, out=u)
                u += 1
                np.divide(2, u, out=u)
                np.matmul(self.p["v"], u, out=score[t])
        score -= score.max(axis=0)
        np.exp(score, out=score)
        return (score * worth).sum(axis=0) / score.sum(axis=0) + self.p["ob"][0]

    def gradients(self, features: np.ndarray, place: np.ndarray, alive: np.ndarray, target: np.ndarray, importance: np.ndarray) -> dict[str, np.ndarray]:
        keep: dict = {}
        logit = self.forward(features, place, alive, keep)
        slope = ((1 / (1 + np.exp(-logit)) - target) * importance / len(target)).astype(np.float32)
        g = {"o": keep["pooled"].T @ slope, "ob": np.array([slope.sum()])}
        pooled = slope[:, None] * self.p["o"]
        both = keep["weight"][:, :, None] * pooled
        wanted = (keep["both"] * pooled).sum(axis=2)
        score = keep["weight"] * (wanted - (keep["weight"] * wanted).sum(axis=0))
        g["v"] = np.einsum("tna,tn->a", keep["u"], score)
        u = score[:, :, None] * self.p["v"] * (1 - keep["u"] ** 2)
        g["a"] = np.einsum("tns,tna->sa", keep["both"], u)
        g["ab"] = u.sum(axis=(0, 1))
        both += u @ self.p["a"].T
        for d, part in (("f", both[:, :, :UNITS]), ("b", both[:, :, UNITS:])):
            weights = self.p[f"h{d}"]
            gx, gh, gc = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(weights), np.zeros_like(self.p[f"c{d}"])
            back = np.zeros((len(target), UNITS), np.float32)
            for t, h, r, z, new, own in reversed(keep[d]):
                back = back + part[t]
                live = alive[t][:, None]
                up = np.where(live, back, 0)
                d_new = up * (1 - z) * (1 - new**2)
                d_z = up * (h - new) * z * (1 - z)
                d_r = d_new * own * r * (1 - r)
                d_own = np.concatenate((d_r, d_z, d_new * r), axis=1)
                d_x = np.concatenate((d_r, d_z, d_new), axis=1)
                gx += features[place[t]].T @ d_x
                gc += d_x.sum(axis=0)
                gh += h.T @ d_own
                back = np.where(live, up * z + d_own @ weights.T, back)
            g |= {f"x{d}": gx, f"h{d}": gh, f"c{d}": gc}
        return g


@dataclass
class Model:
    network: Network
    word_odds: np.ndarray
    gram_odds: list[np.ndarray]
    slope: float
    shift: float
    constant: float | None = None

    def scores(self, words: Words) -> np.ndarray:
        """The score of each text of a slice."""
        counts = words.counts
        if self.constant is not None:
            return np.full(len(counts), self.constant)
        own = vocabulary(words)
        features = inputs(own, self.word_odds[own.word], [o[g] for o, g in zip(self.gram_odds, own.grams, strict=True)])
        text, logit = highest(self.network, features, own.inverse, counts)
        top = np.full(len(counts), -np.inf)
        np.maximum.at(top, text, logit)
        return 1 / (1 + np.exp(-np.clip(self.slope * top + self.shift, -60, 60)))


def highest(
    network: Network, features: np.ndarray, inverse: np.ndarray, counts: np.ndarray, at_once: int = 16_384, threads: int = 1, windows: tuple | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Text and output of every window; ``windows`` are those of :func:`cut`, if they are known."""
    text, first, length = windows or cut(counts)
    logit = np.empty(len(text), np.float32)
    whole = length == WINDOW
    short = np.flatnonzero(~whole)
    for lo in range(0, len(short), at_once):
        some = short[lo : lo + at_once]
        place, alive = steps(np.append(inverse, len(features)), first[some], length[some])
        logit[some] = network.forward(*_narrow(features, place, alive), alive)
    # The words of the longer texts one after the other: windows over the end of a text are left out.
    long = np.repeat(counts >= WINDOW, counts)
    words = inverse[long]
    inside = np.zeros(len(inverse), bool)
    inside[first[whole]] = True
    inside = inside[long]
    found = np.empty(len(words), np.float32)

    def run(lo: int) -> None:
        own = words[lo : lo + at_once + WINDOW - 1]
        a, b = int(own.min()), int(own.max()) + 1
        if b - a > len(own):
            some, own = np.unique(own, return_inverse=True)
            own_features = features[some]
        else:
            own, own_features = own - a, features[a:b]
        found[lo : lo + len(own) - WINDOW + 1] = network.sliding(own_features, own)

    parts = range(0, len(words) - WINDOW + 1, at_once)
    if threads > 1:
        with ThreadPoolExecutor(threads) as pool:
            list(pool.map(run, parts))
    else:
        for lo in parts:
            run(lo)
    logit[whole] = found[inside]
    return text, logit


def _narrow(features: np.ndarray, place: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows from the first to the last that some window has, and a row for none."""
    none = np.zeros((1, INPUTS), np.float32)
    used = place[alive]
    if not len(used):
        return none, np.zeros_like(place)
    a, b = int(used.min()), int(used.max()) + 1
    return np.vstack((features[a:b], none)), np.where(alive, place - a, b - a)


def steps(words: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of each step and window, and whether a window is that long; the last of ``words`` stands for none."""
    longest = max(1, int(length.max(initial=1)))
    at = first[None, :] + np.arange(longest)[:, None]
    alive = np.arange(longest)[:, None] < length[None, :]
    return words[np.where(alive, at, len(words) - 1)], alive


def runs_of(own: Vocabulary) -> list[np.ndarray]:
    """How many runs each word has, per length."""
    return [np.diff(np.append(begin, len(grams))) for begin, grams in zip(own.begin, own.grams, strict=True)]


def kinds(own: Vocabulary, runs: list[np.ndarray], some: np.ndarray) -> list[np.ndarray]:
    """Buckets of some words and of their runs."""
    out = [own.word[some]]
    for grams, begin, lengths in zip(own.grams, own.begin, runs, strict=True):
        length = lengths[some]
        out.append(grams[np.repeat(begin[some] - np.cumsum(length) + length, length) + np.arange(int(length.sum()))])
    return out


class Counts:
    """How many words of texts of each label fall into every bucket of words and of runs; a text's repeated words count once.

    ``words`` are the totals by label. Texts have weights, so that copies of one can add up to one.
    """

    sizes = (1 << WORD_BITS, *(1 << GRAM_BITS for _ in GRAMS))

    def __init__(self):
        self.kinds = [np.zeros((2, n)) for n in self.sizes]
        self.words = np.zeros(2)

    def add(self, words: Words, toxic: np.ndarray, weight: np.ndarray | None = None) -> None:
        """Count a slice; ``toxic`` and ``weight`` are those of the whole column."""
        own = vocabulary(words)
        n = len(own.word)
        if not n:
            return
        text, word = np.divmod(np.unique(np.repeat(np.arange(len(words.counts)), words.counts) * n + own.inverse), n)
        label = toxic[words.first + text].astype(np.int64)
        in_texts = np.bincount(label * n + word, None if weight is None else weight[words.first + text], 2 * n).reshape(2, n)
        self.words += in_texts.sum(axis=1)
        of_run = [np.repeat(np.arange(n), lengths) for lengths in runs_of(own)]
        for kind, cells, of in zip(self.kinds, (own.word, *own.grams), (np.arange(n), *of_run), strict=True):
            for y in (0, 1):
                if in_texts[y].any():
                    kind[y] += np.bincount(cells, in_texts[y][of], kind.shape[1])

    def cells(self) -> tuple[np.ndarray, ...]:
        """Number, other and toxic words of each bucket that has some, and as a last number the words in all."""
        other, toxic = (np.concatenate([*(c[y] for c in self.kinds), self.words[y : y + 1]]) for y in (0, 1))
        at = np.flatnonzero(other + toxic)
        return at, other[at], toxic[at]

    @classmethod
    def of_cells(cls, at: np.ndarray, other: np.ndarray, toxic: np.ndarray) -> Counts:
        out, edges = cls(), np.cumsum((0, *cls.sizes))
        whole = np.zeros((2, int(edges[-1]) + 1))
        whole[0, at], whole[1, at] = other, toxic
        out.kinds = [whole[:, lo:hi] for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
        out.words = whole[:, -1]
        return out


def fit(texts: list[str | None] | pa.Array, toxic: np.ndarray, counted: Counts | None = None) -> Model:
    """A model of labelled texts; the same for the same texts in the same order.

    ``counted`` are the counts of all labelled texts, with these among them; without, these are all.
    """
    toxic = np.asarray(toxic, np.float32)
    n_toxic, n_other = float(toxic.sum()), float(len(toxic) - toxic.sum())
    if not n_toxic or not n_other:
        return Model(Network(), np.zeros(0), [], 1.0, 0.0, n_toxic / len(toxic) if len(toxic) else 0.0)
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    if counted is None:
        counted = Counts()
        for words in words_of(column):
            counted.add(words, toxic)
    counts, (all_other, all_toxic) = counted.kinds, counted.words
    # Inputs of each training text, without itself; one slice is held at a time.
    features, places, lengths, base = [], [], np.zeros(len(toxic), np.int64), 0
    for words in words_of(column):
        own = vocabulary(words)
        runs = runs_of(own)
        for i in range(len(words.counts)):
            whole = own.inverse[words.bounds[i] : words.bounds[i + 1]]
            some = np.unique(whole)
            y = int(toxic[words.first + i])
            values = []
            for c, k in zip(counts, kinds(own, runs, some), strict=True):
                _, place, times = np.unique(k, return_inverse=True, return_counts=True)
                mine = times[place]
                values.append(odds(c[1, k] - y * mine, c[0, k] - (1 - y) * mine, all_toxic - y * len(some), all_other - (1 - y) * len(some)))
            begins = [np.cumsum(length[some]) - length[some] for length in runs]
            features.append(inputs(Vocabulary(own.word[some], [], begins, some), values[0], values[1:]))
            places.append((np.searchsorted(some, whole) + base).astype(np.int32))
            lengths[words.first + i] = len(whole)
            base += len(some)
    table = np.vstack([*features, np.zeros((1, INPUTS), np.float32)])
    features.clear()
    inverse = np.concatenate(places)
    words_at = np.append(inverse, len(table) - 1)
    network = Network()
    text, first, length = windows = cut(lengths)
    begin = np.searchsorted(text, np.arange(len(toxic)))
    chance = np.random.Generator(np.random.PCG64(5))
    mean = {k: np.zeros_like(v) for k, v in network.p.items()}
    square = {k: np.zeros_like(v) for k, v in network.p.items()}
    # A first guess of the telling window: the one with the strongest inputs.
    strength = np.append(table[:-1, :4].max(axis=1), -np.inf)
    logit = np.full(len(text), -1e9, np.float32)
    for t in range(WINDOW):
        logit = np.maximum(logit, strength[words_at[np.where(t < length, first + t, -1)]])
    step = 0
    for _ in range(ROUNDS):
        top = np.flatnonzero(logit == np.maximum.reduceat(logit, begin)[text])
        top = top[np.append(text[top][1:] != text[top][:-1], True)]
        some = np.concatenate((top, chance.integers(0, len(text), len(top) // 4)))
        some = some[(toxic[text[some]] == 0) | np.isin(some, top)]  # other windows of toxic texts tell nothing
        chance.shuffle(some)
        weight = np.where(toxic[text[some]] == 1, len(toxic) / (2 * n_toxic), len(toxic) / (2 * n_other)).astype(np.float32)
        for lo in range(0, len(some), BATCH):
            part = some[lo : lo + BATCH]
            place, alive = steps(words_at, first[part], length[part])
            step += 1
            rows, place = np.unique(place, return_inverse=True)
            for k, g in network.gradients(table[rows], place.reshape(alive.shape), alive, toxic[text[part]], weight[lo : lo + BATCH]).items():
                g = np.clip(g, -1, 1)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                move = mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
                network.p[k] = (network.p[k] - RATE * move - 1e-4 * network.p[k]).astype(np.float32)
        logit = highest(network, table[:-1], inverse, lengths, threads=min(2, os.cpu_count() or 1), windows=windows)[1]
    slope, shift = calibrated(np.maximum.reduceat(logit, begin).astype(float), toxic)
    found = [odds(c[1], c[0], all_toxic, all_other) for c in counts]
    return Model(network, found[0], found[1:], slope, shift)


def calibrated(logit: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits best, by Newton's steps with a weak pull to slope one."""
    a, b = 1.0, 0.0
    x = np.column_stack((logit, np.ones(len(logit))))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
        gradient = x.T @ (p - target) + np.array([a - 1.0, 0.1 * b])
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1.0, 0.1])
        move = np.linalg.solve(curve, gradient)
        a, b = a - float(np.clip(move[0], -1, 1)), b - float(np.clip(move[1], -2, 2))
    return max(a, 0.05), b


def is_held_out(doc_id: Column) -> Column:
    """One row of three by its id: no label of these is learnt."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 3 == 1, F.lit(False))


@dataclass
class Keys:
    """The rows to learn from: id, hash of the text, label, number of equal rows, and whether the network learns from it."""

    ids: np.ndarray
    hashes: np.ndarray
    toxic: np.ndarray
    copies: np.ndarray
    sampled: np.ndarray

    def rows_of(self, ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the rows are known, and their places here; ids ascend."""
        if not len(self.ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        known = np.flatnonzero((self.ids[place] == ids) & (self.hashes[place] == hashes))
        return known, place[known]


def _counted(keys):
    """Counts of the known rows of a task, and the texts of those that the network learns from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known = Counts(), keys.value
        names = ["cell", "other", "toxic", "id", "label", "text"]
        for batch in batches:
            rows, place = known.rows_of(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            texts = batch.column(2).take(pa.array(rows))
            for words in words_of(texts):
                counts.add(words, known.toxic[place], 1.0 / known.copies[place])
            own = np.flatnonzero(known.sampled[place])
            if len(own):
                none = pa.nulls(len(own), pa.int64()), *(pa.nulls(len(own), pa.float64()) for _ in range(2))
                found = (pa.array(known.ids[place[own]]), pa.array(known.toxic[place[own]].astype(np.int32)), texts.take(pa.array(own)))
                yield pa.RecordBatch.from_arrays([*none, *found], names=names)
        cells = counts.cells()
        none = (pa.nulls(len(cells[0]), t) for t in (pa.int64(), pa.int32(), pa.string()))
        yield pa.RecordBatch.from_arrays([*map(pa.array, cells), *none], names=names)

    return run


def _fitted(cells):
    """The model, as one row, from the rows of the sample in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        columns = [pa.concat_arrays([b.column(i) for b in rows]) if rows else pa.array([], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.string()))]
        first = pa.array(np.unique(columns[0].to_numpy(), return_index=True)[1])  # repeated rows are learnt once
        _, toxic, texts = (x.take(first) for x in columns)
        model = fit(texts, toxic.to_numpy(), Counts.of_cells(*cells.value))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    return run


def known_rows(docs: DataFrame, labels: DataFrame) -> Keys:
    """The keys of labelled documents that are not held out: about ``MAX_COUNTED`` of them, the sample first."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~is_held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.select("id", "hash", F.length("text").alias("n_chars")).groupBy("id", "hash").agg(F.first("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("n"))
    # One text of each id, told by its hash; texts do not move.
    rows = texts.join(known, "id").groupBy("id").agg(F.max("toxic").alias("toxic"), F.min(F.struct("hash", "n_chars", "n")).alias("own"))
    rows = written(rows.select("id", "toxic", "own.*", F.xxhash64("id").alias("draw")), "toxicity-known")
    total = rows.count()
    if total > MAX_COUNTED:  # a share of all by the hash of the id
        rows = rows.where(F.shiftrightunsigned("draw", 32) < int(2**32 * (MAX_COUNTED / total)))
    found = rows.orderBy("id").toArrow()
    ids, toxic, hashes, n_chars, copies, draw = (found.column(c).to_numpy() for c in ("id", "toxic", "hash", "n_chars", "n", "draw"))
    sampled = np.zeros(len(ids), bool)
    for y, most in ((1, MAX_TOXIC), (0, MAX_OTHER)):
        usable = np.flatnonzero((toxic == y) & (n_chars <= MAX_CHARS))
        sampled[usable[np.lexsort((ids[usable], draw[usable].view(np.uint64)))[:most]]] = True
    return Keys(ids, hashes, toxic, copies, sampled)


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of the labels (doc_id, toxic) of documents (doc_id, text) that are not held out."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text")).where("text is not null")
    texts = texts.where(F.col("id").isNotNull() & ~is_held_out(F.col("id"))).withColumn("hash", F.xxhash64("text"))
    keys = context.broadcast(known_rows(texts, labels))  # about MAX_COUNTED rows of four numbers
    found = in_tasks(texts.select("id", "hash", "text"), _counted(keys), "cell long, other double, toxic double, id long, label int, text string")
    found = written(found, "toxicity-counted")
    # A fixed number of cells.
    cells = found.where("cell is not null").groupBy("cell").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toArrow()
    cells = context.broadcast([cells.column(i).to_numpy() for i in range(3)])
    sample = found.where("id is not null").select("id", "label", "text")  # MAX_TOXIC + MAX_OTHER texts of MAX_CHARS
    model = in_tasks(sample.repartition(1), _fitted(cells), "model binary").first()
    return pickle.loads(model.model) if model else fit([], np.zeros(0))


def scored(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """``docs`` with the score of ``text`` in the column ``into``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.scores(words) for words in words_of(batch.column(at))]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, into])

    return in_tasks(docs, run, T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())]))


def not_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those whose score reaches ``threshold``."""
    score = "_score_" + "_".join(docs.columns)
    return scored(docs, trained(docs, labels), score).where(F.col(score) < threshold).select(*docs.columns)
