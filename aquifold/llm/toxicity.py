"""Toxicity of documents by a small bidirectional gated recurrent network, trained in NumPy.

A word's input is a learned vector of the word and the mean of learned vectors of its byte
trigrams and four-grams, both hashed. A window of 24 words runs through a gated recurrent
layer in either direction; attention pools the states into one logit. A document's score comes
from the highest logit of all its windows, which overlap by half.

Labels are of documents, so training picks windows: of a toxic document those the network finds
most toxic (at first those with the words that lean most to toxic documents), of others
the highest and a random one. How far a word or n-gram leans is the lower confidence limit of its
log-odds to stand in toxic documents, so that a few labels are not mistaken for evidence; what chance
would reach is measured on shuffled labels. One place of each vector starts at the part
above that, and the vectors learn more slowly the fewer toxic documents there are. Toxic documents without any evidence are
left out of training until the network finds them toxic, as they may be labelled wrongly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aquifold.llm.common import extended, slices, texts_of, without
from aquifold.llm.decontaminate import words_of

WINDOW, STRIDE = 24, 12
#: Standard errors below the estimate at which evidence is taken; what a unit above chance adds to a vector at first.
CONFIDENCE, WARMTH = 1.64, 2.0
BUCKETS, WIDTH, HIDDEN, ATTENTION = 1 << 14, 12, 8, 8  # as many buckets as word_features has by default
#: Words whose inputs a worker remembers; it starts anew beyond that. Scores do not depend on it.
MAX_REMEMBERED = 400_000


def _words(text: str) -> list[bytes]:
    return words_of(text.lower())


def _mix(x: np.ndarray, bits: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def word_features(words: list[bytes], bits: int = 14) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word, buckets of its byte n-grams one after another, and where each word's begin.

    Words are framed by line ends; a word has its trigrams, then come all words' four-grams,
    so the second array is in order of words after a stable sort.
    """
    framed = b"".join(b"\n" + w + b"\n" for w in words)
    raw = np.frombuffer(framed, np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    start = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(raw)) - start[owner]
    room = sizes[owner] - place
    powers = np.uint64(1099511628211) ** np.arange(int(sizes.max(initial=1)), dtype=np.uint64)
    whole = np.add.reduceat((raw + np.uint64(1)) * powers[place], start) if len(words) else np.zeros(0, np.uint64)
    grams, owners = [], []
    for n in (3, 4):
        at = np.flatnonzero(room >= n)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(257) + raw[at + k]
        grams.append(_mix(h, bits))
        owners.append(owner[at])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return _mix(whole, bits), np.concatenate(grams)[order], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(words)))])


def windows_of(index: np.ndarray) -> np.ndarray:
    """Rows of WINDOW word numbers every STRIDE words that cover all of a document; -1 fills the last."""
    n = len(index)
    count = max(1, -(-(n - WINDOW) // STRIDE) + 1) if n > WINDOW else 1
    padded = np.full((count - 1) * STRIDE + WINDOW, -1, np.int64)
    padded[:n] = index
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _row_sums(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` by row of a table of BUCKETS rows."""
    flat = (rows[:, None] * WIDTH + np.arange(WIDTH)).ravel()
    return np.bincount(flat, values.ravel(), BUCKETS * WIDTH).astype(np.float32).reshape(BUCKETS, WIDTH)


@dataclass
class Network:
    """Parameters by name, all float32, and the logistic calibration of a document's highest logit."""

    parameters: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    _moments: dict[str, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict, repr=False)
    _steps: int = 0

    @classmethod
    def new(cls, rng: np.random.Generator) -> Network:
        def draw(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls({
            "word": draw(BUCKETS, WIDTH, scale=0.05), "char": draw(BUCKETS, WIDTH, scale=0.05),
            "input": draw(2 * WIDTH, 6 * HIDDEN, scale=0.3), "bias": np.zeros(6 * HIDDEN, np.float32),
            "forward": draw(HIDDEN, 3 * HIDDEN, scale=0.3), "backward": draw(HIDDEN, 3 * HIDDEN, scale=0.3),
            "attend": draw(2 * HIDDEN, ATTENTION, scale=0.3), "focus": draw(ATTENTION, scale=0.3),
            "out": draw(2 * HIDDEN, scale=0.3), "offset": np.zeros(1, np.float32),
        })

    def inputs(self, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Word vector and mean n-gram vector of each word."""
        word, grams, start = features
        if not len(word):
            return np.zeros((0, 2 * WIDTH), np.float32)
        sums = np.add.reduceat(self.parameters["char"][grams], start[:-1], axis=0)
        return np.concatenate([self.parameters["word"][word], sums / np.diff(start)[:, None].astype(np.float32)], axis=1)

    def gates(self, inputs: np.ndarray) -> np.ndarray:
        """What each word adds to the gates of both directions; the row for no word is the last."""
        own = inputs @ self.parameters["input"] + self.parameters["bias"]
        return np.concatenate([own, np.zeros((1, own.shape[1]), np.float32)]).astype(np.float32)

    def run(self, gates: np.ndarray, windows: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Logit of each window; ``trace`` gets what the gradient needs."""
        p, (count, length) = self.parameters, windows.shape
        states = np.zeros((count, length, 2 * HIDDEN), np.float32)
        filled = windows >= 0
        steps = []
        for side, name in ((0, "forward"), (1, "backward")):
            h = np.zeros((count, HIDDEN), np.float32)
            own = gates[:, side * 3 * HIDDEN : (side + 1) * 3 * HIDDEN]
            for t in range(length) if side == 0 else range(length - 1, -1, -1):
                x, u = own[windows[:, t]], h @ p[name]
                both = _sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
                z, r = both[:, :HIDDEN], both[:, HIDDEN:]
                n = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
                new = n + z * (h - n)
                here = filled[:, t, None]
                if trace is not None:
                    steps.append((side, t, h, z, r, n, u, here))
                h = np.where(here, new, h)
                states[:, t, side * HIDDEN : (side + 1) * HIDDEN] = h
        raw = np.tanh(states @ p["attend"])
        scores = np.where(filled, raw @ p["focus"], np.float32(-1e9))
        weight = np.exp(scores - scores.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        pooled = np.einsum("bt,bth->bh", weight, states)
        if trace is not None:
            trace |= {"states": states, "raw": raw, "weight": weight, "pooled": pooled, "steps": steps}
        return pooled @ p["out"] + p["offset"][0]

    def gradient(self, gates: np.ndarray, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weighted logistic loss by parameter, and by the gates of each word."""
        p, trace = self.parameters, {}
        logits = self.run(gates, windows, trace)
        d = ((_sigmoid(logits) - labels) * weights / weights.sum()).astype(np.float32)
        states, raw, weight = trace["states"], trace["raw"], trace["weight"]
        out = {"out": d @ trace["pooled"], "offset": np.array([d.sum()], np.float32)}
        d_pooled = d[:, None] * p["out"]
        d_states = weight[:, :, None] * d_pooled[:, None, :]
        d_weight = np.einsum("bth,bh->bt", states, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        out["focus"] = np.einsum("bt,bta->a", d_score, raw)
        d_raw = d_score[:, :, None] * p["focus"] * (1 - raw * raw)
        out["attend"] = np.einsum("bth,bta->ha", states, d_raw)
        d_states = d_states + d_raw @ p["attend"].T
        d_gates = np.zeros((windows.shape[0], windows.shape[1], 6 * HIDDEN), np.float32)
        for name in ("forward", "backward"):
            out[name] = np.zeros_like(p[name])
        carried = {0: np.zeros_like(states[:, 0, :HIDDEN]), 1: np.zeros_like(states[:, 0, :HIDDEN])}
        for side, t, h, z, r, n, u, here in reversed(trace["steps"]):
            name = ("forward", "backward")[side]
            total = carried[side] + d_states[:, t, side * HIDDEN : (side + 1) * HIDDEN]
            d_new = np.where(here, total, 0)
            d_n = d_new * (1 - z) * (1 - n * n)
            d_z = d_new * (h - n) * z * (1 - z)
            d_r = d_n * u[:, 2 * HIDDEN :] * r * (1 - r)
            d_u = np.concatenate([d_z, d_r, d_n * r], axis=1)
            d_gates[:, t, side * 3 * HIDDEN : (side + 1) * 3 * HIDDEN] = np.concatenate([d_z, d_r, d_n], axis=1)
            out[name] += h.T @ d_u
            carried[side] = d_new * z + d_u @ p[name].T + np.where(here, 0, total)
        flat = windows.ravel()
        order = np.argsort(flat, kind="stable")
        numbers, first = np.unique(flat[order], return_index=True)
        by_word = np.zeros((len(gates) - 1, 6 * HIDDEN), np.float32)
        sums = np.add.reduceat(d_gates.reshape(-1, 6 * HIDDEN)[order], first, axis=0)
        by_word[numbers[numbers >= 0]] = sums[numbers >= 0]
        return out, by_word

    def learn(self, features: tuple, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray, rng: np.random.Generator, rate: float, table_rate: float) -> None:
        """One step of Adam on a batch; word vectors are left out at random so that n-grams carry their share.

        The vectors of words and n-grams learn at ``table_rate``, all else at ``rate``.
        """
        p = self.parameters
        inputs = self.inputs(features)
        shown = (rng.random((len(inputs), 1)) > 0.3).astype(np.float32)
        inputs[:, :WIDTH] *= shown
        grads, d_gates = self.gradient(self.gates(inputs), windows, labels, weights)
        grads["input"], grads["bias"] = inputs.T @ d_gates, d_gates.sum(axis=0)
        d_inputs = d_gates @ p["input"].T
        word, grams, start = features
        grads["word"] = _row_sums(word, d_inputs[:, :WIDTH] * shown)
        counts = np.diff(start)
        grads["char"] = _row_sums(grams, np.repeat(d_inputs[:, WIDTH:] / counts[:, None], counts, axis=0))
        self._steps += 1
        for name, g in grads.items():
            first, second = self._moments.get(name) or (np.zeros_like(p[name]), np.zeros_like(p[name]))
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            self._moments[name] = first, second
            size = (table_rate if name in ("word", "char") else rate) * math.sqrt(1 - 0.999**self._steps) / (1 - 0.9**self._steps)
            p[name] -= (size * first / (np.sqrt(second) + 1e-8)).astype(np.float32)

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * np.asarray(logits, np.float64) + self.shift, -30, 30)))


class _Sample:
    """Labelled documents as windows over one list of words."""

    def __init__(self, texts: list[str], labels: list[int]) -> None:
        numbers: dict[bytes, int] = {}
        self.windows, self.owner = [], []
        for i, text in enumerate(texts):
            rows = windows_of(np.fromiter((numbers.setdefault(w, len(numbers)) for w in _words(text)), np.int64))
            self.windows.append(rows)
            self.owner.append(np.full(len(rows), i))
        self.windows, self.owner = np.concatenate(self.windows), np.concatenate(self.owner)
        self.labels, self.words = np.array(labels), list(numbers)
        self._features = word_features(self.words)

    def seen(self, bits: int, grams: bool) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of a document and a bucket of its words, or of their n-grams."""
        size = len(self.words) + 1
        pairs = np.unique(np.repeat(self.owner, WINDOW) * size + self.windows.ravel() + 1)
        doc, word = pairs // size, pairs % size - 1
        doc, word = doc[word >= 0], word[word >= 0]
        whole, gram, start = word_features(self.words, bits)
        if grams:
            n = np.diff(start)[word]
            at = np.repeat(start[:-1][word] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            found = np.unique(np.repeat(doc, n) << bits | gram[at])
        else:
            found = np.unique(doc << bits | whole[word])
        return found >> bits, found & ((1 << bits) - 1)

    def leaning(self, seen: dict[bool, tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int) -> np.ndarray:
        """Of each window, the highest evidence of one of its words or their n-grams."""
        whole, gram, start = word_features(self.words, bits)
        by_word = np.zeros(0)
        if len(self.words):
            by_word = evidence(seen[False], labels, bits)[whole]
            by_word = np.maximum(by_word, np.maximum.reduceat(evidence(seen[True], labels, bits)[gram], start[:-1]))
        return np.append(by_word, -10.0)[self.windows].max(axis=1)

    def best(self, value: np.ndarray) -> np.ndarray:
        """Of each document, its window of highest value."""
        order = np.lexsort((-value, self.owner))
        return order[np.searchsorted(self.owner[order], np.arange(len(self.labels)))]

    def logits(self, network: Network) -> np.ndarray:
        gates = network.gates(network.inputs(self._features))
        return np.concatenate([network.run(gates, self.windows[a : a + 4096]) for a in range(0, len(self.windows), 4096)])


def evidence(seen: tuple[np.ndarray, np.ndarray], labels: np.ndarray, bits: int) -> np.ndarray:
    """Of each bucket, the lower confidence limit of its smoothed log-odds to stand in toxic documents."""
    doc, bucket = seen
    count = [np.bincount(bucket[labels[doc] == y], minlength=1 << bits) + 0.5 for y in (0, 1)]
    odds = [np.log(c / ((labels == y).sum() + 1)) for y, c in enumerate(count)]
    return odds[1] - odds[0] - CONFIDENCE * np.sqrt(1 / count[0] + 1 / count[1])


def train(
    texts: list[str], labels: list[int], rounds: int = 6, steps: int = 480, batch: int = 256, rate: float = 0.01, seed: int = 7,
    table_share: float = 0.2, enough: int = 800,
) -> Network:
    """Network from whole labelled texts; every fifth one of either label is kept for the calibration only.

    Windows are picked anew in each of ``rounds``; about ``steps`` batches are learned in all, more if the windows need it.
    Vectors learn at the share ``table_share`` of the rate, and at a smaller one in proportion if fewer than ``enough`` toxic
    texts are learned from.
    """
    rng = np.random.default_rng(seed)
    network = Network.new(rng)
    y = np.array(labels, bool)
    held = np.where(y, np.cumsum(y), np.cumsum(~y)) % 5 == 0
    own = [i for i in range(len(texts)) if not held[i]]
    if len({labels[i] for i in own}) < 2:
        share = (sum(labels) + 0.5) / (len(labels) + 1)
        network.parameters["out"][:] = 0
        network.shift = math.log(share / (1 - share))
        return network
    sample = _Sample([texts[i] for i in own], [labels[i] for i in own])
    toxic = sample.labels == 1
    seen = {grams: sample.seen(20, grams) for grams in (False, True)}
    value = sample.leaning(seen, sample.labels, 20)
    by_chance = []
    for _ in range(5):
        shuffled = rng.permutation(sample.labels)
        other = sample.leaning(seen, shuffled, 20)
        by_chance.append(other[sample.best(other)][shuffled == 1])
    limit = np.quantile(np.concatenate(by_chance), 0.95)
    evident = value[sample.best(value)] > limit
    if not (evident & toxic).any():
        evident[:] = True
    for name, grams in (("word", False), ("char", True)):
        above = evidence(sample.seen(14, grams), sample.labels, 14) - limit
        network.parameters[name][:, 0] += (WARMTH * np.maximum(0, above)).astype(np.float32)
    del seen
    table_share *= min(1.0, toxic.sum() / enough)
    learned = 0
    for round_ in range(rounds):
        if round_:
            value = sample.logits(network)
        top = sample.best(value)
        anywhere = sample.best(rng.random(len(sample.owner)))
        usable = ~toxic | evident | ((value[top] > 0) if round_ else False)
        chosen = [top[usable], anywhere[~toxic]]
        if round_:
            chosen.append(np.flatnonzero((value > 1) & toxic[sample.owner]))
        chosen = np.concatenate(chosen)
        target = toxic[sample.owner[chosen]].astype(np.float32)
        weight = np.where(target == 1, (target == 0).sum() / max(1, target.sum()) * 0.5, 1.0).astype(np.float32)
        while True:
            size = rate * (0.5 * (1 + math.cos(math.pi * min(1.0, learned / steps))) + 0.02)
            order = rng.permutation(len(chosen))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                numbers, inverse = np.unique(sample.windows[chosen[rows]], return_inverse=True)
                local = inverse.reshape(-1, WINDOW) - int(numbers[0] < 0)
                features = word_features([sample.words[i] for i in numbers[numbers >= 0]])
                network.learn(features, local, target[rows], weight[rows], rng, size, size * table_share)
                learned += 1
            if learned >= steps * (round_ + 1) / rounds:
                break
    rest = _Sample([t for t, h in zip(texts, held, strict=True) if h], [y for y, h in zip(labels, held, strict=True) if h]) if held.any() else sample
    if len(set(rest.labels.tolist())) < 2:
        rest = sample
    values = rest.logits(network)
    _calibrate(network, values[rest.best(values)].astype(np.float64), rest.labels)
    return network


def _calibrate(network: Network, x: np.ndarray, y: np.ndarray) -> None:
    """Logistic scale and shift where some documents may be labelled toxic by mistake.

    Expectation-maximisation: a toxic label is a finding or, at a rate that is estimated too, a mistake. So
    toxic labels on texts that look like all others raise that rate and do not flatten the curve.
    """
    a, b, mistakes = 1.0, 0.0, 0.05
    for _ in range(20):
        found = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        true = np.where(y == 1, found / (found + mistakes * (1 - found)), 0.0)
        mistakes = float(((y == 1) * (1 - true)).sum() / max(1e-9, (1 - true).sum()))
        n1, n0 = true.sum(), (1 - true).sum()
        # Soft targets, so that separated classes stay finite.
        a, b = _logistic(x, true * (n1 + 1) / (n1 + 2) + (1 - true) / (n0 + 2), a, b)
    network.scale, network.shift = float(max(a, 1e-3)), float(b)


def _logistic(x: np.ndarray, target: np.ndarray, a: float, b: float) -> tuple[float, float]:
    """Scale and shift of the logistic curve nearest to the targets, by Newton steps."""
    for _ in range(60):
        q = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = np.maximum(q * (1 - q), 1e-6)
        g = np.array([((q - target) * x).sum() + 1e-3 * (a - 1), (q - target).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    return a, b


class _Scorer:
    """Highest window logit of each text; remembers what words add to the gates."""

    def __init__(self, network: Network) -> None:
        self._network = network
        self._forget()

    def _forget(self) -> None:
        self._number: dict[bytes, int] = {}
        self._gates = np.zeros((1024, 6 * HIDDEN), np.float32)

    def _known(self, lists: list[list[bytes]]) -> None:
        every = set().union(*lists)
        new = list(every.difference(self._number))
        if len(self._number) + len(new) > MAX_REMEMBERED:
            self._forget()
            new = list(every)
        if not new:
            return
        start, end = len(self._number), len(self._number) + len(new)
        if end + 1 > len(self._gates):
            self._gates = np.concatenate([self._gates, np.zeros((max(end + 1, 2 * len(self._gates)) - len(self._gates), 6 * HIDDEN), np.float32)])
        self._gates[start:end] = self._network.gates(self._network.inputs(word_features(new)))[:-1]
        self._gates[-1] = 0
        self._number.update(zip(new, range(start, end)))

    def score(self, texts: list[str]) -> np.ndarray:
        lists = [_words(t) for t in texts]
        self._known(lists)
        get = self._number.__getitem__
        rows = [windows_of(np.fromiter(map(get, words), np.int64, len(words))) for words in lists]
        starts = np.cumsum([0, *map(len, rows)])[:-1]
        windows = np.concatenate(rows)
        logits = np.concatenate([self._network.run(self._gates, windows[a : a + 2048]) for a in range(0, len(windows), 2048)])
        return np.maximum.reduceat(logits, starts)


def labelled_sample(docs: DataFrame, labels: DataFrame, positives: int, negatives: int) -> tuple[list[str], list[int]]:
    """Texts and labels of so many rows of either label at most, those of lowest hash of doc_id."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))

    def some(label: int, count: int) -> DataFrame:
        return known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(count)

    chosen = some(1, positives).union(some(0, negatives))
    # At most positives + negatives rows of two numbers each.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id", F.lit(1)))
    pairs = [(r["text"] or "", int(r["toxic"])) for r in rows.toLocalIterator()]
    return [t for t, _ in pairs], [y for _, y in pairs]


def fit(docs: DataFrame, labels: DataFrame, positives: int = 1000, negatives: int = 2000) -> Network:
    """Network trained on a bounded sample: at most ``positives`` + ``negatives`` labelled rows, with their whole texts."""
    return train(*labelled_sample(docs, labels, positives, negatives))


def score_documents(network: Network, docs: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` without text, with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Every window of the whole text counts. Null and empty texts get the score of an empty window.
    Columns of these names are replaced; rows are independent of one another.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)
    docs = without(docs, "score", "predicted")
    rest = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        scorer = _Scorer(network)
        for batch in batches:
            if batch.num_rows:
                texts = texts_of(batch)
                scores = network.probability(np.concatenate([scorer.score(texts[a:b]) for a, b in slices(texts)]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(scores)], names=[*rest, "score"])

    schema = extended(docs.select(*[F.col(f"`{c}`") for c in rest]).schema, "score double")
    return docs.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
