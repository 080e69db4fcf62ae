"""Linear-chain conditional random field over the words of whole texts.

A word's emission is the sum of the weights of its hashed features: the word itself, its first and last letters, its letter n-grams
and its place in lexicons. Transitions are learned. Forward-backward runs over a batch of texts as one chain that starts anew at each text: the
chain is cut into blocks of equal length whose transfer matrices are multiplied for all blocks at a time, then a short pass joins
the blocks, so a text of any length costs the same per word. Fits run in shards: each takes steps from the common weights on its own
share of a bounded sample, and the weights are averaged after each round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tarnwater.llm.encode import text_slices

#: Letters of a word looked at together; longer words count as several parts.
WIDTH = 24
AFFIXES, GRAM = 6, 3
TABLE = 1 << 18
BLOCK = 128
#: Bytes of text tagged at a time.
TAG_BYTES = 2_000_000

_NO_WORD = r"[^\pL\pM\pN]+"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_table(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words (runs of letters, marks and digits, lower-cased), the number of each word of the texts in them, and the n + 1
    places where texts begin."""
    plain = pc.replace_substring_regex(pc.fill_null(texts, "").cast(pa.large_string()), pattern=_NO_WORD, replacement=" ")
    words = pc.ascii_split_whitespace(plain)
    coded = words.flatten().dictionary_encode()
    names, codes = coded.dictionary.to_pylist(), np.asarray(coded.indices, np.int64)
    bounds = np.asarray(words.offsets, np.int64)
    # Blanks at an end of a text, and texts without words, give empty words.
    real = codes != names.index("") if "" in names else np.ones(len(codes), bool)
    upto = np.concatenate([[0], np.cumsum(real)])
    return [w.lower() for w in names], codes[real], upto[bounds - bounds[0]]


def _slot(hashed: np.ndarray, kind: int) -> np.ndarray:
    mixed = (hashed ^ np.uint64(kind * 0x51ED27)) * _MIX
    return ((mixed ^ (mixed >> np.uint64(29))) * _MIX >> np.uint64(40)).astype(np.int64) % TABLE


def word_hash(letters: np.ndarray) -> np.ndarray:
    h = np.full(len(letters), 7, np.uint64)
    for j in range(letters.shape[1]):
        c = letters[:, j].astype(np.uint64)
        h = np.where(c > 0, h * np.uint64(1_000_003) + c, h)
    return h


def _letters(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the words' parts as numbers, 0 after the end, and the word of each part."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.arange(len(words))
    if len(words) and size.max() > WIDTH:
        parts = [(i, w[a : a + WIDTH]) for i, w in enumerate(words) for a in range(0, max(len(w), 1), WIDTH)]
        owner, words = np.array([i for i, _ in parts]), [p for _, p in parts]
    return np.array(words, f"U{WIDTH}").view(np.uint32).reshape(-1, WIDTH), owner


@dataclass
class Model:
    """Weights of a field with the given tags. ``lexicons``: sorted word hashes of each tag's lexicon."""

    tags: list
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray
    lexicons: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def empty(cls, tags: list, lexicons: Sequence[np.ndarray] = ()) -> Model:
        k = len(tags)
        return cls(tags, np.zeros((TABLE + len(lexicons) + 1, k), np.float32), np.zeros((k, k)), np.zeros(k), list(lexicons))

    def features(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(slots, words): the slots of all words' features, each with the number of its word."""
        letters, owner = _letters(words)
        n = (letters > 0).sum(1)
        slots, owners = [], []

        def add(where: np.ndarray, slot: np.ndarray) -> None:
            slots.append(slot[where])
            owners.append(owner[where])

        everything = np.ones(len(letters), bool)
        add(everything, np.full(len(letters), TABLE + len(self.lexicons)))
        whole = word_hash(letters)
        add(everything, _slot(whole, 1))
        for i, lexicon in enumerate(self.lexicons):
            at = np.minimum(np.searchsorted(lexicon, whole), max(len(lexicon) - 1, 0))
            if len(lexicon):
                add(lexicon[at] == whole, np.full(len(letters), TABLE + i))
        back = np.take_along_axis(letters, np.maximum(n[:, None] - 1 - np.arange(AFFIXES), 0), 1).astype(np.uint64)
        first = last = np.full(len(letters), 11, np.uint64)
        for j in range(AFFIXES):
            first = first * np.uint64(1_000_003) + letters[:, j].astype(np.uint64)
            last = last * np.uint64(1_000_003) + back[:, j]
            add(n > j, _slot(first, 10 + j))
            add(n > j, _slot(last, 30 + j))
        edge = np.ones((len(letters), 1), np.uint64)
        padded = np.hstack([edge, letters.astype(np.uint64), np.zeros((len(letters), 1), np.uint64)])
        padded[np.arange(len(letters)), n + 1] = 1
        for j in range(int(n.max(initial=0)) + 3 - GRAM):
            gram = np.full(len(letters), 13, np.uint64)
            for d in range(GRAM):
                gram = gram * np.uint64(1_000_003) + padded[:, j + d]
            add(n + 2 >= j + GRAM, _slot(gram, 50))
        return np.concatenate(slots), np.concatenate(owners)

    def emissions(self, words: Sequence[str]) -> np.ndarray:
        """Score of each tag for each distinct word."""
        slots, owner = self.features(words)
        return np.stack([np.bincount(owner, self.weights[slots, k], len(words)) for k in range(len(self.tags))], 1)

    def marginals(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each tag at every word of some texts, and the n + 1 places where texts begin."""
        words, codes, bounds = word_table(texts)
        if not len(codes) or not self.tags:
            return np.zeros((len(codes), len(self.tags))), bounds
        first = np.zeros(len(codes), bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        chain = Chain(self.emissions(words)[codes], first, self.transitions, self.start)
        return chain.marginals(), bounds


class Chain:
    """Forward-backward over words of many texts; ``first`` marks the first word of each text."""

    def __init__(self, scores: np.ndarray, first: np.ndarray, transitions: np.ndarray, start: np.ndarray):
        self.n, self.k = scores.shape
        self.first = first
        self.step, self.begin = np.exp(transitions), np.exp(start)
        blocks = -(-self.n // BLOCK)
        pad = blocks * BLOCK - self.n
        potential = np.exp(scores - scores.max(1, keepdims=True))
        self.potential = np.concatenate([potential, np.ones((pad, self.k))]).reshape(blocks, BLOCK, self.k)
        self.reset = np.concatenate([first, np.ones(pad, bool)]).reshape(blocks, BLOCK)
        self._run()

    def _run(self) -> None:
        e, reset, a, k = self.potential, self.reset, self.step, self.k
        blocks = len(e)
        product = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
        for t in range(BLOCK):
            moved = np.where(reset[:, t, None, None], product.sum(2, keepdims=True) * self.begin, product @ a)
            product = moved * e[:, t, None, :]
            product /= product.max((1, 2), keepdims=True)
        into, out = np.empty((blocks, k)), np.empty((blocks, k))
        now = np.full(k, 1.0 / k)
        for b in range(blocks):
            into[b] = now
            now = now @ product[b]
            now = now / now.sum()
        now = np.full(k, 1.0 / k)
        for b in range(blocks - 1, -1, -1):
            out[b] = now
            now = product[b] @ now
            now = now / now.sum()
        self.alpha, self.beta = np.empty_like(e), np.empty_like(e)
        now = into
        for t in range(BLOCK):
            now = np.where(reset[:, t, None], now.sum(1, keepdims=True) * self.begin, now @ a) * e[:, t]
            now = now / now.sum(1, keepdims=True)
            self.alpha[:, t] = now
        now = out
        for t in range(BLOCK - 1, -1, -1):
            self.beta[:, t] = now
            later = now * e[:, t]
            now = np.where(reset[:, t, None], (later * self.begin).sum(1, keepdims=True), later @ a.T)
            now = now / now.sum(1, keepdims=True)

    def marginals(self) -> np.ndarray:
        both = (self.alpha * self.beta).reshape(-1, self.k)[: self.n]
        return both / both.sum(1, keepdims=True)

    def expected_steps(self) -> np.ndarray:
        """Expected number of each step from tag to tag."""
        alpha, ahead = self.alpha.reshape(-1, self.k)[: self.n], (self.potential * self.beta).reshape(-1, self.k)[: self.n]
        pairs = alpha[:-1, :, None] * self.step * ahead[1:, None, :]
        pairs = pairs[~self.first[1:]]
        return (pairs / pairs.sum((1, 2), keepdims=True)).sum(0)


@dataclass(frozen=True)
class Fit:
    """How a field is fitted: rounds of averaging, shards of the sample, words per step, step size, pull of weights to 0 per step."""

    rounds: int = 2
    shards: int = 6
    batch: int = 16_384
    rate: float = 0.3
    decay: float = 1e-2


def _descend(model: Model, words: Sequence[str], codes: np.ndarray, tags: np.ndarray, first: np.ndarray, how: Fit, seed: int) -> None:
    """One pass of adaptive steps over tagged words, in place."""
    k, rng = len(model.tags), np.random.default_rng(seed)
    starts = np.flatnonzero(first)
    cuts = np.append(starts[np.searchsorted(starts, np.arange(0, len(codes), how.batch))[:-1]] if len(starts) > 1 else [0], len(codes))
    cuts = np.unique(np.concatenate([[0], cuts]))
    spread, spread_a, spread_s = np.full(model.weights.shape, 1e-3, np.float32), np.full((k, k), 1e-3), np.full(k, 1e-3)
    for i in rng.permutation(len(cuts) - 1):
        part = slice(cuts[i], cuts[i + 1])
        seen, own = np.unique(codes[part], return_inverse=True)
        slots, owner = model.features([words[c] for c in seen])
        scores = np.stack([np.bincount(owner, model.weights[slots, j], len(seen)) for j in range(k)], 1)
        begin = first[part]
        chain = Chain(scores[own], begin, model.transitions, model.start)
        n, truth = part.stop - part.start, tags[part]
        error = chain.marginals()
        error[np.arange(n), truth] -= 1
        per_word = np.stack([np.bincount(own, error[:, j], len(seen)) for j in range(k)], 1)
        used, place = np.unique(slots, return_inverse=True)
        grad = np.stack([np.bincount(place, per_word[owner, j], len(used)) for j in range(k)], 1) + how.decay * model.weights[used]
        spread[used] += grad * grad
        model.weights[used] -= how.rate * grad / np.sqrt(spread[used])
        real = np.zeros((k, k))
        inner = ~begin[1:]
        np.add.at(real, (truth[:-1][inner], truth[1:][inner]), 1)
        grad_a = chain.expected_steps() - real + how.decay * model.transitions
        spread_a += grad_a * grad_a
        model.transitions -= how.rate * grad_a / np.sqrt(spread_a)
        grad_s = error[begin].sum(0)
        spread_s += grad_s * grad_s
        model.start -= how.rate * grad_s / np.sqrt(spread_s)


#: What a shard's rows become: distinct words, the number of each word in them, its tag, and the first word of each sequence.
Tagged = tuple[Sequence[str], np.ndarray, np.ndarray, np.ndarray]


def fit(sample: DataFrame, model: Model, tagged: Callable[[pa.Table, int], Tagged], how: Fit = Fit()) -> Model:
    """Fit a field on a bounded sample with a column ``shard`` from 0 to how.shards - 1.

    ``tagged(rows, round)`` makes tagged sequences of one shard's rows. Only weights, of fixed size, come to the driver.
    """
    schema = "shard int, n bigint, weights binary, transitions array<double>, start array<double>"
    for round_ in range(how.rounds):
        current = model

        def shard(table: pa.Table) -> pa.Table:
            own = Model(current.tags, current.weights.copy(), current.transitions.copy(), current.start.copy(), current.lexicons)
            order = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in table.column_names])
            words, codes, tags, first = tagged(table.take(order), round_)
            if len(codes):
                _descend(own, words, codes, tags, first, how, round_)
            row = {"shard": table.column("shard")[0].as_py(), "n": len(codes), "weights": own.weights.tobytes(), "transitions": own.transitions.ravel(), "start": own.start}
            return pa.Table.from_pylist([row], pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("weights", pa.binary()), ("transitions", pa.list_(pa.float64())), ("start", pa.list_(pa.float64()))]))

        rows = sorted(sample.groupBy("shard").applyInArrow(shard, schema).where("n > 0").collect(), key=lambda r: r["shard"])
        if not rows:
            return model
        share = np.array([r["n"] for r in rows], float) / sum(r["n"] for r in rows)
        mean = lambda name: sum(s * np.array(r[name], float) for s, r in zip(share, rows, strict=True))
        weights = sum(np.float32(s) * np.frombuffer(r["weights"], np.float32) for s, r in zip(share, rows, strict=True))
        model = Model(model.tags, weights.reshape(model.weights.shape), mean("transitions").reshape(model.transitions.shape), mean("start"), model.lexicons)
    return model


def tag_batches(batches: Iterator[pa.RecordBatch], model: Model, text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches of rows with the marginals of their words and the places where texts begin."""
    for whole in batches:
        for a, b in text_slices(whole.column(text), TAG_BYTES):
            batch = whole.slice(a, b - a)
            yield batch, *model.marginals(batch.column(text))


def sums_by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    upto = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return upto[bounds[1:]] - upto[bounds[:-1]]
