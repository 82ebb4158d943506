"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the vectors of its character n-grams (3 to 6, with word
marks) and of the word itself, all hashed into one table; a window of words averages its
word vectors; a softmax over two classes reads that average. Table and softmax are trained
jointly in numpy, so a misspelling that was never seen shares most of its n-grams, and
thus its vector, with the words it came from.

A document is as toxic as its worst windows, so a short outburst in a long text counts: a
logistic regression reads the worst window, the worst one apart from it, and the share of
toxic windows.
Windows have no labels of their own: training starts from the documents' labels and then
keeps, of each toxic document, the windows that the model itself finds toxic. Only n-grams
whose presence in a document is associated with its label (a z-test of two shares) get a
vector; the others stay zero, so that single documents cannot be learned by heart.

The model is fitted on a bounded sample of labelled documents: ``MAX_TOXIC`` and
``MAX_CLEAN`` rows of each class, the first in the order of a hash of their ids. Scoring
reads all words of all documents.

Defined results: a null or blank text has no windows and gets the score of an empty
window; a null label teaches nothing; with fewer than two classes, or no word, in training every score
is the share of label 1 (0.5 without labels); repeated rows are scored each for itself; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import LOWER, id_text, map_slices, text_bytes, words

MAX_TOXIC = 1500
MAX_CLEAN = 3000
BITS = 18
DIM = 8
SIZES = (3, 4, 5, 6)
#: N-grams with a smaller association with the label have no vector.
MIN_Z = 4.0
WINDOW = 8
STRIDE = 4
ROUNDS = 3
DECAY = 0.002
STEPS = 50
#: Windows of a class in a training round, besides those that stand out.
ROUND_WINDOWS = 25_000
#: Words of the training vocabulary whose n-grams are listed at a time.
SLICE_WORDS = 20_000
#: Word logits kept per worker process.
CACHE_WORDS = 500_000

_MUL = np.uint64(0x9E3779B97F4A7C15)


def _buckets(h: np.ndarray, kind: int, bits: int) -> np.ndarray:
    h = (h + np.uint64(kind)) * _MUL
    h ^= h >> np.uint64(29)
    return ((h * _MUL) >> np.uint64(64 - bits)).astype(np.int32)


def ngrams(vocabulary: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of every n-gram of every word and of each whole word."""
    marked = [b"<" + w + b">" for w in vocabulary]
    data = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
    sizes = np.array([len(w) for w in marked], dtype=np.int64)
    owner = np.repeat(np.arange(len(marked), dtype=np.int32), sizes)
    place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max(initial=1)), _MUL, dtype=np.uint64))
        whole = np.add.reduceat(data * powers[place], np.cumsum(sizes) - sizes) if len(marked) else data
        who, what = [np.arange(len(marked), dtype=np.int32)], [_buckets(whole, 1, bits)]
        for n in SIZES:
            if len(data) < n:
                continue
            h = np.zeros(len(data) - n + 1, dtype=np.uint64)
            for k in range(n):
                h = h * np.uint64(1099511628211) + data[k : len(data) - n + 1 + k]
            inside = owner[: len(h)] == owner[n - 1 :]
            who.append(owner[: len(h)][inside])
            what.append(_buckets(h[inside], n + 1, bits))
    return np.concatenate(who), np.concatenate(what)


def windows(n: int) -> np.ndarray:
    """Starts of the windows over ``n`` words; the last one ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, dtype=np.int64)
    starts = np.arange(0, n - WINDOW + 1, STRIDE)
    return starts if starts[-1] == n - WINDOW else np.append(starts, n - WINDOW)


class Model:
    """Per n-gram logits (the table times the softmax's weights), bias and calibration."""

    def __init__(self, logits: np.ndarray, bias: float, beta: np.ndarray):
        self.logits, self.bias, self.beta = logits, bias, beta

    def word_logits(self, vocabulary: list[bytes]) -> np.ndarray:
        if not vocabulary:
            return np.zeros(0)
        who, what = ngrams(vocabulary)
        n = len(vocabulary)
        return np.bincount(who, self.logits[what], n) / np.bincount(who, minlength=n)

    def features(self, s: np.ndarray) -> tuple[float, float, float]:
        """Worst window of a text with word logits ``s``, the worst one that does not overlap
        it, and the square root of the share of toxic windows."""
        if not len(s):
            return self.bias, self.bias, 0.0
        total = np.concatenate([[0.0], np.cumsum(s)])
        at = windows(len(s))
        end = np.minimum(at + WINDOW, len(s))
        return spread_features((total[end] - total[at]) / (end - at) + self.bias, at)

    def score(self, features: np.ndarray) -> np.ndarray:
        z = features.reshape(-1, 3) @ self.beta[:3] + self.beta[3]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def spread_features(logits: np.ndarray, starts: np.ndarray) -> tuple[float, float, float]:
    top = int(logits.argmax())
    apart = logits[np.abs(starts - starts[top]) >= WINDOW]
    second = float(apart.max()) if len(apart) else min(float(logits[top]), 0.0)
    return float(logits[top]), second, float(np.sqrt((logits > 0).mean()))


class _Adam:
    def __init__(self, *shapes: tuple[int, ...]):
        self.m, self.v, self.t = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0

    def step(self, params: list[np.ndarray], grads: list[np.ndarray], rate: float) -> None:
        self.t += 1
        for p, g, m, v in zip(params, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-8)


def _sums(at: np.ndarray, rows: np.ndarray, picks: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``rows[picks]`` by ``at``; column by column, so that the picked rows are never whole."""
    return np.stack([np.bincount(at, rows[:, k][picks], n) for k in range(rows.shape[1])], 1)


def _grams_by_word(vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram buckets of all words, word after word, and the number of each word's.
    Built in slices of the vocabulary: what lies in between is several times larger."""
    what, sizes = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
    for at in range(0, len(vocabulary), SLICE_WORDS):
        who, buckets = ngrams(vocabulary[at : at + SLICE_WORDS])
        what.append(buckets[np.argsort(who, kind="stable")])
        sizes.append(np.bincount(who))
    return np.concatenate(what), np.concatenate(sizes)


def _associated(docs: list[np.ndarray], toxic: np.ndarray, what: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Which n-grams occur in toxic and clean documents at significantly different rates."""
    first = np.concatenate([[0], np.cumsum(grams)])
    found = np.zeros((2, 1 << BITS))
    for ids, y in zip(docs, toxic, strict=True):
        words_of_doc = np.unique(ids)
        spans = first[words_of_doc + 1] - first[words_of_doc]
        heads = np.cumsum(spans) - spans
        own = what[np.repeat(first[words_of_doc] - heads, spans) + np.arange(spans.sum())]
        found[y, np.unique(own)] += 1
    n = np.array([(toxic == 0).sum(), (toxic == 1).sum()])
    share = found.sum(axis=0) / n.sum()
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n[0] + 1 / n[1]))
    return np.abs(found[1] / n[1] - found[0] / n[0]) > MIN_Z * error


def train(texts: list[bytes], toxic: np.ndarray, seed: int = 11) -> Model:
    """Joint training on labelled texts (bounded by the caller)."""
    toxic = np.asarray(toxic).astype(int)
    index: dict[bytes, int] = {}
    docs = [
        np.fromiter((index.setdefault(w, len(index)) for w in words(t.translate(LOWER))), dtype=np.int32) for t in texts
    ]
    if not index or toxic.min() == toxic.max():
        share = float(toxic.mean()) if len(toxic) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(1 << BITS), 0.0, np.array([0, 0, 0, np.log(share / (1 - share))]))
    rng = np.random.default_rng(seed)
    what, grams = _grams_by_word(list(index))
    del index
    used = _associated(docs, toxic, what, grams)[what]
    who, what = np.repeat(np.arange(len(grams), dtype=np.int32), grams)[used], what[used]
    tokens = np.concatenate(docs)
    base = np.cumsum([0, *(len(d) for d in docs)])
    doc_of, start_of, end_of = [], [], []
    for k, d in enumerate(docs):
        if len(d):
            at = windows(len(d))
            doc_of.append(np.full(len(at), k))
            start_of.append(base[k] + at)
            end_of.append(base[k] + np.minimum(at + WINDOW, len(d)))
    doc_of, start_of, end_of = (np.concatenate(x) for x in (doc_of, start_of, end_of))
    positive = toxic[doc_of] == 1
    kinds, what = np.unique(what, return_inverse=True)  # the n-grams with a vector
    table = rng.normal(0, 0.05, (len(kinds), DIM))
    weights, bias = rng.normal(0, 0.3, (DIM, 2)), np.zeros(2)
    adam = _Adam(table.shape, weights.shape, bias.shape)

    def window_logits() -> np.ndarray:
        per_gram = table @ (weights[:, 1] - weights[:, 0])
        per_word = np.bincount(who, per_gram[what], len(grams)) / grams
        total = np.concatenate([[0.0], np.cumsum(per_word[tokens])])
        return (total[end_of] - total[start_of]) / (end_of - start_of) + bias[1] - bias[0]

    for turn in range(ROUNDS):
        clean = np.flatnonzero(~positive)
        if turn == 0:
            chosen_pos = rng.permutation(np.flatnonzero(positive))[:ROUND_WINDOWS]
        else:
            # Of each toxic document the windows that stand out, its worst one at least;
            # of each clean document also its worst one.
            logits = window_logits()
            top = np.full(len(docs), -np.inf)
            np.maximum.at(top, doc_of, logits)
            stands = positive & ((logits >= top[doc_of]) | (logits > 2))
            chosen_pos = np.flatnonzero(stands)
            hard = clean[logits[clean] >= top[doc_of[clean]]]
        chosen_neg = rng.permutation(clean)[:ROUND_WINDOWS]
        if turn:
            chosen_neg = np.union1d(chosen_neg, hard)
        chosen = np.concatenate([chosen_pos, chosen_neg])
        y = np.concatenate([np.ones(len(chosen_pos)), np.zeros(len(chosen_neg))])
        weight = np.where(y == 1, 0.5 / max(len(chosen_pos), 1), 0.5 / max(len(chosen_neg), 1))
        sizes = end_of[chosen] - start_of[chosen]
        member = np.repeat(np.arange(len(chosen)), sizes)
        heads = np.cumsum(sizes) - sizes
        seen = tokens[np.repeat(start_of[chosen] - heads, sizes) + np.arange(sizes.sum())]
        for _ in range(STEPS):
            vectors = _sums(who, table, what, len(grams)) / grams[:, None]
            bags = np.add.reduceat(vectors[seen], heads, axis=0) / sizes[:, None]
            logits = bags @ weights + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[:, 1] -= y
            p[:, 0] -= 1 - y
            g = p * weight[:, None]
            to_bag = (g @ weights.T) / sizes[:, None]
            to_word = _sums(seen, to_bag, member, len(grams)) / grams[:, None]
            to_table = _sums(what, to_word, who, len(kinds))
            table *= 1 - DECAY
            adam.step([table, weights, bias], [to_table, bags.T @ g, g.sum(axis=0)], 0.05)
    logits, gap = window_logits(), float(bias[1] - bias[0])
    cuts = np.searchsorted(doc_of, np.arange(len(docs) + 1))
    rows = [
        spread_features(logits[a:b], start_of[a:b]) if b > a else (gap, gap, 0.0) for a, b in zip(cuts, cuts[1:], strict=False)
    ]
    per_gram = np.zeros(1 << BITS)
    per_gram[kinds] = table @ (weights[:, 1] - weights[:, 0])
    return Model(per_gram, gap, _calibrate(np.array(rows), toxic))


def _calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression of the labels on the window features (damped Newton)."""
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    beta = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        h = z.T @ (z * (p * (1 - p))[:, None]) + 0.1 * np.eye(len(beta))
        beta += np.clip(np.linalg.solve(h, z.T @ (y - p) - 0.1 * beta), -2, 2)
    slopes = beta[:-1] / scale
    return np.append(slopes, beta[-1] - slopes @ centre)


_WORKER: dict[int, tuple[Model, dict[bytes, float]]] = {}


def _scorer(model: Model, stamp: int):
    """Scores of a list of texts; word logits are kept for the next tasks of the worker."""
    if stamp not in _WORKER:
        _WORKER.clear()
        _WORKER[stamp] = model, {}
    model, cache = _WORKER[stamp]

    def scores(texts: list[bytes]) -> np.ndarray:
        docs = [words(t.translate(LOWER)) for t in texts]
        new = {w for d in docs for w in d if w not in cache}
        if new and len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = {w for d in docs for w in d}
        known = list(new)
        cache.update(zip(known, model.word_logits(known).tolist(), strict=True))
        return model.score(np.array([model.features(np.array([cache[w] for w in d])) for d in docs]))

    return scores


def fit(docs: DataFrame, labels: DataFrame, train_rows: Callable[[], Column], label: str = "toxic", key: str = "doc_id") -> Model:
    """Fit on the bounded sample of labelled documents that ``train_rows()`` allows."""
    usable = labels.select(F.col(key), F.col(label).cast("int").alias("y")).where(train_rows() & F.col("y").isin(0, 1))
    rank = F.xxhash64(id_text(key), F.lit(7))
    chosen = [usable.where(F.col("y") == y).orderBy(rank).limit(n) for y, n in ((1, MAX_TOXIC), (0, MAX_CLEAN))]
    # At most MAX_TOXIC + MAX_CLEAN ids are broadcast; only their texts reach the driver.
    sample = docs.select(F.col(key), F.col("text")).join(F.broadcast(chosen[0].union(chosen[1])), key)
    rows = sample.select("text", "y", rank.alias("r")).collect()
    rows.sort(key=lambda r: (r["r"], r["text"] or ""))
    texts, toxic = [(r["text"] or "").encode() for r in rows], np.array([r["y"] for r in rows])
    del rows  # the training needs the room
    return train(texts, toxic)


def score_documents(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` but ``text`` as they are, and ``score``. Map-only."""
    rest = [c for c in docs.columns if c != text and c != "score"]
    source = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`"))
    schema = source.select(*rest).schema.add("score", "double")
    stamp = int(np.random.default_rng().integers(1 << 62))

    def make():
        scores = _scorer(model, stamp)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            got = scores(text_bytes(batch.column(len(rest))))
            return pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(got)], [*rest, "score"])

        return step

    return map_slices(source, make, schema)
