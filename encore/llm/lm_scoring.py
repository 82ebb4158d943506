"""Language-model scores from a probabilistic suffix tree over whole texts.

Symbols are a document's tokens and an end symbol. The state of the model is the longest
retained context: up to two preceding tokens, whatever text they stand in (start marks
before the first). A context is retained when it occurs ``MIN_COUNT`` times and its next
symbols diverge from those of the state that would otherwise serve (the longest retained
suffix); its distribution is smoothed with that state's. The root is the distribution of
words, smoothed with a spelling model: a suffix tree of the same kind over the bytes of a
word and its closing space (contexts of up to ``DEPTH`` bytes since the word began). So
unseen words have a probability, too, and all texts' probabilities sum to 1.

All counts come from all training rows. There are no shares: minimum counts are absolute, so
the tree grows with the corpus. Texts are written once as blocks (some megabytes of text as
word codes), bucketed by their number, so that no later step moves them. What a block has to
know of the corpus it asks for by key: it sends its distinct words, windows (context and
next symbol) or contexts as sorted 64-bit hashes with their own counts, in ranges of the hash;
tasks sum a range over all blocks and send the sums back in the order of the keys. Such
rounds give the words' counts; the counts of windows of one token of context; of two tokens,
and which contexts of one are retained; which of two are; then every block scores its own
texts. Windows whose
context occurs less than ``MIN_COUNT`` times are never sent: they pass on to the lower order
by definition. Words go by 64-bit hashes (a billion of them hold one collision with
probability 3 %); windows by as many bits as keep the share of windows that collide near a
millionth, whatever the size of the corpus (``KEY_BITS`` more than tokens have).

The spelling model is a table of byte windows; up to ``SPELLING_ROWS`` rows it is worked out
on the driver and sent to the tasks, beyond that it is built and joined with the distinct
words as a distributed table.

Defined results: a null or blank text is only its end token; repeated rows count and are
scored each for itself; without training rows the counts are 0 and all symbols are equally
likely; long texts and words are read whole; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import checkpointed, shuffles_removed
from encore.llm.parts import text_slices
from encore.llm.phrase_mining import mixed, pack, pack_sorted, range_of, unpack, unpack_sorted
from encore.session import scratch_path

DEPTH = 5
#: Occurrences that a context needs: one that was seen once tells nothing about what may follow.
MIN_COUNT = 2
#: Nats by which a context must better its suffix over all its occurrences.
MIN_GAIN = 8.0
#: Weight of the suffix's distribution, in occurrences.
SMOOTHING = 4.0
SPACE, END = 32, 10  # neither byte occurs in a word
#: Rows (16 bytes each) of the spelling model that are sent to every task.
SPELLING_ROWS = 4_000_000
#: Bytes of text in a block, and keys that one summing task holds at a time.
BLOCK_BYTES, RANGE_KEYS = 5 << 20, 4_000_000
#: Byte contexts that a task adds up before it sends them on.
HELD_CONTEXTS = 1_500_000
#: Bits of a window's key beyond those that number the corpus' tokens.
KEY_BITS = 20


def hash_of(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


#: Keys of the mark before a text, of its end, and of two marks; none is a word.
START_KEY, END_KEY, STARTS_KEY = (np.uint64(hash_of(x)) for x in (b" ", b"\n", b"  "))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct keys, a place of each, and the index of every key among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    heads = np.empty(len(keys), dtype=bool)
    heads[:1] = True
    np.not_equal(ordered[1:], ordered[:-1], out=heads[1:])
    back = np.empty(len(keys), dtype=np.int32)
    back[order] = np.cumsum(heads, dtype=np.int32) - 1
    return ordered[heads], order[heads], back


def spelling_keys(vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of each symbol of the words, the word's place in the list and the key (as in
    ``context_keys``) of the symbol after its longest context."""
    data = np.frombuffer(b"".join([b" " + w + b" " for w in vocabulary]), dtype=np.uint8)
    sizes = np.fromiter(map(len, vocabulary), dtype=np.int64, count=len(vocabulary)) + 2
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.minimum(place, DEPTH)
    # The bytes before a symbol, whatever word they are of; the order says how many are its own.
    before = np.zeros(len(data), dtype=np.int64)
    for k in range(DEPTH, 0, -1):
        before <<= 8
        before[k:] |= data[:-k]
    before &= ((1 << 8 * np.arange(DEPTH + 1)) - 1)[order]
    at = np.flatnonzero(place)
    return owner[at], ((order << 56) | (before << 8) | data)[at]


def context_keys(vocabulary: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (order, context, next symbol) keys of words and their weighted counts. A key
    packs the order, up to DEPTH context bytes and the symbol, from the high to the low bits."""
    owner, longest = spelling_keys(vocabulary)
    known, _, back = distinct(longest)
    weight = np.bincount(back, np.asarray(counts, dtype=np.float64)[owner], len(known))
    order = known >> 56
    keys, weights = [], []
    held, of_held = np.zeros(0, dtype=np.int64), np.zeros(0)
    for k in range(DEPTH, -1, -1):
        # The symbols whose longest context has this order, and the longer ones without their first byte.
        shorter = (k << 56) | (held & ((1 << 8 * (k + 1)) - 1))
        here = order == k
        held, _, back = distinct(np.concatenate([known[here], shorter]))
        of_held = np.bincount(back, np.concatenate([weight[here], of_held]), len(held))
        keys.append(held)
        weights.append(of_held)
    return np.concatenate(keys), np.concatenate(weights).astype(np.int64)


def climb(windows: DataFrame, lower: DataFrame) -> DataFrame:
    """(window, lp): log10 probabilities of the windows of one order.

    ``windows`` (window, ctx, below, c): a window, its context, the window of the next lower
    order, and its count (0 for those that only texts to be scored have); ``lower`` (window,
    lp): the lower order. Contexts that are not retained pass on the lower order's value.
    """
    known = windows.join(lower.select(F.col("window").alias("below"), "lp"), "below")
    n, c, lp = F.col("n"), F.col("c"), F.col("lp")
    # The sum of c * ln(c / n / p), as n is the sum of c; c * ln c is 0 for windows not seen.
    gain = F.sum(F.when(c > 0, c * (F.log(c.cast("double")) - lp * math.log(10)))).alias("gain")
    states = known.groupBy("ctx").agg(F.sum("c").alias("n"), gain).where((n >= MIN_COUNT) & (F.col("gain") - n * F.log(n.cast("double")) >= MIN_GAIN))
    # Read back from the folder, so that both sides of the join come from exchanges and
    # adaptive execution can split a frequent context.
    states = checkpointed(states.select("ctx", "n"))
    own = F.when(c > 0, F.log10((c + SMOOTHING * F.pow(F.lit(10.0), lp)) / (n + SMOOTHING))).otherwise(lp + F.log10(SMOOTHING / (n + SMOOTHING)))
    return known.join(states, "ctx", "left").select("window", F.when(n.isNull(), lp).otherwise(own).alias("lp"))



# -- the spelling model ------------------------------------------------------------------------


def spelling_table(contexts: DataFrame, documents: int) -> DataFrame:
    """(window, lp): the log10 probabilities of all byte windows, from (key, c) of all words'
    contexts and next symbols, and the ends of ``documents`` texts."""
    ends = [(END, documents), (1 << 56 | SPACE << 8 | END, documents)]
    contexts = checkpointed(contexts.union(contexts.sparkSession.createDataFrame(ends, "key bigint, c bigint")))
    of_order = [contexts.where(F.shiftright("key", 56) == k) for k in range(DEPTH + 1)]
    total = of_order[0].agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    lower = of_order[0].select(F.col("key").alias("window"), F.log10((F.col("c") + 1) / F.lit(float(total + 256))).alias("lp"))
    table = None
    for k in range(1, DEPTH + 1):
        # The context without its first byte, one order lower.
        below = F.when(F.lit(k == 1), F.col("key").bitwiseAND(255)).otherwise(F.lit((k - 1) << 56).bitwiseOR(F.col("key").bitwiseAND((1 << 8 * k) - 1)))
        lower = checkpointed(climb(of_order[k].select(F.col("key").alias("window"), F.shiftright("key", 8).alias("ctx"), below.alias("below"), "c"), lower))
        table = lower if table is None else table.union(lower)
    return table


def spelling_arrays(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``spelling_table`` gives, sorted by window, for contexts that fit one task."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    cuts = np.searchsorted(keys, np.arange(DEPTH + 2) << 56)
    c = counts[: cuts[1]]
    lower_keys, lower = keys[: cuts[1]], np.log10((c + 1) / float(c.sum() + 256))
    made = []
    for k in range(1, DEPTH + 1):
        window, c = keys[cuts[k] : cuts[k + 1]], counts[cuts[k] : cuts[k + 1]].astype(np.float64)
        below = window & 255 if k == 1 else ((k - 1) << 56) | (window & ((1 << 8 * k) - 1))
        lp = lower[np.searchsorted(lower_keys, below)]
        context = window >> 8
        heads = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(window) else np.zeros(0, dtype=np.int64)
        place = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, len(window)]))
        n = np.bincount(place, c, len(heads))
        gain = np.bincount(place, np.where(c > 0, c * (np.log(np.maximum(c, 1)) - lp * math.log(10)), 0.0), len(heads))
        kept = (n >= MIN_COUNT) & (gain - n * np.log(np.maximum(n, 1)) >= MIN_GAIN)
        n, here = n[place], kept[place]
        own = np.where(c > 0, np.log10((c + SMOOTHING * np.power(10.0, lp)) / (n + SMOOTHING)), lp + np.log10(SMOOTHING / (n + SMOOTHING)))
        lower_keys, lower = window, np.where(here, own, lp)
        made.append((lower_keys, lower))
    return tuple(np.concatenate(x) for x in zip(*made, strict=True))


class SuffixTree:
    """The spelling model of a small table of contexts in memory, as ``climb`` defines it but
    for the minimum count; the tests hold the distributed tables against it.

    ``probabilities[key]`` holds those that a context saw; for others a state's ``escape``
    is added and its suffix state asked.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, min_gain: float = MIN_GAIN, smoothing: float = SMOOTHING):
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order].astype(float)
        state, symbol = keys >> 8, (keys & 255).astype(int)
        heads = np.flatnonzero(np.r_[True, state[1:] != state[:-1]]) if len(keys) else np.zeros(0, dtype=int)
        self.probabilities: dict[int, float] = {}
        self.escape: dict[int, float] = {}
        self.dense: dict[int, np.ndarray] = {}
        total = counts[state == 0].sum()
        root = np.full(256, 1.0)
        np.add.at(root, symbol[state == 0], counts[state == 0])
        self.root = np.log10(root / (total + 256))
        self.dense[0] = root / (total + 256)
        tails = np.r_[heads[1:], len(keys)][: len(heads)]
        for a, b in zip(heads.tolist(), tails.tolist(), strict=True):
            ctx = int(state[a])
            if ctx == 0:
                continue
            seen, c = symbol[a:b], counts[a:b]
            n = c.sum()
            below = self.dense[self.suffix(ctx)]
            gain = float((c * np.log(c / n / below[seen])).sum())
            if gain < min_gain:
                continue
            p = below * (smoothing / (n + smoothing))
            p[seen] += c / (n + smoothing)
            self.dense[ctx] = p.astype(np.float32)
            self.escape[ctx] = math.log10(smoothing / (n + smoothing))
            for s, q in zip(seen.tolist(), np.log10(p[seen]).tolist(), strict=True):
                self.probabilities[ctx << 8 | s] = q
        self.dense = {}

    def suffix(self, ctx: int) -> int:
        """The longest retained proper suffix of a context (0: the root)."""
        known = self.dense or self.escape
        for k in range((ctx >> 48) - 1, 0, -1):
            shorter = k << 48 | ctx & ((1 << 8 * k) - 1)
            if shorter in known:
                return shorter
        return 0

    def _next(self, recent: int, length: int, symbol: int) -> float:
        """log10 probability of a symbol after the ``length`` bytes in ``recent`` (last byte lowest)."""
        probabilities, escape, total = self.probabilities, self.escape, 0.0
        for k in range(length, 0, -1):
            ctx = k << 48 | recent & ((1 << 8 * k) - 1)
            lost = escape.get(ctx)
            if lost is None:
                continue
            p = probabilities.get(ctx << 8 | symbol)
            if p is not None:
                return total + p
            total += lost
        return total + float(self.root[symbol])

    def word(self, word: bytes) -> float:
        recent, length, total, limit = SPACE, 1, 0.0, (1 << 8 * DEPTH) - 1
        for symbol in [*word, SPACE]:
            total += self._next(recent, length, symbol)
            recent = (recent << 8 | symbol) & limit
            length = min(length + 1, DEPTH)
        return total

    def end(self) -> float:
        return self._next(SPACE, 1, END)


# -- blocks --------------------------------------------------------------------------------------


def words_of(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Word codes of all texts (the most frequent word is 0), the words, and each text's count."""
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), ""))
    lists = pc.split_pattern(pc.replace_substring_regex(texts, "[\\x09-\\x0D]", " "), " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    coded = lists.flatten().dictionary_encode()
    known, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
    full = np.array([bool(w) for w in known], dtype=bool)[codes]
    sizes = np.diff(np.concatenate([[0], np.cumsum(full)])[offsets])
    codes = codes[full]
    counts = np.bincount(codes, minlength=len(known))
    order = np.argsort(-counts, kind="stable")[: int((counts > 0).sum())]
    rank = np.zeros(max(len(known), 1), dtype=np.int32)
    rank[order] = np.arange(len(order))
    return rank[codes].astype("<i4"), [known[k] for k in order.tolist()], sizes


BLOCK_SCHEMA = "block bigint, codes binary, words binary, sizes binary, doc_ids array<bigint>, held array<boolean>, n bigint, documents bigint"


def write_blocks(docs: DataFrame, held_out: Column, path: str, table: str, key: str, text: str) -> None:
    """The blocks of all texts as a table bucketed by block, with each block's training tokens
    and documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in text_slices(batches, 2, BLOCK_BYTES):
            codes, words, sizes = words_of(batch.column(2))
            held = batch.column(1).to_pylist()
            train = ~np.array(held, dtype=bool)
            blob = zstandard.ZstdCompressor(level=1).compress("\n".join(words).encode())
            row = [block, pack(codes), blob, pack(sizes.astype("<i8")), batch.column(0).to_pylist(), held, int((sizes + 1)[train].sum()), int(train.sum())]
            types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.int64(), pa.int64()]
            names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(row, types, strict=True)], names)
            block += 1

    source = docs.select(F.col(key).cast("bigint").alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A task writes a file for each bucket that its few blocks fall in. The blobs are compressed already.
    source.mapInArrow(run, BLOCK_SCHEMA).write.bucketBy(buckets, "block").option("path", path).option("compression", "uncompressed").saveAsTable(table)


class Corpus(NamedTuple):
    """What the tasks know of the whole corpus: training tokens, distinct training tokens (0 in
    the first round), training documents, ranges of the hash, bits of a window's key, and the
    sent spelling model."""

    n: int
    v: int
    documents: int
    ranges: int
    bits: int
    spelling: Broadcast | None


class Asked(NamedTuple):
    """Distinct sorted keys of a block, and what it sends with each."""

    keys: np.ndarray
    values: tuple[np.ndarray, ...]


class Windows:
    """The windows of one order in a block: contexts (as codes, with all codes' keys) of the
    symbols at ``open``, where the context occurs often enough."""

    def __init__(self, block: Block, order: int, open_: np.ndarray, occurs: np.ndarray, code: np.ndarray, keys: np.ndarray):
        self.open, self.occurs, self.code, self.context_keys = open_, occurs, code, keys
        window = mixed(mixed(keys[code], np.full(1, order, dtype=np.uint64)), block.key[block.symbol[open_]])
        self.keys, self.first, self.back = distinct(window >> np.uint64(64 - block.corpus.bits) << np.uint64(64 - block.corpus.bits))
        self.counts = np.bincount(self.back, block.weight[open_], len(self.keys)).astype(np.int64)
        self.seen = self.speaks = None

    def know(self, answer: tuple[np.ndarray, np.ndarray]) -> Windows:
        self.seen, self.speaks = answer
        return self

    def contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of the contexts, how often they occur, and each window place's context."""
        n = np.zeros(len(self.context_keys), dtype=np.int64)
        n[self.code] = self.occurs
        present = np.flatnonzero(n)
        order = np.argsort(self.context_keys[present], kind="stable")
        place = np.empty(len(n), dtype=np.int32)
        place[present[order]] = np.arange(len(present), dtype=np.int32)
        return self.context_keys[present[order]], n[present[order]], place[self.code]


class Block:
    """The texts of one block, and what it asks in the rounds. ``answers`` holds, by round, what
    came back for the keys it sent, in their order, and which keys it speaks for alone."""

    def __init__(self, row: dict, corpus: Corpus):
        self.corpus = corpus
        self.codes, self.sizes = unpack(row["codes"], "<i4"), unpack(row["sizes"], "<i8")
        self.words = zstandard.ZstdDecompressor().decompress(row["words"]).split(b"\n") if len(self.codes) else []
        self.held = np.array(row["held"], dtype=bool)
        self.doc_ids, self.written_root = row["doc_ids"], row["root"]
        self.packed: dict[str, list[tuple[int, bytes, bytes]]] = {}
        for m in row["answers"] or []:
            self.packed.setdefault(m["round"], []).append((m["range"], m["value"], m["owned"]))
        v, total = len(self.words), len(self.sizes)
        # Codes v and v + 1: the end and the mark before a text.
        self.key = np.empty(v + 2, dtype=np.uint64)
        self.key[:v] = np.fromiter(map(hash_of, self.words), dtype=np.uint64, count=v)
        self.key[v:] = END_KEY, START_KEY
        self.by_key = np.argsort(self.key[:-1])
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.symbol = np.insert(self.codes, np.cumsum(self.sizes), v) if total else np.zeros(0, dtype=np.int32)
        self.weight = np.repeat(~self.held, self.sizes + 1)
        self._known: dict[str, object] = {}

    def answer(self, name: str, keys: np.ndarray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
        edges = np.searchsorted(range_of(keys, self.corpus.ranges), np.arange(self.corpus.ranges + 1))
        values, owned = np.zeros(len(keys), dtype=dtype), np.zeros(len(keys), dtype=bool)
        for r, value, mask in self.packed[name] if len(keys) else []:
            a, b = edges[r], edges[r + 1]
            values[a:b] = unpack(value, dtype)
            owned[a:b] = np.unpackbits(np.frombuffer(mask, dtype=np.uint8), count=b - a).astype(bool)
        return values, owned

    def _once(self, name: str, make: Callable):
        if name not in self._known:
            self._known[name] = make()
        return self._known[name]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of all words and the end, and which of them the block speaks for."""

        def make() -> tuple[np.ndarray, np.ndarray]:
            count, owned = np.empty(len(self.by_key), dtype=np.int64), np.empty(len(self.by_key), dtype=bool)
            count[self.by_key], owned[self.by_key] = self.answer("words", self.key[:-1][self.by_key], "<i8")
            return count, owned

        return self._once("words", make)

    def pairs(self) -> Windows:
        """Windows of one token of context."""

        def make() -> Windows:
            before = np.empty_like(self.symbol)
            before[1:] = self.symbol[:-1]
            before[self.starts] = len(self.words) + 1
            # A word stands before a symbol each time it occurs, the mark once a text.
            occurs = np.concatenate([self.counts()[0][:-1], [0, self.corpus.documents]])[before]
            at = np.flatnonzero(occurs >= MIN_COUNT)
            return Windows(self, 1, at, occurs[at], before[at], self.key)

        return self._once("pairs", make)

    def triples(self) -> Windows:
        """Windows of two tokens of context, which is the window one symbol earlier."""

        def make() -> Windows:
            pairs = self.known_pairs()
            window = np.full(len(self.symbol) + 1, -1, dtype=np.int32)
            window[pairs.open + 1] = pairs.back
            window = window[:-1]
            window[self.starts] = len(pairs.keys)
            seen = np.concatenate([pairs.seen, [self.corpus.documents, 0]])  # the last one for no window
            occurs = seen[window]
            at = np.flatnonzero(occurs >= MIN_COUNT)
            return Windows(self, 2, at, occurs[at], window[at], np.append(pairs.keys, STARTS_KEY))

        return self._once("triples", make)

    def known_pairs(self) -> Windows:
        return self._once("known pairs", lambda: (w := self.pairs()).know(self.answer("pairs", w.keys, "<i8")))

    def known_triples(self) -> Windows:
        return self._once("known triples", lambda: (w := self.triples()).know(self.answer("triples", w.keys, "<i8")))

    def root_of_words(self) -> np.ndarray:
        """The log10 probabilities of the words and the end by the distribution of words."""
        n, c = self.corpus.n, self.counts()[0]
        if self.corpus.spelling is not None:
            spelt = spellings(self.words, *self.corpus.spelling.value)
        else:
            spelt = np.empty(len(c))
            spelt[self.by_key] = self.answer("spelling", self.key[:-1][self.by_key], "<f8")[0]
        seen = np.log10((np.maximum(c, 1) + SMOOTHING * np.power(10.0, spelt)) / (n + SMOOTHING))
        return np.where(c > 0, seen, spelt + math.log10(SMOOTHING / (n + SMOOTHING)))

    def root(self) -> np.ndarray:
        """Of every symbol, as written by the step before the rounds that need it."""
        return self._once("root", lambda: np.frombuffer(self.written_root, dtype="<f8")[self.symbol])

    def gains(self, windows: Windows, lp: np.ndarray) -> Asked:
        """The block's share of the contexts' gain over their suffixes (from the windows it
        speaks for), and how often the contexts occur."""
        keys, n, context = windows.contexts()
        mine = np.flatnonzero(windows.speaks & (windows.seen > 0))
        c, at = windows.seen[mine], windows.first[mine]
        gain = np.bincount(context[at], c * (np.log(c) - lp[windows.open[at]] * math.log(10)), len(keys))
        return Asked(keys, (gain.astype("<f4"), n))

    def after(self, windows: Windows, name: str, lp: np.ndarray) -> np.ndarray:
        """The symbols' probabilities after the contexts of one order."""
        keys, _, context = windows.contexts()
        kept = self.answer(name, keys, "u1")[0].astype(bool)[context]
        at = windows.open[kept]
        c, n, below = windows.seen[windows.back[kept]], windows.occurs[kept], lp[at]
        out = lp.copy()
        out[at] = np.log10((c + SMOOTHING * np.power(10.0, below)) / (n + SMOOTHING))
        unseen = at[c == 0]
        out[unseen] = lp[unseen] + np.log10(SMOOTHING / (n[c == 0] + SMOOTHING))
        return out

    def ask(self, name: str) -> Asked:
        """What the block asks in a round."""
        if name == "words":
            own = np.bincount(self.symbol, self.weight, len(self.words) + 1).astype(np.int64)
            return Asked(self.key[:-1][self.by_key], (own[self.by_key],))
        if name == "spelling":  # only where the model is too large to be sent
            return Asked(self.key[:-1][self.by_key], (np.zeros(len(self.by_key)),))
        if name in ("pairs", "triples"):
            windows = self.pairs() if name == "pairs" else self.triples()
            return Asked(windows.keys, (windows.counts,))
        if name == "kept1":
            return self.gains(self.known_pairs(), self.root())
        return self.gains(self.known_triples(), self.after(self.known_pairs(), "kept1", self.root()))

    def scores(self) -> tuple[np.ndarray, ...]:
        """n_tokens, n_known, base_score and score of the block's texts."""
        count = self.counts()[0]
        base = np.log10((count + 1) / (self.corpus.n + self.corpus.v + 1))
        lp = self.after(self.known_triples(), "kept2", self.after(self.known_pairs(), "kept1", self.root()))
        of_symbol = [(count > 0).astype(np.int64)[self.symbol], base[self.symbol], lp]
        return (self.sizes + 1, *(np.add.reduceat(x, self.starts) if len(self.starts) else x for x in of_symbol))


def merged(keys: tuple[np.ndarray, ...], counts: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several lists and the sums of their counts."""
    known, _, back = distinct(np.concatenate(keys))
    return known, np.bincount(back, np.concatenate(counts), len(known)).astype(np.int64)


def spellings(words: list[bytes], windows: np.ndarray, lp: np.ndarray) -> np.ndarray:
    """The log10 probabilities of the words' spellings, and of the end."""
    end = lp[np.searchsorted(windows, 1 << 56 | SPACE << 8 | END)]
    if not words:
        return np.array([end])
    owner, keys = spelling_keys(words)
    asked, _, back = distinct(keys)
    return np.append(np.bincount(owner, lp[np.searchsorted(windows, asked)][back], len(words)), end)


# -- rounds --------------------------------------------------------------------------------------


def _blocks(blocks: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """The blocks with all answers so far. The answers move to the blocks' buckets, not the blocks."""
    if not answers:
        return blocks.withColumn("answers", F.lit(None).cast("array<struct<round:string,range:bigint,value:binary,owned:binary>>"))
    rows = answers[0]
    for other in answers[1:]:
        rows = rows.unionByName(other)
    listed = rows.groupBy("block").agg(F.collect_list(F.struct("round", "range", "value", "owned")).alias("answers"))
    return blocks.join(listed, "block", "left")


def _each(
    blocks: DataFrame, corpus: Corpus, make: Callable[[int, Block], Iterator[tuple]], schema: str, last: Callable[[], list[tuple]] = list
) -> DataFrame:
    """``make`` over all blocks, then ``last``, per task; they give tuples of columns."""
    names = [c.split()[0] for c in schema.split(", ")]

    def packed(columns: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                yield from map(packed, make(row["block"], Block(row, corpus)))
        yield from map(packed, last())

    return blocks.select("block", "codes", "words", "sizes", "doc_ids", "held", "root", "answers").mapInArrow(run, schema)


ASKED_SCHEMA = "round string, range bigint, block bigint, keys binary, first binary, second binary"
ANSWER_SCHEMA = "round string, range bigint, block bigint, value binary, owned binary, positive bigint"
#: What the tasks do with the numbers of a round: add up counts or values, or decide on contexts.
KINDS = {"words": "count", "pairs": "count", "triples": "count", "spelling": "value", "kept1": "gain", "kept2": "gain"}


def _in_ranges(name: str, block: int, asked: Asked, ranges: int) -> tuple:
    """Rows of ``ASKED_SCHEMA``, one for each range of the hash that has keys."""
    edges = np.searchsorted(range_of(asked.keys, ranges), np.arange(ranges + 1)).tolist()
    some = [r for r in range(ranges) if edges[r] < edges[r + 1]]
    spans = [(edges[r], edges[r + 1]) for r in some]
    packed = [[pack(v[a:b]) for a, b in spans] for v in asked.values]
    second = packed[1] if len(packed) > 1 else [None] * len(some)
    keys = [pack_sorted(asked.keys[a:b]) for a, b in spans]
    return pa.array([name] * len(some), pa.string()), pa.array(some, pa.int64()), pa.array([block] * len(some), pa.int64()), *(pa.array(x, pa.binary()) for x in (keys, packed[0], second))


def summed(rows: DataFrame) -> DataFrame:
    """What all blocks together say of each key, sent back to every block that asked: the sum, or
    whether a context is kept."""

    def answer(table: pa.Table) -> pa.Table:
        kind = KINDS[table.column("round")[0].as_py()]
        dtype = {"count": "<i8", "value": "<f8", "gain": "<f4"}[kind]
        table = table.sort_by("block")  # the same sums and speakers in every run
        keys = [unpack_sorted(x.as_py()) for x in table.column("keys")]
        first = np.concatenate([unpack(x.as_py(), dtype) for x in table.column("first")])
        ends = np.cumsum([len(x) for x in keys])
        whole = np.concatenate(keys)
        order = np.argsort(whole, kind="stable")
        whole = whole[order]
        heads = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]])
        total = np.add.reduceat(first[order].astype("<i8" if kind == "count" else "<f8"), heads)
        positive = int((total > 0).sum())
        if kind == "gain":
            n = np.concatenate([unpack(x.as_py(), "<i8") for x in table.column("second")])[order[heads]]
            total = ((n >= MIN_COUNT) & (total - n * np.log(n) >= MIN_GAIN)).astype("u1")
        value, owned = np.empty(len(whole), dtype=total.dtype), np.zeros(len(whole), dtype=bool)
        value[order] = np.repeat(total, np.diff(np.r_[heads, len(whole)]))
        owned[order[heads]] = True
        spans = list(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True))
        columns = [
            table.column("round"), table.column("range"), table.column("block"), pa.array([pack(value[a:b]) for a, b in spans], pa.binary()),
            pa.array([np.packbits(owned[a:b]).tobytes() for a, b in spans], pa.binary()),
            pa.array([positive, *[0] * (len(spans) - 1)], pa.int64()),
        ]
        return pa.table(columns, names=["round", "range", "block", "value", "owned", "positive"])

    return rows.groupBy("round", "range").applyInArrow(answer, ANSWER_SCHEMA)


def _round(blocks: DataFrame, answers: list[DataFrame], corpus: Corpus, *names: str, also: DataFrame | None = None) -> None:
    """Asks, sums, and adds the written answers (with rows ``also`` said by no block)."""
    spark = blocks.sparkSession
    rows = _each(_blocks(blocks, answers), corpus, lambda k, block: (_in_ranges(x, k, block.ask(x), corpus.ranges) for x in names), ASKED_SCHEMA)
    path = scratch_path(spark, f"answers-{names[0]}")
    with shuffles_removed(spark):
        summed(rows if also is None else rows.union(also)).write.parquet(path)
    answers.append(spark.read.parquet(path).where("block >= 0"))


def _contexts(blocks: DataFrame, answers: list[DataFrame], corpus: Corpus) -> DataFrame:
    """(key, c) of all byte contexts and next symbols of the distinct words, each word from
    the block that speaks for it."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def contexts(_: int, block: Block) -> Iterator[tuple]:
        count, speaks = block.counts()
        mine = np.flatnonzero(speaks[:-1]).tolist()
        if mine:
            held.append(context_keys([block.words[k] for k in mine], count[mine]))
            if len(held) > 1:  # the blocks of a task are added up
                held[:] = [merged(*zip(*held, strict=True))]
        if held and len(held[0][0]) > HELD_CONTEXTS:
            yield held.pop()

    return _each(_blocks(blocks, answers), corpus, contexts, "key bigint, c bigint", lambda: held).groupBy("key").agg(F.sum("c").alias("c"))


def _joined_spelling(blocks: DataFrame, answers: list[DataFrame], corpus: Corpus, table: DataFrame) -> DataFrame:
    """The spellings' log10 probabilities as rows of ``ASKED_SCHEMA``, from a join of the
    distinct words' byte windows with the spelling model."""

    def needed(_: int, block: Block) -> Iterator[tuple]:
        speaks = block.counts()[1]
        mine = np.flatnonzero(speaks[:-1])
        if len(mine):
            owner, keys = spelling_keys([block.words[k] for k in mine.tolist()])
            yield block.key[mine][owner].view(np.int64), keys
        if speaks[-1]:
            yield np.array([END_KEY]).view(np.int64), np.array([1 << 56 | SPACE << 8 | END])

    asked = _each(_blocks(blocks, answers), corpus, needed, "id bigint, window bigint")
    spelt = asked.join(table, "window").groupBy("id").agg(F.sum("lp").alias("spelt"))
    ranges = corpus.ranges

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = range_of(batch.column(0).to_numpy().view(np.uint64), ranges).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(where), *batch.columns], ["range", "id", "spelt"])

    def packed(rows: pa.Table) -> pa.Table:
        keys = rows.column("id").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        asked = Asked(keys[order], (rows.column("spelt").to_numpy()[order],))
        return pa.table(list(_in_ranges("spelling", -1, asked, ranges)), names=[c.split()[0] for c in ASKED_SCHEMA.split(", ")])

    return spelt.mapInArrow(place, "range bigint, id bigint, spelt double").groupBy("range").applyInArrow(packed, ASKED_SCHEMA)


SCORE_SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score_corpus(docs: DataFrame, held_out: Callable[[], Column], key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of all rows, by
    the model of the rows that are not held out."""
    spark = docs.sparkSession
    held = F.coalesce(held_out(), F.lit(False))
    table = f"encore_lm_{uuid.uuid4().hex}"
    write_blocks(docs, held, scratch_path(spark, "lm-blocks"), table, key, text)
    try:
        blocks = spark.table(table).withColumn("root", F.lit(None).cast("binary"))
        n, documents = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("documents"), F.lit(0))).first()
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // RANGE_KEYS + 1)
        bits = min(64, int(n).bit_length() + KEY_BITS)
        corpus, answers = Corpus(n, 0, documents, ranges, bits, None), []
        _round(blocks, answers, corpus, "words")
        corpus = corpus._replace(v=answers[0].agg(F.coalesce(F.sum("positive"), F.lit(0))).first()[0])
        contexts = checkpointed(_contexts(blocks, answers, corpus))
        if contexts.count() <= SPELLING_ROWS:
            known = contexts.toArrow()
            ends = np.array([END, 1 << 56 | SPACE << 8 | END])
            keys = np.concatenate([known.column("key").to_numpy(), ends])
            counts = np.concatenate([known.column("c").to_numpy(), [documents, documents]])
            corpus = corpus._replace(spelling=spark.sparkContext.broadcast(spelling_arrays(keys, counts)))
        else:
            model = spelling_table(contexts, documents)
            _round(blocks, answers, corpus, "spelling", also=_joined_spelling(blocks, answers, corpus, model))
        # Written once, bucketed like the blocks, as three steps need it.
        roots = _each(_blocks(blocks, answers), corpus, lambda k, block: [([k], [block.root_of_words().tobytes()])], "block bigint, root binary")
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        with shuffles_removed(spark):
            roots.write.bucketBy(buckets, "block").option("path", scratch_path(spark, "lm-roots")).saveAsTable(f"{table}_roots")
        blocks = spark.table(table).join(spark.table(f"{table}_roots"), "block")
        for names in (("pairs",), ("kept1", "triples"), ("kept2",)):
            _round(blocks, answers, corpus, *names)

        def score(_: int, block: Block) -> Iterator[tuple]:
            tokens, known, base, total = block.scores()
            ids = pa.array(block.doc_ids, pa.int64())
            yield ids, block.held, tokens, known, np.full(len(tokens), n, dtype=np.int64), base, total

        path = scratch_path(spark, "lm-scores")
        with shuffles_removed(spark):
            _each(_blocks(blocks, answers), corpus, score, SCORE_SCHEMA).write.parquet(path)
    finally:
        for name in (table, f"{table}_roots"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.schema(SCORE_SCHEMA).parquet(path)
