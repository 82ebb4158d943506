"""Benchmark decontamination by SimHash of item-sized windows.

Each benchmark item has a SimHash fingerprint over its word shingles; so has each window of
a document that is as long as an item. An index of fingerprint blocks finds all items
within a Hamming radius of a window: with ``BLOCKS`` blocks, fingerprints at distance
``RADIUS`` or less differ by at most ``RADIUS // BLOCKS`` bits in one block. Candidates are
verified by the exact weighted similarity of their shingles (shared weight over total
weight, a shingle weighing as often as it occurs).

A window is looked at for the items whose shingles it holds, and only if it holds so many of
an item's that the similarity can reach the threshold. Such windows are fingerprinted some
thousands at a time, whatever a text's length, and those within the radius are compared with
counts that roll from window to window. Words are compared without case and ASCII
punctuation. Items and windows at similarity 0.75 lie within the radius with a probability
of about 0.99995.

The items are the stated queries of this search: each distinct item's text is sent to the
tasks in passes of about ``ITEMS_PER_PASS`` items and ``ITEM_BYTES`` bytes, each pass over all
documents; only one pass's items are held at a time.

Defined results: null or blank texts match nothing; an item with fewer words than a shingle
is one shingle and is found only as a whole document of those words; a document shorter
than an item is compared as a whole; repeated rows and equal items each have their own
results; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm.common import fresh, map_slices, text_bytes
from encore.llm.shingles import ALNUM, mix, shingles
from encore.session import scratch_path

THRESHOLD = 0.75
RADIUS = 23
BLOCKS = 8
ITEMS_PER_PASS, ITEM_BYTES = 4096, 16 << 20
#: Windows fingerprinted together.
WINDOWS = 8192
_BITS = np.arange(64, dtype=np.uint64)


def signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of every hash."""
    return (((hashes[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) << 1) - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """SimHash from the summed signs of each row; ties count as ones."""
    return ((sums >= 0).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)


class BlockIndex:
    """For every block of the fingerprint and every value of it, the items whose block
    differs by at most ``RADIUS // BLOCKS`` bits."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        values = np.arange(256, dtype=np.uint8)
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= RADIUS // BLOCKS
        self.blocks = [near[:, self._block(prints, b)] for b in range(BLOCKS)]

    @staticmethod
    def _block(prints: np.ndarray, b: int) -> np.ndarray:
        return ((prints >> np.uint64(8 * b)) & np.uint64(255)).astype(np.int64)

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, item) of all pairs within the radius."""
        found = np.zeros((len(prints), len(self.prints)), dtype=bool)
        for b, table in enumerate(self.blocks):
            found |= table[self._block(prints, b)]
        rows, items = np.nonzero(found)
        close = np.bitwise_count(prints[rows] ^ self.prints[items]) <= RADIUS
        return rows[close], items[close]

    def near(self, prints: np.ndarray, item: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows within the radius of one item, and their distances."""
        found = np.zeros(len(prints), dtype=bool)
        for b, table in enumerate(self.blocks):
            found |= table[self._block(prints, b), item]
        rows = np.flatnonzero(found)
        distance = np.bitwise_count(prints[rows] ^ self.prints[item])
        close = distance <= RADIUS
        return rows[close], distance[close]


def similarity(a: Counter, b: Counter) -> float:
    """Shared weight over total weight of two weighted sets."""
    shared = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


class Benchmark:
    """Fingerprints and shingles of a bounded list of items."""

    def __init__(self, ids: list, texts: list[bytes]):
        sets, self.words = shingles(texts, ALNUM)
        usable = [k for k, s in enumerate(sets) if len(s)]
        self.ids = [ids[k] for k in usable]
        self.sets = [sets[k] for k in usable]
        self.words = self.words[usable]
        self.lengths = np.array([len(s) for s in self.sets], dtype=np.int64)
        prints = [fingerprints(signs(mix(s)).sum(axis=0)[None, :])[0] for s in self.sets]
        self.index = BlockIndex(np.array(prints, dtype=np.uint64))
        self.values, code = np.unique(np.concatenate([*self.sets, np.zeros(0, dtype=np.uint64)]), return_inverse=True)
        self.filter = np.zeros(1 << 22, dtype=bool)
        self.filter[self.values >> np.uint64(42)] = True
        # Of each item its distinct shingles (places in ``values``) and their weights; of each shingle its items.
        cuts = np.cumsum([0, *self.lengths.tolist()])
        self.members = [np.unique(code[a:b], return_counts=True) for a, b in pairwise(cuts.tolist())]
        holder = np.repeat(np.arange(len(self.members)), [len(m) for m, _ in self.members])
        value = np.concatenate([*(m for m, _ in self.members), np.zeros(0, dtype=np.int64)])
        self.holders = holder[np.argsort(value, kind="stable")]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(value, minlength=len(self.values)))])

    def held(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the shingles that some item has, and their places in ``values``."""
        at = np.flatnonzero(self.filter[hashes >> np.uint64(42)])
        if not len(at):
            return at, at
        place = np.minimum(np.searchsorted(self.values, hashes[at]), len(self.values) - 1)
        same = self.values[place] == hashes[at]
        return at[same], place[same]

    def search(self, hashes: np.ndarray, at: np.ndarray, place: np.ndarray) -> list[tuple]:
        """Best window of a document for each item: (item, first word, similarity, distance)."""
        known = np.unique(place)
        spans = self.first[known + 1] - self.first[known]
        heads = np.cumsum(spans) - spans
        items = np.unique(self.holders[np.repeat(self.first[known] - heads, spans) + np.arange(spans.sum())])
        own = np.full(len(self.values), -1, dtype=np.int32)
        found = []
        for i in items.tolist():
            members, weights = self.members[i]
            own[members] = np.arange(len(members), dtype=np.int32)
            code = own[place]
            own[members] = -1
            hit = code >= 0
            best = self._best(i, weights, hashes, at[hit], code[hit])
            if best:
                found.append(best)
        return found

    def _best(self, i: int, weights: np.ndarray, hashes: np.ndarray, hits: np.ndarray, code: np.ndarray) -> tuple | None:
        n, size = len(hashes), int(self.lengths[i])
        width = min(size, n)  # a shorter document is one window
        # The least shared weight that reaches the threshold, and as many hits hold it.
        need = max(1, math.ceil(THRESHOLD * (width + size) / (1 + THRESHOLD) - 1e-9))
        if len(hits) < need:
            return None
        first, last = hits[: len(hits) - need + 1], hits[need - 1 :]
        dense = last - first < width
        low, high = np.maximum(last[dense] - width + 1, 0), np.minimum(first[dense], n - width)
        best = None
        for a, b in _ranges(low, high):
            window = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs(mix(hashes[a : b + width])), axis=0)])
            rows, distances = self.index.near(fingerprints(window[width:] - window[:-width]), i)
            if not len(rows):
                continue
            shared = _rolled(hits, code, weights, (a + rows).tolist(), width)
            for row, d, common in zip(rows.tolist(), distances.tolist(), shared, strict=True):
                s = common / (width + size - common)
                if s >= THRESHOLD and (best is None or s > best[2]):
                    best = (i, a + row, s, d)
            if best and best[2] == 1.0:  # no later window is better
                break
        return best


def _ranges(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, int]]:
    """The union of the ranges low..high (both included, both ascending) in pieces (a, b) of at
    most WINDOWS numbers, b included."""
    some = low <= high
    low, high = low[some], high[some]
    if not len(low):
        return
    reach = np.maximum.accumulate(high)
    cuts = np.flatnonzero(low[1:] > reach[:-1] + 1) + 1
    for a, b in zip(low[np.concatenate([[0], cuts])].tolist(), reach[np.concatenate([cuts - 1, [len(low) - 1]])].tolist(), strict=True):
        for at in range(a, b + 1, WINDOWS):
            yield at, min(at + WINDOWS - 1, b)


def _rolled(hits: np.ndarray, code: np.ndarray, weights: np.ndarray, starts: list[int], width: int) -> list[int]:
    """The weight that each window (ascending starts) shares with an item; the counts of the
    item's shingles roll from one window to the next."""
    a, b = np.searchsorted(hits, [starts[0], starts[-1] + width]).tolist()
    places, codes, weight = hits[a:b].tolist(), code[a:b].tolist(), weights.tolist()
    count, shared, come, gone, out = [0] * len(weight), 0, 0, 0, []
    for start in starts:
        while come < len(places) and places[come] < start + width:
            c = codes[come]
            count[c] += 1
            shared += count[c] <= weight[c]
            come += 1
        while gone < come and places[gone] < start:
            c = codes[gone]
            shared -= count[c] <= weight[c]
            count[c] -= 1
            gone += 1
        out.append(shared)
    return out


_FOUND = T.ArrayType(
    T.StructType()
    .add("item_id", "long")
    .add("first_word", "long")
    .add("n_words", "long")
    .add("similarity", "double")
    .add("distance", "integer")
)


def _found_in(docs: DataFrame, sent: Broadcast, text: str, name: str) -> DataFrame:
    """``docs`` with the array column ``name`` of the matching items of one pass. Map-only."""
    struct = pa.struct([("item_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("similarity", pa.float64()), ("distance", pa.int32())])

    def make():
        bench = sent.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets, _ = shingles(text_bytes(batch.column(text)), ALNUM)
            cuts = np.cumsum([0, *map(len, sets)])
            none = np.zeros(0, dtype=np.int64)
            at, place = bench.held(np.concatenate(sets)) if sets and len(bench.ids) else (none, none)
            owner = np.searchsorted(cuts, at, side="right") - 1
            found: list[list] = [[] for _ in sets]
            for d in np.unique(owner).tolist():
                found[d] = [
                    {"item_id": bench.ids[i], "first_word": a, "n_words": int(bench.words[i]), "similarity": s, "distance": h}
                    for i, a, s, h in bench.search(sets[d], at[owner == d] - cuts[d], place[owner == d])
                ]
            made = pa.array(found, type=pa.list_(struct))
            return pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, name])

        return step

    return map_slices(docs, make, T.StructType([*docs.schema.fields, T.StructField(name, _FOUND)]))


def _passed(docs: DataFrame, items: DataFrame, text: str, name: str, kept: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``kept`` of the documents with their finds, over all ``items`` (id, text; texts distinct).

    Items that fit one pass are one step of the caller's plan. More are taken in passes, one
    after the other: a pass writes its result to the checkpoint folder, and its items and
    their broadcast are released before the next.
    """
    spark = docs.sparkSession
    passes = _passes(items)
    root = scratch_path(spark, "decontamination")
    for k in range(passes):
        part = items if passes == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(passes)) == k)
        rows = part.collect()
        sent = spark.sparkContext.broadcast(Benchmark([r["id"] for r in rows], [r["text"].encode() for r in rows]))
        out = kept(_found_in(docs, sent, text, name))
        if passes == 1:
            return out
        out.write.parquet(f"{root}/{k}")
        sent.destroy()
    return spark.read.schema(out.schema).parquet(*[f"{root}/{k}" for k in range(passes)])


def _passes(items: DataFrame) -> int:
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    full = max(1, -(-n // ITEMS_PER_PASS), -(-size // ITEM_BYTES))
    return full if full == 1 else full * 2 - 1  # hashed parts vary in size


def _distinct(benchmark: DataFrame, item: str) -> tuple[DataFrame, DataFrame]:
    """The distinct texts with a key each (a hash), and all (id, item_id) pairs of key and item."""
    rows = benchmark.select(F.col(item).cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("id", F.xxhash64("text"))
    return rows.select("id", "text").distinct(), rows.select("id", "item_id")


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """One row per document and matching item: doc_id, item_id, the best window's first word
    and length, its similarity and its Hamming distance."""
    source = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    texts, ids = _distinct(benchmark, item)
    found = _passed(source, texts, "text", "found", lambda found: found.where(F.size("found") > 0).select("doc_id", F.inline("found")))
    # Equal items each have the result of their text.
    named = found.withColumnRenamed("item_id", "id").join(ids, "id")
    return named.select("doc_id", "item_id", "first_word", "n_words", "similarity", "distance")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """The documents (all columns) that hold no benchmark item."""
    name = fresh(docs, "_found")
    texts, _ = _distinct(benchmark, item)
    if _passes(texts) == 1:
        return _passed(docs, texts, text, name, lambda found: found.where(F.size(name) == 0).drop(name))
    # What a document holds depends on its text alone: passes write the digests of texts with finds.
    digest = F.sha2(F.col(f"`{text}`").cast("binary"), 256)
    source = docs.select(F.col(f"`{text}`").alias("text"))
    leaks = _passed(source, texts, "text", "found", lambda found: found.where(F.size("found") > 0).select(F.sha2(F.col("text").cast("binary"), 256).alias(name)))
    return docs.withColumn(name, digest).join(leaks, name, "left_anti").select(*[f"`{c}`" for c in docs.columns])
