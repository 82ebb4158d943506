"""Near-duplicate groups from SetSketch registers.

A document's shingle set is sketched in registers: each holds, on an exponential scale, the
minimum of one hash over the set, truncated to an integer. Equal minima give equal
registers, so bands of registers find similar sets; sketches of parts merge by the register
maximum; and the counts of larger, smaller and equal registers give the likelihood of the
similarity, whose maximum screens candidates before full sets are compared.

Documents with equal sets form a class first; only class representatives are banded. Pairs
within a band's bucket are not all made. Since the answer is connected components, stars
come first: each document is screened and verified against one leader of its buckets, and
the links contract the components. Buckets that still hold several components are then
compared inside their task, first by the likelihood of the registers, then on the full
sets through an inverted index; only links that join components leave it, so no candidate
goes unchecked and no list of pairs is made. Buckets over BLOCK members are split into
pairs of blocks, which bounds what a task holds.

Two sets at the threshold share no bucket with a probability of about 5e-7 (see BANDS); a
true link is lost by the likelihood screen with less than 1e-8.

Defined results: documents without words (or null texts) have an empty set and are linked
with nothing; repeated rows of one id are one document of the same component; null ids are
kept with a null component and are linked with nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import checkpointed, map_slices, text_bytes
from encore.llm.components import components
from encore.llm.shingles import shingles
from encore.operators.joins import broadcast_if_small
from encore.session import scratch_path

#: Links need 100 * intersection >= LINK_PCT * union.
LINK_PCT = 75
ROWS = 5
#: Bands: at similarity 0.75 a pair misses all with probability (1 - 0.75^5)^BANDS = 4.5e-7.
BANDS = 54
REGISTERS = ROWS * BANDS
#: Ratio of the exponential scale; registers fit in 16 bits.
BASE = 1.001
#: Candidates whose most likely similarity is lower (six standard errors) are dropped unseen.
SCREEN = LINK_PCT / 100 - 6 * (0.75 * 0.25 / REGISTERS) ** 0.5

_rng = np.random.default_rng(20240229)
_MULTIPLIERS = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)


def sketch(values: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit hashes (at least one)."""
    least = np.empty(REGISTERS, dtype=np.uint64)
    with np.errstate(over="ignore"):
        step = max(1, (1 << 16) // len(values))
        for i in range(0, REGISTERS, step):
            part = slice(i, i + step)
            least[part] = (values[None, :] * _MULTIPLIERS[part, None] + _OFFSETS[part, None]).min(axis=1)
    minimum = -np.log1p(-np.minimum((least.astype(np.float64) + 1) / 2.0**64, 1 - 2.0**-53))
    return np.clip(np.floor(1 - np.log(minimum) / np.log(BASE)), 0, 65535).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets (for callers that keep sketches; grouping needs none)."""
    return np.maximum(a, b)


def band_keys(registers: Column) -> Column:
    """One 64-bit key for each band of a sketch column (16-bit registers as bytes)."""
    size = 2 * ROWS
    return F.array(*[F.xxhash64(F.substring(registers, 1 + size * i, size), F.lit(i)) for i in range(BANDS)])


def likely_similarity(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity given how many registers are larger and smaller in a
    than in b, and the set sizes (joint maximum likelihood, by bisection of its slope)."""
    equal = REGISTERS - larger - smaller
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    scale = (BASE - 1) / BASE
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u) - 1e-9

    def slope(j: np.ndarray) -> np.ndarray:
        x, y = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        p, q = -np.log1p(-x * scale) / np.log(BASE), -np.log1p(-y * scale) / np.log(BASE)
        dp = -v * scale / (1 - x * scale) / np.log(BASE)
        dq = -u * scale / (1 - y * scale) / np.log(BASE)
        return larger * dp / p + smaller * dq / q - equal * (dp + dq) / np.maximum(1 - p - q, 1e-12)

    for _ in range(40):
        mid = (low + high) / 2
        up = slope(mid) > 0
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    return (low + high) / 2


_SKETCHES = "doc_id bigint, n_shingles bigint, content binary, registers binary"


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Set size, fingerprint of the whole set and registers of every document (neither
    fingerprint nor registers for empty sets). Map-only."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets, _ = shingles(text_bytes(batch.column(1)))
            rows = []
            for values in map(np.unique, sets):
                if len(values):
                    registers = sketch(values)
                    content = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                    rows.append((len(values), content, registers.tobytes()))
                else:
                    rows.append((0, None, None))
            types = [pa.int64(), pa.binary(), pa.binary()]
            made = [pa.array([r[k] for r in rows], type=t) for k, t in enumerate(types)]
            return pa.RecordBatch.from_arrays([batch.column(0), *made], [c.split()[0] for c in _SKETCHES.split(", ")])

        return step

    source = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return map_slices(source, make, _SKETCHES)


def shingle_sets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, values): the sorted distinct shingle hashes as bytes."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets, _ = shingles(text_bytes(batch.column(1)))
            made = pa.array([np.unique(s).tobytes() for s in sets], type=pa.binary())
            return pa.RecordBatch.from_arrays([batch.column(0), made], ["doc_id", "values"])

        return step

    source = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return map_slices(source, make, "doc_id bigint, values binary")


#: Ids (8 bytes each) that may be sent to every task.
BROADCAST_IDS = 1_000_000
#: Members of a bucket that one task compares with as many others.
BLOCK = 2048


def screen(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose most likely similarity is not below SCREEN."""
    side = reps.select(F.col("doc_id"), F.col("n_shingles").alias("n"), F.col("registers").alias("r"))
    both = pairs.join(side.toDF("a", "n_a", "r_a"), "a").join(side.toDF("b", "n_b", "r_b"), "b")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            if not batch.num_rows:
                return batch.select(["a", "b"])
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS) for c in ("r_a", "r_b"))
            n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            j = likely_similarity((a > b).sum(axis=1), (a < b).sum(axis=1), n_a, n_b)
            return batch.select(["a", "b"]).filter(pa.array(j >= SCREEN))

        return step

    # A pair whose sizes alone forbid the similarity needs no look at the registers.
    fits = "100 * least(n_a, n_b) >= {0} * greatest(n_a, n_b)".format(LINK_PCT)
    return map_slices(both.where(fits).select("a", "b", "n_a", "r_a", "n_b", "r_b"), make, "a bigint, b bigint", 2048)


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) linked on their full sets."""
    both = pairs.join(sets.toDF("a", "v_a"), "a").join(sets.toDF("b", "v_b"), "b")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            linked = []
            for x, y in zip(batch.column("v_a").to_pylist(), batch.column("v_b").to_pylist(), strict=True):
                a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * shared >= LINK_PCT * (len(a) + len(b) - shared))
            return batch.select(["a", "b"]).filter(pa.array(linked, type=pa.bool_()))

        return step

    return map_slices(both, make, "a bigint, b bigint")


def _streamed(df: DataFrame, kernel, payload: str, schema: str) -> DataFrame:
    """Applies ``kernel(doc_ids, components, payloads)`` to each bucket part of ``df`` (key,
    part, doc_id, component, payload), sorted together; it yields (a, b) pairs."""

    def run(batches):
        held: list[tuple] = []
        current = None

        def made(found: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(a, type=pa.int64()), pa.array(b, type=pa.int64())], ["a", "b"])

        def done() -> list[tuple[int, int]]:
            return kernel([r[0] for r in held], [r[1] for r in held], [r[2] for r in held]) if len(held) > 1 else []

        for batch in batches:
            found: list[tuple[int, int]] = []
            for key, part, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, part) != current:
                    found += done()
                    current, held = (key, part), []
                held.append(tuple(row))
            if found:
                yield made(found)
        if found := done():
            yield made(found)

    ordered = df.select("key", "part", "doc_id", "component", payload).repartition("key", "part").sortWithinPartitions("key", "part")
    return ordered.mapInArrow(run, schema)


def _minor(components_of: list[int]) -> np.ndarray:
    """Members outside the largest component: every pair across components has one."""
    _, code, counts = np.unique(components_of, return_inverse=True, return_counts=True)
    return np.flatnonzero(code != counts.argmax())


def plausible(ids: list[int], components_of: list[int], payloads: list[bytes]) -> list[tuple[int, int]]:
    """(doc, doc) of each member that has a partner in another component which the registers
    do not rule out."""
    sizes = np.array([int.from_bytes(p[:8], "little") for p in payloads], dtype=float)
    registers = np.stack([np.frombuffer(p, dtype=np.uint16, offset=8) for p in payloads])
    group = np.array(components_of)
    keep = np.zeros(len(ids), dtype=bool)
    for x in _minor(components_of).tolist():
        fits = (group != group[x]) & (100 * np.minimum(sizes, sizes[x]) >= LINK_PCT * np.maximum(sizes, sizes[x]))
        y = np.flatnonzero(fits)
        if not len(y):
            continue
        # Far fewer equal registers than the screen's similarity makes likely: no need for the maximum.
        y = y[(registers[y] == registers[x]).sum(axis=1) >= REGISTERS * (SCREEN - 0.1)]
        if not len(y):
            continue
        larger, smaller = (registers[x] > registers[y]).sum(axis=1), (registers[x] < registers[y]).sum(axis=1)
        y = y[likely_similarity(larger, smaller, np.full(len(y), sizes[x]), sizes[y]) >= SCREEN]
        if len(y):
            keep[x] = True
            keep[y] = True
    return [(ids[i], ids[i]) for i in np.flatnonzero(keep).tolist()]


def links_between(ids: list[int], components_of: list[int], payloads: list[bytes]) -> list[tuple[int, int]]:
    """Links on full sets that join components, at most one for each joining."""
    sets = [np.frombuffer(p, dtype=np.uint64) for p in payloads]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(code, kind="stable")
    holders = owner[order]
    first = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(values)))])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    root = {c: c for c in components_of}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    found = []
    for x in _minor(components_of).tolist():
        own = code[begin[x] : begin[x + 1]]
        spans = first[own + 1] - first[own]
        heads = np.cumsum(spans) - spans
        shared = np.bincount(holders[np.repeat(first[own] - heads, spans) + np.arange(spans.sum())], minlength=len(sets))
        for y in np.flatnonzero(100 * shared >= LINK_PCT * (sizes[x] + sizes - shared)).tolist():
            a, b = find(components_of[x]), find(components_of[y])
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((ids[x], ids[y]))
    return found


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written once as Parquet in the checkpoint folder; readers prune its columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest
    document that it reaches over links, itself included) and ``kept``."""
    sk = _stored(sketches(docs, key, text), "sketches")
    known = sk.where("content is not null and doc_id is not null")
    classes = _stored(known.groupBy("content").agg(F.min("doc_id").alias("rep")), "classes")
    reps = _stored(
        known.join(classes.select("content", F.col("rep").alias("doc_id")), ["content", "doc_id"], "left_semi")
        .dropDuplicates(["content", "doc_id"])
        .drop("content"),
        "representatives",
    )
    # Buckets with several documents, each with its leader: the least of its ids.
    rows = reps.select(F.explode(band_keys(F.col("registers"))).alias("key"), "doc_id")
    shared = rows.groupBy("key").agg(F.min("doc_id").alias("lead"), F.count(F.lit(1)).alias("members")).where("members > 1")
    members = _stored(rows.join(_stored(shared, "buckets"), "key"), "members")

    # The ids go to every task where they are few; elsewhere the texts are shuffled to them.
    needed = broadcast_if_small(_stored(members.select("doc_id").distinct(), "needed"), BROADCAST_IDS)
    source = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sets = _stored(shingle_sets(source.join(needed, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])), "sets")

    # Stars: every document with the leader that comes first among those of its buckets.
    pairs = members.where("doc_id <> lead").groupBy(F.col("doc_id").alias("a")).agg(F.min("lead").alias("b"))
    links = checkpointed(verify(screen(pairs, reps), sets))
    joined = components(links)

    # Buckets with several components, in parts of bounded size.
    tagged = members.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "key", "doc_id", "members", F.coalesce("component", "doc_id").alias("component")
    )
    mixed = tagged.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("blocks")).cast("int")
    parts = "transform(sequence(0, blocks - 1), j -> least(own, j) * blocks + greatest(own, j))"
    open_rows = _stored(
        tagged.join(mixed, "key").withColumn("blocks", blocks).withColumn("own", own)
        .select("key", F.explode(F.expr(parts)).alias("part"), "doc_id", "component"), "open-rows"
    )
    size = F.unhex(F.regexp_replace(F.lpad(F.hex("n_shingles"), 16, "0"), "(..)(..)(..)(..)(..)(..)(..)(..)", "$8$7$6$5$4$3$2$1"))
    payload = reps.select("doc_id", F.concat(size, "registers").alias("payload"))
    likely = _streamed(open_rows.join(payload, "doc_id"), plausible, "payload", "a bigint, b bigint")
    left = checkpointed(likely.select(F.col("a").alias("doc_id")).distinct())
    rest = open_rows.join(left, "doc_id", "left_semi").join(sets, "doc_id")
    more = _streamed(rest, links_between, "values", "a bigint, b bigint")

    # Classes join through their representatives: their other members point at these.
    final = components(links.union(more))
    of_class = classes.join(final.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "content", F.coalesce("component", "rep").alias("class_component")
    )
    out = sk.select("doc_id", "n_shingles", "content").join(of_class, "content", "left")
    component = F.coalesce("class_component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
