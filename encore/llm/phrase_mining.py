"""Phrases that hold together, mined set by set from sorted occurrence relations.

The first relation holds every word's place: texts are split into pieces and words, and the
words of some millions of places, in the order of pieces and positions, form a block. Blocks
are written once, bucketed by their number, so that no later step moves them. The relation
of length k + 1 joins a block's places of length k with those one position on, which is a
merge over the sorted places; its groups are counted over all blocks; a semi-join with
the groups that are frequent leaves the places that the next length extends.

Counting sends the distinct groups of a block, by 64-bit hashes in ranges of the hash, to
tasks that sum them, and gets back one bit per group: whether it is frequent. So a group's
rows are as many as the blocks that hold it, however common it is, and the relations'
places never leave their blocks. Frequent groups are named once, by the first block that
holds them; scores and the final choice are joins on (lang, phrase).

Defined results: a null text counts as empty, a null lang as ``und``; repeated rows count;
languages with the same counts are ranked alike in any run (ties by phrase in UTF-8 order);
texts of any length are read whole; an empty table gives an empty result; other columns are
ignored. Hashes of two groups of a corpus with a billion frequent ones and a trillion others
collide with a chance below one in ten thousand for each frequent one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.parts import text_slices
from encore.session import scratch_path

#: Occurrences that a candidate needs, and the lengths of candidates.
MIN_COUNT, MIN_WORDS, MAX_WORDS = 30, 2, 4
#: A candidate goes if a longer one around it has this share (in percent) of its occurrences.
ABSORBED_PCT = 80
SCALE, TOP = 2_000_000, 2000
NO_LANG = "und"
#: Bytes of text in a block, and distinct groups that one counting task holds at a time.
BLOCK_BYTES, RANGE_KEYS = 8 << 20, 4_000_000
_BREAK = -1


# -- packing ---------------------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes (small and repeated values take few bytes)."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, dtype: str) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(data.reshape(size, -1).T).view(dtype).reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, "<u8"), dtype=np.uint64)


# -- the first relation ------------------------------------------------------------------------


def places(texts: pa.Array, langs: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], list[str], np.ndarray]:
    """Word codes of all places of texts (a break after each piece), and of each code its
    language's index and its word, the languages, and how many words each has."""
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), ""))
    texts = pc.replace_substring_regex(texts, "[.,;:!?\\x0A-\\x0D]", " \n ")
    lists = pc.split_pattern(pc.replace_substring(texts, "\t", " "), " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    coded = lists.flatten().dictionary_encode()
    known = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    spoken = pc.fill_null(langs.cast(pa.string()), NO_LANG).dictionary_encode()
    names = spoken.dictionary.to_pylist()
    special = {"": -2, "\n": _BREAK}
    kind = np.array([special.get(w, k) for k, w in enumerate(known)], dtype=np.int64)
    codes = kind[coded.indices.to_numpy()]
    of_text = np.repeat(spoken.indices.to_numpy().astype(np.int64), np.diff(offsets))
    mixed = np.where(codes >= 0, of_text * max(len(known), 1) + codes, codes)
    mixed = np.insert(mixed, offsets[1:], _BREAK)
    mixed = mixed[mixed != -2]
    distinct, back, counts = np.unique(mixed, return_inverse=True, return_counts=True)
    first = int(np.searchsorted(distinct, 0))  # the break comes before all words
    order = np.argsort(-counts[first:], kind="stable")
    rank = np.empty(len(distinct), dtype=np.int32)
    rank[:first] = _BREAK
    rank[first + order] = np.arange(len(order))
    words = distinct[first:][order]
    lang = words // max(len(known), 1)
    spelled = [known[w] for w in (words % max(len(known), 1)).tolist()]
    n = np.bincount(lang, counts[first:][order], len(names)).astype(np.int64)
    return rank[back].astype("<i4"), lang.astype("<u4"), spelled, names, n


BLOCK_SCHEMA = "block bigint, places binary, of_lang binary, words binary, langs array<string>, n array<bigint>"


def write_blocks(docs: DataFrame, path: str, table: str, lang: str, text: str) -> None:
    """The blocks of all texts as a table bucketed by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in text_slices(batches, 0, BLOCK_BYTES):
            codes, of_lang, spelled, names, n = places(batch.column(0), batch.column(1))
            words = zstandard.ZstdCompressor(level=1).compress("\n".join(spelled).encode())
            row = [block, pack(codes), pack(of_lang), words, names, n.tolist()]
            types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
            arrays = [pa.array([v], type=t) for v, t in zip(row, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "places", "of_lang", "words", "langs", "n"])
            block += 1

    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).mapInArrow(run, BLOCK_SCHEMA)
    # The blobs are compressed already.
    made.repartition(buckets, "block").write.bucketBy(buckets, "block").option("path", path).option("compression", "uncompressed").saveAsTable(table)


# -- relations of longer groups ----------------------------------------------------------------


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The range of the hash that a key lies in; ascending with the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


class Block:
    """The sorted places of one block, and its relations length by length."""

    def __init__(self, row: dict):
        self.codes = unpack(row["places"], "<i4")
        self.lang = unpack(row["of_lang"], "<u4")
        blob = zstandard.ZstdDecompressor().decompress(row["words"])
        self.words = blob.split(b"\n") if len(self.lang) else []
        self.langs = [x.encode() + b"\t" for x in row["langs"]]
        langs, digest = [self.langs[i] for i in self.lang.tolist()], xxhash.xxh3_64_intdigest
        self.hashes = np.array([digest(a + w) for a, w in zip(langs, self.words, strict=True)], dtype=np.uint64)
        self.word_at = np.flatnonzero(self.codes >= 0)

    def relations(self, masks: dict[int, list[tuple[int, bytes, bytes]]], ranges: int, upto: int) -> Iterator[tuple]:
        """(length, distinct keys, place of each key's first occurrence, counts, frequent,
        owned) of lengths 1 to ``upto``; the last two are None where no masks are known."""
        at = self.word_at
        keys = self.hashes[self.codes[at]]
        for k in range(1, upto + 1):
            distinct, first, back, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            frequent = owned = None
            if k in masks:
                bits = [np.zeros(len(distinct), dtype=bool), np.zeros(len(distinct), dtype=bool)]
                edges = np.searchsorted(range_of(distinct, ranges), np.arange(ranges + 1))
                for r, *found in masks[k]:
                    a, b = edges[r], edges[r + 1]
                    for whole, mask in zip(bits, found, strict=True):
                        whole[a:b] = np.unpackbits(np.frombuffer(mask, dtype=np.uint8), count=b - a).astype(bool)
                frequent, owned = bits
            yield k, distinct, at[first], counts, frequent, owned
            if k == upto:
                return
            if frequent is None:  # a block without groups of this length has no masks of it
                frequent = np.zeros(len(distinct), dtype=bool)
            # Places of frequent groups whose next position holds one, too, in the same piece.
            alive = frequent[back]
            at, keys = at[alive], keys[alive]
            joined = np.flatnonzero(at[1:] == at[:-1] + 1)
            at = at[joined]
            keys = mixed(keys[joined], self.hashes[self.codes[at + k]])

    def phrase(self, at: int, length: int) -> str:
        return b" ".join([self.words[c] for c in self.codes[at : at + length].tolist()]).decode()


COUNT_SCHEMA = "range bigint, block bigint, keys binary, counts binary"


def _with_masks(blocks: DataFrame, found: list[DataFrame], how: str = "left") -> DataFrame:
    """The blocks with all their masks. The masks move to the blocks' buckets, not the blocks."""
    kept = F.struct("length", "range", "frequent", "owned", "f")
    if not found:
        return blocks.withColumn("masks", F.lit(None).cast("array<struct<length:int,range:bigint,frequent:binary,owned:binary,f:binary>>"))
    rows = found[0]
    for other in found[1:]:
        rows = rows.unionByName(other)
    return blocks.join(rows.groupBy("block").agg(F.collect_list(kept).alias("masks")), "block", how)


def _masks(row: dict) -> dict[int, list[tuple[int, bytes, bytes]]]:
    out: dict[int, list[tuple[int, bytes, bytes]]] = {}
    for m in row["masks"] or []:
        out.setdefault(m["length"], []).append((m["range"], m["frequent"], m["owned"]))
    return out


def distinct_groups(blocks: DataFrame, ranges: int, length: int) -> DataFrame:
    """The distinct groups of ``length`` words of every block, by ranges of their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                *_, (_, keys, _, counts, _, _) = Block(row).relations(_masks(row), ranges, length)
                edges = np.searchsorted(range_of(keys, ranges), np.arange(ranges + 1)).tolist()
                some = [r for r in range(ranges) if edges[r] < edges[r + 1]]
                counts = counts.astype("<u4")
                made = [
                    pa.array(some, pa.int64()), pa.array([row["block"]] * len(some), pa.int64()),
                    pa.array([pack_sorted(keys[edges[r] : edges[r + 1]]) for r in some], pa.binary()),
                    pa.array([pack(counts[edges[r] : edges[r + 1]]) for r in some], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(made, ["range", "block", "keys", "counts"])

    return blocks.select("block", "places", "of_lang", "words", "langs", "masks").mapInArrow(run, COUNT_SCHEMA)


FOUND_SCHEMA = "range bigint, block bigint, frequent binary, owned binary, f binary"


def count_groups(groups: DataFrame, min_count: int) -> DataFrame:
    """Of every block and range: which of its groups are frequent, in the order of their
    keys, which of these it names (as the first block that holds them), and their counts."""

    def count(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")  # the same owner in every run
        keys = [unpack_sorted(x.as_py()) for x in table.column("keys")]
        counts = np.concatenate([unpack(x.as_py(), "<u4") for x in table.column("counts")]).astype(np.int64)
        sizes = np.array([len(x) for x in keys])
        order = np.argsort(whole := np.concatenate(keys), kind="stable")
        whole = whole[order]
        heads = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]])
        total = np.add.reduceat(counts[order], heads)
        frequent, owned = np.zeros(len(whole), dtype=bool), np.zeros(len(whole), dtype=bool)
        frequent[order] = np.repeat(total >= min_count, np.diff(np.r_[heads, len(whole)]))
        owners = order[heads[total >= min_count]]
        owned[owners] = True
        f = np.zeros(len(whole), dtype="<i8")
        f[owners] = total[total >= min_count]
        ends = np.cumsum(sizes)
        slices = list(zip((ends - sizes).tolist(), ends.tolist(), strict=True))
        columns = [
            table.column("range"), table.column("block"),
            pa.array([np.packbits(frequent[a:b]).tobytes() for a, b in slices], pa.binary()),
            pa.array([np.packbits(owned[a:b]).tobytes() for a, b in slices], pa.binary()),
            pa.array([pack(f[a:b][owned[a:b]]) for a, b in slices], pa.binary()),
        ]
        return pa.table(columns, names=["range", "block", "frequent", "owned", "f"])

    return groups.groupBy("range").applyInArrow(count, FOUND_SCHEMA)


def named_groups(blocks: DataFrame, ranges: int, max_words: int) -> DataFrame:
    """(lang, phrase, words, f): every frequent group once, from the block that names it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                block, masks = Block(row), _masks(row)
                counted = {(m["length"], m["range"]): m["f"] for m in row["masks"] or []}
                for length, keys, first, _, _, owned in block.relations(masks, ranges, max_words):
                    if owned is None or not owned.any():
                        continue
                    first = first[owned].tolist()
                    parts = [counted[length, r] for r in sorted(r for n, r in counted if n == length)]
                    f = np.concatenate([unpack(x, "<i8") for x in parts])
                    made = [
                        pa.array([row["langs"][block.lang[block.codes[p]]] for p in first], pa.string()),
                        pa.array([block.phrase(p, length) for p in first], pa.string()),
                        pa.array([length] * len(first), pa.int32()), pa.array(f),
                    ]
                    yield pa.RecordBatch.from_arrays(made, ["lang", "phrase", "words", "f"])

    return blocks.select("block", "places", "of_lang", "words", "langs", "masks").mapInArrow(run, "lang string, phrase string, words int, f bigint")


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All frequent groups of 1 to ``max_words`` words (lang, phrase, words, f), and the count
    of all word occurrences (lang, n), both written to the checkpoint folder."""
    spark = docs.sparkSession
    table = f"encore_blocks_{uuid.uuid4().hex}"
    write_blocks(docs, scratch_path(spark, "blocks"), table, lang, text)
    try:
        blocks = spark.table(table)
        totals = blocks.select(F.explode(F.arrays_zip("langs", "n")).alias("x")).groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.n").alias("n"))
        totals_path = scratch_path(spark, "words-by-lang")
        totals.where("n > 0").write.parquet(totals_path)
        totals = spark.read.parquet(totals_path)
        words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words // RANGE_KEYS + 1)
        found: list[DataFrame] = []
        for length in range(1, max_words + 1):
            path = scratch_path(spark, f"groups-{length}")
            count_groups(distinct_groups(_with_masks(blocks, found), ranges, length), min_count).write.parquet(path)
            found.append(spark.read.parquet(path).withColumn("length", F.lit(length)))
        named_path = scratch_path(spark, "phrases")
        named_groups(_with_masks(blocks, found, "inner"), ranges, max_words).write.parquet(named_path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return spark.read.parquet(named_path), totals


# -- scores --------------------------------------------------------------------------------------


def _between(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def collocations(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer candidate absorbs, by
    their lowest-scoring cut (the earliest of these)."""
    listed = phrases.where(F.col("words") >= MIN_WORDS).select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    size = F.size("w")
    starts, sizes = F.sequence(F.lit(1), size), F.sequence(F.lit(MIN_WORDS), size - 1)
    inner = F.flatten(F.transform(sizes, lambda n: F.transform(F.filter(starts, lambda s: s + n - 1 <= size), lambda s: _between(F.col("w"), s, n))))
    around = listed.where(size > MIN_WORDS).select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a")
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = listed.join(around, ["lang", "phrase"], "left")
    kept = kept.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * ABSORBED_PCT)).drop("longer")
    cuts = kept.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _between(F.col("w"), F.lit(1), F.col("k")).alias("left"), _between(F.col("w"), F.col("k") + 1, size).alias("right"))
    f = phrases.select("lang", F.col("phrase").alias("part"), "f")
    cuts = cuts.join(f.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(f.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    # Decimals: the product may pass 64 bits. ``div`` gives the floor of the exact quotient.
    score = F.expr(f"(cast(a AS decimal(20, 0)) * {SCALE}) div (cast(l AS decimal(20, 0)) + r)")
    cuts = cuts.withColumn("score", score)
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"))


def mine(docs: DataFrame, top: int = TOP, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases."""
    phrases, totals = frequent_phrases(docs, lang=lang, text=text)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = collocations(phrases).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
