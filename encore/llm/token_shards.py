"""Token ids in binary shards, each one wavelet matrix.

A shard holds the ids of consecutive documents (in ascending id order). Its distinct ids
are numbered densely; the matrix keeps one bit plane per binary digit of these numbers,
from the highest: below each plane the tokens are ordered stably by its bit. Rank counts on
the planes answer access, counting and occurrence look-ups without unpacking the ids, and
unpacking all of them runs the planes backwards. A shard is one self-contained byte string
(header, then zstd sections), stored as one row of a Parquet table that Spark commits, so
lost executors and repeated tasks leave no half-written shards behind.

Defined results: a null or empty text has no ids but its end id; repeated ids of documents
each keep their own tokens, in the order of a hash of their texts; null ids of documents come first; documents of any length stay
whole in one shard; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.llm.byte_bpe import encoder_for
from encore.llm.common import sliced
from encore.llm.parts import text_slices
from encore.session import scratch_path

SHARD_TOKENS = 1 << 20
END_ID = 0
_MAGIC = b"WVM1"
_BLOCK = 64  # bytes of a plane between two rank samples


class WaveletMatrix:
    """Bit planes over dense codes of a token sequence."""

    def __init__(self, n: int, alphabet: np.ndarray, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.alphabet, self.planes, self.zeros = n, alphabet, planes, zeros
        self._samples: list[np.ndarray | None] = [None] * len(planes)

    @classmethod
    def build(cls, tokens: np.ndarray) -> WaveletMatrix:
        counts = np.bincount(tokens) if len(tokens) else np.zeros(0, dtype=np.int64)
        alphabet = np.flatnonzero(counts).astype(np.uint32)
        small = np.uint16 if len(alphabet) <= 1 << 16 else np.uint32
        code = np.zeros(len(counts), dtype=small)
        code[alphabet] = np.arange(len(alphabet))
        codes = code[tokens]
        planes, zeros = [], []
        for level in range(max(len(alphabet) - 1, 0).bit_length() - 1, -1, -1):
            ones = (codes >> level) & 1 == 1
            planes.append(np.packbits(ones))
            low = codes.take(np.flatnonzero(~ones))
            zeros.append(len(low))
            codes = np.concatenate([low, codes.take(np.flatnonzero(ones))])
        return cls(len(tokens), alphabet, planes, zeros)

    def decode(self) -> np.ndarray:
        """All tokens in order."""
        codes = np.zeros(self.n, dtype=np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32)
        for level, (plane, zero) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            ones = np.unpackbits(plane, count=self.n).view(bool)
            before = np.empty_like(codes)
            before[np.flatnonzero(~ones)] = codes[:zero]
            before[np.flatnonzero(ones)] = codes[zero:] | codes.dtype.type(1 << level)
            codes = before
        return self.alphabet[codes] if self.n else np.zeros(0, dtype=np.uint32)

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        plane = self.planes[level]
        if self._samples[level] is None:
            padded = np.zeros(-(-len(plane) // _BLOCK) * _BLOCK, dtype=np.uint8)
            padded[: len(plane)] = plane
            ones = np.bitwise_count(padded).reshape(-1, _BLOCK).sum(axis=1, dtype=np.int64)
            self._samples[level] = np.concatenate([[0], np.cumsum(ones)])
        byte, bit = divmod(i, 8)
        block = byte // _BLOCK
        total = int(self._samples[level][block]) + int(np.bitwise_count(plane[block * _BLOCK : byte]).sum())
        return total + (int(plane[byte] >> (8 - bit)).bit_count() if bit else 0)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (7 - (i & 7))) & 1

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for level, zero in enumerate(self.zeros):
            bit, ones = self._bit(level, i), self._rank1(level, i)
            code = code << 1 | bit
            i = zero + ones if bit else i - ones
        return int(self.alphabet[code])

    def _code(self, token: int) -> int | None:
        k = int(np.searchsorted(self.alphabet, token))
        return k if k < len(self.alphabet) and self.alphabet[k] == token else None

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int]:
        """Where the occurrences of a token among positions start..stop stand below all planes."""
        code = self._code(token)
        if code is None:
            return 0, 0
        for level, zero in enumerate(self.zeros):
            a, b = self._rank1(level, start), self._rank1(level, stop)
            one = code >> (len(self.zeros) - 1 - level) & 1
            start, stop = (zero + a, zero + b) if one else (start - a, stop - b)
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """How often a token occurs at positions ``start`` to ``stop`` (excluded)."""
        a, b = self._range(token, start, self.n if stop is None else stop)
        return b - a

    def select(self, token: int, k: int) -> int:
        """Position of the ``k``-th occurrence (from 0)."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i, code = a + k, self._code(token)
        for level in range(len(self.zeros) - 1, -1, -1):
            one = code >> (len(self.zeros) - 1 - level) & 1
            rank = i - self.zeros[level] if one else i
            low, high = 0, self.n - 1  # the least position whose bit is the rank-th of its kind
            while low < high:
                mid = (low + high) // 2
                ones = self._rank1(level, mid + 1)
                if (ones if one else mid + 1 - ones) > rank:
                    high = mid
                else:
                    low = mid + 1
            i = low
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]


def pack_shard(ids: list[int | None], sizes: list[int], tokens: np.ndarray) -> bytes:
    """A shard: documents' ids, their token counts and the wavelet matrix of all tokens."""
    matrix = WaveletMatrix.build(tokens)
    press = zstandard.ZstdCompressor(level=1).compress
    known = np.array([i is not None for i in ids], dtype=np.uint8)
    sections = [
        np.array([i or 0 for i in ids], dtype="<i8").tobytes(), known.tobytes(), np.array(sizes, dtype="<i8").tobytes(),
        matrix.alphabet.astype("<u4").tobytes(), np.array(matrix.zeros, dtype="<i8").tobytes(),
        *(p.tobytes() for p in matrix.planes),
    ]
    packed = [press(s) for s in sections]
    head = struct.pack("<4sQI", _MAGIC, matrix.n, len(packed)) + np.array([len(p) for p in packed], dtype="<u8").tobytes()
    return head + b"".join(packed)


def read_shard(blob: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    magic, n, count = struct.unpack_from("<4sQI", blob)
    if magic != _MAGIC:
        raise ValueError("not a token shard")
    at = 16
    sizes = np.frombuffer(blob, dtype="<u8", count=count, offset=at).tolist()
    at += 8 * count
    unpack, sections = zstandard.ZstdDecompressor().decompress, []
    for size in sizes:
        sections.append(unpack(blob[at : at + size]))
        at += size
    ids = np.frombuffer(sections[0], dtype="<i8").tolist()
    known = np.frombuffer(sections[1], dtype=np.uint8).tolist()
    planes = [np.frombuffer(s, dtype=np.uint8) for s in sections[5:]]
    matrix = WaveletMatrix(n, np.frombuffer(sections[3], dtype="<u4"), planes, np.frombuffer(sections[4], dtype="<i8").tolist())
    return [i if k else None for i, k in zip(ids, known, strict=True)], np.frombuffer(sections[2], dtype="<i8"), matrix


SHARD_SCHEMA = "part int, seq int, before bigint, n_docs bigint, n_tokens bigint, shard binary"
_SHARD_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def write_shards(docs: DataFrame, tokenizer_path: str, path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Writes the shards of ``docs`` to ``path``, in ascending order of ``key``.

    One range shuffle of the texts; each range is encoded, packed and written by one task,
    which holds one shard at a time. ``part`` and ``seq`` number the shards in order;
    ``before`` counts the tokens of the same part that come before a shard.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer_path)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        sizes: list[int] = []
        tokens: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal seq, before, ids, sizes, tokens
            held = sum(sizes)
            row = [part, seq, before, len(ids), held, pack_shard(ids, sizes, np.concatenate(tokens))]
            seq, before, ids, sizes, tokens = seq + 1, before + held, [], [], []
            arrays = [pa.array([v], type=t) for v, t in zip(row, _SHARD_TYPES, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in SHARD_SCHEMA.split(", ")])

        for batch in text_slices(batches, 1):
            found, each = encoder.encode(batch.column(1), end=end_id)
            ends, at, held = np.cumsum(each), 0, sum(sizes)
            while at < batch.num_rows:
                # The documents up to the one that fills the shard.
                base = int(ends[at - 1]) if at else 0
                stop = min(int(np.searchsorted(ends, base + SHARD_TOKENS - held)) + 1, batch.num_rows)
                ids += batch.column(0)[at:stop].to_pylist()
                sizes += each[at:stop].tolist()
                tokens.append(found[base : ends[stop - 1]])
                held += int(ends[stop - 1]) - base
                if held >= SHARD_TOKENS:
                    yield flush()
                    held = 0
                at = stop
        if ids:
            yield flush()

    # Rows with one id may be many: the hash of the text deals them out and orders them.
    keys = [F.col("doc_id").asc_nulls_first(), F.col("mixed").asc()]
    ordered = (
        docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
        .withColumn("mixed", F.xxhash64("text"))
        .repartitionByRange(ranges, *keys)
        .sortWithinPartitions(*keys, "text")
        .select("doc_id", "text")
    )
    # The sections are compressed already.
    ordered.mapInArrow(run, SHARD_SCHEMA).write.option("compression", "uncompressed").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, unpacked from the shards."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            part, _, before, _, _, blob = (c[0].as_py() for c in batch.columns)
            ids, sizes, matrix = read_shard(blob)
            tokens = np.ascontiguousarray(matrix.decode().astype("<u4"))
            ends = np.cumsum(sizes)
            starts = ends - sizes
            crc = [zlib.crc32(tokens[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ids), type=pa.int32()), pa.array(ids, type=pa.int64()),
                 pa.array(before + starts, type=pa.int64()), pa.array(sizes, type=pa.int64()), pa.array(crc, type=pa.int64())],
                ["part", "doc_id", "start", "n_tokens", "ids_crc32"],
            )

    found = shards.mapInArrow(run, "part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    # One row per range: the only numbers that all ranges share.
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return found.join(offsets, "part").select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Shards of ``docs`` in the checkpoint folder, and what is read back from them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-shards")
    write_shards(docs, tokenizer_path, path)
    return read_documents(spark, path)
