"""Alignment of two tokenizers' tokens over the same bytes, and counts of linked tokens.

Tokens of a text end at byte offsets. Each tokenizer's ends are kept in a dictionary from end
to token index (a table over the bytes of some texts, as ends are dense). The sorted common
keys cut both id lists into groups; within a group the tokens that end together are linked.

Texts are encoded once and their ids written to the checkpoint folder. How often each pair
of ids is linked is counted over all texts, in the tasks and then by one shuffle of distinct
pairs. That table cannot outgrow the vocabularies: tokens that end at the same byte cover
the same last bytes, so the shorter one is a suffix of the longer, and the pairs are at
most twice the vocabularies' bytes (under a million for the usual ones). It is sent to the
tasks that align the written ids.

Defined results: the first tokenizer reads a space and the text, the second the text (it adds
the space itself); texts that are null, empty, or that one of the tokenizers does not give
back byte by byte have no tokens; special tokens' strings are plain text; repeated rows count
and are aligned each for itself; texts of any length are read whole; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.byte_bpe import encoder_for
from encore.llm.parts import Memory, cut, gather, text_slices
from encore.session import scratch_path

SPACE = "▁"
#: Distinct pairs held by a counting task before they are merged, and bytes of ids aligned together.
_HELD_PAIRS, _ID_BYTES = 500_000, 1 << 20
#: Bytes of text encoded together, and runs and parts kept per generation of the two memories.
_TEXT_BYTES, _KEPT = 2 << 20, 50_000


class Encoders:
    """A byte-level BPE file (a) and a SentencePiece model file (b), and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        self.a = encoder_for(a_path, True, _KEPT)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        a_bytes = self.a.vocabulary()
        self.a_size = np.array(list(map(len, a_bytes)), dtype=np.int64)
        self.b_size = np.array(list(map(len, self.b_bytes)), dtype=np.int64)
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError("pieces that hold a space mark behind other text cannot be encoded by parts")
        if not {bytes([x]) for x in range(256)}.issubset(a_bytes) or min(self.a_size.min(), self.b_size.min()) < 1:
            raise ValueError("the first vocabulary must spell every byte, and every token must have bytes")
        self.parts = Memory(self._learn, _KEPT)

    def _learn(self, parts: list[str]) -> list[bytes]:
        """Packed ids of b, none for a part that they do not give back."""
        known, out = self.b_bytes, []
        for part, ids in zip(parts, self.b.encode(parts, num_threads=1), strict=True):
            same = b"".join([known[i] for i in ids]) == b" " + part.encode()
            out.append(array("I", ids).tobytes() if same and part else b"")
        return out

    def encode(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """For a and b: the ids of all texts one after the other, and each text's count."""
        a, a_count = self.a.encode(texts, lead=" ")
        parts, codes, offsets = cut(texts)
        entries = self.parts.look(parts)
        lost = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries)) == 0
        kept = ~np.logical_or.reduceat(lost[codes], offsets[:-1])
        b, each = gather(entries, codes)
        b_count = np.add.reduceat(each, offsets[:-1])
        return [(ids[np.repeat(kept, n)], n * kept) for ids, n in ((a, a_count), (b, b_count))]


@lru_cache(maxsize=1)
def encoders_for(a_path: str, b_path: str) -> Encoders:
    return Encoders(a_path, b_path)


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per text: its ids as little-endian 32-bit integers."""
    offsets = np.concatenate([[0], np.cumsum(counts * 4)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4"))])


def _unlisted(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    counts = pc.binary_length(column).to_numpy().astype(np.int64) // 4
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4"), counts


def encode_tokens(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, a, b): the ids of both tokenizers, packed; both empty for texts without tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = encoders_for(a_path, b_path)
        for batch in text_slices(batches, 1, _TEXT_BYTES):
            columns = [_lists(*found) for found in encoders.encode(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "a", "b"])

    source = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id bigint, a binary, b binary")


def aligned(a_size: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of tokens with these sizes, over the same bytes: the common ends in order, and for each
    the index of the token of a and of b that ends there. A group reaches from behind the
    last common end to the next."""
    total = int(a_size.sum())
    index = []
    for size in (a_size, b_size):
        by_end = np.full(total + 1, -1, dtype=np.int32)
        by_end[np.cumsum(size)] = np.arange(len(size), dtype=np.int32)
        index.append(by_end)
    common = np.flatnonzero((index[0] >= 0) & (index[1] >= 0))
    return common, index[0][common].astype(np.int64), index[1][common].astype(np.int64)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
    return key[heads], np.add.reduceat(n, heads) if len(key) else n


def pair_counts(tokens: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a, b, n, best): how many links of all texts hold each pair of ids linked, and whether
    no other pair with that b has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = encoders_for(a_path, b_path)
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        for batch in text_slices(batches, 0, _ID_BYTES):
            (a, _), (b, _) = map(_unlisted, batch.columns)
            _, i, j = aligned(encoders.a_size[a], encoders.b_size[b])
            key, n = np.unique(a[i].astype(np.int64) << 32 | b[j], return_counts=True)
            keys.append(key)
            counts.append(n)
            if sum(map(len, keys)) > _HELD_PAIRS:
                key, n = merged(keys, counts)
                keys, counts = [key], [n]
        if keys:
            key, n = merged(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key >> 32, key & 0xFFFFFFFF, n)], ["a", "b", "n"])

    counted = tokens.select("a", "b").mapInArrow(run, "a bigint, b bigint, n bigint")
    counted = counted.groupBy("a", "b").agg(F.sum("n").alias("n"))
    return counted.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def written(ids: list[np.ndarray], last: list[np.ndarray], texts: list[np.ndarray]) -> pa.Array:
    """Groups as text, ``a1,a2|b1;a3|b2,b3``, one string per text. ``ids`` of a and b, ``last``
    the indices of the tokens that end a group, ``texts`` the counts of tokens per text."""
    of_group = [np.diff(x, prepend=-1) for x in last]
    # Each group's tokens of a come before its tokens of b.
    place = [
        np.arange(len(ids[0])) + np.repeat(np.cumsum(of_group[1]) - of_group[1], of_group[0]),
        np.arange(len(ids[1])) + np.repeat(np.cumsum(of_group[0]), of_group[1]),
    ]
    total = len(ids[0]) + len(ids[1])
    width = len(str(max([int(x.max()) for x in ids if len(x)], default=0)))
    merged_ids = np.empty(total, dtype=np.int64)
    chars = np.full((total, width + 1), ord(","), dtype=np.uint8)
    shown = np.ones((total, width + 1), dtype=bool)
    for x, at in zip(ids, place, strict=True):
        merged_ids[at] = x
    for k in range(width):
        power = 10 ** (width - 1 - k)
        chars[:, k] = ord("0") + merged_ids // power % 10
        if power > 1:
            shown[:, k] = merged_ids >= power
    chars[place[0][last[0]], width] = ord("|")
    chars[place[1][last[1]], width] = ord(";")
    sizes = texts[0] + texts[1]
    ends = np.cumsum(sizes)
    shown[ends[sizes > 0] - 1, width] = False  # nothing stands behind a text's last group
    of_token = np.concatenate([[0], np.cumsum(shown.sum(axis=1))])
    offsets = np.concatenate([[0], of_token[ends]]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(chars[shown])])


SCHEMA = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"


def align_tokens(tokens: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document: tokens of both, groups, links, links whose pair is its b's most frequent
    one, the sum of the links' pair counts, and ``groups`` as text: ``a1,a2|b1;a3|b2,b3``."""
    pairs = pair_counts(tokens, a_path, b_path).toArrow()  # bounded by the vocabularies
    order = np.argsort(keys := (pairs.column("a").to_numpy() << 32 | pairs.column("b").to_numpy()))
    sent = tokens.sparkSession.sparkContext.broadcast(
        (keys[order], pairs.column("n").to_numpy()[order], pairs.column("best").to_numpy()[order].astype(np.int64))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = encoders_for(a_path, b_path)
        known, times, best = sent.value
        for batch in text_slices(batches, 1, _ID_BYTES):
            (a, n_a), (b, n_b) = _unlisted(batch.column(1)), _unlisted(batch.column(2))
            _, i, j = aligned(encoders.a_size[a], encoders.b_size[b])
            pair = np.searchsorted(known, a[i].astype(np.int64) << 32 | b[j])
            # A text's last token ends a group, so groups before the text's end are the text's.
            stops = np.searchsorted(i, np.cumsum(n_a))
            sums = [stops - np.concatenate([[0], stops[:-1]])]
            for values in (best, times):
                so_far = np.concatenate([[0], np.cumsum(values[pair])])[stops]
                sums.append(np.diff(so_far, prepend=0))
            counts = [n_a, n_b, sums[0], sums[0], *sums[1:]]
            groups = written([a, b], [i, j], [n_a, n_b])
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts), groups], [c.split()[0] for c in SCHEMA.split(", ")])

    return tokens.select("doc_id", "a", "b").mapInArrow(run, SCHEMA)


def align_documents(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The alignment of all documents; their ids are written to the checkpoint folder first."""
    path = scratch_path(docs.sparkSession, "aligned-tokens")
    encode_tokens(docs, a_path, b_path, key, text).write.option("compression", "zstd").parquet(path)
    return align_tokens(docs.sparkSession.read.parquet(path), a_path, b_path)


def digests(aligned: DataFrame) -> DataFrame:
    """The counts with ``groups_sha256``, the hash of the groups' text (empty without tokens)."""
    hashed = F.when(F.col("n_a") > 0, F.sha2(F.col("groups"), 256)).otherwise("")
    return aligned.withColumn("groups_sha256", hashed).drop("groups")
