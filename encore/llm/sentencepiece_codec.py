"""SentencePiece encoding that keeps the way back to the original bytes, and decoding.

The text is normalised here: at every position the longest prefix found in the model's
compiled character map is replaced, and each normalised byte records the original byte it
came from. The library then segments the normalised text (its own normaliser switched
off), and every piece is projected through the recorded alignment to a byte span of the
original text. No piece of such a model crosses from a word into the next word's space
mark, so words are segmented once and kept in a bounded memory.

Defined results: a null text counts as empty and has no pieces; long texts are encoded
whole; repeated rows are encoded each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.parts import Memory, cut, gather, text_slices

SPACE = "▁"
_SPACE_BYTES = SPACE.encode()
#: Segmented words kept per worker process.
CACHE_WORDS = 80_000
#: Bytes of text encoded together.
TEXT_BYTES = 2 << 20


def _fields(message: bytes) -> list[tuple[int, int, int, int | bytes]]:
    """(field number, start, end, value) of each field of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    out, at = [], 0
    while at < len(message):
        start = at
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        elif tag & 7 == 2:
            size, at = varint(at)
            value, at = message[at : at + size], at + size
        else:
            size = 8 if tag & 7 == 1 else 4
            value, at = message[at : at + size], at + size
        out.append((tag >> 3, start, at, value))
    return out


class CharsMap:
    """A compiled character map: a double-array trie over UTF-8 bytes whose values point
    into a block of zero-terminated replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist() if size else []
        self.block = blob[4 + size :] if size else b""

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of ``data[at:]`` and its replacement."""
        units, found = self.units, None
        if not units:
            return None
        node = units[0]
        pos = (node >> 10) << ((node & 512) >> 6)
        for k in range(at, len(data)):
            byte = data[k]
            pos ^= byte
            node = units[pos]
            if node & 0x800000FF != byte:
                break
            pos ^= (node >> 10) << ((node & 512) >> 6)
            if node & 256:
                found = k + 1 - at, units[pos] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.block[start : self.block.index(0, start)]


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            proto = f.read()
        fields = _fields(proto)
        spec = next((v for n, _, _, v in fields if n == 3), b"")
        values = {n: v for n, _, _, v in _fields(spec)}
        self.charsmap = CharsMap(values.get(2, b""))
        self.dummy_prefix = bool(values.get(3, 1))
        self.squeeze = bool(values.get(4, 1))
        trainer = {n: v for n, _, _, v in _fields(next((v for n, _, _, v in fields if n == 2), b""))}
        plain = bytes([3 << 3 | 2, 8, 3 << 3, 0, 4 << 3, 0, 5 << 3, 0])  # no prefix, no squeezing, no escaping
        plain = plain[:1] + bytes([len(plain) - 2]) + plain[2:]
        rest = b"".join(proto[a:b] for n, a, b, _ in fields if n != 3)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=rest + plain)
        n = self.segmenter.get_piece_size()
        pieces = [self.segmenter.id_to_piece(i) for i in range(n)]
        self.unknown = self.segmenter.unk_id()
        self.is_byte = [self.segmenter.is_byte(i) for i in range(n)]
        self.byte_of = [int(p[3:5], 16) if b else -1 for p, b in zip(pieces, self.is_byte, strict=True)]
        self.size_of = [len(p.encode()) for p in pieces]
        self.bytes_or_unknown = {i for i, b in enumerate(self.is_byte) if b} | {self.unknown}
        kinds = [next((v for f, _, _, v in _fields(x) if f == 3), 1) for f, _, _, x in fields if f == 1]
        self.literal = sorted((p.encode() for p, k in zip(pieces, kinds, strict=True) if k == 4), key=len, reverse=True)
        #: Whether words can be segmented one by one.
        self.by_word = self.dummy_prefix and not self.literal and not trainer.get(24) and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.cache: dict[str, bytes] = {}  # (id, bytes covered) pairs of a word's pieces
        #: Whether texts need no map, so that their parts can be looked up in Arrow.
        self.direct = self.by_word and not self.charsmap.units and not self.squeeze
        self.parts = Memory(self._pairs, CACHE_WORDS)
        # Space marks stand for one byte of a text that holds none itself.
        self.source_size_of = [n - 2 * p.count(SPACE) for n, p in zip(self.size_of, pieces, strict=True)]

    # -- normalisation ---------------------------------------------------------------

    def normalise(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them (and the end) its original byte offset."""
        if not self.charsmap.units and not self.literal and not self.squeeze:
            return self._escape(data)
        out, align, at = bytearray(), [], 0

        def step(at: int) -> tuple[int, bytes]:
            for piece in self.literal:
                if data.startswith(piece, at):
                    return len(piece), piece
            if hit := self.charsmap.longest(data, at):
                return hit
            lead = data[at]
            size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return size, data[at : at + size]

        if self.squeeze:
            while at < len(data) and (got := step(at))[1] == b" ":
                at += got[0]
        if at == len(data):
            return b"", np.zeros(1, dtype=np.int64)
        if self.dummy_prefix:
            out += _SPACE_BYTES
            align += [at] * 3
        blank = self.squeeze
        while at < len(data):
            size, new = step(at)
            while blank and new.startswith(b" "):
                new = new[1:]
            if new:
                for byte in new:
                    put = _SPACE_BYTES if byte == 32 else bytes([byte])
                    out += put
                    align += [at] * len(put)
                blank = self.squeeze and new.endswith(b" ")
            at += size
        if self.squeeze:
            while out.endswith(_SPACE_BYTES):
                at = align[-3]
                del out[-3:], align[-3:]
        return bytes(out), np.array([*align, at if out else 0], dtype=np.int64)

    def _escape(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The same without a map: only the prefix and the space marks."""
        if not data:
            return b"", np.zeros(1, dtype=np.int64)
        original = np.frombuffer(data, dtype=np.uint8)
        align = np.repeat(np.arange(len(data)), np.where(original == 32, 3, 1))
        prefix = _SPACE_BYTES if self.dummy_prefix else b""
        align = np.concatenate([np.zeros(len(prefix), dtype=np.int64), align, [len(data)]])
        return prefix + data.replace(b" ", _SPACE_BYTES), align

    # -- segmentation ----------------------------------------------------------------

    def _sizes(self, part: str, ids: list[int]) -> list[int]:
        """Normalised bytes that each piece covers: a character spelled in byte pieces
        belongs to the last of them."""
        if self.bytes_or_unknown.isdisjoint(ids):
            size_of = self.size_of
            return [size_of[i] for i in ids]
        if self.unknown in ids:
            spans = self.segmenter.encode(part, return_type="proto").pieces
            return [len(part[p.begin : p.end].encode()) for p in spans]
        sizes, spelled = [], 0
        for i in ids:
            if not self.is_byte[i]:
                sizes.append(self.size_of[i])
                continue
            if not spelled:
                lead = self.byte_of[i]
                full = spelled = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            spelled -= 1
            sizes.append(0 if spelled else full)
        return sizes

    def _learn(self, parts: list[str]) -> None:
        marked = [SPACE + p for p in parts]
        for part, full, ids in zip(parts, marked, self.segmenter.encode(marked, num_threads=1), strict=True):
            pairs = array("i", chain.from_iterable(zip(ids, self._sizes(full, ids), strict=True)))
            self.cache[part] = pairs.tobytes()

    def encode(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the original byte offsets where each piece begins and ends."""
        return self.encode_all([data])[0]

    def encode_all(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The same for several texts; words that are new in them are segmented in one call."""
        normal = [self.normalise(x) for x in texts]
        if not self.by_word:
            return [self._whole(x.decode("utf-8"), align) for x, align in normal]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        parts = [self._parts(x.decode("utf-8")) for x, _ in normal]
        cache = self.cache
        found = [list(map(cache.get, ps)) for ps in parts]
        new = {p for ps, f in zip(parts, found, strict=True) if None in f for p, x in zip(ps, f, strict=True) if x is None}
        if new:
            self._learn(list(new))
            found = [list(map(cache.get, ps)) if None in f else f for ps, f in zip(parts, found, strict=True)]
        out = []
        for f, (_, align) in zip(found, normal, strict=True):
            pairs = np.frombuffer(b"".join(f), dtype=np.int32).reshape(-1, 2)
            out.append(self._spans(pairs[:, 0], pairs[:, 1], align))
        return out

    def _pairs(self, parts: list[str]) -> list[bytes]:
        """Packed (id, original bytes covered) pairs of parts, the space before them included."""
        size_of, special, out = self.source_size_of, self.bytes_or_unknown, []
        # A part's own spaces and the one before it become marks.
        marked = [SPACE + p.replace(" ", SPACE) for p in parts]
        for full, ids in zip(marked, self.segmenter.encode(marked, num_threads=1), strict=True):
            if special.isdisjoint(ids):
                sizes = [size_of[i] for i in ids]
            else:
                sizes = [n - (self.size_of[i] - size_of[i]) if n else 0 for i, n in zip(ids, self._sizes(full, ids), strict=True)]
            out.append(array("i", chain.from_iterable(zip(ids, sizes, strict=True))).tobytes())
        return out

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, begins and ends of all texts one after the other, and how many each text has."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        # Texts that hold the space mark themselves go one by one, as all do where a map is needed.
        alone = pc.match_substring(texts, SPACE) if self.direct else pa.array([True] * len(texts), pa.bool_())
        together = pc.if_else(alone, "", texts)
        parts, codes, offsets = cut(together)
        pairs, each = gather(self.parts.look(parts), codes, "<i4,<i4")
        counts = np.add.reduceat(each, offsets[:-1]) if len(texts) else np.zeros(0, dtype=np.int64)
        counts[pc.equal(together, "").to_numpy(zero_copy_only=False)] = 0
        if not len(pairs):
            ids = ends = np.zeros(0, dtype=np.int32)
        else:
            kept = np.repeat(counts > 0, np.add.reduceat(each, offsets[:-1]))
            ids, ends = pairs["f0"][kept], np.cumsum(pairs["f1"][kept], dtype=np.int64)
        starts = np.cumsum(counts) - counts
        filled = counts > 0
        # Ends count from each text's begin; the first mark stands for no byte.
        before = np.zeros(len(counts), dtype=np.int64)
        before[filled] = np.concatenate([[0], ends])[starts[filled]]
        ends = ends - np.repeat(before + 1, counts)
        begins = np.empty_like(ends)
        begins[1:] = ends[:-1]
        begins[starts[filled]] = 0
        found = [ids.astype(np.int32), begins.astype(np.int32), ends.astype(np.int32)]
        rows = np.flatnonzero(alone.to_numpy(zero_copy_only=False))
        if not len(rows):
            return *found, counts
        own = self.encode_all([t.encode() for t in texts.take(pa.array(rows)).to_pylist()])
        pieces: list[list[np.ndarray]] = [[], [], []]
        at = 0
        for row, triple in zip(rows.tolist(), own, strict=True):
            for k in range(3):
                pieces[k] += [found[k][at : starts[row]], triple[k]]
            at, counts[row] = starts[row], len(triple[0])
        return *(np.concatenate([*p, f[at:]]).astype(np.int32) for p, f in zip(pieces, found, strict=True)), counts

    @staticmethod
    def _parts(text: str) -> list[str]:
        """The words of normalised text, each without its own space mark but with those before it."""
        _, *others = text.split(SPACE)
        return [p[1:] for p in re.findall(f"{SPACE}+[^{SPACE}]*", text)] if "" in others else others

    def _whole(self, text: str, align: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = self.segmenter.encode(text)
        return self._spans(np.array(ids, dtype=np.int32), np.array(self._sizes(text, ids), dtype=np.int32), align)

    @staticmethod
    def _spans(ids: np.ndarray, sizes: np.ndarray, align: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ends = np.cumsum(sizes, dtype=np.int64)
        return ids, align[ends - sizes].astype(np.int32), align[ends].astype(np.int32)

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=1)
def codec_for(path: str) -> Codec:
    """The worker's codec; a worker process serves many tasks and keeps its segmented words."""
    return Codec(path)


SCHEMA = "doc_id bigint, ids array<int>, begins array<int>, ends array<int>, decoded string"


def encode_documents(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ids, byte span of every piece in the original text, and the
    text decoded from the ids. Map-only: no shuffle, nothing kept beyond a slice of rows.

    ``model_path`` is read in each task, so it must exist on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(model_path)
        for batch in text_slices(batches, 1, TEXT_BYTES):
            *columns, counts = codec.encode_batch(batch.column(1))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(c, type=pa.int32())) for c in columns]
            flat = columns[0].tolist()
            decoded = pa.array([codec.decode(flat[a:b]) for a, b in pairwise(offsets.tolist())], type=pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists, decoded], ["doc_id", "ids", "begins", "ends", "decoded"])

    source = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, SCHEMA)


def digests(encoded: DataFrame) -> DataFrame:
    """Per document: token count and the hashes of its ids and of its decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        F.when(F.size("ends") > 0, F.get("ends", F.size("ends") - 1)).otherwise(0).cast("long").alias("covered_bytes"),
    )
