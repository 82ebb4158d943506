"""Texts cut into parts that can be encoded one by one, and a memory of encoded parts.

Neither a byte-level pattern nor a SentencePiece model whose space marks only begin pieces
joins text across a single space between two other characters: the space begins the next
token. Texts are cut there, in Arrow, and every distinct part of a slice of texts is looked
up once; the tokens of all its occurrences are then gathered with numpy.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Bytes of text that are looked up together.
SLICE_BYTES = 8 << 20
#: Parts kept per generation of a memory.
CACHE_PARTS = 600_000


def text_slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` bytes in a text column (one row at least).
    Arrow's pool gives back what a slice needed: workers stay, and would hold it between tasks."""
    pool = pa.default_memory_pool()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(int(np.searchsorted(ends, before + limit, side="right")), at + 1)
            yield batch.slice(at, stop - at)
            pool.release_unused()
            at = stop


def cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct parts, index of every part of all texts, offsets of the texts among them).

    Parts stand without the space before them. A null text counts as empty; an empty text
    has one empty part. Spaces next to other white space or at a text's ends stay inside.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    lists = pc.split_pattern(texts, " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    coded = lists.flatten().dictionary_encode()
    known, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    parts = known.to_numpy(zero_copy_only=False).tolist()
    trimmed = pc.binary_length(pc.utf8_trim_whitespace(known)).to_numpy()
    touching = (trimmed == 0) | (trimmed < pc.binary_length(known).to_numpy())
    if not touching.any():
        return parts, codes, offsets
    again = np.unique(np.searchsorted(offsets, np.flatnonzero(touching[codes]), side="right") - 1)
    place = {p: k for k, p in enumerate(parts)}
    pieces, sizes, at = [], np.diff(offsets), 0
    for row, text in zip(again.tolist(), texts.take(pa.array(again)).to_pylist(), strict=True):
        own = [place.setdefault(p, len(place)) for p in _CUT.split(text)]
        pieces += [codes[at : offsets[row]], np.array(own, dtype=np.int64)]
        at, sizes[row] = offsets[row + 1], len(own)
    pieces.append(codes[at:])
    return list(place), np.concatenate(pieces), np.concatenate([[0], np.cumsum(sizes)])


class Memory:
    """What ``learn`` (list of parts to list of results) made of parts. Two generations are
    kept: parts that come up again move to the newer one, the others are forgotten."""

    def __init__(self, learn: Callable[[list[str]], list], limit: int = CACHE_PARTS):
        self.learn, self.limit = learn, limit
        self.newer: dict[str, object] = {}
        self.older: dict[str, object] = {}

    def look(self, parts: list[str]) -> list:
        """The results of the parts. Nothing made here is cyclic, so the collector, which would
        walk these long lists again and again, rests meanwhile."""
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._look(parts)
        finally:
            if collecting:
                gc.enable()

    def _look(self, parts: list[str]) -> list:
        newer, older = self.newer, self.older
        found = list(map(newer.get, parts))
        if None in found:
            missing = [p for p, f in zip(parts, found, strict=True) if f is None]
            known = list(map(older.get, missing))
            new = [p for p, f in zip(missing, known, strict=True) if f is None]
            newer.update(zip(missing, known, strict=True))
            newer.update(zip(new, self.learn(new), strict=True))
            found = list(map(newer.__getitem__, parts))
            if len(newer) > self.limit:
                self.older, self.newer = newer, {}
        return found


def gather(entries: list[bytes], codes: np.ndarray, dtype: str = "<u4") -> tuple[np.ndarray, np.ndarray]:
    """The values of entries (packed arrays) ``codes[0], codes[1], ...`` one after the other,
    and how many each of these has."""
    flat = np.frombuffer(b"".join(entries), dtype=dtype)
    sizes = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries)) // flat.itemsize
    starts = np.cumsum(sizes) - sizes
    each = sizes[codes]
    ends = np.cumsum(each)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts[codes] - (ends - each), each)], each
