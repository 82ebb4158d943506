"""Word shingles of many texts at once, as 64-bit hashes in numpy.

Words are hashed from their bytes by a polynomial with a fixed odd multiplier and mixed;
a shingle's hash combines the hashes of its words and its length, so that equal word
sequences have equal hashes and others differ but for a chance of 2^-64 a pair.
"""

from __future__ import annotations

import numpy as np

from encore.llm.common import LOWER

SIZE = 5
_MUL = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Lower-cased bytes, with the six word separators mapped to 0.
PLAIN = bytes(0 if c in b" \t\n\x0b\x0c\r" else c for c in LOWER)
#: The same with all ASCII but letters and digits as separators.
ALNUM = bytes(c if c >= 128 or chr(c).isalnum() else 0 for c in LOWER)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[bytes], table: bytes = PLAIN) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the number of words of each text. ``table`` maps
    bytes to what they count as, separators to 0."""
    joined = b"\n".join(texts).translate(table)
    data = np.frombuffer(joined, dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    if not len(data) or not data.any():
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    inside = data != 0
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    # Words of a text: starts before its end, less those before its beginning.
    upto = np.searchsorted(starts, np.cumsum(sizes) - 1)
    counts = np.diff(np.concatenate([[0], upto]))
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), _MUL, dtype=np.uint64))
        spelled = data[starts[0] :].astype(np.uint64) * powers[place]
        return mix(np.add.reduceat(spelled, starts - starts[0])), counts


def shingles(texts: list[bytes], table: bytes = PLAIN, size: int = SIZE) -> tuple[list[np.ndarray], np.ndarray]:
    """The shingles of each text in order, and its word counts. A text with fewer than ``size``
    words has its whole sequence as one shingle; a text without words has none."""
    hashes, counts = word_hashes(texts, table)
    out, at = [], 0
    with np.errstate(over="ignore"):
        for n in counts.tolist():
            own = hashes[at : at + n]
            at += n
            k = min(n, size)
            h = np.full(n - k + 1 if n else 0, k, dtype=np.uint64)
            for i in range(k):
                h = h * _STEP + own[i : n - k + 1 + i]
            out.append(mix(h))
    return out, counts
