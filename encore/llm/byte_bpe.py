"""Byte-level BPE ids of many texts, by the tokenizers library, with runs kept between texts.

The byte-level pattern cuts a text into runs; the library's model encodes each distinct run
once and the ids of all runs are gathered with numpy. Texts are cut in Arrow where its
regular expressions give the same runs: texts of usual characters (whose classes are the same
in all Unicode versions) without white space next to white space. Of the other texts, those
of usual characters are cut by the full pattern, and the rest goes through the library's
whole pipeline, which takes several times as long for the same ids.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from encore.llm.parts import CACHE_PARTS, Memory, gather

# The pre-tokenizer's pattern, and its spelling of bytes: those that print
# stand for themselves, the others for code points from 256 on.
_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_PRINTS = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTS]
SPELLED = {b: b for b in _PRINTS} | {b: 256 + k for k, b in enumerate(_OTHERS)}

_USUAL = r"\x{01}-\x{24F}\x{400}-\x{527}\x{2010}-\x{2027}\x{2030}-\x{205E}"
_BLANK = r"\x{09}-\x{0D}\x{20}\x{85}\x{A0}"
#: The pattern for texts whose white space stands alone.
_CUT = rf"'(?:s|t|re|ve|m|ll|d)| ?\pL+| ?\pN+| ?[^{_BLANK}\pL\pN]+|[{_BLANK}]"
_UNUSUAL = regex.compile("[^\x01-ɏЀ-ԧ‐-‧‰-⁞]")
_MARK = "\x00"  # not a usual character


class ByteEncoder:
    """Encoder of one tokenizer file. ``plain`` makes special tokens' strings ordinary text;
    ``kept`` is how many runs a generation of its memory holds."""

    def __init__(self, path: str, plain: bool = False, kept: int = CACHE_PARTS):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        self.path, self.plain = path, plain
        self.runs = Memory(self._learn, kept)
        self.apart = rf"[^{_USUAL}]|[{_BLANK}][{_BLANK}]" + ("" if plain else r"|<\|")

    def _learn(self, runs: list[str]) -> list[bytes]:
        tokenize = self.library.model.tokenize
        spelled = ["Ġ" + r[1:] if r.isascii() and r[1:].isalpha() and r[0] == " " else r.encode().decode("latin-1").translate(SPELLED) for r in runs]
        return [array("I", [t.id for t in tokenize(s)]).tobytes() for s in spelled]

    def encode(self, texts: pa.Array, lead: str = "", end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (nulls are empty) one after the other and each text's count,
        with ``lead`` before and the id ``end`` after each text."""
        if not len(texts):
            return np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if lead:
            texts = pc.binary_join_element_wise(lead, texts, "")
        apart = pc.match_substring_regex(texts, self.apart)
        cut = pc.replace_substring_regex(pc.if_else(apart, "", texts), _CUT, rf"\0{_MARK}")
        lists = pc.split_pattern(cut, _MARK)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        coded = lists.flatten().dictionary_encode()
        runs, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        # Behind its last mark each text has an empty run, which becomes its end.
        last = b"" if end is None else array("I", [end]).tobytes()
        others = np.flatnonzero(apart.to_numpy(zero_copy_only=False))
        of_text = [self._whole(t) + last for t in texts.take(pa.array(others)).to_pylist()]
        known = [r for r in runs if r]
        entries = dict(zip(known, self.runs.look(known), strict=True))
        entries[""] = last
        found = [*map(entries.__getitem__, runs), *of_text]
        codes = codes.copy()
        codes[offsets[1:][others] - 1] = len(runs) + np.arange(len(others))
        ids, each = gather(found, codes)
        return ids, np.add.reduceat(each, offsets[:-1])

    def _whole(self, text: str) -> bytes:
        if _UNUSUAL.search(text) or (not self.plain and "<|" in text):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(self.runs.look(_PATTERN.findall(text)))

    def vocabulary(self) -> list[bytes]:
        """The bytes of every id (of special tokens, their strings)."""
        with open(self.path, encoding="utf-8") as f:
            read = json.load(f)
        back = {c: b for b, c in SPELLED.items()}
        out = [b""] * self.library.get_vocab_size(with_added_tokens=True)
        for token, i in read["model"]["vocab"].items():
            out[i] = bytes(back[ord(c)] for c in token) if all(ord(c) in back for c in token) else token.encode()
        for added in read["added_tokens"]:
            out[added["id"]] = added["content"].encode()
        return out


@lru_cache(maxsize=2)
def encoder_for(path: str, plain: bool = False, kept: int = CACHE_PARTS) -> ByteEncoder:
    """The worker's encoder; a worker process serves many tasks and keeps what it has learned."""
    return ByteEncoder(path, plain, kept)
