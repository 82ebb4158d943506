"""License scan: an Aho-Corasick automaton finds notice phrases and identifier tags in
one pass over each text; the expression after a tag is read with a shunting-yard parser.

Words are maximal runs of 0-9, a-z (A-Z lower-cased) and code points above 0x7F. Notice
phrases must match whole consecutive words. After ``SPDX-License-Identifier:`` the rest of
the line is an expression of licence ids with AND, OR, WITH and parentheses; its labels
count, and its value decides what the tag permits: OR takes the more permissive side, AND
the stricter one, and WITH keeps the licence it qualifies.

Defined results: a null text counts as empty; a text without finds has empty label
strings, null first and last word, and score 0; a malformed expression yields the ids that
can be read from it and the strictest of their values; texts are scanned whole; repeated
rows are scanned each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import LOWER, map_slices, text_bytes

# The base phrases and their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Further notices, by label.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache 2 0": "apache-2",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gplv2": "gpl-2",
    "gplv3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa",
    "cc by 4 0": "cc-by",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
# How freely a text under a label may be used, from 0 to 1.
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "mit": 1.0, "bsd": 1.0, "apache-2": 1.0, "cc-by": 0.9, "mpl": 0.7, "cc-by-sa": 0.6,
    "lgpl": 0.6, "gpl-2": 0.4, "gpl-3": 0.4, "agpl": 0.3, "cc-by-nc": 0.2, "all-rights-reserved": 0.0,
}
UNKNOWN_FREEDOM = 0.1
TAG = "spdx license identifier"
_TAG_LINE = re.compile(rb"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"[()]|[a-z0-9.+-]+")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
#: Word bytes (lower-cased) stay, every other byte becomes a space.
_WORD_BYTES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in LOWER)


def label_of(identifier: str) -> str:
    """The label of a licence id such as ``GPL-3.0-or-later``; unknown ids are their own label."""
    bare = identifier.lower().rstrip("+")
    bare = re.sub(r"-(only|or-later)$", "", bare)
    for pattern, label in (
        (r"mit(-0)?", "mit"), (r"apache-2(\.0)?", "apache-2"), (r"cc-by-nc.*", "cc-by-nc"), (r"cc-by-sa.*", "cc-by-sa"),
        (r"cc-by(-\d.*)?", "cc-by"), (r"cc0.*", "cc0"), (r"lgpl.*", "lgpl"), (r"agpl.*", "agpl"), (r"mpl.*", "mpl"),
        (r"bsd.*|0bsd", "bsd"), (r"gpl-([23]).*", r"gpl-\1"),
    ):
        if m := re.fullmatch(pattern, bare):
            return m.expand(label)
    return bare


def read_expression(text: str) -> tuple[list[str], list[str], bool]:
    """Licence ids in order of appearance, the expression in reverse Polish order, and
    whether it is well formed (shunting yard)."""
    output: list[str] = []
    stack: list[str] = []
    ids: list[str] = []
    well, operand = True, True  # operand: an id or an opening parenthesis must come next
    for token in _TOKEN.findall(text.lower()):
        if token == "(":
            well &= operand
            stack.append(token)
        elif token == ")":
            well &= not operand
            while stack and stack[-1] != "(":
                output.append(stack.pop())
            if stack:
                stack.pop()
            else:
                well = False
        elif token in _PRECEDENCE:
            well &= not operand
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[token]:
                output.append(stack.pop())
            stack.append(token)
            operand = True
        else:
            if not operand:
                break  # prose after the expression
            if not (stack and stack[-1] == "with"):
                ids.append(token)
            output.append(token)
            operand = False
    well &= not operand
    while stack:
        top = stack.pop()
        if top == "(":
            well = False
        else:
            output.append(top)
    return ids, output, well


def expression_freedom(text: str) -> tuple[list[str], float | None]:
    """Labels of an expression and its value; no value when there is no id in it."""
    ids, output, well = read_expression(text)
    value = {i: FREEDOM.get(label_of(i), UNKNOWN_FREEDOM) for i in ids}
    labels = list(dict.fromkeys(label_of(i) for i in ids))
    if not ids:
        return [], None
    if not well:
        return labels, min(value.values())
    stack: list[float] = []
    for token in output:
        if token not in _PRECEDENCE:
            stack.append(value.get(token, 1.0))
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(max(left, right) if token == "or" else min(left, right) if token == "and" else left)
    return labels, stack[-1]


def build_automaton(base: dict[str, str], notices: dict[str, str]) -> ahocorasick.Automaton:
    """Phrases as words between single spaces, so that only whole words match."""
    automaton = ahocorasick.Automaton()
    for phrase in {*base, *notices, TAG}:
        automaton.add_word(f" {phrase} ", (phrase, base.get(phrase), notices.get(phrase)))
    automaton.make_automaton()
    return automaton


class Scanner:
    def __init__(self, base: dict[str, str] = BASE_PHRASES, notices: dict[str, str] = NOTICES):
        self.automaton = build_automaton(base, notices)

    def scan(self, data: bytes) -> tuple:
        """Word count, base places, first and last base word, base labels, all labels,
        score, and the finds as (label, word) pairs."""
        words = data.translate(_WORD_BYTES).split()
        # latin-1 keeps one character for each byte, so phrases (ASCII) match as they are.
        line = b" ".join(words).decode("latin-1")
        line = f" {line} "
        places, base_labels, labels, finds, tagged = [], set(), set(), [], False
        at = word = 0
        for end, (phrase, base, notice) in self.automaton.iter(line):
            start = end - len(phrase) - 1
            # Words before the find, counted on from the find before it.
            if start >= at:
                word += line.count(" ", at, start)
            else:
                word -= line.count(" ", start, at)
            at = start
            if phrase == TAG:
                tagged = True
                continue
            if base:
                places.append(word)
                base_labels.add(base)
            label = base or notice
            labels.add(label)
            finds.append((label, word))
        values = [FREEDOM.get(x, UNKNOWN_FREEDOM) for x in labels]
        if tagged:
            for m in _TAG_LINE.finditer(data.translate(LOWER)):
                named, value = expression_freedom(m[1].decode("utf-8", "replace"))
                labels.update(named)
                if value is not None:
                    values.append(value)
        finds.sort(key=lambda x: (x[1], x[0]))
        return (
            len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(labels)), min(values, default=0.0),
            [{"label": a, "word": b} for a, b in finds],
        )


SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, finds array<struct<label:string,word:bigint>>"
)
_TYPES = [
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
    pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())])),
]


def scan_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: words, base finds, labels, the score (the least freedom that any
    notice or tag grants; 0 without finds) and every find. Map-only."""

    def make():
        scanner = Scanner()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [scanner.scan(x) for x in text_bytes(batch.column(1))]
            columns = [pa.array([r[k] for r in rows], type=t) for k, t in enumerate(_TYPES)]
            return pa.RecordBatch.from_arrays([batch.column(0), *columns], [c.split()[0] for c in SCHEMA.split(", ")])

        return step

    source = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return map_slices(source, make, SCHEMA)
