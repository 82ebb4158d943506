"""Cross-tokenizer alignment against both libraries on whole texts and plain loops."""

import hashlib
import json
from collections import Counter
from itertools import accumulate

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

from encore.llm import token_alignment
from encore.llm.queries import op13_token_alignment, tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm.test_parts import hard_texts

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def expected(rows):
    """{(doc_id, text): result} by both libraries on whole texts."""
    a_lib, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    with open(A, encoding="utf-8") as f:
        vocab = {i: t for t, i in json.load(f)["model"]["vocab"].items()}
    found, counts = [], Counter()
    for doc, text in rows:
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        a_bytes = [bytes(back[c] for c in vocab[i]) for i in a]
        b_bytes = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
        want = b" " + (text or "").encode()
        if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            found.append((doc, [], [], [], []))
            continue
        ends_a, ends_b = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
        groups, links, at = [], [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            groups.append(([i for i, e in zip(a, ends_a, strict=True) if at < e <= end], [i for i, e in zip(b, ends_b, strict=True) if at < e <= end]))
            at = end
        where = dict(zip(ends_b, b, strict=True))
        links = [(i, where[e]) for i, e in zip(a, ends_a, strict=True) if e in where]
        counts.update(links)
        found.append((doc, a, b, groups, links))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for doc, a, b, groups, links in found:
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sha = hashlib.sha256(told.encode()).hexdigest() if a else ""
        best = sum(counts[x] == most[x[1]] for x in links)
        out.append((doc, len(a), len(b), len(groups), len(links), best, sum(counts[x] for x in links), sha))
    return Counter(out)


def result(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def test_hard_texts(spark):
    texts = [t for t in hard_texts(200) if t is None or len(t) < 5000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(5, "again and again"), (5, "again and again"), (None, "no id"), (6, "a▁b c"), (7, "<s>x</s> <0x41> <unk>")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, n_a int, groups string").repartition(3)
    assert result(token_alignment.digests(token_alignment.align_documents(docs, A, B))) == expected(rows)


def test_very_long_text_and_empty_table(spark):
    long = " ".join(f"w{i % 313}." for i in range(60_000))
    docs = spark.createDataFrame([(1, long)], "doc_id bigint, text string")
    (row,) = token_alignment.align_documents(docs, A, B).collect()
    assert row.groups.count(";") + 1 == row.n_groups == row.n_links and row.n_a > 120_000
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_alignment.align_documents(empty, A, B).collect() == []
    assert token_alignment.pair_counts(token_alignment.encode_tokens(empty, A, B), A, B).collect() == []


def test_aligned_and_written():
    common, i, j = token_alignment.aligned(np.array([1, 2, 3, 2]), np.array([3, 1, 2, 2]))
    assert common.tolist() == [3, 6, 8] and i.tolist() == [1, 2, 3] and j.tolist() == [0, 2, 3]
    ids = [np.array([5, 10, 0, 44]), np.array([7, 99, 100, 3])]
    found = token_alignment.written(ids, [i, j], [np.array([0, 3, 0, 1, 0]), np.array([0, 3, 0, 1, 0])])
    assert found.to_pylist() == ["", "5,10|7;0|99,100", "", "44|3", ""]
    none = np.zeros(0, dtype=np.int64)
    assert token_alignment.written([none, none], [none, none], [np.array([0]), np.array([0])]).to_pylist() == [""]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert result(op13_token_alignment(spark, SF_SMALL)) == expected(rows)
