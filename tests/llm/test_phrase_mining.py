"""Phrase mining against plain Python over whole texts."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from encore.llm import phrase_mining
from encore.llm.queries import op11_phrase_mining
from tests.conftest import SF_SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, n bigint, phrase string"


def expected(rows, min_count=phrase_mining.MIN_COUNT, top=phrase_mining.TOP):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = tuple(re.findall("[^\x20\x09]+", piece))
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= min_count}
    longest = Counter()
    for (lang, w), a in candidates.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                part = (lang, w[i : i + size])
                longest[part] = max(longest[part], a)
    out = defaultdict(list)
    for (lang, w), a in candidates.items():
        if 100 * longest[lang, w] >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    found = []
    for lang, some in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(some)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(found)


def result(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


def hard_rows():
    rng = np.random.default_rng(4)
    words = ["Alpha", "beta", "ÉTÉ", "é", "漢字", "x\x00y", "▁", "don't", "a\x0bq", "g\x85h", "two words", "Ends.", "#"]
    rows = []
    for k in range(900):
        picked = rng.choice(len(words), size=int(rng.integers(0, 25)), p=np.r_[[0.28, 0.22], [0.5 / 11] * 11])
        seps = rng.choice([" ", "  ", "\t", " \t ", ", ", "\n", "!"], size=len(picked), p=[0.7, 0.1, 0.05, 0.05, 0.05, 0.03, 0.02])
        text = "".join(words[i] + s for i, s in zip(picked, seps, strict=True))
        rows.append((k % 50, text, ["en", "en", "de", None, "und", ""][k % 6], k, "clash"))
    fixed = "one two three four five. New York city hall, new york city hall; new york"
    return [*rows, *[(7, fixed, "en", 1, None)] * 40, (8, None, "en", None, None), (9, "", "fr", None, None), (None, "of the of the of the", "en", 0, "")]


@pytest.mark.parametrize("block_bytes", [1 << 23, 900])
def test_hard_texts(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(phrase_mining, "BLOCK_BYTES", block_bytes)  # many small blocks hold the same groups
    rows = hard_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = expected([(r[2], r[1]) for r in rows])
    assert len(want) > 30 and any(len(x[2].split(" ")) == 4 for x in want)
    assert result(phrase_mining.mine(docs)) == want
    assert result(phrase_mining.mine(docs, top=3)) == [x for x in want if x[1] <= 3]


def test_long_text_and_no_rows(spark):
    text = " ".join(f"w{i % 7} v{i % 5}" for i in range(150_000))
    docs = spark.createDataFrame([(1, text, "en", 1, "")], SCHEMA)
    assert result(phrase_mining.mine(docs)) == expected([("en", text)])
    for rows in ([], [(1, None, None, None, None)]):
        assert phrase_mining.mine(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_products_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    rows = [("en", "a", 1, big), ("en", "b", 1, big + 2), ("en", "a b", 2, big - 1)]
    (row,) = phrase_mining.collocations(spark.createDataFrame(rows, "lang string, phrase string, words int, f bigint")).collect()
    assert row["score"] == 2_000_000 * (big - 1) // (2 * big + 2)


def test_packing():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        values = rng.integers(-1, 70_000, n).astype("<i4")
        assert (phrase_mining.unpack(phrase_mining.pack(values), "<i4") == values).all()
        keys = np.sort(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (phrase_mining.unpack_sorted(phrase_mining.pack_sorted(keys)) == keys).all()


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("lang", "text").collect()]
    assert result(op11_phrase_mining(spark, SF_SMALL)) == expected(rows)
