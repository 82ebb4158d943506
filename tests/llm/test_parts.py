"""Cutting texts into parts, the memory of parts, and byte-level ids against the library."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from encore.llm import common, parts, token_shards
from encore.llm.byte_bpe import ByteEncoder
from encore.llm.parts import Memory, cut, gather, text_slices
from encore.llm.queries import tokenizer_path
from encore.llm.sentencepiece_codec import Codec
from encore.llm.token_alignment import Encoders

PIECES = [" ", "  ", "\n", "\t", "a", "word", "Word.", "don't", "'s", "é", "ßü", "漢字", "😀", "1234", "<|endoftext|>", "<|", "\x00", "\x1c", "\x85", " ",
          "　", "▁", "...", "x,y;z", "<s>", "ﬁ", "é", "A" * 200, "ɐ", " "]


def hard_texts(n=300):
    rng = random.Random(3)
    made = ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(n)]
    return [None, "", " ", "   ", *made, " ".join(f"w{i % 313}." for i in range(20_000))]


def test_parts_join_to_the_text():
    texts = hard_texts()
    parts, codes, offsets = cut(pa.array(texts, pa.string()))
    assert len(set(parts)) == len(parts)
    for k, t in enumerate(texts):
        own = [parts[c] for c in codes[offsets[k] : offsets[k + 1]]]
        assert " ".join(own) == (t or "")
        assert len(own) == 1 or not any(p == "" or p[0].isspace() and j or p[-1].isspace() and j < len(own) - 1 for j, p in enumerate(own))
    one = cut(pa.array(["a b"]).slice(0, 1))
    assert one[0] == ["a", "b"]
    assert cut(pa.array(["q", "a b", None]).slice(1))[2].tolist() == [0, 2, 3]


@pytest.mark.parametrize("plain", [False, True])
def test_ids_are_the_library_s(plain):
    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = plain
    texts = hard_texts()
    encoder = ByteEncoder(path, plain)
    encoder.runs.limit = 40  # generations change
    for at in range(0, len(texts), 50):
        some = texts[at : at + 50]
        ids, sizes = encoder.encode(pa.array(some, pa.string()), end=7)
        ends = np.cumsum(sizes)
        for k, t in enumerate(some):
            assert ids[ends[k] - sizes[k] : ends[k]].tolist() == [*library.encode(t or "", add_special_tokens=False).ids, 7]
    assert encoder.encode(pa.array([], pa.string()))[0].tolist() == []
    ids, sizes = encoder.encode(pa.array(texts, pa.string()), lead=" ")
    assert np.split(ids, np.cumsum(sizes)[:-1])[7].tolist() == library.encode(" " + texts[7], add_special_tokens=False).ids
    assert ids.tolist() == [i for t in texts for i in library.encode(" " + (t or ""), add_special_tokens=False).ids]
    vocabulary = encoder.vocabulary()
    for t in texts[3:60]:
        assert b"".join(vocabulary[i] for i in library.encode(t or "", add_special_tokens=False).ids) == (t or "").encode()


def test_memory_forgets_only_what_is_not_asked():
    asked = []
    memory = Memory(lambda ps: [asked.append(p) or p.encode() for p in ps], limit=3)
    assert memory.look(["a", "b"]) == [b"a", b"b"] and memory.look(["c", "d", "a"]) == [b"c", b"d", b"a"]
    assert memory.look(["a", "e"]) == [b"a", b"e"] and asked == ["a", "b", "c", "d", "e"]


def test_gather_and_slices():
    values, each = gather([b"", b"\1\0\0\0", b"\2\0\0\0\3\0\0\0"], np.array([2, 0, 1, 2]))
    assert values.tolist() == [2, 3, 1, 2, 3] and each.tolist() == [2, 0, 1, 2]
    batch = pa.record_batch([pa.array(["aa", None, "b" * 50, "cc", ""])], ["t"])
    assert [b.column(0).to_pylist() for b in text_slices(iter([batch]), 0, 4)] == [["aa", None], ["b" * 50], ["cc", ""]]


def test_order_of_repeated_ids_is_fixed(spark):
    rows = [(1, f"text {k}") for k in range(60)] + [(None, f"none {k}") for k in range(40)] + [(0, "a"), (2, "b")]
    found = []
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
        got = token_shards.encode_documents(docs, tokenizer_path("byte_bpe_50k.json")).collect()
        found.append(sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got))
    assert found[0] == found[1] and len(found[0]) == 102


def test_pieces_and_spans_of_batches_are_those_of_single_texts():
    codec = Codec(tokenizer_path("piece_bpe_32k.model"))
    assert codec.direct
    codec.parts.limit = 50  # generations change
    texts = hard_texts(400)
    for some in (texts, texts[:1], texts[4:9], ["▁"], ["a▁ b", "", "c", "x ▁"], []):
        ids, begins, ends, counts = codec.encode_batch(pa.array(some, pa.string()))
        at = np.cumsum([0, *counts.tolist()])
        assert at[-1] == len(ids) == len(begins) == len(ends) and len(counts) == len(some)
        for k, t in enumerate(some):
            want = codec.encode((t or "").encode())
            own = slice(at[k], at[k + 1])
            assert all(x[own].tolist() == y.tolist() for x, y in zip((ids, begins, ends), want, strict=True)), t
            assert ids[own].tolist() == codec.library.encode(t or "")


def _new_words(n=300_000, each=20_000):
    """Texts of words that do not come up again."""
    return [pa.array([" ".join(f"w{k}" for k in range(at, at + each))]) for at in range(0, n, each)]


def test_worker_keeps_few_pieces():
    codec = Codec(tokenizer_path("piece_bpe_32k.model"))
    for texts in _new_words():
        codec.encode_batch(texts)
    assert len(codec.parts.newer) + len(codec.parts.older) <= 200_000  # all 300,000 before


def test_worker_keeps_few_parts_and_runs():
    encoders = Encoders(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    for texts in _new_words():
        encoders.encode(texts)
    assert max(len(m.newer) + len(m.older) for m in (encoders.parts, encoders.a.runs)) <= 200_000  # all 300,000 before


def test_slices_give_memory_back(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(1)

    batches = [pa.RecordBatch.from_arrays([pa.array(["abc"] * 10)], ["text"])] * 2
    monkeypatch.setattr(parts.pa, "default_memory_pool", Pool)
    assert sum(b.num_rows for b in text_slices(iter(batches), 0, 15)) == 20 and len(released) == 4
    assert sum(b.num_rows for b in common.sliced(iter(batches), 5)) == 20 and len(released) == 6
