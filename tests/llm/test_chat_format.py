"""Chat formatting: round trip, loss masks and examples against plain Python."""

import hashlib
import random

import pytest

from encore.llm import chat_format
from encore.llm.queries import FORGED, op12_chat_format

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    """Digests of conversations by plain Python; the order is turn, role, text, nulls first."""
    out = {}
    for conv in {r[0] for r in rows}:
        key = lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        told = "".join(f"{a}\n{b}\n" for a, b in turns)
        loss = "".join(b for a, b in turns if a == "assistant")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (told, loss)]
        out[conv] = (len(turns), sha[0], len(loss), sha[1])
    return out


def digests(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def hard_rows():
    rng = random.Random(5)
    parts = ["\\", "#", "##", "###", "</turn>", "\n", "<", "/turn>", "### assistant:", "é", "漢", " ", "$1", "\\\\", "\n</turn>\n", ":\n", ""]
    roles = ["user", "assistant", "system", "### x:\n", "a b%20\\", None, "", "Assistant"]
    rows = [(None, 0, "user", "of no conversation"), (None, 1, "assistant", None), (1, None, "user", "no turn"), (1, 0, "assistant", "a")]
    rows += [(2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (2, 0, "user", "same"), (3, 5, None, None)]
    rows += [(9, k, rng.choice(["user", "assistant"]), f"turn {k} " * 3) for k in range(600)]
    for conv in range(20, 60):
        rows += [(conv, k, rng.choice(roles), "".join(rng.choices(parts, k=rng.randint(0, 9)))) for k in range(rng.randint(1, 7))]
    return rows


def test_round_trip_of_hard_texts(spark):
    rows = hard_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert digests(chat_format.format_conversations(df)) == expected(rows)


def test_examples_hold_prefix_and_only_the_reply_is_trainable(spark):
    rows = [r for r in hard_rows() if r[0] != 9]
    turns = chat_format.turn_rows(spark.createDataFrame(rows, SCHEMA))
    texts = {(r.conv_id, r.turn_no): r for r in chat_format.with_text(turns).collect()}
    masks = {(r.conv_id, r.turn_no): r for r in chat_format.masked(chat_format.examples(turns)).collect()}
    by_conv = {}
    for r in sorted(turns.collect(), key=lambda r: r.turn_no):
        by_conv.setdefault(r.conv_id, []).append(r)
    assert texts.keys() == masks.keys()
    for conv, ts in by_conv.items():
        for k, t in enumerate(ts):
            made = texts.get((conv, k))
            assert (made is not None) == (t.trainable or k == len(ts) - 1)
            if made is None:
                continue
            mask = masks[conv, k]
            assert made.text == "".join(x.formatted for x in ts[: k + 1]) and len(made.text) == mask.text_end
            assert (made.loss_begin, made.loss_end) == (mask.loss_begin, mask.loss_end)
            if t.trainable:
                inside = made.text[made.loss_begin : made.loss_end]
                assert made.text[: made.loss_begin].endswith("### assistant:\n") and made.text[made.loss_end :] == chat_format.CLOSE
                assert mask.loss_text == inside.replace("\\\\", "\0").replace("\\", "").replace("\0", "\\")
            else:
                assert made.loss_begin is None and mask.loss_text is None


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "x", "y", 7)], SCHEMA + ", formatted string, turn_no int")
    assert digests(chat_format.format_conversations(df)) == expected([(1, 0, "assistant", "x")])
    empty = spark.createDataFrame([], SCHEMA)
    assert chat_format.format_conversations(empty).collect() == []
    assert chat_format.with_text(chat_format.turn_rows(empty)).collect() == []


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", FORGED), (-7, 1, "assistant", FORGED)]
    found = op12_chat_format(spark, sf_dir)
    assert digests(found) == expected(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_digests_are_read_from_the_examples(spark):
    rows = [r for r in hard_rows() if r[0] != 9] + [(7, 0, "user", "q"), (7, 1, "assistant", "abc"), (7, 2, "user", "r"), (7, 3, "assistant", "défg")]
    made = chat_format.with_text(chat_format.turn_rows(spark.createDataFrame(rows, SCHEMA)))
    found = chat_format.read_back(made)
    assert digests(found) == expected(rows)
    chars = {}
    for r in made.collect():
        chars[r.conv_id] = chars.get(r.conv_id, 0) + len(r.text)
    assert {r.conv_id: r.formatted_chars for r in found.collect()} == chars
    # Other texts or masks, other digests: nothing is taken from elsewhere.
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    shorter = digests(chat_format.read_back(made.where("conv_id = 7").selectExpr("conv_id", "turn_no", "text", "loss_begin + 1 AS loss_begin", "loss_end", "last")))
    assert shorter == {7: (4, expected(rows)[7][1], 5, sha("bcéfg"))}
    other = digests(chat_format.read_back(made.where("conv_id = 7").selectExpr("conv_id", "turn_no", "translate(text, 'bé', 'BE') AS text", "loss_begin", "loss_end", "last")))
    assert other[7][2:] == (7, sha("aBcdEfg")) and other[7][1] != expected(rows)[7][1]
