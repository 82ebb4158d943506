"""Chat formatting: every assistant turn becomes an example of its own.

A conversation's turns are written one after the other by a template; an example is the
text up to the end of one assistant turn, of which only that turn's words are trainable
(its context is all turns before it). A last row without trainable text holds the whole
conversation where turns follow the last assistant turn, so that nothing is lost.

Template: ``### <role>:``, a line end, the text, a line end, ``</turn>``, a line end. Inside
texts a backslash stands before each backslash, ``###`` and ``</turn>``; roles are
percent-encoded. So no text can open or close a turn, and reading back is exact.

Windows and string functions only. Turns are shuffled once, by conversation. ``examples``
are offsets into their conversation's text, so that their size grows with its turns and
not with their square; ``with_text`` expands them to texts, which the digests are read from.
A conversation of any length streams through windows that spill; its texts need all its
turns in one row.

Defined results: rows of a conversation stand by turn, then role, then text (nulls first;
repeated rows are turns each); null text or role counts as empty; rows without conv_id form
one conversation; a conversation without assistant turns has only the last row; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINABLE = "assistant"
OPEN, CLOSE = "### ", "\n</turn>\n"
_CONTROL = r"(\\|###|</turn>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\" + _CONTROL, "$1")


def formatted(role: Column, text: Column) -> Column:
    """One turn by the template."""
    return F.concat(F.lit(OPEN), F.url_encode(role), F.lit(":\n"), escaped(text), F.lit(CLOSE))


def turn_rows(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn_no (from 0), trainable, formatted, ``begin`` and ``end``
    (code points of the conversation's formatted text), body (where the escaped text begins
    inside ``formatted``) and last (of its conversation). One shuffle, by conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    made = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    made = made.withColumn("turn_no", F.row_number().over(by_turn) - 1)
    # Formatted behind the shuffle, which carries each text once.
    made = made.select(
        "conv_id", "turn_no", (F.col("role") == TRAINABLE).alias("trainable"),
        formatted(F.col("role"), F.col("text")).alias("formatted"),
        (F.length(F.url_encode("role")) + len(OPEN) + 2).cast("long").alias("body"),
    )
    made = made.withColumn("size", F.length("formatted").cast("long"))
    in_order = Window.partitionBy("conv_id").orderBy("turn_no")
    end = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    last = F.lead("turn_no").over(in_order).isNull()
    made = made.select("*", end.alias("end"), last.alias("last"))
    return made.select("conv_id", "turn_no", "trainable", "formatted", (F.col("end") - F.col("size")).alias("begin"), "end", "body", "last")


def marked(rows: DataFrame) -> DataFrame:
    """The ``turn_rows`` with ``is_example`` (a turn that ends an example: a trainable one, or
    the conversation's last), text_end (the example's text is the first ``text_end`` code
    points of the conversation's), the formatted ``reply``, and ``loss_begin`` and
    ``loss_end``, the trainable code points of its text (the last three null where nothing is)."""
    trainable = F.col("trainable")
    return rows.select(
        "*", (trainable | F.col("last")).alias("is_example"), F.col("end").alias("text_end"),
        F.when(trainable, F.col("formatted")).alias("reply"),
        F.when(trainable, F.col("begin") + F.col("body")).alias("loss_begin"),
        F.when(trainable, F.col("end") - len(CLOSE)).alias("loss_end"),
    )


def examples(rows: DataFrame) -> DataFrame:
    """One row per example: conv_id, turn_no (of its last turn), text_end, reply, loss_begin, loss_end."""
    return marked(rows).where("is_example").select("conv_id", "turn_no", "text_end", "reply", "loss_begin", "loss_end")


def with_text(rows: DataFrame) -> DataFrame:
    """(conv_id, turn_no, text, loss_begin, loss_end, last): the examples with their whole texts,
    context and reply; the last one's text is the whole conversation. The texts of a
    conversation grow with the square of its turns; they are made one after the other, and
    only its turns are held together. The mask alone is in ``examples``."""
    kept = F.struct("turn_no", "formatted", "trainable", "last", "begin", "end", "body")
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(kept)).alias("turns"))
    each = listed.select("conv_id", "turns", F.explode(F.filter("turns", lambda t: t["trainable"] | t["last"])).alias("t"))
    t = F.col("t")
    text = F.array_join(F.transform(F.slice("turns", F.lit(1), t["turn_no"] + 1), lambda x: x["formatted"]), "")
    return each.select(
        "conv_id", t["turn_no"].alias("turn_no"), text.alias("text"),
        F.when(t["trainable"], t["begin"] + t["body"]).alias("loss_begin"),
        F.when(t["trainable"], t["end"] - len(CLOSE)).alias("loss_end"), t["last"].alias("last"),
    )


def masked(examples: DataFrame) -> DataFrame:
    """The examples with ``loss_text``: the words under the loss mask, unescaped."""
    before = F.col("text_end") - F.length("reply")
    cut = F.substring("reply", (F.col("loss_begin") - before + 1).cast("int"), (F.col("loss_end") - F.col("loss_begin")).cast("int"))
    return examples.withColumn("loss_text", unescaped(cut))


def parse(text: Column) -> Column:
    """The (role, text) structs of a formatted text, read back."""
    pieces = F.split(text, CLOSE)
    found = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def one(p: Column) -> Column:
        head = F.substring_index(p, ":\n", 1)
        body = F.substring(p, F.length(head) + 3, F.length(p))
        return F.struct(F.url_decode(F.substring(head, F.lit(len(OPEN) + 1), F.length(head))).alias("role"), unescaped(body).alias("text"))

    return F.transform(found, one)


def read_back(texts: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars (code
    points of all examples' texts) of every conversation, read from the examples that
    ``with_text`` wrote: losses by each example's mask from its own text, the turns from the
    text that holds the whole conversation. The texts lie by conversation: no further shuffle."""
    cut = F.substring("text", (F.col("loss_begin") + 1).cast("int"), (F.col("loss_end") - F.col("loss_begin")).cast("int"))
    own = texts.select(
        "conv_id", "turn_no", F.length("text").cast("long").alias("chars"),
        F.when(F.col("loss_begin").isNotNull(), unescaped(cut)).alias("loss_text"), F.when(F.col("last"), F.col("text")).alias("whole"),
    )
    found = own.groupBy("conv_id").agg(
        F.max("whole").alias("whole"),
        F.sort_array(F.collect_list(F.when(F.col("loss_text").isNotNull(), F.struct("turn_no", "loss_text")))).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
    )
    loss = F.array_join(F.transform("losses", lambda x: x["loss_text"]), "")
    # Generators between the steps: the optimizer does not copy their expressions into each other.
    text = found.select("conv_id", "formatted_chars", F.explode(F.array(F.struct("whole", loss.alias("loss")))).alias("text"))
    read = text.select("conv_id", "formatted_chars", "text.loss", F.explode(F.array(parse(F.col("text.whole")))).alias("read"))
    told = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"), "formatted_chars",
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    """The digests of all conversations, formatted into examples and read back from these."""
    return read_back(with_text(turn_rows(turns)))
