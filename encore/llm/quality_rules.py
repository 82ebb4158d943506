"""Line-first quality rules, in DataFrame expressions only.

Every line is judged by three rules; failing lines are removed; a document that loses
more than ``max_lost`` of its text, or fails a base rule, is rejected.

* punctuation: no sentence ends in the line, or it is full of symbols, or shouts;
* navigation: the line is a row of separated links or a single menu word;
* boilerplate: the line holds a stock phrase (cookies, copyright, sign-up ...).

Defined results: a null or blank text has no words and is rejected; blank lines are
neither judged nor counted; repeated rows are judged each for itself; an empty table
gives an empty result; columns of the input are kept and never overwritten.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import fresh

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PCT = 50

# Parameters of the line rules.
MAX_LOST = 0.5
MAX_LINE_SYMBOLS = 0.05
MAX_SHOUTS = 0.03
MIN_SEPARATORS = 3
SEPARATORS = "|»›•·>"
LINE_END = r"[.!?…:;。！？][\"'”’»)\]]*(\s|$)"
MENU = r"(?i)^(home|menu|login|log in|sign in|sign up|register|search|next|previous|back|contact|about( us)?|share)[.!:]*$"
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies",
    "use of cookies", "enable javascript", "click here", "read more", "powered by", "subscribe to", "lorem ipsum",
)

def _count(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars`` (from byte lengths, one fast
    search for each character)."""
    return reduce(
        lambda a, b: a + b,
        [(F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))) / len(c.encode()) for c in chars],
    ).cast("long")


def _has(text: Column, phrases: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in phrases])


def split_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` as an array."""
    return F.array_remove(F.split(text, r"[ \t-\r]+"), "")


def _positions_seen_twice(df: DataFrame, size: int) -> DataFrame:
    """Adds ``starts``: sorted starts of the ``size``-word windows that occur at least twice.

    Windows are sorted as one long each (hash bits above, position below), so that equal
    windows lie side by side; the few that share hash bits are then compared as words,
    which makes the result exact whatever the hash does.
    """
    window = ", ".join(f"get(words, i + {k})" for k in range(size))
    df = df.withColumn("bits", F.expr("int(ceil(log2(n_words + 2)))"))
    df = df.withColumn(
        "packed",
        F.expr(
            f"""case when n_words > {size} then sort_array(transform(sequence(0, int(n_words) - {size}),
                i -> shiftleft(xxhash64({window}), bits) + i)) else array() end"""
        ).cast("array<bigint>"),
    )
    # Places in the sorted array whose successor has the same hash bits; then both of them.
    alike = "transform(packed, (x, k) -> if(shiftright(x ^ get(packed, k + 1), bits) = 0, k, -1))"
    df = df.withColumn("alike", F.expr(f"array_remove({alike}, -1)"))
    df = df.withColumn("alike", F.expr("array_distinct(concat(alike, transform(alike, k -> k + 1)))"))
    df = df.withColumn("maybe", F.expr("transform(alike, k -> int(packed[k] & (shiftleft(1L, bits) - 1)))"))
    df = df.withColumn(
        "spelled", F.expr(f"sort_array(transform(maybe, i -> struct(concat_ws(' ', {window}) as w, i as i)))")
    )
    return df.withColumn(
        "starts",
        F.expr(
            """sort_array(transform(filter(transform(spelled, (x, k) -> struct(x.i as i,
                coalesce(x.w = get(spelled, k - 1).w, false) or coalesce(x.w = get(spelled, k + 1).w, false) as twice)),
                y -> y.twice), y -> y.i))"""
        ),
    )


def base_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` with the word, symbol and repetition counts of whole texts and the line verdicts."""
    df = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    df = df.withColumn("words", split_words(F.col("text")))
    df = df.withColumn("n_words", F.size("words").cast("long"))
    df = _positions_seen_twice(df, 3)
    # Windows of three words cover three words each, less what the next one covers too.
    df = df.withColumn(
        "n_repeat_words",
        F.expr(
            "aggregate(transform(starts, (p, k) -> least(3, coalesce(get(starts, k + 1) - p, 3))), 0L, (a, x) -> a + x)"
        ),
    )
    df = df.withColumn("lines", F.expr(r"filter(split(text, '\n', -1), l -> l rlike '[^ \t-\r]')"))
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    df = df.withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
    df = df.withColumn("n_symbols", _count(F.col("text"), SYMBOLS))
    return df.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PCT * F.col("n_words")),
    )


def _line_failure(line: Column, doc: Column) -> Column:
    """Name of the first rule that a line fails, or null. What the whole document lacks
    (``n_symbols``, ``n_separators``, ``n_shouts``, ``has_stock``) is not looked for in its lines."""
    bare = F.trim(line)
    shouts = _count(bare, "!")
    symbols = _count(bare, SYMBOLS) > MAX_LINE_SYMBOLS * F.length(bare)
    return (
        F.when((doc["n_separators"] >= MIN_SEPARATORS) & (_count(bare, SEPARATORS) >= MIN_SEPARATORS), "navigation")
        .when((F.length(bare) <= 12) & bare.rlike(MENU), "navigation")
        .when(~bare.rlike(LINE_END), "punctuation")
        .when((doc["n_symbols"] > 0) & symbols, "punctuation")
        .when((doc["n_shouts"] > 2) & (shouts > 2) & (shouts > MAX_SHOUTS * F.length(bare)), "punctuation")
        .when(doc["has_stock"] & _has(F.lower(bare), BOILERPLATE), "boilerplate")
    )


def _judged_lines() -> Column:
    """``(line, rule)`` of every line. The document's values enter through the one element of
    an array: named as columns inside the lambda, the optimizer may put their expressions
    there, and whole texts would be searched once for each line."""
    names = ("lines", "n_separators", "n_symbols", "n_shouts", "has_stock")
    per_doc = F.transform(
        F.array(F.struct(*names)),
        lambda doc: F.transform(doc["lines"], lambda l: F.struct(l.alias("line"), _line_failure(l, doc).alias("rule"))),
    )
    return F.get(per_doc, F.lit(0))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """One row per document: ``key``, the base counts, lines removed by rule, lost text
    share, cleaned text, ``base_failed`` and ``kept``."""
    df = base_statistics(docs, key, text)
    df = df.withColumn("n_separators", _count(F.col("text"), SEPARATORS)).withColumn("n_shouts", _count(F.col("text"), "!"))
    df = df.withColumn("has_stock", _has(F.lower("text"), BOILERPLATE))
    df = df.withColumn("judged", _judged_lines())
    df = df.withColumn("kept_lines", F.expr("transform(filter(judged, j -> j.rule is null), j -> j.line)"))
    chars = "aggregate({}, 0L, (a, l) -> a + length(l))"
    df = df.withColumn("line_chars", F.expr(chars.format("lines"))).withColumn("left_chars", F.expr(chars.format("kept_lines")))
    lost = F.when(F.col("line_chars") > 0, 1 - F.col("left_chars") / F.col("line_chars")).otherwise(F.lit(1.0))
    df = df.withColumn("lost_share", lost)
    # A text that loses no line stays as it is, blank lines included.
    cleaned = F.when(F.size("kept_lines") == F.size("lines"), F.col("text")).otherwise(F.array_join("kept_lines", "\n"))
    rule = [F.expr(f"size(filter(judged, j -> j.rule = '{r}'))").cast("long").alias(f"n_{r}_lines") for r in
            ("punctuation", "navigation", "boilerplate")]
    at = fresh(docs, "_at")
    out = df.select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *rule,
        "lost_share", cleaned.alias("clean_text"), "base_failed",
        (~F.col("base_failed") & (F.col("lost_share") <= F.lit(max_lost))).alias("kept"),
        F.monotonically_increasing_id().alias(at),
    )
    # A caller's filter is not pushed below a column that is not deterministic; pushed down,
    # it would hold a copy of every expression above for each place that uses it.
    return out.where(F.col(at) >= 0).drop(at)


def clean(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """The documents that are kept, all columns, with failing lines taken out of their
    text (``n_chars``, where there is one, follows the text). No shuffle, no join."""
    row = fresh(docs, "_row")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), F.col(f"`{text}`").alias("text"))
    out = judge(packed, row, "text", max_lost).where(F.col("kept"))
    cols = []
    for c, kind in docs.dtypes:
        if c == text:
            cols.append(F.col("clean_text").alias(c))
        elif c == "n_chars" and text == "text":
            cols.append(F.length("clean_text").cast(kind).alias(c))
        else:
            cols.append(F.col(row).getField(c).alias(c))
    return out.select(*cols)
