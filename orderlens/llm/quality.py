"""Line-first quality rules, in DataFrame functions only.

Each line that holds a word is judged by itself: too many symbols, navigation (words between bars), all capitals,
a stock phrase of licences and page furniture, or a run of words without a single sentence mark. Failing lines are
removed (lines without a word stay as they are); a document that loses more than ``max_lost`` of its characters is rejected, and so is one that fails the
base rules (fewer than ``min_words`` words, or too many words inside repeated five-word windows).

Words are runs of characters other than space and \\t \\n \\v \\f \\r. Null or empty text has no words and fails. A
null or repeated ``doc_id`` is a row like any other: nothing here looks across rows, so nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
#: Stock phrases of licences and page furniture, in lower case.
STOCK = [
    "all rights reserved", "licensed under", "license, version", "terms of service", "terms of use",
    "privacy policy", "accept cookies", "cookie policy", "enable javascript", "click here", "subscribe to our",
    "sign in", "log in", "skip to content",
]
MARKS = "[.!?:;…。！？]"


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) == ""


def _lit_in(line: Column, phrases: list[str]) -> Column:
    low = F.lower(line)
    found = F.contains(low, F.lit(phrases[0]))
    for p in phrases[1:]:
        found = found | F.contains(low, F.lit(p))
    return found


def line_fails(line: Column, has_symbols: Column) -> Column:
    """Whether a line breaks a rule. ``has_symbols``: whether its document holds a symbol at all."""
    n = F.size(F.split(F.btrim(line, F.lit(SPACES)), "[ \\t-\\r]+"))
    symbols = F.when(has_symbols, F.regexp_count(line, F.lit(SYMBOLS))).otherwise(0)
    noisy = symbols * 10 > n * 3
    shouted = (n >= 3) & (F.upper(line) == line) & (F.lower(line) != line)
    unmarked = (n >= 10) & ~F.rlike(line, F.lit(MARKS))
    return noisy | shouted | unmarked | _lit_in(line, STOCK)


def _covered(positions: Column) -> Column:
    """Words covered by five-word windows that start at the ascending positions."""
    start = F.struct(F.lit(-5).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(
        positions,
        start,
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(5), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )


def judged(docs: DataFrame, text: str = "text", min_words: int = 10, max_repeat: int = 20, max_lost: float = 0.5) -> DataFrame:
    """The input's columns and ``q``, a struct of counts, ``base_failed``, ``kept`` and the ``cleaned`` text.

    A column of the input that is called ``q`` (in any case) gives way to the result, as in ``withColumn``.
    """
    own = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    a = own.select("row", "t", words(F.col("t")).alias("w"))
    n = F.size("w")
    window = F.transform(
        F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(5)])
    )
    b = a.select(
        "row", "t", n.alias("n_words"), F.length(F.array_join("w", "")).alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda x: ~_blank(x)).alias("lines"),
        F.when(n >= 5, window).otherwise(F.array().cast("array<bigint>")).alias("h"),
    )
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    c = b.withColumn(
        "s", F.when(repeats, F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    ).drop("h")

    def same(x: Column, k: Column) -> Column:
        return F.coalesce(F.get("s", k)["h"] == x["h"], F.lit(False))

    places = F.sort_array(F.transform(F.filter("s", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))
    good = F.filter(F.split("t", "\n"), lambda x: _blank(x) | ~line_fails(x, F.col("n_symbols") > 0))
    d = c.select(
        "row", "t", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.coalesce(_covered(places), F.lit(0)).alias("n_repeat_words"),
        F.array_join(good, "\n").alias("cleaned"),
    )
    failed = (F.col("n_words") < min_words) | (
        F.col("n_repeat_words").cast("bigint") * 100 > F.col("n_words").cast("bigint") * max_repeat
    )
    e = d.select("*", failed.alias("base_failed"))
    kept = ~F.col("base_failed") & (F.length("cleaned") >= F.length("t") * (1 - max_lost))
    counts = [F.col(x).cast("bigint").alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return e.select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() != "q"],
        F.struct(*counts, "base_failed", kept.alias("kept"), "cleaned").alias("q"),
    )
