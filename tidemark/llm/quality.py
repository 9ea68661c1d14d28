"""Quality rules: clean line by line, then reject documents that lost too much text.

Only built-in functions: each document is judged from its own row, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import SPACE_RUN, apart, together, words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A document that loses more than this share of its letters, digits and marks is rejected.
MAX_LOST_PERCENT = 40
# A line fails if one of its rules matches at least once in so many words: one phrase does not fail a long line.
WORDS_PER_MATCH = 40

# The symbols counted by n_symbols.
SYMBOLS = r"[#*$%&|<>]"

# A line fails if its symbols exceed one in eight characters, or it shouts,
BAD_PUNCTUATION = r"(?:[!?]{2,}[^!?]+){3}|[.,;:!?-]{12,}"
# if it is a row of links or cells,
NAVIGATION = (
    r"(?:\S\s*[|»›•·]\s*\S[^|»›•·]*){3}"
    r"|^(?i:home|menu|next|previous|back to top|skip to content|log in|sign in|sign up|share|read more)[\s.!»]*$"
)
# or if it says what web pages say everywhere.
BOILERPLATE = (
    r"(?i)all rights reserved|terms (?:of|and) (?:use|service|conditions)|privacy policy|cookie policy|we use cookies"
    r"|enable javascript|subscribe to our|click here to|lorem ipsum|copyright (?:\(c\)|©|\d{4})"
)


def line_fails(line: Column) -> Column:
    symbols = F.length(line) - F.length(F.regexp_replace(line, SYMBOLS, ""))

    def often(pattern: str) -> Column:
        words = F.regexp_count(line, F.lit(SPACE_RUN)) + 1
        return line.rlike(pattern) & (F.regexp_count(line, F.lit(pattern)) * WORDS_PER_MATCH >= words)

    return (symbols * 8 > F.length(line)) | often(BAD_PUNCTUATION) | often(NAVIGATION) | often(BOILERPLATE)


def assess(
    docs: DataFrame,
    text: str = "text",
    *,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    max_lost_percent: int = MAX_LOST_PERCENT,
) -> DataFrame:
    """Add the counts, the cleaned text and the verdict to every document.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed,
    n_lines, n_failed_lines, lost_percent (double), cleaned (the lines that pass, each
    distinct line once) and kept. An input column of such a name is replaced.

    A line fails by its punctuation, as navigation or as boilerplate, in a long line only if that comes again
    and again; a line that equals
    an earlier one is lost too. A document is kept if it has enough words, few repeated
    3-word windows and at least (100 - max_lost_percent) % of its characters in lines that
    pass. Null and empty texts have counts of 0 and fail. Repeated rows are judged each on
    its own, an empty table gives an empty result, and texts are read whole. Equal 3-word
    windows are found by their 64-bit hash.
    """
    columns = docs.columns
    step = apart(docs, text=F.coalesce(F.col(text).cast("string"), F.lit("")))
    step = step.withColumn("words", words_of(F.col("text"))).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    )
    n = F.size("words")
    step = step.withColumn(
        "windows",
        F.when(n < 3, F.array().cast("array<struct<h:bigint,at:int>>")).otherwise(
            F.transform(
                F.arrays_zip(
                    F.slice("words", F.lit(1), n - 2).alias("a"),
                    F.slice("words", F.lit(2), n - 2).alias("b"),
                    F.slice("words", F.lit(3), n - 2).alias("c"),
                ),
                lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("at")),
            )
        ),
    ).withColumn("windows", F.sort_array("windows"))
    # Equal windows are neighbours now; the places of those that have one.
    step = step.withColumn(
        "repeats",
        F.sort_array(
            F.array_distinct(
                F.flatten(
                    F.filter(
                        F.zip_with(
                            "windows",
                            F.slice("windows", F.lit(2), F.greatest(F.size("windows") - 1, F.lit(0))),
                            lambda a, b: F.when(a["h"] == b["h"], F.array(a["at"], b["at"])),
                        ),
                        lambda x: x.isNotNull(),
                    )
                )
            )
        ),
    )
    # Words under those windows: each adds what the one before has not covered.
    covered = F.aggregate(
        "repeats",
        F.struct(F.lit(0).alias("n"), F.lit(-1).alias("last")),
        lambda acc, at: F.struct(
            (acc["n"] + F.lit(2) + at - F.greatest(acc["last"], at - 1)).alias("n"), (at + 2).alias("last")
        ),
        lambda acc: acc["n"].cast("long"),
    )
    step = step.withColumn("distinct_lines", F.array_distinct("lines")).withColumn(
        "passing", F.filter("distinct_lines", lambda x: ~line_fails(x))
    )
    step = step.select(
        "row",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size("distinct_lines")).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        (F.size("distinct_lines") - F.size("passing")).alias("n_failed_lines"),
        F.length(F.array_join("lines", "")).alias("all_chars"),
        F.array_join("passing", "\n").alias("cleaned"),
        F.length(F.array_join("passing", "")).alias("passing_chars"),
    )
    base_failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    lost = F.col("all_chars") - F.col("passing_chars")
    return together(
        step,
        columns,
        **{c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")},
        base_failed=base_failed,
        n_lines=F.col("n_lines"),
        n_failed_lines=F.col("n_failed_lines"),
        lost_percent=F.when(F.col("all_chars") > 0, 100.0 * lost / F.col("all_chars")).otherwise(0.0),
        cleaned=F.col("cleaned"),
        kept=~base_failed & (100 * lost <= max_lost_percent * F.col("all_chars")),
    )


def keep_good(docs: DataFrame, text: str = "text", **limits: int) -> DataFrame:
    """The documents that `assess` keeps, with their own columns and whole texts."""
    columns = docs.columns
    judged = assess(apart(docs, text=F.col(text)), "text", **limits)
    # Exploded, not filtered: a filter would be pushed below and evaluate the rules several times.
    return together(judged.select(F.explode(F.when(F.col("kept"), F.array("row"))).alias("row")), columns)
