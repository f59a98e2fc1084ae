"""Quality rules, line first: lines are judged one by one, then what is left of a text.

A line with a word fails by one of these rules:

* punctuation: it has no sentence end (a mark at its end, or one before a blank), or
  runs of repeated marks (``!!``, ``***``) behind a quarter of its words or more;
* navigation: separators such as ``|`` or ``»`` cut it into four parts or more, of three
  words each at most on average;
* boilerplate: it has fewer than ``SHORT`` words, with a phrase of page furniture.

Failing lines are removed. A document is kept if it passes the base limits (50 words, and
at most half of the words in repeated windows of three) and if removal took at most
``MAX_LOST`` of the characters of its lines. Everything is worked out inside the row, by
Spark's own expressions: there is no shuffle, and no step is more than n log n in the
length of a text.

Defined cases: null, empty and blank texts have no words, fail the base limits and clean
to an empty text; repeated rows and ids are judged each for itself; an empty table gives
an empty result. Other columns are not read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.columns import BLANKS, blank_split, let

MIN_WORDS = 50
SHORT = 15
MAX_LOST = 0.5
SYMBOLS = "#*$%&|<>"
# Phrases of page furniture, lower-cased.
FURNITURE = (
    "accept cookies", "all rights reserved", "back to top", "click here", "cookie policy", "enable javascript",
    "follow us", "forgot password", "log in", "lorem ipsum", "privacy policy", "read more", "share on", "sign in",
    "sign up", "skip to content", "subscribe to", "terms of service", "terms of use", "we use cookies",
)
SENTENCE_END = r"""[.!?…。！？:;]["'”’)»\]]*(\s|$)"""
MARK_RUNS = r"([^\p{L}\p{N}\s])\1+"
SEPARATORS = r"\s[|»›•·>]+(?=\s|$)"


def _failures(line: Column) -> Column:
    """The rule that the line fails, or null."""
    n_words = F.size(blank_split(line))
    parts = F.size(F.split(line, SEPARATORS))
    runs = F.regexp_count(line, F.lit(MARK_RUNS))
    furniture = F.lower(line).rlike("|".join(FURNITURE))
    return let(n_words, lambda n: (
        F.when(~line.rlike(SENTENCE_END) | (runs * 4 >= n) & (runs >= 3), "punctuation")
        .when((parts >= 4) & (n <= parts * 4), "navigation")
        .when((n < SHORT) & furniture, "boilerplate")
    ))


def _repeated(words: Column) -> Column:
    """Words inside a window of three that stands twice or more in the text."""
    def of(w: Column) -> Column:
        n = F.size(w) - 2
        # Windows with their places, sorted: equal ones become neighbours.
        windows = F.sort_array(F.arrays_zip(
            F.slice(w, 1, n).alias("a"), F.slice(w, 2, n).alias("b"), F.slice(w, 3, n).alias("c"), F.sequence(F.lit(1), n).alias("p")))
        def twins(s: Column) -> Column:
            beside = F.arrays_zip(F.slice(s, 1, n - 1).alias("x"), F.slice(s, 2, n - 1).alias("y"))
            equal = F.filter(beside, lambda t: (t["x"]["a"] == t["y"]["a"]) & (t["x"]["b"] == t["y"]["b"]) & (t["x"]["c"] == t["y"]["c"]))
            places = F.transform(equal, lambda t: F.array(*[t[k]["p"] + i for k in ("x", "y") for i in range(3)]))
            return F.size(F.array_distinct(F.flatten(places)))
        return F.when(n >= 2, let(windows, twins)).otherwise(0)
    return let(words, of)


def judge_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS, max_lost: float = MAX_LOST) -> DataFrame:
    """One row per document with its counts, verdicts, ``failed_lines`` by rule and ``clean_text``."""
    text = F.coalesce(F.col("_rollcall_text"), F.lit(""))
    has_word = lambda l: F.length(F.btrim(l, F.lit(BLANKS))) > 0
    judged = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_rollcall_text")
    ).select(
        "doc_id",
        F.size(blank_split(text)).cast("long").alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(F.filter(F.split(text, "\n"), has_word), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated(blank_split(text)).cast("long").alias("n_repeat_words"),
        F.transform(F.filter(F.split(text, "\n"), has_word), lambda l: F.struct(l.alias("line"), _failures(l).alias("rule"))).alias("lines"),
    )
    size = lambda lines: F.aggregate(lines, F.lit(0).cast("long"), lambda n, l: n + F.length(l["line"]))
    kept = F.filter("lines", lambda l: l["rule"].isNull())
    measured = judged.select(
        "*", size(F.col("lines")).alias("line_chars"), size(kept).alias("kept_chars"),
        F.array_join(F.transform(kept, lambda l: l["line"]), "\n").alias("clean_text"),
        F.filter(F.transform("lines", lambda l: l["rule"]), lambda r: r.isNotNull()).alias("failed_lines"),
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    enough = F.col("kept_chars") >= (1 - max_lost) * F.col("line_chars")
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & enough & (F.col("kept_chars") > 0)).alias("kept"), "line_chars", "kept_chars", "failed_lines", "clean_text",
    )


def drop_poor(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents that are kept: ``doc_id`` and ``clean_text``."""
    return judge_lines(docs, id_col, text_col).filter("kept").select("doc_id", "clean_text")
