"""Line-first quality rules (DataFrame functions only).

Every line is judged by itself: punctuation, navigation and boilerplate rules
remove lines; a document that loses too much of its text is rejected. The
base rules of the digest (too few words, too much repetition) come on top.

The whole operator is one projection: no shuffle, no Python.

Defined results: a null text counts as an empty one (no words, base_failed);
a null id passes through; repeated rows give repeated rows; an empty table
gives an empty one; a column of the input named like ``out`` is replaced, all
others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, blank_words, starts, whole

SYMBOLS = "#*$%&|<>"

#: Runs of symbols or of shouting marks glued to words.
MARK_RUN = "[#*$%&<>]{2,}|[!?]{2,}"
#: Separators of menus and breadcrumbs, standing alone.
SEPARATOR = "[ \\t][|»›•·>][ \\t]"
PUNCTUATION = "\\p{P}"
BOILERPLATE = ("we use cookies", "cookie policy", "cookie settings", "cookie consent", "accept cookies",
               "accept all cookies", "enable javascript", "requires javascript", "javascript is disabled",
               "javascript is required", "terms of use", "terms of service", "privacy policy",
               "all rights reserved", "subscribe to our", "sign up for our", "click here",
               "skip to content", "skip to main content", "share on facebook", "share on twitter",
               "lorem ipsum", "back to top")
#: Every phrase has one of these.
BOILERPLATE_STEMS = ("cookie", "javascript", "terms of ", "privacy policy", "all rights reserved", "subscribe to",
                     "sign up for", "click here", "skip to ", "share on ", "lorem ipsum", "back to top")

#: Percent of a line's words that may carry mark runs, or be followed by a separator.
MARK_PERCENT = 20
SEPARATOR_PERCENT = 20
#: A line without any punctuation is prose only below this many words.
BARE_WORDS = 40
#: Boilerplate phrases condemn short lines only.
BOILERPLATE_WORDS = 30
#: A document may lose this percent of its word characters.
LOST_PERCENT = 30


def _letters(text: Column) -> Column:
    """Characters outside blanks."""
    return F.char_length(F.regexp_replace(text, BLANKS, ""))


def _occurrences(text: Column, pattern: str) -> Column:
    return F.size(F.split(text, pattern)) - 1


def _mentions(low: Column, phrases: tuple[str, ...]) -> Column:
    found = low.contains(phrases[0])
    for phrase in phrases[1:]:
        found = found | low.contains(phrase)
    return found


def bare_line(line: Column) -> Column:
    """A long line without any punctuation."""
    return ~line.rlike(PUNCTUATION) & (F.size(blank_words(line)) >= BARE_WORDS)


def line_fails(line: Column) -> Column:
    """Whether one line breaks the punctuation, the navigation or the boilerplate rule."""
    n = F.size(blank_words(line))
    marks = _occurrences(line, MARK_RUN)
    separators = _occurrences(line, SEPARATOR)
    punctuation = ((marks >= 2) & (marks * 100 > n * MARK_PERCENT)) | bare_line(line)
    navigation = (separators >= 2) & (separators * 100 > n * SEPARATOR_PERCENT)
    boilerplate = _mentions(F.lower(line), BOILERPLATE) & (n <= BOILERPLATE_WORDS)
    return punctuation | navigation | boilerplate


def failed_lines(text: Column, low: Column, lines: Column) -> Column:
    """One boolean a line. A text without any mark run, separator or boilerplate
    stem, found by one scan each, needs the rule of bare lines only."""
    suspect = text.rlike(MARK_RUN) | text.rlike(SEPARATOR) | _mentions(low, BOILERPLATE_STEMS)
    return (F.when(suspect, F.transform(lines, line_fails))
            .otherwise(F.transform(lines, bare_line)))


def annotate(docs: DataFrame, text_col: str = "text", out: str = "quality",
             min_words: int = 50, repeat_percent: int = 50,
             lost_percent: int = LOST_PERCENT) -> DataFrame:
    """``docs`` with the struct column ``out``: the measures, the verdict and the cleaned text.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed, kept (boolean), n_lines, n_bad_lines, lost_chars (long),
    cleaned (the text without its failed lines).
    """
    t, w, lines, bad, h, s, p = (F.col(f"__q_{x}") for x in ("t", "w", "lines", "bad", "h", "s", "p"))
    if out in docs.columns and out != text_col:
        docs = docs.drop(out)
    # Columns that are named like the steps' own stand aside meanwhile.
    aside = {c: f"__kept{c}" for c in docs.columns if c.startswith("__q_")}
    docs = docs.withColumnsRenamed(aside)
    text_col = aside.get(text_col, text_col)
    d = docs.withColumn("__q_t", whole(F.col(text_col))).withColumn("__q_low", F.lower(t))
    d = d.withColumns({
        "__q_w": blank_words(t),
        "__q_lines": F.split(t, "\n"),
    })
    d = d.withColumns({
        # 3-word windows as 64-bit hashes: within one text a false match has a chance below 1e-9.
        "__q_h": F.transform(starts(w, 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
        "__q_bad": failed_lines(t, F.col("__q_low"), lines),
    })
    # Only texts with an equal pair of windows pay for the sort.
    d = d.withColumn("__q_s", F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    d = d.withColumn("__q_p", F.sort_array(F.transform(
        F.filter(s, lambda e, k: F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
                 | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False))),
        lambda e: e["i"])))
    repeated = F.coalesce(F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(3), F.get(p, k + 1) - x).cast("long")),
        F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0).cast("long"))
    worded = F.filter(lines, lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    keep = F.filter(lines, lambda x, k: ~F.get(bad, k))
    d = d.withColumns({
        "__q_n": F.size(w).cast("long"),
        "__q_chars": F.char_length(F.concat_ws("", w)).cast("long"),
        "__q_symbols": F.char_length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("long"),
        "__q_worded": worded,
        "__q_repeated": repeated,
        "__q_clean": F.when(F.exists(bad, lambda b: b), F.array_join(keep, "\n")).otherwise(t),
    })
    n, chars, rep = F.col("__q_n"), F.col("__q_chars"), F.col("__q_repeated")
    clean = F.col("__q_clean")
    # The row number makes this a step that filters are not pushed through. Pushed down, a filter
    # on the verdict would spell the steps below out again, line rules inside line loops.
    d = d.withColumns({
        "__q_failed": F.when(F.monotonically_increasing_id() >= 0,
                             (n < min_words) | (rep * 100 > n * repeat_percent)),
        "__q_lost": F.when(F.exists(bad, lambda b: b), chars - _letters(clean)).otherwise(F.lit(0)).cast("long"),
        "__q_dup": (F.size("__q_worded") - F.size(F.array_distinct("__q_worded"))).cast("long"),
    })
    failed, lost = F.col("__q_failed"), F.col("__q_lost")
    d = d.withColumn(out + "__new" if out == text_col else out, F.struct(
        n.alias("n_words"), chars.alias("word_chars"), F.col("__q_symbols").alias("n_symbols"),
        F.col("__q_dup").alias("n_dup_lines"), rep.alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & (lost * 100 <= chars * lost_percent)).alias("kept"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(bad, lambda b: b)).cast("long").alias("n_bad_lines"),
        lost.alias("lost_chars"), clean.alias("cleaned")))
    return d.drop(*[c for c in d.columns if c.startswith("__q_")]).withColumnsRenamed({v: k for k, v in aside.items()})


def keep_clean(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that pass, with their failed lines removed; columns as in ``docs``.

    ``n_chars``, where there is such a column, is set to the length of the new text.
    """
    d = annotate(docs, text_col, out="__quality", **options)
    d = d.where("__quality.kept")
    cols = [F.col("__quality.cleaned").alias(c) if c == text_col
            else F.char_length("__quality.cleaned").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col(f"`{c}`") for c in docs.columns]
    return d.select(*cols)


def quality_digest(docs: DataFrame) -> DataFrame:
    """The digest of ``op1``: one row per document with its measures and verdict."""
    d = annotate(docs.select("doc_id", "text"), out="quality")
    q = F.col("quality")
    return d.select("doc_id", *[q[f].alias(f) for f in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_bad_lines", "lost_chars")])
