"""Quality rules: line-first cleaning, in DataFrame functions only.

Every line is judged by itself: punctuation rules (no closing mark, mostly shouted or
symbol-laden words), navigation rules (separator lists, link rows) and boilerplate rules
(licence, cookie and sign-up phrases). Lines that fail go, and a document that loses too
much of its text, or fails the counts of the whole text, is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words
from .decontam import let

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Java regexes of the line rules, matched on the stripped, lower-cased line.
ENDS = r"""[.!?:;…。！？"'”’»)\]][\x22\x27”’»)\]]*$"""
NAVIGATION = r"^(home|menu|next|previous|prev|back|top|search|login|log in|sign in|sign up|share|tweet|print|contact|about)( us| up| in)?$|^(\S+ ){0,3}\S*( ?[|»›•·>] ?(\S+ ?){1,3}){3,}$"
BOILERPLATE = r"all rights reserved|copyright ©|©|\(c\) ?\d{4}|(licensed|released|distributed) under|terms of (use|service)|privacy policy|cookie|javascript|click here|subscribe|newsletter|lorem ipsum|powered by|read more"


def repeated_window_words(w: Column, size: int = 3) -> Column:
    """Words covered by ``size``-word windows that occur at least twice among the words ``w``."""

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda p, j: F.least(F.lit(size), F.coalesce(F.get(at, j + 1) - p, F.lit(size))))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def spots(pairs: Column) -> Column:
        same = lambda x, j: x["h"] == F.get(pairs, j)["h"]
        twice = F.filter(pairs, lambda x, j: F.coalesce(same(x, j - 1), F.lit(False)) | F.coalesce(same(x, j + 1), F.lit(False)))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def counted(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(F.sort_array(pairs), spots))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)]))
    return F.when(F.size(w) <= size, F.lit(0)).otherwise(let(windows, counted))


def line_fails(line: Column, max_words: int = 40) -> Column:
    """Name of the first rule that a line breaks, else null. Blank lines break none."""

    def rule(x: Column) -> Column:
        n = F.size(F.split(x, SPACED))
        bare = F.translate(x, SYMBOLS, "")
        symbols = F.length(x) - F.length(bare)
        bangs = F.length(x) - F.length(F.replace(x, F.lit("!!"), F.lit("!")))
        return (
            F.when(x == "", F.lit(None).cast("string"))
            .when((n <= max_words) & x.rlike(BOILERPLATE), F.lit("boilerplate"))
            .when(x.rlike(NAVIGATION) | (2 * (F.length(x) - F.length(F.translate(x, "|", ""))) >= n) & (n > 3), F.lit("navigation"))
            .when(~x.rlike(ENDS) | (2 * symbols > n) & (n > 3) | (3 * bangs > n), F.lit("punctuation"))
        )

    return let(F.lower(F.trim(F.translate(line, "\t\x0b\f\r", "    "))), rule)


SPACED = " +"


def assess(docs: DataFrame, *, text: str = "text", min_words: int = 50, max_repeat_share: float = 0.5, max_lost_share: float = 0.5) -> DataFrame:
    """``docs`` with the counts, the cleaned text and the verdict of each row.

    Words are runs of anything but ASCII white space. n_words; word_chars (code points in
    words); n_symbols; n_dup_lines (\\n-split lines with a word that equal an earlier
    line); n_repeat_words (words in 3-word windows that occur twice or more); base_failed
    (under ``min_words``, or over ``max_repeat_share`` of the words repeated); n_lines and
    n_failed_lines (non-blank), lost_share (code points in failed lines against all in
    non-blank lines), clean_text (the lines left, joined by \\n), kept (not base_failed, and
    at most ``max_lost_share`` lost). Null text has no word: it fails, with clean_text "".
    Repeated rows are judged alike. Columns of these names are replaced.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines", "n_failed_lines", "lost_share", "clean_text", "kept")
    rest = [c for c in docs.columns if c not in added]
    t = F.coalesce(F.col(text), F.lit(""))
    by_words = lambda w: F.struct(F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"), repeated_window_words(w).cast("long").alias("again"))
    chars = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + F.length(x["l"]))

    def by_lines(a: Column) -> Column:
        full = F.filter(a, lambda l: l.rlike(r"[^\x20\x09-\x0D]"))
        judged = F.transform(a, lambda l: F.struct(l.alias("l"), line_fails(l).alias("why"), l.rlike(r"[^\x20\x09-\x0D]").alias("full")))

        def summed(j: Column) -> Column:
            good = F.filter(j, lambda x: x["why"].isNull())
            return F.struct(
                (F.size(full) - F.size(F.array_distinct(full))).cast("long").alias("dup"),
                F.size(full).cast("long").alias("lines"),
                (F.size(j) - F.size(good)).cast("long").alias("failed"),
                chars(F.filter(j, lambda x: x["full"])).alias("all"),
                chars(F.filter(j, lambda x: x["why"].isNotNull())).alias("lost"),
                F.array_join(F.transform(good, lambda x: x["l"]), "\n").alias("clean"),
            )

        return let(judged, summed)

    made = docs.select(*rest, let(words(t), by_words).alias("_mr_w"), let(F.split(t, "\n"), by_lines).alias("_mr_l"), (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    n, again = F.col("_mr_w.n"), F.col("_mr_w.again")
    failed = (n < min_words) | (100 * again > 100 * max_repeat_share * n)
    lost = F.col("_mr_l.lost") / F.greatest(F.col("_mr_l.all"), F.lit(1))
    return made.select(
        *rest, n.alias("n_words"), F.col("_mr_w.chars").alias("word_chars"), "n_symbols", F.col("_mr_l.dup").alias("n_dup_lines"), again.alias("n_repeat_words"), failed.alias("base_failed"),
        F.col("_mr_l.lines").alias("n_lines"), F.col("_mr_l.failed").alias("n_failed_lines"), lost.alias("lost_share"), F.col("_mr_l.clean").alias("clean_text"), (~failed & (lost <= max_lost_share)).alias("kept"),
    )
