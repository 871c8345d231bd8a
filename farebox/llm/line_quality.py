"""Line-first quality rules (operator 5, native).

Every line is judged by itself: punctuation, navigation and boilerplate rules.
Lines that fail are removed; a document that loses too much of its text is
rejected, as is one that fails the base rules (too few words, or too many words
in repeated 8-word windows).

All counts are built-in expressions over one row: no shuffle, no Python.  The
8-word windows are hashed by doubling (1, 2, 4, 8 words), and only documents
whose window hashes aren't all distinct have them sorted.

Cases.  Null text has no words, so it fails the base.  Empty lines and lines
without a word are neither judged nor counted.  Texts of one endless line work.
Columns named like an output are replaced; all others pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import documents

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|›»•·→"

# Words of menus, and phrases of page furniture.
MENU = ("home", "menu", "login", "log in", "sign in", "sign up", "register", "search", "next", "previous", "contact",
        "contact us", "about", "about us", "sitemap", "share", "tweet", "print", "subscribe", "read more", "back to top")
FURNITURE = ("lorem ipsum", "enable javascript", "javascript is disabled", "use of cookies", "uses cookies", "use cookies",
             "cookie policy", "privacy policy", "terms of use", "terms of service", "terms and conditions",
             "all rights reserved", "click here", "skip to content", "add to cart")


def _points(text: Column, drop: str) -> Column:
    return F.char_length(F.regexp_replace(text, drop, ""))


def line_words(line: Column) -> Column:
    return F.size(F.filter(F.split(line, WHITE), lambda w: w != ""))


def bad_punctuation(line: Column, max_share: float, endless: int) -> Column:
    """Too many signs for its length, or a long line without any end of a sentence."""
    signs = _points(line, r"[\p{L}\p{M}\p{N}\s]+")
    return ((signs > max_share * F.char_length(line))
            | (~line.rlike(r"[.!?…。！？]") & (line_words(line) >= endless)))


def bad_separators(line: Column, separators: int) -> Column:
    """Navigation: a row of links."""
    return _points(line, f"[^{SEPARATORS}]+") >= separators


def bad_menu(line: Column) -> Column:
    """Navigation: only words of a menu."""
    words = "|".join(MENU)
    return line.rlike(rf"(?i)^\s*(?:(?:{words})[\s,/>-]*)+$")


def bad_boilerplate(line: Column) -> Column:
    """Page furniture."""
    return line.rlike("(?i)" + "|".join(FURNITURE))


def bad_repetition(line: Column) -> Column:
    """One word five times in a row."""
    return line.rlike(r"(?:^|\s)(\S+)(?:\s+\1){4}(?=\s|$)")


def quality_rules(docs: DataFrame, text: str = "text", min_words: int = 20, max_repeat_percent: int = 30,
                  max_sign_share: float = 0.15, endless_words: int = 60, separators: int = 3,
                  max_loss_percent: int = 50) -> DataFrame:
    """``docs`` with the base counts, base_failed, clean_text, kept_chars and kept.

    ``max_loss_percent``: a document is rejected when its removed lines hold
    more than this share of its word characters.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    added = ("words", "lines", "good_lines", "windows", "sorted_windows", "repeat_starts", "low")
    outputs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "clean_text",
               "kept_chars", "kept")
    out = (docs.drop(*added, *outputs)
           .withColumn("words", F.filter(F.split(body, WHITE), lambda w: w != ""))
           .withColumn("lines", F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
           .withColumn("n_words", F.size("words").cast("long"))
           .withColumn("word_chars", F.char_length(F.array_join("words", "")).cast("long"))
           .withColumn("n_symbols", _points(body, "[^" + SYMBOLS + "]+").cast("long"))
           .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")))
    out = _repeat_words(out)
    # What the whole text has not, no line needs to be searched for.  The choice stands outside the filters: inside,
    # the optimizer would put the test of the whole text in the place of its result and run it for every line.
    out = out.withColumn("low", F.lower(body))
    searched = (reduce(lambda a, b: a | b, [F.col("low").contains(x) for x in FURNITURE])
                | body.rlike(f"[{SEPARATORS}]"))

    def common_faults(line: Column) -> Column:
        return bad_punctuation(line, max_sign_share, endless_words) | bad_menu(line) | bad_repetition(line)

    good_lines = (F.when(searched, F.filter("lines", lambda x: ~(common_faults(x) | bad_separators(x, separators) | bad_boilerplate(x))))
                  .otherwise(F.filter("lines", lambda x: ~common_faults(x))))

    out = (out.withColumn("base_failed", (F.col("n_words") < min_words)
                          | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
           .withColumn("good_lines", good_lines)
           .withColumn("clean_text", F.array_join("good_lines", "\n"))
           .withColumn("kept_chars", F.when(F.size("good_lines") == F.size("lines"), F.col("word_chars"))
                       .otherwise(_points(F.col("clean_text"), WHITE).cast("long")))
           .withColumn("kept", ~F.col("base_failed")
                       & (100 * (F.col("word_chars") - F.col("kept_chars")) <= max_loss_percent * F.col("word_chars"))))
    # The verdicts leave through a generator of one row: the optimizer moves no later filter below it, where each
    # column that the filter needs would be computed anew in its place.
    own = [F.col(f"`{c}`") for c in docs.columns if c not in (*added, *outputs)]
    return (out.select(*own, F.explode(F.array(F.struct(*outputs))).alias("judged"))
            .select(*own, *(F.col(f"judged.{c}") for c in outputs)))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in an 8-word window that the text has twice or more."""
    def double(name: str, step: int) -> Column:
        """Hashes of windows twice as long: of each window and the one that starts ``step`` words later."""
        left = F.greatest(F.size(name) - step, F.lit(0))
        return F.zip_with(F.slice(name, 1, left), F.slice(name, step + 1, left), lambda x, y: F.xxhash64(x, y))

    # columns of their own: an array used more than once in an expression would be built as often
    df = df.withColumn("windows", F.transform(F.when(F.size("words") >= 8, F.col("words")), lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        df = df.withColumn("windows", double("windows", step))
    repeated = F.size("windows") > F.size(F.array_distinct("windows"))
    at = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("sorted_windows", F.when(repeated, F.array_sort(at)))
    same = F.filter("sorted_windows", lambda x, k: (
        (F.get("sorted_windows", k - 1)["h"] == x["h"]) | (F.coalesce(F.get("sorted_windows", k + 1)["h"] == x["h"], F.lit(False)))))
    df = df.withColumn("repeat_starts", F.when(F.col("sorted_windows").isNotNull(), F.array_sort(F.transform(same, lambda x: x["i"]))))
    covered = F.aggregate("repeat_starts", F.struct(F.lit(-8).alias("last"), F.lit(0).alias("n")), lambda a, i: F.struct(
        i.alias("last"), (a["n"] + F.least(F.lit(8), i - a["last"])).alias("n")))["n"]
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
