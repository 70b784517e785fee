"""Quality rules, line first.

Each line is judged by three rules, lines that fail one are removed, and a
document that loses too much of its text this way, or fails the base rules, is
rejected:

* punctuation: a line fails when symbols (``#*$%&|<>{}~^=`` and every mark of a
  doubled ``!!`` or ``??``) make up more than ``max_symbol_share`` of its
  non-space characters, or when it has ``min_unpunctuated`` words or more and
  not one mark that ends or parts a clause;
* navigation: a line fails when it has three or more menu separators (``|``,
  ``>``, and the bullets and quotes menus use) and at least one for every two
  words;
* boilerplate: a line of at most ``max_boilerplate_chars`` characters fails when it
  holds one of the fixed notices (licences, cookies, subscriptions, ...).

The base rules reject a text of fewer than 10 words, or one where more than a
fifth of the words lie in five-word windows that occur twice or more in it.

Everything is a DataFrame expression on one row: no shuffle and no Python.

Defined cases: a null text counts as empty; an empty text has no lines and is
rejected by the base rules; very long texts are judged whole, within one row; white
space around a line counts for nothing; a share of exactly its limit passes (ties);
repeated rows are judged one by one; an empty table
gives an empty result; other columns of the input, whatever their names, are kept by
:func:`clean_documents` and never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import SPACE, fresh_name, text_or_empty, where_computed, words

#: Fixed value: the characters that count as symbols in ``n_symbols``.
SYMBOLS = r"[^#*$%&|<>]+"
#: Notices, matched in lower case.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "terms of use", "terms of service", "privacy policy",
    "cookie policy", "we use cookies", "accept cookies", "enable javascript", "sign up for our newsletter", "subscribe to our",
    "click here to", "follow us on", "share this article", "powered by", "lorem ipsum",
)
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_SYMBOL_SHARE = 0.1
MIN_UNPUNCTUATED = 20
MAX_BOILERPLATE_CHARS = 200
MIN_KEPT_SHARE = 0.3

_HAS_WORD = r"[^\x20\x09-\x0D]"


def line_passes(line: Column, max_symbol_share: float = MAX_SYMBOL_SHARE, min_unpunctuated: int = MIN_UNPUNCTUATED,
                max_boilerplate_chars: int = MAX_BOILERPLATE_CHARS) -> Column:
    """Whether a line with a word passes the three rules.

    One cheap scan tells whether a line holds any mark that the first two rules
    count; most lines don't, and are not counted.
    """
    n_words = F.size(words(line))
    visible = F.length(F.regexp_replace(line, SPACE, ""))
    marks = F.length(F.regexp_replace(line, r"[^#*$%&|<>{}~^=!?]+|(?<![!?])[!?](?![!?])", ""))
    separators = F.length(F.regexp_replace(line, r"[^|>»›•·]+", ""))
    marked = line.rlike(r"[#*$%&|<>{}~^=»›•·]|[!?]{2}") & (
        (marks > F.lit(max_symbol_share) * visible) | ((separators >= 3) & (separators * 2 >= n_words - separators)))
    bare = ~line.rlike(r"[.,;:!?…。！？،۔।]") & (n_words >= min_unpunctuated)
    notice = (F.length(line) <= max_boilerplate_chars) & F.lower(line).rlike("|".join(BOILERPLATE))
    return ~(marked | bare | notice)


def window_hashes(docs: DataFrame, words_column: str, out: str) -> DataFrame:
    """``docs`` with the hashes of the five-word windows of a word array, in
    order (empty for fewer than five words): hashes of two neighbours are
    joined to hashes of four and, with the fifth word, of five."""
    w, two, four = words_column, fresh_name(docs, "two_words"), fresh_name(docs, "four_words")
    join = lambda a, b: F.xxhash64(a, b)
    after = lambda c, k: F.slice(F.col(c), F.lit(k + 1), F.size(w))
    step = docs.withColumn(two, F.zip_with(F.col(w), after(w, 1), join))
    step = step.withColumn(four, F.zip_with(F.col(two), after(two, 2), join))
    five = F.zip_with(F.col(four), after(w, 4), join)
    return step.withColumn(out, F.slice(five, F.lit(1), F.greatest(F.size(w) - 4, F.lit(0)))).drop(two, four)


def repeated_words(docs: DataFrame, hashes: str, out: str) -> DataFrame:
    """``docs`` with the number of words inside five-word windows that occur
    twice or more, given the window hashes of each text in order.

    Sorting (hash, position) pairs puts equal windows side by side, so each
    pair of neighbours is looked at once.  A text whose windows all differ
    sorts nothing.
    """
    pairs, starts = fresh_name(docs, "pairs_of"), fresh_name(docs, "starts_of")
    h = F.col(hashes)
    step = docs.withColumn(pairs, F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    touching = F.zip_with(F.slice(F.col(pairs), F.lit(1), F.size(pairs) - 1), F.slice(F.col(pairs), F.lit(2), F.size(pairs) - 1),
                          lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    step = step.withColumn(starts, F.when(F.col(pairs).isNotNull(), F.sort_array(F.array_distinct(F.flatten(
        F.filter(touching, lambda x: x.isNotNull()))))))
    # Each start adds five words, less where the next one comes sooner.
    gaps = F.zip_with(F.col(starts), F.slice(F.col(starts), F.lit(2), F.size(starts)), lambda a, b: F.least(b - a, F.lit(5)))
    total = F.aggregate(gaps, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(5)))
    return step.withColumn(out, F.when(F.col(starts).isNull(), F.lit(0)).otherwise(total).cast("long")).drop(pairs, starts)


def judge(docs: DataFrame, min_kept_share: float = MIN_KEPT_SHARE, **line_rules: float) -> DataFrame:
    """``docs`` with the base figures, ``cleaned`` (the text without failing
    lines), ``base_failed`` and ``kept``."""
    t, w, h, lines, good, rep = (fresh_name(docs, x) for x in ("text_in", "words_in", "hashes_in", "lines_in", "good_in", "repeats_in"))
    step = docs.withColumn(t, text_or_empty())
    step = step.withColumn(w, words(F.col(t))).withColumn(lines, F.split(F.col(t), "\n"))
    step = repeated_words(window_hashes(step, w, h), h, rep)
    # A line without a word is never judged: blank lines part paragraphs.
    step = step.withColumn(good, F.filter(F.col(lines), lambda x: ~x.rlike(_HAS_WORD) | line_passes(x, **line_rules)))
    spoken = F.filter(F.col(lines), lambda x: x.rlike(_HAS_WORD))
    step = step.select(
        *docs.columns,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(F.col(w), "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(F.col(t), SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size(spoken) - F.size(F.array_distinct(spoken))).cast("long").alias("n_dup_lines"),
        F.col(rep).alias("n_repeat_words"),
        F.when(F.size(good) == F.size(lines), F.col(t)).otherwise(F.array_join(F.col(good), "\n")).alias("cleaned"),
        (F.size(good) == F.size(lines)).alias(lines),
    )
    left = F.when(F.col(lines), F.col("word_chars")).otherwise(F.length(F.regexp_replace(F.col("cleaned"), SPACE, "")))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return step.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (left >= F.col("word_chars") * F.lit(min_kept_share))).drop(lines)


def clean_documents(docs: DataFrame, **rules: float) -> DataFrame:
    """The documents that pass, their failing lines removed; same columns.
    ``n_chars``, where there is one, follows the text."""
    columns = docs.columns
    given = docs.select(F.col("text"), F.struct(*columns).alias("row"))
    kept = where_computed(judge(given, **rules), F.col("kept"))
    out = {c: F.col("row")[c] for c in columns} | {"text": F.col("cleaned")}
    if "n_chars" in columns:
        out["n_chars"] = F.length("cleaned").cast(docs.schema["n_chars"].dataType)
    return kept.select(*[out[c].alias(c) for c in columns])
