"""Line deduplication over overlapping windows of three lines.

Lines that hold a word are numbered through each text and compared without
outer white space and with inner white space as one space.  Every three
consecutive ones make a window; a window that occurs more than once in the whole
table stays where it comes first (lowest doc_id, then text, then place) and is
removed everywhere else: a line goes when any such later window covers it.

One aggregation finds the repeated windows and their first places (combined on
the map side, so a passage in a third of all documents is one row per task), one
join brings them back to the other places; windows travel as 128-bit hashes,
texts only once, to be rewritten.  The join's large side can be split wherever
one window is hot.

Defined cases: a null text is kept as it is and has no lines; very long texts are
read whole; of equal windows at the same doc_id the smaller text hash, then place, is first
(ties); texts of fewer
than three lines with a word never change; blank lines are kept while a line
with a word is left after them; repeated rows (same doc_id, same text) count
as one occurrence and are treated alike; rows that share a doc_id but not the
text are different documents; an empty table gives an empty result; other
columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import SPACE, text_or_empty, where_computed

LINES = 3
_HAS_WORD = r"[^\x20\x09-\x0D]"


def spoken_lines(text: Column) -> Column:
    """The lines that hold a word, their white space evened."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(_HAS_WORD))
    return F.transform(lines, lambda x: F.trim(F.regexp_replace(x, SPACE, " ")))


def windows_of(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """id, copy (hash of the text), at, h1 and h2 of every window."""
    said = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text_or_empty()).alias("copy"), spoken_lines(text_or_empty()).alias("said"))
    each = F.transform(F.sequence(F.lit(1), F.size("said") - (lines - 1)), lambda i: F.struct(
        (i - 1).alias("at"), F.xxhash64(F.slice(F.col("said"), i, F.lit(lines))).alias("h1"),
        F.xxhash64(F.lit("second"), F.slice(F.col("said"), i, F.lit(lines))).alias("h2")))
    # The outer form, as the optimiser would filter by the size of the array first and so compute it twice.
    windows = said.select("id", "copy", F.explode_outer(F.when(F.size("said") >= lines, each)).alias("w"))
    return windows.filter("w.at is not null").select("id", "copy", "w.*")


def later_windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """id, copy and the places ``starts`` of windows that came before elsewhere."""
    windows = windows_of(docs, lines)
    place = F.struct("id", "copy", "at")
    repeated = (windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                .filter(~F.col("first").eqNullSafe(F.col("last"))))
    later = windows.join(repeated.select("h1", "h2", "first"), ["h1", "h2"]).filter(~F.struct("id", "copy", "at").eqNullSafe(F.col("first")))
    return later.groupBy("id", "copy").agg(F.collect_set("at").alias("starts"))


def dedup_lines(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``docs`` as one struct ``row`` with ``cleaned`` (its text without later
    occurrences), ``n_lines`` (lines with a word) and ``removed`` (the numbers of
    those that went, from 0)."""
    given = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64(text_or_empty()).alias("own_copy"))
    found = given.join(later_windows(docs, lines), F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_copy") == F.col("copy")), "left")
    text = F.col("row")["text"]
    gone = F.sort_array(F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (lines - 1))))))
    split = F.split(F.coalesce(text, F.lit("")), "\n")
    found = found.withColumn("removed", F.coalesce(gone, F.array().cast("array<int>"))).withColumn("all_lines", split)
    # The places of the lines with a word among all lines, then those that stay.
    every = F.sequence(F.lit(0), F.size("all_lines") - 1)
    spoken = F.filter(every, lambda i: F.get("all_lines", i).rlike(_HAS_WORD))
    found = found.withColumn("places", F.when(F.size("removed") > 0, spoken))
    going = F.transform("removed", lambda r: F.get("places", r))
    found = found.withColumn("left", F.when(F.size("removed") > 0, F.array_except(every, going)))
    kept = F.array_join(F.transform("left", lambda i: F.get("all_lines", i)), "\n")
    cleaned = F.when(F.size("removed") == 0, text).when(F.size("removed") < F.size("places"), kept).otherwise("")
    return found.select("row", cleaned.alias("cleaned"), F.size(F.filter("all_lines", lambda x: x.rlike(_HAS_WORD))).cast("long").alias("n_lines"), "removed")


def report(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (line numbers, comma-joined) and the
    cleaned text of each row."""
    return dedup_lines(docs.select("doc_id", "text"), lines).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"), F.col("cleaned").alias("text"))


def dedup_documents(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """The documents with their remaining lines; those of which nothing is left
    go.  Same columns; ``n_chars``, where there is one, follows the text."""
    found = where_computed(dedup_lines(docs, lines), (F.size("removed") == 0) | (F.col("cleaned") != ""))
    out = {c: F.col("row")[c] for c in docs.columns} | {"text": F.col("cleaned")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.size("removed") == 0, F.col("row")["n_chars"]).otherwise(F.length("cleaned")).cast(docs.schema["n_chars"].dataType)
    return found.select(*[out[c].alias(c) for c in docs.columns])
