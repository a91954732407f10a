"""Line deduplication by overlapping windows of three consecutive lines.

A line ends at a newline or, so that a passage written as one long physical
line is seen as well, after a sentence end (``.``, ``!`` or ``?``) followed
by a space.  Every window of three consecutive lines is hashed; windows found
more than once in the corpus are repeated, their first occurrence (by
doc_id, then position) stays, and the positions covered by all later
occurrences are merged and removed.  Windows with fewer than ``min_chars``
characters are left alone, so blank or one-word lines never count as
repeated.

A passage that holds fewer than three whole lines between different neighbours,
such as one or two long sentences, has no window of its own and stays.  With
``word_ends`` lines end as well after a comma or semicolon followed by a space,
and after a word whose hash is 0 modulo ``word_ends``; these ends depend on the
words before them alone, so they are the same wherever a passage stands.

Only DataFrame functions are used: windows are exploded per row, counted
with a partial aggregation before the shuffle (a window that a third of all
documents share is combined map-side), and joined back by hash, where
adaptive execution can split a hot hash; the repeated ones, a small part, are
written once and joined with their first occurrence under salted keys.  Nothing is collected per window.

Defined results: a null text stays null, an empty text stays empty; texts of
fewer than three lines have no window and stay as they are; rows equal in
doc_id and text count as one document and get the same result each; a null
doc_id orders before all others; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import narrow

WINDOW = 3
LINE_ENDS = ("\n", ". ", "! ", "? ")
LINE_END = r"(?<=\n)|(?<=[.!?] )"      # the same ends as a zero-width pattern
MARK = "\u0001"
SPREAD = 1000             # occurrences of one window that are joined under one key


def short_lines_of(text: Column, word_ends: int) -> Column:
    """The lines of a text that also end within sentences; their concatenation is the text."""
    mark = F.concat(F.lit(MARK), F.hex(F.xxhash64(text)))       # a text does not hold its own hash

    def end(w: Column) -> Column:
        word = F.rtrim(w, F.lit(" \r\n"))
        chosen = (F.length(word) > 0) & (F.pmod(F.xxhash64(word), F.lit(word_ends)) == 0) & (word != w)
        for e in (*LINE_ENDS, ", ", "; "):
            chosen = chosen | w.endswith(e)
        return F.when(chosen, F.concat(w, mark)).otherwise(w)

    words = F.split(text, r"(?<=[ \n])")
    return F.array_remove(F.split(F.array_join(F.transform(words, end), ""), mark), "")


def lines_of(text: Column, word_ends: int = 0) -> Column:
    """The lines of a text with their ends; their concatenation is the text.

    Ends are marked by plain replacement, which is faster than the pattern; only
    a text that holds the mark itself is split by the pattern."""
    if word_ends:
        return short_lines_of(text, word_ends)
    marked = text
    for end in LINE_ENDS:
        marked = F.replace(marked, F.lit(end), F.lit(end + MARK))
    lines = F.when(F.contains(text, F.lit(MARK)), F.split(text, LINE_END)).otherwise(F.split(marked, MARK))
    return F.array_remove(lines, "")


def line_windows(docs: DataFrame, min_chars: int = 40, word_ends: int = 0) -> DataFrame:
    """(doc_id, th, pos, h, g): one row per window.  Each line is hashed once, without its
    end, by two functions; (h, g), 96 bits, combine the hashes of the window's lines."""
    lines = (docs.where(F.col("text").isNotNull())
             .select("doc_id", F.xxhash64("text").alias("th"),
                     F.transform(lines_of(F.col("text"), word_ends), lambda x: F.rtrim(x, F.lit(" \r\n"))).alias("l"))
             .select("doc_id", "th", F.transform("l", lambda x: F.struct(
                 F.xxhash64(x).alias("h"), F.hash(x).alias("g"), F.length(x).alias("n"))).alias("l")))
    n = F.greatest(F.size("l") - WINDOW + 1, F.lit(0))       # windows start at the first n lines
    zipped = F.arrays_zip(*[F.slice("l", k + 1, n).alias(str(k)) for k in range(WINDOW)])
    # one row per window; the hashes are combined after the explode, in generated code
    rows = lines.select("doc_id", "th", F.posexplode(zipped).alias("pos", "w"))
    three = lambda f: [F.col("w")[str(k)][f] for k in range(WINDOW)]
    return (rows.where(sum(three("n")) >= min_chars)
            .select("doc_id", "th", "pos", F.xxhash64(*three("h")).alias("h"), F.hash(*three("g")).alias("g")))


def covered_positions(docs: DataFrame, min_chars: int = 40, word_ends: int = 0) -> DataFrame:
    """(doc_id, th, covered): the line positions that later occurrences cover."""
    windows = line_windows(docs, min_chars, word_ends)
    repeated = windows.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    # a window with many occurrences is spread over ceil(n / SPREAD) keys
    parts = F.ceil(F.col("n") / F.lit(float(SPREAD)))
    found = narrow(windows.join(repeated, ["h", "g"])                       # repeated windows only
                   .withColumn("part", F.pmod(F.xxhash64("doc_id", "th", "pos"), parts)))
    place = F.struct("doc_id", "th", "pos")
    first = found.groupBy("h", "g").agg(F.min(place).alias("first"), F.max("n").alias("n")) \
        .select("h", "g", "first", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    later = found.join(first, ["h", "g", "part"]).where(place != F.col("first"))
    # a window that overlaps its own first occurrence removes only what lies beyond it
    same_doc = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))
    start = F.when(same_doc, F.greatest(F.col("pos"), F.col("first.pos") + WINDOW)).otherwise(F.col("pos"))
    spans = later.select("doc_id", "th", start.alias("a"), (F.col("pos") + WINDOW - 1).alias("b"))
    positions = spans.select("doc_id", "th", F.explode(F.sequence("a", "b")).alias("p"))
    return positions.groupBy("doc_id", "th").agg(F.collect_set("p").alias("covered"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, removed: str = "n_removed", word_ends: int = 0) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text, ...) with the covered lines cut from
    ``text``; a last column, named ``removed``, counts them."""
    cut = covered_positions(docs, min_chars, word_ends).select(
        F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "covered")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = row.join(cut, F.col("row.doc_id").eqNullSafe(F.col("_d"))
                      & (F.xxhash64("row.text") == F.col("_t")), "left")
    # lines are split only where some go; positions are subtracted as sets
    cut_lines = joined.select("row", "covered", F.when(F.col("covered").isNotNull(), lines_of(F.col("row.text"), word_ends)).alias("l"))
    left = F.array_except(F.sequence(F.lit(0), F.size("l") - 1), F.col("covered"))
    kept = F.array_join(F.transform(left, lambda i: F.col("l")[i]), "")
    text = F.when(F.col("covered").isNull(), F.col("row.text")).otherwise(kept)
    count = F.coalesce(F.size("covered"), F.lit(0)).cast("long")
    return cut_lines.select(F.col("row").withField("text", text).alias("row"), count.alias("n")) \
        .select("row.*", F.col("n").alias(removed))
