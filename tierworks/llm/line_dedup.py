"""Line deduplication by names of runs of lines, in the stead of a suffix array over line ids.

The corpus is read as one sequence of lines with a word, in order of document and line, with documents parted. Prefix
doubling names runs of 1, 2, 4, ... lines: two places have the same name at a level exactly if the runs starting there
are equal, because a name stands for the pair of names of the two halves. The name is the first place where the run
occurs, so it needs no global sort. There is no order of suffixes, and maximal runs are not found. A place whose run occurs nowhere else leaves the doubling, which empties quickly.

A run of any length is the overlap of two named runs. For every line that starts or ends a candidate, the shortest run
with ``min_words`` words from it, forwards and backwards, is looked up in this way: the union of those that occur at an
earlier place is exactly the union of all repeated runs of that many words. These later copies are deleted, the first
place of each run stays.

Single lines are named by a 128-bit digest; all further names are places.

Behaviour: null text stays null; lines without words are no part of the sequence and go with a deleted line before
them; a document of which no word is left becomes an empty text (``deduplicated``) or goes (``drop_empty``). Null ids
come first in the order. Rows with equal ids and equal texts count as one document and are treated alike; rows with
equal ids and other texts are ordered by a hash of the text. An empty table gives an empty one. All columns of the
input are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierworks.llm.common import stored

MIN_WORDS = 50
WORD = "[^\\x20\\x09-\\x0D]+"
ALL = "doc", "tie"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc`` and ``tie``, which tell documents apart and order them, and the text."""
    text = F.col(text_col)
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))).alias("doc"), F.xxhash64(text).alias("tie"), text.alias("text")
    )


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines with a word: ``doc``, ``tie``, ``at`` (its number among them), ``h1`` and ``h2`` (its digest), ``n`` (words)."""
    parts = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    rows = _keyed(docs, id_col, text_col).where("text is not null").select(*ALL, F.posexplode(parts).alias("at", "line"))
    digest = F.md5("line")
    half = lambda k: F.conv(F.substring(digest, k, 15), 16, 10).cast("bigint")
    return rows.select(*ALL, "at", half(1).alias("h1"), half(17).alias("h2"), F.regexp_count("line", F.lit(WORD)).cast("int").alias("n"))


def _place() -> Column:
    return F.struct("doc", "tie", "at")


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose ``keys`` occur at several places, with ``name``: the first of them."""
    groups = rows.groupBy(*keys).agg(F.min(_place()).alias("name"), F.max(_place()).alias("_last")).where("name <> _last").drop("_last")
    return rows.join(groups, keys)


def levels(repeated: DataFrame, min_words: int) -> list[DataFrame]:
    """Names of runs of 2^k lines (``doc``, ``tie``, ``at``, ``name``) that occur at several places; k from 0."""
    found, size = [repeated.select(*ALL, "at", "name")], 1
    while 2 * size <= min_words:
        now = found[-1]
        after = now.select(*ALL, (F.col("at") - size).alias("at"), F.col("name").alias("right"))
        pairs = now.withColumnRenamed("name", "left").join(after, [*ALL, "at"])
        step = stored(_named(pairs, ["left", "right"]).select(*ALL, "at", "name"), "runs")
        if not step.head(1):
            break
        found.append(step)
        size *= 2
    return found


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of lines to delete: ``doc``, ``tie``, ``low``, ``high`` (numbers among the lines with a word, inclusive)."""
    # a document that repeats as a row is one document
    everything = stored(lines(docs, id_col, text_col).dropDuplicates([*ALL, "at"]), "lines")
    repeated = stored(_named(everything, ["h1", "h2"]).select(*ALL, "at", "n", "name"), "lines")
    named = levels(repeated, min_words)

    # stretches of neighbouring repeated lines: a run cannot leave them
    order = Window.partitionBy(*ALL).orderBy("at")
    rows = repeated.withColumn("stretch", F.col("at") - F.row_number().over(order))
    inside = Window.partitionBy(*ALL, "stretch").orderBy("at")
    rows = rows.withColumn("sum", F.sum("n").over(inside)).withColumn("before", F.col("sum") - F.col("n"))
    runs = _shortest(rows, min_words).distinct()

    size = F.col("high") - F.col("low") + 1
    runs = runs.withColumn("k", F.length(F.bin(size)) - 1)
    runs = runs.where(F.col("k") < len(named))
    names = None
    for k, level in enumerate(named):
        own = level.select(*ALL, "at", "name", F.lit(k).alias("k"))
        names = own if names is None else names.union(own)
    power = F.expr("shiftleft(1, k)")
    runs = runs.withColumn("mid", F.col("high") - power + 1)
    left = names.withColumnsRenamed({"at": "low", "name": "left"})
    right = names.withColumnsRenamed({"at": "mid", "name": "right"})
    runs = runs.join(left, [*ALL, "k", "low"]).join(right, [*ALL, "k", "mid"])
    runs = runs.select(*ALL, "low", "high", (F.col("high") - F.col("low")).alias("more"), "left", "right")
    place = F.struct(*ALL, "low")
    first = runs.groupBy("more", "left", "right").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    copies = runs.join(first.where("_first <> _last"), ["more", "left", "right"]).where(place != F.col("_first"))
    return copies.select(*ALL, "low", "high").distinct()


def _shortest(rows: DataFrame, min_words: int) -> DataFrame:
    """Spans ``low``..``high`` within a stretch: the shortest with enough words from each line on, and up to each line."""
    by_sum = Window.partitionBy(*ALL, "stretch").orderBy("point").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    by_sum_back = Window.partitionBy(*ALL, "stretch").orderBy("point").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    base = rows.select(*ALL, "stretch", "at", "before", "sum")
    # forwards: the first line whose running sum reaches what stood before the start plus the words asked for
    stops = base.select(*ALL, "stretch", F.col("sum").alias("point"), F.col("at").alias("stop"), F.lit(None).cast("int").alias("start"))
    asks = base.select(*ALL, "stretch", (F.col("before") + min_words).alias("point"), F.lit(None).cast("int").alias("stop"), F.col("at").alias("start"))
    ahead = stops.union(asks).withColumn("high", F.min("stop").over(by_sum)).where("start is not null and high is not null")
    # backwards: the last line before which no more stood than the sum at the end less the words asked for
    starts = base.select(*ALL, "stretch", F.col("before").alias("point"), F.col("at").alias("start"), F.lit(None).cast("int").alias("stop"))
    ends = base.select(*ALL, "stretch", (F.col("sum") - min_words).alias("point"), F.lit(None).cast("int").alias("start"), F.col("at").alias("stop"))
    back = starts.union(ends).withColumn("low", F.max("start").over(by_sum_back)).where("stop is not null and low is not null")
    return ahead.select(*ALL, F.col("start").alias("low"), "high").union(back.select(*ALL, "low", F.col("stop").alias("high")))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _remaining(text: Column, gone: Column) -> Column:
    """The text without the lines numbered in ``gone`` (among those with a word) and the wordless ones behind each."""

    def left(parts):
        all_lines = F.sequence(F.lit(0), F.size(parts) - 1)
        numbers = F.filter(all_lines, lambda i: F.rlike(F.get(parts, i), F.lit(WORD)))

        def joined(places):
            # from each deleted line to the next line with a word
            dropped = F.flatten(
                F.transform(gone, lambda g: F.sequence(F.get(places, g), F.coalesce(F.get(places, g + 1), F.size(parts)) - 1))
            )
            return F.array_join(F.transform(F.array_except(all_lines, dropped), lambda i: F.get(parts, i)), "\n")

        return _let(numbers, joined)

    return _let(F.split(text, "\n"), left)


def deduplicated(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", drop_empty: bool = False,
    count_col: str | None = None,
) -> DataFrame:
    """``docs`` without the later copies of repeated runs of lines; ``count_col`` gets the number of lines deleted."""
    spans = later_copies(docs, min_words, id_col, text_col)
    cuts = spans.groupBy(*ALL).agg(F.collect_set(F.struct("low", "high")).alias("_cuts"))  # two spans per line at most
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63)))
    joined = docs.select(row, key.alias("doc"), F.xxhash64(text_col).alias("tie")).join(cuts, list(ALL), "left")

    text = F.col("_row")[text_col]
    gone = F.sort_array(F.array_distinct(F.flatten(F.transform("_cuts", lambda c: F.sequence(c["low"], c["high"])))))
    marked = joined.select("_row", "_cuts", gone.alias("_gone"))
    if drop_empty:
        with_word = F.size(F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(WORD))))
        marked = marked.where(F.col("_cuts").isNull() | (F.size("_gone") < with_word))
    out = marked.select(
        "_row", F.when(F.col("_cuts").isNull(), text).otherwise(_remaining(text, F.col("_gone"))).alias("_text"),
        F.when(F.col("_cuts").isNull(), 0).otherwise(F.size("_gone")).cast("bigint").alias("_n"),
    )
    columns = [F.col("_text").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns]
    return out.select(*columns, *([F.col("_n").alias(count_col)] if count_col else []))
