"""Line de-duplication by winnowing, with DataFrame functions only.

The lines of a document are hashed. Every window of WINDOW consecutive lines selects its
smallest line hash as fingerprint, so a run of WINDOW lines that stands in two places has
the same fingerprint in both; a line of LONG_WORDS or more words is a window of its own.
Only windows whose fingerprint was selected in two places go on. They are compared by the
hash of all their lines; overlapping equal windows extend a match to both sides, line by line,
up to where the run ends. The first place of each window, by document id and position, stays
and the later ones are deleted.

A passage of LONG_WORDS or more words in fewer than WINDOW lines, none of them that long, has no
such window. So each line that isn't blank also opens the shortest run of 2 to WINDOW - 1 lines
that reaches LONG_WORDS. Its lines alone fix its length, so equal passages give equal windows.

Hashes are 64 bits wide. Frequent lines only add rows, one per place, to aggregations that
combine before the shuffle and to joins that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from .tables import joined

WINDOW = 4
LONG_WORDS = 50

_SPACE = r"[\x20\x09-\x0D]+"


def _line_hash(line: Column) -> Column:
    """Equal for lines that differ in white space at their ends only."""
    return F.xxhash64(F.regexp_replace(line, rf"^{_SPACE}|{_SPACE}$", ""))


def _words(line: Column) -> Column:
    """The number of words: of runs without white space."""
    return F.size(F.array_remove(F.split(line, _SPACE), ""))


def _text_key() -> Column:
    """60 bits of a text's md5, which tell apart the rows of one doc_id."""
    return F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("long")


def _windows(hashes: Column, words: Column, window: int, long_words: int) -> Column:
    """Array of (start, size, print, place, content): place is where the fingerprint stands.

    ``words`` are the lines' numbers of words.
    """

    def of(start: Column, size: Column) -> Column:
        rows = F.slice(hashes, start + 1, size)
        least = F.array_min(rows)
        return F.struct(
            start.alias("start"),
            size.alias("size"),
            least.alias("print"),
            (start + F.array_position(rows, least).cast("int") - 1).alias("place"),
            F.xxhash64(F.array_join(F.transform(rows, lambda x: x.cast("string")), ",")).alias("content"),
        )

    def alone(at: Column) -> Column:
        return F.struct(
            at.alias("start"),
            F.lit(1).alias("size"),
            F.element_at(hashes, at + 1).alias("print"),
            at.alias("place"),
            F.xxhash64(F.element_at(hashes, at + 1)).alias("content"),
        )

    def short(total: Column, at: Column) -> Column:
        size = F.when((total == 0) | (total >= long_words), F.lit(None).cast("int"))
        for more in range(1, window - 1):
            total = total + F.get(words, at + more)  # null beyond the last line
            size = size.when(total >= long_words, more + 1)
        return F.when(size.isNotNull(), of(at, size))

    n = F.size(hashes)
    none = F.expr("CAST(array() AS array<struct<start:int,size:int,print:bigint,place:int,content:bigint>>)")
    many = F.when(n >= window, F.transform(F.sequence(F.lit(0), F.greatest(n - window, F.lit(0))), lambda i: of(i, F.lit(window)))).otherwise(none)
    long = F.filter(
        F.transform(words, lambda n, at: F.when(n >= long_words, alone(at))), lambda x: x.isNotNull()
    )
    return F.concat(many, long, F.filter(F.transform(words, short), lambda x: x.isNotNull()))


def repeated_lines(docs: DataFrame, window: int = WINDOW, long_words: int = LONG_WORDS) -> DataFrame:
    """(doc_id, text_key, removed): positions, from 0 and ascending, of lines in later repeated runs.

    Only texts with such lines have a row. Places are ordered by doc_id, then by ``text_key``,
    a hash of the text, then by position. Within one text a repeat that overlaps its first
    place isn't one. Null and empty texts have none, and rows without an id are left as they
    are. Rows equal in doc_id and text are one document, so neither is a repeat of the other.
    """
    # one row per document
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    rows = rows.select("doc_id", _text_key().alias("text_key"), F.split("text", "\n").alias("lines"))
    rows = rows.withColumns({"hashes": F.transform("lines", _line_hash), "words": F.transform("lines", _words)})
    rows = rows.select("doc_id", "text_key", _windows(F.col("hashes"), F.col("words"), window, long_words).alias("windows"))
    # an outer explode: a plain one adds a filter that works out all windows a second time
    rows = rows.select("doc_id", "text_key", F.explode_outer("windows").alias("w")).where("w IS NOT NULL")
    windows = written(rows.select("doc_id", "text_key", "w.*"))

    # guaranteed fingerprints: those selected in two places, each place counted once
    stands = F.struct("doc_id", "text_key", "place")
    prints = windows.groupBy("print").agg(F.min(stands).alias("low"), F.max(stands).alias("high"))
    shared = written(prints.where("low <> high").select("print"))
    matched = joined(windows, shared, "print", "left_semi", shared.count())
    place = F.struct("doc_id", "text_key", "start")
    firsts = matched.groupBy("content", "size").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    firsts = written(firsts.where("first <> last").select("content", "size", "first"))
    later = joined(matched, firsts, ["content", "size"], "inner", firsts.count()).where(
        (F.col("doc_id") != F.col("first.doc_id"))
        | (F.col("text_key") != F.col("first.text_key"))
        | (F.col("start") >= F.col("first.start") + F.col("size"))
    )
    covered = later.select("doc_id", "text_key", F.explode(F.expr("sequence(start, start + size - 1)")).alias("at"))
    return covered.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("at")).alias("removed"))


def without_repeated_lines(docs: DataFrame, window: int = WINDOW, long_words: int = LONG_WORDS) -> DataFrame:
    """Every row of ``docs`` with its text less repeated lines, and n_lines and n_removed.

    A null text stays null with no lines; a text whose lines all repeat becomes empty. Other
    columns are carried along, but those named n_lines or n_removed are replaced.
    """
    kept_columns = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    gone, key, lines = ("_" * (i + max(map(len, docs.columns))) for i in (1, 2, 3))  # no column's names
    removed = written(repeated_lines(docs, window, long_words))
    removed = removed.withColumnsRenamed({"removed": gone, "text_key": key})
    # hot ids can't be: a document is one row; so a plain sort-merge join at every size
    out = docs.withColumn(key, _text_key()).join(removed.hint("merge"), ["doc_id", key], "left")
    out = out.withColumn(lines, F.split("text", "\n"))
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.transform(F.array_except(every, F.col(gone)), lambda i: F.get(lines, i))
    return out.select(
        *kept_columns,
        F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_removed"),
    )
