"""Repeated lines across documents, by range-partitioned line hashes and keep bitmaps.

A text is split at ``\\n``. A line's key is the line stripped of blanks and control
blanks (space, U+0009 to U+000D) at both ends, A-Z lower-cased. A key of at least
``min_chars`` code points that at least ``min_docs`` documents hold is *repeated*: it
loses all its lines except those in the largest doc_id that holds it.

Lines travel as 128-bit key hashes with document and position, never as text. They are
range-partitioned by (hash, document block) and sorted inside by document and
position; each (hash, block) group is streamed, its first occurrence and the number of
its documents kept. A block is 1,024 consecutive ids, so a line that a third of all
documents share is thousands of bounded groups rather than one. The groups' results
are summed per hash, go back to the groups of repeated hashes, and mark lines. What is returned is a bitmap per
document that loses a line: the 64-line words that hold a dropped line, in order; a
word that is absent keeps its lines, a document that is absent keeps all.

Everything is DataFrame functions on the JVM. Defined results: a null text is one empty
line; documents are told apart by doc_id, so rows that share an id count once, and all
hold what any of them holds; a null id is one more document, smaller than any other;
rows equal in id and text share a bitmap; extra columns are ignored by
``keep_bitmaps`` and kept by ``drop_repeated_lines``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import doc_columns, lower_ascii, text_or_empty, written

MIN_CHARS, MIN_DOCS = 40, 5
BLANKS = " \t\n\x0b\x0c\r"
BLOCK_BITS = 10  # ids of a block: 1,024
_GROUP = ["_h1", "_h2", "_block"]


def text_lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _block(doc_id: Column) -> Column:
    """Consecutive ids in one block; ids that are no numbers by a hash."""
    return F.coalesce(F.shiftright(doc_id.try_cast("long"), BLOCK_BITS), F.shiftright(F.xxhash64(doc_id), 54))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """_h1, _h2, _block, _id, _text_hash, _pos of every line whose key is long enough."""
    d = doc_columns(docs, {"_id": "doc_id", "text": "text"}).withColumn("_text", text_or_empty()) \
        .withColumn("_text_hash", F.xxhash64("_text"))  # once a text, before its lines are told apart
    each = d.select("_id", "_text_hash", F.posexplode(text_lines(F.col("_text"))).alias("_pos", "_line"))
    long = each.filter(F.char_length(F.btrim("_line", F.lit(BLANKS))) >= F.lit(min_chars))
    return long.withColumn("_key", line_key(F.col("_line"))).select(
        F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit("second"), "_key").alias("_h2"),
        _block(F.col("_id")).alias("_block"), "_id", "_text_hash", "_pos")


def first_occurrences(lines: DataFrame) -> DataFrame:
    """(_h1, _h2, _block, _docs, _first): documents of each group and the largest of them.

    The window's groups and order are those of the range partitions, so the sort and the
    aggregation add no shuffle."""
    stream = Window.partitionBy(*_GROUP).orderBy(F.desc("_id"), "_text_hash", "_pos")
    new_doc = (F.row_number().over(stream) == 1) | ~F.col("_id").eqNullSafe(F.lag("_id").over(stream))
    return lines.repartitionByRange(*_GROUP).withColumn("_new", new_doc) \
        .groupBy(*_GROUP).agg(F.count_if("_new").alias("_docs"), F.max("_id").alias("_first"))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, text_hash, dropped (array of (word, bits), by word) of each document that
    loses lines: line i is dropped where bit i % 64 of word i / 64 is set."""
    lines = written(hashed_lines(docs, min_chars))
    groups = written(first_occurrences(lines))
    repeated = groups.groupBy("_h1", "_h2").agg(F.sum("_docs").alias("_docs"), F.max("_first").alias("_keep")) \
        .filter(F.col("_docs") >= F.lit(min_docs)).select("_h1", "_h2", "_keep")
    marked = written(groups.select(*_GROUP).join(written(repeated), ["_h1", "_h2"]))
    gone = lines.join(marked, _GROUP).filter(~F.col("_id").eqNullSafe(F.col("_keep")))
    words = gone.groupBy("_id", "_text_hash", F.shiftright("_pos", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_pos") % 64)).alias("bits"))
    return words.groupBy("_id", "_text_hash").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("dropped")) \
        .select(F.col("_id").alias("doc_id"), F.col("_text_hash").alias("text_hash"), "dropped")


def n_dropped(dropped: Column) -> Column:
    """Lines a bitmap drops (none where it is null)."""
    return F.coalesce(F.aggregate(dropped, F.lit(0).cast("long"),
                                  lambda n, w: n + F.bit_count(w["bits"]).cast("long")), F.lit(0).cast("long"))


def kept_text(text: Column, dropped: Column) -> Column:
    """A text less the lines a bitmap drops (a null bitmap drops none), in linear time."""
    lines = text_lines(text)
    gone = F.flatten(F.transform(dropped, lambda w: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("getbit", w["bits"], i) == 1),
        lambda i: w["word"] * 64 + i)))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.when(dropped.isNull(), text).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))


def _with_bitmaps(docs: DataFrame, id_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """``docs`` with _dropped; its columns _text and ``id_col`` name the text and the id."""
    maps = keep_bitmaps(docs.select(F.col(id_col).alias("doc_id"), F.col("_text").alias("text")), min_chars, min_docs) \
        .select(F.col("doc_id").alias("_map_id"), F.col("text_hash").alias("_map_hash"), F.col("dropped").alias("_dropped"))
    return docs.join(maps, F.col(id_col).eqNullSafe(F.col("_map_id")) & (F.xxhash64("_text") == F.col("_map_hash")), "left")


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text of every row of ``docs``."""
    d = doc_columns(docs, {"doc_id": "doc_id", "text": "text"}).select("doc_id", text_or_empty().alias("_text"))
    return _with_bitmaps(d, "doc_id", min_chars, min_docs).select(
        "doc_id", F.size(text_lines(F.col("_text"))).cast("long").alias("n_lines"),
        n_dropped(F.col("_dropped")).alias("n_dropped"), kept_text(F.col("_text"), F.col("_dropped")).alias("kept_text"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs``, all columns, with text less its repeated lines (a null text stays null)."""
    names, inside = docs.columns, [f"_c{i}" for i in range(len(docs.columns))]
    d = docs.toDF(*inside)
    at = {n: c for n, c in zip(names, inside)}
    d = d.withColumn("_text", text_or_empty(at["text"]))
    out = _with_bitmaps(d, at["doc_id"], min_chars, min_docs)
    new = F.when(F.col(at["text"]).isNotNull(), kept_text(F.col("_text"), F.col("_dropped")))
    return out.select(*[(new if n == "text" else F.col(c)).alias(n) for n, c in zip(names, inside)])


ORACLE = """
    WITH l AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
        FROM documents
    ), k AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
    ), r AS (
        SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5
    ), m AS (
        SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.keep_id AS gone FROM k LEFT JOIN r ON k.key = r.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id"""
