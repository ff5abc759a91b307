"""Exact duplicates by content-defined chunk recipes.

A normalised text (A-Z lower-cased, null as empty) is cut into chunks at places
its content decides: the first sentence or line end after ``min_chunk``
characters, at ``max_chunk`` at the latest. Each chunk gets an identifier, a
text's recipe is the ordered list of them, and two texts are equal exactly when
their recipes are. Identifiers are verified: every distinct chunk text moves once
(after map-side removal of repeats), and where two different chunks share a hash
they get different identifiers. Texts themselves are never shuffled again;
grouping and joining move lists of eight-byte identifiers.

Everything is DataFrame functions on the JVM. Defined results: null texts are
empty texts, and empty texts (recipe of no chunks) form one group; a null doc_id
loses to any other; of repeated rows that tie, one stays; extra columns are
ignored by ``duplicate_groups`` and kept by ``keep_one``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import doc_columns, free_name, lower_ascii, text_or_empty, with_row_id, written

MIN_CHUNK, MAX_CHUNK = 512, 4096


def chunks(text: Column, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK) -> Column:
    """The chunks of a text, in order; joined they are the text."""
    ended = rf"(?s).{{{min_chunk},{max_chunk - 1}}}?[.!?\n]|.{{1,{max_chunk}}}"
    return F.regexp_extract_all(text, F.lit(ended), F.lit(0))


def chunk_hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def _clashes(texts: DataFrame, hashed, cut) -> DataFrame:
    """(h, chunk, variant) of every hash that different chunk texts share; variants
    number those texts from 0 in text order. Empty unless the hash failed."""
    each = texts.select(F.explode(cut(F.col("_text"))).alias("chunk")) \
        .select(hashed(F.col("chunk")).alias("h"), "chunk").distinct()
    several = written(each.groupBy("h").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("h"))
    if several.isEmpty():
        return None
    order = Window.partitionBy("h").orderBy("chunk")  # as many rows as texts share one hash
    return written(each.join(several, "h", "left_semi")
                   .withColumn("variant", (F.row_number().over(order) - 1).cast("long")))


def recipes(docs: DataFrame, hashed=chunk_hash, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK,
            row_id: str | None = None) -> DataFrame:
    """_uid, doc_id, text_sha256 and recipe (list of verified chunk identifiers)
    of every row, as a written table. ``hashed`` maps a chunk to a long; ``row_id`` names a
    column of lasting row identities, made here where there is none."""

    def cut(text):
        return chunks(text, min_chunk, max_chunk)

    if row_id is None:
        row_id = free_name(docs, "_row_uid")
        docs = with_row_id(docs, row_id)
    texts = doc_columns(docs, {"_uid": row_id, "doc_id": "doc_id", "text": "text"}) \
        .withColumn("_text", lower_ascii(text_or_empty()))
    plain = written(texts.select("_uid", "doc_id", F.sha2("_text", 256).alias("text_sha256"),
                                 F.transform(cut(F.col("_text")), hashed).alias("recipe")))
    clashes = _clashes(texts, hashed, cut)
    if clashes is None:
        return plain
    # a chunk that is not the first text of its hash is told apart by its variant
    told = texts.select("_uid", F.posexplode(cut(F.col("_text"))).alias("pos", "chunk")) \
        .withColumn("h", hashed(F.col("chunk"))).join(clashes, ["h", "chunk"]).filter("variant > 0") \
        .groupBy("_uid").agg(F.map_from_entries(F.collect_list(F.struct("pos", "variant"))).alias("_variants"))
    variants = F.transform(F.col("recipe"), lambda h, i: F.coalesce(F.col("_variants")[i], F.lit(0)))
    return written(plain.join(told, "_uid", "left").withColumn(
        "recipe", F.when(F.col("_variants").isNull(), F.col("recipe")).otherwise(F.concat("recipe", variants)))
        .drop("_variants"))


def duplicate_groups(docs: DataFrame, **cutting) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, _uid.

    Group sums combine before the shuffle, so a group of any size sends one row
    per task. They are written, so that both sides of the join back have an exchange of
    their own and Spark can split a hot recipe.
    """
    marked = recipes(docs, **cutting)
    groups = written(marked.groupBy("recipe").agg(
        F.max(F.struct("doc_id", "_uid")).alias("_keep"), F.count(F.lit(1)).alias("group_size")))
    return marked.join(groups, "recipe").select(
        "doc_id", F.col("_keep.doc_id").alias("keep_id"), "group_size",
        (F.col("_uid") == F.col("_keep._uid")).alias("kept"), "text_sha256", "_uid")


def keep_one(docs: DataFrame, **cutting) -> DataFrame:
    """The rows of ``docs``, all columns, less the repeats of equal texts: of a
    group the row with the largest doc_id stays."""
    row_id = free_name(docs, "_row_uid")
    rows = with_row_id(docs, row_id)
    kept = recipes(rows, row_id=row_id, **cutting).groupBy("recipe") \
        .agg(F.max(F.struct("doc_id", "_uid")).alias("_keep")).select(F.col("_keep._uid").alias(row_id))
    return rows.join(kept, row_id, "left_semi").drop(row_id)
