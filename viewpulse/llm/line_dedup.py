"""Exact removal of lines that several documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.common import LAST_ID, fresh, hash128, line_key, same


def split_lines(text: Column) -> Column:
    """Lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Of (``ord``, ``h1``, ``h2``) rows: hashes found in ``min_docs`` or more documents, with the ``first`` of these."""
    if min_docs <= 2:
        found = lines.groupBy("h1", "h2").agg(F.min("ord").alias("first"), F.max("ord").alias("_last"))
        return found.where(F.col("first") < F.col("_last")).drop("_last")
    each = lines.groupBy("h1", "h2", "ord").agg(F.lit(1).alias("_one"))
    found = each.groupBy("h1", "h2").agg(F.min("ord").alias("first"), F.count("*").alias("_docs"))
    return found.where(F.col("_docs") >= min_docs).drop("_docs")


def dedupe_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                 min_docs: int = 2) -> DataFrame:
    """Drop each line that also stands in a document of smaller id, if ``min_docs`` or more documents share it.

    Lines are compared by key (blanks stripped, A-Z lower-cased); keys shorter than ``min_chars`` code points always
    stay.  Lines go out as (document, position, 128-bit hash) rows without their text, are counted per hash, and the
    positions to drop come back to the document, whose remaining lines are put together in their order.  No group of
    equal lines is ever gathered: counting combines map-side and the join on the hash is one adaptive execution splits.

    Returns the columns of ``docs`` with the new text, ``n_lines`` (before) and ``n_dropped``.  A null text becomes the
    empty text (one empty line).  Rows with one id are one document and keep the lines they share with each other; rows
    without an id are one document that comes last.  Columns of ``docs`` named ``n_lines`` or ``n_dropped`` are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    key, seen, drop, lines = fresh(docs, "_text_hash", "_of", "_drop", "_lines")
    text = F.coalesce(F.col(text_col), F.lit(""))
    placed = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.posexplode(split_lines(F.col(text_col))).alias("pos", "line"))
    placed = placed.select("id", "th", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    h1, h2 = hash128(F.col("key"))
    placed = placed.select("id", "th", "pos", h1.alias("h1"), h2.alias("h2"),
                           F.coalesce("id", F.lit(LAST_ID)).alias("ord"))
    shared = shared_lines(placed.select("ord", "h1", "h2"), min_docs)
    drops = (placed.join(shared, ["h1", "h2"]).where(F.col("ord") > F.col("first"))
             .groupBy(F.col("id").alias(seen), F.col("th").alias(f"{seen}_th")).agg(F.collect_set("pos").alias(drop)))
    known = docs.withColumn(key, F.xxhash64(text))
    found = known.join(drops, same(known, drops, (id_col, seen), (key, f"{seen}_th")), "left")
    found = found.withColumn(lines, split_lines(F.col(text_col)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop))
    kept = F.when(F.col(drop).isNull(), text).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col(lines), i)), "\n"))
    return found.select(
        *[kept.alias(c) if c == text_col else F.col(c) for c in docs.columns],
        F.size(lines).cast("long").alias("n_lines"),
        F.when(F.col(drop).isNull(), 0).otherwise(F.size(drop)).cast("long").alias("n_dropped"))
