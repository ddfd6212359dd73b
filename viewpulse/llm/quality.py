"""Document rules and the frequency of lines among the documents of a host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.common import BLANKS, LAST_ID, WORD, count_words, fresh, hash128, let, line_key, same
from viewpulse.llm.line_dedup import split_lines

SYMBOLS = "#*$%&|<>"


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window which the text has twice or more."""
    def covered(hashes: Column) -> Column:
        def of(ordered: Column) -> Column:
            twice = F.filter(ordered, lambda e, k: e["h"].eqNullSafe(F.get(ordered, k - 1)["h"])
                             | e["h"].eqNullSafe(F.get(ordered, k + 1)["h"]))
            return F.size(F.array_distinct(F.flatten(F.transform(
                twice, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2)))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(
        let(words, lambda w: let(windows(w), covered))).cast("long")


def base_columns(text: Column) -> dict[str, Column]:
    """Counts of one text; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(split_lines(text), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    return {
        "n_words": count_words(text),
        "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_words(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))),
    }


def frequent_lines(docs: DataFrame, id_col: str, host_col: str, text_col: str, max_docs: int, max_share: float,
                   min_docs: int, min_chars: int) -> DataFrame:
    """(``host``, ``h1``, ``h2``, ``n_docs``) of lines in more documents of their host than one of two limits allows.

    Documents are told apart by id; rows without one count as one document.  Counting combines map-side; only lines of
    ``min_docs`` documents meet the host sizes.
    """
    keys = F.array_distinct(F.filter(F.transform(split_lines(F.col(text_col)), line_key),
                                     lambda k: F.length(k) >= min_chars))
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    each = docs.select(F.col(host_col).alias("host"), own.alias("doc"), F.explode(keys).alias("key"))
    h1, h2 = hash128(F.col("key"))
    often = (each.select("host", "doc", h1.alias("h1"), h2.alias("h2")).groupBy("host", "h1", "h2")
             .agg(F.count_distinct("doc").alias("n_docs")).where(F.col("n_docs") >= min(min_docs, max_docs + 1)))
    sizes = docs.groupBy(F.col(host_col).alias("_host")).agg(F.count_distinct(own).alias("_size"))
    over = (F.col("n_docs") > max_docs) | (F.col("n_docs") >= min_docs) & (F.col("n_docs") > F.col("_size") * max_share)
    return often.join(sizes, same(often, sizes, ("host", "_host"))).where(over).select("host", "h1", "h2", "n_docs")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  min_words: int = 50, max_repeat_pct: int = 50, max_docs: int = 10, max_share: float = 0.5,
                  min_docs: int = 3, min_chars: int = 10, min_left: float = 0.3) -> DataFrame:
    """Judge documents by their own counts and by how many of their lines are boilerplate of their host.

    A line (blanks stripped, A-Z lower-cased, ``min_chars`` code points or more) is boilerplate where more than
    ``max_docs`` documents of its host have it, at any size of the host, or ``min_docs`` or more that are more than the
    share ``max_share`` of a small host.  Such lines are removed; a document left with fewer than ``min_words`` words or less
    than ``min_left`` of its words is depleted.

    Returns the columns of ``docs`` with the remaining text, the counts of :func:`base_columns`, ``n_left`` (words that
    remain), ``base_failed`` (fewer than ``min_words`` words, or more than ``max_repeat_pct`` percent of them in repeated
    windows) and ``kept``.  All counts are of the text as it came.  A null text counts as empty and fails; a null host is
    a host of its own; rows of one id count as one document where lines are counted, rows without an id too.  Columns of ``docs`` with the names of results
    are replaced.
    """
    results = [*base_columns(F.lit("")), "n_left", "base_failed", "kept"]
    docs = docs.drop(*results)
    key, seen, gone, lost = fresh(docs, "_text_hash", "_of", "_gone", "_lost")
    text = F.coalesce(F.col(text_col), F.lit(""))
    placed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.col(host_col).alias("host"),
                         F.posexplode(split_lines(F.col(text_col))).alias("pos", "line"))
    placed = placed.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    h1, h2 = hash128(F.col("key"))
    placed = placed.select("id", "th", "host", "pos", count_words(F.col("line")).alias("n"), h1.alias("h1"), h2.alias("h2"))
    often = frequent_lines(docs, id_col, host_col, text_col, max_docs, max_share, min_docs, min_chars).select(
        F.col("host").alias("_host"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"))
    removed = (placed.join(often, same(placed, often, ("host", "_host")) & (placed["h1"] == often["_h1"])
                           & (placed["h2"] == often["_h2"]))
               .groupBy(F.col("id").alias(seen), F.col("th").alias(f"{seen}_th"), F.col("host").alias(f"{seen}_host"))
               .agg(F.collect_set(F.struct("pos", "n")).alias(gone)))
    removed = removed.withColumn(lost, F.aggregate(gone, F.lit(0).cast("long"), lambda s, e: s + e["n"])).withColumn(
        gone, F.transform(gone, lambda e: e["pos"]))
    counted = docs.withColumn(key, F.xxhash64(text)).withColumns(base_columns(F.col(text_col)))
    found = counted.join(removed, same(counted, removed, (id_col, seen), (key, f"{seen}_th"), (host_col, f"{seen}_host")),
                         "left")
    left = F.col("n_words") - F.coalesce(F.col(lost), F.lit(0))
    lines = split_lines(F.col(text_col))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    rest = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(let(lines, lambda own: F.array_join(
        F.transform(stay, lambda i: F.get(own, i)), "\n")))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct)
    return found.select(
        *[rest.alias(c) if c == text_col else F.col(c) for c in docs.columns], *base_columns(F.lit("")),
        left.alias("n_left"), failed.alias("base_failed"),
        (~failed & (left >= min_words) & (left >= F.col("n_words") * min_left)).alias("kept"))
