"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewpulse.llm.common import bits_for, count_words, fresh, running, same, stored

#: Rows of one innermost window: slots of a source, documents of a source, sources.
CHUNK = 4096


def numbered_sources(sized: DataFrame) -> DataFrame:
    """One row per source, numbered from 0 in code-point order, null last, without sorting them in one task."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    dealt = stored(sums.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn(
        "_part", F.spark_partition_id()), "mix-sources")
    order = [F.col("source").asc_nulls_last()]
    parts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))  # one row per partition
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1).join(
        parts, "_part").withColumn("no", (F.col("_rank") + F.col("_before")).cast("long")).drop("_part", "_rank", "_before")


def water_filled(sources: DataFrame, weights: tuple[float, ...], share: float, max_repeats: int) -> DataFrame:
    """Add ``target``: ``share`` of all sizes by weight, at most ``max_repeats`` times a source's size.

    What the limit cuts is dealt out again by weight among the others.  Each round fixes the level from two sums over the
    sources; rounds end when no further source is cut.
    """
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("no") % len(weights)).cast("int"))
    sources = stored(sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeats), "mix-weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    wanted, level, cut = total * share, 0.0, -1
    while True:
        over = F.col("cap") < F.lit(level) * F.col("weight")
        row = sources.agg(F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)).alias("fixed"),
                          F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("free"),
                          F.count_if(over).alias("n")).first()
        if row["n"] == cut or not row["free"]:
            break
        cut, level = row["n"], (wanted - row["fixed"]) / row["free"]
    return sources.withColumn("target", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))).withColumn(
        "take", F.floor(F.col("target") + 0.5).cast("long"))


def van_der_corput(n: Column) -> Column:
    """The point of [0, 1) whose binary digits are those of ``n`` in reverse."""
    return F.conv(F.reverse(F.lpad(F.bin(n), 48, "0")), 2, 10).cast("double") / float(2**48)


def schedule(sources: DataFrame, block_words: int) -> DataFrame:
    """(``slot``, ``no``, ``rank``): the order in which the sources give their blocks.

    Point t of the van der Corput sequence falls into the stretch of one source in the line of all targets; the slots of a
    source are ranked in order.  A source takes as many slots as its target has blocks: later slots stay empty, and the
    few that a source is short of (discrepancy grows with log n) come at the end.
    """
    spark = sources.sparkSession
    total, n = sources.agg(F.coalesce(F.sum("take"), F.lit(0)), F.count("*")).first()
    slots = -(-total // block_words)
    blocks = F.ceil(F.col("take") / F.lit(block_words)).cast("long")
    line = running(sources.select("no", "take", blocks.alias("blocks"), F.lit(0).alias("all"),
                                  F.expr(f"no div {CHUNK}").alias("bucket")), "all", "bucket", ["no"], "take", "start")
    cells = 16 * max(n, 1)  # the line is cut into cells, so that points meet stretches by an equal join
    at = lambda c: F.least(F.floor(c / F.lit(float(max(total, 1))) * cells), F.lit(cells - 1))
    stretches = line.where("take > 0").select(
        "no", "blocks", F.col("start").alias("low"), (F.col("start") + F.col("take")).alias("high"),
        F.explode(F.sequence(at(F.col("start")), at(F.col("start") + F.col("take")))).alias("cell"))
    points = spark.range(slots).select(F.col("id").alias("slot"), (van_der_corput(F.col("id")) * total).alias("u"))
    points = points.withColumn("cell", at(F.col("u")))
    hit = points.join(stretches, "cell").where((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
    hit = hit.select("slot", "no", "blocks", F.expr(f"slot div {CHUNK}").alias("bucket"), F.lit(1).alias("one"))
    ranked = stored(running(hit, "no", "bucket", ["slot"], "one", "rank").select("slot", "no", "rank", "blocks"), "mix-slots")
    have = ranked.groupBy("no").agg(F.count("*").alias("have"))
    short = line.join(have, "no", "left").withColumn("have", F.coalesce("have", F.lit(0))).where(F.col("have") < F.col("blocks"))
    extra = short.select("no", "have", F.explode(F.sequence(F.col("have"), F.col("blocks") - 1)).alias("rank"))
    extra = extra.select((F.lit(slots) + (F.col("rank") - F.col("have")) * n + F.col("no")).alias("slot"), "no", "rank")
    return ranked.where(F.col("rank") < F.col("blocks")).select("slot", "no", "rank").unionByName(extra)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (1, 2, 3), share: float = 1.0, max_repeats: int = 3, block_words: int = 1024,
        seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """Draw a mixture whose sources stand in the given weights.

    Sources in code-point order (null last) weigh ``weights``, repeating; together they give ``share`` of the words of
    ``docs``, none more than ``max_repeats`` times its own words.  The documents of a source are shuffled by a keyed hash
    and laid end to end as a ring, which is cut into blocks of ``block_words`` words; the k-th slot of a source in the
    :func:`schedule` takes its k-th block, round after round.  The last block of a source is cut where its target ends, so
    its words equal the target to within half a word.

    Returns two frames.  ``items``: ``row``, ``id``, ``th`` (hash of the text), ``source``, ``size``, ``source_size``,
    ``target``, one per row of ``docs``.  ``pieces``: ``slot``, ``no``, ``row``, ``start``, ``words``: the words of a
    document that a slot gets, in the order of the mixture.  A null text has size 0 and is in no piece; repeated rows are
    separate items; a source without words has target 0; without any words there are no pieces.
    """
    sized = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(source_col).alias("source"),
                        count_words(F.col(text_col)).alias("size"))
    sized = stored(sized.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    sources = stored(water_filled(numbered_sources(sized), weights, share, max_repeats), "mix-targets")
    known = sources.select(F.col("source").alias("_source"), "no", "source_size", "target", "take")
    items = sized.join(known, same(sized, known, ("source", "_source"))).drop("_source")

    bits = bits_for(sources.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0], CHUNK)
    # rows without an id are dealt by text and row, so that they do not meet in one bucket
    own = F.coalesce(F.col("id").cast("string"), F.concat_ws(":", F.lit("null"), "th", "row"))
    mixed = F.md5(F.concat(own, F.lit(f":{seed}")))
    bucket = F.shiftrightunsigned(F.conv(F.substring(mixed, 1, 8), 16, 10).cast("long"), 32 - bits)
    ring = running(items.where("size > 0").select("row", "no", "id", "th", "size", "source_size", "take", mixed.alias("key"),
                                                  bucket.alias("bucket")),
                   "no", "bucket", ["key", "id", "th", "row"], "size", "start")
    rounds = ring.where("take > 0").withColumn("lap", F.explode(F.sequence(F.lit(0), F.expr("(take - 1) div source_size"))))
    rounds = rounds.withColumn("low", F.col("start") + F.col("lap") * F.col("source_size"))
    rounds = rounds.withColumn("high", F.least(F.col("low") + F.col("size"), F.col("take"))).where("low < high")
    cut = rounds.withColumn("rank", F.explode(F.expr(f"sequence(low div {block_words}, (high - 1) div {block_words})")))
    begin = F.greatest("low", F.col("rank") * block_words)
    cut = cut.select("no", "rank", "row", (begin - F.col("low")).alias("start"),
                     (F.least("high", (F.col("rank") + 1) * block_words) - begin).alias("words"))
    pieces = cut.join(schedule(sources, block_words), ["no", "rank"]).select("slot", "no", "row", "start", "words")
    return items.select("row", "id", "th", "source", "size", "source_size", "target"), pieces


def taken(items: DataFrame, pieces: DataFrame) -> DataFrame:
    """``items`` with ``taken``: the words the mixture has of each, repeats counted."""
    sums = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    return items.join(sums, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """Rows of ``docs`` as often as :func:`mix` takes them, rounded to whole documents (at most one of a source is cut).

    Rows equal in id and text share what they get together evenly.  Documents without words, null texts among them, are in
    no mixture and go.
    """
    items, pieces = mix(docs, id_col, text_col, **settings)
    each = taken(items, pieces).where("size > 0")
    times = F.round(F.sum("taken") / F.sum("size")).cast("int")
    key, id_, th, n = fresh(docs, "_text_hash", "_of", "_th", "_times")
    copies = each.groupBy(F.col("id").alias(id_), F.col("th").alias(th)).agg(times.alias(n)).where(F.col(n) > 0)
    known = docs.withColumn(key, F.xxhash64(text_col))
    found = known.join(copies, same(known, copies, (id_col, id_), (key, th)))
    return found.withColumn(key, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*[F.col(c) for c in docs.columns])
