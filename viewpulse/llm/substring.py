"""Removal of word passages that an earlier document has, by suffix automata of reference shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.common import LAST_ID, WORD, count_words, fresh, hash128, same, ship, stored, unstored

#: Words of the shortest passage that counts; words of an anchor (windows of a passage share one by its smallest hash).
WINDOW, ANCHOR = 50, 12
#: Words of one reference shard, pieces of documents that meet a shard in one task, words a process remembers.
SHARD, MEET, REMEMBERED = 20_000, 4096, 1_000_000
#: Bits of the filters that keep rows without candidates out of a shuffle (their size does not depend on the data).
FILTER_BITS = 24
#: Multiplier of the rolling hash (odd) and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


_WORDS = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array(list(map(_WORDS.__getitem__, words)), np.uint64)


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` words, the same wherever the run stands."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    down = np.cumprod(np.append(np.uint64(1), np.full(len(hashes) - 1, _INVERSE, np.uint64)))
    up = np.cumprod(np.append(np.uint64(1), np.full(len(hashes) - n, _BASE, np.uint64)))
    sums = np.append(np.uint64(0), np.cumsum(hashes * down))
    x = (sums[n:] - sums[:-n]) * up
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):  # spread the low bits
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x


def anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """For every window the smallest hash of its runs of :data:`ANCHOR` words: equal windows have equal anchors."""
    low, width, span = rolling(hashes, ANCHOR), 1, window - ANCHOR + 1
    while width < span:
        step = min(width, span - width)
        low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        width += step
    return low


class Automaton:
    """Suffix automaton of word passages; passages are told apart by end marks that no text holds."""

    def __init__(self, passages: list[list[bytes]]):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for i, passage in enumerate(passages):
            for word in passage:
                last = self._add(last, word)
            last = self._add(last, i)

    def _add(self, last: int, word: bytes | int) -> int:
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            to = self.next[at][word]
            if self.length[to] == self.length[at] + 1:
                self.link[new] = to
            else:
                twin = len(self.next)
                self.next.append(self.next[to].copy())
                self.length.append(self.length[at] + 1)
                self.link.append(self.link[to])
                while at >= 0 and self.next[at].get(word) == to:
                    self.next[at][word] = twin
                    at = self.link[at]
                self.link[to] = self.link[new] = twin
        return new

    def spans(self, words: list[bytes], least: int) -> list[tuple[int, int]]:
        """Maximal runs [from, to) of words that lie in a match of ``least`` words or more.

        Matching statistics: at each word the length of the longest passage ending there that the automaton knows.
        """
        follow, link, length = self.next, self.link, self.length
        found: list[tuple[int, int]] = []
        state = run = 0
        for i, word in enumerate(words):
            while state and word not in follow[state]:
                state = link[state]
                run = length[state]
            to = follow[state].get(word)
            if to is None:
                run = 0
                continue
            state, run = to, run + 1
            if run >= least:
                start = i + 1 - run
                while found and found[-1][1] >= start:
                    start = min(start, found.pop()[0])
                found.append((start, i + 1))
        return found


def _anchored(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.unique(anchors(word_hashes((t.as_py() or b"").split()), window)) for t in batch.column("text")]
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()),
                                         pa.array(np.concatenate(found).view(np.int64) if found else [], pa.int64()))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "t1", "t2")), lists], ["id", "t1", "t2", "anchors"])


def _runs(marked: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs [from, to) of equal, non-negative numbers."""
    edge = np.flatnonzero(np.diff(np.concatenate([[-1], marked, [-1]])))
    return [(a, b) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()) if marked[a] >= 0]


def _candidates(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Passages of windows with shared anchors, and the hashes of these windows."""
    kinds = {"id": pa.int64(), "t1": pa.int64(), "t2": pa.int64(), "starts": pa.list_(pa.int64()),
             "passages": pa.list_(pa.string()), "windows": pa.list_(pa.int64())}
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            rows = []
            for row in batch.slice(at, 64).to_pylist():
                words = (row["text"] or b"").split()
                hashes = word_hashes(words)
                near = np.isin(anchors(hashes, window), np.array(row["shared"], np.int64).view(np.uint64))
                runs = _runs(near.astype(np.int64) - 1)
                rows.append({**{c: row[c] for c in ("id", "t1", "t2")}, "starts": [a for a, _ in runs],
                             "passages": [b" ".join(words[a:b + window - 1]).decode() for a, b in runs],
                             "windows": np.unique(rolling(hashes, window)[near]).view(np.int64).tolist()})
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in kinds.items()], list(kinds))


def _pieces(batches: Iterator[pa.RecordBatch], window: int, shards: int, shared: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Candidate passages cut by the shards of their anchors: windows that a document holds first become references, other
    windows that may be shared stream past them."""
    names = ["shard", "streams", "id", "t1", "t2", "start", "passage"]
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            out = []
            for row in batch.slice(at, 64).to_pylist():
                own = np.array(row["firsts"] or [], np.int64).view(np.uint64)
                for start, passage in zip(row["starts"], row["passages"], strict=True):
                    words = passage.encode().split(b" ")
                    hashes = word_hashes(words)
                    windows = rolling(hashes, window)
                    place = windows & np.uint64((1 << FILTER_BITS) - 1)
                    known = shared[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1 == 1
                    if not known.any():
                        continue
                    first = np.isin(windows, own)
                    shard = (anchors(hashes, window) % np.uint64(shards)).astype(np.int64)
                    for streams, chosen in ((0, first), (1, known & ~first)):
                        out += [(shard[a], streams, row["id"], row["t1"], row["t2"], start + a,
                                 b" ".join(words[a:b + window - 1]).decode()) for a, b in _runs(np.where(chosen, shard, -1))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], pa.string() if c == "passage" else pa.int64()) for i, c in enumerate(names)], names)


def _matched(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard, its references before the pieces that stream past them."""
    key, references, automaton = None, [], None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if key != (now := (row["shard"], row["salt"])):
                key, references, automaton = now, [], None
            if not row["streams"]:
                references.append(row["passage"].encode().split(b" "))
                continue
            if automaton is None:
                automaton = Automaton(references)
            out += [(row["id"], row["t1"], row["t2"], row["start"] + a, row["start"] + b)
                    for a, b in automaton.spans(row["passage"].encode().split(b" "), window)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(5)],
                                         ["id", "t1", "t2", "low", "high"])


def filter_of(keys: Column, chosen: DataFrame, bits: int) -> DataFrame:
    """(``_bucket``, ``_bits``): a set of the low ``bits`` bits of long keys, in at most 2^bits / 32768 + 1 rows of 4 KB."""
    place = F.pmod(keys, F.lit(1 << bits)) + 1
    return chosen.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("_bits"))


def filter_bytes(keys: Column, chosen: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The same as bytes, for Arrow functions: bit b of byte i stands for the place 8 i + b."""
    found = np.zeros((1 << bits) // 8, np.uint8)
    for row in filter_of(keys, chosen, bits).collect():  # bounded by bits
        at = (row["_bucket"] - 1) * 4096
        found[at:at + 4096] = np.frombuffer(row["_bits"], np.uint8)[:len(found) - at]
    return found


def maybe_among(df: DataFrame, key: Column, chosen: DataFrame, name: str, bits: int = FILTER_BITS) -> DataFrame:
    """``df`` with a boolean ``name``: whether a row may have a ``key`` of ``chosen``.

    A filter of 2^``bits`` bits is sent to all tasks; nothing else moves.  It says yes to some other rows too, more of them
    the more keys there are, but never no to a chosen one.
    """
    bitmaps = filter_of(F.xxhash64("key"), chosen, bits)
    own, bucket = fresh(df, "_place", "_own_bucket")
    placed = df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(1 << bits)) + 1)
    placed = placed.withColumn(bucket, F.bitmap_bucket_number(own)).withColumn(own, F.bitmap_bit_position(own))
    met = placed.join(F.broadcast(bitmaps), placed[bucket] == bitmaps["_bucket"], "left")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.col(own) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, F.col(own) % 8) == 1, F.lit(False))
    return met.withColumn(name, hit).select(*[F.col(c) for c in df.columns], name)


def only_among(df: DataFrame, key: Column, chosen: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``df`` that :func:`maybe_among` says yes to."""
    (hit,) = fresh(df, "_hit")
    return maybe_among(df, key, chosen, hit, bits).where(F.col(hit)).drop(hit)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(``id``, ``t1``, ``t2``, ``copy``, ``ranges``) of documents with words to remove; t1, t2 hash the text.

    1. Of equal texts only the one with the smallest id goes on; the others are ``copy``.
    2. Each window has an anchor, the smallest hash of its 12-word runs.  Anchors of two or more documents mark the
       candidate passages; texts without any are not moved.
    3. Each window found in several documents has a first one.  The windows that a document holds first are references.
       They go, as passages of many documents, to the shards of their anchors, of :data:`SHARD` words in expectation, and
       become one suffix automaton a shard.
    4. Other windows that may be shared (a filter of fixed size decides, so a window of very many documents is never looked
       up) stream, as pieces of passages, past the automata of *their* anchors: equal windows have equal anchors.  A shard
       that many pieces meet goes to as many tasks.  Matching statistics give the maximal spans of ``window`` words or
       more.  All that an automaton holds stands in a document of smaller id than the piece, so a match decides.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    t1, t2 = hash128(text)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), t1.alias("t1"), t2.alias("t2"), text.cast("binary").alias("text"))
    marked = stored(plain.mapInArrow(lambda it: _anchored(it, window), "id long, t1 long, t2 long, anchors array<long>"), "anchors")
    order = F.coalesce("id", F.lit(LAST_ID))
    firsts = stored(marked.groupBy("t1", "t2").agg(F.min(order).alias("ord")), "equal-texts")
    # looked up with the id: what is not found is a copy, and the copies of one text spread over all tasks
    copies = marked.select("id", "t1", "t2", order.alias("ord")).join(firsts, ["t1", "t2", "ord"], "left_anti").select("id", "t1", "t2")
    # a text stands for its copies from here on; rows of one id stay apart by their texts
    seen = marked.groupBy("t1", "t2").agg(F.min(order).alias("ord"), F.any_value("anchors").alias("anchors"))
    each = seen.select("ord", "t1", "t2", F.explode("anchors").alias("anchor"))
    shared = each.groupBy("anchor").agg(F.min("ord").alias("_low"), F.max("ord").alias("_high")).where("_low < _high")
    shared = stored(shared.select("anchor"), "shared-anchors")
    met = only_among(each, F.col("anchor"), shared.select(F.col("anchor").alias("key"))).join(shared, "anchor").groupBy(
        "ord", "t1", "t2").agg(F.collect_list("anchor").alias("shared"))
    met = stored(met, "met-anchors")
    some = only_among(plain.withColumn("ord", order), F.xxhash64("ord", "t1", "t2"), met.select(
        F.xxhash64("ord", "t1", "t2").alias("key")))
    joined = some.join(met, ["ord", "t1", "t2"]).select(F.col("ord").alias("id"), "t1", "t2", "text", "shared").dropDuplicates(
        ["id", "t1", "t2"])
    spans = stored(joined.mapInArrow(lambda it: _candidates(it, window), "id long, t1 long, t2 long, starts array<long>, "
                                     "passages array<string>, windows array<long>"), "candidates")
    windows = spans.select("id", F.explode("windows").alias("w"))
    held = stored(windows.groupBy("w").agg(F.min("id").alias("first"), F.max("id").alias("_high")).where("first < _high").select(
        "w", "first"), "shared-windows")
    unstored(shared, met)
    known = filter_bytes(F.col("w"), held)
    n_shards = max(1, -(-held.count() * 4 // SHARD))  # a reference window brings about four words
    own = held.groupBy(F.col("first").alias("id")).agg(F.collect_list("w").alias("firsts"))
    pieces = stored(spans.select("id", "t1", "t2", "starts", "passages").join(own, "id", "left").mapInArrow(
        lambda it: _pieces(it, window, n_shards, known),
        "shard long, streams long, id long, t1 long, t2 long, start long, passage string"), "pieces")
    unstored(spans, held)
    crowds = pieces.where("streams = 1").groupBy("shard").agg(F.ceil(F.count("*") / F.lit(float(MEET))).cast("long").alias("salts"))
    crowds = stored(crowds, "crowds")
    references = pieces.where("streams = 0").join(crowds, "shard").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    streams = pieces.where("streams = 1").join(crowds.where("salts > 1"), "shard", "left").withColumn(
        "salt", F.pmod(F.xxhash64("id", "t1", "t2", "start"), F.coalesce("salts", F.lit(1).cast("long"))))
    names = ["shard", "salt"]
    together = references.unionByName(streams).drop("salts").repartition(*names).sortWithinPartitions(*names, "streams")
    ranges = together.mapInArrow(lambda it: _matched(it, window), "id long, t1 long, t2 long, low long, high long")
    ranges = ranges.groupBy("id", "t1", "t2").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    ranges = ranges.select(F.when(F.col("id") < LAST_ID, F.col("id")).alias("id"), "t1", "t2", F.lit(False).alias("copy"), "ranges")
    whole = copies.distinct().withColumn("copy", F.lit(True)).withColumn("ranges", F.lit(None).cast(ranges.schema["ranges"].dataType))
    found = stored(ranges.unionByName(whole), "repeated")
    unstored(marked, firsts, pieces, crowds)
    return found


def dedupe_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Remove each word that lies in a window of ``window`` words which a document of smaller id also has.

    Windows are judged on the texts as they come.  Returns the columns of ``docs``, a changed text being its kept words
    joined by one space, and ``n_words`` (before) and ``n_removed``; columns of ``docs`` with these names are replaced.  A
    null text stays null and has no words.  Rows with one id are one document and keep what they share with each other;
    rows without an id are one document that comes last.  Only rows that may lose words meet the list of ranges in a
    shuffle, the others go through where they are.
    """
    docs = docs.drop("n_words", "n_removed")
    key1, key2, id_, copy, ranges, words, hit = fresh(docs, "_t1", "_t2", "_of", "_copy", "_ranges", "_words", "_hit")
    found = repeated_passages(docs, id_col, text_col, window).select(
        F.col("id").alias(id_), F.col("t1").alias(f"{key1}_of"), F.col("t2").alias(f"{key2}_of"), F.col("copy").alias(copy),
        F.col("ranges").alias(ranges))
    t1, t2 = hash128(F.coalesce(F.col(text_col), F.lit("")))
    hashed = maybe_among(docs.withColumn(key1, t1).withColumn(key2, t2), F.xxhash64(key1, key2, F.coalesce(
        F.col(id_col).cast("long"), F.lit(LAST_ID))), found.select(F.xxhash64(
            f"{key1}_of", f"{key2}_of", F.coalesce(id_, F.lit(LAST_ID))).alias("key")), hit)
    known = hashed.where(F.col(hit))
    met = known.join(found, same(known, found, (id_col, id_), (key1, f"{key1}_of"), (key2, f"{key2}_of")), "left")
    met = met.withColumn("n_words", count_words(F.col(text_col)))
    gone = F.array_distinct(F.flatten(F.transform(F.col(ranges), lambda r: F.sequence(r["low"], r["high"] - 1))))
    stay = F.array_except(F.sequence(F.lit(0).cast("long"), F.col("n_words") - 1), gone)
    all_gone = F.coalesce(F.col(copy), F.lit(False)) & (F.col("n_words") >= window)
    part_gone = ~F.coalesce(F.col(copy), F.lit(True))
    met = met.withColumn(words, F.when(part_gone, F.transform(stay, lambda i: i.cast("int"))))
    own = F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0))
    kept = F.when(all_gone, "").when(part_gone, F.get(F.transform(F.array(own), lambda w: F.array_join(
        F.transform(F.col(words), lambda i: F.get(w, i)), " ")), F.lit(0))).otherwise(F.col(text_col))
    removed = F.when(all_gone, F.col("n_words")).when(part_gone, F.col("n_words") - F.size(words)).otherwise(0)
    changed = met.select(*[kept.alias(c) if c == text_col else F.col(c) for c in docs.columns], "n_words",
                         removed.cast("long").alias("n_removed"))
    same_ = hashed.where(~F.col(hit)).select(*[F.col(c) for c in docs.columns], count_words(F.col(text_col)).alias("n_words"),
                                             F.lit(0).cast("long").alias("n_removed"))
    return same_.unionByName(changed)
