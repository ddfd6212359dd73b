"""What each of several text filters removes in every order of them, from one pass over the bytes of the texts."""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.common import LAST_ID, fresh, hash128, ship, stored
from viewpulse.llm.infill import flat

#: Bytes of the texts that pass the transducer together (a longer text alone).
TOGETHER = 1 << 20
#: Bytes of a word up to which it is hashed and compared in 64-bit steps beside others.
LONG = 256
FILTERS = "ABCDE"
#: What the transducer emits at a byte.
WORD, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8
_OUTSIDE, _INSIDE = 0, 1


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """State after a byte, whatever the state before, and what is emitted, by state before and byte."""
    byte = np.arange(256)
    blank = (byte == 0x20) | (byte >= 0x09) & (byte <= 0x0D)
    after = np.where(blank, _OUTSIDE, _INSIDE).astype(np.uint8)
    always = (CAPITAL * ((byte >= ord("A")) & (byte <= ord("Z"))) + POINT * ((byte & 0xC0) != 0x80)
              + SYMBOL * np.isin(byte, list(b"#$%&*|")))
    return after, np.stack([always + WORD * ~blank, always]).astype(np.uint8)


AFTER, EMIT = _tables()
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _FACTOR
    return x ^ x >> np.uint64(29)


class Spans:
    """Words as stretches of bytes, hashed and compared where they lie."""

    def __init__(self, data: np.ndarray, at: np.ndarray, size: np.ndarray, owner: np.ndarray):
        padded = np.append(data, np.zeros(8, np.uint8))
        self.loads = np.ndarray(len(data) + 1, "<u8", buffer=padded, strides=(1,))  # eight bytes from every place
        self.data, self.at, self.size, self.owner = data, at, size, owner

    def _step(self, rows: np.ndarray, step: int) -> np.ndarray:
        return self.loads[self.at[rows] + 8 * step] & _KEEP[np.minimum(self.size[rows] - 8 * step, 8)]

    def _bytes(self, row: int) -> bytes:
        return self.data[self.at[row]:self.at[row] + self.size[row]].tobytes()

    def hashes(self) -> np.ndarray:
        """By owner and bytes."""
        found = _mixed(self.owner.astype(np.uint64) * _FACTOR + self.size.astype(np.uint64))
        rows, step = np.flatnonzero(self.size <= LONG), 0
        while len(rows):
            found[rows] = _mixed(found[rows] ^ self._step(rows, step))
            step += 1
            rows = rows[self.size[rows] > 8 * step]
        for row in np.flatnonzero(self.size > LONG):
            found[row] ^= np.uint64(xxhash.xxh64_intdigest(self._bytes(row)))
        return found

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans ``a`` and ``b`` have one owner and the same bytes."""
        same = (self.owner[a] == self.owner[b]) & (self.size[a] == self.size[b])
        open_, step = np.flatnonzero(same & (self.size[a] <= LONG)), 0
        while len(open_):
            fits = self._step(a[open_], step) == self._step(b[open_], step)
            same[open_[~fits]] = False
            step += 1
            open_ = open_[fits & (self.size[a[open_]] > 8 * step)]
        for i in np.flatnonzero(same & (self.size[a] > LONG)):
            same[i] = self._bytes(a[i]) == self._bytes(b[i])
        return same

    def first(self) -> np.ndarray:
        """One span of every kind of equal ones: all spans are put into an open hash table at once.

        A span takes the empty slot it comes to; where one is held, the bytes of both are compared: an equal span is done,
        a different one goes on to the next slot.  Equal spans come to the same slots in the same rounds.
        """
        n = len(self.at)
        bits = max(4, (2 * n).bit_length())
        slots = np.full(1 << bits, -1)
        slot = (self.hashes() >> np.uint64(64 - bits)).astype(np.int64)
        first, waiting = np.zeros(n, bool), np.arange(n)
        while len(waiting):
            here = slot[waiting]
            free = slots[here] < 0
            slots[here[free]] = waiting[free]  # of several spans one stays
            held = slots[here]
            own = held == waiting
            first[waiting[own]] = True
            rest = np.flatnonzero(~own)
            waiting = waiting[rest[~self.equal(waiting[rest], held[rest])]]
            slot[waiting] = slot[waiting] + 1 & (1 << bits) - 1
        return first


def counts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Words, distinct words, capitals A-Z, code points and symbols of texts that lie behind each other.

    The transducer has two states, outside and inside a word, and its tables are indexed by byte.  A byte leads to one state
    whatever the state before, so the states of all bytes are looked up at once.
    """
    state = AFTER[data]
    before = np.append(np.uint8(_OUTSIDE), state[:-1])
    before[starts[:-1][starts[:-1] < len(data)]] = _OUTSIDE  # a text starts outside
    emitted = EMIT[before, data]

    def per_text(flag: int) -> np.ndarray:
        sums = np.append(0, np.cumsum(emitted & flag != 0, dtype=np.int64))
        return sums[starts[1:]] - sums[starts[:-1]]
    at = np.flatnonzero(emitted & WORD)
    owner = np.searchsorted(starts, at, "right") - 1
    outside = np.flatnonzero(np.append(state, _OUTSIDE) == _OUTSIDE)
    stop = np.minimum(outside[np.searchsorted(outside, at)], starts[owner + 1])
    first = Spans(data, at, stop - at, owner).first()
    return np.stack([per_text(WORD), np.bincount(owner[first], minlength=len(starts) - 1), *map(per_text, (CAPITAL, POINT, SYMBOL))])


COUNTS = ("n_words", "n_distinct", "n_capitals", "n_chars", "n_symbols")


def _counter() -> Callable[[Column], Column]:
    def count(texts: pa.Array) -> pa.Array:
        data, starts = flat(texts)
        parts, low = [np.zeros((len(COUNTS), 0), np.int64)], 0
        while low < len(texts):
            high = max(low + 1, int(np.searchsorted(starts, starts[low] + TOGETHER)) - 1)
            parts.append(counts(data[starts[low]:starts[high]], starts[low:high + 1] - starts[low]))
            low = high
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in np.concatenate(parts, axis=1)], list(COUNTS))
    return F.arrow_udf(count, ", ".join(f"{c} long" for c in COUNTS))


def text_counts(text: Column) -> Column:
    """The counts of :data:`COUNTS` as one struct; a null text counts as empty."""
    return _counter()(F.coalesce(text, F.lit("")))


def text_failures(c: Column, min_words: int = 200, min_distinct: int = 50, max_capitals: int = 3) -> list[Column]:
    """Filters A to D on the counts: few words, few different words, many capitals, any symbol."""
    return [c["n_words"] < min_words, c["n_distinct"] * 100 < c["n_words"] * min_distinct,
            c["n_capitals"] * 100 > c["n_chars"] * max_capitals, c["n_symbols"] > 0]


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(``id``, ``part``, ``mask``) per row of ``docs``: bit i is set where the text fails filter i of ABCDE.

    E, an equal text of a smaller id, is judged among all rows.  Texts are told apart by two 64-bit hashes; a row is looked
    up by hash *and* id among the first rows of the texts, so the copies of one text spread over all tasks.
    """
    ship(docs.sparkSession)
    (c,) = fresh(docs, "_counts")
    t1, t2 = hash128(F.coalesce(F.col(text_col), F.lit("")))
    bits = [F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(text_failures(F.col(c)))]
    rows = stored(docs.withColumn(c, text_counts(F.col(text_col))).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
        sum(bits, F.lit(0)).alias("mask"), t1.alias("t1"), t2.alias("t2"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("ord")), "failures")
    firsts = rows.groupBy("t1", "t2").agg(F.min("ord").alias("ord")).withColumn("first", F.lit(True))
    return rows.join(firsts, ["t1", "t2", "ord"], "left").select(
        "id", "part", (F.col("mask") + F.when(F.col("first"), 0).otherwise(1 << 4)).alias("mask"))


def interactions(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from (``part``, ``mask``, ``good``, ``toxic``) per document.

    Documents are first counted per part and mask, at most 2^filters rows a part; the orders are laid out over these.
    """
    number = {f: i for i, f in enumerate(filters)}
    steps = F.array(*[F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(step + 1).alias("step"),
                               F.lit(1 << number[f]).alias("own"), F.lit(sum(1 << number[g] for g in order[:step])).alias("earlier"))
                      for order in permutations(filters) for step, f in enumerate(order)])
    cells = masks.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"),
                                              F.count_if("toxic").alias("toxic"))
    laid = cells.select("*", F.inline(steps))
    mask, own, earlier = F.col("mask"), F.col("own"), F.col("earlier")
    fails, gone = mask.bitwiseAND(own) != 0, mask.bitwiseAND(earlier) != 0
    total = lambda condition, value="n": F.sum(F.when(condition, F.col(value)).otherwise(0)).cast("long")
    # a document is removed by each of its failed filters in the same number of orders
    share = F.expr(f"n * ({factorial(len(filters))} div greatest(bit_count(mask), 1))")
    return laid.groupBy("part", "filter_order", "step").agg(
        total(mask.bitwiseAND(own.bitwiseOR(earlier)) == 0).alias("kept"), total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"), total(mask == own).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"), total(fails & ~gone, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, share).otherwise(0)).cast("long").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """How the filters A to E work together in every order, per value of ``part_col`` (null: the empty text).

    Columns: ``part``, ``filter_order``, ``step``, and counts of documents: ``kept`` after the step, ``removed`` here,
    ``redundant`` (failing, but removed earlier), ``unique_fails`` (failing this filter only), ``good_lost`` and
    ``toxic_lost`` (removed here, of quality 1 or toxic by ``labels``), ``shapley`` (removed by the filter, over all orders).

    Every row is a document, repeated rows too; rows of one id do not repeat each other, rows without an id repeat any with
    one.  A null text counts as empty.  Of several labels of an id any 1 counts; other columns are not looked at.  Without
    rows there are no parts.
    """
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    masks = failure_masks(docs, id_col, text_col, part_col).join(marks, "id", "left")
    return interactions(masks)
