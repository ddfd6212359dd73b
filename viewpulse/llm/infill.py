"""Fill-in-the-middle: documents cut between units of text that are counted and found by arithmetic on 64-bit words."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.common import fresh, ship

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Texts whose bytes are marked together.
TOGETHER = 256
_FIRST = np.uint64(0x0101010101010101)
_TOP = np.uint64(0x8080808080808080)
_REST = ~_TOP


def _each(byte: int) -> np.uint64:
    return np.uint64(byte) * _FIRST


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind each other, and where each text starts (and the last one ends)."""
    whole = texts.cast(pa.large_binary())
    _, places, data = whole.buffers()
    at = np.frombuffer(places, np.int64)[whole.offset:whole.offset + len(whole) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def as_words(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian 64-bit words, filled up with blanks: at least one stands behind the last byte."""
    filled = np.full(len(data) // 8 * 8 + 8, 0x20, np.uint8)
    filled[:len(data)] = data
    return filled.view("<u8")


def blank_marks(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is white space (0x20, 0x09 to 0x0D); no sum leaves its byte."""
    other = words ^ _each(0x20)
    space = ~((other & _REST) + _REST | other)
    low = words & _REST
    control = low + _each(0x80 - 0x09) & ~(low + _each(0x80 - 0x0E)) & ~words
    return (space | control) & _TOP


def unit_end_marks(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The top bit of the last byte of every unit: a word byte in front of white space, or the last byte of a text."""
    blank = blank_marks(words)
    ends = ~blank & (blank >> np.uint64(8) | np.append(blank[1:], np.uint64(0)) << np.uint64(56)) & _TOP
    last = starts[1:][starts[1:] > starts[:-1]] - 1
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << (last & 7).astype(np.uint64) * np.uint64(8))
    return ends


def code_point_marks(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that starts a code point: all but 10xxxxxx."""
    return ~(words & ~(words << np.uint64(1))) & _TOP


class Marks:
    """Counting and finding marked bytes: population counts of whole words, added up, and the rest inside one word."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.append(0, np.cumsum(np.bitwise_count(words), dtype=np.int64))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes in front of byte ``at``."""
        word = at >> 3
        front = (np.uint64(1) << (at & 7).astype(np.uint64) * np.uint64(8)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & front)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The ``k``-th marked byte, from 1."""
        word = np.searchsorted(self.before, k, "left") - 1
        missing = (k - self.before[word]).astype(np.uint64)
        sums = (self.words[word] >> np.uint64(7)) * _FIRST  # in each byte the marks up to it, at most eight
        reached = (sums | _TOP) - missing * _FIRST & _TOP  # keeps the top bit where the sum is enough
        return word * 8 + 8 - np.bitwise_count(reached)


def cut_points(texts: pa.Array, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Per text the number of units, and the code points in front of the smaller and between both cuts.

    A cut lies behind ``h % (units + 1)`` units.
    """
    data, starts = flat(texts)
    words = as_words(data)
    ends, points = Marks(unit_end_marks(words, starts)), Marks(code_point_marks(words))
    first = ends.rank(starts[:-1])
    n = ends.rank(starts[1:]) - first
    a, b = h1 % (n + 1), h2 % (n + 1)

    def at(k: np.ndarray) -> np.ndarray:
        found, some = starts[:-1].copy(), k > 0
        found[some] = ends.select((first + k)[some]) + 1
        return found
    before, low, high = (points.rank(x) for x in (starts[:-1], at(np.minimum(a, b)), at(np.maximum(a, b))))
    return np.stack([n, low - before, high - low])


def _cutter() -> Callable[..., Column]:
    def cut(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        own = [x.to_numpy(zero_copy_only=False) for x in (h1, h2)]
        parts = [cut_points(text.slice(i, TOGETHER), *(x[i:i + TOGETHER] for x in own)) for i in range(0, len(text), TOGETHER)]
        found = np.concatenate(parts, axis=1) if parts else np.zeros((3, 0), np.int64)
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], ["n", "before", "between"])
    return F.arrow_udf(cut, "n long, before long, between long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "42", plain_percent: int = 50,
                   spm_percent: int = 80) -> DataFrame:
    """Bring documents into fill-in-the-middle order, cut behind whole units (a word with the white space in front of it).

    Four draws come from the SHA-256 of ``seed:id``: the two cuts, whether the text stays plain, and whether the suffix
    stands first (spm) or the prefix (psm).  A text that holds one of the three marks stays plain.

    Returns the columns of ``docs`` with the new text, and ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` (code
    points, null if plain); columns of ``docs`` with these names are replaced.  A null text stays null, an empty one empty:
    both are plain and have no units.  A missing id is drawn for as the empty text; repeated rows are cut alike.  Nothing is
    shuffled.
    """
    ship(docs.sparkSession)
    docs = docs.drop("n", "form", "prefix_chars", "middle_chars")
    drawn, cuts = fresh(docs, "_draws", "_cuts")
    text = F.coalesce(F.col(text_col), F.lit(""))
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    known = docs.withColumn(drawn, digits)
    draw = lambda i: F.conv(F.substring(F.col(drawn), 8 * i + 1, 8), 16, 10).cast("long")
    known = known.withColumn(cuts, _cutter()(text, draw(0), draw(1)))
    plain = (F.col(text_col).isNull() | (F.col(text_col) == "") | text.rlike(f"{PREFIX}|{SUFFIX}|{MIDDLE}")
             | (draw(2) % 100 >= plain_percent))
    form = F.when(plain, "plain").when(draw(3) % 100 < spm_percent, "spm").otherwise("psm")
    before, between = (F.col(cuts)[c].cast("int") for c in ("before", "between"))
    prefix = F.substring(text, F.lit(1), before)
    middle = F.substring(text, before + 1, between)
    suffix = F.substring(text, before + between + 1, F.length(text))
    moved = F.when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)).when(
        F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)).otherwise(
        F.col(text_col))
    own = lambda c: F.when(F.col("form") != "plain", F.col(cuts)[c])
    return known.withColumn("form", form).select(
        *[moved.alias(c) if c == text_col else F.col(c) for c in docs.columns], F.col(cuts)["n"].alias("n"), "form",
        own("before").alias("prefix_chars"), own("between").alias("middle_chars"))


def restored(output: Column, form: Column) -> Column:
    """The text that :func:`fill_in_middle` made ``output`` from."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(form == "spm", F.concat(parts[2], parts[3], parts[1])).when(
        form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(output)
