"""Packing tokenised documents into sequences by multiway differencing."""

from __future__ import annotations

import heapq
import sys
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized, normalize

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.common import remembered, ship

#: Words a process remembers the ids of (about 200 bytes each), as many as it met before these, and the longest of them.
REMEMBERED, LONGEST = 250_000, 64
#: ASCII punctuation that never joins a letter before it in a token run; an apostrophe may.
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters from here on go through the tokenizer's own normalizer.
_PLAIN = "\u02b0"
#: The byte alphabet of byte-level vocabularies: printable bytes stand for themselves, the others for U+0100 onwards.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class WordIds(dict):
    """Ids of words as bytes (little-endian unsigned 32-bit), looked up once.

    The tokenizer never joins text across ASCII white space and lower-cases, so the ids of a text are those of its words
    one after the other.  Closing punctuation after a letter is always a token run of its own and is looked up apart.

    When :data:`REMEMBERED` words are known they become ``older``, in place of those that were; a word met again is taken
    from there.  Common words are thus never forgotten, however many rare ones pass.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.older: dict[bytes, bytes] = {}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def run(self, run: str) -> bytes:
        """One token run that the normalizer leaves alone goes straight to the merges, in the byte alphabet."""
        found = array("I", [t.id for t in self.model.tokenize(run)])
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()

    def ids(self, word: bytes) -> bytes:
        text = word.decode()
        if word.isalpha() and word.islower():  # of bytes: ASCII letters, which stand for themselves
            return self.run(text)
        body = text.rstrip(_TAIL)
        if body and len(body) < len(text) and normalize("NFC", body[-1]).lower().isalpha():
            return self[body.encode()] + self[text[len(body):].encode()]
        if text.isalpha() and text == text.lower() and max(text) < _PLAIN and is_normalized("NFC", text):
            return self.run(word.decode("latin-1").translate(_BYTES))
        return self.encode(text)

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.ids(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found

    def of_text(self, text: bytes | None) -> bytes:
        text = text or b""
        if b"<|" in text:  # may hold a special token, which is told apart by case and may span blanks
            return self.encode(text.decode())
        return b"".join(map(self.__getitem__, text.lower().split()))


def word_ids(path: str) -> WordIds:
    """One memory of words per process."""
    return remembered(("word ids", path), lambda: WordIds(path))


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window (0 to ``k`` - 1) of each item by Karmarkar-Karp multiway differencing.

    A partial partition has k sums in falling order.  The two partitions with the widest spread are merged, the largest
    sum of one with the smallest of the other, until one is left; windows are then read off from the merges.
    """
    n = len(sizes)
    spread = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(spread)
    sums: dict[int, np.ndarray] = {}
    merges: list[tuple[int, int, np.ndarray]] = []

    def take(i: int) -> np.ndarray:
        if i >= n:
            return sums.pop(i)
        leaf = np.zeros(k, np.int64)
        leaf[0] = sizes[i]
        return leaf

    while len(spread) > 1:
        (_, a), (_, b) = heapq.heappop(spread), heapq.heappop(spread)
        both = take(a) + take(b)[::-1]
        order = np.argsort(-both, kind="stable").astype(np.int32)
        both = both[order]
        merges.append((a, b, order))
        new = n + len(merges) - 1
        sums[new] = both
        heapq.heappush(spread, (int(both[-1] - both[0]), new))
    window = np.zeros(n, np.int64)
    labels = {n + len(merges) - 1: np.arange(k)}
    for j in range(len(merges) - 1, -1, -1):
        a, b, order = merges[j]
        raw = np.empty(k, np.int64)
        raw[order] = labels.pop(n + j)
        for child, own in ((a, raw), (b, raw[::-1])):
            if child < n:
                window[child] = own[0]
            else:
                labels[child] = own
    return window


def near_equal_windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows of :func:`differencing`; their count starts at the least possible and rises while one is too full."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, k)
        if np.bincount(window, sizes, k).max() <= capacity:
            return window
        k += 1


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
         end_id: int = 2, largest: int = 1024, shard: int = 512) -> DataFrame:
    """Tokenise and pack all documents into sequences of at most ``capacity`` ids.

    A document is its ids and ``end_id``.  Full sequences are cut from its front; the rest, in pieces of at most
    ``largest`` ids, is packed with those of the documents around it: ``shard`` pieces at a time go into near-equal
    windows.  Each partition of ``docs`` is read once, as a stream, and nothing is shuffled; a task holds the ids of one
    shard.  ``docs`` should come straight from a table, so that a repeated task meets the same rows.

    Returns per piece ``doc_id``, ``start``, ``length``, ``ids`` (binary, little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset``.  A null or empty text is the ``end_id`` alone.  Repeated rows are packed each on their
    own; other columns of ``docs`` are not looked at.
    """
    ship(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sequence = word_ids(tokenizer), TaskContext.get().partitionId() << 33
        whole: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of full sequences
        rest: list[tuple] = []  # the same of pieces that share a sequence

        def out(rows: list[tuple], sequences: list[int], offsets: list[int]) -> pa.RecordBatch:
            doc, start, ids, tokens = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([
                pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(ids, pa.binary()), pa.array(tokens, pa.int64()), pa.array(sequences, pa.int64()),
                pa.array(offsets, pa.int64())], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        def shared(rows: list[tuple], sequence: int) -> tuple[pa.RecordBatch, int]:
            window = near_equal_windows(np.array([len(r[2]) // 4 for r in rows], np.int64), capacity)
            used = np.unique(window, return_inverse=True)[1]
            filled, offsets = [0] * (int(used.max()) + 1), []
            for row, w in zip(rows, used, strict=True):
                offsets.append(filled[w])
                filled[w] += len(row[2]) // 4
            return out(rows, (sequence + used).tolist(), offsets), sequence + len(filled)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = known.of_text(text.as_py()) + end
                n = len(ids) // 4
                cut = n // capacity * capacity
                whole += [(doc, s, ids[4 * s:4 * (s + capacity)], n) for s in range(0, cut, capacity)]
                rest += [(doc, s, ids[4 * s:4 * min(n, s + largest)], n) for s in range(cut, n, largest)]
                if len(whole) >= 256:
                    yield out(whole, list(range(sequence, sequence + len(whole))), [0] * len(whole))
                    sequence, whole = sequence + len(whole), []
                while len(rest) >= 2 * shard:
                    done, sequence = shared(rest[:shard], sequence)
                    rest = rest[shard:]
                    yield done
        if whole:
            yield out(whole, list(range(sequence, sequence + len(whole))), [0] * len(whole))
            sequence += len(whole)
        if rest:
            yield shared(rest, sequence)[0]

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return plain.mapInArrow(packed, "doc_id long, start long, length long, ids binary, doc_tokens long, "
                                    "sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
