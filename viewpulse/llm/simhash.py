"""SimHash fingerprints and their near-duplicate classes by bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.common import LAST_ID, fresh, same, ship, stored
from viewpulse.llm.components import components, merge

#: Bits of a fingerprint, words of a shingle, seed of its hash, most differing bits of a link.
BITS, SHINGLE, SEED, RADIUS = 64, 3, 42, 3
#: Fingerprints of one cell of a bucket: larger buckets are cut into this size and compared piece by piece.
CELL = 4096
#: (query, word of 64 lanes) pairs compared at a time, and bit planes between two looks at what can be abandoned.
STEP, LOOK = 1 << 17, 8
_ALL = np.uint64(2**64 - 1)


def fingerprint(text: bytes | None) -> int:
    """Unsigned fingerprint of a whole text; 0 for one without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    stops = ends[SHINGLE - 1:].tolist() or [len(line)]
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    counts, total = np.zeros(BITS, np.int64), len(stops)
    for k in range(0, total, 65536):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[k:k + 65536], stops[k:k + 65536])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("th"), pa.array(found.view(np.int64))],
                                         ["id", "th", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id``, ``th`` hash of the text, ``fp`` as signed long) of every row."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"),
                        F.col(text_col).cast("binary").alias("text"))
    return plain.mapInArrow(_fingerprints, "id long, th long, fp long")


def masks(radius: int = RADIUS) -> list[int]:
    """Bit masks, as signed longs: fingerprints within ``radius`` agree under at least one of them.

    The bits are cut into ``radius`` + 2 blocks; differing bits touch at most ``radius`` of them, so two blocks agree.
    """
    cuts = np.linspace(0, BITS, radius + 3).round().astype(int)
    blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:])]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(x | y) for x, y in combinations(blocks, 2)]


def close_lanes(fps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For rows sorted into groups (``starts``: first row of each): the first row of each row's class in its group.

    Bit planes are stored vertically: a word has one bit of 64 fingerprints of a group.  A row is compared with 64 others
    by 64 plane operations; two carry-save counter words and an overflow word hold all 64 distances, and pairs of row and
    word are abandoned once every lane has overflowed.  Links merge classes at once, so they are never gathered.
    """
    n = len(fps)
    sizes = np.diff(np.append(starts, n))
    words = -(-sizes // 64)
    base = np.cumsum(words) - words
    group = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(n) - starts[group]
    lane = base[group] * 64 + place
    padded = np.zeros(int(words.sum()) * 64, np.uint64)
    padded[lane] = fps
    there = np.zeros(len(padded), bool)
    there[lane] = True
    pack = lambda bits: np.packbits(bits, bitorder="little").view("<u8")
    planes = [pack((padded >> np.uint64(p) & np.uint64(1)).astype(bool)) for p in range(BITS)]
    valid = pack(there)
    row_of = np.zeros(len(padded), np.int64)
    row_of[lane] = np.arange(n)
    root = np.arange(n)
    visits = words[group] - place // 64  # words from a row's own to the last of its group
    ends = np.cumsum(visits)
    at = 0
    while at < n:
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, "right")))
        row = np.repeat(np.arange(at, upto), visits[at:upto])
        first = np.repeat(base[group[at:upto]] + place[at:upto] // 64, visits[at:upto])
        run = np.arange(len(row)) - np.repeat(ends[at:upto] - visits[at:upto] - (ends[at - 1] if at else 0), visits[at:upto])
        word = first + run
        own = run == 0
        later = np.where(own, ~np.uint64(1) << (place[row] % 64).astype(np.uint64), _ALL) & valid[word]  # lanes after the row
        one, two = np.zeros(len(row), np.uint64), np.zeros(len(row), np.uint64)
        over, value = ~later, fps[row]
        for p in range(BITS):
            if p % LOOK == 0:
                alive = over != _ALL
                if not alive.all():
                    row, word, one, two, over, value = (x[alive] for x in (row, word, one, two, over, value))
                if not len(row):
                    break
            differ = planes[p][word] ^ (np.uint64(0) - (value >> np.uint64(p) & np.uint64(1)))
            carry = one & differ
            one ^= differ
            over |= two & carry
            two ^= carry
        hit = np.flatnonzero(over != _ALL)
        for part in np.array_split(hit, max(1, len(hit) // 16384)):
            pair, bit = np.nonzero(np.unpackbits((~over[part]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            merge(root, row[part][pair], row_of[word[part][pair] * 64 + bit])
        at = upto
    return root


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell; a cell may go on in the next batch and is held back until it is whole."""
    held = np.zeros((0, 5), np.int64)

    def linked(rows: np.ndarray) -> pa.RecordBatch:
        new = np.append(True, (rows[1:, :4] != rows[:-1, :4]).any(1)) if len(rows) else np.zeros(0, bool)
        fps = np.ascontiguousarray(rows[:, 4])
        root = close_lanes(fps.view(np.uint64), np.flatnonzero(new))
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(fps[moved]), pa.array(fps[root[moved]])], ["a", "b"])

    for batch in batches:
        rows = np.column_stack([batch.column(i).to_numpy().astype(np.int64) for i in range(5)])
        rows = np.concatenate([held, rows]) if len(held) else rows
        if not len(rows):
            continue
        last = int(np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(1))[-1]) + 1 if (rows[0, :4] != rows[-1, :4]).any() else 0
        held = rows[last:]
        if last:
            yield linked(rows[:last])
    if len(held):
        yield linked(held)


def links(fps: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """Edges (``a``, ``b``) between distinct fingerprints ``fp`` with the components that all links of ``radius`` give.

    Every fingerprint goes to one bucket per mask of :func:`masks`.  Buckets of more than ``cell`` are cut by hash into
    pieces, and each two pieces meet in a cell of their own, so a bucket of any size is spread over many tasks.  A cell
    sends out one edge per linked fingerprint at most.
    """
    if radius != 3:
        raise ValueError("two counter words hold distances up to 3")
    tables = F.array(*[F.struct(F.lit(i).cast("byte").alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                       for i, m in enumerate(masks(radius))])
    keyed = fps.select("fp", F.explode(tables).alias("at")).select("at.table", "at.key", "fp")
    crowds = keyed.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1")
    pieces = F.ceil(F.col("n") / F.lit(float(cell))).cast("int")
    met = keyed.join(crowds, ["table", "key"]).withColumn("pieces", pieces)
    met = met.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    cells = met.select("table", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")
    names = ["table", "key", "low", "high"]
    return cells.repartition(*names).sortWithinPartitions(*names, "fp").mapInArrow(_links, "a long, b long").distinct()


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint and near-duplicate class of every row of ``docs``.

    A fingerprint bit is 1 if set in over half the hashes of a text's three-word shingles (A-Z lower-cased, repeats
    included; fewer words are one shingle).  Fingerprints that differ in at most three bits are linked; a class is a
    connected component, named by its smallest id.

    Returns ``id``, ``th`` (hash of the text), ``fp`` (signed long), ``class_id``, one row per row of ``docs``.  Null and
    empty texts have fingerprint 0 and are linked like any other.  Equal fingerprints are compared once.  Rows without an
    id belong to a class too; it has a null name where no member has an id.
    """
    ship(docs.sparkSession)
    known = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = stored(known.groupBy("fp").agg(F.min(F.coalesce("id", F.lit(LAST_ID))).alias("first")), "distinct-fp")
    star = components(links(distinct.select("fp")))
    rooted = distinct.join(star.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stored(rooted, "rooted-fp")
    names = rooted.groupBy("root").agg(F.min("first").alias("class_id"))
    named = rooted.select("fp", "root").join(names, "root").select(
        "fp", F.when(F.col("class_id") < LAST_ID, F.col("class_id")).alias("class_id"))
    return known.join(stored(named, "named-fp"), "fp").select("id", "th", "fp", "class_id")


def fingerprint_text(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each class the document with the smallest id (all its rows; rows without an id only where none has one)."""
    classes = simhash_classes(docs, id_col, text_col)
    chosen = classes.where(F.col("id").eqNullSafe(F.col("class_id"))).select(
        F.col("id").alias("_id"), F.col("th").alias("_th")).distinct()
    (own,) = fresh(docs, "_own")
    hashed = docs.withColumn(own, F.xxhash64(text_col))
    return hashed.join(chosen, same(hashed, chosen, (id_col, "_id"), (own, "_th")), "left_semi").drop(own)
