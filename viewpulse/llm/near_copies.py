"""Near copies by the Jaccard similarity of word shingles.

SimHash fingerprints are compared as :mod:`simhash` does it, MinHash bands find the pairs that differ in more bits, and of both
the shingles themselves decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewpulse.llm.common import LAST_ID, fresh, same, ship, stored
from viewpulse.llm.components import components
from viewpulse.llm.simhash import BITS, links

#: Words of a shingle, least similarity of a link.
SHINGLE, SIMILAR = 5, Fraction(4, 5)
#: Bands and MinHash values of a band.  A pair at 0.8 agrees in no band with probability (1 - 0.8 ** 4) ** 32 < 1e-7.
BANDS, VALUES = 32, 4
#: Values of 128 in which a pair has to agree to be compared by its shingles; at 0.8 fewer have a probability of about 1e-5.
AGREE = 83
#: Rows of one cell of a bucket: larger buckets are cut into this size and compared piece by piece.
CELL = 1024
_NUMBERS = np.random.default_rng(42).integers(0, 1 << 63, (2, BANDS * VALUES), np.uint64)
_TIMES, _PLUS = _NUMBERS[0] << np.uint64(1) | np.uint64(1), _NUMBERS[1] << np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles (A-Z lower-cased); fewer words are one shingle, no words none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    stops = ends[SHINGLE - 1:].tolist() or [len(line)]
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[a:b]) for a, b in zip(starts, stops)], np.uint64))


def least_values(hashes: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty set."""
    least = np.full(BANDS * VALUES, 2**64 - 1, np.uint64)
    for k in range(0, len(hashes), 4096):
        np.minimum(least, (hashes[k:k + 4096, None] * _TIMES + _PLUS).min(0), out=least)
    return least


def fingerprint(hashes: np.ndarray) -> int:
    """SimHash of a set: a bit is 1 if set in over half the hashes."""
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[k:k + 65536].astype("<u8").view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets of shingles reach :data:`SIMILAR`."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both * SIMILAR.denominator >= SIMILAR.numerator * (len(x) + len(y) - both)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, h1, h2, fp, bands, sketch = [], [], [], [], [], []
        for text in batch.column("text"):
            own = shingles(text.as_py())
            whole = xxhash.xxh3_128_digest(own.tobytes())
            n.append(len(own))
            h1.append(int.from_bytes(whole[:8], "little", signed=True))
            h2.append(int.from_bytes(whole[8:], "little", signed=True))
            fp.append(fingerprint(own))
            least = least_values(own) if len(own) else np.zeros(0, np.uint64)
            keys = np.zeros(len(least) // VALUES, np.uint64)
            for k in range(VALUES):
                keys = (keys ^ least[k::VALUES]) * _MIX
                keys ^= keys >> np.uint64(29)
            bands.append(keys.view(np.int64))
            sketch.append((least >> np.uint64(16)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
             pa.array(fp, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
            ["id", "th", "n", "h1", "h2", "fp", "bands", "sketch"])


_CELL = ["table", "key", "low", "high"]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Cells one by one.  Rows come sorted by cell; a cell may go on in the next batch and is held back until it is whole."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = pa.concat_tables([*([held] if held else []), pa.Table.from_batches([batch])])
        at = np.column_stack([held[name].to_numpy().astype(np.int64) for name in _CELL])
        cuts = np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1
        for low, high in zip([0, *cuts.tolist()], cuts.tolist()):
            yield held.slice(low, high - low)
        if len(cuts):
            held = held.slice(int(cuts[-1]))
    if held:
        yield held


def _fitting(cell: pa.Table, root: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For rows of a cell the others to compare them with: of another ``root``, and alike by size and MinHash values.  Two that
    share the bucket of an earlier table meet there."""
    own, node, n = (cell[name].to_numpy() for name in ("own", "node", "n"))
    table, _, first, second = (cell[name][0].as_py() for name in _CELL)
    mark = np.frombuffer(b"".join(cell["sketch"].to_pylist()), np.uint8).reshape(len(cell), -1)
    keys = cell["bands"].combine_chunks().flatten().to_numpy().reshape(len(cell), -1)[:, :table]
    for i in range(len(cell)):
        # two pieces meet in a cell of their own; a piece is compared with itself where it is both
        other = np.flatnonzero((node > node[i]) if first == second else (own != own[i]) & (own[i] == first))
        other = other[root[other] != root[i]]
        small, large = np.minimum(n[other], n[i]), np.maximum(n[other], n[i])
        other = other[small * SIMILAR.denominator >= large * SIMILAR.numerator]
        other = other[(mark[other] == mark[i]).sum(1) >= AGREE]
        other = other[~(keys[other] == keys[i]).any(1)]
        if len(other):
            yield i, other


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of cells that are compared with another one."""
    for cell in _whole(batches):
        wanted = np.zeros(len(cell), bool)
        for i, other in _fitting(cell, cell["root"].to_numpy()):
            wanted[i] = wanted[other] = True
        yield from cell.filter(pa.array(wanted)).to_batches()


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between rows of a cell whose shingles are alike; what an edge joins is not compared again in its cell."""
    known = lru_cache(4096)(lambda text: shingles(text))
    for cell in _whole(batches):
        node, root, text = cell["node"].to_numpy(), cell["root"].to_numpy().copy(), cell["text"]
        found = []
        for i, other in _fitting(cell, root):
            own = known(text[i].as_py())
            for j in other.tolist():
                if root[i] != root[j] and alike(own, known(text[j].as_py())):
                    root[root == root[j]] = root[i]
                    found.append((min(node[i], node[j]), max(node[i], node[j])))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(ends, pa.int64()) for ends in zip(*found, strict=True)], ["a", "b"])


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = lru_cache(4096)(lambda text: shingles(text))
    for batch in batches:
        kept = [alike(known(x.as_py()), known(y.as_py())) for x, y in zip(batch.column("x"), batch.column("y"))]
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def close_fingerprints(nodes: DataFrame) -> DataFrame:
    """Edges (``a``, ``b``) between ``nodes`` whose fingerprints are close; one node stands for those of one fingerprint."""
    each = stored(nodes.groupBy("fp").agg(F.min("node").alias("lead")), "fingerprint-leads")
    equal = nodes.select("node", "fp").join(each, "fp").where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    end = lambda name: each.select(F.col("fp").alias(name), F.col("lead").alias(f"_{name}"))
    near = links(each.select("fp")).join(end("a"), "a").join(end("b"), "b").select("_a", "_b")
    return equal.unionByName(near.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")))


def near_links(nodes: DataFrame, texts_of, cell: int = CELL) -> DataFrame:
    """Edges (``a``, ``b``) between ``nodes`` with the components that all pairs of :data:`SIMILAR` give.

    Fingerprints that differ in few bits are linked first.  Rows of a bucket are compared with one neighbour each, in another
    order for every band: that joins large groups of near copies by few comparisons.  Every pair of a bucket that is not in
    one component by then is compared where its bucket lies: the rows of a large group move, never its pairs.
    """
    keyed = nodes.select("node", "n", F.posexplode("bands").alias("table", "key"))
    crowds = keyed.groupBy("table", "key").agg(F.count("*").alias("rows")).where("rows > 1")
    met = stored(keyed.join(crowds, ["table", "key"]), "bands")
    pieces = F.ceil(F.col("rows") / F.lit(float(cell))).cast("int")
    own = F.pmod(F.xxhash64("node", "table"), pieces).cast("int")
    order = Window.partitionBy("table", "key", "own").orderBy(F.xxhash64("table", "node"), "node")
    beside = met.withColumn("own", own).select("node", "n", F.lead("node").over(order).alias("next"),
                                               F.lead("n").over(order).alias("next_n"))
    fits = F.least("n", "next_n") * SIMILAR.denominator >= F.greatest("n", "next_n") * SIMILAR.numerator
    chained = beside.where(fits).select(F.least("node", "next").alias("a"), F.greatest("node", "next").alias("b"))
    first = chained.unionByName(close_fingerprints(nodes)).distinct()
    sure = stored(decided(stored(first, "beside"), texts_of), "beside-links")
    star = stored(components(sure), "beside-roots")
    rooted = stored(met.join(star, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted-bands")
    mixed = rooted.groupBy("table", "key").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low <> _high")
    apart = rooted.join(mixed, ["table", "key"]).join(nodes.select("node", "sketch", "bands"), "node").withColumn("own", own)
    apart = apart.withColumn("other", F.explode(F.sequence(F.lit(0), pieces - 1)))
    cells = apart.select("table", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                         "own", "node", "root", "n", "sketch", "bands")
    met_in = lambda rows: rows.repartition(*_CELL).sortWithinPartitions(*_CELL)
    compared = stored(met_in(cells).mapInArrow(_compared, cells.schema), "apart")
    texts = stored(texts_of(compared.select("node").distinct()), "compared-texts")
    rest = met_in(compared.join(texts.select("node", "text"), "node")).mapInArrow(_linked, "a long, b long")
    return sure.unionByName(rest)


def decided(pairs: DataFrame, texts_of) -> DataFrame:
    """The ``pairs`` whose shingles are alike."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = stored(texts_of(ends), "compared-texts")
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(_decided, "a long, b long")


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each class of near copies the document with the smallest id (all its rows; rows without an id only where none
    has one).

    Documents are linked whose sets of five-word shingles have a Jaccard similarity of 0.8 or more; a class is a connected
    component.  Documents with equal sets count once; those without words, null texts among them, are one class.  Texts
    of any length are read whole.  Rows equal in id and text stay or go together; columns of ``docs``, whatever their
    names, stay as they are.  An empty table gives an empty one.
    """
    ship(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"),
                        F.col(text_col).cast("binary").alias("text"))
    known = stored(plain.mapInArrow(
        _sketches, "id long, th long, n long, h1 long, h2 long, fp long, bands array<long>, sketch binary"), "sketches")
    nodes = stored(known.groupBy("h1", "h2").agg(
        F.min(F.struct(F.coalesce("id", F.lit(LAST_ID)).alias("id"), "th")).alias("least"), F.first("n").alias("n"),
        F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")).withColumn(
        "node", F.monotonically_increasing_id()), "distinct-sketches")

    def texts_of(ends: DataFrame) -> DataFrame:
        wanted = nodes.join(ends, "node").select("node", F.col("least.id").alias("id"), F.col("least.th").alias("th"))
        found = plain.withColumn("id", F.coalesce("id", F.lit(LAST_ID)))
        return wanted.join(found, ["id", "th"]).groupBy("node").agg(F.max("text").alias("text"))

    star = components(near_links(nodes.where("n > 0"), texts_of))
    rooted = stored(nodes.select("node", "h1", "h2", F.col("least.id").alias("first")).join(star, "node", "left").withColumn(
        "root", F.coalesce("root", "node")), "rooted-sketches")
    names = rooted.groupBy("root").agg(F.min("first").alias("class_id"))
    named = rooted.join(names, "root").where("first = class_id").select(
        "h1", "h2", F.col("class_id").alias("class_id"))
    chosen = known.join(named, ["h1", "h2"]).where(F.coalesce("id", F.lit(LAST_ID)) == F.col("class_id")).select(
        F.col("id").alias("_id"), F.col("th").alias("_th")).distinct()
    (own,) = fresh(docs, "_own")
    hashed = docs.withColumn(own, F.xxhash64(text_col))
    return hashed.join(chosen, same(hashed, chosen, (id_col, "_id"), (own, "_th")), "left_semi").drop(own)
