"""Exact top-k by inner product with a pivot-distance index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewpulse.llm.common import ship, stored

#: Vectors sampled for pivots and first bounds, pivots among them, rings of a pivot: they bound all that goes to tasks whole.
SAMPLE, PIVOTS, RINGS = 2048, 64, 64
#: Vectors of one piece of a ring, queries that meet it at a time, vectors between two looks at the bounds.
PIECE, QUERIES, SLAB = 4096, 8192, 512


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: in floats while these hold them, else in 64-bit integers."""
    most = (np.abs(q).max(initial=0) * np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if most < 2**53:
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long vectors as rows of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def lifted(x: np.ndarray, norms: np.ndarray, most: float) -> np.ndarray:
    """Vectors with one more component that brings all to the squared norm ``most``: near now means a large product."""
    return np.column_stack([x, np.sqrt(np.maximum(most - norms, 0))])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line the ``k`` highest scores, ties to the smaller id, then the smaller row."""
    order = np.lexsort((rows, ids, -scores), axis=1)[:, :k]
    return tuple(np.take_along_axis(x, order, 1) for x in (scores, ids, rows))


class Search:
    """The queries that meet one piece of a ring, against its vectors sorted by distance from the pivot."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, radius: np.ndarray, most: float, k: int):
        order = np.argsort(radius, kind="stable")
        self.x, self.ids, self.rows, self.radius, self.most, self.k = x[order], ids[order], rows[order], radius[order], most, k

    def top(self, q: np.ndarray, own: np.ndarray, to_pivot: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, ...]:
        """Best (score, id, row) per query; -1 as row where there is none.

        Slabs of the sorted vectors are taken from where the queries stand outwards; a query skips a slab that the
        triangle inequality puts beyond its k-th best distance so far.  ``floor``: a score that the k-th best reaches.
        """
        n, k, lowest = len(q), self.k, np.iinfo(np.int64).min + 1
        scores, ids, rows = np.full((n, k), lowest), np.zeros((n, k), np.int64), np.full((n, k), -1)
        norms = (q * q).sum(1)
        starts = np.arange(0, len(self.x), SLAB)
        low, high = self.radius[starts], self.radius[np.minimum(starts + SLAB, len(self.x)) - 1]
        middle = np.median(to_pivot)
        for s in np.argsort(np.maximum(low - middle, middle - high), kind="stable"):
            least = np.maximum(scores[:, -1].astype(np.float64), floor)
            reach = np.sqrt(np.maximum(norms + self.most - 2 * least, 0))
            gap = np.maximum(low[s] - to_pivot, to_pivot - high[s])
            near = np.flatnonzero(gap <= reach + 1e-6 * (1 + reach))
            if not len(near):
                continue
            part = slice(starts[s], starts[s] + SLAB)
            by_id = np.lexsort((self.rows[part], self.ids[part]))
            slab_ids, slab_rows = self.ids[part][by_id], self.rows[part][by_id]
            found = products(q[near], self.x[part][by_id])
            found[slab_rows[None] == own[near][:, None]] = lowest
            first = np.argsort(-found, axis=1, kind="stable")[:, :k]
            more = np.take_along_axis(found, first, 1)
            more_rows = np.where(more > lowest, slab_rows[first], -1)
            scores[near], ids[near], rows[near] = best(
                np.hstack([scores[near], more]), np.hstack([ids[near], slab_ids[first]]), np.hstack([rows[near], more_rows]), k)
        return scores, ids, rows


class Pivots:
    """The vectors of one length: their sample, pivots and rings.  Cells of all lengths are numbered through."""

    def __init__(self, number: int, sample: np.ndarray, norms: np.ndarray, rows: np.ndarray, most: float):
        self.rings, self.base, self.end = RINGS, number * PIVOTS * RINGS, (number + 1) * PIVOTS * RINGS
        self.sample, self.rows, self.most = sample, rows, most
        self.pivots = lifted(sample, norms, most)[:PIVOTS]
        self.width = max(2 * most**0.5, 1e-9) / RINGS

    def cells(self, x: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and distance from its pivot."""
        away = distances(lifted(x, norms, self.most), self.pivots)
        pivot = away.argmin(1)
        radius = away[np.arange(len(away)), pivot]
        ring = np.minimum(radius // self.width, self.rings - 1).astype(np.int64)
        return self.base + pivot * self.rings + ring, radius

    def reached(self, q: np.ndarray, own: np.ndarray, rings: "Rings", k: int) -> tuple[np.ndarray, ...]:
        """(query, cell, distance to its pivot, score that the k-th best reaches) for all rings within reach."""
        scores = products(q, self.sample).astype(np.float64)
        scores[own[:, None] == self.rows[None]] = -np.inf
        floor = np.sort(scores, 1)[:, -k] if len(self.sample) >= k else np.full(len(q), -np.inf)
        reach = np.sqrt(np.maximum((q * q).sum(1) + self.most - 2 * floor, 0))
        mine = slice(*np.searchsorted(rings.cells, [self.base, self.end]))
        away = distances(np.column_stack([q, np.zeros(len(q))]), self.pivots)[:, (rings.cells[mine] - self.base) // self.rings]
        gap = np.maximum(rings.low[mine][None] - away, away - rings.high[mine][None])
        which, cell = np.nonzero(gap <= (reach + 1e-6 * (1 + reach))[:, None])
        return which, rings.cells[mine][cell], away[which, cell], floor[which]


class Rings:
    """Least and greatest distance in every cell that has rows, in order of cells."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r["cell"])
        self.cells, self.low, self.high = (np.array([r[c] for r in rows]) for c in ("cell", "low", "high"))


def by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch with vectors ``v`` of one length at a time."""
    lengths = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        yield batch.take(pa.array(np.flatnonzero(lengths == length)))


def exact_top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
                scale: float = 256.0) -> DataFrame:
    """The ``k`` rows with the largest integer inner products for every query row, ties to the smaller id.

    Components become floor(scale * x).  Vectors are lifted to one norm, where the largest product is the smallest
    distance, and keyed by their nearest pivot and the ring of their distance from it.  A query first gets a bound from
    the sample, then goes to those rings that the triangle inequality leaves within reach, and there works outwards until
    the bound closes.  Every length of vectors has pivots of its own, and a query is answered among vectors of its length.
    Pivots, sample and the list of rings are bounded by constants per length; rings are cut into pieces of bounded size and
    the queries of a ring into blocks, so a crowded ring is spread over many tasks.  Every row is indexed; the sample only
    helps to leave rings out.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.  A row is compared with all rows of its length but itself;
    a repeated row is another candidate.  Vectors that are null, empty or hold null or non-finite components take no part,
    nor do rows without an id.  Products must stay below 2^63.  Other columns are not looked at, but ``is_query`` may use any.
    """
    spark = vectors.sparkSession
    ship(spark)
    raw = F.col(vec_col)
    whole = raw.isNotNull() & (F.size(raw) > 0) & F.forall(
        raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ints = F.transform(raw, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    table = vectors.where(whole & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), ints.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    table = table.withColumn("norm", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).withColumn(
        "row", F.monotonically_increasing_id())
    table = stored(table, "vectors")
    lengths = {r["n"]: float(r["most"]) for r in table.groupBy(F.size("v").alias("n")).agg(F.max("norm").alias("most")).collect()}
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    mixed = Window.partitionBy(F.size("v")).orderBy(F.xxhash64("id", "row"), "id", "row")
    chosen = table.withColumn("_n", F.row_number().over(mixed)).where(F.col("_n") <= max(PIVOTS, SAMPLE // len(lengths)))
    samples: dict[int, list] = {}
    for r in chosen.select("row", "v", "norm", "_n").collect():  # SAMPLE rows, or PIVOTS of each length
        samples.setdefault(len(r["v"]), []).append(r)
    index = {}
    for number, (length, own) in enumerate(sorted(samples.items())):
        own.sort(key=lambda r: r["_n"])
        index[length] = Pivots(number, np.array([r["v"] for r in own]), np.array([r["norm"] for r in own]),
                               np.array([r["row"] for r in own]), lengths[length])
    most_of = {of.base // (PIVOTS * RINGS): of.most for of in index.values()}

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_length(batch):
                x = matrix(part.column("v"))
                cell, radius = index[x.shape[1]].cells(x, part.column("norm").to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("id"), part.column("v"), pa.array(radius), pa.array(cell)],
                    ["row", "id", "v", "radius", "cell"])

    placed = stored(table.select("row", "id", "v", "norm").mapInArrow(
        keyed, "row long, id long, v array<double>, radius double, cell long"), "placed")
    sizes = stored(placed.groupBy("cell").agg(F.min("radius").alias("low"), F.max("radius").alias("high"),
                                              F.ceil(F.count("*") / F.lit(float(PIECE))).cast("long").alias("pieces")), "rings")
    rings = Rings(sizes.collect())  # at most PIVOTS * RINGS rows of a length

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for part in by_length(batch.slice(at, 256)):
                    q = matrix(part.column("v"))
                    which, cell, away, floor = index[q.shape[1]].reached(q, part.column("row").to_numpy(), rings, k)
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c).take(pa.array(which)) for c in ("row", "id", "v")), pa.array(away), pa.array(cell),
                         pa.array(floor)], ["row", "id", "v", "radius", "cell", "floor"])

    asked = stored(table.where("asks").select("row", "id", "v").mapInArrow(
        routed, "row long, id long, v array<double>, radius double, cell long, floor double"), "asked")
    met = asked.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(float(QUERIES))).cast("int").alias("blocks"))
    known = F.broadcast(sizes.join(met, "cell").select("cell", "pieces", "blocks"))  # a row per ring
    asking = asked.join(known, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"),
        F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("asks"), "row", "id", "v", "radius", "floor")
    against = placed.join(known, "cell").select(
        "cell", F.pmod(F.xxhash64("row"), F.col("pieces")).alias("piece"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("asks"), "row", "id", "v", "radius",
        F.lit(0.0).alias("floor"))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by piece and block, the vectors of a piece before its queries."""
        key, vectors, search = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in ("cell", "piece", "block", "asks")])
            cuts = [0, *(np.flatnonzero((kind[1:] != kind[:-1]).any(1)) + 1).tolist(), len(kind)]
            for lo, hi in zip(cuts, cuts[1:]):
                part = batch.slice(lo, hi - lo)
                if key != (now := tuple(kind[lo, :3])):
                    key, vectors, search = now, [], None
                found = [matrix(part.column("v")), *(part.column(c).to_numpy() for c in ("id", "row", "radius"))]
                if not kind[lo, 3]:
                    vectors.append(found)
                    continue
                if search is None:
                    if not vectors:
                        continue
                    search = Search(*(np.concatenate(x) for x in zip(*vectors, strict=True)), most_of[key[0] // (PIVOTS * RINGS)], k)
                q, ids, rows, away = found
                scores, near, near_rows = search.top(q, rows, away, part.column("floor").to_numpy())
                line, place = np.nonzero(near_rows >= 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (rows[line], ids[line], scores[line, place], near[line, place], near_rows[line, place])],
                    ["query_row", "query_id", "score", "vec_id", "vec_row"])

    names = ["cell", "piece", "block"]
    together = asking.unionByName(against).repartition(*names).sortWithinPartitions(*names, "asks")
    near = together.mapInArrow(searched, "query_row long, query_id long, score long, vec_id long, vec_row long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
