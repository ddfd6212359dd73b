"""Approximate nearest neighbours by cosine: a tree of k-means, searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewpulse.llm.common import ship, stored

#: Vectors of one length that a tree is fitted on, children of a node, sampled vectors of a leaf, rounds of k-means.
SAMPLE, BRANCHES, LEAF, ROUNDS = 32_768, 16, 64, 8
#: Queries on which the number of visited leaves is calibrated, and the share of their true neighbours to be reached.
CALIBRATED, RECALL = 256, 0.95
#: Vectors of one shard (bound in expectation), queries of one task beside a shard, queries multiplied at a time.
SHARD, QUERIES, AT_ONCE = 8192, 16_384, 256
#: Scores of a matrix product may be off by this; what may count is scored again, row by row.
SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows; equal pairs get equal results wherever they stand."""
    return (q * x).sum(1) / (np.sqrt((q * q).sum(1)) * np.sqrt((x * x).sum(1)))


def vectors_of(column: pa.Array) -> list[np.ndarray]:
    """The rows of a list column, as rows of one matrix where they are equally long."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.split(flat, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))[:-1]) if len(column) else []


def means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Group number of each row after some rounds of k-means (centres drawn by squared distance)."""
    centres = x[rng.integers(len(x))][None]
    away = ((x - centres[0]) ** 2).sum(1)
    while len(centres) < k and away.max() > 1e-12:
        centres = np.vstack([centres, x[rng.choice(len(x), p=away / away.sum())]])
        away = np.minimum(away, ((x - centres[-1]) ** 2).sum(1))
    group = np.zeros(len(x), np.int64)
    for _ in range(ROUNDS):
        group = ((centres * centres).sum(1)[None] - 2 * x @ centres.T).argmin(1)
        centres = np.stack([x[group == g].mean(0) if (group == g).any() else centres[g] for g in range(len(centres))])
    return ((centres * centres).sum(1)[None] - 2 * x @ centres.T).argmin(1)


class Tree:
    """Nodes in the order of a walk in depth; leaves are numbered in that order, so near leaves have near numbers."""

    def __init__(self, sample: np.ndarray, seed: int = 1):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.n_leaves = 0
        self._grow(unit(sample), np.random.default_rng(seed))
        self.matrix = np.stack(self.centres)
        self.squares = (self.matrix * self.matrix).sum(1)

    def _grow(self, x: np.ndarray, rng: np.random.Generator) -> int:
        node = len(self.centres)
        self.centres.append(x.mean(0))
        self.children.append([])
        self.leaf.append(-1)
        group = means(x, BRANCHES, rng) if len(x) > LEAF else np.zeros(len(x), np.int64)
        own = np.unique(group)
        if len(own) < 2:  # few vectors, or all alike
            self.leaf[node], self.n_leaves = self.n_leaves, self.n_leaves + 1
        else:
            self.children[node] = [self._grow(x[group == g], rng) for g in own]
        return node

    def away(self, x: np.ndarray) -> np.ndarray:
        """Squared distance of unit vectors to the centre of every node."""
        return 1 + self.squares[None] - 2 * x @ self.matrix.T

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each unit vector comes to by the nearest child of every node."""
        away, node = self.away(x), np.zeros(len(x), np.int64)
        for at, below in enumerate(self.children):  # parents come before their children
            if below and len(here := np.flatnonzero(node == at)):
                node[here] = np.array(below)[away[np.ix_(here, below)].argmin(1)]
        return np.array(self.leaf)[node]

    def visits(self, away: list[float], n: int) -> list[int]:
        """The first ``n`` leaves for a query with the given distances: always on from the nearest node seen so far."""
        queue, found = [(away[0], 0)], []
        while queue and len(found) < n:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                found.append(self.leaf[node])
            for child in self.children[node]:
                heapq.heappush(queue, (away[child], child))
        return found


class Forest:
    """A tree per length of vectors; a length outside the sample is one leaf.  Leaves are numbered through."""

    def __init__(self, samples: dict[int, np.ndarray], lengths: list[int]):
        self.trees: dict[int, Tree | None] = {}
        self.base: dict[int, int] = {}
        self.n_leaves = 0
        for length in lengths:
            tree = self.trees[length] = Tree(samples[length]) if length in samples else None
            self.base[length] = self.n_leaves
            self.n_leaves += tree.n_leaves if tree else 1

    def leaf_of(self, rows: list[np.ndarray]) -> np.ndarray:
        found = np.zeros(len(rows), np.int64)
        sizes = np.array([len(r) for r in rows])
        for length in np.unique(sizes):
            own = np.flatnonzero(sizes == length)
            tree = self.trees[length]
            found[own] = self.base[length]
            if tree:
                found[own] += tree.leaf_of(unit(np.stack([rows[i] for i in own])))
        return found

    def visits(self, row: np.ndarray, n: int | None = None) -> list[int]:
        tree, base = self.trees[len(row)], self.base[len(row)]
        if tree is None:
            return [base]
        away = tree.away(unit(row[None]))[0].tolist()
        return [base + leaf for leaf in tree.visits(away, n or tree.n_leaves)]


def top(score: np.ndarray, vec: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((row, vec, -score))[:k]


def best_of(q: np.ndarray, own: int, x: np.ndarray, rough: np.ndarray, ids: list, rows: list, k: int) -> list[tuple]:
    """(score, id, row) of the ``k`` nearest rows for one query, from rough scores of distinct vectors (-inf: not asked)."""
    usable = rough > -np.inf
    if not usable.any():
        return []
    m = min(k + 1, int(usable.sum()))  # one of the vectors may have no row but the query's own
    least = np.partition(rough, len(rough) - m)[len(rough) - m]
    near = np.flatnonzero(usable & (rough >= least - SLACK))
    exact = cosines(np.broadcast_to(q, (len(near), len(q))), x[near])
    score = np.repeat(exact, [len(ids[i]) for i in near])
    vec, row = (np.concatenate([own_of[i] for i in near]) for own_of in (ids, rows))
    other = row != own
    score, vec, row = score[other], vec[other], row[other]
    return [(float(score[i]), int(vec[i]), int(row[i])) for i in top(score, vec, row, k)]


def usable(vectors: DataFrame, is_query: Column, id_col: str, vec_col: str) -> DataFrame:
    """(``row``, ``id``, ``v``, ``asks``) of rows with an id and a finite vector that is not zero."""
    raw = F.col(vec_col)
    whole = raw.isNotNull() & F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        raw, lambda x: x != 0)
    return vectors.where(whole & F.col(id_col).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        F.transform(raw, lambda x: x.cast("double")).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(``v``, ``ids``, ``rows``): every different vector once, with the ``k`` + 1 rows of it that come first by id.

    No result can hold a later row of it, so copies in any number change nothing.  The rank limit works before the shuffle too.
    """
    keyed = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit("second"), "v")})
    first = Window.partitionBy("h1", "h2").orderBy("id", "row")
    few = keyed.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
    packed = few.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("id", "row"))).alias("own"), F.first("v").alias("v"))
    return packed.select("v", F.transform("own", lambda e: e["id"]).alias("ids"), F.transform("own", lambda e: e["row"]).alias("rows"))


def _results(found: list[tuple]) -> pa.RecordBatch:
    kinds = {"query_row": pa.int64(), "query_id": pa.int64(), "score": pa.float64(), "vec_id": pa.int64(), "vec_row": pa.int64(),
             "leaf": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], kind) for i, kind in enumerate(kinds.values())], list(kinds))


_RESULT = "query_row long, query_id long, score double, vec_id long, vec_row long, leaf long"


def _nearest_rows(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def true_neighbours(placed: DataFrame, asked: list[tuple[int, int, np.ndarray]], k: int) -> DataFrame:
    """The ``k`` nearest of all rows for a bounded list of queries (row, id, vector), with their leaves: every task goes through its rows."""
    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = vectors_of(batch.column("v"))
            sizes = np.array([len(r) for r in rows])
            ids, own = batch.column("ids").to_pylist(), batch.column("rows").to_pylist()
            leaf = batch.column("leaf").to_numpy()
            out = []
            for length in np.unique(sizes):
                at = np.flatnonzero(sizes == length)
                x = np.stack([rows[i] for i in at])
                of_row = {r: leaf[i] for i in at for r in own[i]}
                asking = [a for a in asked if len(a[2]) == length]
                if asking:
                    rough = unit(np.stack([a[2] for a in asking])) @ unit(x).T
                    for (row, id_, q), line in zip(asking, rough, strict=True):
                        out += [(row, id_, s, v, r, of_row[r]) for s, v, r in best_of(
                            q, row, x, line, [ids[i] for i in at], [own[i] for i in at], k)]
            yield _results(out)
    return _nearest_rows(placed.mapInArrow(scanned, _RESULT), k)


def calibrated_visits(forest: Forest, asked: list[tuple[int, int, np.ndarray]], true: DataFrame, recall: float) -> int:
    """Leaves to visit: the visits are widened until the share ``recall`` of the true neighbours lies in them."""
    wanted: dict[int, list[int]] = {}
    for r in true.select("query_row", "leaf").collect():  # at most k rows for each of the bounded queries
        wanted.setdefault(r["query_row"], []).append(r["leaf"])
    ranks = []
    for row, _, q in asked:
        order = {leaf: i for i, leaf in enumerate(forest.visits(q))}
        ranks += [order[leaf] for leaf in wanted.get(row, ())]
    visits = 1
    while ranks and np.mean(np.array(ranks) < visits) < recall:
        visits += max(1, visits // 16)
    return visits


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
            recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest rows by cosine for every query row, nearly always: ties to the smaller id.

    Trees of k-means (one per length of vectors) are fitted on at most :data:`SAMPLE` vectors of a length; every row is
    indexed.  A query visits leaves best bin first.  How many is settled on at most :data:`CALIBRATED` queries, whose true
    neighbours are found among all rows: visits are widened until the share ``recall`` of these is reached.  Neighbouring
    leaves share a shard of bounded size, a leaf beyond it is dealt over several; a query travels once to every shard it
    visits, with the list of its leaves there, and shards with many queries are searched in several tasks.  Scores are exact,
    in doubles.  Trees and tables of leaves are bounded by the sample.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.  A row is compared with all rows of its length but itself; a
    repeated row is another candidate.  Vectors that are null, empty, zero or hold null or non-finite components take no part, nor
    do rows without an id.  Fewer candidates give fewer rows.  Other columns are not looked at, but ``is_query`` may use any.
    """
    spark = vectors.sparkSession
    ship(spark)
    table = stored(usable(vectors, is_query, id_col, vec_col), "neighbour-rows")
    lengths = sorted(r["n"] for r in table.select(F.size("v").alias("n")).distinct().collect())  # no more than lengths
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    mixed = Window.partitionBy(F.size("v")).orderBy(F.xxhash64("id", "row"), "row")
    chosen = table.withColumn("_n", F.row_number().over(mixed)).where(F.col("_n") <= max(1, SAMPLE // len(lengths))).select("v")
    samples: dict[int, list] = {}
    for r in chosen.collect():  # SAMPLE rows at most, or one per length
        samples.setdefault(len(r["v"]), []).append(r["v"])
    forest = Forest({n: np.array(v) for n, v in samples.items()}, lengths)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = forest.leaf_of(vectors_of(batch.column("v")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], [*batch.schema.names, "leaf"])

    placed = stored(distinct_vectors(table, k).mapInArrow(keyed, "v array<double>, ids array<long>, rows array<long>, leaf long"),
                    "neighbour-leaves")
    few = table.where("asks").orderBy(F.xxhash64("id", "row"), "row").limit(CALIBRATED).collect()  # bounded
    asked = [(r["row"], r["id"], np.array(r["v"])) for r in few]
    visits = calibrated_visits(forest, asked, true_neighbours(placed, asked, k), recall)

    size = np.zeros(forest.n_leaves, np.int64)
    for r in placed.groupBy("leaf").count().collect():  # a row per leaf
        size[r["leaf"]] = r["count"]
    pieces = np.maximum(-(-size // SHARD), 1)
    shard, now, room = np.zeros(len(size), np.int64), -1, 0
    for leaf, n in enumerate(size):  # neighbouring leaves together
        if n > room or pieces[leaf] > 1:
            now, room = now + 1, SHARD
        shard[leaf], room = now, room - n if pieces[leaf] == 1 else 0
        now += int(pieces[leaf]) - 1

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            took, where, leaves = [], [], []
            for i, q in enumerate(vectors_of(batch.column("v"))):
                to: dict[int, list[int]] = {}
                for leaf in forest.visits(q, visits):
                    for piece in range(pieces[leaf]):
                        to.setdefault(int(shard[leaf]) + piece, []).append(leaf)
                took += [i] * len(to)
                where += to.keys()
                leaves += to.values()
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(took, pa.int64())) for c in ("row", "id", "v")),
                                              pa.array(where, pa.int64()), pa.array(leaves, pa.list_(pa.int64()))],
                                             ["row", "id", "v", "shard", "leaves"])

    asking = stored(table.where("asks").select("row", "id", "v").mapInArrow(
        routed, "row long, id long, v array<double>, shard long, leaves array<long>"), "neighbour-queries")
    blocks = asking.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(float(QUERIES))).cast("int").alias("blocks"))
    none = lambda kind: F.lit(None).cast(kind)
    places = spark.createDataFrame(list(zip(range(len(size)), shard.tolist(), pieces.tolist(), strict=True)),
                                   "leaf long, _shard long, _pieces long")  # a row per leaf
    held = placed.join(F.broadcast(places), "leaf").withColumn(
        "shard", F.col("_shard") + F.pmod(F.xxhash64("rows"), F.col("_pieces")))
    held = held.join(blocks, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("asks"), "v", "ids", "rows", "leaf",
        none("long").alias("row"), none("long").alias("id"), none("array<long>").alias("leaves"))
    asking = asking.join(blocks, "shard").select(
        "shard", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("asks"), "v",
        none("array<long>").alias("ids"), none("array<long>").alias("rows"), none("long").alias("leaf"), "row", "id", "leaves")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard and block, the vectors before the queries; lengths may be mixed in a shard."""
        key, held, by_length = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in ("shard", "block", "asks")])
            cuts = [0, *(np.flatnonzero((kind[1:] != kind[:-1]).any(1)) + 1).tolist(), len(kind)]
            for lo, hi in zip(cuts, cuts[1:]):
                part = batch.slice(lo, hi - lo)
                if key != (now := tuple(kind[lo, :2])):
                    key, held, by_length = now, [], None
                rows = vectors_of(part.column("v"))
                if not kind[lo, 2]:
                    held += zip(rows, part.column("ids").to_pylist(), part.column("rows").to_pylist(),
                                part.column("leaf").to_pylist(), strict=True)
                    continue
                if by_length is None:
                    by_length = {n: [h for h in held if len(h[0]) == n] for n in {len(h[0]) for h in held}}
                    by_length = {n: (np.stack([h[0] for h in own]), *([h[i] for h in own] for i in (1, 2)),
                                     np.array([h[3] for h in own])) for n, own in by_length.items()}
                sizes = np.array([len(r) for r in rows])
                q_row, q_id, leaves = (part.column(c).to_pylist() for c in ("row", "id", "leaves"))
                for n, (x, ids, x_rows, leaf) in by_length.items():
                    own = np.flatnonzero(sizes == n)
                    for at in range(0, len(own), AT_ONCE):
                        some = own[at:at + AT_ONCE]
                        rough = unit(np.stack([rows[i] for i in some])) @ unit(x).T
                        out = []
                        for i, line in zip(some, rough, strict=True):
                            line[~np.isin(leaf, leaves[i])] = -np.inf
                            out += [(q_row[i], q_id[i], *found, 0) for found in best_of(rows[i], q_row[i], x, line, ids, x_rows, k)]
                        yield _results(out)

    names = ["shard", "block"]
    met = asking.unionByName(held).repartition(*names).sortWithinPartitions(*names, "asks")
    return _nearest_rows(met.mapInArrow(searched, _RESULT), k).select("query_id", "rank", "vec_id", "score")
