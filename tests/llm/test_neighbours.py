from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewpulse.llm import neighbours as N
from viewpulse.llm.queries import QUERIES

DDL = "vec_id long, embedding array<float>, score int, rank string, leaf int, shard int"


def brute(rows, asks, k=5):
    """Per query (position in ``rows``) its exact list."""
    good = [(at, i, np.array(v, np.float32).astype(float)) for at, (i, v) in enumerate(rows)
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for at, q, v in good:
        if asks(q):
            score = lambda w: float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum())))
            out[at] = [(q, r + 1, i, s) for r, (s, i) in enumerate(sorted(
                ((score(w), i) for n, i, w in good if n != at and len(w) == len(v)), key=lambda e: (-e[0], e[1]))[:k])]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "r", 2, 3) for i, v in rows], DDL).repartition(3)


def clustered(n, rng, dims=8):
    centres = rng.normal(0, 1, (12, dims))
    return [(i, [float(x) for x in centres[i % 12] + 0.3 * rng.normal(0, 1, dims)]) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_all_leaves_give_exact_results(spark, monkeypatch, small):
    if small:
        for name, value in (("SAMPLE", 150), ("BRANCHES", 3), ("LEAF", 6), ("SHARD", 20), ("QUERIES", 7), ("AT_ONCE", 4), ("CALIBRATED", 20)):
            monkeypatch.setattr(N, name, value)
    rng = np.random.default_rng(5)
    rows = clustered(300, rng)
    rows += [(300 + i, rows[i % 3][1]) for i in range(60)] + [(400 + i, [0.5] * 8) for i in range(50)] + [(7, rows[7][1])] * 2
    rows += [(i, [float(x) for x in rng.normal(0, 1, 3)]) for i in range(500, 520)] + [(600, [1.0, 2.0]), (602, [2.0])]
    rows += [(50, None), (100, []), (150, [None] * 8), (200, [float("nan")] * 8), (250, [float("inf")] + [0.0] * 7), (None, [1.0] * 8),
             (150, [0.0] * 8)]
    got = N.nearest(frame(spark, rows), F.col("vec_id") % 7 == 0, recall=1.0).collect()
    want = Counter(x for own in brute(rows, lambda i: i % 7 == 0).values() for x in own)
    hit = Counter(tuple(r) for r in got)
    assert sum(hit.values()) == sum(want.values())
    if small:  # calibrated on a part of the queries
        assert sum((hit & want).values()) >= 0.9 * sum(want.values())
    else:
        assert hit == want


def test_few_rows(spark):
    for rows in ([], [(0, [1.0])], [(0, [1.0]), (1, [-1.0]), (50, [0.001])], [(0, None)], [(0, [0.0]), (50, [1.0])]):
        got = Counter(tuple(r) for r in N.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0).collect())
        assert got == Counter(x for own in brute(rows, lambda i: i % 50 == 0).values() for x in own)


def test_tree_visits_every_leaf_once_nearest_first():
    rng = np.random.default_rng(2)
    x = N.unit(rng.normal(0, 1, (2000, 16)))
    tree = N.Tree(x)
    away = tree.away(x[:5])
    for line in away:
        order = tree.visits(line.tolist(), tree.n_leaves)
        assert sorted(order) == list(range(tree.n_leaves)) and order[:7] == tree.visits(line.tolist(), 7)
    leaf = tree.leaf_of(x)
    assert np.bincount(leaf, minlength=tree.n_leaves).max() <= 4 * N.LEAF
    first = [tree.visits(line.tolist(), 1)[0] for line in tree.away(x)]
    assert np.mean(np.array(first) == leaf) > 0.9  # the best bin is nearly always the own one
    assert N.Tree(np.ones((500, 4))).n_leaves == 1


def test_recall_on_the_sample_tables(spark):
    for size in ("0.01", "0.1"):
        sf = f"/root/testdata/sf{size}"
        rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
        want = Counter(x[:1] + x[2:3] for own in brute(rows, lambda i: i % 50 == 0).values() for x in own)
        got = QUERIES["op11_nearest_neighbours"](spark, sf).collect()
        assert sum((Counter((r.query_id, r.vec_id) for r in got) & want).values()) >= 0.9 * sum(want.values())
        at = dict(rows)
        for r in got:
            q, v = (np.array(at[i], np.float64) for i in (r.query_id, r.vec_id))
            assert abs(r.score - q @ v / np.sqrt((q @ q) * (v @ v))) < 1e-12
