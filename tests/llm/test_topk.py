from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewpulse.llm import topk

DDL = "vec_id long, embedding array<float>, score int, rank string, row int, cell int"


def brute(rows, asks, k=5):
    usable = [(i, np.floor(256.0 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for at, (q, v) in enumerate(usable):
        if asks(q):
            best = sorted((-int(v @ w), i) for n, (i, w) in enumerate(usable)
                          if n != at and len(w) == len(v))[:k]
            out.update((q, r + 1, i, -s) for r, (s, i) in enumerate(best))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "r", 2, 3) for i, v in rows], DDL).repartition(3)


def got(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # many pieces, blocks and slabs
        for name, value in (("SAMPLE", 40), ("PIVOTS", 3), ("RINGS", 4), ("PIECE", 30), ("QUERIES", 5), ("SLAB", 7)):
            monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 6) * rng.choice([0.1, 1, 5])]) for i in range(300)]
    rows += [(300 + i, rows[i % 4][1]) for i in range(60)] + [(400 + i, [0.5] * 6) for i in range(40)] + [(7, rows[7][1])]
    rows += [(50, None), (100, []), (150, [None] * 6), (200, [float("nan")] * 6), (250, [float("inf")] + [0.0] * 5), (None, [1.0] * 6),
             (448, [1.0, 2.0])]
    rows += [(i, [float(x) for x in rng.normal(0, 1, 3)]) for i in range(500, 560)] + [(560, [2.0]), (567, [1.0])]
    assert got(topk.exact_top_k(frame(spark, rows), F.col("vec_id") % 7 == 0)) == brute(rows, lambda i: i % 7 == 0)


def test_few_rows(spark):
    for rows in ([], [(0, [1.0])], [(0, [1.0]), (1, [-1.0]), (50, [0.001])], [(0, None)]):
        assert got(topk.exact_top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)) == (
            brute(rows, lambda i: i % 50 == 0) if any(v for _, v in rows) else Counter())


def test_large_components(spark):
    rows = [(i, [float(x) for x in np.random.default_rng(i).integers(-4_000_000, 4_000_000, 5)]) for i in range(60)]
    assert got(topk.exact_top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)) == brute(rows, lambda i: i % 50 == 0)
