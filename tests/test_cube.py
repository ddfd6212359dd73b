"""Roll-ups against brute force in plain Python, and their plans."""

from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalog.queries import QUERIES
from viewpulse.model import D5
from viewpulse.operators import cube as C

DIMS = ("a", "b", "c")
DDL = "t string, a string, b string, c string, id string, v bigint"

data = st.lists(st.tuples(st.sampled_from(["t1", "t2"]), st.sampled_from(["x", "y", None, ""]),
                          st.sampled_from(["p", "q"]), st.sampled_from(["m", "n"]),
                          st.sampled_from(["i1", "i2", "i3", None]), st.integers(0, 9)), max_size=25)
slow = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute(records, pick, fixed=True):
    cells = {}
    for t, a, b, c, i, v in records:
        dims = (a or "", b, c)
        for n in range(4):
            for kept in combinations(range(3), n):
                key = tuple(d if k in kept else "ALL" for k, d in enumerate(dims))
                cells.setdefault(((t,) if fixed else ()) + key, []).append((i, v))
    out = {k: pick(rows) for k, rows in cells.items()}
    return {k: n for k, n in out.items() if n is not None}


def got(frame, n=4):
    return {tuple(r[:n]): r[n] for r in frame.collect()}


@slow
@given(records=data)
def test_sum_cube(spark, records):
    frame = spark.createDataFrame(records, DDL)
    want = brute(records, lambda rows: sum(v for _, v in rows))
    measure = {"v": ("sum", F.col("v"))}
    assert got(C.cube_all(frame, DIMS, measure, ("t",))) == want
    assert got(C.cube_all(frame, DIMS, measure, ("t",), lattice=True)) == want
    whole = brute(records, lambda rows: sum(v for _, v in rows), False)
    assert got(C.cube_all(frame, DIMS, measure), 3) == got(C.cube_all(frame, DIMS, measure, lattice=True), 3) == whole
    assert got(C.cube_all(frame, DIMS, measure, ("t",), pre_aggregate=False)) == want


@slow
@given(records=data)
def test_exact_distinct(spark, records):
    frame = spark.createDataFrame(records, DDL)
    want = brute(records, lambda rows: len({i for i, _ in rows if i}) or None)
    assert got(C.exact_distinct_cube(frame, DIMS, "n", "id", ("t",))) == want
    both = C.exact_distinct_cube(frame, DIMS, "n", "id", ("t",), {"v": ("sum", F.col("v"))})
    assert got(both) == want
    sums = brute([r for r in records if r[4]], lambda rows: sum(v for _, v in rows))
    assert {tuple(r[:4]): r["v"] for r in both.collect()} == sums
    additive = got(C.additive_distinct_cube(frame, DIMS, {"n": "id"}, ("t",)))
    assert set(additive) == set(want) and all(additive[k] >= n for k, n in want.items())


def test_grand_total_once_and_empty(rows):
    frame = rows(DDL, [("t1", "x", "p", "m", "i", 2), ("t1", "y", "p", "m", "i", 3)])
    total = C.cube_all(frame, DIMS, {"v": ("sum", F.col("v"))}).where("a = 'ALL' and b = 'ALL' and c = 'ALL'")
    assert [r.v for r in total.collect()] == [5]
    assert C.cube_all(frame.where("false"), DIMS, {"v": ("sum", F.col("v"))}).count() == 0
    assert C.exact_distinct_cube(frame.where("false"), DIMS, "n", "id").count() == 0


def test_dense_counts(rows):
    frame = rows("a string, k string", [("x", "1"), ("x", "1"), ("y", "9")])
    got = {tuple(r) for r in C.dense_counts(frame, ("a",), "k", ("1", "2"), "n").collect()}
    assert got == {("x", "1", 2), ("x", "2", 0), ("y", "1", 0), ("y", "2", 0), ("ALL", "1", 2), ("ALL", "2", 0),
                   ("y", "9", 1), ("ALL", "9", 1)}


def test_sketch_close_to_exact(rows):
    frame = rows("a string, id string", [(str(i % 3), f"i{i}") for i in range(3000)])
    exact = {r.a: r.n for r in C.exact_distinct_cube(frame, ("a",), "n", "id").collect()}
    for row in C.sketch_distinct_cube(frame, ("a",), "n", "id").collect():
        assert abs(row.n - exact[row.a]) <= 0.05 * exact[row.a]


@pytest.mark.parametrize("name", ["cube_preagg", "play_fail_minute", "natural_buffer_rate", "business_quality"])
def test_no_python_in_batch_plans(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def lines_of(frame):
    """Operators of the initial plan with their depth, roots first."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    return [(len(line) - len(line.lstrip(" :+-*()0123456789")), line) for line in plan.splitlines() if line.strip()]


def below(lines, at):
    """Lines of the subtree under line ``at``."""
    out = []
    for depth, line in lines[at + 1:]:
        if depth <= lines[at][0]:
            break
        out.append(line)
    return out


def test_lattice_shuffles_cells_only(spark, sf):
    """In no branch an exchange lies above rows that are expanded to several levels."""
    lines = lines_of(QUERIES["image_lattice_day"](spark, sf))
    exchanges = [i for i, (_, line) in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(exchanges) >= 10
    for i in exchanges:
        own = below(lines, i)
        assert not any("Generate inline" in line or "Expand" in line for line in own), lines[i][1]


def test_lattice_deals_cells_to_few_partitions(spark, monkeypatch):
    """Cells are dealt out once a dimension, from as many partitions to as many: their number is kept lower than elsewhere."""
    monkeypatch.setattr(C, "read_bytes", lambda df: 512 << 20)
    frame = spark.createDataFrame([("t1", "x", "p", "m", "i1", 1)], DDL)
    lines = lines_of(C.cube_all(frame, DIMS, {"v": ("sum", F.col("v"))}, ("t",), lattice=True))
    dealt = [int(line.split("), REPARTITION_BY_NUM")[0].rsplit(" ", 1)[1]) for _, line in lines if "REPARTITION_BY_NUM" in line]
    assert len(dealt) >= 4 and set(dealt) == {256}


def test_levels_expand_cells_once(spark, sf):
    """Minute labels: one expansion, above the finest cells; the expanded rows are combined before they are shuffled."""
    lines = lines_of(QUERIES["image_rates_minute"](spark, sf))
    expanded = [i for i, (_, line) in enumerate(lines) if "Expand" in line]
    assert len(expanded) == 1
    assert any("Exchange hashpartitioning" in line for line in below(lines, expanded[0]))
    above = [line for _, line in lines[:expanded[0]]]
    assert "HashAggregate" in above[-1] or "HashAggregate" in above[-2]


def test_d5_dims():
    assert len(C.subsets(D5)) == 32


@pytest.mark.parametrize("name", ["image_rates_minute", "event_trend_minute", "epg_bands_minute", "multires_event"])
def test_labels_shuffle_no_levels(spark, sf, name):
    """No shuffle carries more than the two halves of the cells, with the first dimension and without it."""
    lines = lines_of(QUERIES[name](spark, sf))
    placed = [line for _, line in lines if "Exchange" in line and "REPARTITION_BY_NUM" in line]
    assert placed
    for i in [i for i, (_, line) in enumerate(lines) if "Exchange" in line]:
        assert not any("Generate explode" in line for line in below(lines, i)), lines[i][1]
    for i in [i for i, (_, line) in enumerate(lines) if "Expand" in line]:
        assert lines[i][1].count("], [") == 2, "two halves and the names of the columns"


@slow
@given(records=data)
def test_label_cubes_tell_all_apart(spark, records):
    """Time labels take the form in place, for any number of dimensions; a value that reads ALL is not a rolled-up one."""
    records = [(t, "ALL" if a == "x" else a, b, c, i, v) for t, a, b, c, i, v in records]
    frame = spark.createDataFrame(records, DDL).withColumnRenamed("t", "minute")
    for dims in (DIMS, DIMS[:2], DIMS[:1]):
        want = sorted(map(tuple, C.grouped_cube(C.no_null_dims(frame, dims), dims, ("minute",), [F.sum("v").alias("v")]).collect()))
        got_rows = C.cube_all(frame, dims, {"v": ("sum", F.col("v"))}, ("minute",))
        assert sorted(map(tuple, got_rows.collect())) == want
        assert got_rows.columns == ["minute", *dims, "v"]
    distinct = brute(records, lambda rows: len({i for i, _ in rows if i}) or None)
    if not any(r[1] == "ALL" for r in records):
        assert got(C.exact_distinct_cube(frame, DIMS, "n", "id", ("minute",))) == distinct


def test_partitions_grow_with_what_is_read(spark, tmp_path, monkeypatch):
    spark.range(20_000).write.parquet(f"{tmp_path}/rows")
    read = spark.read.parquet(f"{tmp_path}/rows")
    assert C.read_bytes(read) > 0
    assert C.read_bytes(read.unionByName(read)) == 2 * C.read_bytes(read)
    monkeypatch.setattr(C, "PLACE_BYTES", 1024)
    assert C.place_partitions(read) == -(-C.read_bytes(read) // 1024) > spark.sparkContext.defaultParallelism
