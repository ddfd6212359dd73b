"""Roll-ups over every subset of the dimensions, ``'ALL'`` standing for a rolled-up one.

Scale notes: ``CUBE`` expands each input row once per subset (32 times for five dimensions), so mergeable measures are
first brought to the finest grain.  That first step combines map-side, so a hot key costs one row per task, and what is
expanded afterwards is bounded by the number of distinct cells instead of the number of log rows.

Cells of time labels hardly merge before they are expanded.  They are therefore dealt out by label and expanded and summed
where they lie: the shuffles carry cells, never the 32 rows of a cell.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from viewpulse.model import ALL, TIME_LABELS

#: measures by name: (merge function, value column)
Measures = Mapping[str, tuple[str, "Column | str"]]

_MERGE = {"sum": F.sum, "max": F.max, "min": F.min}

#: bytes read per partition of cells that are expanded in place; a partition's levels have to fit in the memory of a task
PLACE_BYTES = 512 * 1024
#: as many times these bytes where partitions are dealt out again and again: the blocks of such a shuffle are their number squared
LATTICE_TIMES = 4
#: planned sizes from here on are placeholders of relations that know none
_UNKNOWN_BYTES = 1 << 50


def subsets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [kept for n in range(len(dims), -1, -1) for kept in combinations(dims, n)]


def no_null_dims(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """A missing dimension value is the empty text, so that it never looks rolled up."""
    return df.withColumns({d: F.coalesce(F.col(d), F.lit("")) for d in dims})


def grouped_cube(df: DataFrame, dims: Sequence[str], fixed: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """``GROUP BY fixed, CUBE(dims)`` in one Expand and one aggregate."""
    levels = [[F.col(c) for c in (*fixed, *kept)] for kept in subsets(dims)]
    keys = [F.col(c) for c in (*fixed, *dims)]
    flags = [F.grouping(d).alias(f"_g_{d}") for d in dims]
    out = df.groupingSets(levels, *keys).agg(*aggregates, *flags)
    measures = [c for c in out.columns if c not in (*fixed, *dims) and not c.startswith("_g_")]
    named = [F.when(F.col(f"_g_{d}") == 1, ALL).otherwise(F.col(d)).alias(d) for d in dims]
    return out.select(*fixed, *named, *measures)


def all_levels(rows: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Each row once per subset of the dimensions, ``'ALL'`` for the others.

    Unlike ``CUBE`` this keeps the partitioning of the rows, and it may run inside a stream: a stream cannot count
    distinct ids, but it can drop repeated (window, level, id) rows from this form and count.
    """
    others = [c for c in rows.columns if c not in dims]
    return numbered_levels(rows, dims).select(*others, *dims)


def numbered_levels(rows: DataFrame, dims: Sequence[str], known: str | None = None) -> DataFrame:
    """:func:`all_levels` with the number of the level in ``_level``: bit i is set where dimension i is rolled up.

    Rows whose column ``known`` is not null belong to the level it names and are not expanded.
    """
    levels = F.array(*[F.lit(n) for n in range(1 << len(dims))])
    if known is not None:
        levels = F.when(F.col(known).isNull(), levels).otherwise(F.array(known))
    others = [c for c in rows.columns if c not in dims and c != known]
    named = [F.when(F.col("_level").bitwiseAND(1 << i) != 0, ALL).otherwise(F.col(d)).alias(d) for i, d in enumerate(dims)]
    return rows.select(*others, *dims, F.explode(levels).alias("_level")).select(*others, *named, "_level")


def read_bytes(df: DataFrame) -> int:
    """Bytes of all relations a frame is made of, as Catalyst knows them; 0 where it does not."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(n for n in sizes if n < _UNKNOWN_BYTES)


def place_partitions(cells: DataFrame, times: int = 1) -> int:
    """Partitions for cells that are expanded where they lie; one for ``times`` :data:`PLACE_BYTES` read, where that is known."""
    known, spark = read_bytes(cells), cells.sparkSession
    if not known:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, -(-known // (times * PLACE_BYTES)))


def cube_in_place(cells: DataFrame, dims: Sequence[str], fixed: Sequence[str], aggregates: Sequence[Column],
                  known: str | None = None, together: Sequence[str] = ()) -> DataFrame:
    """All levels of cells, which come together by the fixed keys: one shuffle of the cells, none of their levels.

    A task holds the cells of some labels, each bounded by the combinations of dimension values.  Cells that differ in the
    fixed keys ``together`` alone come to one task, so the levels can be grouped without these keys where they lie.
    """
    placed = cells.repartition(place_partitions(cells), *[c for c in fixed if c not in together])
    return numbered_levels(placed, dims, known).groupBy(*fixed, *dims, "_level").agg(*aggregates).drop("_level")


def cube_by_label(cells: DataFrame, dims: Sequence[str], fixed: Sequence[str], aggregates: Sequence[Column],
                  together: Sequence[str] = ()) -> DataFrame:
    """All levels of the cells of time labels; what is shuffled does not grow with the number of levels.

    The first dimension is expanded (kept and rolled up) and combined before its shuffle.  The cells then come together by
    label and first dimension, so that a label spreads over as many tasks as that has values, and the levels of the others
    are summed where they lie.  Two dimensions have few cells a label and need no such spread.
    """
    if len(dims) <= 2:
        return cube_in_place(cells, dims, fixed, aggregates, None, together)
    first, *others = dims
    levels = [[F.col(c) for c in (*fixed, *kept)] for kept in (dims, others)]
    halves = cells.groupingSets(levels, *[F.col(c) for c in (*fixed, *dims)]).agg(*aggregates, F.grouping(first).alias("_half"))
    named = halves.withColumn(first, F.when(F.col("_half") == 1, ALL).otherwise(F.col(first)))
    return cube_in_place(named, others, (*fixed, first, "_half"), aggregates, None, ("_half", *together)).select(
        *fixed, *dims, *[c for c in halves.columns if c not in (*fixed, *dims, "_half")])


def _finest(df: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    values = [_MERGE[how](value).alias(name) for name, (how, value) in measures.items()]
    return df.groupBy(*keys).agg(*values)


def cube_all(df: DataFrame, dims: Sequence[str], measures: Measures, fixed: Sequence[str] = (),
             pre_aggregate: bool = True, lattice: bool = False, together: Sequence[str] = ()) -> DataFrame:
    """Cube of mergeable measures (``sum``, ``max``, ``min``) with ``fixed`` keys always grouped.

    With a time label among the fixed keys the finest cells are shuffled by label and expanded in place, see
    :func:`cube_by_label`.  Without one they merge well: they are expanded to all levels, combined map-side and shuffled.
    ``lattice`` asks for :func:`lattice_cube`, which spreads a label by its dimensions.  ``together`` names fixed keys that the
    result will be grouped without.  An empty input gives an empty result, also for the grand total.
    """
    df = no_null_dims(df, dims)
    keys = (*fixed, *dims)
    if not pre_aggregate:
        merged, cells = measures, df
    else:
        cells = _finest(df, keys, measures)
        merged = {name: (how, name) for name, (how, _) in measures.items()}
    aggregates = [_MERGE[how](value).alias(name) for name, (how, value) in merged.items()]
    if pre_aggregate and lattice and dims:
        return lattice_cube(cells, dims, fixed, aggregates)
    if dims and set(fixed) & set(TIME_LABELS):
        return cube_by_label(cells, dims, fixed, aggregates, together)
    rows = F.count(F.lit(1)).alias("_rows")
    return grouped_cube(cells, dims, fixed, [*aggregates, rows]).where("_rows > 0").drop("_rows")


def lattice_cube(cells: DataFrame, dims: Sequence[str], fixed: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """All levels of finest cells, each from the smallest parent at hand; only cells are ever shuffled, once a dimension.

    Levels with the first dimension: cells come together by the fixed keys and that dimension, and are expanded over the
    others where they lie.  Levels without it: the cells come together by the fixed keys and the next dimension, are summed
    there, and the same is done with what remains.  One label is thus spread over as many tasks as the first dimension has
    values, and so on down the dimensions.
    """
    first, *others = dims
    n, keys = place_partitions(cells, LATTICE_TIMES), (*fixed, *dims)
    if others:
        own = numbered_levels(cells.repartition(n, *fixed, first), others).groupBy(*keys, "_level").agg(*aggregates).drop("_level")
        met = cells.drop(first).repartition(n, *fixed, others[0])
        rolled = lattice_cube(met.groupBy(*fixed, *others).agg(*aggregates), others, fixed, aggregates)
    else:
        own = cells
        rolled = cells.groupBy(*fixed).agg(*aggregates) if fixed else cells.groupBy().agg(
            *aggregates, F.count(F.lit(1)).alias("_rows")).where("_rows > 0").drop("_rows")
    columns = own.columns
    return own.unionByName(rolled.withColumn(first, F.lit(ALL)).select(*columns))


def cube_and_filter(df: DataFrame, dims: Sequence[str], keys: Sequence[str], measures: Measures) -> DataFrame:
    """Cube whose sub-totals over ``keys`` are not wanted: the keys are grouped always, half the grouping sets each."""
    return cube_all(df, dims, measures, fixed=keys)


def additive_distinct_cube(df: DataFrame, dims: Sequence[str], ids: Mapping[str, str],
                           fixed: Sequence[str] = ()) -> DataFrame:
    """Distinct ids per finest cell, *summed* upwards (an id seen in several cells counts several times)."""
    df = no_null_dims(df, dims)
    keys = (*fixed, *dims)
    cells = None
    for name, column in ids.items():
        one = (df.where(F.col(column).isNotNull()).select(*keys, column).distinct()
               .groupBy(*keys).agg(F.count(F.lit(1)).alias(name)))
        others = [F.lit(0).cast("bigint").alias(n) for n in ids if n != name]
        one = one.select(*keys, F.col(name), *others).select(*keys, *ids)
        cells = one if cells is None else cells.unionByName(one)
    return cube_all(cells, dims, {name: ("sum", name) for name in ids}, fixed,
                    pre_aggregate=len(ids) > 1)


def exact_distinct_cube(df: DataFrame, dims: Sequence[str], name: str, column: str,
                        fixed: Sequence[str] = (), measures: Measures | None = None, plain: bool = False) -> DataFrame:
    """Exact distinct ids per subset, with further summed ``measures`` if wanted.

    ``plain`` asks for the expanded distinct count of all ids, which few levels make cheaper.

    Nearly every id lives in one finest cell; those ids add up exactly, so they are counted per cell and only the cell
    counts are expanded.  Ids seen in several cells go through the expanded distinct count.  Both parts are whole, and
    no step gathers a group: each shuffle is keyed by an id, or by a cell after map-side combining.
    """
    df = no_null_dims(df, dims)
    measures = dict(measures or {})
    keys = (*fixed, *dims)
    known = df.withColumn("_id", F.col(column))
    if plain:
        known = known.where(F.col("_id").isNotNull())
    if measures:
        pairs = _finest(known, (*keys, "_id"), measures)
    else:
        pairs = known.select(*keys, "_id").distinct()
    if plain:
        return cube_of_distinct(pairs, dims, name, fixed, [F.sum(m).alias(m) for m in measures])
    # missing ids have no cells; they go after the window, so that cubes of several ids read one shuffle of the rows
    cells = pairs.withColumn("_cells", F.count("_id").over(Window.partitionBy(*fixed, "_id"))).where("_cells > 0")
    sums = [F.sum(m).alias(m) for m in measures]
    counted = [F.sum(c).alias(c) for c in (name, *measures)]
    if dims and set(fixed) & set(TIME_LABELS):
        # one pass over the ids: those of one cell stay in it, the others are expanded to all levels
        marked = cells.withColumn("_lone", F.col("_cells") == 1).withColumn("_known", F.when(F.col("_lone"), 0)).drop("_cells")
        levels = numbered_levels(marked, dims, "_known").groupBy(*keys, "_level", "_lone").agg(F.count_distinct("_id").alias(name), *sums)
        parts = levels.withColumn("_known", F.when(~F.col("_lone"), F.col("_level"))).drop("_level", "_lone")
        return cube_in_place(parts, dims, fixed, counted, "_known")
    # the same columns in both parts, so that both read one shuffle
    lone = cells.where("_cells = 1").groupBy(*keys).agg(F.count(F.lit(1)).alias(name), *sums)
    several = cube_of_distinct(cells.where("_cells > 1"), dims, name, fixed, sums)
    return all_levels(lone, dims).unionByName(several).groupBy(*fixed, *dims).agg(*counted)


def cube_of_distinct(pairs: DataFrame, dims: Sequence[str], name: str, fixed: Sequence[str],
                     sums: Sequence[Column] = ()) -> DataFrame:
    distinct = F.count_distinct("_id").alias(name)
    return grouped_cube(pairs, dims, fixed, [distinct, *sums]).where(F.col(name) > 0)


def sketch_distinct_cube(df: DataFrame, dims: Sequence[str], name: str, column: str, fixed: Sequence[str] = (),
                         lg_config_k: int = 12) -> DataFrame:
    """Approximate distinct ids per subset from HLL sketches, which do merge upwards.  An explicit, separate mode."""
    df = no_null_dims(df, dims)
    cells = df.groupBy(*fixed, *dims).agg(F.hll_sketch_agg(column, F.lit(lg_config_k)).alias("_sketch"))
    merged = grouped_cube(cells, dims, fixed, [F.hll_union_agg("_sketch").alias("_sketch"),
                                               F.count(F.lit(1)).alias("_rows")])
    return (merged.where("_rows > 0")
            .select(*fixed, *dims, F.hll_sketch_estimate("_sketch").alias(name)))


def dense_counts(df: DataFrame, dims: Sequence[str], category: str, categories: Sequence[str], name: str,
                 fixed: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """Count per category (or sum of ``weight``) with a zero row for every listed category a key has not seen.

    One roll-up by category, then the zero rows of a key from the categories it has: no grid join, one scan.  Categories
    outside the list are counted where they occur, a missing one as the empty text.
    """
    one = F.lit(1).cast("bigint") if weight is None else weight
    known = df.withColumn(category, F.coalesce(F.col(category), F.lit("")))
    sparse = cube_all(known, dims, {name: ("sum", one)}, (*fixed, category), together=(category,))
    # one entry per category of a key; with a time label these lie together already
    points = sparse.groupBy(*fixed, *dims).agg(F.collect_list(F.struct(category, name)).alias("_seen"))
    listed = F.array(*[F.lit(c) for c in categories])
    missing = F.transform(F.array_except(listed, F.transform("_seen", lambda e: e[category])), lambda c: F.struct(
        c.alias(category), F.lit(0).cast(sparse.schema[name].dataType).alias(name)))
    return points.select(*fixed, *dims, F.inline(F.concat("_seen", missing)))
