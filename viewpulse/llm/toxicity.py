"""A convolutional text classifier trained in numpy, with a threshold per language."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from viewpulse.llm.common import remembered, ship, stored
from viewpulse.llm.substring import only_among

#: Width of an embedding, filter widths, filters of a width.
DIM, WIDTHS, FILTERS = 16, (1, 2, 3), 8
#: Parts in fewer labelled documents have no embedding of their own: they count as nothing.  In a larger table they also have
#: to be in this share of the documents of a class, so the vocabulary does not grow with the table.
LEAST, LEAST_SHARE = 4, 1 / 1500
#: Labelled documents of a shard, which one task trains on; rounds of training and averaging of several shards.
SHARD, ROUNDS = 8192, 2
#: Batches of training in all at least, and their documents.
STEPS, BATCH = 700, 32
#: Sums of parameters that one task adds up, and rows of the table that move as one value.
FAN, BLOCK = 8, 2048
#: Raw scores for calibration that differ by less than 1 / CELLS are counted as their mean.
CELLS = 4096
#: Documents of each class in :func:`labelled_sample`.
SAMPLE = 3000
#: Words a process remembers (about 250 bytes each) besides as many that it met before these, words convolved at a time, texts taken out of a batch at a time.
REMEMBERED, STEP, TEXTS = 150_000, 32_768, 512
#: Positions behind a text at which filters still meet its last words or nothing; as many zero vectors more keep the next text out.
GAP = max(WIDTHS) - 1
_TRIM = b".,;:!?\"'()[]*#$%&<>|"
#: Parts of a word that are embedded besides the word: beginnings and ends, for words with a common stem.
_PARTS = (4, 5, 6, -4, -5)
#: Each part as a slice, with the hash of what is hashed before it.
_SLICES = [(slice(n) if n > 0 else slice(n, None), zlib.crc32(b"%d" % n)) for n in _PARTS]
_WHOLE = zlib.crc32(b"=")


def parts(word: bytes) -> list[int]:
    """Hashes of a lower-case word: of the whole and of its beginnings and ends (in bytes); short words are their own."""
    word = word.strip(_TRIM) or word
    return [zlib.crc32(word, _WHOLE), *[zlib.crc32(word[own], start) for own, start in _SLICES]]


@dataclass
class Model:
    """``keys``: sorted hashes that have a row of ``table`` (its last row is zero, for all others); ``filters`` (DIM, all
    offsets of all widths); ``out``: weights of the pooled maxima."""

    keys: np.ndarray
    table: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict = field(default_factory=dict)
    threshold: float = 0.5

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of the table for an array of hashes."""
        if not len(self.keys):
            return np.zeros(hashes.shape, np.int64)
        at = np.searchsorted(self.keys, hashes).clip(max=len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, len(self.keys))


_SLOTS = [(w, o) for w in WIDTHS for o in range(w)]  # (width, offset) of each block of FILTERS columns


def new_model(keys: np.ndarray, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    normal = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    table = np.append(normal(len(keys), DIM) * 0.05, np.zeros((1, DIM), np.float32), 0)
    return Model(keys, table, normal(DIM, FILTERS * len(_SLOTS)) * 0.3, np.zeros(FILTERS * len(WIDTHS), np.float32),
                 normal(FILTERS * len(WIDTHS)) * 0.1, 0.0)


def responses(model: Model, x: np.ndarray) -> np.ndarray:
    """Filter responses (n, FILTERS * widths) at every position; past the end there are zero vectors.

    The values of a filter lie side by side, as sums and maxima run along the positions.
    """
    z = model.filters.T @ x.T
    found = np.repeat(model.bias[:, None], len(x), 1)
    for j, (w, o) in enumerate(_SLOTS):
        k = WIDTHS.index(w) * FILTERS
        found[k:k + FILTERS, :len(x) - o] += z[j * FILTERS:(j + 1) * FILTERS, o:]
    return found.T


class Words:
    """Numbers of words with the sum of their embedded parts.

    When :data:`REMEMBERED` words are known they become ``older``, in place of those that were; a word met again is taken
    from there.  Common words are thus never forgotten, however many rare ones pass.
    """

    def __init__(self, model: Model):
        self.model, self.numbers, self.older = model, {}, {}
        self.vectors = self.older_vectors = np.zeros((1024, DIM), np.float32)

    def look_up(self, words: list[bytes]) -> np.ndarray:
        if len(self.numbers) > REMEMBERED:
            self.older, self.older_vectors = self.numbers, self.vectors[:len(self.numbers)].copy()
            self.numbers = {}
        known, older = self.numbers, self.older
        new = list(set(words).difference(known))
        if new:
            at = len(known)
            while at + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
            met = [w for w in new if w in older]
            if met:
                self.vectors[at:at + len(met)] = self.older_vectors[[older[w] for w in met]]
                known.update(zip(met, range(at, at + len(met)), strict=True))
                new, at = [w for w in new if w not in older], at + len(met)
        if new:
            self.vectors[at:at + len(new)] = self.model.table[self.model.rows(np.array([parts(w) for w in new]))].sum(1)
            known.update(zip(new, range(at, at + len(new)), strict=True))
        return self.vectors[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]


def pooled(model: Model, words: Words, texts: list[bytes | None]) -> np.ndarray:
    """Largest rectified response of each filter over each whole text; texts are convolved a stretch at a time.

    The positions of a text are its words and :data:`GAP` more.  A stretch brings along the words that filters at its last
    positions reach, so what a text gets depends neither on where it is cut nor on the texts beside it.
    """
    found = np.zeros((len(texts), FILTERS * len(WIDTHS)), np.float32)
    line: list[bytes] = []
    owner: list[int] = []
    bounds: list[int] = []  # first position of a stretch and the one behind its last, in turn
    empty: list[int] = []

    def flush() -> None:
        if not line:
            return
        x = words.look_up(line)
        x[empty] = 0
        top = np.maximum.reduceat(responses(model, x), bounds)[::2]
        np.maximum.at(found, owner, top)
        for own in (line, owner, bounds, empty):
            own.clear()

    for d, text in enumerate(texts):
        own = (text or b"").lower().split()
        for s in range(0, max(1, len(own)), STEP):
            piece = own[s:s + STEP + GAP]
            lo, end = len(line), len(line) + len(piece)
            owner.append(d)
            bounds.extend([lo, lo + STEP if s + STEP < len(own) else end + GAP])
            empty.extend(range(end, end + 2 * GAP))
            line.extend(piece)
            line.extend([b""] * (2 * GAP))
            if len(line) >= STEP:
                flush()
    flush()
    return found


def raw_scores(model: Model, words: Words, texts: list[bytes | None]) -> np.ndarray:
    # summed in double precision: what a row gets does not hang on how many rows are multiplied at a time
    return pooled(model, words, texts).astype(np.float64) @ model.out.astype(np.float64) + model.out_bias


def probability(model: Model, raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.scale * raw.astype(np.float64) + model.shift, -30, 30)))


def least_documents(counts: dict[int, int]) -> dict[int, float]:
    """Documents of a class that a part has to be in; one class that has them is enough."""
    return {y: n * LEAST_SHARE for y, n in counts.items()}


def new_state(keys: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters of a new model and, as ``seen_*``, the sums of squared gradients of Adagrad."""
    model = new_model(keys, seed)
    state = {"table": model.table, "filters": model.filters, "bias": model.bias, "out": model.out, "out_bias": np.zeros(1)}
    return state | {f"seen_{k}": np.full_like(v, 1e-6) for k, v in state.items()}


def as_model(keys: np.ndarray, state: dict[str, np.ndarray]) -> Model:
    return Model(keys, state["table"], state["filters"], state["bias"], state["out"], float(state["out_bias"][0]))


class Texts:
    """Texts as numbers of their distinct words, with :data:`GAP` times two empty places behind each."""

    def __init__(self, texts: Iterable[bytes]):
        numbers: dict[bytes, int] = {}
        gap = [-1] * (2 * GAP)
        self.words = [np.array([*(numbers.setdefault(w, len(numbers)) for w in t.lower().split()), *gap], np.int32) for t in texts]
        each = chain(chain.from_iterable(map(parts, numbers)), [0] * (1 + len(_PARTS)))
        self.hashes = np.fromiter(each, np.int64).reshape(-1, 1 + len(_PARTS))

    def documents(self, chosen: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of parts and how many of the chosen texts have them."""
        words = [self.words[i] for i in np.arange(len(self.words))[chosen]]
        found = [np.unique(self.hashes[w[:-2 * GAP]]) for w in words]
        return np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)


def descend(state: dict[str, np.ndarray], keys: np.ndarray, texts: Texts, labels: np.ndarray, passes: int, batch: int = BATCH,
            rate: float = 0.05, seed: int = 7) -> None:
    """Adagrad on the log loss in ``passes`` over the texts; gradients pass only through each filter's maximum."""
    width_of, rng, words = np.repeat(WIDTHS, FILTERS), np.random.default_rng(seed), texts.words
    model = as_model(keys, state)
    buckets = model.rows(texts.hashes)
    column = {(w, o): np.arange(FILTERS) + j * FILTERS for j, (w, o) in enumerate(_SLOTS)}
    out_bias = state["out_bias"]

    def step(name: str, grad: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        state[f"seen_{name}"][rows] += grad * grad
        state[name][rows] -= rate * grad / np.sqrt(state[f"seen_{name}"][rows])

    for _ in range(passes):
        order = rng.permutation(len(words))
        for k in range(0, len(order), batch):
            ids = order[k:k + batch]
            line = np.concatenate([words[i] for i in ids])
            starts = np.cumsum([0, *(len(words[i]) for i in ids)])
            distinct, back = np.unique(line, return_inverse=True)
            vectors = model.table[buckets[distinct]].sum(1)
            vectors[distinct < 0] = 0
            x = vectors[back]
            z = responses(model, x)
            peak = np.array([lo + z[lo:hi - GAP].argmax(0) for lo, hi in zip(starts, starts[1:])])
            pool = np.maximum(np.take_along_axis(z, peak, 0), 0)
            p = 1 / (1 + np.exp(-np.clip(pool @ model.out + out_bias[0], -30, 30)))
            error = ((p - labels[ids]) / len(ids)).astype(np.float32)
            back_pool = error[:, None] * model.out * (pool > 0)
            step("out", pool.T @ error)
            step("out_bias", np.array([float(error.sum())]))
            grad_filters, grad_x = np.zeros_like(model.filters), np.zeros_like(x)
            for w, o in _SLOTS:
                f = np.flatnonzero(width_of == w)
                at = (peak[:, f] + o).clip(max=len(x) - 1)
                inside = peak[:, f] + o < starts[1:, None]
                g = back_pool[:, f] * inside
                grad_filters[:, column[w, o]] += np.einsum("dfk,df->kf", x[at], g)
                np.add.at(grad_x, at, g[:, :, None] * model.filters[:, column[w, o]].T[None])
            step("bias", back_pool.sum(0))
            step("filters", grad_filters)
            moved = np.flatnonzero(grad_x.any(1) & (line >= 0))
            rows = buckets[line[moved]]
            hit, place = np.unique(rows, return_inverse=True)
            total = np.zeros((len(hit), DIM), np.float32)
            np.add.at(total, place.reshape(rows.shape), grad_x[moved][:, None, :])
            total[hit == len(model.keys)] = 0
            step("table", total, hit)


def passes_over(n: int, steps: int = STEPS, batch: int = BATCH) -> int:
    return max(2, -(-steps * batch // n))


def train(texts: list[bytes], labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.05, seed: int = 7) -> Model:
    """Fit one shard here, in about ``steps`` batches; :func:`fit` does the same in tasks."""
    known = Texts(texts)
    found, n = known.documents()
    keys = found[n >= LEAST]
    state = new_state(keys, seed)
    descend(state, keys, known, labels, passes_over(len(texts), steps, batch), batch, rate, seed)
    return as_model(keys, state)


def calibrate(model: Model, raw: np.ndarray, labels: np.ndarray, weight: np.ndarray, langs: list[str | None],
              rows: np.ndarray | None = None) -> None:
    """Fit ``scale`` and ``shift`` by weighted logistic regression, then the threshold of least weighted error per language.

    An entry stands for as many ``rows`` (one by default), whose weights are summed in ``weight``.  A language with fewer
    than 20 rows of either class keeps the common threshold of 0.5.
    """
    rows = np.ones(len(raw), np.int64) if rows is None else rows
    # a little of the opposite label keeps the fit finite where the classes part cleanly
    target = labels * 0.98 + 0.01

    def loss(at: np.ndarray) -> float:
        z = at[0] * raw + at[1]
        return float(np.sum(weight * (np.logaddexp(0, z) - target * z)))

    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at[0] * raw + at[1], -30, 30)))
        g, h = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-4)
        hessian = np.array([[np.sum(h * raw * raw) + 1e-6, np.sum(h * raw)], [np.sum(h * raw), np.sum(h) + 1e-6]])
        move = np.linalg.solve(hessian, [np.sum(g * raw), np.sum(g)])
        # a whole step may overshoot where few rows of a class are left: it is halved until the loss falls
        while np.abs(move).max() >= 1e-9 and not loss(at - move) < loss(at):
            move /= 2
        if np.abs(move).max() < 1e-9:
            break
        at = at - move
    a, b = at
    model.scale, model.shift = float(max(a, 1e-3)), float(b)
    p = probability(model, raw)
    names = np.array([x or "" for x in langs], object)
    for lang in {x for x in langs if x is not None}:
        own = np.flatnonzero((names == lang) & np.array([x is not None for x in langs]))
        if min(rows[own][labels[own] == 1].sum(), rows[own][labels[own] == 0].sum()) < 20:
            continue
        own = own[np.argsort(p[own], kind="stable")]
        cuts = np.unique(np.append(p[own], 0.5))
        middle = np.append((cuts[1:] + cuts[:-1]) / 2, 0.5)
        # of label 1 what lies below a cut is wrong, of label 0 what lies above
        below = np.searchsorted(p[own], middle)
        missed = np.append(0, np.cumsum(weight[own] * (labels[own] == 1)))
        spared = np.append(0, np.cumsum(weight[own] * (labels[own] == 0)))
        wrong = missed[below] + spared[-1] - spared[below]
        best = np.flatnonzero(wrong <= wrong.min() + 1e-9 * weight[own].sum())
        model.thresholds[lang] = float(middle[best[np.abs(middle[best] - 0.5).argmin()]])


def _labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(``_id``, ``_y``) of the labels that may be learnt from: never those whose crc32 of the id as text is divisible by 5."""
    return labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where(
        F.crc32(F.col("_id").cast("string").cast("binary")) % 5 != 0).distinct()


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", label_col: str = "toxic") -> tuple[list[tuple], dict[int, int]]:
    """At most ``per_class`` (text, lang, label) rows of each label, chosen by hash, and how many rows have each label.

    For a look at the data; :func:`fit` learns from all labelled rows.
    """
    own = _labels(labels, id_col, label_col)
    counts = {r["_y"]: r["count"] for r in own.groupBy("_y").count().collect()}  # two rows
    rate = F.lit(0.0)
    for y, n in counts.items():  # by hash first, so that only about the sample is sorted; the sort makes the bound exact
        rate = F.when(F.col("_y") == y, min(1.0, 1.2 * per_class / n + 0.001)).otherwise(rate)
    near = own.where(F.pmod(F.xxhash64(F.lit("sample"), "_id"), F.lit(1 << 30)) < rate * float(1 << 30))
    picked = None
    for y in sorted(counts):
        some = near.where(F.col("_y") == y).orderBy(F.xxhash64(F.lit("sample"), "_id"), "_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    if picked is None:
        return [], counts
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("binary").alias("text"), F.col(lang_col).alias("lang"))
    rows = texts.join(F.broadcast(picked), F.col("_doc") == F.col("_id")).select("_id", "text", "lang", "_y")  # bounded
    return sorted((r["_id"], bytes(r["text"] or b""), r["lang"], r["_y"]) for r in rows.toLocalIterator()), counts


def labelled(docs: DataFrame, own: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(``_id``, ``body`` compressed text, ``lang``, ``_y``, ``apart``) of all labelled rows; other texts are not moved."""
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("binary").alias("body"), F.col(lang_col).alias("lang"))
    near = only_among(texts, F.col("_doc").cast("string"), own.select(F.col("_id").cast("string").alias("key")))

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = [zlib.compress(t.as_py() or b"", 1) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(body, pa.binary()), batch.column(2)], batch.schema.names)

    # a quarter is kept apart for calibration
    apart = F.crc32(F.concat(F.lit("apart"), F.col("_id").cast("string")).cast("binary")) % 4 == 0
    return near.mapInArrow(small, near.schema).join(own, F.col("_doc") == F.col("_id")).select(
        "_id", "body", "lang", "_y", apart.alias("apart"))


def vocabulary(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of the parts that have an embedding, counted over all ``rows``."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1).to_numpy()
            for k in range(0, batch.num_rows, TEXTS):
                texts = Texts([zlib.decompress(t.as_py()) for t in batch.column(0).slice(k, TEXTS)])
                for label in (0, 1):
                    found, n = texts.documents(y[k:k + TEXTS] == label)
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n), pa.array(np.full(len(n), label, np.int32))],
                                                     ["part", "n", "y"])

    least = least_documents({r["_y"]: r["count"] for r in rows.groupBy("_y").count().collect()})
    each = rows.select("body", "_y").mapInArrow(counted, "part long, n long, y int").groupBy("part").agg(
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("n0"),
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("n1"))
    common = each.where((F.col("n0") + F.col("n1") >= LEAST) & (
        (F.col("n0") >= max(1.0, least.get(0, 0))) | (F.col("n1") >= max(1.0, least.get(1, 0)))))
    return np.sort(common.select("part").toArrow().column(0).to_numpy().astype(np.int64))


def _moved(new: dict[str, np.ndarray], old: dict[str, np.ndarray], last: bool) -> Iterator[tuple[int, bytes]]:
    """What a shard made of the parameters and how many shards that is, by block of the table; -1 has all that is no table."""
    tables = ("table",) if last else ("table", "seen_table")  # nothing is trained any more from what the last round has seen
    moved = (new["seen_table"] != old["seen_table"]).any(1, keepdims=True)
    yield -1, pickle.dumps({k: (v, np.ones(1, np.int32)) for k, v in new.items() if not k.endswith("table")})
    for lo in range(0, len(moved), BLOCK):
        own = slice(lo, lo + BLOCK)
        yield lo // BLOCK, pickle.dumps({k: (new[k][own] * moved[own], moved[own].astype(np.int32)) for k in tables})


def _added(groups: Iterator[bytes]) -> bytes:
    """Sums of parameters and of their counts."""
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for group in groups:
        for name, (value, n) in pickle.loads(group).items():
            total[name] = (total[name][0] + value, total[name][1] + n) if name in total else (value, n)
    return pickle.dumps(total)


def one_round(rows: DataFrame, shards: int, keys: np.ndarray, state: dict[str, np.ndarray], passes: int, number: int,
              seed: int = 7, last: bool = False) -> dict[str, np.ndarray]:
    """Every shard trains from ``state`` on; parameters become the mean of the shards that moved them.

    The embedding of a part that few shards have is thus not held back by the others.  Parameters travel as blocks of
    :data:`BLOCK` rows: neither the driver nor a task that adds up meets a shard's parameters as one value.  After the
    ``last`` round the state is good for a model only.
    """
    shared = rows.sparkSession.sparkContext.broadcast((keys, state))  # bounded by the vocabulary

    def trained(key: tuple, group: pa.Table) -> pa.Table:
        known, old = shared.value
        shard = key[0].as_py()
        order = sorted(zip(*(group.column(c).to_pylist() for c in ("_id", "_y", "lang", "body"))),
                       key=lambda r: (r[0], zlib.crc32(r[3]), r[2] or "", r[1]))
        texts, y = Texts(zlib.decompress(r[3]) for r in order), np.array([r[1] for r in order], np.float32)
        del order
        new = {k: v.copy() for k, v in old.items()}
        descend(new, known, texts, y, passes, seed=seed + 7919 * number + shard)
        blocks, sums = zip(*_moved(new, old, last), strict=True)
        return pa.table({"at": pa.array([shard // FAN] * len(blocks), pa.int32()), "part": pa.array([shard] * len(blocks), pa.int32()),
                         "block": pa.array(blocks, pa.int32()), "sums": pa.array(sums, pa.binary())})

    def added(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("part")  # the same sum in every run
        at, block = (k.as_py() for k in key)
        return pa.table({"at": pa.array([at // FAN], pa.int32()), "part": pa.array([at], pa.int32()), "block": pa.array([block], pa.int32()),
                         "sums": pa.array([_added(x.as_py() for x in group.column("sums"))], pa.binary())})

    schema, left = "at int, part int, block int, sums binary", shards
    sums = rows.groupBy("shard").applyInArrow(trained, schema)
    while left > 1:
        sums, left = sums.groupBy("at", "block").applyInArrow(added, schema), -(-left // FAN)
    mean = {k: v.copy() for k, v in state.items() if not (last and k == "seen_table")}
    found = sums.select("block", "sums").toArrow()
    for block, each in zip(found.column("block").to_pylist(), found.column("sums"), strict=True):
        own = slice(None) if block < 0 else slice(block * BLOCK, (block + 1) * BLOCK)
        for k, (v, n) in pickle.loads(each.as_buffer()).items():
            mean[k][own] = np.where(n > 0, v / np.maximum(n, 1), mean[k][own])
    shared.destroy()
    return mean


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        label_col: str = "toxic") -> Model:
    """Train on all labelled rows but a quarter, calibrate on that, weighted to the true share of the labels.

    Rows are dealt to shards by hash.  Tasks train one shard each, :data:`ROUNDS` times from the mean of all; a table of one
    shard is trained at once.  The vocabulary is counted over all rows.  What the driver holds is one model and the counts of
    calibration, per language, label and cell of raw scores.  Rows equal in id and text share a shard.  Without labelled
    rows of both classes every text gets the score 0.
    """
    ship(docs.sparkSession)
    own = _labels(labels, id_col, label_col)
    counts = {r["_y"]: r["count"] for r in own.groupBy("_y").count().collect()}
    known = stored(labelled(docs, own, id_col, text_col, lang_col), "labelled") if len(counts) == 2 else None
    sizes = {(r["apart"], r["_y"]): r["count"] for r in known.groupBy("apart", "_y").count().collect()} if known else {}
    if len({y for _, y in sizes}) < 2:
        model = new_model(np.zeros(0, np.int64))
        model.scale, model.shift = 0.0, -30.0
        return model
    split = all((part, y) in sizes for part in (False, True) for y in (0, 1))
    fitted, judged = (known.where("not apart"), known.where("apart")) if split else (known, known)
    n = sum(c for (part, _), c in sizes.items() if not (split and part))
    shards = -(-n // SHARD)
    keys = vocabulary(fitted)
    state = new_state(keys)
    dealt = fitted.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "_id", "body"), F.lit(shards)).cast("int"))
    rounds = 1 if shards == 1 else ROUNDS
    for number in range(rounds):
        state = one_round(dealt, shards, keys, state, passes_over(n) if shards == 1 else 1, number, last=number == rounds - 1)
    model = as_model(keys, state)
    cells = raw_cells(judged, model)
    y, rows = cells["_y"].to_numpy().astype(np.float64), cells["n"].to_numpy()
    each = np.where(y == 1, counts[1] / max(1, rows[y == 1].sum()), counts[0] / max(1, rows[y == 0].sum()))
    weight = each * rows / (np.sum(each * rows) / rows.sum())
    calibrate(model, cells["raw"].to_numpy(), y, weight, cells["lang"].to_pylist(), rows)
    return model


def raw_cells(rows: DataFrame, model: Model) -> pa.Table:
    """Mean raw score ``raw`` and number ``n`` of ``rows`` per language, label and cell, in a fixed order."""
    shared = rows.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, words = loaded(shared.value)
        for batch in batches:
            body = batch.column(0)
            raw = [raw_scores(own, words, [zlib.decompress(t.as_py()) for t in body.slice(k, TEXTS)]) for k in range(0, len(body), TEXTS)]
            raw = np.concatenate(raw or [np.zeros(0)]).astype(np.float64).clip(-64, 64)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(raw)], ["lang", "_y", "raw"])

    scored = rows.select("body", "lang", "_y").mapInArrow(judge, "lang string, _y int, raw double")
    return scored.groupBy("lang", "_y", F.floor(F.col("raw") * CELLS).alias("cell")).agg(
        F.avg("raw").alias("raw"), F.count("*").alias("n")).orderBy("lang", "_y", "cell").toArrow()


def loaded(pickled: bytes) -> tuple[Model, Words]:
    """The model and its memory of words, kept by the process from task to task."""
    def load() -> tuple[Model, Words]:
        model = pickle.loads(pickled)
        return model, Words(model)

    return remembered(("toxicity", zlib.crc32(pickled), len(pickled)), load)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``toxic`` (score reaches the threshold of the row's language).

    The score comes from the text alone.  Null and empty texts get the score of no words; a null or unknown language has
    the common threshold.  Columns of ``docs`` with these names are replaced; all others, clashing names or not, stay.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # a few MB: bounded by the vocabulary
    docs = docs.drop("score", "toxic")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, words = loaded(shared.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            pieces = (column.slice(k, TEXTS).to_pylist() for k in range(0, len(column), TEXTS))
            raw = [raw_scores(own, words, [None if t is None else t.encode() for t in piece]) for piece in pieces]
            p = probability(own, np.concatenate(raw or [np.zeros(0, np.float32)]))
            langs = batch.column(batch.schema.get_field_index(lang_col)).to_pylist()
            cut = np.array([own.thresholds.get(x, own.threshold) for x in langs], np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64()), pa.array(p >= cut, pa.bool_())],
                                             [*batch.schema.names, "score", "toxic"])

    results = [StructField("score", DoubleType()), StructField("toxic", BooleanType())]
    return docs.mapInArrow(scored, StructType([*docs.schema.fields, *results]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on all labelled rows and score every row of ``docs``, see :func:`fit` and :func:`score`."""
    return score(docs, fit(docs, labels))
