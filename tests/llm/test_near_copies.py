"""SimHash classes, repeated passages, connected components."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from viewpulse.llm import components, near_copies, simhash, substring


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps, radius=3):
    values = np.array(fps, np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None]) <= radius
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None], len(fps)).min(1)
        if (new == label).all():
            return label
        label = new


def test_classes_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    fps = [brute_fingerprint(t) for _, t in rows]
    want = {i: (f"{fp:016x}", rows[k][0]) for (i, _), fp, k in zip(rows, fps, brute_classes(fps), strict=True)}
    got = simhash.simhash_classes(docs).withColumn("text", simhash.fingerprint_text(simhash.F.col("fp")))
    assert {r.id: (r.text, r.class_id) for r in got.collect()} == want


def test_classes_of_odd_rows(odd, odd_rows, none):
    got = simhash.simhash_classes(odd).collect()
    want = [(i, brute_fingerprint(t)) for i, t, *_ in odd_rows]
    assert Counter((r.id, r.fp % (1 << 64)) for r in got) == Counter(want)
    assert {r.class_id for r in got if r.id in (3, 4, 5)} == {3} and {r.class_id for r in got if r.id in (6, 7)} == {6}
    kept = simhash.first_of_each(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter(r.id for r in got if r.id == r.class_id)
    assert ids[3] == 1 and not ids[4] and not ids[7] and ids[6] == 1
    assert simhash.simhash_classes(none).count() == 0 and simhash.first_of_each(none).count() == 0


@pytest.mark.parametrize("cell", [4, 4096])
def test_links_of_a_crowded_bucket(spark, cell):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base:  # chains of small changes around few centres
        x = int(b)
        for _ in range(60):
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), cell=cell)
    roots = {r.node: r.root for r in components.components(edges).collect()}
    got = [roots.get(x, x) for x in signed]
    want = brute_classes(fps)
    assert len({*zip(got, want.tolist(), strict=True)}) == len(set(got)) == len(set(want.tolist()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, (1 << 64) - 1) | st.sampled_from([0, 1, 3, 7, 15, 31, (1 << 64) - 1]), min_size=1,
                         max_size=90), min_size=1, max_size=6))
def test_lanes_against_brute_force(groups):
    fps = np.array([x for g in groups for x in g], np.uint64)
    starts = np.cumsum([0, *map(len, groups)])[:-1]
    want = np.concatenate([brute_classes(g) + s for g, s in zip(groups, starts, strict=True)])
    assert (simhash.close_lanes(fps, starts) == want).all()


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 9), (9, 8), (3, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {8: 7, 9: 7}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_take_few_rounds(spark, monkeypatch):
    """Tasks tie what they read to stars first, so that the driver runs few jobs, long paths or not."""
    kept, labels = components.stored, []
    monkeypatch.setattr(components, "stored", lambda df, label: labels.append(label) or kept(df, label))
    edges = spark.createDataFrame([(i, i + 1) for i in range(400)] + [(i, i + 1) for i in range(0, 400, 7)], "a long, b long")
    got = components.components(edges.repartition(4)).collect()
    assert sorted((r.node, r.root) for r in got) == [(i, 0) for i in range(1, 401)]
    assert len(labels) <= 8


@pytest.mark.parametrize("block", [3, 1 << 18])
def test_tied_edges_keep_components(monkeypatch, block):
    monkeypatch.setattr(components, "BLOCK", block)
    rng = np.random.default_rng(4)
    ends = rng.integers(0, 300, (250, 2))

    def classes(edges):
        root = np.arange(300)
        for _ in range(300):
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        return root.tolist()

    batches = [components.pa.RecordBatch.from_arrays([components.pa.array(x) for x in part.T], ["a", "b"])
               for part in np.array_split(ends, 60)]
    found = [(a, b) for batch in components._tied(iter(batches)) for a, b in zip(*(c.to_pylist() for c in batch.columns))]
    assert all(a > b for a, b in found) and classes(found) == classes(ends.tolist())
    if block > 250:
        assert len({a for a, _ in found}) == len(found) and not {a for a, _ in found} & {b for _, b in found}


def brute_passages(rows, window):
    """Per row: words kept, words removed.  rows: (order, words)."""
    seen = {}
    for order, words in rows:
        for k in range(len(words) - window + 1):
            seen[tuple(words[k:k + window])] = min(order, seen.get(tuple(words[k:k + window]), order))
    for order, words in rows:
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if seen[tuple(words[k:k + window])] < order:
                gone[k:k + window] = [True] * window
        yield [w for w, g in zip(words, gone, strict=True) if not g], sum(gone)


def check_passages(frame, rows, window):
    order = [(2**63 if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    want = Counter((i, " ".join(kept), len(kept) + n, n) for (i, _), (kept, n) in zip(rows, brute_passages(order, window), strict=True))
    got = substring.dedupe_passages(frame, window=window)
    assert got.columns == [*[c for c in frame.columns if c not in ("n_words", "n_removed")], "n_words", "n_removed"]
    words = lambda t: " ".join(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, words(r.text), r.n_words, r.n_removed) for r in got.collect()) == want


def test_passages_of_odd_rows(odd, odd_rows, none):
    check_passages(odd, [r[:2] for r in odd_rows], 50)
    assert substring.dedupe_passages(none).count() == 0


def test_passages_of_sample_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check_passages(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 50)


def test_passages_in_other_surroundings(rows, monkeypatch):
    """Few different words, so that passages meet at every offset; small shards and crowds."""
    monkeypatch.setattr(substring, "SHARD", 40)
    monkeypatch.setattr(substring, "MEET", 2)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 50, 400)]
    data = []
    for i in range(40):
        a, b = sorted(rng.integers(0, 400, 2))
        words = [f"v{x}" for x in rng.integers(0, 50, rng.integers(0, 40))] + base[a:b]
        data.append((int(rng.integers(0, 30)), " ".join(words)))
    check_passages(rows("doc_id long, text string", data), data, 50)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=25), max_size=4), st.lists(st.sampled_from("abcd"), max_size=40))
def test_matching_statistics(passages, words):
    known = {tuple(p[i:i + 4]) for p in passages for i in range(len(p) - 3)}
    covered = {i + k for i in range(len(words) - 3) if tuple(words[i:i + 4]) in known for k in range(4)}
    spans = substring.Automaton(passages).spans(words, 4)
    assert {i for a, b in spans for i in range(a, b)} == covered
    assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_pipeline_links_by_fingerprints(spark, monkeypatch):
    """Without any MinHash bucket, copies whose fingerprints are close are still found, and the shingles still decide."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 400)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(10 + i, t + " more") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [near_copies.shingles(t.encode()) for _, t in rows]
    fps = [near_copies.fingerprint(s) for s in sets]
    for own, fp in zip(sets, fps, strict=True):
        want = sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in own) > len(own))
        assert fp % (1 << 64) == want
    near = [a for a in range(6) if ((fps[a] ^ fps[6 + a]) % (1 << 64)).bit_count() <= 3]
    assert len(near) >= 4
    nodes = spark.createDataFrame([(i, fp, len(s), [k * 100 + i]) for k, (i, fp, s) in enumerate(zip(range(12), fps, sets))],
                                  "node long, fp long, n long, bands array<long>").withColumn("sketch", simhash.F.lit(b""))
    plain = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "node long, text string").withColumn(
        "text", simhash.F.col("text").cast("binary"))
    got = {(r.a, r.b) for r in near_copies.near_links(nodes, lambda ends: plain.join(ends, "node")).collect()}
    assert got == {(a, 6 + a) for a in near}
    kept = {r.doc_id for r in near_copies.first_of_each(frame).collect()}
    assert kept == set(range(6))
