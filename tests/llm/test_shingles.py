"""Near copies of the pipeline by five-word shingles."""

import numpy as np
import pytest

import corpus_pipeline
from viewpulse.llm import near_copies


def brute_shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_kept(texts):
    """Smallest index of every component of pairs at 0.8 or more."""
    sets = [brute_shingles(t) for t in texts]
    near = [[5 * len(x & y) >= 4 * len(x | y) for y in sets] for x in sets]
    label = list(range(len(texts)))
    while (new := [min(label[j] for j in range(len(texts)) if near[i][j]) for i in range(len(texts))]) != label:
        label = new
    return {i for i in range(len(texts)) if label[i] == i}


def edited(rng, words, n):
    """``n`` spread words replaced: each takes five shingles of the text with it."""
    out = list(words)
    for i in range(n):
        out[int((i + 0.5) * len(out) / n)] = f"new{rng.integers(1 << 40)}"
    return out


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(11)
    texts = []
    for k in range(40):
        words = [f"w{x}" for x in rng.integers(0, 5000, int(rng.integers(200, 800)))]
        texts.append(" ".join(words))
        for share in (0.005, 0.01, 0.02, 0.0222, 0.03, 0.05):  # similarity about 0.95, 0.9, 0.82, 0.8, 0.74, 0.6
            texts.append(" ".join(edited(rng, words, max(1, int(share * len(words))))))
    return texts


def test_planted_near_copies(rows, planted):
    frame = rows("doc_id long, text string", list(enumerate(planted)))
    got = corpus_pipeline.near_dedup(frame.sparkSession, frame, "")
    assert sorted(r.doc_id for r in got.collect()) == sorted(brute_kept(planted))


def test_exact_limit(rows):
    """40 shingles of 50 in common are enough, 39 of 50 are not."""
    words = [f"a{i}" for i in range(49)]
    data = [(1, " ".join(words)), (2, " ".join([*words[:44], *(f"b{i}" for i in range(5))])),
            (3, "\n".join(words).upper())]
    assert near_copies.alike(np.arange(45, dtype=np.uint64), np.arange(5, 50, dtype=np.uint64))
    assert not near_copies.alike(np.arange(44, dtype=np.uint64), np.arange(5, 50, dtype=np.uint64))
    got = near_copies.first_of_each(rows("doc_id long, text string", data))
    assert {r.doc_id for r in got.collect()} == {1 + i for i in brute_kept([t for _, t in data])}


def test_large_group_in_small_cells(rows, monkeypatch):
    """A chain of copies, each edited a little more, in cells far smaller than its buckets."""
    monkeypatch.setattr(near_copies.near_links, "__defaults__", (8,))
    rng = np.random.default_rng(3)
    words, texts = [f"w{x}" for x in rng.integers(0, 5000, 300)], []
    for _ in range(60):
        texts.append(" ".join(words))
        words = edited(rng, words, int(rng.integers(3, 9)))
        rng.shuffle(texts)
    got = near_copies.first_of_each(rows("doc_id long, text string", list(enumerate(texts))))
    assert {r.doc_id for r in got.collect()} == brute_kept(texts)


def test_large_group_below_the_limit(rows, monkeypatch):
    """Copies of one text that are a little less alike than the limit: rows of their buckets are stored, never their pairs."""
    rng, kept, sizes = np.random.default_rng(6), near_copies.stored, []

    def counted(df, label):
        found = kept(df, label)
        sizes.append((label, found.count()))
        return found

    monkeypatch.setattr(near_copies, "stored", counted)
    words = [f"w{x}" for x in rng.integers(0, 5000, 400)]
    texts = [" ".join(edited(rng, words, 12)) for _ in range(220)]
    frame = rows("doc_id long, text string", list(enumerate(texts)))
    assert {r.doc_id for r in near_copies.first_of_each(frame).collect()} == set(brute_kept(texts))
    assert all(n <= near_copies.BANDS * len(texts) for _, n in sizes), sizes


def test_odd_rows(odd, none):
    got = near_copies.first_of_each(odd)
    assert got.columns == odd.columns
    ids = [r.doc_id for r in got.collect()]
    assert 3 in ids and 4 not in ids and 5 not in ids and 6 in ids and 7 not in ids
    assert near_copies.first_of_each(none).count() == 0
