import pickle
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from viewpulse.llm import packing
from viewpulse.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


TEXTS = ["It's DON'T we'll, and. (x) 12345 a,b", "Éèñ Ünïcödé İİ İ ﬁ Ⅳ ½", "é. é' ...! ?!a", "日本語 текст ΑΣ Σ ΣΑΣ.", "a b c\x1fd",
         "<|endoftext|> <|ENDOFTEXT|>x <| startoftext|>", "", " \n", "ǅ ʰa ß ẞ.", "it'sall 're're!'s"]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_of_a_text_are_those_of_its_words(tokenizer, text):
    ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert packing.WordIds(tokenizer_path()).of_text(text.encode()) == ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30) | st.text("aAéÉ.,'s !?́̇İ1\n", max_size=30))
def test_ids_of_any_text(tokenizer, text):
    ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert packing.word_ids(tokenizer_path()).of_text(text.encode()) == ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1024), min_size=1, max_size=120), st.integers(1, 12))
def test_differencing_places_every_item(sizes, k):
    window = packing.differencing(np.array(sizes), k)
    assert len(window) == len(sizes) and 0 <= window.min() and window.max() < k
    full = packing.near_equal_windows(np.array(sizes), 1024)
    assert np.bincount(full, sizes).max() <= 1024


def test_differencing_is_near_equal():
    sizes = np.random.default_rng(1).integers(1, 1000, 600)
    sums = np.bincount(packing.differencing(sizes, 60), sizes)
    assert sums.max() - sums.min() < 0.02 * sums.mean()
    assert sorted(np.bincount(packing.differencing(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])) == [14, 16]


def check(pieces, rows, tokenizer, capacity=4096):
    """Every id of every row lies in exactly one piece, sequences are gapless and not too long."""
    streams = Counter()
    for i, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        streams[i, np.array(ids, "<u4").tobytes()] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
        assert r.length == len(r.ids) // 4
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    copies = {i: [s for (d, s), n in streams.items() if d == i for _ in range(n)] for i, _ in streams}
    assert set(by_doc) == set(copies)
    for i, own in by_doc.items():
        assert sum(r.length for r in own) * 4 == sum(map(len, copies[i]))
        assert Counter((r.start, bytes(r.ids), r.doc_tokens) for r in own) <= Counter(
            (r.start, s[4 * r.start:4 * (r.start + r.length)], len(s) // 4) for s in copies[i] for r in own)
    return sum(len(s) // 4 * n for (_, s), n in streams.items()) / (len(by_sequence) * capacity)


def test_odd_rows(odd, odd_rows, none, tokenizer):
    check(packing.pack(odd, tokenizer_path(), capacity=256, largest=64, shard=16).collect(), odd_rows, tokenizer, 256)
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_sample_documents(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    fill = check(packing.pack(docs, tokenizer_path()).collect(), docs.select("doc_id", "text").collect(), tokenizer)
    assert fill > 0.95
    first = packing.digest(packing.pack(docs, tokenizer_path())).collect()
    assert first == packing.digest(packing.pack(docs, tokenizer_path())).collect()
    ids = {r.doc_id: r.ids_crc32 for r in first if r.length == r.doc_tokens}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for i, crc in list(ids.items())[:20]:
        assert crc == zlib.crc32(np.array([*tokenizer.encode(texts[i], add_special_tokens=False).ids, 2], "<u4").tobytes())


def test_a_process_keeps_the_memory_of_one_operator():
    """A worker that scored texts before must not hold their words besides those of the tokenizer."""
    from viewpulse.llm import common, toxicity

    model = toxicity.new_model(np.zeros(0, np.int64))
    first = toxicity.loaded(pickle.dumps(model))
    assert toxicity.loaded(pickle.dumps(model)) is first
    known = packing.word_ids(tokenizer_path())
    assert packing.word_ids(tokenizer_path()) is known
    assert list(common._REMEMBERED.values()) == [known]


@pytest.mark.parametrize("text", ["ein.*** et### rarrbo$$$ x<y>", "x=\u0338 a>\u0338 a~ é|é É}", "it's' don't'. l'- a-'s a-s (b)[c]", "ΑΣ~ Σ@ e\u0301* 1$ ½%"])
def test_punctuation_behind_a_letter_is_a_run_of_its_own(tokenizer, text):
    ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert packing.WordIds(tokenizer_path()).of_text(text.encode()) == ids


def test_common_words_are_not_forgotten_among_rare_ones(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 10)
    known, looked_up = packing.WordIds(tokenizer_path()), Counter()
    model = known.model

    class Counted:
        def tokenize(self, run):
            looked_up[run] += 1
            return model.tokenize(run)

    known.model = Counted()
    rare = [f"rare{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(60)]
    text = " ".join(f"the {w}" for w in rare)
    assert known.of_text(text.encode()) == known.encode(text)
    assert looked_up["the"] == 1 and len(looked_up) == 61
    assert len(known) + len(known.older) <= 2 * 10 + 1


def test_words_remembered_stay_within_their_bound(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 10)
    known = packing.WordIds(tokenizer_path())
    words = [f"word{i}" for i in range(40)]
    got = known.of_text(" ".join(words).encode())
    assert got == known.encode(" ".join(words)) and len(known) <= 10 + 1
