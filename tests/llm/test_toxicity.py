import pickle
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

from viewpulse.llm import toxicity


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for i in range(900):
        words = [f"w{x}" for x in rng.integers(0, 400, rng.integers(5, 60))]
        bad = i % 5 == 0
        for _ in range(3 * bad):
            words[rng.integers(0, len(words))] = "vile" + "abcdefgh"[rng.integers(0, 8)] + "xyz"[rng.integers(0, 3)]
        docs.append((i, " ".join(words), "en" if i % 2 else "de"))
        labels.append((i, int(bad)))
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string"),
            spark.createDataFrame([*labels, (None, 1), (5000, 1), (3, None)], "doc_id long, toxic int"), dict(labels))


def test_held_out_accuracy(corpus):
    docs, labels, truth = corpus
    model = toxicity.fit(docs, labels)
    got = [r for r in toxicity.score(docs, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in got]) > 0.95
    assert set(model.thresholds) <= {"en", "de"} and all(0 < x < 1 for x in model.thresholds.values())


def test_only_other_rows_are_learnt_from(corpus):
    docs, labels, _ = corpus
    rows, counts = toxicity.labelled_sample(docs, labels, per_class=50)
    assert len(rows) == 100 and sum(counts.values()) > 600
    assert all(zlib.crc32(str(r[0]).encode()) % 5 for r in rows)
    assert rows == toxicity.labelled_sample(docs.repartition(3), labels, per_class=50)[0]


def test_score_sees_the_whole_text_and_nothing_else(corpus, spark):
    docs, labels, _ = corpus
    model = toxicity.fit(docs, labels)
    long = " ".join(["w1"] * 70_000)
    texts = [long, f"{long} vileax vilebx vilecx", "vileax vilebx vilecx " + long]
    frame = spark.createDataFrame([(i, t, lang, 1, "s") for i, t in enumerate(texts) for lang in ("en", None, "de")],
                                  "doc_id long, text string, lang string, toxic int, score string")
    got = toxicity.score(frame, model)
    assert got.columns == ["doc_id", "text", "lang", "score", "toxic"]
    scores = {}
    for r in got.collect():
        scores.setdefault(r.doc_id, set()).add(round(r.score, 9))
    assert all(len(s) == 1 for s in scores.values())
    assert max(scores[0]) < 0.5 < min(scores[1] | scores[2])


def test_odd_rows(odd, odd_rows, none, corpus, spark):
    _, labels, _ = corpus
    got = toxicity.toxicity(odd, labels)
    rows = got.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((i, t) for i, t, *_ in odd_rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(none, labels).count() == 0
    nothing = toxicity.toxicity(odd, spark.createDataFrame([], "doc_id long, toxic int"))
    assert nothing.where("toxic or score >= 0.5").count() == 0


def test_gradient():
    """One step on a text with a single telling word lowers the loss."""
    texts = [b"good day all", b"vile day all", b"good night all", b"vile night all"] * 4
    labels = np.array([0, 1, 0, 1] * 4, np.float32)
    model = toxicity.train(texts, labels, steps=60, batch=8)
    raw = toxicity.raw_scores(model, toxicity.Words(model), texts)
    assert raw[labels == 1].min() > raw[labels == 0].max()


def learnt_from(i):
    return zlib.crc32(str(i).encode()) % 5 != 0 and zlib.crc32(b"apart%d" % i) % 4 != 0


def test_all_labelled_rows_are_counted(spark):
    """Words of five labelled documents each: a sample of 3,000 rows of a class misses some of them."""
    own = [i for i in range(9000) if i % 40 and learnt_from(i)][:200 * 5 * 5:5]
    rare = {i: f"rareword{k % 200:03d}" for k, i in enumerate(own)}
    docs = [(i, f"{'vile' if i % 40 == 0 else 'good'} day {rare.get(i, '')}", "en") for i in range(9000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 40 == 0)) for i in range(9000)], "doc_id long, toxic int")
    model = toxicity.fit(frame, labels)
    words = [f"rareword{k:03d}".encode() for k in range(200)]
    assert Counter(rare.values()) == {w.decode(): 5 for w in words}
    whole = np.array([toxicity.parts(w)[0] for w in words])
    assert (model.rows(whole) < len(model.keys)).all()
    raw = toxicity.raw_scores(model, toxicity.Words(model), [b"vile day", b"good day"])
    assert raw[0] > raw[1]


def test_shards_give_one_model(corpus, monkeypatch):
    docs, labels, truth = corpus
    monkeypatch.setattr(toxicity, "SHARD", 50)  # more shards than one task adds up
    monkeypatch.setattr(toxicity, "ROUNDS", 12)
    model = toxicity.fit(docs, labels)
    got = [r for r in toxicity.score(docs, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in got]) > 0.9


def test_parameters_come_in_blocks(spark, monkeypatch):
    """What the driver or a sum takes in as one value does not grow with the vocabulary."""
    words = [f"{a}{b}{c}zz{c}{a}{b}" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"]
    docs = [(i, " ".join(words[(i * 37) % 1000:][:200]) + (" vile" if i % 3 == 0 else ""), "en") for i in range(240)]
    rows = spark.createDataFrame([(i, zlib.compress(t.encode()), "en", int(i % 3 == 0), i % 20) for i, t, _ in docs],
                                 "_id long, body binary, lang string, _y int, shard int")
    known = toxicity.Texts(t.encode() for _, t, _ in docs)
    keys = known.documents()[0]
    state, taken = toxicity.new_state(keys), []

    def loads(value):
        taken.append(len(value))
        return pickle.loads(value)

    monkeypatch.setattr(toxicity, "pickle", SimpleNamespace(dumps=pickle.dumps, loads=loads))
    got = toxicity.one_round(rows, 20, keys, state, 1, 0)
    assert len(keys) > 2048 and max(taken) < 2048 * (2 * 4 * toxicity.DIM + 8) + 10_000 < state["table"].nbytes * 2
    # the mean of the shards that moved a row, and what no shard moved as it was
    each = []
    for shard in range(20):
        own = [(i, t) for i, t, _ in docs if i % 20 == shard]
        new = {k: v.copy() for k, v in state.items()}
        toxicity.descend(new, keys, toxicity.Texts(t.encode() for _, t in own), np.array([i % 3 == 0 for i, _ in own], np.float32), 1,
                         seed=7 + shard)
        each.append(new)
    moved = np.array([(new["seen_table"] != state["seen_table"]).any(1) for new in each])
    want = (np.array([new["table"] for new in each]) * moved[:, :, None]).sum(0) / np.maximum(moved.sum(0), 1)[:, None]
    assert np.allclose(got["table"], np.where(moved.any(0)[:, None], want, state["table"]), atol=1e-5)
    assert np.allclose(got["filters"], np.mean([new["filters"] for new in each], 0), atol=1e-5)
    last = toxicity.one_round(rows, 20, keys, state, 1, 0, last=True)
    assert np.array_equal(last["table"], got["table"]) and np.array_equal(last["out"], got["out"])


def test_common_words_are_not_forgotten_among_rare_ones(monkeypatch):
    monkeypatch.setattr(toxicity, "REMEMBERED", 8)
    keys = np.unique([h for w in (b"the", b"rare") for h in toxicity.parts(w)])
    model, looked_up = toxicity.new_model(keys), Counter()
    parts = toxicity.parts
    monkeypatch.setattr(toxicity, "parts", lambda word: looked_up.update([word]) or parts(word))
    words = toxicity.Words(model)
    for i in range(60):
        line = [b"the", b"rare%d" % i, b"rarest%d" % i]
        got = words.look_up(line)
        assert np.array_equal(got, np.array([model.table[model.rows(np.array(parts(w)))].sum(0) for w in line]))
    assert looked_up[b"the"] == 1 and len(words.numbers) + len(words.older) <= 2 * (8 + 3)
