import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from viewpulse.llm import audit
from viewpulse.llm.infill import flat

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.lists(st.sampled_from(["a", "b", "Ab", "AB", "é", "éa", "漢", "😀", "#", "a|", " ", "\n", "\x0e", "longerthaneight",
                                           "longerthaneighu", "x" * 300, "x" * 299 + "y"]), max_size=30).map("".join),
                 min_size=1, max_size=8)


def brute_counts(text):
    words = WORD.findall(text or "")
    return [len(words), len(set(words)), sum("A" <= c <= "Z" for c in text or ""), len(text or ""), sum(c in "#$%&*|" for c in text or "")]


def brute(docs, labels):
    """Rows as a Counter, by going through all orders for every document."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    order_of = lambda i: float("inf") if i is None else i
    least = {}
    for i, text, _ in docs:
        least[text or ""] = min(order_of(i), least.get(text or "", float("inf")))
    fails, found = [], Counter()
    for i, text, part in docs:
        w, d, c, n, s = brute_counts(text)
        own = {"A": w < 200, "B": 100 * d < 50 * w, "C": 100 * c > 3 * n, "D": s > 0, "E": least[text or ""] < order_of(i)}
        fails.append((part or "", {f for f in own if own[f]}, i in good, i in toxic))
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    out, shapley = {}, Counter()
    for part in {f[0] for f in fails}:
        for order in permutations("ABCDE"):
            for step, f in enumerate(order):
                row = Counter()
                for p, own, g, t in fails:
                    if p != part:
                        continue
                    gone, here = bool(own & set(order[:step])), f in own
                    row["kept"] += not gone and not here
                    row["removed"] += here and not gone
                    row["redundant"] += here and gone
                    row["unique_fails"] += own == {f}
                    row["good_lost"] += here and not gone and g
                    row["toxic_lost"] += here and not gone and t
                out[part, "".join(order), step + 1] = row
                shapley[part, f] += row["removed"]
    for (part, order, step), row in out.items():
        row["shapley"] = shapley[part, order[step - 1]]
        found[(part, order, step, *(row[n] for n in names))] += 1
    return found


@settings(max_examples=60, deadline=None)
@given(own=texts)
def test_transducer_and_table_against_python(own):
    assert audit.counts(*flat(pa.array(own))).T.tolist() == [brute_counts(t) for t in own]


def test_hash_table_survives_equal_hashes(monkeypatch):
    monkeypatch.setattr(audit.Spans, "hashes", lambda self: np.zeros(len(self.at), np.uint64))
    own = ["a b c a b", "a", "", "b a " + "z" * 300 + " " + "z" * 300]
    assert audit.counts(*flat(pa.array(own))).T.tolist() == [brute_counts(t) for t in own]


def test_odd_documents(spark, odd, odd_rows, none):
    labels = [(1, 1, 0), (2, 0, 1), (7, 1, 1), (7, 0, 0), (10, None, 1), (None, 1, 1), (99, 1, 1), (8, 1, None)]
    table = spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, toxic int, text string")
    got = audit.audit(odd, table)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
                           "shapley"]
    assert Counter(tuple(r) for r in got.collect()) == brute([r[:3] for r in odd_rows], [x for x in labels if x[0] is not None])
    assert audit.audit(none, table).count() == 0
    assert audit.audit(odd, table.where("false")).agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_long_texts_in_several_steps(spark, monkeypatch):
    monkeypatch.setattr(audit, "TOGETHER", 64)
    own = ["word " * n + "A#" for n in range(40)] + ["", "one"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(own)], "i int, text string").coalesce(1)
    got = rows.select("i", audit.text_counts(F.col("text")).alias("c")).collect()
    assert {r.i: list(r.c) for r in got} == {i: brute_counts(t) for i, t in enumerate(own)}
