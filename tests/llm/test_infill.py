import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from viewpulse.llm import infill
from viewpulse.llm.queries import QUERIES

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
pieces = st.lists(st.sampled_from(["a", "word", "é", "漢字", "😀", " ", "  ", "\n", "\t", "\x0b", "\x0e", "\x08", "\x1f", "!", "\x7f", "\xa0",
                                   " ", "abcdefgh", "I)"]), max_size=40).map("".join)


def brute(doc_id, text):
    own = UNIT.findall(text or "")
    h = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(own) + 1), h2 % (len(own) + 1)))
    p, m, s = "".join(own[:a]), "".join(own[a:b]), "".join(own[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return text, len(own), "plain", None, None
    if h4 % 100 < 80:
        return f"<S>{s}<P>{p}<M>{m}", len(own), "spm", len(p), len(m)
    return f"<P>{p}<S>{s}<M>{m}", len(own), "psm", len(p), len(m)


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(pieces, min_size=1, max_size=12), draws=st.integers(0, 2**31))
def test_cuts_against_the_pattern(texts, draws):
    h1 = np.array([(draws * (i + 3)) % 2**32 for i in range(len(texts))])
    h2 = np.array([(draws * (i + 7)) % 2**32 for i in range(len(texts))])
    got = infill.cut_points(pa.array(texts), h1, h2)
    for i, text in enumerate(texts):
        own = UNIT.findall(text)
        a, b = sorted((int(h1[i]) % (len(own) + 1), int(h2[i]) % (len(own) + 1)))
        assert got[:, i].tolist() == [len(own), len("".join(own[:a])), len("".join(own[a:b]))]


def test_marks_find_what_they_count():
    rng = np.random.default_rng(3)
    marked = rng.random(1000) < 0.3
    marks = infill.Marks((marked.astype(np.uint8) * 0x80).view("<u8"))
    assert (marks.rank(np.arange(999)) == np.append(0, np.cumsum(marked))[:999]).all()
    assert (marks.select(np.arange(1, marked.sum() + 1)) == np.flatnonzero(marked)).all()


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_documents_and_back(spark, odd, odd_rows, none):
    more = spark.createDataFrame([(90, "a <P> b c d", 7, "x"), (91, "a <M b> c d <S", 7, "x"), (92, "ends with <", 7, "x")],
                                 "doc_id long, text string, n int, form string")
    cols = ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars"]
    for frame, rows in ((odd, [r[:2] for r in odd_rows]), (more, [r[:2] for r in more.collect()])):
        out = infill.fill_in_middle(frame)
        want = [(i, *brute("" if i is None else i, t)) for i, t in rows]
        assert as_rows(out.select(*cols)) == sorted(want, key=repr)
        back = out.select("doc_id", infill.restored(F.col("text"), F.col("form")))
        assert as_rows(back) == sorted(((i, t) for i, t in rows), key=repr)
    assert infill.fill_in_middle(none).count() == 0
    assert [c for c in infill.fill_in_middle(odd).columns if c not in cols] == [c for c in odd.columns if c not in cols]


def test_settings_change_the_forms(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("some words in a row").alias("text"))
    forms = lambda **s: {r.form: r["count"] for r in infill.fill_in_middle(docs, **s).groupBy("form").count().collect()}
    assert set(forms(plain_percent=100, spm_percent=0)) == {"psm"} and set(forms(plain_percent=0)) == {"plain"}
    assert forms() != forms(seed="43")


@pytest.mark.parametrize("name", ["op12_fill_in_middle"])
def test_query_against_brute_force(spark, sf, name):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES[name](spark, sf).collect():
        out, *rest = brute(r.doc_id, texts[r.doc_id])
        assert [r.n, r.form, r.prefix_chars, r.middle_chars] == rest
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
