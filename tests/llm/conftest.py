import pytest

#: Columns of documents, and some with names that operators use inside.
ODD = ("doc_id long, text string, lang string, source string, n_chars long, id string, th long, pos int, line string, key string, "
       "h1 long, ord long, n_words string, score string, _of int, _drop string, slot int, first string, anchors string")
_EXTRA = ("x", 1, 2, "l", "k", 3, 4, "w", "s", 5, "d", 6, "f", "a")
_LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
_PASSAGE = " ".join(f"shared{i}" for i in range(60))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source): nulls, empty and very long texts, ties and repeated rows."""
    return [
        (1, "First line here\nsecond line here\nFirst line here", "en", "a"),
        (2, "  FIRST line here \nshort\nonly in two, and long", "en", "a"),
        (3, None, None, None), (4, "", "en", "b"), (5, " \n\t ", "en", None),
        (6, _LONG, "de", "b"), (7, _LONG, "de", "b"), (7, _LONG, "de", "b"),
        (8, f"before {_PASSAGE} after the passage", "en", "c"), (9, f"other words {_PASSAGE} in front", "en", "c"),
        (10, _PASSAGE, "en", "c"), (10, "another text of the same id", "en", "c"),
        (None, f"no id {_PASSAGE}", "en", "a"), (None, "First line here\nno id either", None, "a"),
        (11, "mail to a.b@mail.example.com or call +1 (583) 555-8469", "fr", "é"), (12, "one", "fr", "Z"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame([(*r, 7, *_EXTRA) for r in odd_rows], ODD).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], ODD)
