"""Small tables with every odd case."""

import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that no operator asks for, named like what some of them return.
CLASHES = {
    "score": "double", "kept": "boolean", "rejected": "boolean", "n_words": "long", "ids": "string",
    "block": "string", "place": "int", "at": "int", "bits": "string", "check": "long", "n_tokens": "string",
    "component": "string", "kept_text": "string", "n_removed": "string", "row": "string", "predicted": "string",
}


def prose(rnd, n, words=400):
    return " ".join(f"w{rnd.randrange(words)}" for _ in range(n))


def odd_documents():
    """(doc_id, text, lang, source, n_chars): nulls everywhere, empty, blank and long texts, exact
    and near copies, repeated rows."""
    rnd = random.Random(3)
    base, long = prose(rnd, 60), prose(rnd, 30_000)
    texts = [
        None, "", " \t\r\n\v\f ", "one", "# $ % word & more | < > words here to be counted now ok",
        base, base, base.replace("w1", "W1"), base + " tail", "x " * 500, "éà ñ " * 30 + "　wide　 nb sp",
        "line one two three four five\n" * 20, long, long + " end", prose(rnd, 80), prose(rnd, 80), "🙂" * 100,
    ]
    rows = [
        (i, t, ("en", "de", None)[i % 3], ("a", "b", None)[i % 4 % 3], None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    rows += [rows[5], rows[5], (None, base, "en", "a", 1), (None, base, None, None, None), (-7, "below zero", "en", "a", 10)]
    return rows


def frame(spark, rows, clashes=True):
    docs = spark.createDataFrame(rows, DOCUMENT)
    if clashes:
        from pyspark.sql import functions as F

        docs = docs.withColumns({c: F.lit(True if t == "boolean" else 7).cast(t) for c, t in CLASHES.items()})
    return docs


@pytest.fixture(scope="session")
def odd_rows():
    return odd_documents()


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return frame(spark, odd_rows)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])
