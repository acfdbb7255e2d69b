import random

import pytest
from pyspark.sql import functions as F

VOCABULARY = [a + b for a in "ba ce di fo gu ha je ki lo mu".split() for b in "ra se ti no pu la me vi zo xu".split()]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def edited(text, seed, changes):
    r, w = random.Random(seed), text.split()
    for k in r.sample(range(len(w)), changes):
        w[k] = f"new{seed}x{k}"
    return " ".join(w)


def document_rows():
    """(doc_id, text, source): nulls, blanks, short and long texts, copies, near copies, passages, repeated rows."""
    base, passage = prose(1, 200), prose(2, 40)
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t\n", None), (4, "one two", "a"), (5, "ONE Two", "b"), (6, "one", None),
            (10, base, "a"), (11, base, "a"), (11, base, "a"), (12, base.replace(" ", "\n"), "b"),
            (20, prose(3, 20000), "c"), (None, prose(4, 50), "a"), (None, base, None),
            (30, prose(5, 30) + " " + passage + " " + prose(6, 30), "a"), (31, passage, "b"),
            (32, prose(7, 9) + " " + passage + " " + passage, "c"), (33, "x y " * 40, "a"), (34, "x y " * 30, "a"),
            (35, "é ü " * 20 + "ß", "b"), (36, "nul\x00byte " * 5, "b")]
    rows += [(100 + k, edited(base, k, k % 9), "d") for k in range(60)]
    rows += [(200 + k, prose(100 + k, 60 + k), f"s{k % 5}") for k in range(40)]
    return rows


@pytest.fixture(scope="session")
def document_list():
    return document_rows()


@pytest.fixture(scope="session")
def documents(spark, document_list):
    df = spark.createDataFrame([(d, t, "en", s, len(t) if t else None) for d, t, s in document_list],
                               "doc_id long, text string, lang string, source string, n_chars long")
    clash = ("n rep size copies target component a b node label region h w seeds owned first_id score predicted "
             "_x word block blocks frac").split()
    for k, name in enumerate(clash):
        df = df.withColumn(name, F.lit(k))
    return df.repartition(5).cache()


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.limit(0)
