import random

import pytest
from pyspark.sql import functions as F

#: Names that the operators use inside; inputs may have them as further columns.
CLASHES = ["id", "n", "norm", "salt", "digest", "least", "keep_id", "cls", "code", "bucket", "skey", "start", "slot", "part",
           "local", "x", "y", "host", "lead", "slice", "th", "numbers", "paragraph", "words", "family", "_keep", "h", "size"]


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 6))) for _ in range(n))


def corpus():
    """Rows (doc_id, text, lang, source): copies, near copies, shared passages and odd cases."""
    rng = random.Random(7)
    base = [words(rng, n) for n in (60, 200, 40, 15, 90)]
    passage = words(rng, 55)
    rows = []
    for i, t in enumerate(base):
        w = t.split()
        near = w[:]
        near[len(w) // 2] = "changed"
        rows += [(10 * i, t, "en", f"s{i % 3}"), (10 * i + 1, t, "en", "s0"), (10 * i + 2, " ".join(near), "en", "s1"),
                 (10 * i + 3, t.replace(" ", " \t\n", 5), "de", None), (10 * i + 4, words(rng, 30) + " " + passage + " " + words(rng, 9), "fr", "é")]
    rows += [(100, None, None, None), (101, "", "en", "s0"), (102, " \t\n ", "en", "s0"), (103, "one", "en", "s0"), (104, "one", "en", "s9"),
             (105, "One two Three", "en", "s2"), (106, "one TWO three", "en", "s2"), (107, words(rng, 6000), "en", "s0"),
             (108, "é", "fr", "s1"), (109, "日本語 テキスト 😀", "ja", "s1"), (110, "x" * 5000, "en", "s1")]
    rows += [(0, base[0], "en", "s0"), (0, base[0], "en", "s0")]            # repeated rows
    rows += [(200 + i, "copy of " + base[2], "en", "s0") for i in range(40)]   # a group of copies
    rows += [(300 + i, f"v{i} " + base[1], "en", "s0") for i in range(25)]     # a group of near copies
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def unique_rows(rows):
    """One row per id."""
    return list({r[0]: r for r in rows}.values())


def frame(spark, rows):
    df = spark.createDataFrame([(i, t, l, s, len(t or "")) for i, t, l, s in rows],
                               "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.select("*", *[F.lit(f"clash-{c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="session")
def unique_docs(spark, unique_rows):
    return frame(spark, unique_rows)


@pytest.fixture(scope="session")
def null_ids(spark):
    rows = [(None, "alpha beta gamma delta epsilon zeta", "en", "a"), (None, "alpha beta gamma delta epsilon zeta", "en", "a"),
            (5, "alpha beta gamma delta epsilon zeta", "en", "a"), (None, None, None, None), (6, "other words", "en", None)]
    return frame(spark, rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
