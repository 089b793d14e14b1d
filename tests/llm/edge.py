"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

random.seed(5)
LONG = " ".join(random.choice(["alpha", "beta", "gamma", "delta", "épsilon"]) + str(random.randint(0, 999))
                for _ in range(30_000))
ROWS = [
    (None, "a text without an id, of a few words more", None, None, None),
    (1, None, "en", "s1", 0), (2, "", "en", None, 0), (3, "x", None, "s1", 1),
    (4, LONG, "en", "s2", len(LONG)), (5, LONG, "en", "s2", len(LONG)),
    (6, "the same row twice, word for word", "en", "s1", 33), (6, "the same row twice, word for word", "en", "s1", 33),
    (7, "one id, two texts: the first", "de", "s1", 28), (7, "one id, two texts: the second", "de", "s1", 29),
    (8, " \t\n ", "fr", "s3", 4), (9, "12 34 %%% !!", "fr", "s3", 12), (10, "Ünï 中文 \U0001F600 é", "de", "s3", 12),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCS)


def clashing(df, *names):
    """``df`` with extra columns named like the operator's own."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("theirs") for n in names})


def rows(df, *cols):
    got = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in got.collect()), key=repr)
