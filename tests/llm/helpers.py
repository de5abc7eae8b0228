"""Rows shared by the tests of the operators."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=""):
    """rows: (doc_id, text, source)."""
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.selectExpr("*", *extra.split(";")) if extra else df


def prose(seed, n, words=60):
    """A text of n words drawn from a vocabulary of invented words."""
    import random

    rnd = random.Random(seed)
    vocabulary = [a + b for a in ("th", "er", "on", "an", "re", "he", "in", "ed") for b in ("ing", "ly", "or", "es", "at", "is", "ou", "ha")]
    return " ".join(rnd.choice(vocabulary[:words]) for _ in range(n))
