"""Small tables with the hard cases."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim minim veniam quis nostrud".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def edited(text, every, mark="zzz"):
    """Every so many words replaced."""
    return " ".join(f"{mark}{i}" if i % every == every - 1 else w for i, w in enumerate(text.split()))


def hard_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    long = prose(1, 30_000)
    rows = [
        (1, None, "en", "src0", 0),
        (2, "", "en", "src0", 0),
        (3, " \n\t ", None, "src1", 4),
        (None, prose(2, 80), "de", None, None),
        (4, long, "fr", "src2", len(long)),
        (5, prose(3, 120), "en", "src0", 1),
        (6, prose(3, 120), "es", "src3", 1),
        (6, prose(3, 120), "es", "src3", 1),
        (7, "é ü ñ 漢字 😀 one", "en", "src0", 16),
        (8, "word", None, None, 4),
        (5, prose(9, 60), "en", "src1", 2),
    ]
    return rows


def docs(spark, rows=None):
    return spark.createDataFrame(hard_rows() if rows is None else rows, DOCS)


def with_clashing_columns(df):
    """Extra columns named as the operators name theirs."""
    from pyspark.sql import functions as F

    names = ["node", "keys", "key", "label", "centre", "_words", "_tokens", "_source", "rate", "drawn", "score", "media", "segment", "class_id", "n_words", "_row", "a.b"]
    return df.withColumns({n: F.lit("x") for n in names if n not in df.columns})
